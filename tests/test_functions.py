"""Column functions on literal frames holding the edge rows of each rule."""

import json

import pytest
from pyspark.sql import functions as F

from civitas.functions import cleaning as C
from civitas.functions import json as J


def col(spark, values, ddl="x string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_clean_int_edges(spark):
    vals = [None, "", "nan", "-3.9", "1e3", "1,234", "1_000", "1d", "Infinity", "3e10", " 12 ", ".5", "abc"]
    got = [r[0] for r in col(spark, vals).select(C.clean_int("x")).collect()]
    assert got == [0, 0, 0, -3, 1000, 0, 1000, 0, 0, 30000000000, 12, 0, 0]


def test_unmask_code(spark):
    rows = [("2912*****12345", "29120"), ("29120612345", "29120"), ("12", "B"), (None, "B"), ("1*2", None),
            ("", "B"), ("**12", "BLK")]
    df = spark.createDataFrame(rows, "code string, block string")
    got = [r[0] for r in df.select(C.unmask_code("code", "block")).collect()]
    assert got == ["2912012345", "29120612345", "12", None, None, None, "BLK**12"]


def test_composite_key_null_propagates(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", None, "c")], "p string, q string, r string")
    assert [r[0] for r in df.select(C.composite_key("p", "q", "r")).collect()] == ["a-b-c", None]


def test_total_or_parts(spark):
    # (total, boys, girls) already sentinel-coded
    df = spark.createDataFrame([(-1, 3, -1), (-1, -1, -1), (10, 3, 4), (-1, 2, 5)], "t int, b int, g int")
    students = [r[0] for r in df.select(C.total_or_parts("t", "b", "g")).collect()]
    assert students == [3, -1, 10, 7]
    raw = spark.createDataFrame([(None, 3, -1), (-1, 3, 4), (None, -1, -1)], "t int, b int, g int")
    teachers = [r[0] for r in raw.select(C.total_or_parts("t", "b", "g", stated_sentinel_falls_back=False)).collect()]
    assert teachers == [3, -1, -1]


def test_slug_completeness_lookup(spark):
    df = spark.createDataFrame([("ANDHRA PRADESH", 200, 200), ("goa", 200, None), ("x", 404, 200)],
                               "s string, a int, b int")
    out = df.select(C.slug("s"), C.completeness("a", "b"), C.lookup_code("s", {"Andhra Pradesh": 128, "GOA": 130}))
    assert [tuple(r) for r in out.collect()] == [("andhra_pradesh", "success", 128), ("goa", "partial", 130),
                                                 ("x", "partial", None)]


def test_json_int_and_flags(spark):
    docs = ['{"data": {"k": 1}}', '{"data": {"k": "1"}}', '{"data": {"k": 2}}', '{"data": {}}',
            '{"data": {"k": null}}', '{"data": "s"}', None]
    df = col(spark, docs)
    got = [tuple(r) for r in df.select(J.json_int("x", "$.data.k"), J.json_flag("x", "$.data.k")).collect()]
    assert got == [(1, True), (1, True), (2, False), (None, None), (None, None), (None, None), (None, None)]


def test_json_int_rejects_malformed(spark):
    df = col(spark, ['{"k": "1.0"}'])
    with pytest.raises(Exception):
        df.select(J.json_int("x", "$.k")).collect()
    assert df.select(J.json_int("x", "$.k", on_bad="null")).first()[0] is None


def test_strict_flag(spark):
    docs = ['{"f": 1}', '{"f": 1.0}', '{"f": true}', '{"f": "1"}', '{"f": 2}', '{"f": 1.5}', '{"f": false}',
            '{"f": null}', '{}', '{"f": {"a": 1}}', None]
    got = [r[0] for r in col(spark, docs).select(J.strict_flag(J.variant("x"), "$.f")).collect()]
    assert got == [True, True, True, False, False, False, False, False, False, False, False]


def test_initial_status(spark):
    docs = ['{}', '{"schoolStatus": 0, "schoolStatusName": "A"}', '{"schoolStatus": "0"}',
            '{"schoolStatus": 1}', '{"schoolStatus": null, "schoolStatusName": null}', '{"schoolStatus": false}']
    s = J.initial_status(J.variant("x"))
    got = [tuple(r) for r in col(spark, docs).select(s["scrape_status"], s["status_name"], s["school_status"]).collect()]
    assert got == [("pending", "Unknown", 0), ("pending", "A", 0), ("closed_registry", "Unknown", 0),
                   ("closed_registry", "Unknown", 1), ("closed_registry", None, None), ("pending", "Unknown", 0)]


def test_truthy_text(spark):
    docs = ['{"p": 0}', '{"p": "0"}', '{"p": ""}', '{"p": null}', '{}', '{"p": 560038}', '{"p": "560038"}',
            '{"p": false}', '{"p": true}', '{"p": []}']
    got = [r[0] for r in col(spark, docs).select(J.truthy_text(J.variant("x"), "$.p")).collect()]
    assert got == [None, "0", None, None, None, "560038", "560038", None, "True", None]


def test_classify_response(spark):
    df = spark.createDataFrame([(503, None), (200, '{"status": true}'), (200, '{"status": "true"}'),
                                (200, "not json"), (404, '{"status": true}'), (200, "[1]")], "c int, b string")
    got = [r[0] for r in df.select(J.classify_response("c", "b")).collect()]
    assert got == ["retry", "ok", "bad", "bad", "bad", "bad"]


def test_json_or_missing_vs_null(spark):
    docs = ['{"data": {"yearId": 11}}', '{"data": {}}', '{"data": {"yearId": null}}']
    got = [r[0] for r in col(spark, docs).select(J.json_or(J.variant("x"), "$.data.yearId", 12)).collect()]
    assert got == [11, 12, None]


def test_json_map_set_keeps_absent_fields(spark):
    doc = '{"A": {"model": "m", "math_dependencies": ["x"]}, "COSTS_BUDGETS": {"model": "n", "flag": true}}'
    df = col(spark, [doc])
    out = df.select(J.json_map_set("x", "math_dependencies", {"COSTS_BUDGETS": ["SOLUTION_DESIGN", "BENEFICIARIES"]}, []))
    assert json.loads(out.first()[0]) == {
        "A": {"model": "m", "math_dependencies": []},
        "COSTS_BUDGETS": {"model": "n", "flag": True, "math_dependencies": ["SOLUTION_DESIGN", "BENEFICIARIES"]}}


def test_json_map_set_keeps_unnamed_fields_and_nulls(spark):
    doc = '{"A": {"deep": {"x": [1, 2.5]}, "empty": null, "deps": 3}, "B": {}}'
    got = col(spark, [doc, None, "[1]", "{"]).select(J.json_map_set("x", "deps", {"B": ["z"]}, [])).collect()
    assert json.loads(got[0][0]) == {"A": {"deep": {"x": [1, 2.5]}, "empty": None, "deps": []}, "B": {"deps": ["z"]}}
    assert [r[0] for r in got[1:]] == [None, None, None]


def test_floats_keep_their_point_and_large_counts_saturate(spark):
    docs = ['{"p": 560001.0}', '{"p": 560001}', '{"p": 1.5}', '{"p": 0.0}', '{"p": "560001.0"}']
    got = [r[0] for r in col(spark, docs).select(J.truthy_text(J.variant("x"), "$.p")).collect()]
    assert got == ["560001.0", "560001", "1.5", None, "560001.0"]
    big = col(spark, ["1e30", "-1e30", "1e999", "9e18"]).select(C.clean_int("x").alias("n"))
    assert [r[0] for r in big.collect()] == [2**63 - 1, -(2**63 - 1), 0, 9 * 10**18]


def test_with_defaults_only_absent(spark):
    df = spark.createDataFrame([(1, "ACTIVE")], "id int, status string")
    out = C.with_defaults(df, {"status": "PENDING", "active": False})
    assert out.first().asDict() == {"id": 1, "status": "ACTIVE", "active": False}


def test_where_present_is_pushed_down(spark, scratch):
    spark.createDataFrame([(1, "a"), (2, None)], "id int, s string").write.parquet(scratch)
    df = C.where_present(spark.read.parquet(scratch), "s")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(s)" in plan and df.count() == 1


def test_view_on_bad(spark):
    from civitas.plans import views as V
    df = spark.createDataFrame([("c", "n", "S", '{"data": {"laptopTot": "1.0", "internetYn": "x"}}')],
                               "udise_code string, school_name string, state_name string, facility_data string")
    with pytest.raises(Exception):
        V.view_digital_infrastructure(df).collect()
    r = V.view_digital_infrastructure(df, on_bad="null").first()
    assert r["laptop_count"] is None and r["has_internet"] is None


def test_exactly_one_json_value(spark):
    """P16 and the envelopes take a body that is one JSON value and nothing else."""
    bodies = ['{"status":true}', ' {"status":true}\n', '{"status":false,"status":true}', "{'status':true}", '{"status":true}trailing', '{"status":true}]',
              '{"status":true}]}', '{"status":true},{"status":true}', '{"status":true} {}', '{"status":"true"}', '{"status":1}', '[{"status":true}]',
              '{"status":null}', "", "true", None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    got = {r["i"]: r["c"] for r in df.select("i", J.classify_response(F.lit(200), "body").alias("c")).collect()}
    assert [got[i] for i in range(len(bodies))] == ["ok"] * 3 + ["bad"] * (len(bodies) - 3)
