"""End-to-end jobs on small landed fixtures (edge rows from FIXTURES.md)."""

import json

from pyspark.sql import functions as F

from civitas.plans import jobs as G
from civitas.plans.registry_queries import conform
from civitas.schemas import DISTRICT_DEMOGRAPHICS, LGD_MASTER, SCHOOLS

T0 = "2024-01-01 00:00:00"


def ts(text=T0):
    return F.lit(text).cast("timestamp_ntz")


def page(records):
    return json.dumps({"records": records})


def test_geography_sync(spark):
    target = spark.createDataFrame([(7, "V1", "old", "S1", "sub", "D1", "d", "ST1", "s", None, None)], LGD_MASTER)
    pages = spark.createDataFrame([
        (0, page([{"villageCode": "V1", "villageNameEnglish": "new1", "subdistrictCode": "S9", "pincode": 0},
                  {"villageCode": "V2", "villageNameEnglish": "a", "districtCode": "D2", "pincode": "0"},
                  {"villageCode": None, "villageNameEnglish": "bad"}])),
        (1, page([{"villageCode": "V2", "villageNameEnglish": "b", "districtCode": "D3", "pincode": 560001},
                  {"villageCode": "V3", "villageNameEnglish": "c", "pincode": ""}])),
        (2, page([])), (None, page([{"villageCode": "V9", "villageNameEnglish": "lost"}])),
        (3, '{"records": {"villageCode": "V8"}}'), (4, page([{"villageCode": "V7"}]) + "]")], "page int, body string")
    table, rejects = G.geography_sync(target, pages, as_of=ts())
    got = {r["village_code"]: r for r in table.collect()}
    assert set(got) == {"V1", "V2", "V3"}
    assert (got["V1"]["id"], got["V1"]["village_name"], got["V1"]["subdistrict_code"]) == (7, "new1", "S1")
    assert got["V1"]["pincode"] is None                      # number 0 is falsy
    assert (got["V2"]["id"], got["V2"]["village_name"], got["V2"]["district_code"]) == (8, "b", "D2")
    assert got["V2"]["pincode"] == "560001"
    assert (got["V3"]["id"], got["V3"]["pincode"]) == (9, None)
    assert sorted((r["page"] if r["page"] is not None else -1, r["reasons"]) for r in rejects.filter("body IS NOT NULL").collect()) == [
        (-1, "page_null"), (3, "records_not_array"), (4, "invalid_body")]
    assert [r["reasons"] for r in rejects.filter("body IS NULL").collect()] == ["village_code_null"]


def test_district_load(spark):
    target = spark.createDataFrame([("Goa", "North", "2021", 1, 1, 0, 0, "orig.csv", None)], DISTRICT_DEMOGRAPHICS)
    rows = spark.createDataFrame([
        ("Goa", "North", "2021", "10", "nan", "-3.9", 1),
        ("Goa", "North", "2021", "1e3", "1_000", "", 2),
        ("Goa", "South", "2021", "1,234", "Infinity", "5", 3),
        (None, "X", "2021", "1", "1", "1", 4),
        ("Goa", "Big", "2021", "3e10", "0", "0", 5)],
        "srcStateName string, srcDistrictName string, srcYear string, `Number of SC population` string, "
        "`Number of ST population` string, `Number of general population` string, line_no int")
    table, rejects = G.district_load(target, rows, as_of=ts())
    got = {r["district_name"]: r for r in table.collect()}
    assert (got["North"]["total_population"], got["North"]["sc_population"], got["North"]["source_file"]) == \
        (2000, 1000, "orig.csv")                            # last row wins, source file insert-only
    assert (got["South"]["total_population"], got["South"]["source_file"]) == (5, G.DISTRICT_SOURCE_FILE)
    assert sorted(r["reasons"] for r in rejects.collect()) == ["out_of_range", "state_null"]


def test_district_load_reads_stored_numbers(spark):
    """With ``checkpoint_batch`` no number is cleaned again for rules, fold or rejects; the results are the same."""
    rows = spark.createDataFrame([("Goa", "North", "2021", "10", "1", None, 1), ("Goa", "North", "2021", "3", "1_000", "x", 2),
                                  ("Goa", None, "2021", "1", "1", "1", 3), ("Goa", "Big", "2021", "3e10", "0", "0", 4)],
                                 "srcStateName string, srcDistrictName string, srcYear string, `Number of SC population` string, "
                                 "`Number of ST population` string, `Number of general population` string, line_no int")
    target = spark.createDataFrame([], DISTRICT_DEMOGRAPHICS)
    planned, kept = (G.district_load(target, rows, as_of=ts(), checkpoint_batch=c) for c in (False, True))
    for a, b in zip(planned, kept, strict=True):
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
        assert "RLIKE" not in b._jdf.queryExecution().optimizedPlan().toString()


def test_unreadable_fields(spark):
    records = ['{"n": 1, "t": "2024-01-01 00:00:00"}', '{"n": "x", "t": "never"}', '{"n": null}', "{}", '{"n": {"a": 1}, "s": 5}', "[1]"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, r string").select("i", F.parse_json("r").alias("record"))
    fields = {"num": ("n", "int"), "at": ("t", "timestamp_ntz"), "text": "s", "same": ("s", "string")}
    out = G.with_unreadable(df, "record", fields)
    assert out.columns == ["i", "record", "unreadable"]
    assert [r["unreadable"] for r in out.orderBy("i").collect()] == ["", "num,at", "", "", "num", ""]


def _resp(school, endpoint, attempt, status, body):
    return (school, endpoint, attempt, 0, status, None if body is None else json.dumps(body))


def test_school_enrichment_edges(spark):
    ok = lambda data: {"status": True, "data": data}
    target = conform(spark, spark.createDataFrame(
        [(s, 12, f"c{s}", "pending", -1, False) for s in range(1, 7)] + [(1, 11, "c1", "pending", -1, False)],
        "school_id int, year_id int, udise_code string, scrape_status string, total_teachers int, has_internet boolean"),
        SCHOOLS)
    responses = spark.createDataFrame([
        # 1: by_year ok (year missing -> 12), fragments ok, both required parts 200
        _resp(1, "by_year", 1, 200, ok({})), _resp(1, "report_card", 1, 200, ok({"totMale": 2, "totFemale": 3})),
        _resp(1, "profile_data", 1, 200, ok({"lgdwardId": 5})),
        _resp(1, "facility_data", 1, 200, ok({"internetYn": 1.0})),
        # 2: primary 503 first -> probe ok -> year 11, profile missing -> partial
        _resp(2, "by_year", 1, 503, None), _resp(2, "by_year", 2, 200, ok({"yearId": 12})),
        _resp(2, "probe", 1, 200, ok({})), _resp(2, "report_card", 1, 200, ok({"totalTeacher": 9})),
        _resp(2, "facility_data", 1, 200, {"status": "true", "data": {"internetYn": 1}}),
        # 3: primary bad then ok with explicit yearId 10
        _resp(3, "by_year", 1, 200, {"status": "true"}), _resp(3, "by_year", 2, 200, ok({"yearId": 10})),
        _resp(3, "report_card", 1, 200, ok({"totMale": None})), _resp(3, "profile_data", 1, 200, ok({})),
        # 4: primary and probe bad -> missing_on_server
        _resp(4, "by_year", 1, 404, None), _resp(4, "probe", 1, 404, None),
        # 5: a fragment with "data": null stops the school before its summary
        _resp(5, "by_year", 1, 200, ok({})), _resp(5, "report_card", 1, 200, {"status": True, "data": None}),
        _resp(5, "profile_data", 1, 200, ok({})),
    ], "school_id int, endpoint string, attempt int, seq long, http_status int, body string")
    out = G.school_enrichment(target, responses, as_of=ts())
    all_rows = out.collect()
    assert len(all_rows) == 7
    got = {(r["school_id"], r["udise_code"]): r for r in all_rows}
    school1 = [r for r in all_rows if r["school_id"] == 1]
    s1a = school1[0]
    assert len(school1) == 2
    for r in school1:                                       # U5: every row of the school changes
        assert (r["effective_year"], r["year_id"], r["scrape_status"]) == (12, 12, "success")
        assert (r["total_teachers"], r["has_internet"], r["lgd_ward_id"]) == (5, True, "5")
    assert json.loads(s1a["enrichment_manifest"]) == {"basic_info": 200, "facility_data": 200,
                                                      "profile_data": 200, "report_card": 200}
    s2 = got[(2, "c2")]
    assert (s2["effective_year"], s2["year_id"], s2["scrape_status"], s2["total_teachers"], s2["has_internet"]) == \
        (11, 11, "partial", 9, False)
    assert s2["basic_info"] == "{}" and s2["facility_data"] is None
    s3 = got[(3, "c3")]
    assert (s3["effective_year"], s3["scrape_status"], s3["total_teachers"]) == (10, "success", -1)
    s4 = got[(4, "c4")]
    assert (s4["scrape_status"], s4["effective_year"], s4["year_id"], s4["enrichment_manifest"]) == \
        ("missing_on_server", None, 12, None)
    s5 = got[(5, "c5")]
    assert (s5["effective_year"], s5["year_id"], s5["scrape_status"], s5["total_teachers"]) == (12, 12, "pending", -1)
    assert s5["report_card"] is not None and s5["enrichment_manifest"] is not None
    s6 = got[(6, "c6")]                                     # not in this batch: untouched
    assert (s6["scrape_status"], s6["effective_year"], s6["last_scraped_at"]) == ("pending", None, None)


def test_school_discovery_hierarchy(spark):
    districts = spark.createDataFrame([(129, json.dumps({"data": [{"districtId": 1, "districtName": "D1"}]}))],
                                      "state_id int, body string")
    blocks = spark.createDataFrame([(1, json.dumps({"data": [{"blockId": 10, "blockName": "B10"},
                                                             {"blockId": 11, "blockName": "Empty"}]}))],
                                   "district_id int, body string")
    clusters = spark.createDataFrame([(10, json.dumps({"data": [{"clusterId": 100, "clusterName": "C100"}]})),
                                      (11, json.dumps({"data": []}))], "block_id int, body string")
    schools = [
        {"schoolId": 1, "udiseschCode": "2912*****12345", "blockCd": "29120", "schoolName": "A", "schoolStatus": 0},
        {"schoolId": 2, "udiseschCode": "29120654321", "blockCd": "29120", "schoolName": "B", "schoolStatus": 1},
        {"schoolId": 3, "udiseschCode": None, "blockCd": "29120", "schoolName": "C"},
        {"schoolId": 1, "udiseschCode": "2912*****12345", "blockCd": "29120", "schoolName": "A2"},
        {"schoolId": None, "udiseschCode": "29120600001", "blockCd": "29120", "schoolName": "NoId"},
    ]
    pages = spark.createDataFrame([(100, 0, json.dumps({"data": {"content": schools}}))],
                                  "cluster_id int, page int, body string")
    target = conform(spark, spark.createDataFrame([(2, 12, "old", "success", 11)],
                     "school_id int, year_id int, school_name string, scrape_status string, effective_year int"),
                     SCHOOLS)
    pages = pages.union(spark.createDataFrame([(999, 0, json.dumps({"data": {"content": schools}})), (100, 1, '{"data": {"content": {}}}'),
                                               (100, 2, '{"data": [1]}'), (100, 3, "no json"), (100, 4, '{"data": null}')], pages.schema))
    found, unread = G.discovered_schools(districts, blocks, clusters, pages)
    assert sorted((r["level"], r["parent_id"], r["page"], r["reasons"]) for r in unread.collect()) == [
        ("school", 100, 1, "records_not_array"), ("school", 100, 2, "records_not_array"), ("school", 100, 3, "invalid_body"),
        ("school", 999, 0, "cluster_unknown")]
    table, rejects = G.school_discovery(target, found)
    got = {r["school_id"]: r for r in table.collect()}
    assert set(got) == {1, 2}
    assert (got[1]["udise_code"], got[1]["school_name"], got[1]["scrape_status"]) == ("2912012345", "A2", "pending")
    assert (got[1]["block_name"], got[1]["cluster_name"]) == ("B10", "C100")
    assert (got[2]["school_name"], got[2]["scrape_status"], got[2]["effective_year"]) == ("B", "success", 11)
    assert sorted(r["reasons"] for r in rejects.collect()) == ["no_code", "school_id_null"]
    assert G.STATE_IDS["GOA"] == 130
    assert spark.range(1).select(G.state_id(F.lit("karnataka"))).first()[0] == 129


def test_seed_and_migrate(spark):
    target = spark.createDataFrame([(1, "Education", None), (5, "Healthcare", None)],
                                   "id int, name string, created_at timestamp_ntz")
    seeds = spark.createDataFrame([("WASH / JJM", 1), ("Education", 2), ("Livelihoods", 3), ("WASH / JJM", 4)],
                                  "name string, seq int")
    once = G.seed_reference(target, seeds, as_of=ts())
    got = sorted((r["id"], r["name"]) for r in once.collect())
    assert got == [(1, "Education"), (5, "Healthcare"), (6, "Livelihoods"), (7, "WASH / JJM")]
    again = G.seed_reference(once, seeds, as_of=ts())
    assert sorted((r["id"], r["name"]) for r in again.collect()) == got
    cfg = json.dumps({"A": {"model": "m", "math_dependencies": ["x"]}, "COSTS_BUDGETS": {"model": "n"}})
    bp = spark.createDataFrame([(1, True, cfg), (2, False, cfg)], "id int, is_default boolean, sections_config string")
    out = {r["id"]: json.loads(r["sections_config"]) for r in G.migrate_config(
        bp, "math_dependencies", {"COSTS_BUDGETS": ["SOLUTION_DESIGN", "BENEFICIARIES"]}, [])[0].collect()}
    assert out[1] == {"A": {"model": "m", "math_dependencies": []},
                      "COSTS_BUDGETS": {"model": "n", "math_dependencies": ["SOLUTION_DESIGN", "BENEFICIARIES"]}}
    assert out[2] == json.loads(cfg)
    odd = json.dumps({"A": {"model": "m", "prompt_method": "p"}})
    bp2 = spark.createDataFrame([(3, True, odd)], "id int, is_default boolean, sections_config string")
    kept = G.migrate_config(bp2, "math_dependencies", {}, [])[0].first()["sections_config"]
    assert json.loads(kept) == {"A": {"model": "m", "prompt_method": "p", "math_dependencies": []}}


def test_configurations_that_cannot_be_migrated(spark):
    bad = ['{"A":{"x":1},"B":"text"}', '{"A":{"x":1},"B":null}', "[1]", "no json", None]
    bp = spark.createDataFrame([(i, True, c) for i, c in enumerate([*bad, "{}", '{"A":{}}'])] + [(9, False, "no json")],
                               "id int, is_default boolean, sections_config string")
    table, rejects = G.migrate_config(bp, "deps", {}, [])
    got = {r["id"]: r["sections_config"] for r in table.collect()}
    assert [got[i] for i in range(5)] == bad and got[9] == "no json" and got[5] == "{}" and json.loads(got[6]) == {"A": {"deps": []}}
    assert sorted((r["id"], r["reasons"]) for r in rejects.collect()) == [
        (0, "entry_not_object"), (1, "entry_not_object"), (2, "config_not_object"), (3, "config_not_object"), (4, "config_not_object")]


def test_bad_pages_are_rejected_alone(spark):
    target = spark.createDataFrame([], LGD_MASTER)
    pages = spark.createDataFrame([
        (0, '{"records": [], "records": [{"villageCode": "A"}]}'), (1, page([{"villageCode": "B"}, {"villageCode": "C"}])),
        (2, '{"records": [{"villageCode": "D"'), (3, None)], "page int, body string")
    table, rejects = G.geography_sync(target, pages, as_of=ts())
    assert sorted((r["village_code"], r["id"]) for r in table.collect()) == [("A", 1), ("B", 2), ("C", 3)]
    assert sorted((r["page"], r["reasons"]) for r in rejects.collect()) == [(2, "invalid_body"), (3, "invalid_body")]


def test_null_primary_document_leaves_the_school(spark):
    target = conformed(spark, [(1, 12, "pending"), (2, 12, "pending")])
    responses = spark.createDataFrame([
        _resp(1, "by_year", 1, 200, {"status": True, "data": None}), _resp(1, "report_card", 1, 200, {"status": True, "data": {}}),
        _resp(2, "by_year", 1, 200, {"status": True, "data": {"yearId": 10}}),
        (2, "by_year", 1, 1, 200, json.dumps({"status": True, "data": {"yearId": 11}}))],
        "school_id long, endpoint string, attempt int, seq long, http_status int, body string")
    out = {r["school_id"]: r for r in G.school_enrichment(target, responses, as_of=ts()).collect()}
    assert (out[1]["scrape_status"], out[1]["effective_year"], out[1]["enrichment_manifest"]) == ("pending", None, None)
    assert out[2]["effective_year"] == 11                    # the later fetch round counts
    assert [tuple(r)[0::2] for r in G.enrichment_rejects(responses).collect()] == [(1, "primary_data_null")]


def conformed(spark, rows):
    from civitas.plans.registry_queries import conform
    from civitas.schemas import SCHOOLS
    return conform(spark, spark.createDataFrame(rows, "school_id long, year_id int, scrape_status string"), SCHOOLS)


def test_summary_of_unreadable_counts(spark):
    from civitas.plans.summary import extract_summary
    docs = [('{"data": {"schEnrollmentYearDataTotal": null}}',), ('{"data": {"schEnrollmentYearDataTotal": {"rowTotal": "many"}}}',),
            ('{"data": {"schEnrollmentYearDataTotal": {"rowTotal": 5}}}',), ('{"data": {"schEnrollmentYearDataTotal": {"rowTotal": null}}}',)]
    df = spark.createDataFrame(docs, "enrollment_social string").selectExpr(
        "*", *[f"CAST(NULL AS STRING) AS {c}" for c in ("report_card", "facility_data", "profile_data")])
    assert [r["summary_error"] for r in extract_summary(df).collect()] == [True, True, False, False]


def test_enrichment_on_touched_buckets_only(spark, scratch):
    from civitas.sources import tables as T
    schema = spark.createDataFrame([], SCHOOLS).schema
    base = conform(spark, spark.range(1, 41).selectExpr(
        "cast(id as int) as school_id", "12 as year_id", "concat('c', id) as udise_code",
        "'pending' as scrape_status", "-1 as total_teachers", "false as has_internet"), SCHOOLS)
    path = f"{scratch}/schools"
    T.apply_to_buckets(spark, path, base, "school_id", lambda cur: base.withColumn(
        T.BUCKET_COL, T.bucket_of(["school_id"], 8, schema)), schema, num_buckets=8)
    responses = spark.createDataFrame([_resp(3, "by_year", 1, 404, None), _resp(3, "probe", 1, 404, None)],
                                      "school_id int, endpoint string, attempt int, seq long, http_status int, "
                                      "body string")
    touched = T.apply_to_buckets(
        spark, path, responses, "school_id",
        lambda cur: G.school_enrichment(cur.drop(T.BUCKET_COL), responses, as_of=ts())
        .withColumn(T.BUCKET_COL, T.bucket_of(["school_id"], 8, schema)), schema, num_buckets=8)
    assert len(touched) == 1
    table = {r["school_id"]: r["scrape_status"] for r in T.read_buckets(spark, path).collect()}
    assert len(table) == 40 and table[3] == "missing_on_server"
    assert sum(1 for v in table.values() if v == "pending") == 39


def test_sync_status_row(spark):
    from civitas.operators.ids import resume_offset
    target = spark.range(2345)
    consumed = spark.range(120)
    row = G.sync_status_row(spark, "lgd_master", resume_offset(None, target, "lgd_master"), consumed,
                            as_of=ts()).first()
    assert (row["job_name"], row["last_offset"]) == ("lgd_master", 2120)


def test_state_parameter_fails_fast():
    import pytest
    assert G.state_id_of("Kerala") == 132
    with pytest.raises(ValueError):
        G.state_id_of("Atlantis")


def test_district_rows_from_csv_files(spark, scratch):
    import os
    os.makedirs(f"{scratch}/d")
    head = "srcStateName,srcDistrictName,srcYear,Number of SC population,Number of ST population,Number of general population\n"
    for name, body in (("1.csv", "Goa,North,2021,1,1,1\nGoa,North,2021,2,2,2\nGoa,South,2021,5,0,0\n"), ("2.csv", "Goa,North,2021,3,3,3\n")):
        with open(f"{scratch}/d/{name}", "w") as f:
            f.write(head + body)
    table, rejects = G.district_load(spark.createDataFrame([], DISTRICT_DEMOGRAPHICS), G.district_rows(spark, f"{scratch}/d"), as_of=ts())
    got = {r["district_name"]: r["total_population"] for r in table.collect()}
    assert got == {"North": 9, "South": 5} and rejects.count() == 0


def test_enrich_state_changes_its_queue_only(spark):
    target = conformed(spark, [(1, 12, "pending"), (2, 12, "success"), (3, 12, "pending")])
    target = target.withColumn("state_name", F.when(F.col("school_id") == 3, "KERALA").otherwise("GOA"))
    ok = {"status": True, "data": {"yearId": 12}}
    responses = spark.createDataFrame([_resp(i, e, 1, 200, ok) for i in (1, 2, 3) for e in ("by_year", "report_card", "profile_data")],
                                      "school_id long, endpoint string, attempt int, seq long, http_status int, body string")
    table, rejects = G.enrich_state(target, responses, "GOA", as_of=ts())
    got = {r["school_id"]: (r["scrape_status"], r["enrichment_manifest"] is not None) for r in table.collect()}
    assert got == {1: ("success", True), 2: ("success", False), 3: ("pending", False)} and rejects.count() == 0


def _landed(spark, pages):
    return spark.createDataFrame([(o, b if isinstance(b, str) else page([{"villageCode": c, "villageNameEnglish": n} for c, n in b]), s)
                                  for o, b, s in pages], "offset long, body string, seq int")


def test_geography_increment(spark, scratch):
    """Only the unbroken run of pages moves the offset; gaps, broken, short and empty pages stop it; a replay changes nothing."""
    from civitas.sources.tables import list_versions, read_latest, read_progress
    status = spark.createDataFrame([], "job_name string, last_offset bigint, last_updated timestamp_ntz").schema

    def run(*pages):
        progress, rejects = G.geography_increment(spark, scratch, _landed(spark, pages), limit=2, as_of=ts())
        p = progress.first()
        assert p["pages"] == 0 or [r["last_offset"] for r in read_progress(spark, scratch, status).collect()] == [p["last_offset"]]
        return p["last_offset"], p["state"], sorted(r["reasons"] for r in rejects.collect())

    two = lambda a, b: [(a, a.lower()), (b, b.lower())]
    codes = lambda: sorted((r["village_code"], r["village_name"], r["id"]) for r in read_latest(spark, scratch).collect())
    assert run((2, two("C", "D"), 1)) == (0, "waiting", [])                       # the first page is missing
    assert list_versions(spark, scratch) == []
    assert run((0, "{broken", 1), (2, two("C", "D"), 1)) == (0, "restart", ["invalid_body"])
    assert run((0, "{broken", 2), (0, two("A", "B"), 1), (4, two("E", "F"), 1), (None, two("X", "Y"), 1)) == (
        2, "waiting", ["invalid_body", "offset_null"])                            # page 2 is missing, 4 waits
    assert codes() == [("A", "a", 1), ("B", "b", 2)]
    landed = [(0, two("A", "B"), 1), (2, two("C", "A"), 1), (2, two("C", "A"), 1), (4, [("E", "e")], 1), (6, two("G", "H"), 1)]
    assert run(*landed) == (5, "complete", [])                                    # a short page is the last
    assert codes() == [("A", "a", 1), ("B", "b", 2), ("C", "c", 3), ("E", "e", 4)]
    before = list_versions(spark, scratch)
    assert run(*landed) == (5, "waiting", []) and list_versions(spark, scratch) == before
    assert run(*landed, (5, [], 1)) == (5, "complete", []) and list_versions(spark, scratch) == before
    assert run((5, two("B", "I"), 1), (7, [], 1)) == (7, "complete", [])
    from civitas.sources.tables import read_counters
    assert [tuple(r) for r in read_counters(spark, scratch).collect()] == [("lgd_master", 3, 7, 0, 5)]


def test_rows_and_offset_are_one_commit(spark, scratch, monkeypatch):
    """A failure before the rename leaves neither rows nor offset, and the next run does both."""
    import pytest

    from civitas.sources import tables
    pages = [(0, [("A", "a"), ("B", "b")], 1), (2, [("C", "c")], 1)]
    status = spark.createDataFrame([], "job_name string, last_offset bigint, last_updated timestamp_ntz").schema
    publish = tables._publish

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "_publish", broken)
    with pytest.raises(RuntimeError, match="lost"):
        G.geography_increment(spark, scratch, _landed(spark, pages), limit=2)
    assert tables.list_versions(spark, scratch) == [] and tables.read_progress(spark, scratch, status).count() == 0
    monkeypatch.setattr(tables, "_publish", publish)
    assert G.geography_increment(spark, scratch, _landed(spark, pages), limit=2)[0].first()["last_offset"] == 3
    assert tables.read_latest(spark, scratch).count() == 3 and tables.read_progress(spark, scratch, status).first()["last_offset"] == 3
