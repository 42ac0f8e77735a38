"""Sources and sinks: positional CSV, named CSV, zipped CSV, envelopes, versioned tables, stream."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from civitas.operators import upsert as U
from civitas.sources import csv as S
from civitas.sources import tables as T
from civitas.sources.envelope import explode_records, parse_bodies
from civitas.sources import zipped
from civitas.sources.records import NOTED
from civitas.sources.zipped import read_zip_member_csv


def write_text(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_positional_empty_vs_null_quotes_newlines(spark, scratch):
    write_text(scratch, "a.csv", 'renamed_a,renamed_b,renamed_c\n1,,""\n2,"say ""hi""","line1\nline2"\n')
    df = S.read_csv_positional(spark, scratch, ["x", "y", "z"])
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("1", None, ""), ("2", 'say "hi"', "line1\nline2")]


def test_csv_positional_wrong_field_count(spark, scratch):
    write_text(scratch, "a.csv", "a,b\n1,2\n3\n4,5,6\n")
    with pytest.raises(Exception):
        S.read_csv_positional(spark, scratch, ["x", "y"]).collect()
    good, bad = S.read_csv_positional(spark, scratch, ["x", "y"], on_bad="reject")
    assert sorted(tuple(r) for r in good.collect()) == [("1", "2")]
    assert bad.count() == 2


def test_csv_named_missing_column(spark, scratch):
    write_text(scratch, "a.csv", "srcStateName,extra,Number of SC population\nGoa,x,12\n")
    df = S.read_csv_named(spark, scratch, {"srcStateName": "string", "Number of SC population": "string",
                                           "Number of ST population": "string"})
    assert [tuple(r) for r in df.collect()] == [("Goa", "12", None)]


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def test_zip_member_csv(spark, scratch):
    _zip(f"{scratch}/a.zip", {"notes.txt": "x", "dir/9307_source_data.csv": "srcStateName,srcYear\nGoa,2021\n,2022\n"})
    df = read_zip_member_csv(spark, scratch, "9307_source_data.csv", {"srcStateName": "string", "srcYear": "string",
                                                                      "Number of SC population": "string"})
    got = sorted((r["srcStateName"] or "", r["srcYear"], r["Number of SC population"]) for r in df.collect())
    assert got == [("", "2022", None), ("Goa", "2021", None)]


def test_zip_without_member_fails(spark, scratch):
    _zip(f"{scratch}/b.zip", {"other.csv": "a\n1\n"})
    with pytest.raises(Exception):
        read_zip_member_csv(spark, scratch, "9307_source_data.csv", {"a": "string"}).collect()


def test_zip_members_of_any_form(spark, scratch):
    """Stored and deflated members, a streamed archive with late sizes, decoys before and behind, blanks in the path."""
    text = "srcYear,srcStateName\n" + "".join(f'{i},"state\n{i}, ""x"""\n' for i in range(5000)) + "NA,nan\n"
    os.makedirs(f"{scratch}/with blank")

    class Unseekable(io.RawIOBase):
        def __init__(self):
            self.data = bytearray()

        def writable(self):
            return True

        def write(self, b):
            self.data += b
            return len(b)

    for kind in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        out = Unseekable()
        with zipfile.ZipFile(f"{scratch}/with blank/plain-{kind}.zip", "w", kind) as z, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as late:
            for archive in (z, late):
                archive.writestr("decoy.txt", os.urandom(3000))
                archive.writestr("a/9307_source_data.csv", text)
                archive.writestr("b/9307_source_data.csv", "second member")
        with open(f"{scratch}/with blank/late-{kind}.zip", "wb") as f:
            f.write(out.data)
    got = read_zip_member_csv(spark, f"{scratch}/with blank", "9307_source_data.csv", {"srcStateName": "string", "srcYear": "int"})
    assert got.select("source_path").distinct().count() == 4 and {r["member"] for r in got.select("member").distinct().collect()} == {"a/9307_source_data.csv"}
    one = got.filter(got["source_path"].contains("late-8")).orderBy("line_no").collect()
    assert [(r["srcStateName"], r["srcYear"]) for r in one] == [(f'state\n{i}, "x"', i) for i in range(5000)] + [(None, None)]
    assert got.count() == 4 * 5001


def test_zip_staging_goes_on_after_a_broken_run(spark, scratch):
    """A run that fails leaves nothing that is read; the next stages what is missing, and only that."""
    wanted, like = {"a": "string"}, "9307_source_data.csv"
    _zip(f"{scratch}/in/one.zip", {like: "a\n1\n2\n"})
    read = lambda: sorted(r["a"] for r in read_zip_member_csv(spark, f"{scratch}/in", like, wanted, stage=f"{scratch}/stage").collect())
    assert read() == ["1", "2"]
    _zip(f"{scratch}/in/two.zip", {like: "a\n" + "".join(f"{os.urandom(20).hex()}\n" for _ in range(3000))})
    with open(f"{scratch}/in/two.zip", "rb") as f:
        whole = f.read()
    for damaged in (whole[:len(whole) // 2], whole[:2000] + bytes([whole[2000] ^ 1]) + whole[2001:]):
        with open(f"{scratch}/in/two.zip", "wb") as f:
            f.write(damaged)
        with pytest.raises(Exception):
            read()
    spark.createDataFrame([("one", 0, 0, "half a line", 0, 0, 0, 0, 0, 0)], NOTED).write.parquet(f"{scratch}/stage/lines/half-written")
    _zip(f"{scratch}/in/two.zip", {like: "a\n3\n"})
    assert read() == ["1", "2", "3"]
    runs = spark.read.parquet(f"{scratch}/stage/complete").groupBy("run").count().collect()
    assert sorted(r["count"] for r in runs) == [1, 1]
    assert read() == ["1", "2", "3"] and spark.read.parquet(f"{scratch}/stage/complete").count() == 2


def test_inflating_holds_a_chunk_at_a_time(monkeypatch):
    """However long archive and member are, bytes are handed on in bounded chunks."""
    monkeypatch.setattr(zipped, "CHUNK", 1000)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.csv", b"a,b\n" * 300_000)
    data, held = buf.getvalue(), []
    found = zipped.first_member((data[i:i + 50] for i in range(0, len(data), 50)), "x.csv", "t")
    assert next(found) == "x.csv"
    n = sum(held.append(len(chunk)) or len(chunk) for chunk in found)
    assert n == 1_200_000 and max(held) <= 1000


def test_named_csv_rules(spark, scratch):
    """Blanks in the path, repeated names, quoted newlines, short and long rows, missing markers."""
    os.makedirs(f"{scratch}/in dir")
    with open(f"{scratch}/in dir/f 1.csv", "w", newline="") as f:
        f.write('\ufeffa,a,"b, c"\r\n1,2,"x\r\ny"\r\n\r\nNA,3\r\nnull,"",z,more\r\n"nan",4,None\r\n')
    got = S.read_csv_named(spark, f"{scratch}/in dir", {"a": "string", "b, c": "string", "d": "int"}, positions=True).orderBy("line_no").collect()
    assert [tuple(r)[2:] for r in got] == [("1", "x\ny", None), (None, None, None), (None, "z", None), (None, None, None)]
    kept = S.read_csv_named(spark, f"{scratch}/in dir", {"a": "string"}, missing=("",)).collect()
    assert sorted(r["a"] for r in kept) == ["1", "NA", "nan", "null"]


def test_explode_records_edges(spark):
    df = spark.createDataFrame([(1, '{"records": [{"villageCode": "V1", "pincode": 0}, {"villageCode": "V2"}]}'),
                                (2, '{"records": []}'), (3, '{"records": null}'), (4, '{}'), (5, "bad json")],
                               "page int, body string")
    out = explode_records(df, "body", "$.records", {"code": "villageCode"}, keep=["page"])
    assert sorted((r["page"], r["record_index"], r["code"]) for r in out.collect()) == [(1, 0, "V1"), (1, 1, "V2")]


def test_records_are_walked_once(spark):
    """Fields come out of one struct of the record, equal to a search per field, whatever the record is."""
    records = ['{"a": 1, "b": "x", "odd key": 3, "C": 5, "c": 6}', '{"a": "7", "b": null, "d": 2.5}', '{"a": "x", "b": {"k": 1}, "d": "z"}',
               '[1, 2]', '"text"', 'null', '{}', '{"a": 99999999999, "d": true, "ts": "2024-01-02 03:04:05"}']
    df = spark.createDataFrame([(1, '{"records": [' + ", ".join(records) + "]}")], "page int, body string")
    fields = {"a": ("a", "int"), "b": "b", "cc": "C", "c": ("c", "int"), "d": ("d", "double"), "ts": ("ts", "timestamp_ntz"), "gone": "gone"}
    out = explode_records(df, "body", "$.records", fields, keep=["page"])
    single = [f"try_variant_get(record, '$.{k}', '{t}')" for k, t in ((f, "string") if isinstance(f, str) else f for f in fields.values())]
    assert out.count() == len(records)
    assert out.filter(" OR ".join(f"NOT ({e} <=> {n})" for e, n in zip(single, fields, strict=True))).count() == 0
    plain = explode_records(df, "body", "$.records", {f"f{i}": (f"k{i}", "int") for i in range(20)})
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get(record") == 1


def test_body_kinds(spark):
    """Objects, arrays and other values at every step of the path: the same reasons as ever."""
    bodies = {'{"data": {"content": [1, {"a": 2}]}}': "", '{"data": {"content": []}}': "", '{"data": {}}': "", '{"data": null}': "", "{}": "",
              '{"data": {"content": null}}': "", '{"data": [1]}': "records_not_array", '{"data": {"content": {"a": 1}}}': "records_not_array",
              '{"data": {"content": "none"}}': "records_not_array", "[]": "records_not_array", "3": "records_not_array", "null": "records_not_array",
              "{": "invalid_body", '{"data": 5}': "records_not_array"}
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    parsed = parse_bodies(df, "body", "$.data.content")
    assert {r["body"]: r["reasons"] for r in parsed.select("body", "reasons").collect()} == bodies
    assert "map<string,variant>" not in parsed._jdf.queryExecution().optimizedPlan().toString()


def test_versions_rotate_and_evolve(spark, scratch):
    base = f"{scratch}/t"
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    T.write_version(df, base)
    T.write_version(df.withColumn("v", F.lit("b")), base)
    assert T.list_versions(spark, base) == [1, 2]
    assert T.read_latest(spark, base).first()["v"] == "b"
    assert T.read_as_of(spark, base, 1).first()["v"] == "a"
    from pyspark.sql import types as TT
    T.rotate_table(spark, base, f"{scratch}/bak", TT.StructType([TT.StructField("k", TT.IntegerType())]))
    assert T.read_latest(spark, base).count() == 0
    assert T.read_latest(spark, f"{scratch}/bak").first()["v"] == "b"
    ev = T.ensure_column(df, "downstream_summary", "string", "{}")
    assert ev.first()["downstream_summary"] == "{}"
    T.append_table(df, f"{scratch}/raw")
    T.append_table(df, f"{scratch}/raw")
    assert spark.read.parquet(f"{scratch}/raw").count() == 2


def test_incremental_stream_equals_batch_and_resumes(spark, scratch):
    from civitas.streaming import incremental_upsert
    land = f"{scratch}/landing/*"
    schema = "k long, v string, seq long"
    batches = [[(1, "a", 1), (2, "b", 2)], [(1, "c", 3)], [(3, "d", 4), (2, "e", 5)]]

    def run():
        incremental_upsert(spark, land, schema, f"{scratch}/target", "k long, v string", f"{scratch}/ckpt",
                           "k", {"v": U.OVERWRITE}, seq="seq", status_path=f"{scratch}/status", job="j")

    for i, b in enumerate(batches[:2]):
        spark.createDataFrame(b, schema).write.mode("overwrite").json(f"{scratch}/landing/b{i}")
    run()
    assert sorted(tuple(r) for r in T.read_latest(spark, f"{scratch}/target").collect()) == [(1, "c"), (2, "b")]
    spark.createDataFrame(batches[2], schema).write.mode("overwrite").json(f"{scratch}/landing/b2")
    run()  # resumes from the checkpoint: only the new file is read
    final = sorted(tuple(r) for r in T.read_latest(spark, f"{scratch}/target").collect())
    assert final == [(1, "c"), (2, "e"), (3, "d")]
    status = T.read_latest(spark, f"{scratch}/status").first()
    assert status["job_name"] == "j" and status["last_offset"] == 5


def test_merge_into_buckets_rewrites_only_touched(spark, scratch):
    import glob
    from pyspark.sql import types as TT
    path = f"{scratch}/bucketed"
    schema = TT.StructType([TT.StructField("k", TT.LongType()), TT.StructField("v", TT.StringType())])
    rules = {"v": U.OVERWRITE}
    first = spark.createDataFrame([(i, "a") for i in range(200)], schema)
    touched_all = T.merge_into_buckets(spark, path, first, "k", rules, schema, num_buckets=16)
    assert len(touched_all) == 16

    def mtimes():
        return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/_bucket=*/*.parquet")}

    before = mtimes()
    batch = spark.createDataFrame([(7, "b", 1), (7, "c", 2), (1000, "n", 3)], "k long, v string, seq int")
    touched = T.merge_into_buckets(spark, path, batch, "k", rules, schema, seq="seq", num_buckets=16)
    assert 1 <= len(touched) <= 2
    after = mtimes()
    untouched = [f for f in before if not any(f"_bucket={b}/" in f for b in touched)]
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    table = {r["k"]: r["v"] for r in T.read_buckets(spark, path).collect()}
    assert len(table) == 201 and table[7] == "c" and table[1000] == "n" and table[8] == "a"
    T.merge_into_buckets(spark, path, batch, "k", rules, schema, seq="seq", num_buckets=16)  # replay
    again = {r["k"]: r["v"] for r in T.read_buckets(spark, path).collect()}
    assert again == table


def test_union_with_defaults(spark):
    old = spark.createDataFrame([(1, "a")], "id int, content string")
    new = spark.createDataFrame([(2, "b", '{"x": 1}')], "id int, content string, downstream_summary string")
    out = sorted(tuple(r) for r in T.union_with_defaults(old, new, {"downstream_summary": "{}"}).collect())
    assert out == [(1, "a", "{}"), (2, "b", '{"x": 1}')]


@pytest.mark.parametrize("num_buckets", [None, 8])
def test_stream_batch_replay_is_idempotent(spark, scratch, num_buckets):
    """A micro-batch written twice (failure before the commit, then replay)
    leaves the table and the offset row exactly as a single write."""
    from pyspark.sql import types as TT
    from civitas.streaming.incremental import batch_writer
    tschema = TT.StructType([TT.StructField("k", TT.LongType()), TT.StructField("v", TT.StringType())])
    b0 = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, v string, seq long")
    b1 = spark.createDataFrame([(1, "c", 3), (3, "d", 4)], "k long, v string, seq long")

    def run(path, replay):
        w = batch_writer(spark, f"{path}/t", tschema, "k", {"v": U.OVERWRITE}, "seq",
                         status_path=f"{path}/s", job="j", num_buckets=num_buckets)
        w(b0, 0)
        w(b1, 1)
        if replay:
            w(b1, 1)
        read = T.read_buckets if num_buckets else T.read_latest
        table = sorted(tuple(r) for r in read(spark, f"{path}/t").collect())
        return table, T.read_latest(spark, f"{path}/s").first()["last_offset"]

    once, twice = run(f"{scratch}/once", False), run(f"{scratch}/twice", True)
    assert once == twice == ([(1, "c"), (2, "b"), (3, "d")], 4)


def test_counters_are_committed_with_their_rows(spark, scratch, monkeypatch):
    """Replays count once, failures not at all, jobs apart; the stream's counters come with its versions."""
    from pyspark.sql import types as TT

    from civitas.streaming.incremental import batch_writer
    t, base = spark.createDataFrame([(1,), (2,)], "k long"), f"{scratch}/c"
    got = lambda path: sorted(tuple(r) for r in T.read_counters(spark, path).collect())
    assert got(base) == []
    assert T.commit_run(t, base, "r1", "a", read=t, rejects=1) and not T.commit_run(t, base, "r1", "a", read=t, rejects=1)
    assert got(base) == [("a", 1, 2, 1, 2)]
    publish = T._publish

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(T, "_publish", broken)
    with pytest.raises(RuntimeError, match="lost"):
        T.commit_run(t.limit(1), base, "r2", "a", read=t)
    monkeypatch.setattr(T, "_publish", publish)
    assert got(base) == [("a", 1, 2, 1, 2)] and T.read_latest(spark, base).count() == 2
    assert T.commit_run(t.limit(1), base, "r2", "a", read=t)        # rows that went count as negative
    assert T.commit_run(t.limit(0), base, "r3", "b")                # an empty version
    assert got(base) == [("a", 2, 4, 1, 1), ("b", 1, 0, 0, -1)]
    T.write_version(t, base)                                        # a version without counters hides none
    assert got(base) == [("a", 2, 4, 1, 1), ("b", 1, 0, 0, -1)]
    tschema = TT.StructType([TT.StructField("k", TT.LongType()), TT.StructField("v", TT.StringType())])
    w = batch_writer(spark, f"{scratch}/s", tschema, "k", {"v": U.OVERWRITE}, "seq", job="j")
    for batch_id, rows in ((0, [(1, "a", 1), (1, "b", 2)]), (1, [(2, "c", 3)]), (1, [(2, "c", 3)])):
        w(spark.createDataFrame(rows, "k long, v string, seq long"), batch_id)
    assert got(f"{scratch}/s") == [("j", 2, 3, 0, 2)]


def test_stream_never_overwrites_versions(spark, scratch):
    """A stream with a new checkpoint goes on from the newest version, whatever its batch ids."""
    from pyspark.sql import types as TT

    from civitas.streaming.incremental import batch_writer
    tschema = TT.StructType([TT.StructField("k", TT.LongType()), TT.StructField("v", TT.StringType())])
    for v in ("x", "y"):
        T.write_version(spark.createDataFrame([(9, v)], tschema), f"{scratch}/t")
    b = spark.createDataFrame([(1, "a", 1)], "k long, v string, seq long")
    for stream in ("one", "two"):
        w = batch_writer(spark, f"{scratch}/t", tschema, "k", {"v": U.OVERWRITE}, "seq", stream_id=lambda s=stream: s)
        w(b, 0)
        w(b, 0)
    assert T.list_versions(spark, f"{scratch}/t") == [1, 2, 3, 4]
    assert [tuple(r) for r in spark.read.parquet(T.version_path(f"{scratch}/t", 1)).collect()] == [(9, "x")]
    assert sorted(tuple(r) for r in T.read_latest(spark, f"{scratch}/t").collect()) == [(1, "a"), (9, "y")]
    assert T.retire_versions(spark, f"{scratch}/t", 2) == [1, 2] and T.list_versions(spark, f"{scratch}/t") == [3, 4]
    bad = spark.createDataFrame([(None, "a", 1)], "k long, v string, seq long")
    with pytest.raises(Exception, match="NULL in key"):
        w(bad, 1)


def test_number_of_buckets_is_kept(spark, scratch):
    from pyspark.sql import types as TT
    tschema = TT.StructType([TT.StructField("k", TT.LongType()), TT.StructField("v", TT.StringType())])
    b = spark.createDataFrame([(i, "a", 1) for i in range(20)], "k long, v string, seq long")
    T.merge_into_buckets(spark, f"{scratch}/b", b, "k", {"v": U.OVERWRITE}, tschema, seq="seq", num_buckets=8)
    with pytest.raises(ValueError, match="8 buckets"):
        T.merge_into_buckets(spark, f"{scratch}/b", b, "k", {"v": U.OVERWRITE}, tschema, seq="seq", num_buckets=16)
    assert T.read_buckets(spark, f"{scratch}/b").count() == 20


def test_named_csv_with_differing_headers_and_pruned_rejects(spark, scratch):
    import os

    from civitas.sources.csv import read_csv_named, read_csv_positional
    os.makedirs(f"{scratch}/n")
    for name, text in (("1.csv", "a,b\n1,2\n"), ("2.csv", "b,a\n2,1\n"), ("3.csv", "c,a\nx,7\n")):
        with open(f"{scratch}/n/{name}", "w") as f:
            f.write(text)
    got = sorted(map(repr, (tuple(r) for r in read_csv_named(spark, f"{scratch}/n", {"a": "string", "b": "string"}).collect())))
    assert got == ["('1', '2')", "('1', '2')", "('7', None)"]
    with open(f"{scratch}/p.csv", "w") as f:
        f.write("h1,h2\n1,2\n3\n4,5,6\n7,8\n")
    good, bad = read_csv_positional(spark, f"{scratch}/p.csv", ["x", "y"], on_bad="reject", multi_line=False)
    assert sorted(r["x"] for r in good.select("x").collect()) == ["1", "7"] and good.count() == 2 and bad.count() == 2
    with pytest.raises(Exception):
        read_csv_positional(spark, f"{scratch}/p.csv", ["x", "y"], multi_line=False).select("x").collect()
