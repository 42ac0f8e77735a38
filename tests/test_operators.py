"""Operators on small frames: upsert rules and properties, folding, top-n, ids, responses, audits."""

import pytest
from pyspark.sql import functions as F

from civitas.operators import audit as K
from civitas.operators import dedupe as W
from civitas.operators import ids as A
from civitas.operators import joins as JN
from civitas.operators import responses as R
from civitas.operators import upsert as U


def _key(r):
    return tuple((v is None, v) for v in r)


def srt(items):
    return sorted(items, key=_key)


def rows(df, *cols):
    return srt(tuple(r) for r in df.select(*cols).collect())


TARGET = [(1, "old1", "p1", "success", None), (2, "old2", "p2", "pending", 11)]
TDDL = "k int, name string, parent string, status string, eff int"


def test_upsert_rules_and_folding(spark):
    target = spark.createDataFrame(TARGET, TDDL)
    batch = spark.createDataFrame([
        (1, "new1", "q1", "pending", 12, 1), (2, "a", "q2", "pending", 12, 2), (2, "b", "q3", "pending", 13, 3),
        (3, "c", "q4", "pending", None, 4), (3, "d", "q5", "success", 14, 5), (3, "e", "q6", "pending", 15, 6),
        (None, "z", "q7", "pending", 1, 7)], TDDL + ", seq int")
    rules = {"name": U.OVERWRITE, "parent": U.KEEP, "status": U.sticky("success"), "eff": U.FILL}
    out = U.upsert(target, batch, "k", rules, seq="seq")
    assert out.columns == target.columns
    assert rows(out, "k", "name", "parent", "status", "eff") == srt([
        (1, "new1", "p1", "success", 12),      # sticky success, fill old NULL
        (2, "b", "p2", "pending", 11),         # last name, parent kept, eff kept
        (3, "e", "q4", "success", 14),         # insert: first parent, ever-success, first non-null eff
        (None, "z", "q7", "pending", 1),       # NULL key never matches: inserted as is
    ])


def test_upsert_twice_equals_once_and_split_batches(spark):
    target = spark.createDataFrame(TARGET, TDDL)
    batch = spark.createDataFrame([(1, "x", "q", "pending", 5, 1), (4, "y", "q", "pending", 6, 2),
                                   (4, "w", "r", "pending", 7, 3)], TDDL + ", seq int")
    rules = {"name": U.OVERWRITE, "status": U.sticky("success"), "eff": U.FILL}
    once = U.upsert(target, batch, "k", rules, seq="seq")
    twice = U.upsert(once, batch, "k", rules, seq="seq")
    assert rows(once, *target.columns) == rows(twice, *target.columns)
    first = U.upsert(target, batch.filter("seq <= 2"), "k", rules, seq="seq")
    split = U.upsert(first, batch.filter("seq > 2"), "k", rules, seq="seq")
    assert rows(split, *target.columns) == rows(once, *target.columns)


def test_update_from_touches_all_matches_no_insert(spark):
    target = spark.createDataFrame([(1, 12, "a"), (1, 11, "b"), (2, 12, "c")], "k int, year int, v string")
    changes = spark.createDataFrame([(1, "new"), (9, "nope")], "k int, v string")
    out = U.update_from(target, changes, "k", ["v"])
    assert rows(out, "k", "year", "v") == [(1, 11, "new"), (1, 12, "new"), (2, 12, "c")]


def test_insert_absent_multiple_keys(spark):
    target = spark.createDataFrame([(1, "Education", "D1")], "id int, name string, darpan string")
    batch = spark.createDataFrame([(None, "Education", "D9", 1), (None, "Health", "D1", 2), (None, "WASH", "D7", 3),
                                   (None, "WASH", "D8", 4)], "id int, name string, darpan string, seq int")
    out = U.insert_absent(target, batch, ["name", "darpan"], seq="seq")
    assert rows(out, "name", "darpan") == [("Education", "D1"), ("WASH", "D7")]


def test_split_rejects(spark):
    df = spark.createDataFrame([(1, "ok"), (None, "toolongvalue"), (3, None)], "k int, s string")
    good, bad = U.split_rejects(df, {"key_null": F.col("k").isNull(), "length": F.length("s") > 5})
    assert rows(good, "k") == [(1,), (3,)]
    assert rows(bad, "reasons") == [("key_null,length",)]


def test_fold_batch_null_keys_not_folded(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 3), (None, "d", 4)], "k int, v string, s int")
    out = W.fold_batch(df, "k", "s", last_cols=["v"])
    assert rows(out, "k", "v") == srt([(1, "b"), (None, "c"), (None, "d")])


def test_distinct_on_keeps_all_null_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 6), (2, 10, 1), (2, 20, 2), (2, None, 3)], "k int, v int, h int")
    out = W.distinct_on(df, "k", [F.col("v").desc_nulls_last(), F.col("h").desc_nulls_last()])
    assert rows(out, "k", "v", "h") == [(1, None, 6), (2, 20, 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_keep_latest_touched_groups_only(spark):
    data = [(g, v, g * 10 + v) for g in (1, 2) for v in range(1, 8)]
    df = spark.createDataFrame(data, "g int, version int, id int")
    touched = spark.createDataFrame([(1,)], "g int")
    out = W.keep_latest(df, "g", [F.col("version").desc(), F.col("id").desc()], 5, touched)
    counts = dict(rows(out.groupBy("g").count(), "g", "count"))
    assert counts == {1: 5, 2: 7}
    assert rows(out.filter("g = 1"), "version") == [(3,), (4,), (5,), (6,), (7,)]


def test_work_queues(spark):
    df = spark.createDataFrame([
        (1, "GOA", "pending", "c3", None), (2, "GOA", "partial", "c2", None), (3, "GOA", "success", "c1", None),
        (4, "GOA", "pending", "c0", 12), (5, "KERALA", "pending", "c9", None)],
        "id int, state_name string, scrape_status string, udise_code string, effective_year int")
    normal = [r[0] for r in W.work_queue(df, "GOA", "normal").collect()]
    assert normal == [4, 1, 2]  # status DESC: pending before partial, then code
    recovery = [r[0] for r in W.work_queue(df, "GOA", "recovery", limit=2).collect()]
    assert recovery == [2, 1]  # status ASC: partial, pending, success
    pq = [r[0] for r in W.priority_queue(df, ["KERALA", "GOA"], then=[F.col("id")]).collect()]
    assert pq == [5, 1, 2, 3, 4]


def test_assign_ids_dense_after_max(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    existing = spark.createDataFrame([(41,)], "id long")
    out = A.assign_ids(df, existing, "id", ["k"], num_partitions=5)
    got = rows(out, "k", "id")
    assert got == [(k, 42 + k) for k in range(1000)]


def test_resume_offset(spark):
    target = spark.range(2345)
    assert A.resume_offset(None, target, "j").first()[0] == 2000
    status = spark.createDataFrame([("j", 999), ("other", 5)], "job_name string, last_offset int")
    assert A.resume_offset(status, target, "j").first()[0] == 999
    assert A.resume_offset(status, spark.range(999), "none").first()[0] == 0


def test_resolve_attempts(spark):
    ok = '{"status": true, "data": {}}'
    df = spark.createDataFrame([
        (1, 1, 503, None), (1, 2, 200, ok),                     # 503 first -> 503
        (2, 1, 200, '{"status": "true"}'), (2, 2, 200, ok),     # bad then ok -> 200
        (3, 1, 404, None), (3, 2, 500, None), (3, 3, 200, ok),  # third attempt never happened -> 404
    ], "k int, attempt int, http_status int, body string")
    got = rows(R.resolve_attempts(df, "k", max_attempts=2), "k", "code")
    assert got == [(1, 503), (2, 200), (3, 404)]
    disc = rows(R.resolve_attempts(df, "k", max_attempts=3, outcome="http200"), "k", "code")
    assert disc == [(1, 200), (2, 200), (3, 200)]


def test_fragments_and_manifest(spark):
    df = spark.createDataFrame([(1, "report_card", "r1", 1), (1, "report_card", "r2", 2), (1, "facility", "f", 1),
                                (2, "facility", "g", 5)], "k int, endpoint string, body string, seq int")
    out = R.assemble_fragments(df, "k", ["report_card", "facility", "profile"])
    assert rows(out, "k", "report_card", "facility", "profile") == [(1, "r2", "f", None), (2, None, "g", None)]
    codes = df.withColumn("code", F.when(F.col("endpoint") == "facility", 404).otherwise(200))
    man = rows(R.build_manifest(codes, "k"), "k", "manifest")
    assert man == [(1, '{"facility":404,"report_card":200}'), (2, '{"facility":404}')]


def test_effective_year(spark):
    schools = spark.createDataFrame([(1,), (2,), (3,), (4,)], "school_id int")
    primary = spark.createDataFrame([(1, 200, None), (2, 404, None), (3, 503, None), (4, 200, 10)],
                                    "school_id int, code int, year int")
    probe = spark.createDataFrame([(2, 200), (3, 404)], "school_id int, code int")
    out = JN.resolve_effective_year(schools, primary, probe)
    assert rows(out, "school_id", "effective_year", "missing_on_server") == [
        (1, 12, False), (2, 11, False), (3, 12, True), (4, 10, False)]


def test_cascade_and_orphans(spark):
    users = spark.createDataFrame([(1,), (2,)], "uid int")
    reqs = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "rid int, uid int")
    notes = spark.createDataFrame([(100, 10), (101, 11), (102, 99)], "nid int, rid int")
    kept_reqs, kept_notes = JN.cascade_delete(users.filter("uid = 1"), "uid",
                                              [(reqs, "uid", "rid"), (notes, "rid", None)])
    assert rows(kept_reqs, "rid") == [(11,), (12,)]
    assert rows(kept_notes, "nid") == [(101,), (102,)]
    assert rows(JN.orphans(notes, reqs, "rid"), "nid") == [(102,)]


def test_audits(spark):
    df = spark.createDataFrame([(1, "draft", "abc", 1.5), (1, "bogus", "abcdef", 9.999), (None, None, None, None)],
                               "k int, status string, code string, temp double")
    assert rows(K.audit_unique(df, "k"), "k", "n") == [(1, 2)]
    assert rows(K.audit_in(df, "status", ["draft", "published"]), "status") == [("bogus",)]
    assert rows(K.audit_fits(df, "code", "varchar(5)"), "code") == [("abcdef",)]
    assert rows(K.audit_fits(df, "temp", "numeric(3,2)"), "temp") == [(9.999,)]
    assert rows(K.audit_not_null(df, ["k", "status"]), "column") == [("k",)]
    default = spark.createDataFrame([(1, True), (2, True), (3, False), (4, None)], "id int, is_default boolean")
    assert rows(K.audit_unique(default, "is_default", where=F.col("is_default")), "n") == [(2,)]
    rep = K.audit([(K.audit_in(df, "status", ["draft"]), "status")])
    assert rep.columns == ["rule", "detail"] and rep.count() == 1


def test_audit_fixture_edges(spark):
    from civitas.schemas import PROPOSAL_STATUSES
    df = spark.createDataFrame([(1, "draft", 9.995), (2, "published", 9.99), (3, "deleted", -1.0), (4, None, None)],
                               "id int, status string, temperature double")
    assert rows(K.audit_in(df, "status", PROPOSAL_STATUSES), "id") == [(3,)]      # NULL passes
    assert rows(K.audit_fits(df, "temperature", "numeric(3,2)"), "id") == [(1,)]  # 9.995 rounds to 10.00


def test_split_rejects_checkpointed(spark):
    df = spark.createDataFrame([(1, "ok"), (None, "x")], "k int, s string")
    good, bad = U.split_rejects(df, {"key_null": F.col("k").isNull()}, checkpoint=True)
    assert "ExistingRDD" in good._jdf.queryExecution().executedPlan().toString()
    assert rows(good, "k") == [(1,)] and rows(bad, "reasons") == [("key_null",)]


def test_insert_absent_with_nullable_keys(spark):
    target = spark.createDataFrame([("u1", "e1")], "userid string, email string")
    batch = spark.createDataFrame([("u1", "e2", 1), ("u2", "e2", 2), ("u2", "e3", 3), (None, "e4", 4), (None, "e4", 5), (None, None, 6),
                                   (None, None, 7), ("u3", "e3", 8), ("u3", None, 9)], "userid string, email string, seq int")
    got = rows(U.insert_absent(target, batch, ["userid", "email"], seq="seq"), "userid", "email")
    # row after row: u1 clashes, (u2,e2) enters, (u2,e3) does not, one e4, both all-NULL rows, (u3,e3) enters
    assert sorted(map(repr, got)) == sorted(map(repr, [
        ("u1", "e1"), ("u2", "e2"), (None, "e4"), (None, None), (None, None), ("u3", "e3")]))
    one = rows(U.insert_absent(target, batch.drop("seq"), ["email"]), "email")
    assert sorted(map(repr, one)) == sorted(map(repr, [("e1",), ("e2",), ("e3",), ("e4",), (None,), (None,), (None,)]))


def test_updates_read_the_old_row_and_repeated_changes_fail(spark):
    df = spark.createDataFrame([("y", 0)], "status string, flag int")
    got = U.update_where(df, F.col("status") == "y", {"status": F.lit("x"), "flag": F.lit(1)}).first()
    assert tuple(got) == ("x", 1)
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="repeated key"):
        U.update_from(t, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), "k", ["v"]).collect()
    got = rows(U.update_from(t, spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, v string, s int"), "k", ["v"], seq="s"), "k", "v")
    assert got == [(1, "y"), (1, "y"), (2, "c")]


def test_null_keys_of_both_sides_survive(spark):
    t = spark.createDataFrame([(None, "t")] * 3 + [(1, "a")], "k int, v string")
    b = spark.createDataFrame([(None, "b", 1), (None, "b", 2), (1, "z", 3)], "k int, v string, s int")
    got = sorted(map(repr, rows(U.upsert(t, b, "k", {"v": U.OVERWRITE}, seq="s"), "k", "v")))
    assert got == sorted(map(repr, [(None, "t")] * 3 + [(None, "b")] * 2 + [(1, "z")]))


def test_attempt_rounds_and_unreadable_bodies(spark):
    ok = lambda n: '{"status": true, "data": {"n": %d}}' % n
    df = spark.createDataFrame([(1, 1, 0, 200, ok(1)), (1, 1, 1, 200, "not json"), (1, 2, 1, 200, ok(2)), (2, 1, 0, 200, "not json"),
                                (3, 1, 0, 200, ok(3)), (3, 1, 1, 404, None)], "k int, attempt int, seq long, http_status int, body string")
    for outcome in ("valid", "http200"):
        got = rows(R.resolve_attempts(df, "k", outcome=outcome), "k", "code", "body")
        assert got == [(1, 200, ok(2)), (2, 404, None), (3, 404, None)]


def test_cascade_over_a_tree(spark):
    a = spark.createDataFrame([(1,), (2,)], "id int")
    b = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "id int, a int")
    c = spark.createDataFrame([(20, 1), (21, 2)], "id int, a int")
    e = spark.createDataFrame([(30, 10, 21), (31, 11, 20), (32, 11, 21), (33, None, 21)], "id int, b int, c int")
    links = [("b", "a", "a", "id"), ("c", "a", "a", "id"), ("e", "b", "b", "id"), ("e", "c", "c", "id")]
    kept = JN.cascade_tree({"a": a, "b": b, "c": c, "e": e}, links, "a", spark.createDataFrame([(1,)], "id int"), "id")
    assert {n: sorted(r["id"] for r in df.collect()) for n, df in kept.items()} == {"a": [2], "b": [11, 12], "c": [21], "e": [32, 33]}


def test_null_seq_is_refused(spark):
    """A NULL seq has no place in the order: an error, no lost value and no endless loop."""
    rows = spark.createDataFrame([("k", None, "a"), (None, None, "b")], "k string, seq int, v string")
    with pytest.raises(Exception, match="NULL in seq"):
        W.fold_batch(rows, "k", "seq", last_cols=["v"]).collect()
    two = spark.createDataFrame([(None, None, None), (None, None, None)], "a string, b string, seq int")
    target = spark.createDataFrame([], "a string, b string")
    with pytest.raises(ValueError, match="seq"):
        U.insert_absent(target, two, ["a", "b"], seq="seq")
    with pytest.raises(ValueError, match="seq"):
        U.insert_absent(target, spark.createDataFrame([("x", "y", 1), ("z", "w", 1)], "a string, b string, seq int"), ["a", "b"], seq="seq")


def test_upsert_beside_maps_and_null_keys(spark):
    """A MAP column cannot be hashed: rows with a NULL key part still come through, each by itself."""
    schema = "k string, m map<string,int>, v string"
    target = spark.createDataFrame([("a", {"x": 1}, "old"), (None, {"x": 2}, "n1"), (None, None, "n2")], schema)
    batch = spark.createDataFrame([("a", {"y": 1}, "new", 1), (None, {"z": 3}, "n3", 2), (None, {"z": 3}, "n4", 2)], schema + ", seq int")
    out = U.upsert(target, batch, "k", {"v": U.OVERWRITE}, seq="seq")
    assert sorted((r["k"] or "", r["v"]) for r in out.collect()) == [("", "n1"), ("", "n2"), ("", "n3"), ("", "n4"), ("a", "new")]


def test_audit_tables_reads_a_table_once(spark, scratch):
    """All row rules of a table in one scan, all its unique keys in another; the report equals the single audits'."""
    rows = [(i, None if i % 5 == 0 else f"n{i % 7}", "abc" * (i % 4), i % 3) for i in range(60)]
    spark.createDataFrame(rows, "id int, name string, code string, kind int").write.parquet(scratch)
    df = spark.read.parquet(scratch)
    rules = K.RuleSet(not_null=(("t", ("name", "id")),), unique=(("t", ("name", "kind"), None), ("t", ("code",), "kind = 1")),
                      allowed=(("t", "kind", (0, 1)),), types=(("t", "code", "varchar(5)"),))
    report = K.audit_tables({"t": df}, rules)
    single = K.audit([(K.audit_not_null(df, ["name"]).drop("column"), "not_null:t.name"), (K.audit_in(df, "kind", (0, 1)), "allowed:t.kind"),
                      (K.audit_fits(df, "code", "varchar(5)"), "type:t.code"), (K.audit_unique(df, ("name", "kind")), "unique:t.name+kind"),
                      (K.audit_unique(df, "code", F.expr("kind = 1")), "unique:t.code")])
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, single.collect()))
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


def greedy(rows, held=((), ())):
    """(a, b, seq) rows in seq order; what goes in under two unique keys."""
    a_held, b_held, out = set(held[0]), set(held[1]), []
    for a, b, seq in sorted(rows, key=lambda r: r[2]):
        if (a is None or a not in a_held) and (b is None or b not in b_held):
            a_held.add(a)
            b_held.add(b)
            out.append(seq)
    return out


@pytest.mark.parametrize("group_rows", [200_000, 3])
def test_insert_absent_by_components(spark, monkeypatch, group_rows):
    import random
    monkeypatch.setattr(U, "GROUP_ROWS", group_rows)
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(60)]), s) for s in rng.sample(range(1000), 120)]
    rows += [(7, None, 1000 + i) for i in range(60)]        # a hot key
    target = spark.createDataFrame([(1, 1, -1), (None, 2, -2)], "a int, b int, seq int")
    out = U.insert_absent(target, spark.createDataFrame(rows, "a int, b int, seq int"), ["a", "b"], seq="seq")
    assert sorted(r["seq"] for r in out.collect()) == sorted([-1, -2, *greedy(rows, ((1,), (1, 2)))])


def test_insert_absent_on_a_long_chain(spark, monkeypatch):
    """10,000 rows, each sharing one key with the row before and the other with the next: few rounds, whatever its length."""
    rows = [((s + 1) // 2, s // 2, s) for s in range(10_000)]
    stored, tables = U._stored, []
    monkeypatch.setattr(U, "_stored", lambda df: tables.append(1) or stored(df))
    out = U.insert_absent(spark.createDataFrame([], "a int, b int, seq int"), spark.createDataFrame(rows, "a int, b int, seq int"), ["a", "b"], seq="seq")
    assert sorted(r["seq"] for r in out.collect()) == greedy(rows)
    assert len(tables) < 60


def test_insert_absent_without_crossing_keys_needs_no_components(spark, monkeypatch):
    """Rows whose keys repeat at one of them only: whoever comes first goes in, and no components are sought."""
    monkeypatch.setattr(U, "connected", lambda member: pytest.fail("components sought"))
    rows = [(i % 30 if i % 4 else None, i, i) for i in range(200)]
    target = spark.createDataFrame([(5, 7, -1)], "a int, b int, seq int")
    out = U.insert_absent(target, spark.createDataFrame(rows, "a int, b int, seq int"), ["a", "b"], seq="seq")
    assert sorted(r["seq"] for r in out.collect()) == sorted([-1, *greedy(rows, ((5,), (7,)))])


def test_insert_absent_settles_many_components(spark):
    """A thousand small components whose firsts wait for others: the same rows as row after row."""
    rows = [x for g in range(0, 6000, 6) for x in [(g, g, g), (g, g + 1, g + 1), (g + 1, g + 1, g + 2), (g + 2, g + 1, g + 3), (g + 2, g + 3, g + 4)]]
    out = U.insert_absent(spark.createDataFrame([], "a int, b int, seq int"), spark.createDataFrame(rows, "a int, b int, seq int"), ["a", "b"], seq="seq")
    assert sorted(r["seq"] for r in out.collect()) == greedy(rows)
