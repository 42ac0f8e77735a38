"""Plan shape checks: the properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

from civitas.operators import audit as K
from civitas.operators import dedupe as W
from civitas.operators import responses as R
from civitas.operators import upsert as U
from civitas.plans import views as V


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan(df)))


def hot_frame(spark, n=30000):
    """One key holds a third of all rows."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"), (F.col("id") % 97).cast("double").alias("v"))


def test_fold_is_partial_before_shuffle(spark):
    f = W.fold_batch(hot_frame(spark), "k", "seq", last_cols=["v"])
    p = plan(f)
    assert "partial_max_by" in p and exchanges(f) == 1
    assert "HashAggregate" in p                       # numeric values: no sort-based aggregate
    got = {r["k"]: r["v"] for r in f.collect()}
    assert got[0] == float(29997 % 97)                # the hot key folds to its last row


def test_audit_unique_partial(spark):
    a = K.audit_unique(hot_frame(spark), "k")
    assert "partial_count" in plan(a)
    assert [(r["k"], r["n"]) for r in a.collect()] == [(0, 10000)]


def test_top_n_cut_before_shuffle(spark):
    d = W.distinct_on(hot_frame(spark), "k", [F.col("v").desc(), F.col("seq").desc()])
    p = plan(d)
    assert p.count("WindowGroupLimit") >= 2           # partial (map side) and final
    assert d.filter("k = 0").count() == 1


def test_upsert_joins_unique_sides_once(spark):
    target = spark.range(1000).select(F.col("id").alias("k"), F.lit(1.0).alias("v"))
    out = U.upsert(target, hot_frame(spark), "k", {"v": U.OVERWRITE}, seq="seq")
    assert exchanges(out) <= 3                        # fold + two join sides
    assert out.filter("k = 0").count() == 1


def test_enrichment_attempts_one_aggregation(spark):
    resp = spark.createDataFrame([(1, "by_year", 1, 200, '{"status": true}')],
                                 "school_id int, endpoint string, attempt int, http_status int, body string")
    w = R.resolve_attempts_wide(resp, "school_id", ["by_year", "probe", "report_card"])
    assert exchanges(w) == 1


def test_views_prune_columns_and_push_gate(spark, scratch):
    raw = spark.createDataFrame([("s", "d", "sd", "v") + tuple(str(i) for i in range(8)) + ("x", "y")],
                                ", ".join(f"`{c}` string" for c in [*V.AMENITY_VIEW_COLUMNS, "unused_1", "unused_2"]))
    raw.write.parquet(f"{scratch}/raw")
    view = V.view_village_amenities(spark.read.parquet(f"{scratch}/raw"))
    scan = plan(view)
    assert "unused_1" not in scan and "unused_2" not in scan
    schools = spark.createDataFrame([("c", "n", "S", None)], "udise_code string, school_name string, "
                                    "state_name string, facility_data string")
    schools.write.parquet(f"{scratch}/schools")
    v4 = V.view_digital_infrastructure(spark.read.parquet(f"{scratch}/schools"))
    assert "IsNotNull(state_name)" in plan(v4)


def test_best_match_ranks_detail_before_join(spark):
    from civitas.operators.joins import best_match_left
    master = spark.range(5).select(F.col("id").alias("code"))
    detail = hot_frame(spark).select(F.col("k").alias("code"), "v", "seq")
    out = best_match_left(master, detail, "code", "code", [F.col("v").desc_nulls_last(), F.col("seq").asc()])
    p = plan(out)
    join_at = min(i for i in (p.find("SortMergeJoin"), p.find("BroadcastHashJoin")) if i >= 0)
    assert p.find("WindowGroupLimit", join_at) > join_at  # the detail is cut to rank 1 below the join
    got = {r["code"]: (r["v"], r["seq"]) for r in out.collect()}
    assert got[0] == (96.0, 96) and got[1] == (1.0, 1) and got[3] == (None, None) and len(got) == 5


# Global aggregates, final limits and A2's per-partition offset window (one
# row per partition) are the only places a single partition is expected.
SINGLE_PARTITION_OK = {"A1_resume_offset", "J4_cascade_tree", "A1_resume_offset_persisted", "A2_assign_ids", "W4_work_queue",
                       "W5_recovery_queue", "W6_priority_queue"}
WRITES = ("S1_", "S2_", "S3_", "S6_", "S7_", "S8_", "G1_", "G3_", "G7_", "G9_", "A6_", "U1_upsert_buckets")


def test_no_single_partition_exchange_outside_allowlist(spark):
    import __spark_entry__ as E
    from civitas.plans.registry_queries import QUERIES
    offenders = []
    for name, fn in E.queries().items():
        if name not in QUERIES:
            continue
        if name.startswith(WRITES) or name in SINGLE_PARTITION_OK:
            continue
        p = plan(fn(spark, "/root/testdata/sf0.001"))
        if "SinglePartition" in p:
            offenders.append(name)
    assert offenders == []


def test_work_queue_prunes_state_partitions(spark, scratch):
    from civitas.operators.dedupe import work_queue
    from civitas.sources import tables as T
    df = spark.createDataFrame([(i, "GOA" if i % 2 else "KERALA", "pending", f"c{i:04d}", None) for i in range(50)],
                               "school_id long, state_name string, scrape_status string, udise_code string, "
                               "effective_year int")
    path = T.write_version(df, f"{scratch}/schools", partition_by=["state_name"], sort_by=["udise_code"])
    q = work_queue(spark.read.parquet(path), "GOA", "normal", 10)
    p = plan(q)
    assert "PartitionFilters: [isnotnull(state_name" in p and "(state_name#" in p
    assert [r["school_id"] for r in q.collect()] == list(range(1, 20, 2))


def test_hot_join_key_is_split_by_aqe(spark):
    """A parent key holding a third of the child rows: AQE's skew join splits
    its partition (thresholds shrunk so the small test data counts as skewed)."""
    from civitas.operators.joins import expand_hierarchy
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        parents = spark.range(100).select(F.col("id").alias("p"), (F.col("id") * 10).alias("pv"))
        children = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100).alias("p"), F.col("id").alias("c"))
        out = expand_hierarchy([(parents, None, "p"), (children, "p", "c")])
        assert len(out.collect()) == 30000
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
