"""Surrogate ids and resume offsets (A1, A2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assign_ids(df: DataFrame, existing: DataFrame | None, id_col: str,
               order: Sequence[str], num_partitions: int | None = None,
               existing_col: str | None = None) -> DataFrame:
    """A2: dense ids ``max(existing.id) + 1, + 2, ...`` in ``order``.

    No single-partition window over the data: rows are range-partitioned and
    sorted on ``order`` (which must be a total order), each partition counts
    its rows, and a running sum over those counts (one row per partition,
    so its size is bounded by the partition count) gives every partition its
    offset. The ordered frame is checkpointed to the shared checkpoint folder
    so that the counts and the numbering see the very same partitioning even
    when a task is re-run after an executor loss.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .withColumn("__pid", F.spark_partition_id())
                 .withColumn("__mono", F.monotonically_increasing_id()))
    ordered = ordered.checkpoint(eager=True)
    # monotonically_increasing_id = partition index << 33 | row index in partition
    local = F.col("__mono") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    counts = ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    # One scalar (the current maximum id) is read back; no data rows are.
    top = existing.agg(F.max(existing_col or id_col)).first()[0] if existing is not None else None
    base: Column = F.lit(int(top) if top is not None else 0).cast("bigint")
    out = ordered.join(F.broadcast(offsets), on="__pid", how="inner")
    return (out.withColumn(id_col, (base + F.col("__off") + local + F.lit(1)).cast("bigint"))
               .drop("__pid", "__mono", "__off"))


def resume_offset(status: DataFrame | None, target: DataFrame, job: str,
                  page: int = 1000, job_col: str = "job_name",
                  offset_col: str = "last_offset") -> DataFrame:
    """A1: one-row frame ``offset``: persisted offset for ``job`` if any, else
    the target's row count cut down to whole pages."""
    counted = target.agg(
        (F.floor(F.count(F.lit(1)) / F.lit(page)) * F.lit(page)).cast("bigint").alias("offset"),
    ).select(F.lit(1).alias("__prio"), "offset")
    if status is None:
        return counted.select("offset")
    # job_name is the status table's key: at most one persisted row.
    persisted = (status.filter((F.col(job_col) == F.lit(job)) & F.col(offset_col).isNotNull())
                 .select(F.lit(0).alias("__prio"), F.col(offset_col).cast("bigint").alias("offset")))
    return persisted.unionByName(counted).agg(F.min_by("offset", "__prio").alias("offset"))
