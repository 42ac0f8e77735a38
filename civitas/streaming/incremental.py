"""Incremental keyed load with a persisted offset.

Landed pages arrive as files in a landing folder. A Structured Streaming
file source tracks which files were consumed in its checkpoint (the
persisted offset); each micro-batch is folded and upserted into the newest
version of the target (``foreachBatch``) and becomes the next version. A
version carries the identity of the batch that wrote it (stream and batch
id), so a batch replayed after a failure is recognised and not applied
again, and no version is ever overwritten: the target may hold data before
the stream starts, and a stream with a new checkpoint goes on from there.
The ``sync_status``-like progress row and the job's counters are part of the
version they belong to: one rename makes rows, offset and counters visible
together, and a replayed batch counts once.
``trigger(availableNow=True)`` drains what has landed and stops, which is
the reference's "stop on a short or empty page".
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civitas.operators.upsert import Rule, upsert
from civitas.schemas import SYNC_STATUS
from civitas.sources.tables import commit_run, merge_into_buckets, read_latest, read_progress, version_of_batch, write_batch_version


def incremental_upsert(spark: SparkSession, landing: str, landing_schema: T.StructType | str,
                       target: str, target_schema: T.StructType | str, checkpoint: str,
                       key: str | list[str], rules: Mapping[str, Rule], seq: str,
                       prepare: Callable[[DataFrame], DataFrame] | None = None,
                       status_path: str | None = None, job: str = "incremental",
                       fmt: str = "json", max_files_per_trigger: int | None = None,
                       num_buckets: int | None = None) -> None:
    """Drain ``landing`` into the versioned table at ``target``.

    ``prepare`` turns landed rows into batch rows (e.g. explode pages);
    it must produce the key, the rule columns and ``seq``. Runs until all
    landed files are consumed, then returns.

    With ``num_buckets`` the target is one Parquet table partitioned by key
    bucket and each micro-batch rewrites only the buckets it touches
    (:func:`civitas.sources.tables.merge_into_buckets`) -- the mode for a
    large table fed small batches; the number of buckets is stored with the
    table; rows and progress are two commits there. Without it every batch writes a full new version
    (:func:`civitas.sources.tables.retire_versions` drops old ones). Rows with a
    NULL key part match nothing and would come in again with every replay:
    they are refused (:func:`batch_writer`).
    """
    schema = landing_schema if isinstance(landing_schema, T.StructType) else \
        T._parse_datatype_string(landing_schema)
    tschema = target_schema if isinstance(target_schema, T.StructType) else \
        T._parse_datatype_string(target_schema)
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing)

    apply = batch_writer(spark, target, tschema, key, rules, seq, prepare, status_path, job, num_buckets,
                         stream_id=lambda: stream_identity(spark, checkpoint))
    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id Structured Streaming stored in the checkpoint: another one for every new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def batch_writer(spark: SparkSession, target: str, tschema: T.StructType, key: str | list[str],
                 rules: Mapping[str, Rule], seq: str, prepare: Callable[[DataFrame], DataFrame] | None = None,
                 status_path: str | None = None, job: str = "incremental", num_buckets: int | None = None,
                 stream_id: Callable[[], str] = lambda: "stream"):
    """The ``foreachBatch`` function of :func:`incremental_upsert`.

    Re-running it with the same ``(batch, batch_id)`` -- what Structured
    Streaming does after a failure between writing and committing a batch --
    leaves the table and the status row as one run would. A row with a NULL
    key part fails the batch.
    """
    keys = [key] if isinstance(key, str) else list(key)
    status_schema = T._parse_datatype_string(SYNC_STATUS)

    def advanced(prev: DataFrame, rows: DataFrame) -> DataFrame:
        """Progress after the batch: the job's offset plus the rows it consumed; other jobs' rows stay."""
        consumed = rows.agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        base = prev.filter(F.col("job_name") == job).select(F.col("last_offset").alias("n"))
        row = base.unionByName(consumed).agg(F.sum("n").cast("bigint").alias("last_offset")).select(
            F.lit(job).alias("job_name"), "last_offset", F.localtimestamp().alias("last_updated"))
        return prev.filter(F.col("job_name") != job).unionByName(row)

    def apply(batch: DataFrame, batch_id: int) -> None:
        me = f"{stream_id()}-{batch_id}"
        rows = prepare(batch) if prepare else batch
        rows = rows.withColumns({k: F.coalesce(F.col(k), F.raise_error(F.lit(f"NULL in key column {k}")).cast(rows.schema[k].dataType))
                                 for k in keys})
        if num_buckets:
            merge_into_buckets(spark, target, rows, key, dict(rules), tschema, seq=seq, num_buckets=num_buckets)
            if status_path and version_of_batch(spark, status_path, me) is None:
                write_batch_version(advanced(read_latest(spark, status_path, status_schema), rows), status_path, me)
            return
        if version_of_batch(spark, target, me) is None:
            merged = upsert(read_latest(spark, target, tschema), rows, key, rules, seq=seq)
            commit_run(merged, target, me, job, read=rows, progress=advanced(read_progress(spark, target, status_schema), rows))
        if status_path and version_of_batch(spark, status_path, me) is None:    # a copy of what is committed
            write_batch_version(read_progress(spark, target, status_schema), status_path, me)

    return apply
