"""Parquet tables: append, versioned rewrites, rotation, evolution.

An upsert never overwrites the table it reads. Each rewrite goes to a new
version folder ``<base>/v<NNNNNNNNN>`` and becomes visible once its
``_SUCCESS`` marker exists; readers take the newest complete version. A
failed or repeated job leaves older versions intact, so a re-run is safe.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERSION = re.compile(r"^v(\d{9})$")
_BATCH = "_batch-"          # marker inside a version folder: the stream batch that wrote it
_PROGRESS = "_progress"     # folder inside a version: the offsets it was committed with
_COUNTERS = "_counters"     # folder inside a version: the counters of all runs committed up to it
_BUCKETS = "_num_buckets-"  # marker inside a bucketed table: its number of buckets

RUN_COUNTERS = "job_name string, runs bigint, rows_read bigint, rows_rejected bigint, rows_added bigint"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def list_versions(spark: SparkSession, base: str) -> list[int]:
    """Complete versions under ``base`` (those with ``_SUCCESS``), ascending."""
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _VERSION.match(st.getPath().getName())
        if m and st.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def version_path(base: str, n: int) -> str:
    return f"{base.rstrip('/')}/v{n:09d}"


def latest_version_path(spark: SparkSession, base: str) -> str | None:
    vs = list_versions(spark, base)
    return version_path(base, vs[-1]) if vs else None


def read_latest(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame:
    """Newest complete version; an empty frame of ``schema`` when there is none."""
    p = latest_version_path(spark, base)
    if p is None:
        if schema is None:
            raise FileNotFoundError(f"no complete version under {base}")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(p)


def read_as_of(spark: SparkSession, base: str, version: int,
               schema: T.StructType | None = None) -> DataFrame:
    """The newest complete version numbered ``<= version`` (time travel)."""
    vs = [v for v in list_versions(spark, base) if v <= version]
    if not vs:
        if schema is None:
            raise FileNotFoundError(f"no complete version <= {version} under {base}")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(version_path(base, vs[-1]))


def write_version(df: DataFrame, base: str, version: int | None = None,
                  partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> str:
    """Write ``df`` as a new version (next number unless given) and return its path.

    Giving ``version`` explicitly (e.g. a stream's batch id) makes a replay
    rewrite the same folder, which keeps the write idempotent.
    ``partition_by`` lays the files out for partition pruning (the school
    table by ``state_name``: the work queues filter on it) and ``sort_by``
    sorts rows inside each task's files (e.g. by ``udise_code``) so Parquet
    min/max statistics skip row groups for point lookups.
    """
    spark = df.sparkSession
    if version is None:
        vs = list_versions(spark, base)
        version = (vs[-1] + 1) if vs else 1
    path = version_path(base, version)
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def version_of_batch(spark: SparkSession, base: str, batch: str) -> int | None:
    """The complete version that the stream batch ``batch`` (an id) wrote, if any."""
    fs, _, jvm = _fs(spark, base)
    for v in reversed(list_versions(spark, base)):
        if fs.exists(jvm.org.apache.hadoop.fs.Path(version_path(base, v), _BATCH + batch)):
            return v
    return None


def write_batch_version(df: DataFrame, base: str, batch: str, progress: DataFrame | None = None,
                        counters: Callable[[int], DataFrame] | None = None) -> int:
    """Write ``df`` as the next version, made by the batch ``batch``, with the progress and counters that go with it.

    Files, progress, counters (of the number of rows written) and the batch's
    marker are written to a staging folder that is renamed into place: rows,
    offset and counters appear together, whole and marked, or not at all, and
    no existing version is touched. Needs a store that renames folders.
    """
    spark = df.sparkSession
    vs = list_versions(spark, base)
    n = (vs[-1] + 1) if vs else 1
    staging = f"{base.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    df.write.parquet(staging)
    fs, _, jvm = _fs(spark, base)
    fs.create(jvm.org.apache.hadoop.fs.Path(staging, _BATCH + batch)).close()
    if progress is not None:
        progress.write.parquet(f"{staging}/{_PROGRESS}")
    if counters is not None:
        counters(spark.read.schema(df.schema).parquet(staging).count()).write.parquet(f"{staging}/{_COUNTERS}")
    _publish(spark, staging, version_path(base, n))
    return n


def _publish(spark: SparkSession, staging: str, path: str) -> None:
    fs, _, jvm = _fs(spark, path)
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), jvm.org.apache.hadoop.fs.Path(path)):
        raise RuntimeError(f"could not move {staging} to {path}")


def read_progress(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The progress rows of the newest version that holds some; readers of the table do not see them."""
    return _newest_with(spark, base, _PROGRESS, schema)


def read_counters(spark: SparkSession, base: str) -> DataFrame:
    """The counters committed with the table at ``base``, one row per job (see :func:`commit_run`)."""
    return _newest_with(spark, base, _COUNTERS, T._parse_datatype_string(RUN_COUNTERS))


def _newest_with(spark: SparkSession, base: str, folder: str, schema: T.StructType) -> DataFrame:
    fs, _, jvm = _fs(spark, base)
    for v in reversed(list_versions(spark, base)):
        path = f"{version_path(base, v)}/{folder}"
        if fs.exists(jvm.org.apache.hadoop.fs.Path(path)):
            return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def commit_run(table: DataFrame, base: str, run: str, job: str, read: DataFrame | int = 0,
               rejects: DataFrame | int = 0, progress: DataFrame | None = None) -> bool:
    """Commit ``table`` as the next version together with the job's counters, once per run -> committed now?

    ``read`` and ``rejects`` are the rows the run read and rejected (a stored
    frame, or its number of rows). A job's counters add up over its runs:
    ``runs, rows_read, rows_rejected, rows_added`` (rows of the new version less
    those of the one before, counted in the files themselves). A run that is
    committed already changes neither table nor counters; one that fails before
    the rename leaves none of both; a task that Spark repeats counts once, as
    nothing is counted while rows are written. Other jobs' rows are kept.
    """
    spark = table.sparkSession
    if version_of_batch(spark, base, run) is not None:
        return False
    before, old = latest_version_path(spark, base), read_counters(spark, base)

    def rows(x: DataFrame | int) -> int:
        return x if isinstance(x, int) else x.count()

    def counters(written: int) -> DataFrame:
        added = written - (spark.read.schema(table.schema).parquet(before).count() if before else 0)
        now = spark.createDataFrame([(job, 1, rows(read), rows(rejects), added)], old.schema)
        return old.unionByName(now).groupBy("job_name").agg(*[F.sum(c).alias(c) for c in old.columns[1:]])

    write_batch_version(table, base, run, progress, counters)
    return True


def retire_versions(spark: SparkSession, base: str, keep: int) -> list[int]:
    """Delete all complete versions but the newest ``keep`` (at least one); returns the deleted numbers."""
    fs, _, jvm = _fs(spark, base)
    old = list_versions(spark, base)[:-max(1, keep)]
    for v in old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(version_path(base, v)), True)
    return old


def append_table(df: DataFrame, path: str) -> None:
    """Append without de-duplication (a re-run duplicates the rows)."""
    df.write.mode("append").parquet(path)


def rotate_table(spark: SparkSession, base: str, backup_base: str,
                 new_schema: T.StructType) -> str:
    """Keep the current table as a backup, start a fresh empty one.

    An empty version with ``new_schema`` is written on top of ``base``
    first (readers switch to it at once), then the previous newest version
    folder is renamed into ``backup_base`` as its next version -- a metadata
    operation on HDFS-like stores, not a copy of the data. Where the store
    cannot rename, the data is copied instead.
    """
    cur = list_versions(spark, base)
    fresh = write_version(spark.createDataFrame([], new_schema), base)
    if cur:
        src = version_path(base, cur[-1])
        backups = list_versions(spark, backup_base)
        dst = version_path(backup_base, (backups[-1] + 1) if backups else 1)
        fs, _, jvm = _fs(spark, src)
        Path = jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(Path(backup_base))
        if not fs.rename(Path(src), Path(dst)):
            spark.read.parquet(src).write.mode("overwrite").parquet(dst)
    return fresh


def union_with_defaults(old: DataFrame, new: DataFrame, defaults: dict | None = None) -> DataFrame:
    """S9 across versions: rows written before a column existed read with
    its declared default (``ADD COLUMN ... DEFAULT``), not NULL.

    ``unionByName(allowMissingColumns=True)`` aligns the schemas; columns
    absent from ``old`` take ``defaults[name]`` for old rows only.
    """
    defaults = defaults or {}
    missing = [c for c in new.columns if c not in old.columns]
    dtypes = dict(new.dtypes)
    staged = old.withColumns({c: (defaults[c] if isinstance(defaults.get(c), Column)
                                  else F.lit(defaults.get(c))).cast(dtypes[c]) for c in missing})
    return staged.unionByName(new, allowMissingColumns=True)


def ensure_column(df: DataFrame, name: str, dtype: str, default=None) -> DataFrame:
    """``ADD COLUMN IF NOT EXISTS name dtype DEFAULT default``.

    Existing rows get the default; an existing column is left as is.
    """
    if name in df.columns:
        return df
    value = default if isinstance(default, Column) else F.lit(default)
    return df.withColumn(name, value.cast(dtype))


# ------------------------------------------------------- bucketed merge

BUCKET_COL = "_bucket"


def bucket_of(keys: list[str], num_buckets: int, schema: T.StructType | None = None) -> Column:
    """Stable bucket of a key: ``pmod(xxhash64(keys), num_buckets)``.

    The hash depends on the value's type (an INT and a BIGINT 7 hash
    differently), so with ``schema`` the keys are first cast to the table's
    key types: a batch keyed by INT then finds the rows of a BIGINT table.
    """
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    cols = [F.col(k).cast(types[k]) if k in types else F.col(k) for k in keys]
    return F.pmod(F.xxhash64(*cols), F.lit(num_buckets)).cast("int")


def apply_to_buckets(spark: SparkSession, path: str, touched_keys: DataFrame, key: str | list[str],
                     fn, schema: T.StructType, num_buckets: int = 256) -> list[int]:
    """Rewrite only the key buckets that ``touched_keys`` hit, as ``fn(current)``.

    ``fn`` receives the rows of the touched buckets (with the bucket column)
    and returns the new rows for exactly those buckets (same columns; build
    the bucket column with ``bucket_of(keys, num_buckets, schema)``). The
    touched bucket ids (at most ``num_buckets`` small ints) are read back to
    prune the scan; the result is checkpointed to the shared checkpoint
    folder (cutting the lineage to the files about to be replaced) and
    written with dynamic partition overwrite, so untouched buckets are
    never read or rewritten. Returns the touched bucket ids.
    """
    keys = [key] if isinstance(key, str) else list(key)
    touched = sorted(r[0] for r in touched_keys.select(bucket_of(keys, num_buckets, schema).alias("b"))
                     .distinct().collect())
    if not touched:
        return []
    full = T.StructType([*schema.fields, T.StructField(BUCKET_COL, T.IntegerType())])
    fs, p, jvm = _fs(spark, path)
    check_buckets(spark, path, num_buckets)
    if any(st.isDirectory() for st in fs.listStatus(p)):
        current = spark.read.schema(full).parquet(path).filter(F.col(BUCKET_COL).isin(touched))
    else:
        current = spark.createDataFrame([], full)
    result = fn(current).checkpoint(eager=True)
    (result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET_COL).parquet(path))
    return touched


def check_buckets(spark: SparkSession, path: str, num_buckets: int) -> None:
    """Record the table's number of buckets; fail if it was made with another one."""
    fs, p, jvm = _fs(spark, path)
    if fs.exists(p):
        known = {st.getPath().getName() for st in fs.listStatus(p) if st.getPath().getName().startswith(_BUCKETS)}
        if known and known != {f"{_BUCKETS}{num_buckets}"}:
            raise ValueError(f"{path} has {sorted(known)[0][len(_BUCKETS):]} buckets, not {num_buckets}")
    fs.mkdirs(p)
    fs.create(jvm.org.apache.hadoop.fs.Path(p, f"{_BUCKETS}{num_buckets}"), True).close()


def merge_into_buckets(spark: SparkSession, path: str, batch: DataFrame, key: str | list[str],
                       rules: dict, schema: T.StructType, seq: str | None = None,
                       num_buckets: int = 256) -> list[int]:
    """Upsert ``batch`` into a Parquet table partitioned by key bucket,
    rewriting only the buckets the batch touches (see :func:`apply_to_buckets`).
    The upsert rules are idempotent, so a replayed batch (after a failure)
    converges to the same table."""
    from civitas.operators.upsert import KEEP, upsert
    keys = [key] if isinstance(key, str) else list(key)
    b = batch.withColumn(BUCKET_COL, bucket_of(keys, num_buckets, schema))
    return apply_to_buckets(spark, path, batch, keys,
                            lambda current: upsert(current, b, keys, {**rules, BUCKET_COL: KEEP}, seq=seq),
                            schema, num_buckets)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """A bucketed table without its bucket column."""
    return spark.read.parquet(path).drop(BUCKET_COL)
