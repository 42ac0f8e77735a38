"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage (a lost executor rereads files), computes an expensive
    frame once, and gives Catalyst its real size: a later join broadcasts it
    only if the files are below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles it otherwise.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_places(docs: DataFrame) -> Column:
    """A number for every row of a file scan, fixed by its file and its position in it.

    However Spark cuts the files into partitions, each job over them sees the
    same numbers. The low bits hold the position, the others a hash of the
    file's path whose seed is chosen so that no two files share it.
    """
    meta = docs.metadataColumn("_metadata")
    path, row = meta["file_path"], meta["row_index"]
    files = pin(docs.select(path.alias("path"), row.alias("row")).groupBy("path").agg(F.max("row").alias("last")), "files")
    n, last = files.agg(F.count(F.lit(1)), F.max("last")).first()
    bits = max(1, (last or 0).bit_length())

    def hashed(seed, path):
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), path), bits + 1)

    for seed in range(64):
        if files.agg(F.countDistinct(hashed(seed, F.col("path")))).first()[0] == n:
            return F.shiftleft(hashed(seed, path), bits).bitwiseOR(row)
    raise ValueError(f"{n} files of up to {last + 1} rows have no distinct places of 63 bits")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(col, UPPER, UPPER.lower())


def held_out(doc_id: Column) -> Column:
    """The evaluation fold: crc32 of the id as text, modulo 5, is 0 (NULL ids are not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def shared(spark: SparkSession, value):
    """A broadcast of a model of bounded size; call the result inside a task to get it.

    Pickled by value, as the classes need not be importable on executors.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def short_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1,000 rows and 8 MB from here on in this session.

    The defaults of 10,000 and 64 MB are made for short rows; whole texts
    would fill them in the JVM and again in Python, in every task. The
    settings stay, as the frames that need them run later.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def slices(batches, rows: int = 512):
    """Arrow batches in short slices: few texts become Python objects at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def packed(df: DataFrame, *extra: Column) -> DataFrame:
    """The whole row as one struct column ``row`` plus ``extra`` columns.

    Operators work beside the struct, so no input column can clash with
    their own names; ``select("row.*")`` restores the input.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *extra)


def unpacked(df: DataFrame, **added: Column) -> DataFrame:
    """Restore the packed row and add (or replace) the given columns."""
    keep = [c for c in df.schema["row"].dataType.fieldNames() if c not in added]
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], *[c.alias(n) for n, c in added.items()])


def labelled_sample(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` training rows (doc_id, label), the held-out fold left out.

    The bound is the operators' documented fitting bound: the sample is the
    ``max_rows`` smallest by a hash of the id, so it does not depend on order.
    Rows without id or label are ignored; an id labelled twice takes the
    smaller label.
    """
    rows = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
            .filter(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id")))
            .groupBy("_id").agg(F.min("_y").alias("_y")))
    return rows.orderBy(F.xxhash64(F.lit(17), "_id"), "_id").limit(max_rows)
