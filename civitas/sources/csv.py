"""CSV sources.

S1 is read by Spark's own parallel reader with an explicit all-STRING schema
(no inference pass), or, with ``split=True``, from records that many tasks
cut out of one file (:mod:`civitas.sources.records`): Spark reads a file with
``multiLine`` in one task. S3 always reads such records.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civitas.sources.records import csv_records, stored, values_text

# Fixed value: a marker that cannot occur in landed text; Spark's CSV reader
# writes it for a quoted empty field so that '""' (empty string) and an
# unquoted empty field (NULL) stay apart, as COPY ... CSV keeps them.
EMPTY_MARK = "\u0000civitas-empty\u0000"
CORRUPT = "_corrupt_record"


def read_csv_positional(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str],
                        on_bad: str = "fail", multi_line: bool = True, header: bool = True,
                        split: bool = False, positions: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """CSV with a header line, mapped to ``columns`` by **position**.

    Unquoted empty -> NULL, quoted ``""`` -> ''. Doubled quotes escape a
    quote; quoted fields may hold newlines. Header names are ignored (a
    renamed header still loads). A row with the wrong number of fields is an
    error (``on_bad='fail'``) or goes to the second returned frame
    (``on_bad='reject'``, with the raw line in ``_corrupt_record``).
    ``multi_line=False`` makes large files splittable across tasks; use it
    only for files known to hold no newline inside a quoted field.
    ``split=True`` reads any file in ranges, newlines inside quotes included,
    with the same result. ``header=False`` reads landed files that carry no
    header line. ``positions`` (with ``split``) adds ``source_path`` and
    ``record_no``, the order of records in a file.
    """
    if split:
        return parse_positional(csv_records(spark, path), columns, on_bad, header, positions)
    if positions:
        raise ValueError("positions needs split=True")
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    reader = (spark.read.option("header", header).option("enforceSchema", True)
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
              .option("emptyValue", EMPTY_MARK).option("nullValue", "")
              # whole rows are parsed even if few columns are asked for: a row
              # of the wrong length is found whichever columns a query reads
              .option("columnPruning", False))
    if on_bad == "fail":
        df = reader.option("mode", "FAILFAST").schema(T.StructType(fields)).csv(path)
        return _unmark(df, columns)
    if on_bad == "reject":
        schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])
        df = (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .schema(schema).csv(path))
        # Spark refuses a query that reads only the corrupt column of a raw
        # CSV scan: a data column (always readable) is read beside it.
        always = F.length(F.coalesce(F.col(columns[0]), F.lit(""))) >= 0
        good = _unmark(df.filter(F.col(CORRUPT).isNull() & always).drop(CORRUPT), columns)
        bad = df.filter(F.col(CORRUPT).isNotNull() & always).select(CORRUPT)
        return good, bad
    raise ValueError(f"on_bad must be 'fail' or 'reject', not {on_bad!r}")


def parse_positional(records: DataFrame, columns: Sequence[str], on_bad: str = "fail", header: bool = True,
                     positions: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """S1 over ``(source_path, record_no, record)`` rows; see :func:`read_csv_positional`."""
    if on_bad not in ("fail", "reject"):
        raise ValueError(f"on_bad must be 'fail' or 'reject', not {on_bad!r}")
    place = ["source_path", "record_no"] if positions else []
    rows = records.filter("record_no > 0") if header else records
    ddl = ", ".join([f"`{c}` string" for c in columns] + ([f"`{CORRUPT}` string"] if on_bad == "reject" else []))
    options = {"mode": "FAILFAST" if on_bad == "fail" else "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "quote": '"', "escape": '"',
               "multiLine": "true", "emptyValue": EMPTY_MARK, "nullValue": ""}
    parsed = rows.select("source_path", "record_no", "record", F.from_csv(values_text(), ddl, options).alias("r"))

    def good(df: DataFrame) -> DataFrame:
        return df.select(*place, *[F.when(F.col(f"r.`{c}`") == EMPTY_MARK, "").otherwise(F.col(f"r.`{c}`")).alias(c) for c in columns])

    if on_bad == "fail":
        return good(parsed)
    corrupt = F.col(f"r.`{CORRUPT}`")
    return good(parsed.filter(corrupt.isNull())), parsed.filter(corrupt.isNotNull()).select(*place, F.col("record").alias(CORRUPT))


def _unmark(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.when(F.col(c) == F.lit(EMPTY_MARK), F.lit("")).otherwise(F.col(c)).alias(c)
                       for c in columns])


# Texts that a named column reads as missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
           "NaN", "None", "n/a", "nan", "null")


def read_csv_named(spark: SparkSession, path: str | Sequence[str], wanted: Mapping[str, str],
                   positions: bool = False, missing: Sequence[str] = MISSING) -> DataFrame:
    """S3: CSV matched by header **name**; missing columns -> NULL, extras ignored.

    Files may differ in header. A file is read by many tasks, newlines inside
    quotes included. ``positions`` adds ``source_path`` and ``line_no``, the
    number of the record in its file. See :func:`parse_named`.
    """
    return parse_named(csv_records(spark, path), wanted, positions, missing)


def parse_named(records: DataFrame, wanted: Mapping[str, str], positions: bool = False,
                missing: Sequence[str] = MISSING) -> DataFrame:
    """S3 over :func:`~civitas.sources.records.csv_records` rows: the first record of a file names its columns.

    A name that a header repeats means its first column. Fields that a row
    lacks are NULL, those beyond the header are ignored. Texts listed in
    ``missing`` are NULL, quoted or not: S2 and S3 share this rule. The driver
    reads the distinct headers, one row each; records are parsed once, whatever
    the number of headers.
    """
    first = stored(records.filter("record_no = 0").select("source_path", values_text().alias("header")), "csv-headers")
    headers = sorted(r["header"] for r in first.select("header").distinct().collect())
    names = [next(csv.reader([h])) for h in headers]
    width = max((len(n) for n in names), default=0)
    ddl = ", ".join(f"c{i} string" for i in range(max(1, width)))
    options = {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": "true", "emptyValue": "", "nullValue": ""}
    rows = records.filter("record_no > 0")
    # one header for all: no join
    rows = rows.join(first, "source_path") if len(headers) > 1 else rows.withColumn("header", F.lit(headers[0] if headers else ""))
    rows = rows.select(
        "source_path", "record_no", "header", F.from_csv(values_text(), ddl, options).alias("r"))

    def column(name: str, kind: str) -> Column:
        value = F.lit(None).cast("string")
        for header, columns in zip(headers, names, strict=True):
            if name in columns:
                value = F.when(F.col("header") == header, F.col(f"r.c{columns.index(name)}")).otherwise(value)
        return F.when(~value.isin(list(missing)), value).cast(kind).alias(name)

    place = [F.col("source_path"), F.col("record_no").alias("line_no")] if positions else []
    return rows.select(*place, *[column(n, k) for n, k in wanted.items()])


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Write quoted CSV (empty strings quoted, NULL unquoted) for S1 inputs."""
    (df.write.mode("overwrite").option("header", header).option("quote", '"')
       .option("escape", '"').option("quoteAll", False).option("emptyValue", '""')
       .option("nullValue", "").csv(path))
