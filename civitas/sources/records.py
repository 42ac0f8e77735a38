"""CSV records of files that are read in ranges, newlines inside quotes included.

Spark's text reader cuts a file into byte ranges at line ends, so many tasks
read one file. Whether a line end is also the end of a record depends on all
quotes before it. Each range therefore notes, line by line, the state after
the line for either state at its start (outside or inside quotes): for lines
with well-placed quotes that is the parity of their number. The lines are
stored once with these notes. One small row per range then gives the state at
the start of every range (for parities a prefix XOR) and how many records end
before it, which numbers all records of a file. A line that starts and ends
outside quotes is a record; only the lines of longer records are shuffled, to
be joined by record number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civitas.session import scratch_path

QUOTE, COMMA = ord('"'), ord(",")
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"

# A range's lines. For h in 0, 1 (state at the start of the range, 1 = inside quotes):
# in<h> the state before the line, out<h> the one after it, ends<h> the records that end before it.
NOTED = ("source_path string, start long, n long, line string, "
         "in0 byte, out0 byte, ends0 long, in1 byte, out1 byte, ends1 long")


def state_after(line: bytes, inside: int) -> int:
    """Outside (0) or inside (1) quotes after one line, read character by character as the CSV reader does."""
    i, n = 0, len(line)
    while True:
        if not inside:
            if i < n and line[i] == QUOTE:
                i += 1
            else:                                       # an unquoted field ends at the next comma, quotes in it are text
                i = line.find(b",", i) + 1
                if i == 0:
                    return 0
                continue
        while True:                                     # inside quotes: to the quote that closes the field
            i = line.find(b'"', i)
            if i < 0:
                return 1
            if line[i + 1:i + 2] != b'"':
                break
            i += 2
        inside = 0
        i = line.find(b",", i + 1) + 1                  # whatever follows the closing quote belongs to the field
        if i == 0:
            return 0


def transitions(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """State after each line for a start outside (first) and inside quotes (second)."""
    n = len(lines)
    offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset:lines.offset + n + 1].astype(np.int64)
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    at = np.flatnonzero(data == QUOTE)
    line = np.searchsorted(offsets, at, side="right") - 1
    count = np.bincount(line, minlength=n)
    after0 = (count & 1).astype(np.int8)
    after1 = 1 - after0
    if len(at):
        order = np.arange(len(at)) - (np.cumsum(count) - count)[line]
        first = at == offsets[line]
        before = np.where(first, COMMA, data[np.maximum(at - 1, 0)])
        # a quote opens a field behind a comma or at the line's start, or is the second half of an escaped one
        placed = (before == COMMA) | ((before == QUOTE) & (order > 0))
        for h, after in ((0, after0), (1, after1)):
            opening = (order & 1) == h
            odd = np.unique(line[opening & ~placed])
            for i in odd.tolist():
                after[i] = state_after(data[offsets[i]:offsets[i + 1]].tobytes(), h)
    return after0, after1


def states(after0: np.ndarray, after1: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """States before and after every line, from the state before the first one."""
    n = len(after0)
    before, flips = np.empty(n, np.int8), (after0 != after1)
    flip = np.where(flips, after0, 0)
    total = np.cumsum(flip) & 1                         # parity of the flips up to and with each line
    state, done = start, 0
    for i in [*np.flatnonzero(~flips).tolist(), n]:     # lines whose end does not depend on their start; few
        base = int(total[done - 1]) if done else 0
        part = slice(done, i)
        before[part] = state ^ base ^ (total[part] ^ flip[part])
        if i < n:
            before[i] = state ^ base ^ (int(total[i - 1]) if i else 0)
            state, done = int(after0[i]), i + 1
    return before, np.where(before == 0, after0, after1).astype(np.int8)


def note_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow task function over the (path, start, line) rows of whole ranges, in file order: NOTED rows."""
    key, n, state, ends = None, 0, [0, 1], [0, 0]
    for b in batches:
        if not b.num_rows:
            continue
        path, start, line = (b.column(i) for i in range(3))
        at = start.to_numpy()
        paths = path.dictionary_encode()
        code = paths.indices.to_numpy()
        cut = np.flatnonzero((at[1:] != at[:-1]) | (code[1:] != code[:-1])) + 1
        after = transitions(line)
        blank = pc.is_in(line, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows], strict=True):
            here = (paths.dictionary[int(code[i])].as_py(), int(at[i]))
            if here != key:
                key, n, state, ends = here, 0, [0, 1], [0, 0]
            cols = [path.slice(i, j - i), start.slice(i, j - i), pa.array(np.arange(n, n + j - i)), line.slice(i, j - i)]
            for h in (0, 1):
                before, then = states(after[0][i:j], after[1][i:j], state[h])
                ends_here = (then == 0) & ~(blank[i:j] & (before == 0))
                closed = np.cumsum(ends_here)
                cols += [pa.array(before), pa.array(then), pa.array(ends[h] + closed - ends_here)]
                state[h], ends[h] = int(then[-1]), ends[h] + int(closed[-1])
            n += j - i
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in NOTED.split(", ")])


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The frame written to the shared scratch folder and read back: its size is known to the joins behind it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    limit = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, "8000")    # wide projections in parts: the JVM never compiles a longer method
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(METHOD_LIMIT, limit)
    return spark.read.schema(df.schema).parquet(path)


def noted_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The lines of the files under ``path`` with their notes, stored once on shared storage.

    A line keeps its carriage return. All later steps read the stored lines,
    so ranges are cut once, however the cluster changes.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return stored(lines.select("_metadata.file_path", "_metadata.file_block_start", "value").mapInArrow(note_lines, NOTED), "csv-lines", "zstd")


def _blank() -> Column:
    return F.col("line").isin("", "\r")


def _ends(h: int) -> Column:
    """The line ends a record, for state ``h`` at the start of its range."""
    return (F.col(f"out{h}") == 0) & ~((F.col(f"in{h}") == 0) & _blank())


def ranges(noted: DataFrame) -> DataFrame:
    """(source_path, start, inside, first_record, crlf): state and record number at the start of each range.

    ``crlf``: the file's first line ends with a carriage return. One row per range of a file; a file's ranges are ordered in one task,
    some hundred thousand rows for 10 TB.
    """
    by_range = noted.groupBy("source_path", "start").agg(
        *[F.max_by(c, "n").alias(c) for c in ("out0", "out1")],
        *[F.max(F.col(f"ends{h}") + _ends(h).cast("long")).alias(f"ends{h}") for h in (0, 1)],
        F.max(F.when((F.col("start") == 0) & (F.col("n") == 0), F.col("line").endswith("\r"))).alias("crlf"))
    order = Window.partitionBy("source_path").orderBy("start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    # a range with out0 = out1 sets the state whatever it was; later ones flip it by their parity
    fixed = F.col("out0") == F.col("out1")
    by_range = by_range.withColumn("flips", F.sum(F.when(fixed, 0).otherwise(F.col("out0"))).over(earlier)).withColumn(
        "set", F.max(F.when(fixed, F.struct("start", "out0", (F.coalesce("flips", F.lit(0))).alias("flips")))).over(earlier))
    base = F.coalesce("flips", F.lit(0)) - F.coalesce("set.flips", F.lit(0))
    by_range = by_range.withColumn("inside", F.pmod(base + F.coalesce("set.out0", F.lit(0)), F.lit(2)))
    ended = F.when(F.col("inside") == 1, F.col("ends1")).otherwise(F.col("ends0"))
    return by_range.select("source_path", "start", "inside", F.coalesce(F.sum(ended).over(earlier), F.lit(0)).alias("first_record"),
                           F.max("crlf").over(Window.partitionBy("source_path")).alias("crlf"))


def csv_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(source_path, record_no, record, crlf): every CSV record of the files under ``path``, as raw text.

    ``record_no`` counts from 0 along a file, the header included; empty
    lines between records are left out. Quotes are doubled inside quoted fields; a
    quote inside an unquoted field is text. A record loses its own line end
    and keeps those inside its quotes; ``crlf`` tells of files whose first
    line ends with CR LF, where Spark's reader makes them LF in values
    (:func:`values_text`). A quote that never closes makes the rest of its
    file one record, as there.
    """
    return records_of(noted_lines(spark, path))


def records_of(noted: DataFrame) -> DataFrame:
    """:func:`csv_records` of noted lines."""
    lines = noted.join(stored(ranges(noted), "csv-ranges"), ["source_path", "start"])

    def of(name: str) -> Column:
        return F.when(F.col("inside") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    lines = lines.select("source_path", "start", "n", "line", of("in").alias("before"), of("out").alias("after"),
                         (F.col("first_record") + of("ends")).alias("record_no"), "crlf")
    whole = lines.filter((F.col("before") == 0) & (F.col("after") == 0) & ~_blank()).select("source_path", "record_no", F.col("line").alias("record"), "crlf")
    parts = lines.filter("before = 1 OR after = 1").groupBy("source_path", "record_no").agg(
        F.array_sort(F.collect_list(F.struct("start", "n", "line"))).alias("parts"), F.first("crlf").alias("crlf"))
    longer = parts.select("source_path", "record_no", F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record"), "crlf")
    bare = F.when(F.col("crlf"), F.regexp_replace("record", r"\r\z", "")).otherwise(F.col("record"))
    both = whole.unionByName(longer).withColumn("record", bare)
    return both.withColumn("record", F.when(F.col("record_no") == 0, F.ltrim("record", F.lit("\ufeff"))).otherwise(F.col("record")))


def values_text() -> Column:
    """The record as its values are read: CR LF is LF in files that end their lines with it."""
    return F.when(F.col("crlf"), F.regexp_replace("record", "\r\n", "\n")).otherwise(F.col("record"))
