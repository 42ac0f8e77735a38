"""Removal of every byte that a repeated 400-byte string covers.

What is built here: repeated strings are found by counting 64-bit names
(polynomial hashes) of byte strings at selected starts, in rounds that name
ever more of the starts still open. No Burrows-Wheeler transform, merged
suffix order or common-prefix array is made; README.md says why, with
figures. Like a merge of shard transforms it adds up, over all tasks, how many
suffixes share a prefix, settles those that are unique or repeated at full
length, and never sorts all suffixes again. Equal names stand for equal
strings: no bytes are compared after it.

Round 1, sampled suffixes: of the window starts that select the same anchor
(leftmost minimal 16-byte hash within 128 starts) only the anchor's suffix is
named, by the bytes all those windows share. Unique: all of them are settled.
Round 2: the bytes from the first of those windows to the end of the last.
Repeated: all of them are settled as repeats.
Round 3: the starts still open are named one by one by their 400 bytes,
together with one representative of each settled repeat they might equal.

Per-byte work is vectorised numpy on one document chunk at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pin, row_places, short_batches, slices, table

OUT_ROWS = 1 << 16  # rows of an Arrow batch that a task hands on
GRAM = 16           # bytes per anchor hash
WINDOW = 128        # window starts that share an anchor at most
CHUNK = 1 << 19     # window starts handled at once
MULTIPLIER = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Names:
    """Names of byte strings: equal strings have equal names wherever they stand."""

    def __init__(self):
        self.code = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))
        self.power = self.back = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        n = len(data)
        if len(self.power) <= n:
            size = 2 * n + 1
            self.power, self.back = np.full(size, MULTIPLIER, np.uint64), np.full(size, pow(MULTIPLIER, -1, 1 << 64), np.uint64)
            for x in (self.power, self.back):
                x[0] = 1
                np.multiply.accumulate(x, out=x)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.code[data] * self.power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.back[start])


def chunks(data: np.ndarray, length: int):
    """(offset, bytes) so that every window start falls in exactly one chunk, with its whole window."""
    starts = len(data) - length + 1
    for c in range(0, starts, CHUNK):
        n = min(CHUNK, starts - c)
        yield c, data[c:c + n + length - 1]


def anchor_runs(names: Names, n_starts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(s, e, a): the window starts s..e-1 select the anchor a; the choice depends on the window's bytes only."""
    m = n_starts + WINDOW - 1
    i = np.arange(m)
    # ties go to the left: places within a chunk fit the low 20 bits
    h = (names.of(i, i + GRAM) & ~np.uint64(0xFFFFF)) | i.astype(np.uint64)
    blocks = np.full(-(-m // WINDOW) * WINDOW, np.iinfo(np.uint64).max, np.uint64)
    blocks[:m] = h
    blocks = blocks.reshape(-1, WINDOW)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n_starts], ahead[WINDOW - 1:WINDOW - 1 + n_starts])
    s = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return s, np.append(s[1:], n_starts), (least[s] & np.uint64(0xFFFFF)).astype(np.int64)


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def document_runs(names: Names, data: np.ndarray, length: int):
    """(s, e, g, l) of one document, chunk by chunk: start runs, name of their shared bytes, name of all their bytes."""
    for c, part in chunks(data, length):
        names.load(part)
        s, e, a = anchor_runs(names, len(part) - length + 1)
        g = names.of(a, a + length - WINDOW + 1)
        l = names.of(s, e - 1 + length) ^ mix((e - s).astype(np.uint64))
        yield s + c, e + c, g, l


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def handed_on(found, names: list[str]):
    """Arrow batches of some OUT_ROWS rows each out of (equally long columns, ...) of any length."""
    held, n = [], 0
    for columns in found:
        for i in range(0, len(columns[0]), OUT_ROWS):
            held.append([c[i:i + OUT_ROWS] for c in columns])
            n += len(held[-1][0])
            if n >= OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)
                held, n = [], 0
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)


def shared_names(length: int):
    """Task function: the round-1 names of a shard with their counts (2 stands for more)."""
    def run(batches):
        names = Names()
        for b in slices(batches):
            found = [g for t in b.column(1) for _, _, g, _ in document_runs(names, as_bytes(t.as_py()), length)]
            if found:
                name, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([signed(name), pa.array(np.minimum(n, 2).astype(np.int8))], names=["name", "n"])
    return run


def open_runs(length: int):
    """Task function: every start run with its two names."""
    def found(batches):
        names = Names()
        for b in slices(batches):
            for place, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for s, e, g, l in document_runs(names, as_bytes(t.as_py()), length):
                    yield np.full(len(s), place, np.int64), s, e, g.view(np.int64), l.view(np.int64)

    def run(batches):
        yield from handed_on(found(batches), ["place", "s", "e", "g", "l"])
    return run


def start_names(length: int, with_place: bool):
    """Task function: names of the 400 bytes at every start of the runs marked OPEN or WITNESS."""
    def found(batches):
        names = Names()
        for b in slices(batches):
            for place, t, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                runs = [r for r in runs if r["kind"] != REPEAT and not (with_place and r["kind"] == WITNESS)]
                if not runs:
                    continue
                first, last = (np.array([r[k] for r in runs], np.int64) for k in ("s", "e"))
                data = as_bytes(t.as_py())
                for c, part in chunks(data, length):
                    a, z = np.maximum(first - c, 0), np.minimum(last - c, CHUNK)
                    mine = [np.arange(x, y) for x, y in zip(a, z, strict=True) if x < y]
                    if mine:
                        p = np.sort(np.concatenate(mine))
                        names.load(part)
                        yield np.full(len(p), place, np.int64), p + c, names.of(p, p + length).view(np.int64)

    def run(batches):
        for b in handed_on(found(batches), ["place", "p", "name"]):
            if with_place:
                yield b
            else:
                name, n = np.unique(b.column(2).to_numpy(), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(np.minimum(n, 2).astype(np.int8))], names=["name", "n"])
    return run


def removed_spans(runs: list[dict], starts: list[int] | None, length: int) -> np.ndarray:
    """Maximal removed runs of bytes as rows (from, to)."""
    s = [np.array([r["s"] for r in runs if r["kind"] != OPEN], np.int64), np.array(starts or [], np.int64)]
    e = [np.array([r["e"] - 1 + length for r in runs if r["kind"] != OPEN], np.int64), s[1] + length]
    s, e = np.concatenate(s), np.concatenate(e)
    if not len(s):
        return np.empty((0, 2), np.int64)
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    first = np.flatnonzero(np.concatenate(([True], s[1:] > e[:-1])))
    return np.stack([s[first], e[np.append(first[1:], len(s)) - 1]], axis=1)


def cut_documents(length: int):
    """Task function: what is removed from each document, and the digest of what stays."""
    def run(batches):
        for b in slices(batches):
            out = []
            for place, t, runs, starts in zip(b.column(0).to_pylist(), b.column(1), *(b.column(i).to_pylist() for i in (2, 3)), strict=True):
                data, spans = as_bytes(t.as_py()), removed_spans(runs, starts, length)
                keep = np.ones(len(data), bool)
                for x, y in spans:
                    keep[x:y] = False
                out.append((place, int(len(data) - keep.sum()), spans.tolist(), hashlib.sha256(data[keep].tobytes()).hexdigest()))
            place, removed, spans, digest = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(digest, pa.string())],
                                             names=["place", "n_removed", "spans", "kept_sha256"])
    return run


OPEN, REPEAT, WITNESS = 1, 2, 3


def repeated(named: DataFrame) -> DataFrame:
    """Names that all shards together hold at least twice."""
    return named.groupBy("name").agg(F.sum("n").alias("n")).filter("n >= 2").select("name")


def repeated_spans(docs: DataFrame, place: Column, *, length: int = 400, text: str = "text") -> DataFrame:
    """(place, n_removed, spans, kept_sha256) of the documents that share anything.

    ``docs`` is a scan of files (rows are known by their ``place`` in them);
    ``spans`` are [from, to) byte offsets.
    """
    short_batches(docs.sparkSession)
    src = docs.select(place.alias("place"), F.col(f"`{text}`").alias("text"))
    # round 1
    names = pin(repeated(src.mapInArrow(shared_names(length), "name long, n byte")), "round1")
    runs = src.mapInArrow(open_runs(length), "place long, s long, e long, g long, l long")
    runs = pin(runs.join(names, runs["g"] == names["name"], "left_semi"), "round1-open")
    # round 2
    whole = runs.groupBy("l").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("place", "s")).alias("first")).filter("n >= 2").select(
        F.col("l").alias("l2"), "first")
    whole = pin(whole, "round2-names")  # the join below then shuffles a scan, whose hot names Spark splits
    marked = runs.join(whole, F.col("l") == F.col("l2"), "left")
    marked = pin(marked.select("place", "s", "e", "g", F.when(F.col("l2").isNull(), OPEN).when(
        F.col("first") == F.struct("place", "s"), WITNESS).otherwise(REPEAT).alias("kind")), "round2")
    # a representative is a witness only where something that shares its anchor is open
    asking = marked.filter(F.col("kind") == OPEN).select(F.col("g").alias("g2")).distinct()
    asked = marked.filter(F.col("kind") == WITNESS).join(asking, F.col("g") == F.col("g2"), "left").select(
        "place", "s", "e", F.when(F.col("g2").isNull(), REPEAT).otherwise(WITNESS).alias("kind"))
    spans = marked.filter(F.col("kind") != WITNESS).select("place", "s", "e", "kind").union(asked)
    spans = pin(spans.groupBy("place").agg(F.collect_list(F.struct("s", "e", "kind")).alias("runs")), "spans")
    # round 3
    texts = pin(src.join(spans, "place").select("place", "text", "runs"), "open-texts")
    names = pin(repeated(texts.mapInArrow(start_names(length, False), "name long, n byte")), "round3")
    starts = texts.mapInArrow(start_names(length, True), "place long, p long, name long")
    starts = starts.join(names, "name", "left_semi").groupBy("place").agg(F.collect_list("p").alias("starts"))
    starts = pin(starts, "starts")
    return texts.join(starts, "place", "left").select("place", "text", "runs", "starts").mapInArrow(
        cut_documents(length), "place long, n_removed long, spans array<array<long>>, kept_sha256 string")


def dedup_repeats(docs: DataFrame, *, length: int = 400, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256) for every row of a file scan.

    A byte goes if a ``length``-byte string that starts anywhere else too, in
    the same document or another, covers it; matches never cross documents.
    Defined cases: NULL is empty; a text shorter than ``length`` loses
    nothing; repeated rows are each other's repeats; an empty table gives no
    rows; other columns are not read; very long texts are read whole, CHUNK
    starts at a time.
    """
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    place = row_places(docs)
    base = docs.select(place.alias("place"), F.col(f"`{id_col}`").alias("doc_id"),
                       F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("whole"))
    cut = pin(repeated_spans(docs, place, length=length, text=text), "cut")
    return base.join(cut, "place", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<array<long>>")).alias("spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))


def op6_query(spark, sf_dir):
    """Bytes of every document covered by a repeated 400-byte string."""
    out = dedup_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
