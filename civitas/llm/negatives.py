"""Hard negatives for contrastive training, from candidate blocks in Hilbert order with zone maps.

Vectors become whole numbers; a row's score is its inner product with the
anchor. All rows are sorted by label, by their place on a Hilbert curve
through all dimensions and by id, and written as Parquet rows of one block
each: at most BLOCK vectors of one label, with the least and greatest entry of
every dimension (the zone map). Interval arithmetic over a zone map bounds the
scores that an anchor can meet in the block; a block is read only where these
bounds reach one of the anchor's score windows.

Anchors come in chunks, zone maps in pages, blocks in tiles: every task holds
one chunk against one page or tile, whatever the number of rows. The windows
are searched in two rounds. The first reads one block in EVERY; what it finds
raises the floor of the windows that are full already, so that the second
chooses fewer blocks and hands on few rows. Results are exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pin, table
from .vectors import finite, matrix, partition, reduced, state_row, width_of

SCALE = 256
BLOCK = 512         # rows of a candidate block at most
BITS = 2            # bits of a dimension on the curve
EVERY = 16          # one block in so many is read in the first round
CHUNK = 1 << 15     # anchors that meet a page or tile together
PAGE = 1024         # zone maps that meet a chunk together
TILE = 16           # blocks that meet a chunk together
SLICE = 2048        # anchors of one matrix product
LAST = (1 << 63) - 1
KINDS = "hiq"       # int16, int32, int64
WINDOW = ("low", "high", "score", "id")


def hilbert(x: np.ndarray, bits: int) -> list[bytes]:
    """The place of each row of whole numbers below 2^bits on the Hilbert curve, as bytes that sort like it."""
    x, (n, d) = x.astype(np.uint16), x.shape
    if not n or not d:
        return [b""] * n
    q = 1 << (bits - 1)
    while q > 1:                                    # undo the turns of the sub-cubes, from the coarsest
        for i in range(d):
            hit = (x[:, i] & q) != 0
            swap = np.where(hit, 0, (x[:, 0] ^ x[:, i]) & (q - 1)).astype(np.uint16)
            x[:, 0] ^= np.where(hit, q - 1, swap).astype(np.uint16)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, d):                           # Gray code
        x[:, i] ^= x[:, i - 1]
    turn, q = np.zeros(n, np.uint16), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[:, d - 1] & q, q - 1, 0).astype(np.uint16)
        q >>= 1
    x ^= turn[:, None]
    planes = np.stack([(x >> (bits - 1 - b)) & 1 for b in range(bits)], axis=1).reshape(n, -1).astype(np.uint8)
    return [r.tobytes() for r in np.packbits(planes, axis=1)]


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, exact: as doubles while every sum fits 53 bits, else as 64-bit integers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most >= 1 << 62:
        raise ValueError("inner products pass 62 bits")
    return a @ b.T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of ``a`` with any vector between ``low`` and ``high``."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return dot(up, low) + dot(down, high), dot(up, high) + dot(down, low)


def packed_matrix(x: np.ndarray) -> tuple[str, bytes]:
    most = np.abs(x).max(initial=0) + 1
    kind = KINDS[int(most >= 1 << 15) + int(most >= 1 << 31)]
    return kind, x.astype(np.dtype(kind)).tobytes()


def cut_blocks(d: int, scale: int, block: int):
    """Task function over sorted (label, key, id, place, v): one row per block."""
    def row(no, label, ids, places, x):
        order = np.lexsort((places, ids))           # ties go to the smaller id, so a block is kept in that order
        kind, codes = packed_matrix(x[order])
        return pa.RecordBatch.from_pylist([{
            "block": (partition() << 32) + no, "label": label, "n": len(ids), "ids": ids[order].tobytes(), "places": places[order].tobytes(),
            "kind": kind, "codes": codes, "low": x.min(axis=0).tobytes(), "high": x.max(axis=0).tobytes(), "first_id": int(ids.min())}], schema=BLOCKS)

    def run(batches):
        no, held = 0, None
        for b in batches:
            label, ids, places = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            x = matrix(b.column(4), d, scale)
            for part in np.split(np.arange(len(label)), np.flatnonzero(np.diff(label)) + 1):
                if not len(part):
                    continue
                if held is not None and held[0] != label[part[0]]:
                    yield row(no, *held)
                    no, held = no + 1, None
                got = (int(label[part[0]]), ids[part], places[part], x[part])
                held = got if held is None else (held[0], *(np.concatenate(p) for p in zip(held[1:], got[1:], strict=True)))
                while len(held[1]) > block:
                    yield row(no, held[0], *(p[:block] for p in held[1:]))
                    no, held = no + 1, (held[0], *(p[block:] for p in held[1:]))
        if held is not None:
            yield row(no, *held)
    return run


BLOCKS = pa.schema([("block", pa.int64()), ("label", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("places", pa.binary()),
                    ("kind", pa.string()), ("codes", pa.binary()), ("low", pa.binary()), ("high", pa.binary()), ("first_id", pa.int64())])
BLOCKS_DDL = ("block long, label long, n int, ids binary, places binary, kind string, codes binary, low binary, high binary, first_id long")


class Queries:
    """The anchors of a chunk with their windows: arrays of one column per window, empty ones where an anchor has fewer."""

    def __init__(self, rows: pa.Table, d: int, scale: int):
        rows = rows.combine_chunks()
        self.place, self.label = (rows[c].to_numpy(zero_copy_only=False) for c in ("place", "label"))
        self.x = matrix(rows["v"].chunk(0), d, scale) if rows.num_rows else np.zeros((0, d), np.int64)
        lists = [rows["windows"].to_pylist()][0]
        slots = max((len(w) for w in lists), default=0)
        self.low, self.high, self.score, self.id = (np.full((len(lists), slots), fill, np.int64) for fill in (1, 0, -LAST, LAST))
        self.w = np.zeros((len(lists), slots), np.int64)
        for i, windows in enumerate(lists):
            for j, w in enumerate(windows):
                self.w[i, j], self.low[i, j], self.high[i, j], self.score[i, j], self.id[i, j] = (w[k] for k in ("w", *WINDOW))

    def needs(self, part: slice, same: bool, label: np.ndarray, low: np.ndarray, high: np.ndarray, first_id: np.ndarray) -> np.ndarray:
        """Which anchors may find a row in which block, by the bounds of the zone maps."""
        least, most = bounds(self.x[part], low, high)
        need = np.zeros(least.shape, bool)
        for j in range(self.low.shape[1]):
            lo, hi, score, no = (a[part, j, None] for a in (self.low, self.high, self.score, self.id))
            need |= (lo <= hi) & (most >= lo) & (least <= hi) & ((most > score) | ((most == score) & (first_id[None, :] < no)))
        return need & ((self.label[part, None] == label[None, :]) == same)


def first_round(block: np.ndarray, every: int) -> np.ndarray:
    return ((block.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(every) == 0


def choose(d: int, scale: int, same: bool, early: bool | None, every: int, tile: int):
    """Cogroup function (chunk of anchors, page of zone maps): the blocks to read and the tile they belong to."""
    def run(key, anchors, zones):
        chunk, page = key[0].as_py(), key[1].as_py()
        zones = zones.sort_by("block").to_pydict()
        block = np.array(zones["block"], np.int64)
        keep = np.ones(len(block), bool) if early is None else first_round(block, every) == early
        at, found = np.flatnonzero(keep), np.zeros(0, np.int64)
        if len(at) and anchors.num_rows:
            q = Queries(anchors, d, scale)
            low, high = (np.frombuffer(b"".join(zones[c][i] for i in at), np.int64).reshape(-1, d) for c in ("low", "high"))
            label, first_id = (np.array([zones[c][i] for i in at], np.int64) for c in ("label", "first_id"))
            need = np.zeros(len(at), bool)
            for i in range(0, anchors.num_rows, SLICE):
                need |= q.needs(slice(i, i + SLICE), same, label, low, high, first_id).any(axis=0)
            found = block[at[need]]
        return pa.table({"chunk": pa.array(np.full(len(found), chunk, np.int64)), "block": pa.array(found),
                         "tile": pa.array([f"{page}-{i // tile}" for i in range(len(found))], pa.string())})
    return run


def best(k: int, anchor, w, score, no, place) -> np.ndarray:
    """Which rows are the first k of their anchor and window: higher scores first, ties by smaller id, then place."""
    order = np.lexsort((place, no, -score, w, anchor))
    group = np.flatnonzero(np.concatenate(([True], (np.diff(anchor[order]) != 0) | (np.diff(w[order]) != 0)))) if len(order) else np.zeros(0, int)
    size = np.diff(np.append(group, len(order)))
    return order[np.arange(len(order)) - np.repeat(group, size) < k]


def search(d: int, scale: int, same: bool, k: int):
    """Cogroup function (chunk of anchors, tile of blocks): the first k rows of each window in the tile."""
    def run(key, anchors, blocks):
        q, found = Queries(anchors, d, scale), [np.zeros(0, np.int64)] * 5
        for r in blocks.to_pylist() if anchors.num_rows else ():
            ids, places = (np.frombuffer(r[c], np.int64) for c in ("ids", "places"))
            x = np.frombuffer(r["codes"], np.dtype(r["kind"])).reshape(-1, d).astype(np.int64)
            zone = [np.array([r["label"]])] + [np.frombuffer(r[c], np.int64)[None, :] for c in ("low", "high")] + [np.array([r["first_id"]])]
            for i in range(0, len(q.place), SLICE):
                asked = i + np.flatnonzero(q.needs(slice(i, i + SLICE), same, *zone)[:, 0])
                if not len(asked):
                    continue
                s = dot(q.x[asked], x)
                other = q.place[asked, None] != places[None, :] if same else True
                parts = [found]
                for j in range(q.low.shape[1]):
                    lo, hi, score, no = (a[asked, j, None] for a in (q.low, q.high, q.score, q.id))
                    a, c = np.nonzero((s >= lo) & (s <= hi) & other & ((s > score) | ((s == score) & (ids[None, :] < no))))
                    rows = [asked[a], q.w[asked[a], j], s[a, c], ids[c], places[c]]
                    at = best(k, *rows)
                    parts.append([v[at] for v in rows])
                found = [np.concatenate(v) for v in zip(*parts, strict=True)]
            if len(found[0]) > 1 << 20:
                at = best(k, *found)
                found = [v[at] for v in found]
        at = best(k, *found)
        found = [v[at] for v in found]
        return pa.table({"place": q.place[found[0]] if len(at) else pa.array([], pa.int64()), "w": found[1], "score": found[2], "id": found[3], "row": found[4]})
    return run


class Candidates:
    """The blocks of a table of (place, id, label, v), their zone maps, and its anchors in chunks."""

    def __init__(self, base: DataFrame, *, anchor_every: int, scale: int = SCALE, block: int = BLOCK, every: int = EVERY,
                 chunk: int = CHUNK, page: int = PAGE, tile: int = TILE):
        self.d, self.scale, self.every, self.tile = width_of(base, "v"), scale, every, tile
        d = self.d
        keyed = base.select("label", "id", "place", "v").mapInArrow(self.keys(base), "label long, key binary, id long, place long, v array<double>")
        order = ["label", "key", "id", "place"]
        self.blocks = pin(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            cut_blocks(d, scale, block), BLOCKS_DDL), "candidate-blocks")
        self.pages = max(1, math.ceil(self.blocks.count() / page))
        self.zones = self.blocks.select("block", "label", "low", "high", "first_id", F.pmod(F.xxhash64("block"), F.lit(self.pages)).alias("page"))
        anchors = keyed.filter(F.col("id").isNotNull() & (F.col("id") % anchor_every == 0) & (F.col("id") != LAST))
        self.chunks = max(1, math.ceil(base.filter(F.col("id") % anchor_every == 0).count() / chunk))
        if self.chunks > 1:                         # neighbours on the curve ask for the same blocks
            anchors = anchors.repartitionByRange(self.chunks, *order).withColumn("chunk", F.spark_partition_id().cast("long"))
        else:
            anchors = anchors.withColumn("chunk", F.lit(0).cast("long"))
        self.anchors = pin(anchors.select("chunk", "place", "id", "label", "v"), "anchors")
        if self.chunks > 1:
            self.chunks = 1 + (self.anchors.agg(F.max("chunk")).first()[0] or 0)

    def keys(self, base: DataFrame):
        """Task function adding the place on the curve, over a grid two standard deviations around the mean."""
        d, scale = self.d, self.scale

        def moments(batches):
            n, s, q = 0, np.zeros(d), np.zeros(d)
            for b in batches:
                x = matrix(b.column(0), d, scale).astype(float)
                n, s, q = n + len(x), s + x.sum(axis=0), q + (x * x).sum(axis=0)
            if n:
                yield state_row(np.array([float(n)]), s, q)

        def add(a, b):
            return (np.frombuffer(a) + np.frombuffer(b)).tobytes()

        got = np.frombuffer(reduced(base.select("v").mapInArrow(moments, "id long, state binary"), add, "curve-grid") or np.ones(2 * d + 1).tobytes())
        mean = got[1:d + 1] / got[0]
        step = np.sqrt(np.maximum(got[d + 1:] / got[0] - mean * mean, 0)) * 4 / (1 << BITS)

        def run(batches):
            for b in batches:
                x = matrix(b.column(3), d, scale)
                cell = np.clip(np.floor((x - mean) / np.where(step > 0, step, 1)) + (1 << (BITS - 1)), 0, (1 << BITS) - 1)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hilbert(cell, BITS), pa.binary()), b.column(1), b.column(2),
                                                  b.column(3).cast(pa.list_(pa.float64()))], names=["label", "key", "id", "place", "v"])
        return run

    def first(self, windows: DataFrame, k: int, same: bool) -> DataFrame:
        """(place, w, rank, score, id): the first ``k`` rows of every window (place, w, low, high), own row left out.

        ``same``: among the rows of the anchor's label, else among the others.
        """
        windows = pin(windows.select("place", "w", "low", "high", F.lit(-LAST).alias("score"), F.lit(LAST).alias("id")), "windows")
        early = self.round(windows, k, same, True)
        rank = F.row_number().over(Window.partitionBy("place", "w").orderBy(F.desc("score"), "id", "row"))
        full = early.withColumn("rank", rank).filter(F.col("rank") == k).select("place", "w", F.col("score").alias("s"), F.col("id").alias("i"))
        raised = windows.join(full, ["place", "w"], "left").select(
            "place", "w", "low", "high", F.coalesce("s", "score").alias("score"), F.coalesce("i", "id").alias("id"))
        late = self.round(raised, k, same, False)
        return early.union(late).withColumn("rank", rank).filter(F.col("rank") <= k).drop("row")

    def round(self, windows: DataFrame, k: int, same: bool, early: bool) -> DataFrame:
        queries = windows.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("w", *WINDOW))).alias("windows"))
        queries = pin(self.anchors.drop("id").join(queries, "place"), "queries")
        asked = queries.withColumn("page", F.explode(F.expr(f"sequence(0L, {self.pages - 1}L)")))
        zones = self.zones.withColumn("chunk", F.explode(F.expr(f"sequence(0L, {self.chunks - 1}L)")))
        chosen = asked.groupBy("chunk", "page").cogroup(zones.groupBy("chunk", "page")).applyInArrow(
            choose(self.d, self.scale, same, early, self.every, self.tile), "chunk long, block long, tile string")
        chosen = pin(chosen, "chosen-blocks")
        read = chosen.join(self.blocks, "block")
        cells = chosen.select(F.col("chunk").alias("c"), F.col("tile").alias("t")).distinct()
        found = queries.join(cells, F.col("chunk") == F.col("c")).drop("chunk").groupBy("c", "t").cogroup(read.groupBy("chunk", "tile")).applyInArrow(
            search(self.d, self.scale, same, k), "place long, w long, score long, id long, row long")
        return pin(found, "found")


def hard_negatives(df: DataFrame, *, vector: str = "embedding", id_col: str = "vec_id", label: str = "label", anchor_every: int = 100,
                   positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, scale: int = SCALE, **sizes) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id ``anchor_every`` divides, positives the first
    rows of the same label, negatives the first rows of other labels whose
    score lies between ``least`` and ``most`` percent of the positive's.

    Defined cases: rows with a null label, a null vector or an entry that is
    null, NaN or infinite take no part; a null id comes after all ids and is
    never an anchor; shorter vectors end in entries of 0; repeated rows are
    rows of their own, each the other's positive and each an anchor; an empty
    table gives no rows; no other columns are read.
    """
    v = F.col(f"`{vector}`")
    rows = df.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                     v.cast("array<double>").alias("v")).filter(F.col("label").isNotNull() & finite(F.col("v")))
    base = pin(rows.withColumn("place", F.monotonically_increasing_id()), "vectors")
    found = Candidates(base, anchor_every=anchor_every, scale=scale, **sizes)
    every = found.anchors.select("place", F.lit(1).cast("long").alias("w"), F.lit(-LAST).alias("low"), F.lit(LAST).alias("high"))
    near = found.first(every, positives, True).select("place", F.col("rank").cast("long").alias("w"), F.col("score").alias("positive_score"),
                                                      F.col("id").alias("positive_id"))
    near = pin(near, "positives")
    windows = near.select("place", "w", F.expr(f"({least} * positive_score + pmod(-{least} * positive_score, 100)) div 100").alias("low"),
                          F.expr(f"({most} * positive_score - pmod({most} * positive_score, 100)) div 100").alias("high"))
    far = found.first(windows, negatives, False).withColumnsRenamed({"score": "negative_score", "id": "negative_id"})
    named = near.join(found.anchors.select("place", F.col("id").alias("anchor_id")), "place")
    return far.join(named, ["place", "w"]).select(
        "anchor_id", F.nullif("positive_id", F.lit(LAST)).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.nullif("negative_id", F.lit(LAST)).alias("negative_id"), "positive_score", "negative_score")


def op11_query(spark, sf_dir):
    """Ten hard negatives for each of five positives of every hundredth embedding."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


ORACLE = """
WITH rows AS (
  SELECT row_number() OVER () AS place, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(c AS DOUBLE)) for c in embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
scored AS (
  SELECT a.place, a.vec_id AS anchor_id, a.label = r.label AS same, r.place AS row_place, r.vec_id,
         CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.place <> r.place),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id, row_place) AS w FROM scored WHERE same
  QUALIFY w <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.place, p.w ORDER BY s.score DESC, s.vec_id, s.row_place) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.place = s.place AND NOT s.same
 AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""
