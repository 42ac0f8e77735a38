"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: 64-bit majority votes over the XXH64 hashes of word shingles.
Equal fingerprints fold into one node first, so a group of copies is one row
however large it is.

Candidates: the 64 bits are cut into ``radius + 2`` blocks. Two fingerprints
within the radius agree on at least two of them, so nodes meet in buckets
keyed by (pair of blocks, their bits): 10 keys of about 26 bits for radius 3.

Comparison: the members of a bucket are stored as bit planes (plane b holds
bit b of 64 fingerprints a word). One XOR of a plane with its shifted self
compares every member with the one ``s`` places on; carry-save counters add
up the planes for all of them at once, and a block is abandoned as soon as
every counter in it has passed the radius. Only planes outside the bucket's
key are read. A bucket above TILE members is cut into tiles and every pair of
tiles is a group of its own, so no bucket meets in one task. Groups emit
spanning stars (at most one row per member), never all pairs.

Components: alternating large-star / small-star rounds over the star edges,
each round a table in the shared folder.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pin, row_places, short_batches, slices, table

TILE = 512
LANES = 8192    # members compared at once
SEED = 42       # of XXH64, fixed by the contract


def document_hashes(text: str | None, ngram: int) -> np.ndarray:
    """XXH64 of every shingle of ``ngram`` words (all words if there are fewer)."""
    from xxhash import xxh64_digest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z; \x20 and \x09-\x0D
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= ngram:
        return np.frombuffer(xxh64_digest(joined, SEED), ">u8").astype(np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - ngram + 1].tolist(), ends[ngram - 1:].tolist(), strict=True)
    return np.frombuffer(b"".join([xxh64_digest(joined[a:b], SEED) for a, b in spans]), ">u8").astype(np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint: bit b is set if it is set in over half of the hashes; 0 without hashes."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, place: Column, *, text: str = "text", id_col: str = "doc_id", ngram: int = 3) -> DataFrame:
    """(place, doc_id, fp): ``place`` as in row_places, fp a signed 64-bit integer."""
    short_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in slices(batches):
            fp = [majority(document_hashes(t.as_py(), ngram)) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.array(fp, np.uint64).view(np.int64))], names=["place", "doc_id", "fp"])

    return docs.select(place.alias("place"), F.col(f"`{id_col}`").alias("doc_id"),
                       F.col(f"`{text}`").alias("text")).mapInArrow(run, f"place long, doc_id {kind}, fp long")


def block_masks(radius: int) -> list[int]:
    """Masks of the key bits: every pair of the ``radius + 2`` blocks."""
    cuts = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [x | y for x, y in combinations(blocks, 2)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def within_radius(planes, valid: np.ndarray, radius: int) -> np.ndarray:
    """Lanes of ``valid`` that differ in at most ``radius`` of the difference planes.

    Carry-save counters: bit j of every lane's count is one word-wide
    variable; a lane that overflows them is out for good.
    """
    width = radius.bit_length()
    count = [np.zeros_like(valid) for _ in range(width)]
    out = ~valid
    for n, d in enumerate(planes):
        carry = d
        for j in range(width):
            count[j], carry = count[j] ^ carry, count[j] & carry
        out |= carry
        if n % 8 == 7 and (out == ~np.uint64(0)).all():
            return np.zeros_like(valid)  # abandoned
    for over in range(radius + 1, 1 << width):  # counts that fit the counters but not the radius
        hit = np.full_like(valid, ~np.uint64(0))
        for j in range(width):
            hit &= count[j] if over >> j & 1 else ~count[j]
        out |= hit
    return ~out


def shifted(plane: np.ndarray, s: int, words: int) -> np.ndarray:
    """The first ``words`` words of the plane, lane i holding what lane i + s held."""
    q, r = divmod(s, 64)
    low = plane[q:q + words]
    return low if r == 0 else (low >> np.uint64(r)) | (plane[q + 1:q + 1 + words] << np.uint64(64 - r))


def pack(bits: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words * 64, np.uint8)
    out[: len(bits)] = bits
    return np.packbits(out, bitorder="little").view(np.uint64)


def star_links(fps: np.ndarray, group: np.ndarray, radius: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) for members of ``group`` linked within the radius; ``group`` is sorted.

    ``skip``: bits known to agree inside a group.
    """
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(start, len(group)))
    order = np.argsort(-size, kind="stable")  # large groups first: what a shift still touches is a prefix
    start, size = start[order], size[order]
    lanes = np.concatenate([np.arange(a, a + n) for a, n in zip(start, size, strict=True)])
    x, left = fps[lanes], np.concatenate([np.arange(n, 0, -1) for n in size])  # left: members from here to the group's end
    words = -(-len(x) // 64)
    pad = words * 2 + 2
    planes = [pack((x >> np.uint64(b)).astype(np.uint8) & 1, pad) for b in range(64) if not skip >> b & 1]
    label, prefix = np.arange(len(x)), np.cumsum(size)
    a, b, held = [], [], 0

    def settle():
        nonlocal held
        if a:
            u, v = np.concatenate(a), np.concatenate(b)
            while True:
                m = np.minimum(label[u], label[v])
                if (label[u] == m).all() and (label[v] == m).all():
                    break
                np.minimum.at(label, label[u], m)
                np.minimum.at(label, label[v], m)
                label[:] = label[label]
            # the links are forgotten: from here on every label must be the root itself
            while not (label == label[label]).all():
                label[:] = label[label]
            a.clear(), b.clear()
            held = 0

    for s in range(1, int(size[0])):
        live = int(prefix[np.count_nonzero(size > s) - 1])
        w = -(-live // 64)
        hit = within_radius((p[:w] ^ shifted(p, s, w) for p in planes), pack(left[:live] > s, w), radius)
        if hit.any():
            i = np.flatnonzero(np.unpackbits(hit.view(np.uint8), bitorder="little"))
            i = i[label[i] != label[i + s]]
            a.append(i), b.append(i + s)
            held += len(i)
            if held > 4 * LANES:
                settle()
    settle()
    moved = np.flatnonzero(label != np.arange(len(x)))
    return x[moved], x[label[moved]]


def compare_buckets(rows: DataFrame, radius: int) -> DataFrame:
    """(u, v) star links of the groups (t, key, a, b); ``rows`` is sorted by group and fp inside each partition."""
    masks = block_masks(radius)

    def run(batches):
        held: list[np.ndarray] = []  # columns t, key, pair, fp of groups not yet compared

        def links(cols):
            t, key, pair, fp = cols
            for at in np.unique(t):
                m = t == at
                k, p = key[m], pair[m]
                gid = np.cumsum(np.concatenate(([0], (k[1:] != k[:-1]) | (p[1:] != p[:-1]))))
                u, v = star_links(fp[m].view(np.uint64), gid, radius, masks[int(at)])
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns]
            held = [np.concatenate(x) for x in zip(held, cols, strict=True)] if held else cols
            if len(held[0]) < LANES:
                continue
            t, key, pair, _ = held
            same = (t == t[-1]) & (key == key[-1]) & (pair == pair[-1])
            whole = len(t) if not same.any() else int(np.argmax(same))  # the last group may go on
            if whole:
                yield from links([c[:whole] for c in held])
                held = [c[whole:] for c in held]
        if held and len(held[0]):
            yield from links(held)

    return rows.mapInArrow(run, "u long, v long")


def links_between(nodes: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(u, v) links that connect the fingerprints of ``nodes`` (fp, distinct) within the radius."""
    keys = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
                               for t, m in enumerate(block_masks(radius))]))
    rows = nodes.select("fp", keys.alias("k")).select("fp", "k.t", "k.key")
    buckets = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "t", "key", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    members = rows.join(buckets, ["t", "key"]).withColumn("tile", F.pmod(F.xxhash64(F.lit(5), "fp"), F.col("tiles")).cast("int"))
    # every pair of tiles of a bucket is one group; a bucket of one tile is one group
    other = F.explode(F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(F.filter(
        F.sequence(F.lit(0), F.col("tiles") - 1), lambda y: y != F.col("tile")))).alias("other")
    pair = (F.least("tile", "other").cast("long") * F.col("tiles") + F.greatest("tile", "other")).alias("pair")
    groups = members.select("t", "key", "tile", "tiles", "fp", other).select("t", "key", pair, "fp")
    return compare_buckets(groups.repartition("t", "key", "pair").sortWithinPartitions("t", "key", "pair", "fp"), radius)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node reachable.

    Alternating large-star and small-star steps; a logarithmic number of
    rounds, each one pinned to a table. Roots themselves are not listed.
    """
    def tidy(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = pin(tidy(edges), "links")
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = pin(tidy(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(
            F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        edges = pin(tidy(small), "small-star")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, *, ngram: int = 3, radius: int = 3, text: str = "text",
                    id_col: str = "doc_id", place: Column | None = None) -> DataFrame:
    """(place, doc_id, fp, component_id) for every row of a file scan.

    component_id is the smallest id of all rows whose fingerprints are linked,
    directly or through others, by at most ``radius`` differing bits. Defined
    cases: NULL and empty texts have fingerprint 0 and link like any other;
    fewer words than a shingle make one shingle; repeated rows and repeated
    ids stay rows of their own; NULL ids count only where a component has no
    other (then its component_id is NULL); an empty table gives no rows; other
    columns of ``docs`` are not read.
    """
    place = row_places(docs) if place is None else place
    rows = pin(fingerprints(docs, place, text=text, id_col=id_col, ngram=ngram), "fingerprints")
    nodes = pin(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = connected_components(links_between(nodes, radius))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = pin(named, "rooted")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = pin(named.join(least, "root").select("fp", "component_id", "root"), "classes")
    return rows.join(classes, "fp").select("place", "doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` (a file scan) with one row of every component: the smallest id, then the lowest place."""
    place = row_places(docs)
    found = near_duplicates(docs, place=place, **settings)
    rank = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("place").alias("place"))
    kept = found.groupBy("root").agg(F.min(rank).alias("best")).select(F.col("best.place").alias("_place"))
    rows = docs.select(F.struct("*").alias("row"), place.alias("_place"))
    return rows.join(kept, "_place", "left_semi").select("row.*")


def hex64(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op10_query(spark, sf_dir):
    """Fingerprint and component of every document: 3-word shingles, 3 differing bits."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")
