"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. Count the rows of every piece of a file (512 positions in a row).
2. Draw the matrix piece x shard: how many rows each piece sends to each
   shard, given that every shard takes an exact number. Drawn in two levels
   -- groups of pieces on the driver, pieces inside a group in tasks -- so
   the driver holds one short row per ``group_size`` pieces.
3. Permute each piece locally (order by a seeded hash of the place) and cut
   the permuted rows by the piece's row of the matrix.
4. Exchange, and permute each shard again: rows fall into hash blocks, are
   numbered inside the block, and blocks are laid one after the other.

Rows are told apart by their place (file and position in it), which every job
over the immutable files reproduces however Spark cuts them; contents play no
part, so equal rows or one hot key cannot overload a piece or shard.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, pin, row_places, table, unpacked

SEED = 2024
PIECE_BITS = 9      # places that differ in these low bits only are one piece


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """An exact hypergeometric draw of any size (numpy's stops at 10**9)."""
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    if good < 10 ** 9 and bad < 10 ** 9:
        return int(rng.hypergeometric(good, bad, n))
    # ratio of uniforms around the mode, with log factorials
    total, lg = good + bad, math.lgamma
    low, high = max(0, n - bad), min(good, n)
    mode = (n + 1) * (good + 1) // (total + 2)

    def logp(k):
        return -(lg(k + 1) + lg(good - k + 1) + lg(n - k + 1) + lg(bad - n + k + 1))

    top = logp(mode)
    spread = math.sqrt(n * (good / total) * (bad / total) * (total - n) / (total - 1)) + 1.0
    width = 2 * math.sqrt(2 / math.e) * (spread + 0.5) + 3 - 2 * math.sqrt(3 / math.e)
    while True:
        u, v = rng.random(), rng.random()
        k = math.floor(mode + 0.5 + width * (v - 0.5) / max(u, 1e-300))
        if low <= k <= high and 2 * math.log(max(u, 1e-300)) <= logp(k) - top:
            return int(k)


def draw_row(rng: np.random.Generator, room: list[int], n: int) -> list[int]:
    """How many of ``n`` rows go to each shard, given the room left in each."""
    rest, out = sum(room), []
    for r in room:
        k = hypergeometric(rng, r, rest - r, n)
        out.append(k)
        rest, n = rest - r, n - k
    return out


def shard_sizes(total: int, n_shards: int) -> list[int]:
    return [total // n_shards + (s < total % n_shards) for s in range(n_shards)]


def communication_matrix(counts: DataFrame, n_shards: int, seed: int, group_size: int) -> DataFrame:
    """(p, cut): for each piece the running totals of its row of the matrix."""
    spark = counts.sparkSession
    n_groups = max(1, math.ceil(counts.count() / group_size))
    counts = pin(counts.withColumn("g", F.pmod(F.xxhash64(F.lit(seed), "p"), F.lit(n_groups))), "shard-counts")
    groups = counts.groupBy("g").agg(F.sum("n").alias("n")).orderBy("g").collect()  # one row per group_size pieces
    room, rng, quotas = shard_sizes(sum(r["n"] for r in groups), n_shards), np.random.default_rng(seed), []
    for r in groups:
        take = draw_row(rng, room, r["n"])
        room = [a - b for a, b in zip(room, take, strict=True)]
        quotas.append((r["g"], take))
    quota = spark.createDataFrame(quotas, "g long, quota array<long>")

    def within(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("p")
        room = [int(x) for x in pdf["quota"].iloc[0]]
        rng, cuts = np.random.default_rng([seed, 1, int(pdf["g"].iloc[0])]), []
        for n in pdf["n"]:
            take = draw_row(rng, room, int(n))
            room = [a - b for a, b in zip(room, take, strict=True)]
            cuts.append(np.cumsum(take).tolist())
        return pd.DataFrame({"p": pdf["p"].to_numpy(), "cut": cuts})

    return counts.join(quota, "g").groupBy("g").applyInPandas(within, "p long, cut array<long>")


def assign_shards(places: DataFrame, n_shards: int, seed: int = SEED, group_size: int = 256,
                  block_rows: int = 4096) -> DataFrame:
    """(place, shard, slot) for every row of ``places``, the places of a file scan."""
    places = places.select(F.shiftright("place", PIECE_BITS).alias("p"), "place")
    counts = pin(places.groupBy("p").agg(F.count(F.lit(1)).alias("n")), "shard-pieces")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    cuts = pin(communication_matrix(counts, n_shards, seed, group_size), "shard-matrix")
    local = Window.partitionBy("p").orderBy(F.xxhash64(F.lit(seed), "place"), "place")
    dealt = places.join(cuts, "p").withColumn("r", F.row_number().over(local) - 1).select(
        "place", F.size(F.filter("cut", lambda c: c <= F.col("r"))).alias("shard"))
    blocks = max(1, math.ceil(total / n_shards / block_rows))
    dealt = pin(dealt.withColumn("mix", F.xxhash64(F.lit(seed + 1), "place"))
                .withColumn("block", F.pmod("mix", F.lit(blocks)).cast("int")), "shard-dealt")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "block").orderBy("mix", "place")
    return dealt.join(starts, ["shard", "block"]).select(
        "place", "shard", (F.col("start") + F.row_number().over(inside) - 1).alias("slot"))


def shard_rows(rows: DataFrame, n_shards: int = 24, *, seed: int = SEED, group_size: int = 256,
               block_rows: int = 4096, layout_rows: int = 1024, layout: bool = True) -> DataFrame:
    """Every row with its ``shard`` (0 to n_shards - 1) and ``slot`` (0 upward, without gaps).

    ``rows`` must be a scan of files, columns added or dropped but not
    filtered, joined or sorted: its row places are then the same each time it
    is read. Shard sizes differ by at most one row. With ``layout`` the rows
    are also moved so that runs of ``layout_rows`` slots of a shard stand
    together, in slot order.

    Defined cases: NULLs, empty texts and repeated rows are rows like any
    other; an empty table gives no rows; columns called shard or slot are
    replaced.
    """
    place = row_places(rows).alias("place")
    where = assign_shards(rows.select(place), n_shards, seed, group_size, block_rows)
    out = packed(rows, place).join(where, "place")
    if layout:
        out = (out.repartition("shard", F.floor(F.col("slot") / layout_rows))
               .sortWithinPartitions("shard", "slot"))
    return unpacked(out, shard=F.col("shard"), slot=F.col("slot"))


def op8_query(spark, sf_dir):
    """All ``documents`` into 24 shards under the law ``rows``."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard_rows(rows, 24, layout=False).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
