"""Operators 1, 2 and 8: Poisson mixing, token length histogram, hypergeometric sharding."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from civitas.llm import mixing, sharding, tokens

from .helpers import SCHEMA, awkward_texts, documents, prose, table_of, with_clashes


# ---- mixing

def test_poisson_inversion_has_the_right_distribution(spark):
    n, mean = 20_000, 2.5
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    got = Counter(r["n"] for r in mixing.mix_sources(docs, {"a": 1.0}, epochs=mean).groupBy("doc_id").agg(
        F.first("n_copies").alias("n")).collect())
    got[0] = n - sum(got.values())
    for k in range(6):
        share = math.exp(-mean) * mean ** k / math.factorial(k)
        assert abs(got[k] / n - share) < 5 * math.sqrt(share / n)


def test_sources_reach_their_target_shares(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "small").when(F.col("id") % 100 == 1, "tiny").otherwise("hot").alias("source"))
    n = {r["source"]: r["count"] for r in mixing.mix_sources(docs, {"small": 0.5, "tiny": 0.4, "hot": 0.1}).groupBy("source").count().collect()}
    total = sum(n.values())
    for s, share in {"small": 0.5, "tiny": 0.4, "hot": 0.1}.items():
        assert abs(n[s] / total - share) < 0.02


def test_large_rates_are_split(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    n = mixing.mix_sources(docs, {"a": 1.0}, epochs=500.0).count()
    assert abs(n - 20_000) < 5 * math.sqrt(20_000)


def test_copies_are_numbered_and_repeatable(spark, scratch):
    docs = documents(spark, scratch, awkward_texts())
    a, b = (sorted(map(repr, mixing.mix_sources(docs, epochs=3.0).collect())) for _ in range(2))
    assert a == b
    rows = mixing.mix_sources(docs, epochs=3.0).collect()
    assert {r["source"] for r in docs.collect()} >= {r["source"] for r in rows}
    assert any(r["source"] is None for r in rows) and any(r["text"] is None for r in rows)
    for r in rows:
        assert 1 <= r["copy"] <= r["n_copies"]


def test_mixing_edges(spark, scratch):
    empty = table_of(spark, scratch, [], files=1)
    assert mixing.mix_sources(empty).count() == 0
    one = spark.createDataFrame([(1, "a", "x")], "doc_id long, source string, rate string")
    out = mixing.mix_sources(one, {"a": 1.0}, epochs=9.0)
    assert out.columns == ["doc_id", "source", "rate", "n_copies", "copy"] and dict(out.dtypes)["rate"] == "double"
    assert mixing.mix_sources(one, {}).count() == 0 and mixing.mix_sources(one, {"b": 1.0}).count() == 0


def test_rows_of_one_id_spread(spark, scratch):
    rows = [(7, "same", "en", "s", 4)] * 3000 + [(i, "t", "en", "s", 1) for i in range(100, 6100)]
    docs = table_of(spark, scratch, rows, files=8)
    parts = mixing.mix_sources(docs, epochs=1.0).groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in parts.collect()]
    assert max(sizes) < 3 * sum(sizes) / max(len(sizes), 1) or len(sizes) == 1


# ---- token counts

def expected_sums(lengths):
    total, out = sum(lengths), {}
    for x in set(lengths):
        over = [y for y in lengths if y > x]
        out[x] = (lengths.count(x), len(over), sum(over), len(lengths), total, sum(min(x, y) for y in lengths), 1 - len(over) / len(lengths))
    return out


def test_token_sums_match_brute_force(spark, scratch):
    texts = awkward_texts() + [prose(n, n) for n in range(1, 60, 7)]
    docs = documents(spark, scratch, texts)
    with open(tokens.RANKS_FILE, "rb") as f:
        enc = tokens.encoder(f.read())
    lengths = [len(enc.encode_ordinary(t)) if t else 0 for t in texts]
    sums = tokens.suffix_sums(tokens.length_histogram(with_clashes(docs, "length", "n_docs")))
    got = {r["length"]: tuple(r)[1:] for r in sums.collect()}
    want = expected_sums(lengths)
    assert got.keys() == want.keys()
    for x, w in want.items():
        assert got[x][:6] == w[:6] and got[x][6] == pytest.approx(w[6])
    order = sorted(lengths)
    for r in tokens.quantiles(sums, [0.1, 0.5, 0.9, 1.0]).collect():
        assert r["length"] == order[math.ceil(r["share"] * len(order) - 1e-9) - 1]
    for r in tokens.at_limits(sums, [0, 3, 100, 10 ** 9]).collect():
        assert r["tokens_truncated"] == sum(min(x, r["context"]) for x in lengths)
        assert r["docs_over"] == sum(x > r["context"] for x in lengths)


def test_token_sums_of_nothing(spark, scratch):
    assert tokens.suffix_sums(tokens.length_histogram(table_of(spark, scratch, [], files=1))).count() == 0


# ---- sharding

def check_shards(rows, n, n_shards):
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == n and set(sizes) <= set(range(n_shards))
    assert sorted((sizes[s] for s in range(n_shards)), reverse=True) == sharding.shard_sizes(n, n_shards)
    for s in range(n_shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


@pytest.mark.parametrize(("n", "shards", "files"), [(1000, 24, 7), (5, 24, 2), (333, 3, 1)])
def test_exact_sizes_and_slots(spark, scratch, n, shards, files):
    docs = table_of(spark, scratch, [(i % 50, "t", "en", "s", 1) for i in range(n)], files=files)
    rows = sharding.shard_rows(with_clashes(docs, "p", "place", "slot"), shards, group_size=2, block_rows=8).collect()
    check_shards(rows, n, shards)
    assert Counter(r["doc_id"] for r in rows) == Counter(i % 50 for i in range(n))


def test_no_row_is_lost_when_scans_are_cut_anew(spark, scratch, recut):
    docs = table_of(spark, scratch, [(i, "t", "en", "s", 1) for i in range(1000)], files=7)
    recut(sharding)
    rows = sharding.shard_rows(docs, 24, group_size=2, block_rows=8).collect()
    check_shards(rows, 1000, 24)
    assert sorted(r["doc_id"] for r in rows) == list(range(1000))


def test_sharding_is_repeatable_and_keeps_awkward_rows(spark, scratch):
    docs = documents(spark, scratch, awkward_texts())
    a, b = (sorted(map(repr, sharding.shard_rows(docs, 4).collect())) for _ in range(2))
    assert a == b and len(a) == len(awkward_texts())
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.parquet(scratch + "-empty")
    assert sharding.shard_rows(spark.read.parquet(scratch + "-empty"), 4).count() == 0


def test_shuffle_is_uniform(spark, scratch):
    """Rows of one input file land in every shard alike (chi square), and slots do not follow the input order."""
    n, shards = 8000, 8
    docs = table_of(spark, scratch, [(i, "t", "en", "s", 1) for i in range(n)], files=4)
    rows = sharding.shard_rows(docs, shards).collect()
    table = np.zeros((4, shards))
    for r in rows:
        table[r["doc_id"] * 4 // n, r["shard"]] += 1
    want = table.sum(axis=1, keepdims=True) / shards
    assert ((table - want) ** 2 / want).sum() < 21 + 6 * math.sqrt(42)
    one = [r["doc_id"] for r in sorted(rows, key=lambda r: r["slot"]) if r["shard"] == 0]
    assert abs(np.corrcoef(range(len(one)), one)[0, 1]) < 0.12


def test_matrix_draws():
    rng = np.random.default_rng(1)
    room = [30, 0, 20, 50]
    for n in (0, 1, 60, 100):
        take = sharding.draw_row(rng, room, n)
        assert sum(take) == n and all(0 <= a <= b for a, b in zip(take, room, strict=True))
    small = [sharding.hypergeometric(rng, 600, 400, 50) for _ in range(4000)]
    assert abs(np.mean(small) - 30) < 0.3
    # beyond numpy's range: mean n * good / total, variance of the hypergeometric distribution
    big = [sharding.hypergeometric(rng, 3 * 10 ** 9, 10 ** 9, 10 ** 6) for _ in range(2000)]
    assert abs(np.mean(big) - 750_000) < 5 * math.sqrt(187_500 / 2000)
    assert 0.8 < np.var(big) / 187_453 < 1.2


def test_long_runs_encode_as_the_whole():
    import random
    with open(tokens.RANKS_FILE, "rb") as f:
        enc = tokens.encoder(f.read())
    rng = random.Random(3)
    short = tokens.long_runs(3)
    for _ in range(400):
        text = "".join(rng.choice(["a", "Bc", " ", "  ", "    ", "\n\n\n", "\t \t ", "\u3000" * 4, "!?", "12", "'s", "\x1c" * 4, "é"]) for _ in range(rng.randint(0, 12)))
        assert tokens.count_tokens(enc, short, text) == len(enc.encode_ordinary(text)), repr(text)
    for kind in (" ", "a", "!", "\n", "é"):
        for text in (kind * 2_000_000, "x" + kind * 2_000_000 + "y", kind * 150_000 + "z " + kind * 150_000):
            n = tokens.count_tokens(enc, tokens.long_runs(), text)
            assert n > 10_000
            if len(text) < 400_000:
                assert n == len(enc.encode_ordinary(text))
