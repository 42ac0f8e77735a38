"""Hard negatives and whitening against brute force in plain numpy."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from civitas.llm import negatives, whitening
from tests.llm.helpers import table_of, with_clashes

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType())])


def rows_of(n, d, seed=0, labels=3):
    """Random rows; a third are one vector, some repeat, some have a null or a non-finite entry, some are shorter."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[rng.random(n) < 0.33] = x[0]
    rows = [(i, [float(c) for c in v], int(rng.integers(labels))) for i, v in enumerate(x)]
    rows += rows[:4]
    rows += [(None, rows[5][1], 0), (n, None, 1), (n + 1, [], 1), (n + 2, [1.0, None] + [0.0] * (d - 2), 1), (n + 3, [math.nan] * d, 0),
             (n + 4, [math.inf] + [0.0] * (d - 1), 2), (n + 5, rows[7][1][:d - 1], 1), (n + 6, rows[8][1], None)]
    return rows


def usable(rows, d):
    return [(i, list(v) + [0.0] * (d - len(v)), y) for i, v, y in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def test_hilbert_neighbours():
    for d, bits in ((2, 3), (3, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        walk = cells[sorted(range(len(cells)), key=dict(enumerate(negatives.hilbert(cells, bits))).get)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
    assert negatives.hilbert(np.zeros((0, 2)), 2) == [] and negatives.hilbert(np.zeros((2, 0)), 2) == [b"", b""]


def test_bounds_hold_every_product():
    rng = np.random.default_rng(1)
    a, x = rng.integers(-9, 9, (20, 5)), rng.integers(-9, 9, (30, 5))
    least, most = negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    s = a @ x.T
    assert (least[:, 0] <= s.min(axis=1)).all() and (s.max(axis=1) <= most[:, 0]).all()
    big = np.array([[1 << 30, 3]])
    assert negatives.dot(big, big)[0, 0] == (1 << 60) + 9
    with pytest.raises(ValueError):
        negatives.dot(big * 4, big)


def brute_negatives(rows, d, anchor_every=10, positives=2, negatives=3):
    ok = [(i, y, [math.floor(256 * c) for c in v]) for i, v, y in usable(rows, d) if y is not None]
    last, out = float("inf"), []
    for a, (i, y, x) in enumerate(ok):
        if i is None or i % anchor_every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, v, strict=True)), last if j is None else j, r, j, z == y)
                        for r, (j, z, v) in enumerate(ok) if r != a)
        for p in [s for s in scored if s[4]][:positives]:
            fit = [s for s in scored if not s[4] and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]][:negatives]
            out += [(i, p[3], r + 1, s[3], -p[0], -s[0]) for r, s in enumerate(fit)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"block": 4, "page": 3, "tile": 2, "chunk": 4, "every": 2}, {"block": 7, "every": 1}])
def test_hard_negatives(spark, scratch, sizes):
    d, rows = 6, rows_of(90, 6)
    df = with_clashes(table_of(spark, scratch, rows, SCHEMA), "place", "score", "rank", "block", "v", "w")
    got = negatives.hard_negatives(df, anchor_every=10, positives=2, negatives=3, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_negatives(rows, d)


def test_zone_maps_leave_blocks_out(spark, scratch):
    """Two far clusters: an anchor's windows read no block of the other cluster."""
    rows = [(i, [8.0, 0.1 * (i % 7)] if i % 2 else [-8.0, 0.1 * (i % 5)], i % 4 // 2) for i in range(64)]
    df = table_of(spark, scratch, rows, SCHEMA).selectExpr("vec_id AS id", "CAST(label AS LONG) AS label", "CAST(embedding AS array<double>) AS v")
    from civitas.llm.common import pin
    found = negatives.Candidates(pin(df.selectExpr("*", "monotonically_increasing_id() AS place"), "t"), anchor_every=100, block=4)
    zones = found.zones.collect()
    anchor = np.array([[-8 * 256, 0]])
    hits = 0
    for z in zones:
        low, high = (np.frombuffer(z[c], np.int64)[None] for c in ("low", "high"))
        hits += negatives.bounds(anchor, low, high)[1][0, 0] > 0
    assert 0 < hits <= len(zones) * 0.6


def test_hard_negatives_without_rows(spark, scratch):
    assert negatives.hard_negatives(table_of(spark, scratch, [], SCHEMA, files=1)).count() == 0
    only = table_of(spark, scratch + "-2", [(0, [1.0], 1), (1, None, 2)], SCHEMA)
    assert negatives.hard_negatives(only).count() == 0


def test_rank_one_updates_match_a_decomposition():
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(400, 12)) * 50)
    x[:150] = x[0]
    x[:, 3] = 7                                     # no variance
    x[:, 5] = x[:, 4]                               # equal entries
    scatter = np.cov(x.T, bias=True) * len(x)
    for chunk in (1, 5, 4096):
        s = whitening.Spectrum.empty(12)
        s.add_rows(x[:100], chunk)
        other = whitening.Spectrum.empty(12)
        other.add_rows(x[100:], chunk)
        s.add(other)
        assert s.n == 400 and np.allclose(s.mean, x.mean(axis=0))
        assert np.allclose(s.vectors @ np.diag(s.values) @ s.vectors.T, scatter, atol=1e-9 * np.abs(scatter).max())
        assert np.allclose(s.vectors.T @ s.vectors, np.eye(12), atol=1e-10)


@pytest.mark.parametrize("fan", [2, 16])
def test_whitening(spark, scratch, monkeypatch, fan):
    monkeypatch.setattr("civitas.llm.vectors.FAN", fan)
    d, rows = 6, rows_of(90, 6, seed=4)
    df = with_clashes(table_of(spark, scratch, rows, SCHEMA, files=5), "v", "state", "whitened", "row", "_v")
    model = whitening.fit(df, components=4, chunk=3)
    got = whitening.whiten(df, model)
    assert set(got.columns) == {*df.columns, "deviation"}
    kept = usable(rows, d)
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v, _ in kept])
    v = np.cov(x.T, bias=True)
    e = np.sort(np.linalg.eigvalsh(v))[::-1]
    assert model.n == len(kept) and model.sums.tolist() == x.sum(axis=0).tolist()
    assert np.allclose(model.values, e[:4], rtol=1e-12) and np.isclose(model.trace, np.trace(v), rtol=1e-12)
    assert np.allclose(v @ model.vectors, model.vectors * model.values, atol=1e-9 * e[0])
    assert model.identity_error < 1e-10
    want = sorted((str(i), tuple(np.round((r - x.mean(axis=0)) @ model.vectors / np.sqrt(model.values), 6)),
                   sum((len(x) * int(c) - int(s)) ** 2 for c, s in zip(r, x.sum(axis=0), strict=True))) for (i, _, _), r in zip(kept, x, strict=True))
    have = sorted((str(r["vec_id"]), tuple(np.round(r["whitened"], 6)), int(r["deviation"])) for r in got.collect())
    assert [w[0::2] for w in want] == [h[0::2] for h in have]
    assert np.allclose([w[1] for w in want], [h[1] for h in have], atol=1e-5)


def test_whitening_edges(spark, scratch):
    none = table_of(spark, scratch, [], SCHEMA, files=1)
    assert whitening.fit(none) is None and whitening.whiten(none, None).count() == 0
    one = table_of(spark, scratch + "-1", [(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)], SCHEMA)
    model = whitening.fit(one)
    assert len(model.values) == 0 and [r["whitened"] for r in whitening.whiten(one, model).collect()] == [[], []]
    empty = table_of(spark, scratch + "-2", [(1, [], 0)], SCHEMA, files=1)
    assert whitening.fit(empty) is None
    far = whitening.Whitening(10**9, np.array([5 * 10**9]), 1, 0, np.eye(1), np.ones(1), 1.0)
    assert far.deviation(np.array([[10**6]])) == [(10**15 - 5 * 10**9) ** 2]
