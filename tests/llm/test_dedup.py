"""Operators 6 and 10 against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from civitas.llm import simhash, suffix

from .helpers import awkward_texts, documents, prose, table_of, with_clashes


def utf8(t):
    return (t or "").encode()


# ---- repeated 400-byte strings

def brute_cut(texts, length):
    count = {}
    for t in texts:
        b = utf8(t)
        for p in range(len(b) - length + 1):
            count[b[p:p + length]] = count.get(b[p:p + length], 0) + 1
    out = []
    for t in texts:
        b = utf8(t)
        keep = np.ones(len(b), bool)
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                keep[p:p + length] = False
        edge = np.diff(np.concatenate(([0], (~keep).astype(int), [0])))
        out.append((len(b), int((~keep).sum()), int((edge == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[keep].tobytes()).hexdigest()))
    return out


def cut(spark, path, texts, length=400):
    docs = documents(spark, path, texts)
    got = suffix.dedup_repeats(with_clashes(docs, "place", "g", "runs"), length=length).collect()
    return sorted((r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got)


def test_removal_matches_brute_force(spark, scratch):
    passage = prose(75, 41)
    texts = [t for t in awkward_texts() if len(t or "") < 10_000] + [
        prose(60, 42) + passage + prose(40, 43), passage + prose(30, 44), prose(90, 45) + passage[:430], passage[100:505],
        "ab" * 700, "x" * 450, "x" * 400, "é" * 500, prose(300, 46) * 2, prose(65, 47), prose(65, 47)[:399]]
    assert cut(spark, scratch, texts) == sorted(brute_cut(texts, 400))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_overlaps(spark, scratch, seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    texts = []
    for _ in range(40):
        a = rng.randrange(5000)
        texts.append("".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(300))) + base[a:a + rng.randrange(300, 900)]
                     + "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(300))))
    assert cut(spark, scratch, texts) == sorted(brute_cut(texts, 400))


def test_chunk_borders(spark, scratch, monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK", 512)
    texts = [prose(600, 51), prose(200, 52) + prose(600, 51)[700:2600], "y" * 3000]
    assert cut(spark, scratch, texts) == sorted(brute_cut(texts, 400))


def test_nothing_to_cut(spark, scratch):
    assert suffix.dedup_repeats(table_of(spark, scratch, [], files=1)).count() == 0
    assert cut(spark, scratch + "-b", [None, "", "short"]) == sorted(brute_cut([None, "", "short"], 400))


# ---- SimHash

def fingerprint(t, n=3):
    w = utf8(t).lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + n]), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, fps, radius):
    label = list(range(len(fps)))
    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    least = {}
    for i, x in enumerate(ids):
        r = find(i)
        least[r] = min((y for y in (least.get(r), x) if y is not None), default=None)
    return [least[find(i)] for i in range(len(fps))]


def near_texts():
    base = prose(400, 61).split()
    out = [" ".join(base)]
    for i in range(60):
        w = list(base)
        w[(i * 37) % 400] = f"edit{i}"
        out.append(" ".join(w))
    return awkward_texts() + out + [prose(300, 70 + i) for i in range(40)]


def test_components_match_brute_force(spark, scratch):
    docs = documents(spark, scratch, near_texts())
    rows = docs.collect()
    got = simhash.near_duplicates(with_clashes(docs, "fp", "place", "root", "t", "key"))
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["fp"] & (2 ** 64 - 1), r["component_id"]) for r in got.collect())
    fps = [fingerprint(r["text"]) for r in rows]
    want = components([r["doc_id"] for r in rows], fps, 3)
    assert got == sorted((-1 if r["doc_id"] is None else r["doc_id"], f, c) for r, f, c in zip(rows, fps, want, strict=True))


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_links_of_dense_and_split_buckets(spark, radius):
    """Clusters around a few centres, small tiles: the links connect what brute force connects."""
    rng = random.Random(radius)
    fps = set()
    for _ in range(6):
        c = rng.getrandbits(64)
        fps.update(c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (2 ** 64 - 1) for _ in range(60))
    fps = sorted(f & (2 ** 64 - 1) for f in fps)
    nodes = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.connected_components(simhash.links_between(nodes, radius, tile=16)).collect()}
    got = [roots.get(simhash.signed(f), simhash.signed(f)) for f in fps]
    want = components([simhash.signed(f) for f in fps], fps, radius)
    assert got == want


def test_lanes_and_counters():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    for radius in (1, 2, 3, 5):
        group = np.repeat(np.arange(30), 10)
        x[1::2] = x[::2] ^ (np.uint64(1) << rng.integers(0, 60, 150, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 60, 150, dtype=np.uint64))
        u, v = simhash.star_links(x.copy(), group, radius)
        for g in range(30):
            m = x[group == g]
            want = components(list(range(10)), [int(y) for y in m], radius)
            link = {int(a): int(b) for a, b in zip(u, v, strict=True) if int(a) in set(map(int, m))}
            assert [int(m[w]) for w in want] == [link.get(int(y), int(y)) for y in m]


def test_links_settled_in_many_batches(monkeypatch):
    """No link is lost when the links met so far are settled after each shift.

    A chain w - x - r - v - p - q of neighbours that differ in one bit: v-p and x-r are met first, then r-v and
    p-q in one batch (which leaves x two steps from its root), then x-w.
    """
    monkeypatch.setattr(simhash, "LANES", 0)
    rng = random.Random(7)
    x = np.array([rng.getrandbits(64) for _ in range(28)], np.uint64)
    for k, at in enumerate((0, 27, 24, 14, 12, 2)):
        x[at] = (1 << k) - 1
    u, v = simhash.star_links(x, np.zeros(len(x), np.int64), 1)
    assert {int(a): int(b) for a, b in zip(u, v, strict=True)} == {(1 << k) - 1: 0 for k in range(1, 6)}


def test_rows_keep_their_places_when_scans_are_cut_anew(spark, scratch, recut):
    docs = documents(spark, scratch, near_texts(), files=5)
    rows = docs.collect()
    recut(simhash, suffix)
    want = set(components([r["doc_id"] for r in rows], [fingerprint(r["text"]) for r in rows], 3))
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == sorted(want)
    texts = [t for t in near_texts() if len(t or "") < 10_000]
    assert cut(spark, scratch + "-c", texts) == sorted(brute_cut(texts, 400))


def test_keep_one_and_edges(spark, scratch):
    docs = documents(spark, scratch, near_texts())
    kept = simhash.keep_one(with_clashes(docs, "fp", "row"))
    rows = docs.collect()
    want = set(components([r["doc_id"] for r in rows], [fingerprint(r["text"]) for r in rows], 3))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    assert kept.columns == [*docs.columns, "fp", "row"]
    twice = table_of(spark, scratch + "-t", [(1, "same text here", "en", "s", 1)] * 5 + [(None, "", "en", "s", 0)] * 2)
    assert sorted(map(repr, (r["doc_id"] for r in simhash.keep_one(twice).collect()))) == ["1", "None"]
    empty = table_of(spark, scratch + "-e", [], files=1)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_long_chains_join(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (300, 300)], "u long, v long")
    got = {r["node"]: r["root"] for r in simhash.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 101)}, 201: 200}
