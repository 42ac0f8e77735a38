"""Operator 4 against brute force."""

import hashlib
import re

from civitas.llm import decontam

from .helpers import awkward_texts, documents, prose, table_of, with_clashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(FOLD))


def brute(texts, items, width=10):
    out = []
    for t in texts:
        w, hit, who = words(t), set(), set()
        for i, item in items:
            v = words(item)
            k = min(width, len(v))
            for win in {tuple(v[a:a + k]) for a in range(len(v) - k + 1)} if v else ():
                for a in range(len(w) - k + 1):
                    if tuple(w[a:a + k]) == win:
                        hit.update(range(a, a + k))
                        who.add("null" if i is None else str(i))
        out.append((len(w), len(hit), tuple(sorted(who)), bool(hit)))
    return out


ITEMS = [(1, prose(40, 21)), (2, prose(10, 22)), (3, "Short item"), (4, "one"), (5, None), (6, ""), (7, "Élan vital ÄÖ x"),
         (8, prose(25, 1)), (None, prose(12, 23)), (10, prose(40, 21)), (11, "...")]


def planted():
    a, b = prose(40, 21), prose(10, 22)
    return [*awkward_texts(), prose(50, 31) + " " + a + " " + prose(20, 32), b.upper(), a[:len(a) // 2] + "; " + b,
            " ".join(a.split()[:9]), " ".join(a.split()[3:13]), "x short, ITEM y", "élan vital äö x", "Élan vital ÄÖ X", a + " " + a, a + " " + a]


def test_matches_brute_force(spark, scratch):
    texts = planted()
    docs = documents(spark, scratch, texts)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.find_contamination(with_clashes(docs, "words", "window", "th"), with_clashes(items, "shingle", "k")).collect()
    want = brute(texts, ITEMS)
    by_id = {r["doc_id"]: r for r in docs.collect()}
    assert len(got) == len(texts)
    assert sorted((r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in got) == sorted(want)
    for r in got:
        if r["doc_id"]:
            assert (r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) == brute([by_id[r["doc_id"]]["text"]], ITEMS)[0]


def test_shuffle_join_beyond_the_broadcast_bound(spark, scratch, monkeypatch):
    monkeypatch.setattr(decontam, "bounded", lambda df, rows=0: df)
    texts = planted()
    got = decontam.find_contamination(documents(spark, scratch, texts), spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    assert sorted((r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in got) == sorted(brute(texts, ITEMS))


def test_edges_and_filter(spark, scratch):
    texts = planted()
    docs = documents(spark, scratch, texts)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_contamination(docs, none).filter("contaminated").count() == 0
    empty = table_of(spark, scratch + "-e", [], files=1)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.find_contamination(empty, items).count() == 0
    kept = decontam.drop_contaminated(with_clashes(docs, "th", "row"), items)
    clean = [t for t, b in zip(texts, brute(texts, ITEMS), strict=True) if not b[3]]
    assert sorted(map(repr, (r["text"] for r in kept.collect()))) == sorted(map(repr, clean))
    assert kept.columns == [*docs.columns, "th", "row"]


def test_digest(spark, scratch):
    docs = documents(spark, scratch + "/documents.parquet", planted())
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(scratch + "/benchmark.parquet")
    for r in decontam.op4_query(spark, scratch).collect():
        if r["n_items"] == 0:
            assert r["items_sha256"] == hashlib.sha256(b"").hexdigest()
    assert docs.count() == decontam.op4_query(spark, scratch).count()
