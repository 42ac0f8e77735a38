"""Language identification against plain Python counting, and on held-out labels."""

from collections import Counter
from math import log, sqrt

import numpy as np
import pytest
from pyspark.sql import functions as F

from civitas.llm import langid
from tests.llm.helpers import awkward_texts, documents, with_clashes

FOLD = langid.fold_table()


def plain_grams(text):
    """N-gram counts by hand: single letters and triples over blank-separated runs of letters."""
    folded = "".join(chr(FOLD[ord(c)]) if c != "\0" else " " for c in text)
    line = " " + " ".join(folded.split(" ")) + " "
    while "  " in line:
        line = line.replace("  ", " ")
    n = Counter(c for c in line if c != " ")
    return n + Counter(line[i:i + 3] for i in range(len(line) - 2))


def name(gram):
    return ord(gram) if len(gram) == 1 else ord(gram[0]) << 42 | ord(gram[1]) << 21 | ord(gram[2])


@pytest.mark.parametrize("batch", [1 << 19, 64, 7])
def test_counts(monkeypatch, batch):
    monkeypatch.setattr(langid, "BATCH", batch)
    texts = [t[:4000] if t else "" for t in awkward_texts()] + ["a\0b", "Ⅷ x ẞ İ ﬁ", "नमस्ते दुनिया", "   ", "x" * 30 + " " * 30 + "y", "a b c d e f g h i j"]
    counter = langid.Counter(FOLD)
    for _ in range(2):                              # with an empty and with a filled lexicon
        text, number, count, letters = counter.count(texts)
        codes = counter.lexicon.codes
        for i, t in enumerate(texts):
            want = {name(g): n for g, n in plain_grams(t).items()}
            assert {int(codes[k]): int(n) for k, n in zip(number[text == i], count[text == i], strict=True)} == want, t
            assert letters[i] == sum(n for g, n in plain_grams(t).items() if len(g) == 1)
    assert (np.diff(text) >= 0).all()


def test_lexicon_is_exact():
    rng = np.random.default_rng(0)
    codes = np.unique(rng.integers(1, 1 << 62, 5000).astype(np.uint64))
    known = langid.Lexicon(codes[::2])
    assert (known.find(codes[::2]) == np.arange(len(codes[::2]))).all() and (known.find(codes[1::2]) == -1).all()
    assert langid.Lexicon(codes[:0]).find(codes).max() == -1


def test_prediction_by_hand(spark, scratch):
    """Scores of a fitted model, with document frequencies and cosines worked out in plain Python."""
    texts = ["the house and the garden", "the cat and the dog", "das haus und der garten", "der hund und die katze", None, "", "der the"]
    df = spark.createDataFrame([(i, t, ["en", "en", "de", "de", "en", "de", None][i]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    df = with_clashes(df, "h", "n", "code", "score", "_text", "row")
    model = langid.fit(df, centroids=2, features=10_000)
    taught = [t for t in texts[:4]]
    df_of = Counter(g for t in taught for g in plain_grams(t))
    assert dict(zip(model.codes.tolist(), np.round(model.idf, 12), strict=True)) == {
        name(g): round(log(5 / (1 + n)) + 1, 12) for g, n in df_of.items()}
    idf = {name(g): log(5 / (1 + n)) + 1 for g, n in df_of.items()}

    def vector(t):
        w = {name(g): (1 + log(n)) * idf[name(g)] for g, n in plain_grams(t).items() if name(g) in idf}
        norm = sqrt(sum(x * x for x in w.values()))
        return {g: x / norm for g, x in w.items()}

    got = {r["doc_id"]: r for r in langid.with_language(df, model).collect()}
    for i in (0, 1, 2, 3, 6):                       # every taught text is a centroid of its own here
        cosine = {j: sum(x * vector(taught[j]).get(g, 0) for g, x in vector(texts[i]).items()) for j in range(4)}
        best = max(cosine, key=cosine.get)
        assert abs(got[i]["score"] - cosine[best]) < 1e-9
        assert got[i]["lang_pred"] == ["en", "en", "de", "de"][best]
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["rejected"] for i in (4, 5))
    foreign = langid.with_language(spark.createDataFrame([("日本語",), ("123 !?",)], "text string"), model).collect()
    assert (foreign[0]["lang_pred"], foreign[0]["score"], foreign[0]["rejected"]) == ("en" if model.common == "en" else "de", 0.0, True)
    assert foreign[1]["lang_pred"] == "und"


def test_edges(spark, scratch):
    docs = documents(spark, scratch, awkward_texts())
    model = langid.fit(docs)
    out = langid.with_language(docs, model)
    assert out.columns == [*docs.columns, "lang_pred", "score", "rejected"] and out.count() == len(awkward_texts())
    assert {r["lang_pred"] for r in out.collect()} == {"en", "und"}
    untaught = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in langid.with_language(docs, untaught).collect()} == {("und", 0.0)}
    assert langid.with_language(docs.limit(0), langid.fit(docs.limit(0))).count() == 0


def test_flushed_counts(spark, scratch, monkeypatch):
    """Document frequencies do not depend on how often a task hands its counts on."""
    docs = documents(spark, scratch, awkward_texts() + [f"text {chr(97 + i % 26)} number {chr(98 + i % 20)}" for i in range(600)])
    whole = langid.fit(docs, features=10_000)
    monkeypatch.setattr(langid, "LEXICON", 1)
    split = langid.fit(docs, features=10_000)
    assert whole.codes.tolist() == split.codes.tolist() and np.allclose(whole.idf, split.idf)


def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.01"
    out = langid.op12_query(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n, und = out.filter("held_out AND lang IS NOT NULL").agg(
        F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.sum((F.col("lang_pred") == "und").cast("int"))).first()
    assert n > 200 and right >= 0.97 * n and und == 0
