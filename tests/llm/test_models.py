"""Operators 3, 5 and 9: held-out accuracy, brute-force statistics, awkward rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from civitas.llm import quality, rules, toxicity

from .helpers import LABELS, awkward_texts, documents, prose, table_of, with_clashes


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def corpus(spark, path, n=600):
    """Half of the documents are junk of four kinds; a fifth is toxic, some only by inflected stems."""
    rows, labels = [], []
    for i in range(n):
        t, good, toxic = prose(60 + i % 90, 1000 + i), 1, 0
        if i % 4 == 1:
            good = 0
            kind = i // 4 % 4
            w = t.split()
            t = [" ".join(x + "&&&$" for x in w), " ".join(w).upper() + "!!", " | ".join(w), " ".join(w[:6] * 14)][kind]
        if i % 5 == 2:
            toxic = 1
            w = t.split()
            w[len(w) // 2:len(w) // 2] = ["you", "blorg" if i % 2 else f"grunk{'abcdefg'[i % 7]}{'xyz'[i % 3]}"]
            t = " ".join(w)
        rows.append((i, t, "en", "s", len(t)))
        if i % 7:
            labels.append((i, good, toxic))
    return table_of(spark, path, rows), spark.createDataFrame(labels, LABELS), {a: (b, c) for a, b, c in labels}


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    return corpus(spark, str(tmp_path_factory.mktemp("corpus") / "d"))


def test_quality_on_held_out_labels(spark, trained):
    docs, labels, truth = trained
    got = quality.with_score(docs, quality.fit(docs, labels)).collect()
    right = [(r["score"] >= 0.3) == truth[r["doc_id"]][0] for r in got if r["doc_id"] in truth and is_held_out(r["doc_id"])]
    assert len(right) > 50 and np.mean(right) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_toxicity_on_held_out_labels(spark, trained):
    docs, labels, truth = trained
    model = toxicity.fit(docs, labels)
    assert {"blorg$", "grunk"} <= set(model.lexicon.weights)
    got = toxicity.with_score(docs, model).collect()
    right = [(r["score"] >= 0.5) == truth[r["doc_id"]][1] for r in got if r["doc_id"] in truth and is_held_out(r["doc_id"])]
    assert np.mean(right) > 0.97


def test_rules_on_held_out_labels(spark, trained):
    docs, labels, truth = trained
    learned = rules.fit_rules(docs, labels)
    assert learned
    got = rules.apply_rules(docs, learned).collect()
    right = [(r["rule"] == 0) == truth[r["doc_id"]][0] for r in got if r["doc_id"] in truth and is_held_out(r["doc_id"])]
    assert np.mean(right) > 0.95


def test_held_out_labels_are_never_read(spark, trained):
    docs, labels, _ = trained
    from pyspark.sql import functions as F

    from civitas.llm.common import held_out, labelled_sample
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rules.fit_rules(docs, labels) == rules.fit_rules(docs, flipped)
    assert labelled_sample(labels, "quality", 10).count() == 10
    assert labelled_sample(labels, "quality", 10 ** 6).filter(held_out(F.col("_id"))).count() == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_awkward_rows_and_labels(spark, scratch, module):
    docs = documents(spark, scratch, awkward_texts())
    clashing = with_clashes(docs, "score", "row", "_text", "_y")
    for rows in ([], [(1, 1, 0), (None, 0, 1), (3, None, None)], [(i, i % 2, i % 2) for i in range(15)] * 2):
        model = module.fit(clashing, spark.createDataFrame(rows, LABELS))
        got = module.with_score(clashing, model)
        assert got.count() == docs.count() and dict(got.dtypes)["score"] == "double"
        by_text = {}
        for r in got.collect():
            assert 0 <= r["score"] <= 1
            assert by_text.setdefault(r["text"] or "", r["score"]) == pytest.approx(r["score"])
    empty = table_of(spark, scratch + "-e", [], files=1)
    assert module.with_score(empty, module.fit(empty, spark.createDataFrame([], LABELS))).count() == 0
    assert {r["score"] for r in quality.with_score(docs, quality.fit(docs, spark.createDataFrame([], LABELS))).collect()} == {0.5}


def test_keep_good_keeps_columns(spark, trained):
    docs, labels, truth = trained
    kept = quality.keep_good(with_clashes(docs, "score", "row"), labels)
    assert kept.columns == [*docs.columns, "score", "row"]
    ids = {r["doc_id"] for r in kept.collect()}
    assert np.mean([(i in ids) == good for i, (good, _) in truth.items()]) > 0.95


# ---- the pieces

def test_units_and_pieces(monkeypatch):
    def flat(texts):
        units = quality.Units()
        out = {}
        for docs, owner, unit in units.blocks(texts):
            for d, u in zip(np.array(docs)[owner], unit, strict=True):
                out.setdefault(int(d), []).append(int(u))
        return out
    a = flat(["Alpha beta!! GAMMA gamma", "", None, "alpha Beta!! gamma GAMMA"])
    assert set(a) == {0, 3} and a[0].count(quality.CAPITALS) == 1 and Counter(a[0]) == Counter(a[3])
    assert quality.REPEATED in flat(["a b c d a b c"])[0] and quality.REPEATED not in flat(["a b c", "a b c"])[0]
    long = prose(5000, 3)
    monkeypatch.setattr(quality, "PIECE", 4096)
    cut = [u for u in flat([long])[0] if u < quality.BUCKETS]
    monkeypatch.setattr(quality, "PIECE", 1 << 20)
    assert cut == [u for u in flat([long])[0] if u < quality.BUCKETS]


def plain_units(text):
    """Rows of a text, one unit after the other, with markers: brute force."""
    units, out, names, met = quality.Units(), [], [], set()
    for word in [m.group() for m in re.finditer(r"[0-9A-Za-z\x80-\U0010ffff]+|([^\s0-9A-Za-z])\1*", text)]:
        (_, _, row), = units.blocks([word.lower()])
        out.append(int(row[0]))
        names.append(word.lower())
        if word.isalnum() and len(word) > 1 and sum("A" <= c <= "Z" for c in word) * 2 > len(word):
            out.append(quality.CAPITALS)
        if len(names) > 2:
            three = tuple(names[-3:])
            if three in met:
                out.append(quality.REPEATED)
            met.add(three)
    return out


def long_text():
    """Repeats over far distances, capitals, signs, and units longer than a piece."""
    w = prose(900, 7).split()
    w[40:40] = ["LOUD", "!!!!", "a&b"]
    w[300:300] = ["x" * 700, "#" * 600]
    return " ".join([*w, *w[:200]]) + " " * 800 + "the end" + "y" * 300


@pytest.mark.parametrize("piece", [64, 257, 4096, 1 << 20])
def test_pieces_read_as_one_text(monkeypatch, piece):
    text, reach, n = long_text(), quality.REACH, quality.BUCKETS + quality.MARKERS
    monkeypatch.setattr(quality, "PIECE", piece)
    units = plain_units(text)
    assert quality.REPEATED in units and quality.CAPITALS in units
    got = [int(u) for _, _, part in quality.Units().blocks([text]) for u in part]
    assert got == units
    # context sums and pooled vectors by plain loops
    import pyarrow as pa
    places, signs = quality.index_vectors()
    index = np.zeros((n, quality.DIM), int)
    for k in range(quality.NONZERO):
        np.add.at(index, (np.arange(n), places[:, k]), signs[:, k])
    sums = np.zeros((n, quality.DIM), int)
    for i, u in enumerate(units):
        for j in range(max(0, i - reach), min(len(units), i + reach + 1)):
            sums[u] += index[units[j]]
    out = np.zeros_like(sums)
    for b in quality.context_sums([pa.record_batch({"text": pa.array([text], pa.string())})]):
        for r in b.to_pylist():
            out[r["row"]] = [r[f"c{j}"] for j in range(quality.DIM)]
    assert (out == sums).all()
    vectors = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    x = quality.pool(quality.Units(), vectors.astype(np.float32), [None, text, "", "one"])
    assert np.allclose(x[1], [*np.mean([vectors[u] for u in units], axis=0), np.log1p(len(units))], atol=1e-5)
    assert not x[0].any() and not x[2].any()


def test_context_sums_add_up_over_splits():
    import pyarrow as pa
    texts = [prose(50, i) for i in range(6)] + [None, ""]

    def total(groups):
        out = Counter()
        for g in groups:
            for b in quality.context_sums([pa.record_batch({"text": pa.array(g, pa.string())})]):
                for r in b.to_pylist():
                    out.update({(r["row"], k): v for k, v in r.items() if k != "row" and v})
        return {k: v for k, v in out.items() if v}
    assert total([texts]) == total([texts[:3], texts[3:]]) != {}


def test_grammar_classes():
    g = toxicity.grammar()
    i, t, n, r, o = "insult", "target", "negation", "reported", "other"
    assert toxicity.clause_matches([t, o, i], g) == [(2, "insult", 1, 0, 0)]
    assert toxicity.clause_matches([i, o, t], g) == [(0, "insult", 1, 0, 0)]
    assert toxicity.clause_matches([n, o, i], g) == [(2, "insult", 0, 1, 0)]
    assert toxicity.clause_matches([n, o, o, o, i], g) == [(4, "insult", 0, 0, 0)]
    assert toxicity.clause_matches([r, o, o, o, o, o, o, i, "threat"], g) == [(7, "insult", 0, 0, 1), (8, "threat", 0, 0, 1)]
    assert toxicity.clause_matches([o, t], g) == []


def test_long_clauses_are_read_whole():
    scorer = toxicity.Scorer(toxicity.Lexicon({"blorg$": 2.0, "ass$": 3.0}))

    def classes(text):
        return {c: x for c, x in zip(toxicity.CLASSES, np.expm1(scorer.features(text)), strict=False) if x > 1e-9}
    filler = "amber birch cedar " * 400     # 7,200 characters
    assert classes(f"First. he said {filler}you blorg {filler}") == {("insult", 1, 0, 1): pytest.approx(2.0)}
    assert classes(f"you blorg {filler}that") == {("insult", 1, 0, 0): pytest.approx(2.0)}
    # an insult anywhere in the clause counts once, and no stump of a word counts
    assert classes("blorg " + "x" * 1992 + " blorg " + filler + "blorg") == {("insult", 0, 0, 0): pytest.approx(6.0)}
    for n in range(1985, 2005):
        assert classes("blorg" + " " * n + "class " + filler) == {("insult", 0, 0, 0): pytest.approx(2.0)}
        assert classes("class" + " " * n + "blorg " + filler) == {("insult", 0, 0, 0): pytest.approx(2.0)}
    # borders at the ends, runs of borders, a report in another clause
    assert classes("...he said! you blorg") == {("insult", 1, 0, 0): pytest.approx(2.0)}
    assert classes(";blorg.!\n not a blorg;") == {("insult", 0, 0, 0): pytest.approx(2.0), ("insult", 0, 1, 0): pytest.approx(2.0)}


def test_lexicon_chooses_stem_or_word():
    toxic = {"fool$": 90, "foo": 95, "fool": 90, "gru": 80, "grun": 80, "grunk": 80, "grunka$": 30, "grunkb$": 30, "the$": 95, "rare$": 4}
    clean = {"foo": 60, "the$": 900}
    lex = toxicity.learn_lexicon(toxic, clean, 100, 1000)
    assert set(lex.weights) == {"fool$", "grunk"}
    assert lex.weight("grunkzzz") > 0 and lex.weight("fool") > 0 and lex.weight("foolish") == 0


# ---- statistics of operator 9

def statistics(t):
    t = t or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    three = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {i + k for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_statistics_match_brute_force(spark, scratch):
    texts = [*awkward_texts(), "a b c a b c", "x x x x", "a b c d\na b c d\n\n a b c d", "#*$%&|<> <<>>", "a b c d", "\x0ba\x0cb\rc d", "a\x1fb"]
    docs = documents(spark, scratch, texts)
    got = rules.apply_rules(with_clashes(docs, "words", "lines", "kept", "rule"), []).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for r in got:
        assert tuple(r[n] for n in names) == statistics(r["text"]), repr(r["text"])[:80]
        assert r["kept"] == (not r["base_failed"]) and r["rule"] == 0
    empty = table_of(spark, scratch + "-e", [], files=1)
    assert rules.apply_rules(empty, rules.fit_rules(empty, spark.createDataFrame([], LABELS))).count() == 0


def test_learner_and_expression_agree(spark):
    rng = np.random.default_rng(5)
    x = rng.random((900, len(rules.FEATURES)))
    bad = (x[:, 2] > 0.7) | ((x[:, 3] > 0.6) & (x[:, 6] < 0.4))
    learned = rules.learn_list(x, bad)
    assert 2 <= len(learned) <= rules.MAX_RULES
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{f} double" for f in rules.FEATURES))
    got = [r["n"] for r in df.coalesce(1).select(rules.rule_number(learned).alias("n")).collect()]
    want = [next((k for k, rule in enumerate(learned, 1) if rules.matches(rule, x[i:i + 1])[0]), 0) for i in range(len(x))]
    assert sorted(got) == sorted(want) and np.mean((np.array(want) > 0) == bad) > 0.95


def test_sampled_copies_count_once(spark):
    """Equal texts and texts with 0.8 of their windows in common count once; one that shares only its smallest window does not."""
    from tests.llm.helpers import prose
    base = prose(100, 3)
    near = base + " one more word"
    half = " ".join(base.split()[:50]) + " " + prose(60, 9)
    rows = [(1, base), (1, base), (1, near), (1, half), (0, base), (1, None), (1, "")]
    got = sorted((r["_y"], len(r["_text"])) for r in toxicity.once_each(spark.createDataFrame(rows, "_y int, _text string")).collect())
    assert len(got) in (5, 4) and [g for g in got if g[0] == 0] == [(0, len(base))]
    assert (1, len(half)) in got and got.count((1, 0)) == 1
    assert ((1, len(base)) in got) + ((1, len(near)) in got) in (1, 2)
    many = spark.createDataFrame([(1, base + f" x{i}") for i in range(30)], "_y int, _text string")
    assert toxicity.once_each(many).count() <= 3     # apart only where the last window is the smallest
