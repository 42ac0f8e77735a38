"""Language by the nearest centroid of TF-IDF n-gram vectors.

A text becomes the counts of its letter n-grams (single letters and triples,
words bounded by a space), each count damped by its logarithm and weighted by
the inverse document frequency over all training documents, the vector scaled
to length one. Every language has the n-grams that most of its training
documents hold as features, and several centroids, clustered by cosine. A text
takes the language of the centroid with the largest cosine; one that is
farther from it than halfway between the centroid's members and a right angle
is marked as rejected.

N-grams are exact 63-bit codes of code points, looked up in an exact table;
nothing is hashed together. Tasks work on whole batches of texts in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, pin, shared, short_batches, slices, table, unpacked

FEATURES = 2048     # n-grams a language adds to the vocabulary
SAMPLE = 512        # documents of a language that are clustered
CENTROIDS = 4       # of a language
SPREAD = 64         # parts of a language's documents that are cut down to the sample's size first
ROUNDS = 12         # of the clustering at most
BATCH = 1 << 19     # characters counted at once
LEXICON = 1 << 20   # distinct n-grams a task holds before it hands its counts on
UNKNOWN = "und"


def fold_table() -> np.ndarray:
    """Code point -> lower-case letter (or combining mark), 32 for anything else; 0 stays 0, the border of two texts."""
    import unicodedata
    out = np.full(0x110000, 32, np.uint32)
    for c in range(1, 0x110000):
        ch = chr(c)
        if ch.isalpha() or (c > 0x2FF and unicodedata.category(ch)[0] == "M"):
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    out[0] = 0
    return out


class Lexicon:
    """Exact numbers of n-gram codes: a table of slots, and a next one for the codes that meet in a slot."""
    MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)

    def __init__(self, codes: np.ndarray):
        self.codes, self.levels = codes, []
        rest, at, level = codes, np.arange(len(codes)), 0
        while len(rest):
            bits = max(4, int(8 * len(rest) - 1).bit_length())
            key = np.zeros(1 << bits, np.uint64)
            number = np.full(1 << bits, -1, np.int32)
            shift, mul = np.uint64(64 - bits), np.uint64(self.MULTIPLIERS[level % 4] + 2 * (level // 4))
            slot = ((rest * mul) >> shift).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            key[slot[first]], number[slot[first]] = rest[first], at[first]
            self.levels.append((mul, shift, key, number))
            left = np.ones(len(rest), bool)
            left[first] = False
            rest, at, level = rest[left], at[left], level + 1

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The number of each code, -1 if it has none."""
        out = np.full(len(codes), -1, np.int32)
        todo = None
        for mul, shift, key, number in self.levels:
            c = codes if todo is None else codes[todo]
            slot = ((c * mul) >> shift).astype(np.int64)
            n, same = number[slot], key[slot] == c
            if todo is None:
                out = np.where(same, n, -1).astype(np.int32)
                todo = np.flatnonzero(~same & (n >= 0))
            else:
                out[todo[same & (n >= 0)]] = n[same & (n >= 0)]
                todo = todo[~same & (n >= 0)]
            if not len(todo):
                break
        return out


class Counter:
    """Counts the n-grams of texts by number; with ``grow`` the lexicon takes in what it does not know."""

    def __init__(self, fold: np.ndarray, codes: np.ndarray | None = None):
        self.fold, self.grow = fold, codes is None
        self.lexicon = Lexicon(np.zeros(0, np.uint64) if codes is None else codes)

    def folded(self, text: str, before: np.ndarray | None = None) -> np.ndarray:
        f = self.fold[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if before is not None:
            f = np.concatenate((before, f))
        blank = f == 32
        blank[1:] &= blank[:-1]
        blank[:1] = False
        return f[~blank].astype(np.uint64)

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        found = self.lexicon.find(codes)
        if self.grow and len(miss := np.flatnonzero(found < 0)):
            self.lexicon = Lexicon(np.concatenate((self.lexicon.codes, np.unique(codes[miss]))))
            found[miss] = self.lexicon.find(codes[miss])
        return found

    def grams(self, f: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, number) of every n-gram, and the texts of the letters; the first ``known`` letters were counted before."""
        border = f == 0
        text = np.cumsum(border)
        single = np.flatnonzero(f > 32)
        single = single[single >= known]
        inside = ~(border[:-2] | border[1:-1] | border[2:])
        at = np.flatnonzero(inside)
        codes = np.concatenate((f[single], (f[at] << np.uint64(42)) | (f[at + 1] << np.uint64(21)) | f[at + 2]))
        return np.concatenate((text[single], text[at])), self.numbers(codes), text[single]

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, number, count) sorted by text and number, and how many letters each text has."""
        parts, letters = [], np.zeros(len(texts), np.int64)

        def add(f, first, n, known=0):
            text, number, single = self.grams(f, known)
            letters[first:first + n] += np.bincount(single, minlength=n)[:n]
            ok = number >= 0
            key, k = np.unique((text[ok] << 32) | number[ok], return_counts=True)
            parts.append((first + (key >> 32), key & 0xFFFFFFFF, k))

        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= BATCH):
                size += len(texts[stop])
                stop += 1
            if size <= BATCH:
                joined = " \0 ".join(t.replace("\0", " ") for t in texts[start:stop])
                add(self.folded(f" {joined} "), start, stop - start)
            else:                                   # one long text, piece by piece; two letters go over each cut
                before, first = np.array([32], np.uint32), len(parts)
                for i in range(0, size, BATCH):
                    f = self.folded(texts[start][i:i + BATCH].replace("\0", " ") + (" " if i + BATCH >= size else ""), before)
                    add(f, start, 1, known=len(before) if i else 1)
                    before = f[-2:].astype(np.uint32)
                number, at = np.unique(np.concatenate([p[1] for p in parts[first:]]), return_inverse=True)
                k = np.bincount(at, np.concatenate([p[2] for p in parts[first:]]), len(number)).astype(np.int64)
                parts[first:] = [(np.full(len(number), start), number, k)]
            start = stop
        if not parts:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), letters
        return *(np.concatenate([p[i] for p in parts]) for i in range(3)), letters


def weighted(text, number, count, idf: np.ndarray, n: int) -> np.ndarray:
    """Weights of the counted n-grams, each text's vector of length one."""
    w = (1 + np.log(count)) * idf[number]
    norm = np.sqrt(np.bincount(text, w * w, n))
    return w / np.where(norm > 0, norm, 1)[text]


def learnable(doc_id: Column) -> Column:
    """Outside the evaluation fold: crc32 of the id as text, modulo 4, is not 2 (a NULL id is outside too)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(True))


def document_frequencies(fold_sent):
    """Task function over (lang, text): in how many of the task's texts of a language each n-gram stands; code 0 counts texts."""
    def run(batches):
        counter, by_lang = Counter(fold_sent()), {}

        def hand_on():
            codes = counter.lexicon.codes.astype(np.int64)
            for lang, (docs, n) in by_lang.items():
                at = np.flatnonzero(n)
                code, k = np.append(codes[at], 0), np.append(n[at], docs)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(k)], names=["lang", "code", "n"])

        for b in slices(batches):
            langs = b.column(0).to_pylist()
            text, number, _, letters = counter.count([t or "" for t in b.column(1).to_pylist()])
            size = len(counter.lexicon.codes)
            names = sorted(set(langs))
            of = np.array([names.index(x) for x in langs], np.int64)
            n = np.bincount(of[text] * size + number, minlength=len(names) * size).reshape(len(names), size) if size else np.zeros((len(names), 0), int)
            for i, lang in enumerate(names):
                docs, old = by_lang.get(lang, (0, np.zeros(0, np.int64)))
                n[i, :len(old)] += old
                by_lang[lang] = (docs + int((letters[of == i] > 0).sum()), n[i].copy())
            if size > LEXICON:
                yield from hand_on()
                counter, by_lang = Counter(fold_sent()), {}
        yield from hand_on()
    return run


def cluster(rows: list[dict], centroids: int, rounds: int) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Spherical k-means of one language's sample: (numbers, weights, radius) of each centroid.

    The centroids start from equal parts of the sample in order of the cosine
    with its mean, so that no single odd text founds one.
    """
    vocabulary, at = np.unique(np.concatenate([r["number"] for r in rows]), return_inverse=True)
    x = np.zeros((len(rows), len(vocabulary)))
    x[np.repeat(np.arange(len(rows)), [len(r["number"]) for r in rows]), at] = np.concatenate([r["weight"] for r in rows])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    order = np.argsort(x @ x.mean(axis=0), kind="stable")
    c = np.stack([x[part].mean(axis=0) for part in np.array_split(order, min(centroids, len(x)))])
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    own = np.full(len(x), -1)
    for _ in range(rounds):
        nearest = np.argmax(x @ c.T, axis=1)
        if (nearest == own).all():
            break
        own = nearest
        for k in np.unique(own):
            m = x[own == k].mean(axis=0)
            c[k] = m / max(np.linalg.norm(m), 1e-12)
    cosine = x @ c.T
    own = np.argmax(cosine, axis=1)
    return [(vocabulary[c[k] > 0], c[k][c[k] > 0], float(1 - cosine[own == k, k].min())) for k in np.unique(own)]


@dataclass
class Model:
    fold: np.ndarray
    codes: np.ndarray       # n-grams, their place is their number
    idf: np.ndarray
    languages: list[str]    # of each centroid
    centroids: np.ndarray   # (n-grams, centroids)
    radius: np.ndarray
    common: str | None      # the language of most training documents

    def predict(self, counter: Counter, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, cosines with the nearest centroid, and whether that is too far away."""
        text, number, count, letters = counter.count(texts)
        if self.common is None:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        w = weighted(text, number, count, self.idf, len(texts))
        cosine = np.zeros((len(texts), len(self.languages)))
        for i in range(0, len(text), 1 << 16):      # the products of a stretch of n-grams, summed by text
            part = slice(i, i + (1 << 16))
            first = np.flatnonzero(np.diff(text[part], prepend=-1))
            cosine[text[part][first]] += np.add.reduceat(w[part, None] * self.centroids[number[part]], first, axis=0)
        best = np.argmax(cosine, axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
        lang = [UNKNOWN if not n else self.languages[k] if s > 0 else self.common for n, k, s in zip(letters, best, score, strict=True)]
        return lang, score, (1 - score > (1 + self.radius[best]) / 2) | (letters == 0)


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", id_col: str = "doc_id", features: int = FEATURES,
        sample: int = SAMPLE, centroids: int = CENTROIDS, rounds: int = ROUNDS) -> Model:
    """Document frequencies from all documents given, centroids from at most ``sample`` documents of a language.

    The sample holds the smallest hashes of the ids, one document a hash, whole
    texts. Rows without text or language teach nothing. The driver gets the
    vocabulary (``features`` a language at most) and the centroids:
    languages x centroids x vocabulary numbers.
    """
    spark = docs.sparkSession
    short_batches(spark)
    fold = fold_table()
    sent = shared(spark, fold)
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"),
                       F.xxhash64(F.lit(17), F.col(f"`{id_col}`")).alias("h")).filter("lang is not null and text is not null")
    stats = rows.select("lang", "text").mapInArrow(document_frequencies(sent), "lang string, code long, n long")
    stats = pin(stats.groupBy("lang", "code").agg(F.sum("n").alias("n")), "ngram-documents")
    by_lang = {r["lang"]: r["n"] for r in stats.filter("code = 0 and n > 0").collect()}
    if not by_lang:
        return Model(fold, np.zeros(0, np.uint64), np.zeros(0), [], np.zeros((0, 0)), np.zeros(0), None)
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    chosen = stats.filter("code <> 0").withColumn("r", F.row_number().over(best)).filter(F.col("r") <= features).select("code").distinct()
    got = stats.join(chosen, "code").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").collect()
    codes = np.array([r["code"] for r in got], np.uint64)
    total = sum(by_lang.values())
    idf = np.log((1 + total) / (1 + np.array([r["n"] for r in got], float))) + 1
    sent_vocabulary = shared(spark, (fold, codes, idf))

    def vectors(batches):
        fold, codes, idf = sent_vocabulary()
        counter = Counter(fold, codes)
        for b in slices(batches):
            at, number, count, _ = counter.count(b.column(2).to_pylist())
            w = weighted(at, number, count, idf, b.num_rows)
            ends = np.searchsorted(at, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(ends, number.astype(np.int32)),
                                              pa.ListArray.from_arrays(ends, w)], names=["lang", "h", "number", "weight"])

    def clustered(key, group):
        found = sorted((r for r in group.to_pylist() if r["number"]), key=lambda r: r["h"])
        out = cluster(found, centroids, rounds) if found else []
        return pa.table({"lang": pa.array([key[0].as_py()] * len(out), pa.string()), "number": pa.array([x[0] for x in out], pa.list_(pa.int32())),
                         "weight": pa.array([x[1] for x in out], pa.list_(pa.float64())), "radius": pa.array([x[2] for x in out], pa.float64())})

    # the smallest hashes of each of SPREAD parts, then of all: no task sees more than SPREAD x sample rows of a language at the end
    picked = rows.select("lang", "h", F.pmod("h", F.lit(SPREAD)).alias("part")).distinct()
    for group in (("lang", "part"), ("lang",)):
        picked = picked.withColumn("r", F.row_number().over(Window.partitionBy(*group).orderBy("h"))).filter(F.col("r") <= sample)
    picked = F.broadcast(pin(picked.select(F.col("lang").alias("l"), F.col("h").alias("k")), "language-sample"))  # at most `sample` rows a language
    of_sample = rows.join(picked, (F.col("lang") == F.col("l")) & (F.col("h") == F.col("k"))).select("lang", "h", "text")
    one = Window.partitionBy("lang", "h").orderBy("text")
    of_sample = of_sample.withColumn("r", F.row_number().over(one)).filter("r = 1").select("lang", "h", "text")
    found = of_sample.mapInArrow(vectors, "lang string, h long, number array<int>, weight array<double>").groupBy("lang").applyInArrow(
        clustered, "lang string, number array<int>, weight array<double>, radius double").collect()
    found.sort(key=lambda r: (r["lang"], r["number"], r["weight"]))
    matrix = np.zeros((len(codes), len(found)))
    for k, r in enumerate(found):
        matrix[r["number"], k] = r["weight"]
    common = max(sorted({r["lang"] for r in found}), key=lambda x: by_lang[x], default=None)
    return Model(fold, codes, idf, [r["lang"] for r in found], matrix, np.array([r["radius"] for r in found]), common)


def with_language(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected`` (too far from every centroid).

    Defined cases: NULL, empty and letterless texts are ``und``, score 0,
    rejected; letters of which no n-gram was learned give the most frequent
    language, score 0, rejected; without training rows everything is ``und``;
    equal texts get equal answers, very long ones are read whole, in pieces;
    an empty table gives no rows; input columns of the three names are replaced.
    """
    short_batches(docs.sparkSession)
    sent = shared(docs.sparkSession, model)
    rows = packed(docs, F.col(f"`{text}`").alias("_text"))

    def run(batches):
        m = sent()
        counter = Counter(m.fold, m.codes)
        for b in slices(batches):
            lang, score, rejected = m.predict(counter, [t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                                             names=["row", "_lang", "_score", "_rejected"])

    out = rows.mapInArrow(run, rows.drop("_text").schema.add("_lang", "string").add("_score", "double").add("_rejected", "boolean"))
    return unpacked(out, lang_pred=F.col("_lang"), score=F.col("_score"), rejected=F.col("_rejected"))


def op12_query(spark, sf_dir):
    """Language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(learnable(F.col("doc_id"))))
    out = with_language(docs.select("doc_id", "text", (~learnable(F.col("doc_id"))).alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")
