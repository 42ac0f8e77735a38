"""Quality classifier: random-indexing word vectors, pooled, and a small numpy network.

1. Units of a text: lower-cased words, runs of one punctuation mark, and
   marker units behind a word written in capitals and behind a word that ends
   a three-unit sequence seen before in the text. Units are hashed to BUCKETS
   rows.
2. Random indexing over *all* documents: every row has a fixed sparse ternary
   index vector; a row's context vector is the sum of the index vectors of the
   units around it (itself included). Tasks add up integer matrices of one
   size, whatever the vocabulary, and Spark adds those.
3. A document is the mean of its units' normalised vectors (and the logarithm
   of its length).
4. A two-layer network is trained on at most ``max_rows`` labelled documents,
   and a temperature is fitted on a fold it was not trained on.

Model and vectors are about 1 MB, whatever the input, and travel as a broadcast
variable.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, packed, shared, short_batches, slices, table, unpacked
from .suffix import Names, as_bytes, mix

BUCKETS, DIM, NONZERO, REACH = 4096, 64, 4, 2
MARKERS = 2                 # rows behind the hashed ones: capitals, repeated sequence
CAPITALS, REPEATED = BUCKETS, BUCKETS + 1
PIECE = 1 << 20             # bytes handled at once; a longer text is cut between units
MAX_LABELLED = 20_000       # labelled documents read by the trainer
TOGETHER = 64               # documents pooled by one matrix product
HIDDEN, EPOCHS, DECAY, SEED = 16, 400, 1e-4, 11
THRESHOLD = 0.3


def byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """(class, lower case) of each byte: 0 white space, 1 part of a word, 2 punctuation."""
    kind = np.full(256, 2, np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = 0
    kind[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 32
    return kind, lower


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the NONZERO entries of every row's index vector."""
    rng = np.random.default_rng(SEED)
    n = BUCKETS + MARKERS
    places = np.argsort(rng.random((n, DIM)), axis=1)[:, :NONZERO]
    return places, rng.integers(0, 2, (n, NONZERO)) * 2 - 1


class Past:
    """What a piece of a long text must know of the pieces before it."""

    def __init__(self):
        self.names, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.runs = []          # names of the three-unit sequences seen: sorted arrays of falling size

    def seen(self, three: np.ndarray) -> np.ndarray:
        out = np.zeros(len(three), bool)
        for run in self.runs:
            at = np.minimum(np.searchsorted(run, three), len(run) - 1)
            out |= run[at] == three
        return out

    def add(self, names: np.ndarray, rows: np.ndarray, three: np.ndarray) -> None:
        self.names, self.rows = names[-2:], rows[-REACH:]
        if len(three):
            self.runs.append(np.unique(three))
        while len(self.runs) > 1 and len(self.runs[-2]) <= 2 * len(self.runs[-1]):
            self.runs[-2:] = [np.union1d(*self.runs[-2:])]


class Units:
    """Unit rows of documents, a block of documents at a time."""

    def __init__(self):
        self.kind, self.lower = byte_classes()
        self.names = Names()

    def blocks(self, texts):
        """(documents, document of each unit, unit rows) for blocks of about PIECE bytes."""
        for docs, owner, unit, lead in self.windows(texts):
            yield docs, owner[lead:], unit[lead:]

    def windows(self, texts):
        """(documents, document of each unit, unit rows, lead) for blocks of about PIECE bytes.

        The first ``lead`` units stood at the end of the same text's piece
        before; they are context of the others.
        """
        held, size = [], 0
        for d, t in enumerate(texts):
            data = as_bytes(t)
            if len(data) > PIECE:
                past = Past()
                while len(data):
                    cut = self.border(data)
                    yield self.block([(d, data[:cut])], past)
                    data = data[cut:]
                continue
            if size + len(data) > PIECE and held:
                yield self.block(held)
                held, size = [], 0
            held.append((d, data))
            size += len(data) + 1
        if held:
            yield self.block(held)

    def key(self, data: np.ndarray) -> np.ndarray:
        """Equal for neighbours of one unit."""
        kind = self.kind[data]
        return kind.astype(np.int16) + np.where(kind == 2, data.astype(np.int16) * 4, 0)

    def border(self, data: np.ndarray) -> int:
        """The last border of units in PIECE bytes, or in more where one unit is longer."""
        n = PIECE
        while n < len(data):
            key = self.key(data[:n + 1])
            change = np.flatnonzero(key[1:] != key[:-1])
            if len(change):
                return int(change[-1]) + 1
            n *= 2
        return len(data)

    def block(self, docs, past: Past | None = None):
        space = np.array([0x20], np.uint8)
        data = np.concatenate([x for _, part in docs for x in (part, space)])
        ends = np.cumsum([len(part) + 1 for _, part in docs])
        kind, key = self.kind[data], self.key(data)
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        stop = np.append(start[1:], len(data))
        real = kind[start] != 0
        start, stop = start[real], stop[real]
        self.names.load(self.lower[data])
        name = self.names.of(start, stop)
        doc = np.searchsorted(ends, start, side="right")
        upper = np.concatenate(([0], np.cumsum((data >= 0x41) & (data <= 0x5A))))
        length = stop - start
        capitals = (kind[start] == 1) & (length > 1) & ((upper[stop] - upper[start]) * 2 > length)
        rows = (name >> np.uint64(64 - 12)).astype(np.int64)
        # a sequence of three units that stood earlier in the same document, an earlier piece of it included
        before = past.names if past else name[:0]
        all_names, all_docs = np.concatenate((before, name)), np.concatenate((np.zeros(len(before), doc.dtype), doc))
        repeated = np.zeros(len(all_names), bool)
        three = name[:0]
        if len(all_names) > 2:
            three = mix(all_names[:-2] ^ mix(all_names[1:-1] ^ mix(all_names[2:] ^ mix(all_docs[:-2].astype(np.uint64) + np.uint64(1)))))
            same_doc = all_docs[:-2] == all_docs[2:]
            order = np.argsort(three, kind="stable")
            again = np.zeros(len(three), bool)
            again[order[1:]] = three[order[1:]] == three[order[:-1]]
            if past:
                again |= past.seen(three)
            repeated[2:] = again & same_doc
        repeated = repeated[len(before):]
        place = np.arange(len(rows)) * 3
        at = np.concatenate((place, place[capitals] + 1, place[repeated] + 2))
        order = np.argsort(at, kind="stable")
        unit = np.concatenate((rows, np.full(capitals.sum(), CAPITALS), np.full(repeated.sum(), REPEATED)))[order]
        owner = np.concatenate((doc, doc[capitals], doc[repeated]))[order]
        lead = 0
        if past:
            lead, unit = len(past.rows), np.concatenate((past.rows, unit))
            owner = np.concatenate((np.zeros(lead, owner.dtype), owner))
            past.add(all_names, unit, three)
        return [d for d, _ in docs], owner, unit, lead


def context_sums(batches):
    """Task function: (row, c0..c63) -- the integer context matrix of the task's documents."""
    units, (places, signs) = Units(), index_vectors()
    n = BUCKETS + MARKERS
    total = np.zeros(n * DIM)
    for b in slices(batches):
        for _, owner, unit, lead in units.windows(t.as_py() for t in b.column(0)):
            count = np.bincount(unit[lead:], minlength=n)
            for k in range(NONZERO):
                total += np.bincount(np.arange(n) * DIM + places[:, k], weights=count * signs[:, k], minlength=n * DIM)
            for reach in range(1, REACH + 1):
                near = owner[reach:] == owner[:-reach]
                near[:max(0, lead - reach)] = False     # counted with the piece before
                a, c = unit[:-reach][near], unit[reach:][near]
                for here, there in ((a, c), (c, a)):
                    for k in range(NONZERO):
                        total += np.bincount(here * DIM + places[there, k], weights=signs[there, k], minlength=n * DIM)
    total = total.reshape(n, DIM).astype(np.int64)
    used = np.flatnonzero(total.any(axis=1))
    if len(used):
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(total[used, j]) for j in range(DIM)]],
                                         names=["row", *[f"c{j}" for j in range(DIM)]])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Normalised context vectors from all of ``docs``: BUCKETS + MARKERS rows of DIM numbers."""
    short_batches(docs.sparkSession)
    cols = [f"c{j}" for j in range(DIM)]
    sums = (docs.select(F.col(f"`{text}`").alias("text"))
            .mapInArrow(context_sums, "row long, " + ", ".join(f"{c} long" for c in cols))
            .groupBy("row").agg(*[F.sum(c).alias(c) for c in cols]).collect())  # at most BUCKETS + MARKERS rows
    out = np.zeros((BUCKETS + MARKERS, DIM))
    for r in sums:
        out[r["row"]] = list(r)[1:]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def pool(units: Units, vectors: np.ndarray, texts) -> np.ndarray:
    """One row per text: the mean vector of its units and log(1 + units); zeros without units."""
    texts = list(texts)
    total, count, n = np.zeros((len(texts), DIM)), np.zeros(len(texts)), BUCKETS + MARKERS
    for docs, owner, unit in units.blocks(texts):
        at = np.searchsorted(owner, np.arange(0, len(docs) + TOGETHER, TOGETHER))
        for k, (a, b) in enumerate(zip(at, at[1:], strict=False)):
            which = docs[k * TOGETHER:(k + 1) * TOGETHER]
            # how often each document holds each unit, times the vectors
            held = np.bincount((owner[a:b] - k * TOGETHER) * n + unit[a:b], minlength=len(which) * n).reshape(-1, n)
            total[which] += held.astype(np.float32) @ vectors
            count[which] += held.sum(axis=1)
    return np.column_stack((total / np.maximum(count, 1)[:, None], np.log1p(count)))


@dataclass
class Network:
    """Two layers on standardised features; ``temperature`` divides the logit."""
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -60, 60)))


def constant(p: float) -> Network:
    width = DIM + 1
    return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(p / (1 - p))))


def train(x: np.ndarray, y: np.ndarray, calibration: np.ndarray) -> Network:
    """Adam on the log loss over the rows outside ``calibration``, then the temperature on those inside.

    With fewer than two classes the score is the smoothed share of label 1.
    """
    if len(y) == 0 or y.min() == y.max():
        return constant((y.sum() + 0.5) / (len(y) + 1))
    fit = ~calibration
    if len(np.unique(y[fit])) < 2:
        fit = np.ones(len(y), bool)
    rng = np.random.default_rng(SEED)
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
    z, t = (x[fit] - mean) / scale, y[fit].astype(float)
    params = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN),
              np.array(np.log((t.sum() + 0.5) / (len(t) - t.sum() + 0.5)))]
    moment, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, EPOCHS + 1):
        h = np.tanh(z @ params[0] + params[1])
        p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -60, 60)))
        d = (p - t) / len(t)
        back = d[:, None] * params[2] * (1 - h * h)
        grads = [z.T @ back + DECAY * params[0], back.sum(axis=0), h.T @ d + DECAY * params[2], np.array(d.sum())]
        for i, g in enumerate(grads):
            moment[i] = 0.9 * moment[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            params[i] = params[i] - 0.02 * (moment[i] / (1 - 0.9 ** step)) / (np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3]))
    if calibration.any():
        logit, t = net.logit(x[calibration]), y[calibration]
        grid = np.geomspace(0.5, 8, 33)
        loss = [np.logaddexp(0, np.where(t == 1, -logit, logit) / k).mean() for k in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = MAX_LABELLED) -> Model:
    """Word vectors from all documents, the network from a bounded sample of the labelled ones.

    If labelled ids repeat in ``docs``, at most 2 * max_rows documents are read.
    """
    vectors = word_vectors(docs, text)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(batches):
        units = Units()
        for b in slices(batches):
            x = pool(units, sent.value, (t.as_py() for t in b.column(2)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "c", "x"])

    sample = F.broadcast(labelled_sample(labels, label, max_rows))
    fold = F.crc32(F.col("_id").cast("string").cast("binary")) % 5 == 1
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(sample, "_id").select("_y", fold, "_text")
    got = rows.mapInArrow(pooled, "y int, c boolean, x array<double>").limit(2 * max_rows).collect()
    got = sorted(got, key=lambda r: (r["c"], r["y"], r["x"]))
    x = np.array([r["x"] for r in got], float).reshape(-1, DIM + 1)
    return Model(vectors, train(x, np.array([r["y"] == 1 for r in got], int), np.array([r["c"] for r in got], bool)))


def with_score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the calibrated probability of label 1.

    Defined cases: NULL and empty texts score as a document without units;
    a text above PIECE bytes is read in pieces that know the sequences and the
    last units before them, as one text (8 bytes a unit are held);
    equal texts score alike; an empty table gives no rows; without labels
    every score is 0.5; an input column called score is replaced.
    """
    short_batches(docs.sparkSession)
    sent = shared(docs.sparkSession, model)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        units, m = Units(), sent()
        for column in batches:
            yield pd.Series(m.network.score(pool(units, m.vectors, column)))

    udf = F.pandas_udf(scores, "double")
    rows = packed(docs, F.col(f"`{text}`").alias("_text")).withColumn("_score", udf("_text"))
    return unpacked(rows, score=F.col("_score"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **columns) -> DataFrame:
    """``docs`` whose score reaches the threshold; the columns stay as they are."""
    text = columns.get("text", "text")
    model = fit(docs, labels, **columns)
    scored = with_score(packed(docs, F.col(f"`{text}`").alias("_t")), model, text="_t")
    return scored.filter(F.col("score") >= threshold).select("row.*")


def op3_query(spark, sf_dir):
    """Quality score of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = with_score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
