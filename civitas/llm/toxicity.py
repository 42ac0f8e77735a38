"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reported speech,
other). Three small transducers read the symbols of a clause: target (is
somebody addressed near the word), negation (does a negation stand shortly
before it) and reported speech (does the clause report what somebody said).
Their composition is one automaton whose output at every insult or threat is
the class of the match, e.g. "targeted, not negated, not reported". A document
is scored by the weighted matches of its clauses.

Insult words and stems are learned: prefixes and whole words whose documents
are labelled toxic far more often than not. What a match of each class is
worth is learned as well, by a logistic regression on the matched classes.
Function words of the other symbols are fixed lists.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, held_out, labelled_sample, packed, pin, shared, short_batches, slices, table, unpacked

MAX_LABELLED = 20_000       # labelled documents read by the learner
PREFIXES = range(3, 9)      # lengths of stems
MIN_SUPPORT = 4             # toxic documents that must hold a unit
ALIKE = 0.8                 # share of common five-word windows from which two sampled texts count once
MIN_EVIDENCE = 2.5          # lower bound of a unit's log odds
PARTS = 64                  # files of the pinned sample

# Fixed word lists: English, German, French, Spanish
TARGET = frozenset("you your yours yourself u ya he she they him her them du dich dir dein deine ihr euch euer sie ihnen "
                   "tu te toi ton ta tes vous votre vos il elle ils elles tú ti tus usted ustedes vosotros él ella ellos ellas".split())
NEGATION = frozenset("not no never none nobody isn't aren't don't doesn't nicht kein keine keinen nie niemals "
                     "ne pas jamais aucun aucune rien nunca jamás ningún ninguna nadie tampoco".split())
REPORTED = frozenset("said says say saying called calls wrote writes quoted quote according claimed reported told "
                     "sagte sagt sagen schrieb nannte laut zitiert dit dits disait écrit appelé selon "
                     "dijo dice decía escribió llamó según".split())
THREAT = frozenset("kill murder destroy hurt beat burn shoot stab strangle hang töten umbringen ermorden schlagen verprügeln "
                   "tuer assassiner frapper brûler étrangler matar asesinar golpear quemar apuñalar".split())
CLAUSE = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


# ---- transducers: (state, symbol) -> state; the output is a function of the state

@dataclass(frozen=True)
class Transducer:
    start: int
    states: tuple[int, ...]
    step: dict          # (state, symbol) -> state, others keep the state
    on: frozenset       # states in which the property holds


SYMBOLS = ("insult", "threat", "target", "negation", "reported", "other")


def countdown(symbol: str, reach: int) -> Transducer:
    """The property holds for ``reach`` words after ``symbol``."""
    step = {(s, x): reach if x == symbol else max(0, s - 1) for s in range(reach + 1) for x in SYMBOLS}
    return Transducer(0, tuple(range(reach + 1)), step, frozenset(range(1, reach + 1)))


def latch(symbol: str) -> Transducer:
    """The property holds from ``symbol`` to the end of the clause."""
    return Transducer(0, (0, 1), {(0, symbol): 1}, frozenset((1,)))


def compose(parts: tuple[Transducer, ...]):
    """One automaton over tuples of states: start, transition table, and the output of each state."""
    table, output = {}, {}
    for states in product(*(p.states for p in parts)):
        output[states] = tuple(int(s in p.on) for p, s in zip(parts, states, strict=True))
        for x in SYMBOLS:
            table[states, x] = tuple(p.step.get((s, x), s) for p, s in zip(parts, states, strict=True))
    return tuple(p.start for p in parts), table, output


def grammar():
    return compose((countdown("target", 4), countdown("negation", 3), latch("reported")))


def clause_matches(symbols: list[str], automaton) -> list[tuple[int, str, int, int, int]]:
    """(position, insult or threat, targeted, negated, reported) of the matches of a clause.

    A target counts on either side of the word: the clause is read forwards
    and backwards, and negation and report come from the forward reading.
    """
    start, step, output = automaton
    found, state = {}, start
    for i, x in enumerate(symbols):
        if x in ("insult", "threat"):
            found[i] = [x, *output[state]]
        state = step[state, x]
    state = start
    for i in range(len(symbols) - 1, -1, -1):
        if i in found:
            found[i][1] |= output[state][0]
        state = step[state, symbols[i]]
    return [(i, *v) for i, v in found.items()]


# ---- lexicon

def units_of(text: str | None) -> set[str]:
    """Whole words (ending in $) and word prefixes of a text, lower-cased."""
    out = set()
    for w in set(WORD.findall((text or "").lower())):
        out.add(w + "$")
        out.update(w[:n] for n in PREFIXES if n < len(w))
    return out


@dataclass
class Lexicon:
    """Insult units with their weights; looked up by word."""
    weights: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        got = self.weights.get(word + "$")
        if got is not None:
            return got
        return max((self.weights[word[:n]] for n in PREFIXES if n < len(word) and word[:n] in self.weights), default=0.0)

    def automaton(self):
        """Aho-Corasick automaton over the units and the threat words: finds the clauses worth reading."""
        import ahocorasick
        auto = ahocorasick.Automaton()
        for unit in [*self.weights, *THREAT]:
            auto.add_word(unit.rstrip("$"), len(unit.rstrip("$")))
        auto.make_automaton()
        return auto


def learn_lexicon(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> Lexicon:
    """Units whose log odds of standing in a toxic document are surely high; of nested units the telling one."""
    weights = {}
    for u, a in toxic.items():
        c = clean.get(u, 0)
        odds = np.log((a + 0.5) / (n_toxic + 1)) - np.log((c + 0.5) / (n_clean + 1))
        if odds - 1.64 * np.sqrt(1 / (a + 0.5) + 1 / (c + 0.5)) >= MIN_EVIDENCE:
            weights[u] = float(odds)
    # of nested units: the stem if it stands in clearly more toxic documents and tells as much, else its extensions
    kept, telling = {}, {}  # telling: prefix -> (toxic documents, log odds) of the best extension kept
    for u in sorted(weights, key=len, reverse=True):
        more, surer = telling.get(u, (0, -np.inf))
        if 0.95 * toxic[u] > more and weights[u] >= surer - 0.2:
            kept[u] = weights[u]
            for n in PREFIXES:
                if n < len(u):
                    m, o = telling.get(u[:n], (0, -np.inf))
                    telling[u[:n]] = (max(m, toxic[u]), max(o, weights[u]))
    return Lexicon({u: w for u, w in sorted(kept.items()) if not any(n < len(u.rstrip("$")) and u[:n] in kept for n in PREFIXES)})


# ---- scoring

CLASSES = [(kind, t, n, r) for kind in ("insult", "threat") for t in (0, 1) for n in (0, 1) for r in (0, 1)]


class Scorer:
    """Match features of a text: weight of the matches by class, of the strongest clause, and per word."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.grammar = lexicon, grammar()
        self.finder = lexicon.automaton()

    def symbol(self, word: str) -> tuple[str, float]:
        weight = self.lexicon.weight(word)
        if weight > 0:
            return "insult", weight
        for name, words in (("threat", THREAT), ("target", TARGET), ("negation", NEGATION), ("reported", REPORTED)):
            if word in words:
                return name, 1.0
        return "other", 0.0

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(len(CLASSES) + 3)
        lower = (text or "").lower()
        strongest = total = 0.0
        start = stop = after = 0    # the clause read last, and where the next one starts
        borders = CLAUSE.finditer(lower)
        for end, length in self.finder.iter(lower):
            first = end - length + 1
            if first < stop or (first and lower[first - 1].isalnum()):
                continue  # in a clause already read, or inside a word
            # hits come in the order of their ends and hold no border, so the borders are passed once
            while stop <= first:
                border = next(borders, None)
                start, stop, after = after, *(border.span() if border else (len(lower), len(lower)))
            read = [self.symbol(w) for w in WORD.findall(lower, start, stop)]
            clause = 0.0
            for i, kind, targeted, negated, reported in clause_matches([s for s, _ in read], self.grammar):
                k = CLASSES.index((kind, targeted, negated, reported))
                out[k] += read[i][1]
                clause += read[i][1] if kind == "insult" else 0.0
            strongest, total = max(strongest, clause), total + clause
        out[-3], out[-2] = strongest, total
        out[:-1] = np.log1p(out[:-1])
        out[-1] = total / (1 + np.log1p(len(lower)))
        return out


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, decay: float = 1.0) -> np.ndarray:
    """Newton's method with a ridge; weights of the columns and the constant last."""
    z = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    ridge = np.full(len(w), decay)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.diag(ridge), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray


def count_units(only: set[str] | None = None):
    """Task function: in how many of the task's documents a unit stands; ``only`` restricts the units."""
    def run(batches):
        count = Counter()
        for b in slices(batches):
            for t in b.column(0):
                u = units_of(t.as_py())
                count.update(u if only is None else u & only)
        if count:
            yield pa.RecordBatch.from_arrays([pa.array(list(count)), pa.array(list(count.values()), pa.int64())], names=["unit", "n"])
    return run


def windows_of(words: Column) -> Column:
    """The distinct hashes of five words in a row, of the whole text if it has fewer."""
    return F.when(F.size(words) < 5, F.array(F.xxhash64(words))).otherwise(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(5)) - 4), lambda i: F.xxhash64(F.slice(words, i, 5)))))


def once_each(rows: DataFrame) -> DataFrame:
    """(_y, _text) of sampled documents: equal texts once, and those that share their smallest window hash and at
    least ALIKE of their windows with the one that stands for that hash once too."""
    rows = rows.select("_y", F.coalesce("_text", F.lit("")).alias("_text"))
    rows = rows.groupBy("_y", F.xxhash64("_text").alias("t")).agg(F.min("_text").alias("_text"))
    # the words as a column of their own: split inside the windows' lambda they would be split for each window
    rows = rows.withColumn("words", F.split("_text", WHITE)).withColumn("w", windows_of(F.col("words"))).drop("words")
    rows = pin(rows.withColumn("h", F.array_min("w")), "toxic-windows")
    stands = rows.groupBy("_y", "h").agg(F.min_by(F.struct("t", "w"), "t").alias("s"))
    common = F.size(F.array_intersect("w", "s.w"))
    alike = common >= ALIKE * (F.size("w") + F.size("s.w") - common)
    return rows.join(stands, ["_y", "h"]).filter((F.col("t") == F.col("s.t")) | ~alike).select("_y", "_text")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        max_rows: int = MAX_LABELLED) -> Model:
    """Lexicon and match weights from at most ``max_rows`` labelled documents (copies and near copies count once).

    The sample bounds the units, too. If labelled ids repeat in ``docs`` with
    other texts, at most 2 * max_rows documents come to the driver as features.
    """
    short_batches(docs.sparkSession)
    sample = F.broadcast(labelled_sample(labels, label, max_rows))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(sample, "_id")
    rows = pin(once_each(rows).repartition(PARTS), "toxic-sample")
    size = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)

    def totals(y, task):
        return rows.filter(F.col("_y") == y).select("_text").mapInArrow(task, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))

    # each document of the bounded sample supports a bounded number of units
    toxic = {r["unit"]: r["n"] for r in totals(1, count_units()).filter(F.col("n") >= MIN_SUPPORT).collect()} if n_toxic else {}
    sent = docs.sparkSession.sparkContext.broadcast(set(toxic))
    clean = {r["unit"]: r["n"] for r in totals(0, lambda batches: count_units(sent.value)(batches)).collect()} if toxic else {}
    lexicon = learn_lexicon(toxic, clean, n_toxic, n_clean)

    def features(batches):
        scorer = Scorer(lexicon)
        for b in slices(batches):
            x = [scorer.features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    got = sorted(rows.select("_y", "_text").mapInArrow(features, "y int, x array<double>").limit(2 * max_rows).collect(), key=lambda r: (r["y"], r["x"]))
    x = np.array([r["x"] for r in got], float).reshape(-1, len(CLASSES) + 3)
    return Model(lexicon, logistic(x, np.array([r["y"] == 1 for r in got], float)))


def with_score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability that the text is toxic.

    Defined cases: NULL and empty texts have no matches and score like any
    other text without one; equal texts score alike; an empty table gives no
    rows; without labels the lexicon is empty and only threats can match; an
    input column called score is replaced.
    """
    short_batches(docs.sparkSession)
    sent = shared(docs.sparkSession, model)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent()
        scorer, w = Scorer(m.lexicon), m.weights
        for column in batches:
            x = np.array([scorer.features(t) for t in column]).reshape(-1, len(w) - 1)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -40, 40))))

    udf = F.pandas_udf(scores, "double")
    rows = packed(docs, F.col(f"`{text}`").alias("_text")).withColumn("_score", udf("_text"))
    return unpacked(rows, score=F.col("_score"))


def op5_query(spark, sf_dir):
    """Toxicity score of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = with_score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
