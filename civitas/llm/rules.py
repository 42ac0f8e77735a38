"""Quality rules: learned decision lists as Spark conditional expressions (no Python in tasks).

Statistics of every text are plain column expressions. A bounded sample of
labelled rows trains the list by sequential covering: grow a conjunction of
threshold conditions by information gain on two thirds of the rows still
uncovered, prune it on the other third, keep it while it is precise, remove
what it covers, repeat. The list is emitted as one ordered CASE expression.
"""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, labelled_sample, packed, table, unpacked

FEATURES = ("n_words", "word_length", "symbol_share", "repeat_share", "upper_share", "bang_share", "distinct_share", "dup_line_share")
MAX_LABELLED = 20_000   # labelled rows read by the learner
THRESHOLDS = 32         # candidate thresholds per statistic
MAX_RULES, MAX_CONDITIONS, MIN_PRECISION, MIN_COVER = 12, 4, 0.9, 5


def window_cover(words: Column) -> Column:
    """Number of words in 3-word windows that the array holds twice or more."""
    hashed = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.when(F.size(words) >= 3, F.sort_array(hashed)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def covered_by(sorted_windows: str) -> Column:
    s = F.col(sorted_windows)
    twice = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    return F.aggregate(starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), lambda a, i: F.struct(
        (a["n"] + i + 3 - F.greatest(a["end"], i)).cast("long").alias("n"), (i + 3).alias("end")), lambda a: a["n"])


def with_statistics(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the base statistics of the column ``text`` and the learner's shares."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = rows.withColumn("words", F.array_remove(F.split(t, WHITE), ""))
    out = out.withColumn("_sorted", window_cover(F.col("words"))).withColumn(
        "lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    out = out.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": covered_by("_sorted"),
        "_upper": F.regexp_count(t, F.lit("[A-Z]")), "_bang": F.regexp_count(t, F.lit("[!?]")),
        "_distinct": F.size(F.array_distinct("words")), "_lines": F.size("lines")}).drop("words", "_sorted", "lines")
    w, c = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return out.withColumns({
        "word_length": F.col("word_chars") / w, "symbol_share": F.col("n_symbols") / c,
        "repeat_share": F.col("n_repeat_words") / w, "upper_share": F.col("_upper") / c, "bang_share": F.col("_bang") / c,
        "distinct_share": F.col("_distinct") / w,
        "dup_line_share": F.col("n_dup_lines") / F.greatest("_lines", F.lit(1))}).drop("_upper", "_bang", "_distinct", "_lines")


@dataclass(frozen=True)
class Condition:
    feature: str
    sign: str  # ">=" or "<="
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return (operator.ge if self.sign == ">=" else operator.le)(x[:, FEATURES.index(self.feature)], self.threshold)

    def column(self) -> Column:
        return (operator.ge if self.sign == ">=" else operator.le)(F.col(self.feature).cast("double"), F.lit(self.threshold))


def matches(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for c in rule:
        hit &= c.holds(x)
    return hit


def grow(x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """Add the condition of the largest FOIL gain until no good row is covered."""
    rule: list[Condition] = []
    hit = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS and (hit & ~bad).any():
        p, n = int((hit & bad).sum()), int(hit.sum())
        base, best = math.log2(max(p, 1e-9) / n), (1e-9, None)
        for k, name in enumerate(FEATURES):
            cuts = np.unique(np.quantile(x[hit, k], np.linspace(0, 1, THRESHOLDS + 1), method="nearest"))
            for sign, test in ((">=", operator.ge), ("<=", operator.le)):
                for cut in cuts:
                    m = hit & test(x[:, k], cut)
                    p2, n2 = int((m & bad).sum()), int(m.sum())
                    if p2:
                        gain = p2 * (math.log2(p2 / n2) - base)
                        if gain > best[0]:
                            best = (gain, Condition(name, sign, float(cut)))
        if best[1] is None:
            break
        rule.append(best[1])
        hit &= best[1].holds(x)
    return rule


def prune(rule: list[Condition], x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """The prefix of the rule with the best (p - n) / (p + n) on the pruning rows; the shortest of equals."""
    def worth(r):
        hit = matches(r, x)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0
    return max((rule[:i] for i in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=[])


def learn_list(x: np.ndarray, bad: np.ndarray, seed: int = 7) -> list[list[Condition]]:
    """Ordered rules for the bad class; rows that match none are good."""
    rules, rng = [], np.random.default_rng(seed)
    while len(rules) < MAX_RULES and bad.sum() >= MIN_COVER:
        pruning = rng.random(len(x)) < 1 / 3
        rule = grow(x[~pruning], bad[~pruning])
        rule = prune(rule, x[pruning], bad[pruning]) if rule else rule
        hit = matches(rule, x) if rule else np.zeros(len(x), bool)
        if not rule or hit.sum() < MIN_COVER or (hit & bad).sum() < MIN_PRECISION * hit.sum():
            break
        rules.append(rule)
        x, bad = x[~hit], bad[~hit]
    return rules


def rule_number(rules: list[list[Condition]]) -> Column:
    """The list as one ordered CASE: the number of the first rule that holds, 0 if none does."""
    out = F.lit(0)
    for i, rule in reversed(list(enumerate(rules, 1))):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, F.lit(i)).otherwise(out)
    return out


def fit_rules(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "quality",
              max_rows: int = MAX_LABELLED) -> list[list[Condition]]:
    """Learn the list from at most ``max_rows`` labelled rows (the sample is small enough to be broadcast).

    If labelled ids repeat in ``docs``, at most 2 * max_rows documents are read.
    """
    sample = F.broadcast(labelled_sample(labels, label, max_rows))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(sample, "_id")
    got = with_statistics(rows, "_text").select("_y", *[F.col(f).cast("double") for f in FEATURES]).orderBy("_id").limit(2 * max_rows).collect()
    x = np.array([list(r)[1:] for r in got], float).reshape(-1, len(FEATURES))
    return learn_list(x, np.array([r["_y"] == 0 for r in got], bool))


def apply_rules(docs: DataFrame, rules: list[list[Condition]], *, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and rule.

    ``kept`` is false if the base check fails or a learned rule holds;
    ``rule`` is the rule's number, 0 for none. Defined cases: NULL and empty
    texts have no words and fail the base check; repeated rows are judged
    alike; an empty table gives no rows; without labelled rows the list is
    empty and only the base check decides; input columns of these names are
    replaced.
    """
    rows = with_statistics(packed(docs, F.col(f"`{text}`").alias("_text")), "_text")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumn("rule", rule_number(rules))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return unpacked(rows, **{n: F.col(n) for n in names}, kept=~F.col("base_failed") & (F.col("rule") == 0), rule=F.col("rule"))


def op9_query(spark, sf_dir):
    """Base statistics and verdict of every document, the list learned from ``labels.quality``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_rules(docs, fit_rules(docs, table(spark, sf_dir, "labels"))).drop("text")
