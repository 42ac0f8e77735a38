"""Token counts through an exact length histogram.

Documents are encoded once and aggregated by length; the histogram has one
row per distinct length, whatever the number of documents. Suffix sums over
it then answer every context limit exactly: how many documents and tokens lie
beyond it, what truncation to it keeps, and which quantile it is.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pin, short_batches, slices, table

RANKS_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pre-tokenisation pattern of this vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RUN = 1 << 16   # white space in a row from which it is encoded by itself: the pattern's look-ahead dies of a million
SPAN = 1024     # lengths per block of the two-level suffix sums


def encoder(ranks: bytes):
    import tiktoken
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def long_runs(run: int = RUN) -> re.Pattern:
    """Runs of at least ``run`` characters that the pattern takes for white space."""
    return re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % run)


def count_tokens(enc, runs: re.Pattern, text: str) -> int:
    """Length of the encoded text.

    A long run of white space is one piece of the pattern: the whole run at
    the text's end, else all but its last character, which goes with what
    follows. Cut there, the parts encode as the whole would.
    """
    n = at = 0
    for m in runs.finditer(text):
        n += len(enc.encode_ordinary(text[at:m.start()]))
        at = m.end() if m.end() == len(text) else m.end() - 1
        n += len(enc._encode_single_piece(text[m.start():at].encode()))
    return n + len(enc.encode_ordinary(text[at:]))


def length_histogram(docs: DataFrame, *, text: str = "text", ranks_file: str = RANKS_FILE) -> DataFrame:
    """(length, n_docs): documents by number of tokens; NULL and empty texts have length 0.

    Texts of any length are encoded whole, runs of any one character included.
    The vocabulary (under 1 MB, read on the driver) travels as a broadcast
    variable. Each task counts its own documents by length first, so the
    shuffle carries at most one row per task and distinct length.
    """
    short_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    with open(ranks_file, "rb") as f:
        ranks = sc.broadcast(f.read())

    def lengths(batches):
        enc, runs = encoder(ranks.value), long_runs()
        for b in slices(batches):
            n = [count_tokens(enc, runs, t) if t else 0 for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=["length"])

    return (docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(lengths, "length long")
            .groupBy("length").agg(F.count(F.lit(1)).alias("n_docs")))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """The histogram with, for every length taken as context limit:

    ``docs_over`` / ``tokens_over``: documents longer than the limit and their
    tokens; ``docs_total`` / ``tokens_total``; ``tokens_truncated``: tokens left
    when every document is cut at the limit; ``quantile``: share of documents
    within the limit. Two levels -- inside blocks of SPAN lengths, then over
    block totals -- so no task orders the whole histogram.
    """
    hist = pin(hist.withColumn("block", F.floor(F.col("length") / SPAN)), "length-histogram")
    weight = F.col("n_docs") * F.col("length")
    totals = hist.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum(weight).alias("bt"))
    # one row per 1,024 possible lengths
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "block", F.coalesce(F.sum("bd").over(after), F.lit(0)).alias("ad"),
        F.coalesce(F.sum("bt").over(after), F.lit(0)).alias("at"),
        F.sum("bd").over(every).alias("docs_total"), F.sum("bt").over(every).alias("tokens_total"))
    inside = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = hist.join(totals, "block").select(
        "length", "n_docs",
        (F.coalesce(F.sum("n_docs").over(inside), F.lit(0)) + F.col("ad")).alias("docs_over"),
        (F.coalesce(F.sum(weight).over(inside), F.lit(0)) + F.col("at")).alias("tokens_over"),
        "docs_total", "tokens_total")
    return out.withColumn(
        "tokens_truncated", F.col("tokens_total") - F.col("tokens_over") + F.col("length") * F.col("docs_over")).withColumn(
        "quantile", (F.col("docs_total") - F.col("docs_over")) / F.col("docs_total"))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the smallest length with at least that share of the documents within it."""
    return sums.select(F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"), "length", "quantile").filter(
        F.col("quantile") >= F.col("share")).groupBy("share").agg(F.min("length").alias("length"))


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context, docs_over, tokens_truncated) for any context lengths, not only those that occur."""
    asked = sums.select(F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("context"), "*")
    over = F.col("length") > F.col("context")
    return asked.groupBy("context").agg(
        F.sum(F.when(over, F.col("n_docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.least("length", "context") * F.col("n_docs")).alias("tokens_truncated"))


def op2_query(spark, sf_dir):
    """Token length histogram of ``documents`` with its suffix sums."""
    return suffix_sums(length_histogram(table(spark, sf_dir, "documents")))
