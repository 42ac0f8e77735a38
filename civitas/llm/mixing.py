"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

A source with ``n`` of the ``N`` rows and target share ``w`` has the mean
repetition rate ``epochs * N * w / n``. Every document draws its number of
copies from a Poisson distribution with that mean: a uniform number hashed
from (seed, document) is inverted through the cumulative distribution, so the
draw is the same on every run, retry and cluster. The copies are exploded and
dealt over the cluster in hash order.

Rates above ``STEP`` are split into equal parts (a sum of Poisson numbers is
Poisson), so a tiny source with a huge rate needs no long table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, pin, unpacked

STEP = 16.0     # largest mean inverted at once
TERMS = 80      # P(Poisson(16) >= 80) is below the grain of the uniform numbers
SEED = "mix-1"


def source_rates(docs: DataFrame, targets: Mapping[str, float] | None, temperature: float,
                 epochs: float, source: str) -> DataFrame:
    """(source, n_rows, rate): one row per source, NULL being a source of its own.

    ``targets`` maps sources to weights (others get no copies); without it the
    weight is ``n_rows ** temperature``.
    """
    n = docs.groupBy(F.col(f"`{source}`").cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
    if targets is None:
        weight = F.pow(F.col("n_rows").cast("double"), F.lit(float(temperature)))
    elif targets:
        weights = F.create_map(*[x for k, v in targets.items() for x in (F.lit(k), F.lit(float(v)))])
        weight = F.coalesce(F.when(F.col("source").isNotNull(), weights[F.coalesce("source", F.lit(""))]), F.lit(0.0))
    else:
        weight = F.lit(0.0)
    counts = pin(n.withColumn("weight", weight), "mix-sources")
    # two scalars: the row count and the sum of the weights
    total = counts.agg(F.sum("n_rows").alias("n"), F.sum("weight").alias("w")).first()
    scale = epochs * (total["n"] or 0) / total["w"] if total["w"] else 0.0
    return counts.select("source", "n_rows", (F.lit(scale) * F.col("weight") / F.col("n_rows")).alias("rate"))


def cumulative(mean: Column) -> Column:
    """The first TERMS values of the Poisson distribution function as an array."""
    first = F.exp(-mean)
    zero = F.struct(first.alias("p"), F.array(first).alias("c"))

    def step(acc, k):
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), zero, step, lambda a: a["c"])


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2 ** 52))


def mix_sources(docs: DataFrame, targets: Mapping[str, float] | None = None, *, temperature: float = 0.5,
                epochs: float = 1.0, seed: str = SEED, id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """``docs`` replicated to the target weights and shuffled globally.

    Adds ``rate`` (mean copies of its source), ``n_copies`` and ``copy`` (1 to
    n_copies); documents that draw zero copies are left out. Defined cases:
    a NULL id counts as the text ``null``; rows with equal ids draw equal
    counts; an empty table gives no rows; input columns called rate, n_copies
    or copy are replaced.

    The rates are pinned to a table, so they are broadcast only while that
    table is below Spark's broadcast threshold. The order key takes the row's
    place in its scan partition into account, so even a third of all rows
    sharing one id spreads over all partitions.
    """
    rates = source_rates(docs, targets, temperature, epochs, source)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP)).cast("int")
    rates = pin(rates.filter("rate > 0").select(
        F.col("source").alias("_source"), "rate", parts.alias("_parts"),
        cumulative(F.col("rate") / parts).alias("_cdf")), "mix-rates")
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))
    rows = packed(docs, F.col(f"`{source}`").cast("string").alias("_own"), key.alias("_key"),
                  F.monotonically_increasing_id().alias("_place"))
    drawn = rows.join(rates, F.col("_own").eqNullSafe(F.col("_source"))).withColumn("_n", F.aggregate(
        F.sequence(F.lit(1), F.col("_parts")), F.lit(0),
        lambda n, j: n + F.size(F.filter("_cdf", lambda c: c <= uniform(F.lit(seed), F.col("_key"), j)))))
    copies = (drawn.filter("_n > 0").select("row", "rate", "_n", "_key", "_place",
                                            F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"))
              .withColumn("_order", F.xxhash64(F.lit(seed), "_key", "_copy", "_place")))
    mixed = copies.repartition("_order").sortWithinPartitions("_order")
    return unpacked(mixed, rate=F.col("rate"), n_copies=F.col("_n"), copy=F.col("_copy"))


def op1_query(spark, sf_dir):
    """Every document of ``documents``, sources mixed with square-root weights."""
    from .common import table
    out = mix_sources(table(spark, sf_dir, "documents"))
    return out.withColumn("rate", F.round("rate", 9))


ORACLE = """
WITH n AS (SELECT source, count(*) AS n_rows FROM documents GROUP BY source),
r AS (SELECT source, sum(n_rows) OVER () * sqrt(n_rows) / sum(sqrt(n_rows)) OVER () / n_rows AS rate FROM n),
p AS (SELECT *, greatest(1, ceil(rate / 16.0))::INT AS parts FROM r),
t AS (SELECT source, k, exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)) AS pk
      FROM p, generate_series(0, 79) g(k)),
c AS (SELECT source, list(s ORDER BY k) AS cdf
      FROM (SELECT source, k, sum(pk) OVER (PARTITION BY source ORDER BY k) AS s FROM t) GROUP BY source),
u AS (SELECT d.*, p.rate, c.cdf, unnest(generate_series(1, p.parts)) AS j
      FROM documents d JOIN p ON d.source IS NOT DISTINCT FROM p.source
                       JOIN c ON d.source IS NOT DISTINCT FROM c.source),
m AS (SELECT doc_id, text, lang, source, n_chars, rate, sum(len(list_filter(cdf, lambda x: x <=
        ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, 'null') || '|' || j), 1, 13))::BIGINT / 4503599627370496.0)))::INT AS n_copies
      FROM u GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, n_copies, unnest(generate_series(1, n_copies))::INT AS copy
FROM m WHERE n_copies > 0
"""
