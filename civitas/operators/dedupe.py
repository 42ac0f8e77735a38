"""Best row per key, newest-N, batch folding and work queues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civitas.functions.cleaning import priority_position


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def distinct_on(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY keys, order``.

    ``order`` is a list of sort expressions, e.g. ``[F.col('v').desc_nulls_last(),
    F.col('id').asc()]``; a row survives even when every ``v`` is NULL. The
    rank-1 filter is planned as ``WindowGroupLimit`` before and after the
    shuffle, so a hot key is cut to one row per map task before it moves.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def keep_latest(df: DataFrame, group: str | Sequence[str], order: Sequence[Column], n: int = 5,
                touched: DataFrame | Column | None = None) -> DataFrame:
    """Keep the newest ``n`` rows per group, pruning only touched groups.

    ``touched`` holds the group columns of newly inserted rows, or is a
    condition that marks them in ``df`` (then one scan and one shuffle do);
    groups not touched are left as they are (rows are pruned on insert only).
    Ties in ``order`` must be broken by the caller (e.g. by id desc).
    """
    g = _cols(group)
    w = Window.partitionBy(*g).orderBy(*order)
    if touched is None:
        return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")
    if isinstance(touched, Column):
        marked = df.withColumn("__hit", F.max(F.coalesce(touched, F.lit(False))).over(Window.partitionBy(*g)))
    else:
        marked = df.join(touched.select(*g).distinct().withColumn("__hit", F.lit(True)), on=g, how="left")
    ranked = marked.withColumn("__rn", F.row_number().over(w))
    return ranked.filter(~F.coalesce("__hit", F.lit(False)) | (F.col("__rn") <= n)).select(*df.columns)


FIXED_WIDTH = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp")


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """A 64-bit hash of the row's columns that Spark can hash: all but those that hold maps or Variants."""
    types = dict(df.dtypes)
    kept = [c for c in columns if "map<" not in types[c] and "variant" not in types[c]]
    return F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in kept], F.lit(0))


def fold_batch(df: DataFrame, key: str | Sequence[str], seq: str,
               last_cols: Sequence[str] = (), first_cols: Sequence[str] = (),
               first_non_null_cols: Sequence[str] = ()) -> DataFrame:
    """Collapse repeated keys the way row-by-row upserts would.

    Columns in ``last_cols`` come from the last occurrence (by ``seq``),
    ``first_cols`` from the first, ``first_non_null_cols`` from the first
    occurrence where they are not NULL. Rows with a NULL key are passed
    through unfolded (NULL never matches NULL). A NULL ``seq`` has no place
    in the order and fails the fold. Aggregation is partial (map-side), so a
    hot key is pre-reduced before the shuffle.
    """
    k = _cols(key)
    df = df.withColumn(seq, F.when(F.col(seq).isNull(), F.raise_error(F.lit(f"NULL in {seq}, which orders the batch"))).otherwise(F.col(seq)))
    null_key = F.lit(False)
    for c in k:
        null_key = null_key | F.col(c).isNull()
    # A row with a NULL key part is its own group: its seq and a hash of the
    # row join the grouping key, so one aggregation serves both cases and the
    # input is computed once.
    staged = df.withColumn("__solo", F.when(null_key, F.struct(F.col(seq), row_hash(df, df.columns))))
    # Columns of fixed width keep an aggregate each (a hash aggregate); with
    # text among them the aggregate sorts anyway, and one struct per kind,
    # picked from the last (or first) row, costs one comparison of seq a row.
    def q(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    s_ = q(seq)

    def struct_of(cols: Sequence[str]) -> str:
        return f"struct({', '.join(q(c) for c in cols)})"

    types = dict(df.dtypes)
    fixed = all(types[c].startswith(FIXED_WIDTH) for c in (*last_cols, *first_cols))
    aggs: list[Column] = []
    if fixed:
        aggs += [F.expr(f"max_by({q(c)}, {s_}) AS {q(c)}") for c in last_cols]
        aggs += [F.expr(f"min_by({q(c)}, {s_}) AS {q(c)}") for c in first_cols]
    elif last_cols:
        aggs.append(F.expr(f"max_by({struct_of(last_cols)}, {s_}) AS __last"))
    if first_cols and not fixed:
        aggs.append(F.expr(f"min_by({struct_of(first_cols)}, {s_}) AS __first"))
    aggs += [F.expr(f"min_by({q(c)}, CASE WHEN {q(c)} IS NOT NULL THEN {s_} END) AS {q(c)}")
             for c in first_non_null_cols]
    aggs.append(F.expr(f"max({s_}) AS {s_}"))
    folded = staged.groupBy(*k, "__solo").agg(*aggs)
    if fixed:
        return folded.select(*k, *last_cols, *first_cols, *first_non_null_cols, seq)
    return folded.selectExpr(*[q(c) for c in k], *[f"__last.{q(c)} AS {q(c)}" for c in last_cols],
                             *[f"__first.{q(c)} AS {q(c)}" for c in first_cols], *[q(c) for c in first_non_null_cols], s_)


# Scrape statuses the enrichment work queues select.
NORMAL_QUEUE_STATUSES = ("pending", "partial")
RECOVERY_QUEUE_STATUSES = ("pending", "partial", "success")


def work_queue(df: DataFrame, state: str | None, mode: str = "normal", limit: int | None = None,
               state_col: str = "state_name", status_col: str = "scrape_status",
               code_col: str = "udise_code", year_col: str = "effective_year") -> DataFrame:
    """Schools to (re)process for one state, in the reference order.

    normal: status pending or partial, ``ORDER BY status DESC, code ASC``.
    recovery: status pending/partial/success with no effective year,
    ``ORDER BY status ASC, code ASC``. ``limit`` 0 or None means no limit
    (a limit is planned as ``TakeOrderedAndProject``: top-k per task, then merge).
    """
    q = df if state is None else df.filter(F.col(state_col) == F.lit(state))
    if mode == "normal":
        q = q.filter(F.col(status_col).isin(*NORMAL_QUEUE_STATUSES))
        q = q.orderBy(F.col(status_col).desc(), F.col(code_col).asc())
    elif mode == "recovery":
        q = q.filter(F.col(status_col).isin(*RECOVERY_QUEUE_STATUSES) & F.col(year_col).isNull())
        q = q.orderBy(F.col(status_col).asc(), F.col(code_col).asc())
    else:
        raise ValueError(f"mode must be 'normal' or 'recovery', not {mode!r}")
    return q.limit(limit) if limit else q


def priority_queue(df: DataFrame, states: Sequence[str], state_col: str = "state_name",
                   then: Sequence[Column] = (), limit: int | None = None) -> DataFrame:
    """Rows of the listed states only, in list order, then ``then``."""
    pos = priority_position(state_col, states)
    q = df.withColumn("priority", pos).filter(F.col("priority") > 0)
    q = q.orderBy(F.col("priority").asc(), *then)
    return q.limit(limit) if limit else q
