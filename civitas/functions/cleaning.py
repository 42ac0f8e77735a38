"""Scalar cleaning expressions.

All are built-in column expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def project(df: DataFrame, mapping: Mapping[str, ColumnOrName]) -> DataFrame:
    """Output name -> source column (or expression); keeps mapping order."""
    return df.select(*[_c(src).alias(dst) for dst, src in mapping.items()])


def composite_key(*cols: ColumnOrName, sep: str = "-") -> Column:
    """``a || '-' || b ...``; NULL when any part is NULL (not ``concat_ws``)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_c(c).cast("string"))
    return F.concat(*parts)


def where_present(df: DataFrame, *cols: str) -> DataFrame:
    """NOT NULL gate; pushed down to the Parquet scan."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def na(col: ColumnOrName, sentinel: int = -1) -> Column:
    """NULL -> sentinel so that 'unknown' differs from 0."""
    return F.coalesce(_c(col), F.lit(sentinel))


def total_or_parts(total: ColumnOrName, *parts: ColumnOrName,
                   stated_sentinel_falls_back: bool = True, sentinel: int = -1) -> Column:
    """Stated total; else the sum of known parts (unknown counts 0); else sentinel.

    Inputs are already sentinel-coded (P8). With ``stated_sentinel_falls_back``
    a stated sentinel also falls back to the parts (student rule); otherwise
    only a NULL total does (teacher rule: pass the raw, un-coded total).
    """
    t = _c(total)
    ps = [_c(p) for p in parts]
    known = F.lit(False)
    acc = F.lit(0)
    for p in ps:
        known = known | (p != F.lit(sentinel))
        acc = acc + F.greatest(F.lit(0), p)
    fallback = F.when(known, acc).otherwise(F.lit(sentinel))
    missing = (t == F.lit(sentinel)) if stated_sentinel_falls_back else t.isNull()
    return F.when(missing, fallback).otherwise(t)


# Fixed value: the numeric text accepted by Python's float() for finite
# decimal input (sign, digits with optional point, optional exponent,
# surrounding blanks). Underscores between digits are removed first.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def clean_int(col: ColumnOrName) -> Column:
    """P10: lenient integer ``int(float(x))``; NULL, text, infinity, NaN -> 0.

    Decimals are cut toward zero and ``1e3`` reads as 1000. A finite value
    beyond BIGINT reads as the largest (smallest) BIGINT, so the range check
    of :func:`civitas.operators.audit.fits` against a smaller type refuses it.
    """
    raw = _c(col).cast("string")
    # the lookbehind regex is costly: only text holding '_' needs it
    s = F.when(raw.contains("_"), F.regexp_replace(raw, r"(?<=\d)_(?=\d)", "")).otherwise(raw)
    d = s.try_cast("double")
    top = F.lit((1 << 63) - 1)
    # the cast fails beyond BIGINT only: the usual value is read once
    beyond = F.when(F.abs(d) == F.lit(float("inf")), F.lit(0)).when(d > 0, top).when(d < 0, -top)
    return F.coalesce(F.when(s.rlike(NUMERIC_TEXT), F.coalesce(d.try_cast("bigint"), beyond)), F.lit(0).cast("bigint"))


def row_sum(*cols: ColumnOrName) -> Column:
    """Sum of cleaned parts as BIGINT (the source total is ignored)."""
    out = F.lit(0).cast("bigint")
    for c in cols:
        out = out + _c(c).cast("bigint")
    return out


def unmask_code(code: ColumnOrName, block: ColumnOrName, keep: int = 5) -> Column:
    """NULL/empty code or block -> NULL; no '*' -> code; else block + last 5."""
    c = _c(code).cast("string")
    b = _c(block).cast("string")
    blank = c.isNull() | (c == F.lit("")) | b.isNull() | (b == F.lit(""))
    return (F.when(blank, F.lit(None).cast("string"))
            .when(~c.contains("*"), c)
            .otherwise(F.concat(b, F.right(c, F.lit(keep)))))


def slug(col: ColumnOrName) -> Column:
    """Spaces to underscores, lower case."""
    return F.lower(F.translate(_c(col), " ", "_"))


def completeness(*codes: ColumnOrName, ok: int = 200) -> Column:
    """P17: 'success' when every required part is 200, else 'partial' (NULL is not 200)."""
    cond = F.lit(True)
    for c in codes:
        cond = cond & F.coalesce(_c(c) == F.lit(ok), F.lit(False))
    return F.when(cond, F.lit("success")).otherwise(F.lit("partial"))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add literal defaults only for columns the input does not supply.

    Values may be Python literals or Columns (e.g. an explicit load time).
    """
    present = set(df.columns)
    out = df
    for name, value in defaults.items():
        if name not in present:
            out = out.withColumn(name, value if isinstance(value, Column) else F.lit(value))
    return out


def lookup_code(col: ColumnOrName, mapping: Mapping[str, int]) -> Column:
    """Case-insensitive dictionary lookup; unknown -> NULL (reject upstream)."""
    pairs: list[Column] = []
    for k, v in mapping.items():
        pairs += [F.lit(k.upper()), F.lit(v)]
    return F.create_map(*pairs)[F.upper(_c(col))]


def priority_position(col: ColumnOrName, order: Sequence[str]) -> Column:
    """Position (1-based) of a value in a priority list; 0 when absent."""
    return F.array_position(F.array(*[F.lit(x) for x in order]), _c(col)).cast("int")
