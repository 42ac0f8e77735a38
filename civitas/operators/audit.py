"""Integrity rules re-aimed as data-quality jobs (K1-K6).

Each audit returns the violating rows (or keys) with a ``rule`` column;
:func:`audit` unions findings of several audits into one report of
``(rule, detail)`` rows. Every check is a filter, an anti join or a keyed
count, so it runs in one pass (plus one shuffle for keyed checks).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civitas.operators.joins import orphans


def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def audit_not_null(df: DataFrame, cols: Sequence[str], rule: str = "not_null") -> DataFrame:
    """K1: rows with a NULL in any NOT NULL column; ``column`` names the first."""
    first_null = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.withColumn("column", first_null).filter(F.col("column").isNotNull()) \
             .withColumn("rule", F.lit(rule))


def audit_unique(df: DataFrame, key: str | Sequence[str], where: Column | None = None,
                 rule: str = "unique") -> DataFrame:
    """K2/K3: keys held by more than one row (``n``); NULL parts never collide.

    ``where`` makes it a partial unique index (e.g. ``is_default``). The
    count aggregates partially map-side, so a hot key costs no skew.
    """
    ks = _keys(key)
    d = df if where is None else df.filter(where)
    for k in ks:
        d = d.filter(F.col(k).isNotNull())
    return (d.groupBy(*ks).agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > 1).withColumn("rule", F.lit(rule)))


def audit_reference(child: DataFrame, parent: DataFrame, fk: str | Sequence[str],
                    pk: str | Sequence[str] | None = None, rule: str = "reference") -> DataFrame:
    """K4: orphans of a foreign key (NULL references pass)."""
    return orphans(child, parent, fk, pk).withColumn("rule", F.lit(rule))


def audit_in(df: DataFrame, col: str, values: Sequence, rule: str = "allowed_values") -> DataFrame:
    """K5: value outside the allowed list; NULL passes (as a CHECK does)."""
    return df.filter(~F.col(col).isin(*values)).withColumn("rule", F.lit(rule))


def fits(col: str | Column, type_: str) -> Column:
    """True when the value fits a declared type: ``varchar(n)``, ``decimal(p,s)``,
    ``int``/``integer``/``bigint``/``smallint`` (NULL fits)."""
    c = F.col(col) if isinstance(col, str) else col
    t = type_.strip().lower().replace(" ", "")
    if t.startswith("varchar(") or t.startswith("char("):
        n = int(t[t.index("(") + 1:-1])
        return c.isNull() | (F.char_length(c.cast("string")) <= F.lit(n))
    if t.startswith("numeric(") or t.startswith("decimal("):
        p, s = t[t.index("(") + 1:-1].split(",")
        return c.isNull() | c.try_cast(f"decimal({int(p)},{int(s)})").isNotNull()
    if t in ("int", "integer", "smallint", "bigint"):
        target = {"integer": "int"}.get(t, t)
        return c.isNull() | c.try_cast(target).isNotNull()
    raise ValueError(f"unsupported type {type_!r}")


def audit_fits(df: DataFrame, col: str, type_: str, rule: str | None = None) -> DataFrame:
    """K6: values too long for ``VARCHAR(n)`` or out of range for a numeric type."""
    return df.filter(~fits(col, type_)).withColumn("rule", F.lit(rule or f"fits:{type_}"))


def audit(findings: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Union audits into ``(rule, detail)``; ``detail`` is the offending row as JSON."""
    parts = []
    for frame, name in findings:
        body = [c for c in frame.columns if c != "rule"]
        parts.append(frame.select(F.lit(name).alias("rule"),
                                  F.to_json(F.struct(*body)).alias("detail")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass(frozen=True)
class RuleSet:
    """Declared constraints of a set of tables; each entry names its table first.

    ``not_null``: (table, columns); ``unique``: (table, key columns, SQL
    condition or None); ``references``: (table, column, parent, parent
    column); ``allowed``: (table, column, values); ``types``: (table, column,
    declared type).
    """
    not_null: tuple[tuple[str, tuple[str, ...]], ...] = ()
    unique: tuple[tuple[str, tuple[str, ...], str | None], ...] = ()
    references: tuple[tuple[str, str, str, str], ...] = ()
    allowed: tuple[tuple[str, str, tuple], ...] = ()
    types: tuple[tuple[str, str, str], ...] = ()


def audit_tables(tables: Mapping[str, DataFrame], rules: RuleSet) -> DataFrame:
    """Every violation of the rules as ``(rule, detail)``, the rule named ``kind:table.column``.

    Rules on tables that are not given are left out. An empty rule set gives
    an empty report. A table is read once for all its row rules (NULLs,
    allowed values, types), once for all its unique keys, and once more for
    each of its references.
    """
    row_rules: dict[str, list[tuple[str, Column]]] = {}
    for t, cols in rules.not_null:
        row_rules.setdefault(t, []).extend((f"not_null:{t}.{c}", F.col(c).isNull()) for c in cols)
    for t, c, values in rules.allowed:
        row_rules.setdefault(t, []).append((f"allowed:{t}.{c}", ~F.col(c).isin(*values)))
    for t, c, kind in rules.types:
        row_rules.setdefault(t, []).append((f"type:{t}.{c}", ~fits(c, kind)))
    keys: dict[str, list[tuple[str, tuple[str, ...], str | None]]] = {}
    for t, key, where in rules.unique:
        keys.setdefault(t, []).append((f"unique:{t}.{'+'.join(key)}", key, where))
    found = [broken_rows(tables[t], named) for t, named in row_rules.items() if t in tables]
    found += [repeated_keys(tables[t], named) for t, named in keys.items() if t in tables]
    references = [(audit_reference(tables[t], tables[parent], c, pk), f"reference:{t}.{c}")
                  for t, c, parent, pk in rules.references if t in tables and parent in tables]
    if references:
        found.append(audit(references))
    if not found:
        return next(iter(tables.values())).limit(0).select(F.lit("").alias("rule"), F.lit("").alias("detail"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def broken_rows(df: DataFrame, named: Sequence[tuple[str, Column]]) -> DataFrame:
    """``(rule, detail)`` of every row rule a row breaks, in one scan; a NULL outcome is no breach."""
    broken = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in named]), lambda r: r.isNotNull())
    marked = df.withColumn("__broken", broken).filter(F.size("__broken") > 0)
    return marked.select(F.explode("__broken").alias("rule"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("detail"))


def repeated_keys(df: DataFrame, named: Sequence[tuple[str, Sequence[str], str | None]]) -> DataFrame:
    """``(rule, detail)`` of every key held by several rows, all ``(rule, key, condition)`` in one scan and one shuffle.

    A row gives one entry per rule, its key as JSON text; entries are counted
    by rule and key, in the task first. Keys with a NULL part never repeat.
    """
    entries = []
    for name, key, where in named:
        holds = F.expr(where) if where else F.lit(True)
        for k in key:
            holds = holds & F.col(k).isNotNull()
        entries.append(F.when(holds, F.struct(F.lit(name).alias("rule"), F.to_json(F.struct(*key)).alias("key"))))
    rows = df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("e.*")
    counted = rows.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return counted.select("rule", F.concat(F.expr("substr(key, 1, length(key) - 1)"), F.lit(',"n":'), F.col("n").cast("string"), F.lit("}")).alias("detail"))
