"""Joins (J1-J6).

No side is hinted for broadcast: AQE measures each shuffle at run time and
turns a sort-merge join into a broadcast join only when the measured side
is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``. That keeps the
broadcast behind a proven size bound however the inputs grow.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civitas.session import scratch_path


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _eq(left: DataFrame, right: DataFrame, lk: Sequence[str], rk: Sequence[str]) -> Column:
    cond = None
    for a, b in zip(lk, rk, strict=True):
        c = left[a] == right[b]
        cond = c if cond is None else cond & c
    return cond


def enrich_left(master: DataFrame, detail: DataFrame, left_on: str | Sequence[str],
                right_on: str | Sequence[str] | None = None) -> DataFrame:
    """Master LEFT JOIN optional enrichment; every master row survives."""
    lk = _keys(left_on)
    rk = _keys(right_on) if right_on is not None else lk
    if lk == rk:
        return master.join(detail, on=lk, how="left")
    return master.join(detail, on=_eq(master, detail, lk, rk), how="left")


def best_match_left(master: DataFrame, detail: DataFrame, left_on: str, right_on: str,
                    order: Sequence[Column]) -> DataFrame:
    """J1 + W1: ``SELECT DISTINCT ON (master key) ... FROM master LEFT JOIN
    detail ... ORDER BY key, <order over detail columns>``.

    Because the ranking reads only detail columns, the best detail row per
    key is chosen *before* the join (a ``WindowGroupLimit`` that trims each
    map task first), so a key holding a third of the detail rows never
    reaches the join: the join is at most 1:1 per master row. A final
    rank-1 cut on the master key keeps the DISTINCT ON meaning when the
    master itself repeats a key (no extra shuffle: the join output is
    already partitioned by that key).
    """
    from civitas.operators.dedupe import distinct_on
    best = distinct_on(detail, right_on, order)
    joined = enrich_left(master, best, left_on, right_on)
    return distinct_on(joined, left_on, order)


def expand_hierarchy(levels: Sequence[tuple[DataFrame, str | None, str]]) -> DataFrame:
    """Chain parent -> child levels with inner joins.

    ``levels`` is ``[(df, parent_key, key), ...]`` top-down; a level's
    ``parent_key`` names the column holding its parent's ``key``. A level
    with no children yields nothing (inner join). Columns of each level are
    expected to be distinct (names come from the hierarchy, not the record).
    """
    out, _, prev_key = levels[0]
    for df, parent_key, key in levels[1:]:
        if parent_key == prev_key:
            out = out.join(df, on=parent_key, how="inner")
        else:
            out = out.join(df, on=out[prev_key] == df[parent_key], how="inner")
        prev_key = key
    return out


def orphans(child: DataFrame, parent: DataFrame, fk: str | Sequence[str],
            pk: str | Sequence[str] | None = None) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    fks = _keys(fk)
    pks = _keys(pk) if pk is not None else fks
    present = child
    for c in fks:
        present = present.filter(F.col(c).isNotNull())
    parent_keys = parent.select(*[F.col(p).alias(f"__pk{i}") for i, p in enumerate(pks)])
    cond = None
    for i, c in enumerate(fks):
        e = present[c] == parent_keys[f"__pk{i}"]
        cond = e if cond is None else cond & e
    return present.join(parent_keys, on=cond, how="left_anti")


def cascade_delete(doomed_keys: DataFrame, key: str,
                   children: Sequence[tuple[DataFrame, str, str | None]]) -> list[DataFrame]:
    """J4 along a chain ``[(df, fk, own_key), ...]``: the surviving frame of every level.

    Each level's rows whose ``fk`` is doomed go, and their ``own_key`` values
    doom the next level (see :func:`cascade_tree` for any other shape).
    """
    tables = {"0": doomed_keys}
    links, up, up_key = [], "0", key
    for i, (df, fk, own_key) in enumerate(children, 1):
        tables[str(i)] = df
        links.append((str(i), fk, up, up_key))
        up, up_key = str(i), own_key
    kept = cascade_tree(tables, links, "0", doomed_keys.select(key), key)
    return [kept[str(i)] for i in range(1, len(children) + 1)]


def cascade_tree(tables: Mapping[str, DataFrame], links: Sequence[tuple[str, str, str, str]],
                 root: str, doomed_keys: DataFrame, key: str) -> dict[str, DataFrame]:
    """Delete rows of ``root`` by key, and everything that references them.

    ``links`` are ``(child, fk, parent, parent_key)``; a parent may have many
    children and a child many parents (links must not form a circle). A child
    row goes if any of its references is to a deleted row; a NULL reference
    is to none. Returns the surviving rows of every table, the root's too.

    Every row is marked once, by one join per reference with the distinct
    deleted keys. A table that others reference is stored with its marks, and
    its survivors and deleted keys are read from there; one that nothing
    references is not stored, its survivors come from anti joins.
    """
    order, waiting = [root], [x for x in tables if x != root]
    while waiting:
        ready = [x for x in waiting if all(p in order for c, _, p, _ in links if c == x)]
        if not ready:
            raise ValueError("the links form a circle")
        order += ready
        waiting = [x for x in waiting if x not in ready]
    gone, kept = {}, {}
    for name in order:
        df = tables[name]
        hits = [(key, doomed_keys, key)] if name == root else []
        hits += [(fk, gone[p], pk) for c, fk, p, pk in links if c == name]
        keys = [(fk, k.select(F.col(pk).alias(f"__d{i}")).distinct()) for i, (fk, k, pk) in enumerate(hits)]
        if not any(p == name for _, _, p, _ in links):
            for i, (fk, k) in enumerate(keys):
                df = df.join(k, df[fk] == k[f"__d{i}"], "left_anti")
            kept[name] = df
            continue
        hit, marked = F.lit(False), df
        for i, (fk, k) in enumerate(keys):
            marked = marked.join(k, marked[fk] == k[f"__d{i}"], "left")
            hit = hit | F.col(f"__d{i}").isNotNull()
        marked = _stored(marked.select(*[F.col(f"`{c}`") for c in df.columns], hit.alias("__gone")))
        kept[name] = marked.filter("NOT __gone").drop("__gone")
        gone[name] = marked.filter("__gone")
    return kept


def _stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, "marked")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def resolve_effective_year(schools: DataFrame, primary: DataFrame, probe: DataFrame,
                           key: str = "school_id", current_year: int = 12,
                           fallback_year: int = 11) -> DataFrame:
    """Effective year per school from resolved responses.

    ``primary`` and ``probe`` hold one resolved row per key with columns
    ``code`` (200/503/404) and, for ``primary``, ``year`` (the document's
    year, NULL when the key is missing there). Primary 200 -> its year or
    ``current_year``; else probe 200 -> ``fallback_year``; else
    ``missing_on_server`` with ``current_year``. One row per school.
    """
    p = primary.select(F.col(key), F.col("code").alias("__pcode"), F.col("year").alias("__pyear"))
    q = probe.select(F.col(key), F.col("code").alias("__qcode"))
    j = schools.join(p, on=key, how="left").join(q, on=key, how="left")
    year, missing = effective_year(F.col("__pcode"), F.coalesce(F.col("__pyear"), F.lit(current_year)),
                                   F.col("__qcode"),
                                   current_year, fallback_year)
    return (j.withColumn("effective_year", year).withColumn("missing_on_server", missing)
             .drop("__pcode", "__pyear", "__qcode"))


def effective_year(primary_code: Column, primary_year: Column, probe_code: Column,
                   current_year: int = 12, fallback_year: int = 11) -> tuple[Column, Column]:
    """J5 as expressions on one row: ``(effective_year, missing_on_server)``.

    A primary year that is explicitly NULL stays NULL (the caller decides
    what that means); a missing one was already defaulted by P20.
    """
    primary_ok = F.coalesce(primary_code == 200, F.lit(False))
    probe_ok = F.coalesce(probe_code == 200, F.lit(False))
    year = (F.when(primary_ok, primary_year)
            .when(probe_ok, F.lit(fallback_year))
            .otherwise(F.lit(current_year)).cast("int"))
    return year, ~primary_ok & ~probe_ok


def lookup(df: DataFrame, col: str, value) -> DataFrame:
    """Targeted lookup by a business key (pushed down to the scan)."""
    return df.filter(F.col(col) == F.lit(value))
