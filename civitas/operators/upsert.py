"""Keyed upserts as DataFrame rewrites.

Parquet tables have no MERGE, so an upsert is a pure function
``(target, batch) -> new target`` that the caller writes to a new version
directory (never over the input it reads). The steps:

1. fold the batch so each key appears once, the way row-at-a-time upserts
   would leave it (:func:`civitas.operators.dedupe.fold_batch`, partial
   aggregation, so hot keys pre-reduce map-side);
2. one ``full_outer`` (or ``left``) join on the key, with non-NULL presence
   markers on each side; after folding both sides are unique per key, so
   the join has no skew however the batch was skewed;
3. one rule per column decides between old and new.

NULL keys never match (as in PostgreSQL): such batch rows are inserted as
they are, target rows with a NULL key survive untouched. Reject them first
with :func:`split_rejects` when the key is NOT NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civitas.operators.dedupe import fold_batch, row_hash
from civitas.session import scratch_path


@dataclass(frozen=True)
class Rule:
    kind: str                       # overwrite | keep | fill | sticky | stamp | custom
    value: object = None            # sticky value / stamp value
    fn: Callable[[Column, Column], Column] | None = None


GROUP_ROWS = 200_000    # rows of a component that one task settles: their keys only, some 100 bytes a row
OVERWRITE = Rule("overwrite")       # EXCLUDED.col on conflict; from the last batch row
KEEP = Rule("keep")                 # insert-only: set on insert, never updated
FILL = Rule("fill")                 # keep old unless NULL: coalesce(old, new)


def sticky(value) -> Rule:
    """Once the column holds ``value`` it keeps it; otherwise overwritten."""
    return Rule("sticky", value=value)


def stamp(value) -> Rule:
    """Set to ``value`` (a literal or Column, e.g. the load time) on every inserted or updated row."""
    return Rule("stamp", value=value)


def custom(fn: Callable[[Column, Column], Column]) -> Rule:
    """``fn(old, new)`` on conflict; the batch folds to its last row first."""
    return Rule("custom", fn=fn)


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def q(name: str) -> str:
    """Quote a column name for a SQL expression string."""
    return "`" + name.replace("`", "``") + "`"


def _sql_literal(v) -> str | None:
    """SQL text of a plain literal, or None when it is not one."""
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return None


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def fold_for(batch: DataFrame, key: str | Sequence[str], rules: Mapping[str, Rule], seq: str) -> DataFrame:
    """The batch as :func:`upsert` folds it under ``rules``: one row per key."""
    return _fold(batch, _keys(key), rules, seq)


def _fold(batch: DataFrame, keys: list[str], rules: Mapping[str, Rule], seq: str | None) -> DataFrame:
    """Fold the batch per key; sticky columns also carry an 'ever held value' flag."""
    data_cols = [c for c in batch.columns if c not in keys and c != seq]
    sticky_cols = [c for c in data_cols if rules.get(c, KEEP).kind == "sticky"]
    flagged = batch
    for c in sticky_cols:
        flagged = flagged.withColumn(f"__ever_{c}", F.col(c) == _lit(rules[c].value))
    if seq is None:
        return flagged
    last = [c for c in data_cols if rules.get(c, KEEP).kind in ("overwrite", "sticky", "custom")]
    fill = [c for c in data_cols if rules.get(c, KEEP).kind == "fill"]
    first = [c for c in data_cols if c not in last and c not in fill]
    # 'ever' flags fold with max (true wins) through first_non_null of a
    # true-only column: min_by over rows where the flag is true.
    ever = [f"__ever_{c}" for c in sticky_cols]
    for e in ever:
        flagged = flagged.withColumn(e, F.when(F.col(e), F.lit(True)))
    return fold_batch(flagged, keys, seq, last_cols=last, first_cols=first,
                      first_non_null_cols=fill + ever)


def _spread(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> Column:
    """0 for a complete key, else a hash of the row."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    return F.when(null, row_hash(df, columns)).otherwise(F.lit(0).cast("bigint"))


def one_per_key(rows: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``rows``, failing when a complete key occurs twice (a NULL key part never repeats)."""
    keys = _keys(key)
    rest = [c for c in rows.columns if c not in keys]
    counted = rows.withColumn("__solo", _spread(rows, keys, rows.columns)).groupBy(*keys, "__solo").agg(
        F.count(F.lit(1)).alias("__n"), *[F.first(F.col(q(c))).alias(c) for c in rest])
    repeated = (F.col("__n") > 1) & (F.col("__solo") == 0)
    checked = counted.withColumn("__ok", F.when(repeated, F.raise_error(
        F.lit(f"repeated key {keys} in a batch without seq"))).otherwise(F.col("__n")))
    # rows with a NULL key part that are equal in every column come back as often as they came
    return checked.select(F.explode(F.sequence(F.lit(1), F.col("__ok").cast("int"))), *[F.col(q(c)) for c in rows.columns]).drop("col")


def upsert(target: DataFrame, batch: DataFrame, key: str | Sequence[str],
           rules: Mapping[str, Rule] | None = None, seq: str | None = None,
           insert: bool = True) -> DataFrame:
    """U1-U3 (and U5 with ``insert=False``): ``INSERT ... ON CONFLICT (key) DO UPDATE``.

    ``rules`` maps target columns to a :class:`Rule`; columns without a rule
    are insert-only (set from the first batch row on insert, kept on update),
    which is what a ``DO UPDATE SET`` list leaves out. ``seq`` orders repeated
    keys inside the batch; without it the batch must be unique per key.
    Output has exactly the target's columns, in order.
    """
    keys = _keys(key)
    rules = dict(rules or {})
    out_cols = target.columns
    batch_cols = [c for c in batch.columns if c in out_cols or c == seq]
    b = _fold(batch.select(*batch_cols), keys, rules, seq)
    if seq is not None:
        b = b.drop(seq)
    # Wide tables: build the projections as SQL text, one JVM call per
    # column instead of a dozen Column calls each.
    b = b.selectExpr(*[f"{q(c)} AS {q('__n_' + c)}" for c in b.columns], "true AS __b")
    t = target.withColumn("__t", F.lit(True))
    # Rows with a NULL key part match nothing; a hash of the whole row joins
    # their key, so they spread over all partitions instead of meeting in one.
    t = t.withColumn("__ts", _spread(target, keys, target.columns))
    b = b.withColumn("__bs", _spread(b, [f"__n_{k}" for k in keys], b.columns))
    cond = t["__ts"] == b["__bs"]
    for k in keys:
        cond = cond & (t[k] == b[f"__n_{k}"])
    j = t.join(b, on=cond, how="full_outer" if insert else "left")
    have_new = set(b.columns)
    in_t, in_b = "__t IS NOT NULL", "__b IS NOT NULL"

    def new(c: str) -> str:
        return q(f"__n_{c}") if f"__n_{c}" in have_new else "NULL"

    sel: list[Column] = []
    dtypes = dict(target.dtypes)
    for c in out_cols:
        old, typ = q(c), dtypes[c]
        r = KEEP if c in keys else rules.get(c, KEEP)
        text = None
        if r.kind == "overwrite":
            text = f"CASE WHEN {in_b} THEN {new(c)} ELSE {old} END"
        elif r.kind == "keep":
            text = f"CASE WHEN {in_t} THEN {old} ELSE {new(c)} END"
        elif r.kind == "fill":
            text = (f"CASE WHEN {in_t} AND {in_b} THEN coalesce({old}, {new(c)}) "
                    f"WHEN {in_t} THEN {old} ELSE {new(c)} END")
        elif r.kind == "sticky" and _sql_literal(r.value) is not None:
            v = _sql_literal(r.value)
            ever = q(f"__n___ever_{c}") if f"__n___ever_{c}" in have_new else f"({new(c)} = {v})"
            text = (f"CASE WHEN {in_t} AND {old} = {v} THEN {v} WHEN {in_b} AND coalesce({ever}, false) THEN {v} "
                    f"WHEN {in_b} THEN {new(c)} ELSE {old} END")
        if text is not None:
            sel.append(F.expr(f"CAST(({text}) AS {typ}) AS {q(c)}"))
            continue
        old_c = F.col(c)
        new_c = F.col(f"__n_{c}") if f"__n_{c}" in have_new else F.lit(None)
        tb, bb = F.col("__t").isNotNull(), F.col("__b").isNotNull()
        if r.kind == "sticky":
            v = _lit(r.value)
            ever = F.col(f"__n___ever_{c}") if f"__n___ever_{c}" in have_new else (new_c == v)
            expr = (F.when(tb & (old_c == v), v).when(bb & F.coalesce(ever, F.lit(False)), v)
                    .when(bb, new_c).otherwise(old_c))
        elif r.kind == "stamp":
            expr = F.when(bb, _lit(r.value)).otherwise(old_c)
        elif r.kind == "custom":
            expr = F.when(tb & bb, r.fn(old_c, new_c)).when(bb, new_c).otherwise(old_c)
        else:
            raise ValueError(f"unknown rule {r.kind!r} for column {c!r}")
        sel.append(expr.cast(typ).alias(c))
    return j.select(*sel)


def update_from(target: DataFrame, changes: DataFrame, key: str | Sequence[str],
                set_cols: Sequence[str], seq: str | None = None,
                touch_col: str | None = None, as_of=None) -> DataFrame:
    """U5 (+U6): every target row whose key matches (all of them, e.g. all
    years of a school) takes the new values; no inserts. With ``touch_col``
    the matched rows are stamped with ``as_of``. ``seq`` orders repeated
    change keys; without it a repeated key is an error."""
    rules: dict[str, Rule] = {c: OVERWRITE for c in set_cols}
    if touch_col:
        rules[touch_col] = stamp(as_of if as_of is not None else F.current_timestamp())
    keys = _keys(key)
    ch = changes.select(*keys, *set_cols, *([seq] if seq else []))
    if seq is None:
        ch = one_per_key(ch, keys)
    return upsert(target, ch, keys, rules, seq=seq, insert=False)


def touch(df: DataFrame, changed: Column, col: str, as_of) -> DataFrame:
    """Stamp ``col`` with ``as_of`` on rows where ``changed`` holds."""
    return df.withColumn(col, F.when(changed, _lit(as_of)).otherwise(F.col(col)))


def insert_absent(target: DataFrame, batch: DataFrame, unique_keys: Sequence[str | Sequence[str]],
                  seq: str | None = None) -> DataFrame:
    """U4: ``INSERT ... ON CONFLICT DO NOTHING`` against several unique keys.

    As if row after row in ``seq`` order: a row goes in unless one of its
    unique keys is held by the target or by a batch row that went in before.
    A unique key with a NULL part never conflicts. With one key a row's fate
    depends on its key group only. With several, the rows that come first at
    all their keys go in at once, and what shares a key with them is out. Only
    rows all of whose repeated keys come first in a row still undecided stay
    open. Open rows that share keys, directly or through others, form a
    component: those of at most GROUP_ROWS rows are settled in row order,
    many to a task, a larger one by rounds that take the rows which come first
    at all their keys and drop what clashes with them; each round is a table in
    the shared folder. Returns target plus the inserted rows (target's
    columns). ``seq`` must be a total order: NULL or repeated values of it are
    refused. It may be left out with a single key (any row of a key may go in).
    """
    uks = [_keys(uk) for uk in unique_keys]
    if seq is None and len(uks) > 1:
        raise ValueError("several unique keys need seq: their result depends on the row order")
    rows = batch
    for ks in uks:
        held = target.select(*ks).dropna(how="any").distinct()
        rows = _at_key(rows, held, ks, "left_anti")
    cols, dtypes = target.columns, dict(target.dtypes)

    def complete(ks: Sequence[str]) -> Column:
        c = F.lit(True)
        for k in ks:
            c = c & F.col(k).isNotNull()
        return c

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(dtypes[c]).alias(c) for c in cols])

    if len(uks) == 1:
        ks = uks[0]
        if seq is None:
            first = rows.filter(complete(ks)).dropDuplicates(ks)
        else:
            rest = [c for c in rows.columns if c not in ks]
            first = rows.filter(complete(ks)).groupBy(*ks).agg(
                F.min_by(F.struct(*rest), F.col(seq)).alias("__r")).select(*ks, *[F.col(f"__r.{q(c)}").alias(c) for c in rest])
        free = rows.filter(~complete(ks))
        return target.unionByName(shaped(first.select(*rows.columns))).unionByName(shaped(free))

    rows = _stored(rows)
    unordered = rows.groupBy(seq).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(seq).isNull())
    if not unordered.isEmpty():     # such rows would wait for each other for ever
        raise ValueError(f"{seq} is NULL or repeated: it must order the batch")
    marked, first_at = rows, [f"__first_{i}" for i in range(len(uks))]     # NULL where no other row has the key
    for ks, name in zip(uks, first_at, strict=True):
        repeated = rows.filter(complete(ks)).groupBy(*ks).agg(F.count(F.lit(1)).alias("__n"), F.min(seq).alias(name))
        marked = _at_key(marked, _stored(repeated.filter("__n > 1").drop("__n")), ks, "left")
    firsts = [F.coalesce(F.col(name), F.col(seq)) for name in first_at]
    marked = _stored(marked.withColumn("__in", reduce(and_, [f == F.col(seq) for f in firsts])))
    waiting = marked.filter("NOT __in")
    blocked = _stored(waiting.filter(reduce(or_, [F.col(name) == F.col(seq) for name in first_at])).select(F.col(seq).alias("__b")))
    at_once = target.unionByName(shaped(marked.filter("__in")))
    if blocked.isEmpty():           # every first went in: whoever waits clashes with one
        return at_once
    for f, name in zip(firsts, first_at, strict=True):
        waiting = waiting.join(blocked, f == F.col("__b"), "left").filter(F.col(name).isNull() | F.col("__b").isNotNull()).drop("__b")
    rows = _stored(waiting)
    texts = [F.when(F.col(name).isNotNull(), F.concat(F.lit(f"{i}:"), F.to_json(F.struct(*ks))))
             for i, (ks, name) in enumerate(zip(uks, first_at, strict=True))]
    keyed = _stored(rows.select(F.col(seq).alias("u"), F.filter(F.array(*texts), lambda k: k.isNotNull()).alias("keys")))
    group = connected(keyed.select("u", F.explode("keys").alias("k")))
    size = _stored(group.groupBy("group").agg(F.count(F.lit(1)).alias("n")))
    sized = _stored(keyed.join(group.join(size, "group"), "u"))
    u_type = keyed.schema["u"].dataType.simpleString()

    def settle(batches):
        group, held = None, set()
        for b in batches:
            went_in = []
            for g, u, keys in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if g != group:
                    group, held = g, set()
                if held.isdisjoint(keys):
                    held.update(keys)
                    went_in.append(u)
            yield pa.RecordBatch.from_arrays([pa.array(went_in, b.schema.field("u").type)], names=["u"])

    small = sized.filter(F.col("n") <= GROUP_ROWS).select("group", "u", "keys").repartition("group").sortWithinPartitions("group", "u")
    inserted = small.mapInArrow(settle, f"u {u_type}")
    open_rows = _stored(sized.filter(F.col("n") > GROUP_ROWS).select("u", F.explode("keys").alias("k")))
    while not open_rows.isEmpty():
        firsts = open_rows.groupBy("k").agg(F.min("u").alias("first"))
        first = open_rows.join(firsts, "k").groupBy("u").agg(F.min(F.col("u") == F.col("first")).alias("ok")).filter("ok").select("u")
        first = _stored(first)
        inserted = inserted.unionByName(first)
        taken = open_rows.join(first, "u", "left_semi").select("k").distinct()
        clash = open_rows.join(taken, "k", "left_semi").select("u").distinct()
        open_rows = _stored(open_rows.join(clash, "u", "left_anti"))
    went_in = _stored(inserted).withColumnRenamed("u", seq)
    return at_once.unionByName(shaped(rows.join(went_in, seq, "left_semi")))


def _at_key(rows: DataFrame, keys: DataFrame, ks: Sequence[str], how: str) -> DataFrame:
    """``rows`` joined with ``keys`` (complete ones) on ``ks``; rows with a NULL key part match nothing and spread over all tasks."""
    spread = rows.withColumn("__spread", _spread(rows, ks, rows.columns))
    joined = spread.join(keys.withColumn("__spread", F.lit(0).cast("bigint")), [*ks, "__spread"], how)
    found = [] if how == "left_anti" else [c for c in keys.columns if c not in ks]
    return joined.select(*[F.col(q(c)) for c in (*rows.columns, *found)])


def connected(member: DataFrame) -> DataFrame:
    """``(u, group)`` of rows ``u`` that share keys ``k``, directly or through others; ``group`` is the smallest ``u``.

    Every round a row offers the smallest grandparent label met at its keys to
    itself and to its parent, and takes its grandparent's: the trees of labels
    shrink by a factor each round, chains included. Only labels move, and every
    round's labels are stored.
    """
    member = _stored(member.distinct())
    labels = _stored(member.select("u", F.col("u").alias("f"), F.col("u").alias("g")).distinct())
    while True:
        at_key = member.join(labels.select("u", "g"), "u").groupBy("k").agg(F.min("g").alias("m"))
        offered = _stored(labels.join(member.join(at_key, "k").groupBy("u").agg(F.min("m").alias("m")), "u"))
        hooks = offered.groupBy(F.col("f").alias("r")).agg(F.min("m").alias("h"))
        moved = offered.join(hooks, F.col("u") == F.col("r"), "left")
        moved = _stored(moved.select("u", F.least("f", "m", "g", F.coalesce("h", "f")).alias("f"), F.col("g").alias("old")))
        parents = moved.select(F.col("u").alias("p"), F.col("f").alias("g"))
        labels = _stored(moved.join(parents, F.col("f") == F.col("p")).select("u", "f", "g", "old"))
        if labels.filter("g <> old OR f <> g").isEmpty():
            return labels.select("u", F.col("g").alias("group"))
        labels = labels.drop("old")


def _stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, "insert")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def update_where(df: DataFrame, cond: Column, sets: Mapping[str, Column]) -> DataFrame:
    """``UPDATE df SET col = expr, ... WHERE cond`` for every matching row.

    All expressions read the row as it was, as in SQL.
    """
    return df.withColumns({c: F.when(cond, e).otherwise(F.col(c)) for c, e in sets.items()})


def split_rejects(df: DataFrame, rules: Mapping[str, Column],
                  checkpoint: bool = False) -> tuple[DataFrame, DataFrame]:
    """U8: ``(good, rejects)``; a rule is a Column that is true for a bad row.

    ``rejects`` keeps the row and adds ``reasons`` (comma list of rule names,
    in rule order). A NULL rule result counts as not bad. Both outputs
    derive from one staged frame; with ``checkpoint=True`` it is written
    once to the shared checkpoint folder, so writing both outputs parses
    the batch once (and survives executor loss) instead of twice.
    """
    reasons = F.concat_ws(",", *[F.when(F.coalesce(c, F.lit(False)), F.lit(name))
                                 for name, c in rules.items()])
    staged = df.withColumn("reasons", reasons)
    if checkpoint:
        staged = staged.checkpoint(eager=True)
    good = staged.filter(F.col("reasons") == F.lit("")).drop("reasons")
    bad = staged.filter(F.col("reasons") != F.lit(""))
    return good, bad
