"""Paged JSON envelopes.

A landed response body is parsed once, into either its record array or the
reason why it has none (:func:`parse_bodies`); stored, that frame is what good
rows, rejects and hierarchies are all read from. Records are Variants, so a
missing key and an explicit ``null`` stay distinguishable for the functions
that care (P13, P14, P20); a record's position orders repeated keys inside a
page, see :func:`civitas.operators.dedupe.fold_batch`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civitas.functions.json import DOCUMENT, is_document, wrapped_document

Fields = Mapping[str, tuple[str, str] | str]


def parse_bodies(df: DataFrame, body_col: str = "body", path: str = "$.records",
                 rejects: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` with ``records`` (array<variant>) and ``reasons`` (empty for a readable body).

    Reasons: those of ``rejects`` that hold, ``invalid_body`` for NULL or
    anything but exactly one JSON value, ``records_not_array`` if what stands
    at ``path`` is no array, or on the way to it no object. A missing or null
    array is an empty one; a rejected body has none. A repeated key is no
    fault: its last value counts (``spark.sql.variant.allowDuplicateKeys``).
    Store the frame before it is read more than once: each body is parsed
    when it is written.
    """
    steps = path.removeprefix("$").lstrip(".").split(".")
    at = [DOCUMENT + "".join(f".{s}" for s in steps[:i + 1]) for i in range(len(steps))]
    arr = F.try_variant_get("__doc", at[-1], "array<variant>")

    # a type that copies nothing tells the kind; the value itself is copied out only where it is of another
    def other_than(kind: str, where: str) -> Column:
        x = F.variant_get("__doc", where, "variant")
        return F.when(F.try_variant_get("__doc", where, kind).isNull(), x.isNotNull() & ~F.is_variant_null(x)).otherwise(False)

    strange = other_than("array<boolean>", at[-1]) | F.try_variant_get("__doc", DOCUMENT, "struct<>").isNull()
    for where in at[:-1]:
        strange = strange | other_than("struct<>", where)
    found = {**(rejects or {}), "invalid_body": ~is_document("__doc"), "records_not_array": is_document("__doc") & strange}
    named = F.concat_ws(",", *[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in found.items()])
    parsed = df.withColumn("__doc", wrapped_document(body_col)).withColumn("reasons", named)
    return parsed.withColumn("records", F.when(F.col("reasons") == "", F.coalesce(arr, F.array().cast("array<variant>")))).drop("__doc")


def parsed_records(parsed: DataFrame, fields: Fields | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per record of :func:`parse_bodies`' frame.

    ``fields`` maps output column -> JSON key (read as string) or
    ``(json_key, spark_type)``. Output columns: ``keep``, ``record_index``
    (position in the page), ``record`` (the record as Variant) and the fields.
    """
    exploded = parsed.select(*keep, F.posexplode("records").alias("record_index", "record"))
    out = [f"`{k}`" for k in keep] + ["record_index", "record"]
    specs = {name: (spec, "string") if isinstance(spec, str) else spec for name, spec in (fields or {}).items()}
    plain = plain_keys(specs.values())
    for name, (key, typ) in specs.items():
        out.append(f"__fields.`{key}` AS `{name}`" if key in plain else f"try_variant_get(record, '$.{key}', '{typ}') AS `{name}`")
    if plain:       # one walk over a record, not one search per field
        exploded = exploded.withColumn("__fields", record_struct("record", plain))
    # one projection parsed JVM-side: wide records cost one call, not one per field
    return exploded.selectExpr(*out)


def plain_keys(specs: Iterable[tuple[str, str]]) -> dict[str, str]:
    """key -> type of the keys that can be fields of one struct: simple names, none twice in any case."""
    specs = list(specs)
    n = Counter(key.lower() for key, _ in specs)
    return {key: typ for key, typ in specs if n[key.lower()] == 1 and re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", key)}


def record_struct(record: str, types: Mapping[str, str]) -> Column:
    """The record's values under ``types`` (key -> type) as one struct; a missing value or one of another type is NULL."""
    ddl = ", ".join(f"`{key}`: {typ}" for key, typ in types.items())
    return F.expr(f"try_variant_get({record}, '$', 'struct<{ddl}>')")


def rejected_bodies(parsed: DataFrame) -> DataFrame:
    """The rows of :func:`parse_bodies`' frame that gave no records, with their reasons."""
    return parsed.filter("reasons <> ''").drop("records")


def explode_records(df: DataFrame, body_col: str, path: str = "$.records", fields: Fields | None = None,
                    keep: Sequence[str] = ()) -> DataFrame:
    """S4/S5 in one go: the records of readable bodies; the others give none (:func:`rejected_bodies` lists them)."""
    return parsed_records(parse_bodies(df.select(*dict.fromkeys([*keep, body_col])), body_col, path), fields, keep)
