"""JSON column expressions.

Two parsing styles, chosen by what the semantics need:

* ``from_json`` into an all-STRING struct: one parse per document for many
  fields; a field reads as the raw text of its JSON value, the way
  PostgreSQL's ``->>`` does. Casting that text with ANSI ``cast`` raises on
  ``'1.0'``, ``'abc'`` and ``''`` exactly like ``::INTEGER``.
* Variant (``try_parse_json``): needed where the JSON *type* decides the
  answer (number 1 vs string ``"1"``), or where a missing key and an
  explicit ``null`` mean different things.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _split_path(path: str) -> list[str]:
    p = path[2:] if path.startswith("$.") else path.lstrip("$")
    return [s for s in p.split(".") if s]


def _nested_string_schema(paths: Sequence[Sequence[str]]) -> str:
    """DDL for a struct holding every path as STRING leaves."""
    tree: dict = {}
    for parts in paths:
        node = tree
        for i, part in enumerate(parts):
            if i == len(parts) - 1:
                node.setdefault(part, None)
            else:
                nxt = node.get(part)
                if nxt is None:
                    nxt = {}
                    node[part] = nxt
                node = nxt

    def render(node: dict) -> str:
        fields = []
        for k, v in node.items():
            typ = "string" if v is None else f"struct<{render(v)}>"
            fields.append(f"`{k}`: {typ}")
        return ", ".join(fields)

    return f"struct<{render(tree)}>"


def json_struct(doc: ColumnOrName, paths: Sequence[str]) -> Column:
    """Parse ``doc`` once into a struct holding each path as text."""
    split = [_split_path(p) for p in paths]
    return F.from_json(_c(doc), _nested_string_schema(split))


def json_text(doc: ColumnOrName, path: str) -> Column:
    """``doc->'a'->>'b'`` as text; missing path or JSON null -> NULL."""
    parts = _split_path(path)
    parsed = json_struct(doc, [path])
    out = parsed
    for p in parts:
        out = out.getField(p)
    return out


def text_to_int(text: Column, on_bad: str = "fail") -> Column:
    """Text to INT the way ``::INTEGER`` does (fail) or as NULL (``null``)."""
    if on_bad == "fail":
        return text.cast("int")
    if on_bad == "null":
        return text.try_cast("int")
    raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")


def json_int(doc: ColumnOrName, path: str, on_bad: str = "fail") -> Column:
    """P5: JSON path as integer; malformed text raises (or NULL)."""
    return text_to_int(json_text(doc, path), on_bad)


def text_flag(text: Column, on_bad: str = "fail") -> Column:
    """P6 on already-extracted text: ``text::INTEGER = 1`` (three-valued)."""
    return text_to_int(text, on_bad) == F.lit(1)


def json_flag(doc: ColumnOrName, path: str, on_bad: str = "fail") -> Column:
    """Lenient three-valued flag; 1 or "1" -> true, 2 -> false, missing -> NULL."""
    return text_flag(json_text(doc, path), on_bad)


# ---------------------------------------------------------------- Variant side

def variant(doc: ColumnOrName) -> Column:
    """Parse JSON text to Variant; invalid JSON -> NULL."""
    return F.try_parse_json(_c(doc))


# A body wrapped as the first entry of an array that ends with a mark: whatever follows the body's one value makes the
# array invalid, longer, or end without the mark. The parser by itself stops behind the first value.
_MARK = "civitas end of body"
DOCUMENT = "$[0]"


def wrapped_document(body: ColumnOrName) -> Column:
    """Variant array of the body's JSON value, at :data:`DOCUMENT`, and a mark; see :func:`is_document`."""
    return F.try_parse_json(F.concat(F.lit("["), _c(body), F.lit(f',"{_MARK}"]')))


def is_document(wrapped: ColumnOrName) -> Column:
    """The wrapped body is exactly one JSON value (two-valued: NULL and broken bodies are not)."""
    w = _c(wrapped)
    return F.coalesce((F.try_variant_get(w, "$[1]", "string") == F.lit(_MARK))
                      & F.variant_get(w, "$[2]", "variant").isNull(), F.lit(False))


def vget(v: Column, path: str) -> Column:
    """Sub-variant at ``path``: SQL NULL when missing, variant null when JSON null."""
    return F.variant_get(v, path, "variant")


def _is_textual(x: Column) -> Column:
    return F.schema_of_variant(x) == F.lit("STRING")


def strict_flag(v: Column, path: str) -> Column:
    """Two-valued ``value == 1`` with Python equality.

    Number or boolean equal to 1 -> true; ``"1"``, 2, 1.5, false, null,
    missing, object, no document -> false.
    """
    x = vget(v, path)
    return F.coalesce(~_is_textual(x) & (F.try_variant_get(x, "$", "double") == F.lit(1.0)),
                      F.lit(False))


def json_or(v: Column, path: str, default, as_type: str = "int") -> Column:
    """P20: value at path, ``default`` when the key is missing; JSON null stays NULL."""
    x = vget(v, path)
    return F.when(x.isNull(), F.lit(default).cast(as_type)).otherwise(
        F.try_variant_get(x, "$", as_type))


def initial_status(v: Column, status_path: str = "$.schoolStatus",
                   name_path: str = "$.schoolStatusName") -> Column:
    """struct(school_status, status_name, scrape_status) from a record.

    A missing status counts as 0; number/boolean equal to 0 -> 'pending';
    anything else (explicit null, text "0", 1 ...) -> 'closed_registry'.
    A missing name -> 'Unknown'; an explicit null name stays NULL.
    """
    s = vget(v, status_path)
    n = vget(v, name_path)
    status_is_zero = s.isNull() | F.coalesce(
        ~_is_textual(s) & (F.try_variant_get(s, "$", "double") == F.lit(0.0)), F.lit(False))
    status_value = F.when(s.isNull(), F.lit(0)).otherwise(F.try_variant_get(s, "$", "int"))
    name_value = F.when(n.isNull(), F.lit("Unknown")).otherwise(F.try_variant_get(n, "$", "string"))
    return F.struct(
        status_value.alias("school_status"),
        name_value.alias("status_name"),
        F.when(status_is_zero, F.lit("pending")).otherwise(F.lit("closed_registry")).alias("scrape_status"),
    )


def truthy_text(v: Column, path: str) -> Column:
    """Python truthiness then ``str``; falsy (0, false, "", null, missing, [], {}) -> NULL.

    The string ``"0"`` is truthy and stays ``'0'``.
    """
    x = vget(v, path)
    typ = F.schema_of_variant(x)
    as_text = F.try_variant_get(x, "$", "string")
    as_num = F.try_variant_get(x, "$", "double")
    falsy = (
        x.isNull() | F.is_variant_null(x)
        | ((typ == F.lit("STRING")) & (as_text == F.lit("")))
        | ((typ != F.lit("STRING")) & (as_num == F.lit(0.0)))
        | (F.to_json(x).isin("[]", "{}"))
    )
    # a float prints with its point: 560001.0, not 560001
    is_float = (typ == F.lit("DOUBLE")) | (typ == F.lit("FLOAT")) | typ.startswith("DECIMAL")
    whole = (as_num == F.floor(as_num)) & (F.abs(as_num) < F.lit(1e16))
    text = (F.when(typ == F.lit("BOOLEAN"), F.lit("True"))
            .when(typ.startswith("ARRAY") | typ.startswith("OBJECT"), F.to_json(x))
            .when(is_float & whole, F.concat(as_num.try_cast("bigint").cast("string"), F.lit(".0")))
            .otherwise(as_text))
    return F.when(falsy, F.lit(None).cast("string")).otherwise(text)


def classify_response(http_status: ColumnOrName, body: ColumnOrName) -> Column:
    """503 -> 'retry'; 200 whose JSON ``status`` is boolean true -> 'ok'; else 'bad'.

    The body must be exactly one JSON value: single quotes, text behind the
    closing bracket and other broken JSON are 'bad', as are the string
    ``"true"``, a number or an array document. A repeated key keeps the last
    value, as the source's parser does.
    """
    # the body and a mark as the two entries of an array: from_json reads the one field it needs and skips the rest
    both = F.from_json(F.concat(F.lit("["), _c(body), F.lit(f',{{"mark":"{_MARK}"}}]')),
                       "array<struct<status: boolean, mark: string>>", {"allowSingleQuotes": "false"})

    def is_ok(x: Column) -> Column:
        return (F.size(x) == F.lit(2)) & (F.get(x, F.lit(1)).getField("mark") == F.lit(_MARK)) & F.get(x, F.lit(0)).getField("status")

    ok = F.get(F.transform(F.array(both), is_ok), F.lit(0))     # bound to a lambda variable: parsed once
    code = _c(http_status)
    return (F.when(code == F.lit(503), F.lit("retry"))
            .when((code == F.lit(200)) & F.coalesce(ok, F.lit(False)), F.lit("ok"))
            .otherwise(F.lit("bad")))


def json_is_object(doc: ColumnOrName) -> Column:
    """The text is one JSON object (two-valued)."""
    w = wrapped_document(doc)
    return is_document(w) & F.try_variant_get(w, DOCUMENT, "map<string, variant>").isNotNull()


def json_map_set(doc: ColumnOrName, field: str, value_by_key: dict[str, list[str]], default: list[str]) -> Column:
    """Set ``field`` of every entry of a JSON object of objects.

    Keys named in ``value_by_key`` get their list, all others ``default``.
    Entries are maps of Variants, so fields nobody names, their types and
    explicit nulls stay. NULL for text that is no object of objects, an
    entry that is null included.
    """
    parsed = F.from_json(_c(doc), "map<string, map<string, variant>>", {"allowSingleQuotes": "false"})
    parsed = F.when(~F.exists(F.map_values(parsed), lambda e: e.isNull()), parsed)

    def listed(values: list[str]) -> Column:
        return F.to_variant_object(F.array(*[F.lit(x) for x in values]).cast("array<string>"))

    def pick(k: Column) -> Column:
        expr = listed(default)
        for key, vals in value_by_key.items():
            expr = F.when(k == F.lit(key), listed(vals)).otherwise(expr)
        return expr

    def rewritten(k: Column, e: Column) -> Column:
        others = F.map_filter(e, lambda name, _: name != F.lit(field))
        return F.map_concat(others, F.create_map(F.lit(field), pick(k)))

    return F.to_json(F.transform_values(parsed, rewritten))


def profile_fields(doc: ColumnOrName, fields: dict[str, str], root: str = "data") -> Column:
    """Optional nested values passed through as text (one parse)."""
    parsed = json_struct(doc, [f"{root}.{src}" for src in fields.values()])
    base = parsed.getField(root)
    return F.struct(*[base.getField(src).alias(dst) for dst, src in fields.items()])
