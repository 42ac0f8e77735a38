"""Landed HTTP responses: attempts, fragments, manifests, counters.

Input shape (one row per request attempt)::

    key, endpoint, attempt int, seq long, http_status int, body string

Every aggregate here is keyed and partial (map-side combine), so a key
holding a third of all rows is reduced inside each map task first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from civitas.functions.json import classify_response, is_document, wrapped_document


def resolve_attempts(responses: DataFrame, key: str | Sequence[str], max_attempts: int = 2,
                     stop_on_503: bool = True, attempt_col: str = "attempt",
                     status_col: str = "http_status", body_col: str = "body",
                     outcome: str = "valid", seq_col: str = "seq") -> DataFrame:
    """A5: one resolved row per key: ``code`` (200/503/404) and ``body``.

    Attempts beyond ``max_attempts`` never happened. With ``outcome='valid'``
    an attempt succeeds when P16 says 'ok' and a 503 met before any success
    ends the tries with 503 (enrichment). With ``outcome='http200'`` the first
    HTTP 200 with a JSON body wins (discovery; a body that is no JSON is tried
    again) and 503 is just a failure. Nothing decisive -> 404 with NULL body.
    If there is a fetch round ``seq_col``, the latest round of a key counts.
    """
    keys = [key] if isinstance(key, str) else list(key)
    r = responses.filter(F.col(attempt_col) <= F.lit(max_attempts))
    if outcome == "valid":
        cls = classify_response(status_col, body_col)
        is_ok = cls == F.lit("ok")
        is_stop = (cls == F.lit("retry")) if stop_on_503 else F.lit(False)
    elif outcome == "http200":
        is_ok = (F.col(status_col) == F.lit(200)) & is_document(wrapped_document(body_col))
        is_stop = F.lit(False)
    else:
        raise ValueError(f"outcome must be 'valid' or 'http200', not {outcome!r}")
    code = F.when(is_ok, F.lit(200)).when(is_stop, F.lit(503))
    # One partial aggregation: in the latest round the earliest decisive attempt.
    staged = r.select(*keys, code.alias("__code"), F.when(is_ok, F.col(body_col)).alias("__body"),
                      _precedence(r, seq_col, attempt_col, code).alias("__order"))
    first = staged.groupBy(*keys).agg(F.max_by(F.struct("__code", "__body"), "__order").alias("__first"))
    return first.select(*keys,
                        F.coalesce(F.col("__first.__code"), F.lit(404)).cast("int").alias("code"),
                        F.col("__first.__body").alias("body"))


def resolve_attempts_wide(responses: DataFrame, key: str | Sequence[str], names: Sequence[str],
                          name_col: str = "endpoint", max_attempts: int = 2, attempt_col: str = "attempt",
                          status_col: str = "http_status", body_col: str = "body", seq_col: str = "seq") -> DataFrame:
    """A5 for a fixed list of endpoints in one pass: one row per key with
    ``<name>_code`` and ``<name>_body`` per endpoint.

    Same rules as :func:`resolve_attempts` (``outcome='valid'``, 503 stops);
    ``<name>_code`` is NULL when the endpoint was never requested for the
    key. One keyed aggregation (partial, map-side) instead of one per
    endpoint, so a school's whole story moves through a single shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    r = responses.filter(F.col(attempt_col) <= F.lit(max_attempts))
    cls = classify_response(status_col, body_col)
    code = F.when(cls == F.lit("ok"), F.lit(200)).when(cls == F.lit("retry"), F.lit(503))
    staged = r.select(*keys, F.col(name_col).alias("__name"), _precedence(r, seq_col, attempt_col, code).alias("__order"),
                      code.alias("__code"), F.when(cls == F.lit("ok"), F.col(body_col)).alias("__body"))
    aggs = []
    for n in names:
        mine = F.col("__name") == F.lit(n)
        aggs.append(F.max_by(F.struct("__code", "__body"), F.when(mine, F.col("__order"))).alias(f"__r_{n}"))
        aggs.append(F.max(mine).alias(f"__seen_{n}"))
    wide = staged.filter(F.col("__name").isin(*names)).groupBy(*keys).agg(*aggs)
    out = [F.col(k) for k in keys]
    for n in names:
        out.append(F.when(F.col(f"__seen_{n}"), F.coalesce(F.col(f"__r_{n}.__code"), F.lit(404)))
                   .cast("int").alias(f"{n}_code"))
        out.append(F.col(f"__r_{n}.__body").alias(f"{n}_body"))
    return wide.select(*out)


def _precedence(responses: DataFrame, seq_col: str, attempt_col: str, code: Column) -> Column:
    """Order of attempts, the deciding one last: latest round, decisive before not, earliest attempt."""
    rnd = F.col(seq_col).cast("bigint") if seq_col in responses.columns else F.lit(0).cast("bigint")
    return F.struct(rnd, code.isNotNull(), -F.col(attempt_col))


def manifest_of(entries: Sequence[tuple[str, Column]]) -> Column:
    """A4 on one row: JSON object name -> code of the entries whose code is
    not NULL, keys in the given order (pass them sorted)."""
    arr = F.array(*[F.struct(F.lit(n).alias("k"), c.cast("int").alias("v")) for n, c in entries])
    kept = F.filter(arr, lambda e: e["v"].isNotNull())
    return F.when(F.size(kept) > 0, F.to_json(F.map_from_entries(kept)))


def assemble_fragments(docs: DataFrame, key: str | Sequence[str], names: Sequence[str],
                       name_col: str = "endpoint", doc_col: str = "body", seq_col: str = "seq",
                       columns: dict[str, str] | None = None) -> DataFrame:
    """A3: one row per key, one column per fragment name; later ``seq`` wins.

    ``names`` is the fixed endpoint list (no extra job to discover pivot
    values). ``columns`` optionally renames endpoint -> output column.
    A fragment that never arrived is NULL (merge with ``coalesce(new, old)``).
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = columns or {}
    # One conditional aggregate per name (max_by skips rows whose ordering
    # is NULL, i.e. other endpoints): a single keyed aggregation and shuffle,
    # where pivot plans two.
    aggs = [F.max_by(F.col(doc_col), F.when(F.col(name_col) == F.lit(n), F.col(seq_col))).alias(cols.get(n, n))
            for n in names]
    return docs.groupBy(*keys).agg(*aggs)


def build_manifest(results: DataFrame, key: str | Sequence[str], name_col: str = "endpoint",
                   code_col: str = "code", seq_col: str | None = None,
                   names: Sequence[str] | None = None) -> DataFrame:
    """A4: ``manifest`` JSON ``{endpoint: code}`` per key, keys sorted.

    With the endpoint list ``names`` known, one conditional aggregation per
    name builds it in a single keyed pass. Otherwise rows are first reduced
    to one per (key, endpoint) (the latest by ``seq_col`` when given), so
    each key's list is bounded by its number of distinct endpoints.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if names is not None:
        order = F.col(seq_col) if seq_col else F.col(code_col)
        aggs = [F.max_by(F.col(code_col), F.when(F.col(name_col) == F.lit(n), order)).alias(f"__m_{i}")
                for i, n in enumerate(names)]
        wide = results.groupBy(*keys).agg(*aggs)
        entries = sorted((n, F.col(f"__m_{i}")) for i, n in enumerate(names))
        return wide.select(*keys, manifest_of(entries).alias("manifest"))
    if seq_col:
        per = results.groupBy(*keys, name_col).agg(F.max_by(code_col, seq_col).alias(code_col))
    else:
        per = results.groupBy(*keys, name_col).agg(F.max(code_col).alias(code_col))
    entries = F.array_sort(F.collect_list(F.struct(F.col(name_col), F.col(code_col))))
    return per.groupBy(*keys).agg(F.to_json(F.map_from_entries(entries)).alias("manifest"))


def with_metrics(df: DataFrame, name: str, reject_col: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach load counters (rows, rejected) measured while the job runs.

    Read ``obs.get`` after the first action on the returned frame.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if reject_col:
        metrics.append(F.count_if(F.col(reject_col)).alias("rejected"))
    return df.observe(obs, *metrics), obs
