"""Property tests for the upsert engine."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from civitas.operators import upsert as U

RULES = {"name": U.OVERWRITE, "parent": U.KEEP, "status": U.sticky("success"), "eff": U.FILL}
DDL = "k int, name string, parent string, status string, eff int"

keys = st.one_of(st.none(), st.integers(0, 6))
row = st.tuples(keys, st.sampled_from(["a", "b", "c"]), st.sampled_from(["p", "q"]),
                st.sampled_from(["pending", "partial", "success"]), st.one_of(st.none(), st.integers(10, 13)))


def table(df):
    return sorted((tuple((v is None, v) for v in r) for r in df.collect()))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target_rows=st.lists(row, max_size=5, unique_by=lambda r: r[0]), batch_rows=st.lists(row, max_size=8),
       cut=st.integers(0, 8))
def test_split_batches_equal_whole_and_idempotent(spark, target_rows, batch_rows, cut):
    target_rows = [r for r in target_rows if r[0] is not None]
    target = spark.createDataFrame(target_rows, DDL)
    batch = spark.createDataFrame([(*r, i) for i, r in enumerate(batch_rows)], DDL + ", seq int")
    whole = U.upsert(target, batch, "k", RULES, seq="seq")
    first = U.upsert(target, batch.filter(f"seq < {cut}"), "k", RULES, seq="seq")
    split = U.upsert(first, batch.filter(f"seq >= {cut}"), "k", RULES, seq="seq")
    # NULL keys never match, so they are inserted once per occurrence either way
    assert table(whole) == table(split)
    nonnull = batch.filter("k IS NOT NULL")
    once = U.upsert(target, nonnull, "k", RULES, seq="seq")
    twice = U.upsert(once, nonnull, "k", RULES, seq="seq")
    assert table(once) == table(twice)
