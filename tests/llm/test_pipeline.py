"""The pipeline's stages against brute force, and its contract."""

from collections import Counter

import corpus_pipeline as P
from civitas.llm import quality, sharding

from .helpers import LABELS, documents, prose, table_of, with_clashes
from .test_decontam import brute as contamination
from .test_dedup import components, fingerprint


def inputs(spark, path):
    good = [prose(80 + i, 500 + i) for i in range(60)]
    texts = [*good, *good[:10], good[11] + " tail", *["@@@ ### $$$ " * 30 for _ in range(10)],
             *[" ".join(x + "&&" for x in prose(50, 700 + i).split()) for i in range(30)],
             prose(30, 801) + " " + prose(20, 802), None, ""]
    documents(spark, path + "/documents.parquet", texts)
    spark.createDataFrame([(i, int("&" not in t and "#" not in t), 0) for i, t in enumerate(texts) if t], LABELS).write.parquet(path + "/labels.parquet")
    spark.createDataFrame([(1, prose(20, 802))], "item_id long, text string").write.parquet(path + "/benchmark.parquet")
    return texts


def test_stages_match_brute_force(spark, scratch):
    inputs(spark, scratch)
    docs = spark.read.parquet(scratch + "/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(P.STAGES):
        before = docs.collect()
        out = stage(spark, docs, scratch)
        out.write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
        rows = docs.collect()
        if k == 0:
            model = quality.fit(spark.read.parquet(scratch + "/documents.parquet"), spark.read.parquet(scratch + "/labels.parquet"))
            x = quality.pool(quality.Units(), model.vectors, [r["text"] for r in before])
            want = [tuple(r) for r, s in zip(before, model.network.score(x), strict=True) if s >= 0.3]
        elif k == 1:
            root = components([r["doc_id"] for r in before], [fingerprint(r["text"]) for r in before], 3)
            want = [tuple(r) for r, c in zip(before, root, strict=True) if r["doc_id"] == c]
        elif k == 2:
            leaks = contamination([r["text"] for r in before], [(1, prose(20, 802))])
            want = [tuple(r) for r, b in zip(before, leaks, strict=True) if not b[3]]
            assert any(b[3] for b in leaks)
        elif k == 3:
            assert set(map(tuple, rows)) <= set(map(tuple, before)) and max(Counter(map(tuple, rows)).values()) > 1
            continue
        else:
            assert Counter(tuple(r)[:5] for r in rows) == Counter(map(tuple, before))
            assert sorted(Counter(r["shard"] for r in rows).values(), reverse=True) == [n for n in sharding.shard_sizes(len(rows), 24) if n]
            continue
        assert docs.columns == columns and Counter(map(tuple, rows)) == Counter(want)
        assert 0 < len(rows) < len(before)


def test_run_and_contract(spark, scratch):
    texts = inputs(spark, scratch)
    assert [n for n, _ in P.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination",
                                        "mixing sources to target weights", "sharding"]
    out = P.run(spark, scratch)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    assert 0 < out.count() < 2 * len(texts)
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}


def test_extra_columns_and_empty_tables(spark, scratch):
    inputs(spark, scratch)
    docs = with_clashes(spark.read.parquet(scratch + "/documents.parquet"), "score", "copy", "rate", "row", "place", "th", "fp")
    docs.write.parquet(scratch + "/clash")
    docs = spark.read.parquet(scratch + "/clash")
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, scratch)
        assert out.dtypes == docs.dtypes and out.count() > 0
    empty = table_of(spark, scratch + "/none", [], files=1)
    for _, stage in P.STAGES:
        assert stage(spark, empty, scratch).count() == 0
