"""Column names and types of every registered opN query, and what its derived columns must satisfy."""

import zlib

import pytest

SF = "/root/testdata/sf0.001"
HEX64 = "abcdef0123456789"

COLUMNS = {
    "op3_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_decontaminate": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op5_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op7_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op8_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op9_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
                          "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op10_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op11_hard_negatives": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint",
                            "negative_score": "bigint"},
    "op12_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op13_whitening": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double",
                       "identity_error": "double"},
}


@pytest.fixture(scope="module")
def results(spark):
    import __spark_entry__
    found = {}

    def of(name):
        if name not in found:
            df = __spark_entry__.queries()[name](spark, SF)
            found[name] = dict(df.dtypes), df.toPandas()
        return found[name]
    return of


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(results, name):
    types, rows = results(name)
    assert {c: types.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    assert len(rows)


def test_every_document_once(results, spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    for name in COLUMNS:
        if "doc_id" in COLUMNS[name]:
            assert sorted(results(name)[1]["doc_id"]) == sorted(docs["doc_id"]), name


def test_folds_and_thresholds(results):
    for name, modulus, rest, threshold in (("op3_quality", 5, 0, 0.3), ("op5_toxicity", 5, 0, 0.5), ("op12_language", 4, 2, None)):
        rows = results(name)[1]
        assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % modulus == rest for i in rows["doc_id"]]).all()
        assert rows["score"].between(0, 1).all()
        if threshold:
            assert (rows["predicted"] == (rows["score"] >= threshold)).all()


def test_derived_columns(results):
    rows = results("op6_suffix_dedup")[1]
    assert ((rows["n_spans"] > 0) == (rows["n_removed"] > 0)).all() and (rows["n_removed"] <= rows["n_bytes"]).all()
    rows = results("op10_simhash")[1]
    assert rows["fingerprint"].str.fullmatch("[0-9a-f]{16}").all() and (rows["component_id"] <= rows["doc_id"]).all()
    for name, column in (("op6_suffix_dedup", "kept_sha256"), ("op4_decontaminate", "items_sha256")):
        assert results(name)[1][column].str.fullmatch("[0-9a-f]{64}").all()
    rows = results("op8_sharding")[1]
    assert set(rows["law"]) == {"rows"} and rows["grown_shard"].isna().all()
    sizes = rows.groupby("shard")["slot"].agg(["count", "max", "min"])
    assert (sizes["max"] + 1 == sizes["count"]).all() and (sizes["min"] == 0).all() and sizes["count"].max() - sizes["count"].min() <= 1
    rows = results("op7_html_text")[1]
    assert (rows["n_chars"] == rows["text"].str.len()).all()
    rows = results("op9_quality_rules")[1]
    assert not rows["kept"][rows["base_failed"]].any()
    rows = results("op13_whitening")[1]
    assert sorted(rows["component"].unique()) == list(range(1, 9)) and rows["identity_error"].nunique() == 1
    assert rows["identity_error"].iloc[0] <= 1e-4 and rows.groupby("component")["explained"].first().is_monotonic_decreasing
