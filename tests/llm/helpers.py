"""Fixtures of the operator tests: small file-backed tables with the awkward rows in them."""

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
LABELS = "doc_id long, quality int, toxic int"

WORDS = ("amber birch cedar delta ember flint grove hazel iris juniper kelp larch maple nettle olive pine quartz reed sage "
         "thyme umber violet willow yarrow zinnia").split()


def prose(n: int, seed: int) -> str:
    """n words, the same for the same seed."""
    x, out = seed * 2654435761 % 2**32, []
    for i in range(n):
        x = (1103515245 * x + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)] + ("." if i % 9 == 8 else ""))
    return " ".join(out).capitalize()


def awkward_texts() -> list:
    """NULL, empty, blank, one word, symbols, non-ASCII, a very long text, copies and near copies."""
    long = prose(30_000, 5)
    base = prose(120, 1)
    return [None, "", "  \t\n ", "one", "two words", "!!! ??? ###", "ÄÖÜ äöü straße ÉTÉ été 日本語 текст \U0001f600",
            long, long, base, base, base, base.replace("amber", "AMBER"), base + " tail", prose(120, 2), prose(200, 3) * 3,
            "line\n\nline\nother\n line", "a a a a a a a a a a", None, ""]


def table_of(spark, path, rows, schema=SCHEMA, files: int = 3):
    """Rows written as several files and read back: a scan, as the operators expect."""
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
    return spark.read.parquet(path)


def documents(spark, path, texts, files: int = 3):
    rows = [(i if t is not None or i else None, t, "en", None if i % 7 == 3 else f"src{i % 3}", len(t or ""))
            for i, t in enumerate(texts)]
    return table_of(spark, path, rows, files=files)


def with_clashes(df, *names):
    """Extra columns whose names an operator uses itself."""
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in names if n not in df.columns])
