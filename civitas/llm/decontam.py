"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

Items are cut into windows of ``width`` words (a shorter item is one window),
windows into shingles of up to SHINGLE words. A window occurs only if all its
shingles do, so its necessary prefix is a single shingle under any global
order; the order is rarity over all documents, which makes that shingle the
one with the fewest candidates.

1. One pass over the texts finds every position whose shingle belongs to any
   window (sparse: the texts are not shuffled).
2. These positions give each shingle's corpus count, hence the prefixes.
3. Positions join the prefixes; position and length bounds place the window
   in the document.
4. Candidates are verified exactly: the shingles that cover the window's words
   must stand at their places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, packed, pin, table

# what separates words: the contract's separators without A-Z, as texts are cut before they are folded
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHINGLE = 3
BROADCAST_ROWS = 2_000_000  # shingle tables up to this size are broadcast (about 100 MB), larger ones shuffled


def words_of(text) -> F.Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A pinned table, marked for broadcast only if it was counted to be small."""
    return F.broadcast(df) if df.count() <= rows else df


def item_windows(items: DataFrame, width: int, id_col: str, text: str) -> DataFrame:
    """(window, words, w, items): the distinct windows and the ids of the items that hold them."""
    words = items.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("item"),
                         words_of(ascii_lower(F.col(f"`{text}`"))).alias("words")).filter(F.size("words") > 0)
    w = F.least(F.lit(width), F.size("words"))
    cut = words.select("item", w.alias("w"), F.col("words").alias("all"),
                       F.explode(F.sequence(F.lit(1), F.size("words") - w + 1)).alias("at")).select(
        "item", "w", F.slice("all", F.col("at"), F.col("w")).alias("words"))
    return cut.groupBy(F.array_join("words", " ").alias("window")).agg(
        F.first("words").alias("words"), F.first("w").alias("w"), F.collect_set("item").alias("items"))


def window_shingles(windows: DataFrame) -> DataFrame:
    """(window, w, k, off, shingle) for every shingle of every window."""
    k = F.least(F.lit(SHINGLE), F.col("w"))
    return windows.select("window", "w", k.alias("k"), "words", F.explode(F.sequence(F.lit(0), F.col("w") - k)).alias("off")).select(
        "window", "w", "k", "off", F.array_join(F.slice("words", F.col("off") + 1, F.col("k")), " ").alias("shingle"))


def shingle_positions(docs: DataFrame, shingles: DataFrame, lengths: list[int], id_col: str, text: str) -> DataFrame:
    """(doc_id, th, n_words, pos, shingle): positions of known shingles, and one row of position -1 per document.

    The hash of the lower-cased words finds candidates without folding every
    word exactly (equal after A-Z folding implies equal after full folding);
    the filter behind the join then compares the exact text.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("th"),
                       words_of(F.col(f"`{text}`")).alias("words"))
    at = base.select("doc_id", "th", "words", F.size("words").cast("long").alias("n_words"),
                     F.explode(F.sequence(F.lit(-1), F.size("words") - 1)).alias("pos"))
    at = at.withColumn("k", F.lit(lengths[0]) if len(lengths) == 1 else F.explode(F.array(*map(F.lit, lengths))))
    at = at.filter(((F.col("pos") >= 0) & (F.col("pos") + F.col("k") <= F.col("n_words")))
                   | ((F.col("pos") == -1) & (F.col("k") == lengths[0])))
    cut = F.array_join(F.slice("words", F.greatest(F.col("pos"), F.lit(0)) + 1, F.col("k")), " ")
    key = F.when(F.col("pos") < 0, F.xxhash64("th")).otherwise(F.xxhash64(F.lower(cut)))
    # the exact comparison is the dear part: only rows that met a shingle reach it
    same = F.col("shingle").isNotNull() & (ascii_lower(cut) == F.col("shingle"))
    found = at.withColumn("h", key).join(shingles, F.col("h") == F.col("sh_h"), "left").filter((F.col("pos") < 0) | same)
    return found.select("doc_id", "th", "n_words", "pos", F.when(F.col("pos") >= 0, F.col("shingle")).alias("shingle"))


def occurrences(places: DataFrame, parts: DataFrame) -> DataFrame:
    """(doc_id, th, start, window): exact occurrences of windows."""
    seen = places.filter("pos >= 0").select("doc_id", "th", "n_words", "pos", "shingle").distinct()
    seen = pin(seen, "shingle-places")
    counts = seen.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.row_number().over(Window.partitionBy("window").orderBy("n", "shingle", "off"))
    # a window with a shingle that never occurs drops out here
    complete = parts.join(counts, "shingle", "left").withColumn("gone", F.max(F.col("n").isNull()).over(Window.partitionBy("window")))
    prefix = pin(complete.filter(~F.col("gone")).withColumn("r", rarest).filter("r = 1").select("window", "w", "k", "off", "shingle"), "prefixes")
    candidates = seen.join(bounded(prefix), "shingle").select(
        "doc_id", "th", "window", "w", "k", F.col("off").alias("have"), (F.col("pos") - F.col("off")).alias("start"), "n_words").filter(
        (F.col("start") >= 0) & (F.col("start") + F.col("w") <= F.col("n_words")))
    # places that cover all w words: every k-th and the last
    cover = parts.filter((F.col("off") % F.col("k") == 0) | (F.col("off") == F.col("w") - F.col("k"))).groupBy("window").agg(
        F.collect_list(F.struct("off", "shingle")).alias("cover"))
    cover = bounded(pin(cover, "covers"))
    asked = candidates.join(cover, "window").select(
        "doc_id", "th", "start", "window", F.size("cover").alias("need"), F.explode("cover").alias("c")).select(
        "doc_id", "th", "start", "window", "need", (F.col("start") + F.col("c.off")).alias("pos"), F.col("c.shingle").alias("shingle"))
    s = seen.select(F.col("doc_id").alias("d2"), F.col("th").alias("t2"), F.col("pos").alias("p2"), F.col("shingle").alias("s2"))
    met = asked.join(s, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2")) & (F.col("pos") == F.col("p2"))
                     & (F.col("shingle") == F.col("s2")), "left_semi")
    return met.groupBy("doc_id", "th", "start", "window").agg(
        F.count(F.lit(1)).alias("got"), F.first("need").alias("need")).filter("got = need").drop("got", "need")


def covered(spans) -> F.Column:
    """Number of positions in the union of an array of (start, w)."""
    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
                       lambda a, s: F.struct(
                           (a["n"] + F.greatest(F.lit(0), s["start"] + s["w"] - F.greatest(a["end"], s["start"]))).cast("long").alias("n"),
                           F.greatest(a["end"], s["start"] + s["w"]).cast("long").alias("end")),
                       lambda a: a["n"])


def find_contamination(docs: DataFrame, items: DataFrame, *, width: int = 10, id_col: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, th (hash of the text), n_words, n_hit, items, contaminated.

    Words are runs of ASCII letters and digits and of any other characters;
    A-Z compare as a-z. Defined cases: NULL and empty texts have no words and
    no hits; items without words match nothing; an item id of NULL reads
    ``null``; rows with equal id and text each get the same result; empty
    tables give no rows, or no hits; other columns are not read.
    """
    windows = pin(item_windows(items, width, item_id, item_text), "windows")
    parts = pin(window_shingles(windows), "window-shingles")
    shingles = pin(parts.select("shingle").distinct().withColumn("sh_h", F.xxhash64(F.lower("shingle"))), "shingles")
    lengths = sorted(r["k"] for r in parts.select("k").distinct().collect()) or [SHINGLE]  # at most SHINGLE values
    places = pin(shingle_positions(docs, bounded(shingles), lengths, id_col, text), "positions")
    found = occurrences(places, parts).join(bounded(windows.select("window", "w", "items")), "window")
    hits = found.groupBy("doc_id", "th").agg(
        F.collect_set(F.struct(F.col("start").cast("long").alias("start"), F.col("w").cast("long").alias("w"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")).select(
        F.col("doc_id").alias("d2"), F.col("th").alias("t2"), covered(F.col("spans")).alias("n_hit"), F.array_sort("items").alias("items"))
    rows = places.filter("pos < 0").select("doc_id", "th", "n_words")
    out = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2")), "left")
    return out.select("doc_id", "th", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      F.col("n_hit").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """``docs`` without the documents in which a window of ``items`` occurs."""
    id_col, text = settings.get("id_col", "doc_id"), settings.get("text", "text")
    hit = find_contamination(docs, items, **settings).filter("contaminated").select("doc_id", "th").distinct()
    hit = bounded(pin(hit, "contaminated"))
    rows = packed(docs, F.col(f"`{id_col}`").alias("_id"), F.xxhash64(F.col(f"`{text}`")).alias("_th"))
    return rows.join(hit, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_th") == F.col("th")), "left_anti").select("row.*")


def op4_query(spark, sf_dir):
    """Benchmark windows of 10 words in every document."""
    out = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bw AS (SELECT item, words, least(10, len(words)) AS w FROM b WHERE len(words) > 0),
win AS (SELECT DISTINCT item, w, array_to_string(words[i:i + w - 1], ' ') AS s
        FROM (SELECT *, unnest(generate_series(1, len(words) - w + 1)) AS i FROM bw)),
d AS (SELECT doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
pos AS (SELECT doc_id, words, w, unnest(generate_series(1, len(words) - w + 1)) AS i
        FROM d, (SELECT DISTINCT w FROM win) WHERE len(words) >= w),
occ AS (SELECT p.doc_id, p.i, p.w, win.item FROM pos p JOIN win ON win.w = p.w AND array_to_string(p.words[p.i:p.i + p.w - 1], ' ') = win.s),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + w - 1)) AS j FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS s FROM occ GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(it.s, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
