"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

1. Items become windows of up to 13 words; equal windows are kept once, beside the items that hold them.
2. One pass over the documents counts the windows' shingles there; that orders each window's shingles by rarity.
3. A window's rarest shingle is its necessary prefix.  A window with a shingle that no document holds cannot occur and
   is dropped.
4. A second pass joins document positions to prefixes, applies the length and position bounds (the window must lie
   inside the document), and compares the exact window, all before any shuffle.  Only true occurrences are shuffled.

The window tables are broadcast in slices of at most ``SLICE_WINDOWS`` windows; a larger benchmark takes more slices,
each its own join, so what is broadcast never grows with it.

Defined results: a null text has no words; an item without words has no window; an item without id hits but is not
listed; repeated rows are judged one by one; empty tables give no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roompulse.llm.tables import stored, table

WINDOW_WORDS = 13
SHINGLE_WORDS = 5
SLICE_WINDOWS = 100_000
#: Contaminated: SHARE * hit words >= all words.
SHARE = 20
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    """A text's words in order, maybe with an empty one at either end."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase), NOT_WORD)


def with_words(rows: DataFrame, *keys: str) -> DataFrame:
    cut = rows.select(*keys, split_words(F.col("text")).alias("parts"))
    first = F.when(F.col("parts")[0] == "", 1).otherwise(0)
    last = F.when((F.size("parts") > 1) & (F.element_at("parts", -1) == ""), 1).otherwise(0)
    cut = cut.select(*keys, "parts", first.alias("lead"), (F.size("parts") - first - last).alias("n_words"))
    return cut.select(*keys, F.slice("parts", F.col("lead") + 1, F.col("n_words")).alias("words"), "n_words")


def shingle(words: Column, at: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(n)])


def item_windows(items: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """(item_id, window, length, id): every window of every item; equal windows have one id."""
    own = with_words(items, "item_id").where(F.col("n_words") > 0).withColumn("length", F.least(F.lit(width), F.col("n_words")))
    at = F.explode(F.sequence(F.lit(0), F.col("n_words") - F.col("length"))).alias("at")
    cut = own.select("item_id", "words", "length", at).select("item_id", "length", F.slice("words", F.col("at") + 1, F.col("length")).alias("window"))
    return cut.withColumn("id", F.md5(F.concat_ws(" ", "window")))


def window_shingles(windows: DataFrame, n: int, least: int) -> DataFrame:
    """(id, window, length, offset, h) for the windows whose shingles have n words."""
    fits = F.col("length") >= n if n == least else F.col("length") == n
    at = F.explode(F.sequence(F.lit(0), F.col("length") - n)).alias("offset")
    return windows.where(fits).select("id", "window", "length", at).withColumn("h", shingle(F.col("window"), F.col("offset"), n))


def positions(rows: DataFrame, n: int, keys: list[str], sentinel: bool) -> DataFrame:
    """A row for each shingle position of a document, and with ``sentinel`` one at -1 without a shingle."""
    first = -1 if sentinel else 0
    last = F.greatest(F.col("n_words") - n, F.lit(-1))
    enough = rows if sentinel else rows.where(F.col("n_words") >= n)
    at = enough.select(*keys, "words", "n_words", F.explode(F.sequence(F.lit(first), last)).alias("i"))
    return at.withColumn("h", F.when(F.col("i") >= 0, shingle(F.col("words"), F.col("i"), n)))


def occurrences(docs: DataFrame, windows: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(row, doc_id, digest of the text, n_words, start, length, id): a row for each occurrence of a window, and one without id for each document."""
    windows = stored(windows, "decontamination-windows")
    n_windows, shortest = windows.agg(F.count("*"), F.min("length")).first()
    sizes = [shingle_words, *range(min(shortest or shingle_words, shingle_words), shingle_words)]
    slices = max(1, -(-n_windows // SLICE_WINDOWS))
    cut = [(n, s, windows.where(F.pmod(F.xxhash64("id"), F.lit(slices)) == s)) for n in sizes for s in range(slices)]

    texts = with_words(docs, "doc_id")
    counted = []
    for n, _, part in cut:
        own = window_shingles(part, n, shingle_words).select("h").distinct()
        counted.append(positions(texts, n, [], False).select("h").join(F.broadcast(own), "h").groupBy("h").agg(F.count("*").alias("n")).withColumn("size", F.lit(n)))
    counts = reduce(DataFrame.unionByName, counted).groupBy("size", "h").agg(F.max("n").alias("n"))
    counts = stored(counts, "decontamination-counts")

    # A row's key follows from its values, so that every branch, and a task run again, gives it the same one.
    digest, none = F.md5("text"), F.lit("none")
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), none), F.coalesce(digest, none)))
    numbered = with_words(docs.select("doc_id", "text", digest.alias("digest"), key.alias("row")), "doc_id", "digest", "row")
    found = []
    for n, s, part in cut:
        ranked = window_shingles(part, n, shingle_words).join(counts.where(F.col("size") == n), "h", "left")
        rarest = ranked.groupBy("id").agg(F.min_by(F.struct("h", "offset", "n", "window", "length"), F.struct(F.coalesce("n", F.lit(0)), "h", "offset")).alias("p"))
        prefixes = rarest.where(F.col("p.n").isNotNull()).select("id", F.col("p.h").alias("prefix"), F.col("p.offset").alias("offset"), F.col("p.window").alias("window"), F.col("p.length").alias("length"))
        first = n == shingle_words and s == 0
        at = positions(numbered, n, ["row", "doc_id", "digest"], first)
        start = F.col("i") - F.col("offset")
        inside = (F.col("h") == F.col("prefix")) & (start >= 0) & (start + F.col("length") <= F.col("n_words"))
        exact = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("length")) == F.col("window")
        joined = at.join(F.broadcast(prefixes), inside & exact, "left" if first else "inner")
        found.append(joined.where((F.col("i") == -1) | F.col("id").isNotNull()).select("row", "doc_id", "digest", "n_words", start.alias("start"), "length", "id"))
    return reduce(DataFrame.unionByName, found)


def judged(docs: DataFrame, items: DataFrame, width: int = WINDOW_WORDS, share: int = SHARE) -> DataFrame:
    """doc_id, the text's md5 digest, n_words, n_hit, n_items, items_sha256, contaminated for each row of (doc_id, text)."""
    held = item_windows(items.select("item_id", "text"), width)
    windows = held.groupBy("id").agg(F.first("window").alias("window"), F.first("length").alias("length"))
    found = stored(occurrences(docs.select("doc_id", "text"), windows), "decontamination-found")
    hits = found.where(F.col("id").isNotNull())
    before = Window.partitionBy("row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select("row", "start", "length").distinct().withColumn("end", F.col("start") + F.col("length"))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.col("start"))))
    covered = spans.withColumn("fresh", fresh).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    listed = hits.select("row", "id").distinct().join(held.where(F.col("item_id").isNotNull()).select("id", F.col("item_id").cast("string").alias("item")).distinct(), "id")
    listed = listed.select("row", "item").distinct().groupBy("row").agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list("item")).alias("items"))
    rows = found.where(F.col("id").isNull()).select("row", "doc_id", "digest", "n_words").join(covered, "row", "left").join(listed, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_text = F.concat_ws(",", F.coalesce("items", F.array().cast("array<string>")))
    return rows.select(
        "doc_id",
        "digest",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(items_text, 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("digest")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
), bw AS (
  SELECT item_id, least(13, len(w)) AS n, w[i : i + least(13, len(w)) - 1] AS win FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM bw
), dw AS (
  SELECT doc_id, n, i, w[i : i + n - 1] AS win FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n
), hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, win)
), covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hits), unnest(range(i, i + n)) AS u(p) GROUP BY doc_id
), listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
