"""Benchmark decontamination by winnowing.

Every window of WINDOW words keeps the least hash of its K-word grams. A document and a benchmark item that share WINDOW
words in a row therefore share a kept gram inside them; the join is on kept grams, and each hit is extended to the whole
window, word by word. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.llm.common import stored, table
from lectio.llm.url_reputation import LOWER, UPPER

WINDOW, K = 10, 5
#: Windows of the benchmark whose keys may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def words_of(text: str) -> Column:
    r"""A-Z lower-cased, then all runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F]; null: none."""
    text = F.coalesce(F.col(text), F.lit(""))
    # lower() is much faster than translate(), and the same unless there is a capital beyond A-Z
    small = F.when(text.rlike(r"[\x{80}-\x{10FFFF}&&[\p{Lu}\p{Lt}\p{Nl}\p{So}]]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(small, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _with_grams(df: DataFrame) -> DataFrame:
    """words -> grams: at each position the hash of the K words that begin there, null where fewer are left."""
    n = F.size("words")
    df = df.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
    df = df.withColumn("pairs", F.zip_with("hashes", F.slice("hashes", 2, F.greatest(n, F.lit(1))), lambda a, b: F.xxhash64(a, b)))
    return df.withColumn("grams", F.transform("pairs", lambda x, i: F.when(i <= n - K, F.xxhash64(x, F.get("pairs", i + 2), F.get("hashes", i + 4))))).drop("hashes", "pairs")


def _with_minima(df: DataFrame) -> DataFrame:
    """grams -> minima: at each position the least gram of the window that begins there, null where none fits."""
    span = WINDOW - K + 1
    least = lambda x, i: F.when(i <= F.size("words") - WINDOW, F.least(x, *(F.get("grams", i + j) for j in range(1, span))))
    return df.withColumn("minima", F.transform("grams", least))


def _short(words: Column, size: int) -> Column:
    """At each position the hash of all ``size`` words that begin there."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - size + 1, F.lit(1))), lambda i: F.when(F.size(words) - i >= size - 1, F.xxhash64(F.array_join(F.slice(words, i, F.lit(size)), " "))))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, text) -> one row for each window: item_id, size, key, at (the place of the kept gram in it), said (its words).

    An item of fewer than WINDOW words is one window, keyed by all its words; one without words has none.
    """
    items = _with_minima(_with_grams(benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of("text").alias("words"))))
    long = items.filter(F.size("words") >= WINDOW).select("item_id", "words", "grams", F.posexplode_outer("minima").alias("start", "key")).filter("key is not null")
    at = F.array_position(F.slice("grams", F.col("start") + 1, F.lit(WINDOW - K + 1)), F.col("key")).cast("int") - 1
    long = long.select("item_id", F.lit(WINDOW).alias("size"), "key", at.alias("at"), F.array_join(F.slice("words", F.col("start") + 1, F.lit(WINDOW)), " ").alias("said"))
    said = F.array_join("words", " ")
    short = items.filter(F.size("words").between(1, WINDOW - 1)).select("item_id", F.size("words").alias("size"), F.xxhash64(said).alias("key"), F.lit(0).alias("at"), said.alias("said"))
    return long.unionByName(short).distinct()


def with_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents x benchmark -> row (all columns of documents), n_words, hits (array of start, size, item_id: every occurrence
    of a window of an item).

    Null texts have no words. A null item_id counts as an empty one; items with the same id are one item. Hits are looked up
    by a hash of the text and checked on each row's own words, so rows with null or equal ids have their own. Each window's
    occurrence is found whatever the number of documents or items that share it. Columns may have any names.
    """
    windows = stored(item_windows(benchmark), "windows")
    rows = docs.select(F.xxhash64("text").alias("name"), words_of("text").alias("words"))
    # no filter on the number of words here: it would split each text a second time, and short ones have no minima
    grams = _with_minima(_with_grams(rows))
    span = WINDOW - K + 1
    kept = F.transform("grams", lambda x, i: F.when(x == F.greatest(*(F.get("minima", i - j) for j in range(span))), x))
    found = grams.select("name", F.lit(WINDOW).alias("size"), kept.alias("keys"))
    for (size,) in windows.filter(F.col("size") < WINDOW).select("size").distinct().collect():
        found = found.unionByName(rows.filter(F.size("words") >= size).select("name", F.lit(size).alias("size"), _short(F.col("words"), size).alias("keys")))
    found = found.select("name", "size", F.posexplode_outer("keys").alias("pos", "key")).filter("key is not null")
    keys = windows.select("size", "key").distinct()
    keys = F.broadcast(keys) if windows.count() <= BROADCAST_ROWS else keys
    near = found.join(keys, ["size", "key"], "left_semi").join(windows, ["size", "key"]).select("name", F.struct((F.col("pos") - F.col("at")).alias("start"), "size", "item_id", "said").alias("near"))
    near = stored(near.filter("near.start >= 0").groupBy("name").agg(F.collect_set("near").alias("near")), "hits")
    # texts are dealt, not words, and always by a shuffle: what is hit has no bound
    joined = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("name")).join(near.hint("merge"), "name", "left").select("row", words_of("row.text").alias("words"), "near")
    hits = F.filter("near", lambda x: F.array_join(F.slice("words", x["start"] + 1, x["size"]), " ") == x["said"])
    hits = F.transform(hits, lambda x: F.struct(x["start"].alias("start"), x["size"].alias("size"), x["item_id"].alias("item_id")))
    return joined.select("row", F.size("words").cast("long").alias("n_words"), F.coalesce(hits, F.array().cast("array<struct<start:int,size:int,item_id:string>>")).alias("hits"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents x benchmark -> doc_id, n_words, hits; see with_hits()."""
    return with_hits(docs.select("doc_id", "text"), benchmark).select("row.doc_id", "n_words", "hits")


def hit_words(hits: str) -> Column:
    """The distinct word positions inside any hit."""
    return F.array_distinct(F.flatten(F.transform(hits, lambda x: F.sequence(x["start"], x["start"] + x["size"] - 1))))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents x benchmark -> doc_id, n_words, n_hit, n_items, items_sha256, contaminated. Nulls, equal ids, an empty benchmark: see with_hits()."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("hits", lambda x: x["item_id"])))
    found = found.select("doc_id", "n_words", F.size(hit_words("hits")).cast("long").alias("n_hit"), items.alias("items"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP5_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS said
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM item WHERE len(w) > 0)),
spans AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS said
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM doc, (SELECT DISTINCT size FROM windows))),
hit AS (SELECT doc_id, s, size, item_id FROM spans JOIN windows USING (size, said)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
