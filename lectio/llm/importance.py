"""Importance resampling of documents towards a target distribution.

Each text's hashed n-grams are an array of buckets; a bucket's gain is how much more frequent it is in the target than in the
corpus, and a document's weight the mean gain of its array. Gumbel noise makes the highest scores a sample without
replacement. The scores are written once; the cutoff is found by halving an interval of scores, then one of ids among those
that tie, each step an exact count over the written table; only what lies above the cutoff is sorted, by ranges.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.llm.common import forget, stored, table
from lectio.llm.decontaminate import words_of
from lectio.operators.ordering import numbered


@dataclass(frozen=True)
class Draw:
    longest: int = 2
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7


def _bucket(feature: Column, n: int) -> Column:
    return (F.crc32(feature.cast("binary")) % n).cast("int")


def bucketed(df: DataFrame, draw: Draw) -> DataFrame:
    """df (text, others) -> others, n_words, buckets (of all runs of 1 to ``longest`` words, repeats kept); null texts have none."""
    rows = df.withColumn("_words", words_of("text")).drop("text")
    joined, arrays = F.col("_words"), []
    for size in range(1, draw.longest + 1):
        if size > 1:
            # runs one word longer: each but the last with the word that follows it
            after = F.slice("_words", size, F.greatest(F.size("_words"), F.lit(1)))
            rows = rows.withColumn(f"_runs{size}", F.zip_with(F.slice(joined, 1, F.greatest(F.size("_words") - (size - 1), F.lit(0))), after, lambda a, b: F.concat(a, F.lit(" "), b)))
            joined = F.col(f"_runs{size}")
        arrays.append(F.transform(joined, lambda x: _bucket(x, draw.buckets)))
    kept = [c for c in df.columns if c != "text"]
    return rows.select(*kept, F.size("_words").alias("n_words"), F.concat(*arrays).alias("buckets"))


def counts(rows: DataFrame, draw: Draw) -> list[int]:
    """How often each bucket occurs in all rows: one number a bucket goes to the driver, whatever the input."""
    found = rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).collect()
    out = [0] * draw.buckets
    for r in found:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln of the ratio of the smoothed shares), in doubles."""
    s_all, t_all, n = float(sum(source)), float(sum(target)), len(source)
    return [math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source, target)]


def scored(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """documents (doc_id, text) x target (text) -> doc_id, n_words, n_features, weight, score, written to the shared folder.

    The buckets of a document are written once, for counting and for scoring; no shuffle but that of the counts. The noise
    depends on the seed and doc_id alone, so rows with equal (or null) ids have the same; a null id counts as an empty text.
    An empty table gives no rows, an empty target weights by the rarity in the corpus alone.
    """
    rows = stored(bucketed(docs.select("doc_id", "text"), draw), "buckets")
    gain = gains(counts(rows, draw), counts(bucketed(target.select("text"), draw), draw))
    gain = F.array(*map(F.lit, gain))
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda acc, b: acc + F.get(F.col("_gain"), b))
    n = F.size("buckets").cast("long")
    weight = F.when(n > 0, F.expr("(_total - pmod(_total, _n)) div _n")).otherwise(F.lit(0).cast("long"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{draw.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    rows = rows.withColumn("_gain", gain).withColumn("_total", total).withColumn("_n", n).withColumn("weight", weight)
    out = stored(rows.select("doc_id", "n_words", n.alias("n_features"), "weight", (F.col("weight") + noise).alias("score")), "scores")
    forget(rows)
    return out


def _least(low: int, high: int, enough: Callable[[int], bool]) -> int:
    """The greatest value in low ... high for which ``enough`` holds, which holds for low and for all below one where it does."""
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if enough(middle) else (low, middle - 1)
    return low


def cutoff(rows: DataFrame, k: int) -> tuple[int, int | None] | None:
    """(score, doc_id) of row k of rows (score, doc_id) by falling score, then rising doc_id, null last; None where k is 0.

    A null doc_id in the answer: all rows with that score that have an id, and some of those without. Every step counts over all
    rows; there are as many as bits in the range of the scores, and of the ids that tie.
    """
    if k <= 0:
        return None
    low, high = rows.agg(F.min("score"), F.max("score")).first()
    score = _least(low, high, lambda x: rows.filter(F.col("score") >= x).count() >= k)
    left = k - rows.filter(F.col("score") > score).count()
    tied = rows.filter(F.col("score") == score)
    low, high, n = tied.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    if n < left:
        return score, None
    return score, -_least(-high, -low, lambda x: tied.filter(F.col("doc_id") <= -x).count() >= left)


def resampled(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """documents x target -> every row's doc_id, n_features, weight, score, rank (from 1; null where it is not drawn).

    Drawn are floor(percent * N / 100) of the N rows with ``least_words`` words: the highest scores, of equal ones the smaller
    doc_id, null last. Of rows that repeat both, any are drawn, as many as are due.
    """
    rows = scored(docs, target, draw)
    may = F.col("n_words") >= draw.least_words
    able = rows.filter(may)
    k = able.count() * draw.percent // 100
    cut = cutoff(able, k)
    columns = ["doc_id", "n_features", "weight", "score"]
    if cut is None:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    score, last = cut
    tied = F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(False))
    above = may & ((F.col("score") > score) | (F.col("score") == score) & tied)
    # rows that repeat the last score and id all stand here, after the others: their ranks are beyond k
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    drawn = numbered(rows.filter(above).select(*columns), order, "_number")
    drawn = drawn.select(*columns, F.when(F.col("_number") < k, F.col("_number") + 1).alias("rank"))
    return drawn.unionByName(rows.filter(~above).select(*columns, F.lit(None).cast("long").alias("rank")))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents drawn towards benchmark, with the parameters of Draw: doc_id, n_features, weight, score, rank."""
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""WITH t AS (SELECT list(v ORDER BY b) AS crc FROM (SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(b))),
words AS (SELECT false AS aim, doc_id, w FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
  UNION ALL SELECT true, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
runs AS (SELECT aim, doc_id, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS f FROM words),
names AS (SELECT f, xor(list_reduce([4294967295] || [CAST('0x' || substr(x, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT) FOR i IN range(len(x) // 2)], lambda c, y: xor(c >> 8, crc[CAST((xor(c, y) & 255) + 1 AS BIGINT)])), 4294967295) % 10000 AS b
  FROM (SELECT DISTINCT f, hex(encode(f)) AS x FROM runs), t),
found AS (SELECT aim, doc_id, b FROM runs JOIN names USING (f)),
tally AS (SELECT b, count(*) FILTER (WHERE NOT aim) AS s, count(*) FILTER (WHERE aim) AS t FROM found GROUP BY b),
gain AS (SELECT b, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM tally)::DOUBLE + 10000) / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM tally)::DOUBLE + 10000)))) AS BIGINT) AS g FROM tally),
weights AS (SELECT doc_id, count(*) AS n_features, CAST((sum(g) - ((sum(g) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS weight FROM found JOIN gain USING (b) WHERE NOT aim GROUP BY doc_id),
scores AS (SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM words d LEFT JOIN weights USING (doc_id) WHERE NOT d.aim),
ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scores WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 25 * count(*) // 100 FROM ranks) THEN rank END AS rank FROM scores LEFT JOIN ranks USING (doc_id)"""
