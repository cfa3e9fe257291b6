"""How the driver's tables stand in for transcripts, questions, claims and artifacts, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectio.sources.shared import dealt

SQL = {
    "seg": """SELECT 'v' || doc_id AS video_id, doc_id, CAST(i - 1 AS INTEGER) AS seg_no, text,
    (sum(length(text)) OVER (PARTITION BY doc_id ORDER BY i) - length(text)) / 12.5 AS start, sum(length(text)) OVER (PARTITION BY doc_id ORDER BY i) / 12.5 AS stop
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""",
    "asr": """SELECT 'u' || user_id AS video_id, CAST(row_number() OVER o - 1 AS INTEGER) AS pos,
    CASE WHEN event_id % 11 <> 0 THEN CAST(s - min(s) OVER (PARTITION BY user_id) AS DOUBLE) END AS start,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN CAST(s - min(s) OVER (PARTITION BY user_id) - 3600 AS DOUBLE)
      WHEN event_id % 3 = 0 THEN CAST(s - min(s) OVER (PARTITION BY user_id) AS DOUBLE) ELSE CAST(s - min(s) OVER (PARTITION BY user_id) + 900 AS DOUBLE) END AS stop,
    CASE WHEN event_id % 13 = 0 THEN '  ' ELSE ' ' || event_type END AS text, CAST(max(s) OVER (PARTITION BY user_id) - min(s) OVER (PARTITION BY user_id) - 50 AS DOUBLE) AS duration
  FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events) WINDOW o AS (PARTITION BY user_id ORDER BY s, event_id)""",
    "chunk": "SELECT 'v' || doc_id || ':0000' AS chunk_id, 'v' || doc_id AS video_id, doc_id, text FROM documents",
    "claim": """SELECT CAST(doc_id // 5 AS BIGINT) AS answer_id, CAST(doc_id % 5 + 1 AS INTEGER) AS position,
    CASE WHEN doc_id % 4 = 3 THEN 'x' ELSE 'v' || (doc_id + CASE WHEN doc_id % 4 = 2 THEN 1 ELSE 0 END) END || ':0000' AS chunk_id,
    CASE WHEN doc_id % 8 = 1 THEN replace(substr(text, 1 + doc_id * 7919 % greatest(length(text) - 60, 1), 60), 'on', 'um') ELSE substr(text, 1 + doc_id * 7919 % greatest(length(text) - 60, 1), 60) END AS quote, doc_id FROM documents""",
    "answer": """SELECT 'q' || o_orderkey AS question_id, 's' || o_custkey % 7 AS question_set, 'c' || o_custkey % 3 AS course,
    CASE WHEN o_orderkey % 9 = 0 THEN 'full' WHEN o_orderkey % 4 = 0 THEN 'not_found' ELSE 'partial' END AS coverage, CAST(coalesce(n, 0) AS INTEGER) AS n,
    CASE WHEN o_orderkey % 17 = 0 THEN 'failed' END AS error, o_orderkey
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY 1) ON o_orderkey = l_orderkey""",
}
#: quote_form() of lectio.functions.text in SQL.
FORM = r"trim(regexp_replace(regexp_replace(replace(lower({x}), 'ё', 'е'), '[^\p{{L}}\p{{N}}\p{{M}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def using(*names: str) -> str:
    """WITH clause of the named stand-ins; the query follows."""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({SQL[n]})" for n in names)


def form(x: str) -> str:
    return FORM.format(x=x)


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/{name}.parquet")
    return dealt(rows) if name == "documents" else rows


def segments(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents as segments, 12.5 characters a second."""
    rows = read(spark, d, "documents").select(F.concat(F.lit("v"), "doc_id").alias("video_id"), F.posexplode(F.split("text", "\n")).alias("seg_no", "text"))
    # by the recording, as what follows: one exchange
    total = F.sum(F.length("text")).over(W.partitionBy("video_id").orderBy("seg_no"))
    return rows.select("video_id", "seg_no", ((total - F.length("text")) / 12.5).alias("start"), (total / 12.5).alias("end"), "text")


def asr(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user as recogniser rows, some without or with inverted bounds."""
    e = read(spark, d, "events").withColumn("s", F.unix_seconds(F.col("ts").cast("timestamp")))
    user = W.partitionBy("user_id")
    at = (F.col("s") - F.min("s").over(user)).cast("double")
    i = F.col("event_id")
    end = F.when(i % 5 == 0, None).when(i % 7 == 0, at - 3600).when(i % 3 == 0, at).otherwise(at + 900)
    text = F.when(i % 13 == 0, "  ").otherwise(F.concat(F.lit(" "), "event_type"))
    return e.select(F.concat(F.lit("u"), "user_id").alias("video_id"), (F.row_number().over(user.orderBy("s", "event_id")) - 1).alias("pos"), F.when(i % 11 != 0, at).alias("start"), end.alias("end"), text.alias("text"), (F.max("s").over(user) - F.min("s").over(user) - 50).cast("double").alias("duration"))


def chunks(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents as chunks."""
    rows = read(spark, d, "documents")
    return rows.select(F.format_string("v%d:0000", "doc_id").alias("chunk_id"), F.format_string("v%d", "doc_id").alias("video_id"), F.lit(0).alias("chunk_no"), F.lit(0.0).alias("start"), (F.length("text") / 12.5).alias("end"), "text")


def questions(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "benchmark").select(F.col("item_id").alias("question_id"), "text")


def claims(spark: SparkSession, d: str) -> DataFrame:
    """Quotes from anywhere in the documents, some altered, some of the wrong or of no chunk."""
    rows = read(spark, d, "documents")
    i = F.col("doc_id")
    cut = F.substring("text", (1 + i * 7919 % F.greatest(F.length("text") - 60, F.lit(1))).cast("int"), F.lit(60))
    name = F.when(i % 4 == 3, F.lit("x")).otherwise(F.concat(F.lit("v"), i + F.when(i % 4 == 2, 1).otherwise(0)))
    return rows.select(F.floor(i / 5).alias("answer_id"), (i % 5 + 1).cast("int").alias("position"), F.concat(name, F.lit(":0000")).alias("chunk_id"), F.when(i % 8 == 1, F.replace(cut, F.lit("on"), F.lit("um"))).otherwise(cut).alias("quote"))


def answers(spark: SparkSession, d: str) -> DataFrame:
    """Orders as answers whose citations are lines of the order."""
    o = read(spark, d, "orders")
    lines = read(spark, d, "lineitem").filter("l_quantity > 10")
    cited = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").cast("int").alias("n")))).alias("cited"))
    k = F.col("o_orderkey")
    coverage = F.when(k % 9 == 0, "full").when(k % 4 == 0, "not_found").otherwise("partial")
    rows = o.join(cited, k == F.col("l_orderkey"), "left")
    return rows.select(F.concat(F.lit("q"), k).alias("question_id"), F.concat(F.lit("s"), F.col("o_custkey") % 7).alias("question_set"), F.concat(F.lit("c"), F.col("o_custkey") % 3).alias("course"), coverage.alias("coverage"), F.coalesce("cited", F.array().cast("array<struct<n:int>>")).alias("citations"), F.when(k % 17 == 0, "failed").alias("error"))
