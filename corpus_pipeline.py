"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.llm import bpe, decontaminate, jaccard, line_dedup, quality
from lectio.llm.common import forget, stored, table

SCORE = "_quality_score"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    network = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, network, SCORE).filter(F.col(SCORE) >= 0.5).select(docs.columns)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; n_chars follows. A document of which no line is left goes."""
    found = line_dedup.with_lines_left(docs).filter("n_removed = 0 or trim(left) <> ''")
    size = F.when(F.col("n_removed") > 0, F.length("left").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    changed = {"text": F.when(F.col("n_removed") > 0, F.col("left")).otherwise(F.col("row.text")), "n_chars": size}
    return found.select(*(changed.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the least doc_id stays."""
    return jaccard.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with a benchmark item go."""
    return decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark")).filter(F.size("hits") == 0).select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    import public_tokenizers

    return bpe.digest(bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", distinct_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("BPE encoding and decoding", encoded),
]
#: The classifier, the edit join and the encoding have no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents through all stages. What a stage wrote is deleted once the next one has written its own.

    Rows with null or equal ids are documents of their own; an empty table gives no rows. See the stages for nulls.
    """
    docs, written = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if written is not None:
            forget(written)
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
