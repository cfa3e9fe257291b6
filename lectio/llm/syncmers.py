"""Document fingerprints of closed syncmers.

A window of K words is an anchor when the least hash of its inner windows of S words is that of the first or the last one.
Whether it is depends on its own words alone, so the same passage has the same anchors wherever it stands. A document's
fingerprint is the sketch of the least SKETCH distinct anchor hashes. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectio.llm.common import table, texts

K, S, SKETCH = 5, 2, 64


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add array ``out``: at each word position the 32-bit hash of the anchor that begins there, null where none does.

    Words are lower-cased runs without white space. A text of 1 to K - 1 words has one anchor, all of it; none has none.
    """
    words, hashes, pairs = f"_{out}_words", f"_{out}_hashes", f"_{out}_pairs"
    df = df.withColumn(words, F.filter(F.split(F.lower(text), r"\s+"), lambda x: x != ""))
    df = df.withColumn(hashes, F.transform(words, lambda x: F.xxhash64(x)))
    df = df.withColumn(pairs, F.zip_with(hashes, F.slice(hashes, 2, F.greatest(F.size(hashes), F.lit(1))), lambda a, b: F.xxhash64(a, b)))
    inner = K - S + 1

    def anchor(x: Column, i: Column) -> Column:
        at = [x, *(F.get(pairs, i + j) for j in range(1, inner))]
        least = F.least(*at)
        closed = (i <= F.size(hashes) - K) & ((least == at[0]) | (least == at[-1]))
        return F.when(closed, F.xxhash64(at[0], at[1], at[-1]).bitwiseAND(0xFFFFFFFF))

    short = F.when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")).bitwiseAND(0xFFFFFFFF))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, F.when(F.size(words) >= K, F.transform(pairs, anchor)).otherwise(short)).drop(words, hashes, pairs)


def sketch_of(anchors: str) -> Column:
    """The least SKETCH distinct anchor hashes in ascending order."""
    return F.slice(F.sort_array(F.array_distinct(F.array_compact(anchors))), 1, SKETCH)


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add array ``out``: the sketch of a text."""
    return with_anchors(df, text, f"_{out}").withColumn(out, sketch_of(f"_{out}")).drop(f"_{out}")


def in_place(a: str, b: str) -> tuple[Column, Column]:
    """Positional matching of two arrays of anchors: (how many of both stand at the same word, the word of the first anchor of ``a``
    that ``b`` does not have there; null where it has all). Anchors depend on their own words alone, so up to the first word
    that differs all agree, whatever follows."""
    same = F.zip_with(a, b, lambda x, y: x == y)
    moved = F.filter(F.transform(a, lambda x, i: F.when(x.isNotNull() & ~F.coalesce(F.get(b, i) == x, F.lit(False)), i)), lambda i: i.isNotNull())
    return F.size(F.filter(same, lambda x: x)).cast("long"), F.array_min(moved).cast("long")


def shown(sketch: str) -> Column:
    """A sketch as a string: 8 hex digits a hash; empty for a text without words."""
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: str, b: str) -> Column:
    """The estimated share of common anchors among all of both: that of the least SKETCH of the union. Two empty ones: 1."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    common = F.array_intersect(union, F.array_intersect(a, b))
    return F.when(F.size(F.array_union(a, b)) == 0, 1.0).otherwise(F.size(common) / F.size(union))


def anchor_matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Positional matching of two tables (doc_id, text): left_id, right_id, shift, n.

    n anchors of the left document occur in the right one ``shift`` words further on. Anchors that occur more than once in
    a document count at their first place. The join is on the anchor hash; equal pairs are summed before they leave a task.
    """

    def places(docs: DataFrame, name: str) -> DataFrame:
        rows = with_anchors(texts(docs), "text", "anchors").select("doc_id", F.posexplode_outer("anchors").alias("pos", "hash")).filter("hash is not null")
        return rows.groupBy(F.col("doc_id").alias(f"{name}_id"), "hash").agg(F.min("pos").alias(f"{name}_pos"))

    both = places(left, "left").join(places(right, "right"), "hash")
    return both.groupBy("left_id", "right_id", (F.col("right_pos") - F.col("left_pos")).alias("shift")).agg(F.count("*").alias("n"))


def _cells(ids: DataFrame, many: int) -> Column:
    """The cell of a row (doc_id, tie): about ``many`` equal ones, in the order of doc_id; rows without one come before all
    others and are dealt by ranges of ``tie``."""
    found, nulls, rows = ids.agg(F.percentile_approx("doc_id", [i / many for i in range(1, many)], 10 * many), F.count_if(F.col("doc_id").isNull()), F.count("*")).first()
    bounds = sorted(set(found or []))
    share = max(1, -(-many * nulls // max(rows, 1)))
    nameless = F.floor((F.shiftright("tie", 40) + (1 << 23)) * share / (1 << 24)).cast("int") - share
    if not bounds:
        return F.when(F.col("doc_id").isNull(), nameless).otherwise(0)
    step = math.isqrt(len(bounds)) + 1
    runs = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    # the run first, then the place in it: far fewer comparisons than along all bounds
    tops = F.array(*(F.lit(x[0]) for x in runs))
    inner = F.array(*(F.array(*map(F.lit, x)) for x in runs))
    run = F.size(F.filter(tops, lambda x: x <= F.col("doc_id")))
    named = F.when(run == 0, 0).otherwise((run - 1) * step + F.size(F.filter(F.get(inner, run - 1), lambda x: x <= F.col("doc_id"))))
    return F.when(F.col("doc_id").isNull(), nameless).otherwise(named)


def with_next(docs: DataFrame, columns: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """prepare(docs) with next_<column> of the next row in descending doc_id (null last; equal ids: by a hash of the text); after the last: the first.

    Rows are dealt to cells of neighbouring ids; each cell also gets the first row of the next one, so one shuffle does,
    and no task sees more than a cell. Only a number for each cell reaches the driver. ``prepare`` adds columns to rows, each
    by itself; it is called once the rows are together, so that none is prepared twice but the guests.
    """
    many = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.withColumn("tie", F.xxhash64("text"))
    celled = docs.withColumn("cell", _cells(docs, many))
    firsts = celled.groupBy("cell").agg(F.max(F.struct("doc_id", "tie")).alias("first")).select("cell", "first.*").collect()
    firsts = sorted(((r["cell"], r["doc_id"], r["tie"]) for r in firsts), key=lambda x: x[0], reverse=True)
    if not firsts:
        return prepare(docs).drop("tie").withColumns({f"next_{c}": F.col(c) for c in columns})
    guests = docs.sparkSession.createDataFrame([(firsts[i - 1][0], *firsts[i][1:]) for i in range(len(firsts))], "cell int, first long, first_tie long")
    guests = docs.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("tie") == F.col("first_tie"))).drop("first", "first_tie")
    rows = prepare(celled.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True))))
    order = W.partitionBy("cell").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    return rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns}).filter("not guest").drop("cell", "guest", "tie")


def fingerprints(docs: DataFrame) -> DataFrame:
    """documents -> doc_id (as a long: a string that holds none is an error), n_chars, text, edited_text, sketches: sketch,
    edited_sketch, next_sketch, and arrays of anchors by word: anchors, edited_anchors.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many (or all) of the next document's.
    A null text is empty. Rows with the same doc_id, or with null ones, are documents of their own. A lone row is its own next.
    """
    rows = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    paired = with_next(rows, ["text", "sketch"], lambda df: with_sketch(df, "text", "sketch"))
    size = F.length("text")
    cut = F.floor(size / 3).cast("int")
    edited = F.concat(F.left("text", size - cut), F.left("next_text", cut))
    paired = paired.select("doc_id", size.cast("long").alias("n_chars"), "text", edited.alias("edited_text"), "sketch", "next_sketch")
    paired = with_anchors(with_anchors(paired, "text", "anchors"), "edited_text", "edited_anchors")
    return paired.withColumn("edited_sketch", sketch_of("edited_anchors"))


def op1_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> the fingerprints of each text and its edited text, their likeness, and from the places of anchors: n_anchors,
    anchors_in_place and first_moved (see in_place()). Nulls, equal ids, an empty table: see fingerprints()."""
    found = fingerprints(table(spark, sf_dir, "documents"))
    together, moved = in_place("anchors", "edited_anchors")
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), shown("sketch").alias("fingerprint"), shown("edited_sketch").alias("edited_fingerprint"), likeness("sketch", "edited_sketch").alias("near_edited"), likeness("sketch", "next_sketch").alias("near_next"),
        F.size(F.array_compact("anchors")).cast("long").alias("n_anchors"), together.alias("anchors_in_place"), moved.alias("first_moved"),
    )
