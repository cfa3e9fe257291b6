"""Numbers and running sums over a whole table in one order, without a task that sees more than a range of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectio.sources.shared import few, stored

#: Below the bits that number a partition, Spark's increasing ids have these for the row in it.
_ROW_BITS = 33


def _ranged(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """df with _at, (partition, row in it) in one number that grows in this order; written once, so that it stays the same."""
    return stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranged")


def _before(parts: DataFrame) -> DataFrame:
    """(_part, _sum) -> (_part, _before). One row for each range, so the window that has no key stays small."""
    return parts.select("_part", (F.sum("_sum").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, 0)) - F.col("_sum")).alias("_before"))


def numbered(df: DataFrame, order: list[Column | str], name: str = "number", within: list[str] = ()) -> DataFrame:
    """df and ``name``: from 0 in this order, over the whole table or over the rows of equal ``within`` columns.

    ``within`` must come first in the order. One exchange of the rows, by ranges; counts of the ranges give the offsets.
    Rows that are equal in the order are numbered in any order, and share a range. An empty table has none.
    """
    rows = _ranged(df, order)
    part = F.shiftright("_at", _ROW_BITS)
    offsets = _before(rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_sum")))
    rows = rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    rows = rows.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)).drop("_part", "_before", "_at")
    if not within:
        return rows.select(*df.columns, name)
    first = rows.groupBy(*within).agg(F.min(name).alias("_first"))
    # few groups are broadcast, so that a large one is not dealt to one task
    first = few(stored(first.select(*(F.col(c).alias(f"_in_{c}") for c in within), "_first"), "firsts"))
    same = [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in within]
    met = same[0]
    for x in same[1:]:
        met = met & x
    return rows.join(first, met).select(*df.columns, (F.col(name) - F.col("_first")).alias(name))


def sum_before(df: DataFrame, order: list[Column | str], amount: str, name: str) -> DataFrame:
    """df and ``name``: the sum of ``amount`` over all rows before this one in the order. Ranges first, then within each."""
    rows = _ranged(df, order).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    offsets = _before(rows.groupBy("_part").agg(F.sum(amount).alias("_sum")))
    own = F.sum(amount).over(W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)) - F.col(amount)
    return rows.withColumn("_own", own).join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_before") + F.col("_own")).alias(name))
