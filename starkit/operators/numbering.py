"""Surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.functions.keys import UNKNOWN_KEY
from starkit.session import stage

# monotonically_increasing_id: partition number above bit 33, row within the partition below.
_ROW_BITS = 33


def dense_key(df: DataFrame, order: list[str], key: str, start: int = 0) -> DataFrame:
    """Add ``key`` = start+1, start+2, ... in the order of ``order``, which should be unique.

    Rows are range-partitioned and sorted within their range; each range counts its own rows and
    a key is the size of all earlier ranges plus the place within the range. One range shuffle,
    no total sort in one task. The ranged rows are written once, so numbers cannot change when a
    task runs again. Only the range sizes, one number per range, pass through the driver.
    """
    spark = df.sparkSession
    ranged = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()),
        f"ranged-{key}",
    )
    range_of = F.shiftright("_place", _ROW_BITS)
    sizes = ranged.groupBy(range_of.alias("_range")).agg(F.count(F.lit(1)).alias("_rows")).collect()
    offsets, total = [], start
    for row in sorted(sizes):
        offsets.append((row["_range"], total))
        total += row["_rows"]
    place = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    if len(offsets) > 1:
        table = F.broadcast(spark.createDataFrame(offsets, "_range long, _before long"))
        ranged = ranged.withColumn("_range", range_of).join(table, "_range")
        before = F.col("_before")
    else:
        before = F.lit(start)
    return ranged.select(*df.columns, (before + place + 1).cast("bigint").alias(key))


def stable_key(existing: DataFrame, values: DataFrame, natural: list[str], key: str) -> DataFrame:
    """Carry a dimension over to new values: known members keep their key, new ones are numbered on.

    The result must be written beside ``existing``, not over it: its plan reads that table.
    """
    known = existing.where(F.col(key) != UNKNOWN_KEY)
    fresh = values.join(known.select(*natural), natural, "left_anti")
    highest = known.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    numbered = dense_key(fresh, natural, key, start=highest)
    return existing.unionByName(numbered.select(*existing.columns))
