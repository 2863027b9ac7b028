"""Size checks that come before a broadcast or a split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed limits; every operator that uses one takes it as a parameter too.
BROADCAST_BYTES = 64 * 1024 * 1024
GROUP_ROWS = 5_000_000

_ROW_OVERHEAD = 32
_COLUMN_OVERHEAD = 16
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def payload_bytes(frames: Sequence[DataFrame]) -> list[int | None]:
    """Measured size of the rows of each frame, all in one job; None where a column has no known width."""
    sizes: list[int | None] = [0 if _known_width(df) else None for df in frames]
    rows = [_row_sizes(place, df) for place, df in enumerate(frames) if sizes[place] is not None]
    if rows:
        summed = reduce(DataFrame.unionAll, rows).groupBy("place").agg(F.sum("bytes"))
        for place, size in summed.collect():
            sizes[place] = size
    return sizes


def _known_width(df: DataFrame) -> bool:
    return all(isinstance(f.dataType, (T.StringType, *_FIXED_WIDTH)) for f in df.schema.fields)


def _row_sizes(place: int, df: DataFrame) -> DataFrame:
    per_row = _ROW_OVERHEAD + _COLUMN_OVERHEAD * len(df.columns)
    texts = [F.octet_length(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    length = reduce(add, [F.coalesce(text, F.lit(0)) for text in texts], F.lit(per_row))
    return df.select(F.lit(place).alias("place"), length.alias("bytes"))


def fits_broadcast(frames: Sequence[DataFrame], limit: int = BROADCAST_BYTES) -> list[bool]:
    """Which frames may be sent to every executor: the smallest ones, as long as all of them together stay within the limit."""
    sizes = payload_bytes(frames)
    fits, total = [False] * len(sizes), 0
    for place in sorted((i for i, size in enumerate(sizes) if size is not None), key=lambda i: sizes[i]):
        total += sizes[place]
        fits[place] = total <= limit
    return fits


def fits_broadcast_together(frames: Sequence[DataFrame], limit: int = BROADCAST_BYTES) -> bool:
    """Whether all frames together are measured to be small enough."""
    sizes = payload_bytes(frames)
    return None not in sizes and sum(sizes) <= limit


def hot_groups(df: DataFrame, keys: list[str], max_rows: int = GROUP_ROWS) -> DataFrame:
    """Groups above ``max_rows`` with their row count; at most ``rows / max_rows`` of them.

    Counts are combined before the shuffle, so a hot group arrives as one row per input task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > max_rows)
