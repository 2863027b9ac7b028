"""Rows from delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_to_rows(df: DataFrame, column: str, delimiter: str, out: str, outer: bool = False) -> DataFrame:
    """One row per part of a delimited text, in place of the text.

    ``delimiter`` is a regular expression. A null text gives no row, or with ``outer`` one row
    with a null part; an empty text gives one empty part.
    """
    generate = F.explode_outer if outer else F.explode
    return df.withColumn(out, generate(F.split(column, delimiter))).drop(column)
