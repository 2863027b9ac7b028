"""CSV, table and inline sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkit.session import stage


#: Column that holds a row which does not fit its schema, as it stands in the file.
CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    date_formats: Mapping[str, str] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV with a header row.

    With a ``schema`` the file is read once, and a header with other names, or in another order, fails the query; without one
    Spark infers the types in a pass of its own. With ``keep_corrupt``, rows that do not fit a declared schema (a bad number,
    a missing or an extra field) have their text in a column CORRUPT (``rejected_rows`` counts them).
    ``date_formats`` names text columns and the pattern to parse them by: text that does not fit becomes null
    (``rejected_dates`` counts those).
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return parse_dates(reader.option("inferSchema", True).csv(path), date_formats or {})
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = reader.option("enforceSchema", False)
    if keep_corrupt:
        schema = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    return parse_dates(reader.schema(schema).csv(path), date_formats or {})


def rejected_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows of ``read_csv`` with ``keep_corrupt`` do not fit the schema, and whether none does.

    The parsed rows are written first, as Spark parses only the columns that a query uses.
    """
    counted = stage(df, "parsed").agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(CORRUPT).isNotNull()).alias("rejected_rows"))
    return counted.withColumn("passed", F.col("rejected_rows") == 0)


def parse_dates(df: DataFrame, date_formats: Mapping[str, str]) -> DataFrame:
    if not date_formats:
        return df
    return df.withColumns({name: F.try_to_date(name, pattern) for name, pattern in date_formats.items()})


def rejected_dates(raw: DataFrame, date_formats: Mapping[str, str]) -> DataFrame:
    """One row per text date column: how many non-null texts do not fit the pattern."""
    counts = raw.agg(
        *[
            F.count_if(F.col(name).isNotNull() & F.try_to_date(name, pattern).isNull()).alias(name)
            for name, pattern in date_formats.items()
        ]
    )
    return counts.unpivot([], list(date_formats), "column_name", "rejected_rows")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table in any format on the classpath (``parquet``, or ``delta`` with its jar)."""
    return spark.read.format(fmt).load(path)


def rows(spark: SparkSession, data: Sequence, schema: T.StructType | Sequence[str] | str | None = None) -> DataFrame:
    """Inline rows: with a full schema, with column names only, or as ``Row`` objects."""
    return spark.createDataFrame(data, schema) if schema is not None else spark.createDataFrame(data)
