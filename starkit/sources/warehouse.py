"""Where dimensions and facts are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starkit.sources.readers import read_table


class Warehouse:
    """One folder per table below ``root``; writing and reading share the path."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Replace the table. ``df`` must not read the table it replaces."""
        df.write.format(self.fmt).mode("overwrite").save(self.path(name))
        return self.load(name)

    def load(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name), self.fmt)

    def save_table(self, df: DataFrame, table: str, managed: bool = False) -> DataFrame:
        """Replace a catalog table: files below ``root``, or in the catalog's own folder if ``managed``."""
        writer = df.write.format(self.fmt).mode("overwrite")
        if not managed:
            writer = writer.option("path", self.path(table))
        writer.saveAsTable(table)
        return self.spark.table(table)
