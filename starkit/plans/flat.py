"""The flat sales extract over the test tables: one row per line item.

Every lookup is a left join on a primary key, so the extract has the rows of ``lineitem`` whatever
columns are asked for, and only the tables behind those columns are joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """Expression, the table it comes from, and the line number on which a defect is injected."""

    expression: str
    table: str
    null_on_line: int | None = None


FIELDS = {
    "OrderKey": Field("l_orderkey", "lineitem"),
    "LineNumber": Field("l_linenumber", "lineitem"),
    "PartKey": Field("l_partkey", "lineitem"),
    "Region": Field("r_name", "region", 7),
    "ProductCategory": Field("p_type", "part"),
    "ProductSubCategory": Field("p_brand", "part"),
    "ProductName": Field("p_name", "part", 6),
    "SalesChannel": Field("o_orderpriority", "orders"),
    "CustomerSegment": Field("c_mktsegment", "customer"),
    "SalesRep": Field("s_name", "supplier"),
    "RepNation": Field("rep_nation", "rep_nation"),
    "StoreName": Field("n_name", "nation"),
    "StoreType": Field("l_returnflag", "lineitem"),
    "SalesDate": Field("cast(o_orderdate as date)", "orders", 5),
    "UnitsSold": Field("l_quantity", "lineitem", 4),
    "UnitPrice": Field("if(l_linenumber = 3, -p_retailprice, p_retailprice)", "part"),
    "Discount": Field("cast(cast(l_discount as decimal(4,2)) * 100 as double)", "lineitem", 2),
    "Revenue": Field("l_extendedprice", "lineitem"),
}

# Tables that must be joined before the one named.
_BEHIND = {
    "lineitem": (),
    "orders": ("orders",),
    "customer": ("orders", "customer"),
    "nation": ("orders", "customer", "nation"),
    "region": ("orders", "customer", "nation", "region"),
    "part": ("part",),
    "supplier": ("supplier",),
    "rep_nation": ("supplier", "rep_nation"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, with the schema that its files have now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The extract, or the named columns of it."""
    columns = list(columns or FIELDS)
    lines = _join_tables(spark, sf_dir, table(spark, sf_dir, "lineitem"), columns)
    return lines.select(*[F.expr(_null_on(FIELDS[c], f"l_linenumber = {FIELDS[c].null_on_line}")).alias(c) for c in columns])


def sales_values(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """The named columns as a set: for dimensions, which need each combination once.

    Where only parts and suppliers are looked up, line items are first reduced to the distinct
    foreign keys, so that lookups see far fewer rows. Orders are nearly as many as
    line items, so there the reduction would not pay.
    """
    tables = {t for c in columns for t in _BEHIND[FIELDS[c].table]}
    if not tables or "orders" in tables or "UnitPrice" in columns:
        return sales(spark, sf_dir, columns).distinct()
    foreign = [key for name, key in (("part", "l_partkey"), ("supplier", "l_suppkey")) if name in tables]
    own = [FIELDS[c].expression for c in columns if FIELDS[c].table == "lineitem"]
    marks = {FIELDS[c].null_on_line for c in columns} - {None}
    reduced = (
        table(spark, sf_dir, "lineitem")
        .select(
            *dict.fromkeys(foreign + own),
            *[(F.col("l_linenumber") == line).alias(f"_line_{line}") for line in sorted(marks)],
        )
        .distinct()
    )
    lines = _join_tables(spark, sf_dir, reduced, columns)
    return lines.select(
        *[F.expr(_null_on(FIELDS[c], f"_line_{FIELDS[c].null_on_line}")).alias(c) for c in columns]
    ).distinct()


def _null_on(field: Field, condition: str) -> str:
    return field.expression if field.null_on_line is None else f"if({condition}, null, {field.expression})"


def _join_tables(spark: SparkSession, sf_dir: str, lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    tables = {t for c in columns for t in _BEHIND[FIELDS[c].table]}
    if "orders" in tables:
        # Customer attributes are attached to the orders, so line items move once for all of them.
        orders = table(spark, sf_dir, "orders")
        if "customer" in tables:
            orders = orders.join(
                table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "left"
            )
        lines = lines.join(orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey", "left")
    if "part" in tables:
        lines = lines.join(table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey", "left")
    if "supplier" in tables:
        suppliers = table(spark, sf_dir, "supplier")
        if "rep_nation" in tables:
            nations = table(spark, sf_dir, "nation").select(
                F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("rep_nation")
            )
            suppliers = suppliers.join(nations, "s_nationkey", "left")
        lines = lines.join(suppliers.withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey", "left")
    if "nation" in tables:
        # last, so that what is shuffled and sorted before holds a number in place of two names
        nation = table(spark, sf_dir, "nation")
        if "region" in tables:
            regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
            nation = nation.join(regions, "n_regionkey", "left")
        lines = lines.join(nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey", "left")
    return lines
