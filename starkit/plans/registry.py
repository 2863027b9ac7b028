"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str


REGISTRY: dict[str, Query] = {}

_SALES = """
sales_flat AS (
  SELECT l_orderkey AS "OrderKey", l_linenumber AS "LineNumber", l_partkey AS "PartKey",
         CASE WHEN l_linenumber = 7 THEN NULL ELSE r_name END AS "Region",
         p_type AS "ProductCategory", p_brand AS "ProductSubCategory",
         CASE WHEN l_linenumber = 6 THEN NULL ELSE p_name END AS "ProductName",
         o_orderpriority AS "SalesChannel", c_mktsegment AS "CustomerSegment",
         s_name AS "SalesRep", sn.n_name AS "RepNation", cn.n_name AS "StoreName",
         l_returnflag AS "StoreType",
         CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS "SalesDate",
         CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity END AS "UnitsSold",
         CASE WHEN l_linenumber = 3 THEN -p_retailprice ELSE p_retailprice END AS "UnitPrice",
         CASE WHEN l_linenumber = 2 THEN NULL
              ELSE CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DOUBLE) END AS "Discount",
         l_extendedprice AS "Revenue"
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
  LEFT JOIN region ON cn.n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
)"""


def over_sales(select: str, *tables: str) -> str:
    """SQL with the flat extract, and further ``name AS (...)`` tables, in front of it."""
    return f"WITH {', '.join([_SALES, *tables])}\n{select}"


def query(name: str, sql: str):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def add(run):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return add
