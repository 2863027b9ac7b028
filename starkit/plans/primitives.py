"""Queries on single operators: sources, sinks, projections, filters, joins, aggregates, windows, sets."""

from __future__ import annotations

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from starkit.functions import exact
from starkit.functions.sums import exact_sums
from starkit.operators.joins import Side, null_safe_join, to_dimensions
from starkit.operators.rows import split_to_rows
from starkit.operators.windows import previous_and_running, top_n
from starkit.plans.flat import sales, table
from starkit.plans.registry import over_sales, query
from starkit.session import fresh_path, stage
from starkit.sources import VersionedTables, Warehouse, quarantine, read_by_header, read_csv, read_table, rejected_dates, rejected_rows, rows

# --- sources and sinks ---------------------------------------------------------------------------

_US_DATE = "M/d/yyyy"


@query("src_csv_infer", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_infer(spark, sf):
    path = fresh_path(spark, "customer-csv")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path)


@query("src_csv_schema", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders")
def csv_schema(spark, sf):
    path = fresh_path(spark, "orders-csv")
    dated = F.date_format("o_orderdate", _US_DATE).alias("o_orderdate")
    table(spark, sf, "orders").select("o_orderkey", dated, "o_totalprice").write.option("header", True).csv(path)
    schema = "o_orderkey bigint, o_orderdate string, o_totalprice double"
    return read_csv(spark, path, schema, {"o_orderdate": _US_DATE})


@query("src_csv_rejects", "SELECT 'o_orderdate' AS column_name, count(*) AS rejected_rows FROM orders WHERE o_orderstatus = 'P'")
def csv_rejects(spark, sf):
    path = fresh_path(spark, "orders-mixed-csv")
    dated = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", _US_DATE)
    )
    table(spark, sf, "orders").select("o_orderkey", dated.alias("o_orderdate")).write.option("header", True).csv(path)
    raw = read_csv(spark, path, "o_orderkey bigint, o_orderdate string")
    return rejected_dates(raw, {"o_orderdate": _US_DATE})


@query(
    "src_csv_bad_numbers",
    """SELECT count(*) AS row_count, count(*) FILTER (o_orderstatus = 'P') AS rejected_rows, count(*) FILTER (o_orderstatus = 'P') = 0 AS passed
       FROM orders""",
)
def csv_bad_numbers(spark, sf):
    """Prices that are no numbers in rows of one status."""
    path = fresh_path(spark, "orders-bad-csv")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    table(spark, sf, "orders").select("o_orderkey", price.alias("price")).write.option("header", True).csv(path)
    return rejected_rows(read_csv(spark, path, "o_orderkey bigint, price double", keep_corrupt=True))


_ORDER_TEXTS = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
    CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' WHEN o_orderkey % 13 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
    CASE WHEN o_orderkey % 17 = 0 THEN '31.31.2020' ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS day FROM orders"""


@query(
    "src_quarantine",
    f"""SELECT reason, count(*) AS rejected_rows FROM (
          SELECT unnest(list_filter([CASE WHEN price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL THEN 'not a double: price' END,
                                     CASE WHEN price IS NULL THEN 'missing price' END,
                                     CASE WHEN TRY_CAST(day AS DATE) IS NULL THEN 'not a date: day' END,
                                     CASE WHEN TRY_CAST(price AS DOUBLE) > 300000 THEN 'too dear' END], lambda x: x IS NOT NULL)) AS reason
          FROM ({_ORDER_TEXTS})) GROUP BY reason
        UNION ALL SELECT 'good', count(*) FROM ({_ORDER_TEXTS})
        WHERE TRY_CAST(price AS DOUBLE) <= 300000 AND TRY_CAST(day AS DATE) IS NOT NULL""",
)
def quarantined(spark, sf):
    """Orders as texts from two files with different column orders; some hold a price or a day that is none."""
    key = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select(
        key.cast("string").alias("o_orderkey"),
        F.when(key % 11 == 0, "n/a").when(key % 13 != 0, F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("price"),
        F.when(key % 17 == 0, "31.31.2020").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("day"), "o_custkey",
    )
    paths = [fresh_path(spark, "orders-csv") for _ in range(2)]
    orders.where(key % 2 == 0).select("o_orderkey", "price", "day").write.option("header", True).csv(paths[0])
    orders.where(key % 2 == 1).select("day", "o_custkey", "o_orderkey", "price").write.option("header", True).csv(paths[1])
    raw = read_by_header(spark, paths, ["o_orderkey", "price", "day"])
    found = quarantine(raw, "o_orderkey bigint not null, price double not null, day date", {"too dear": F.col("price") > 300000}, {"day": "yyyy-MM-dd"})
    good = found.good.agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("rejected_rows"))
    return found.counts().unionByName(good)


@query("src_parquet_scan", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def parquet_scan(spark, sf):
    return spark.read.parquet(f"{sf}/part.parquet")


@query("src_table_load", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def table_load(spark, sf):
    return read_table(spark, f"{sf}/supplier.parquet", "parquet")


@query(
    "src_rows_schema",
    """SELECT c_custkey, v.segment_label, v.segment_rank FROM customer
       JOIN (VALUES ('AUTOMOBILE', 'Cars', 1), ('BUILDING', 'Houses', 2), ('FURNITURE', 'Chairs', 3), ('HOUSEHOLD', 'Homes', 4), ('MACHINERY', 'Machines', 5))
            v(c_mktsegment, segment_label, segment_rank) USING (c_mktsegment)""",
)
def rows_schema(spark, sf):
    labels = rows(
        spark,
        [("AUTOMOBILE", "Cars", 1), ("BUILDING", "Houses", 2), ("FURNITURE", "Chairs", 3), ("HOUSEHOLD", "Homes", 4), ("MACHINERY", "Machines", 5)],
        "c_mktsegment string, segment_label string, segment_rank int",
    )
    joined = table(spark, sf, "customer").join(F.broadcast(labels), "c_mktsegment")
    return joined.select("c_custkey", "segment_label", "segment_rank")


@query(
    "src_rows_names",
    """SELECT o_orderkey, CAST(v.days AS BIGINT) AS days FROM orders
       JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 3), ('3-MEDIUM', 7), ('4-NOT SPECIFIED', 14), ('5-LOW', 30)) v(o_orderpriority, days) USING (o_orderpriority)""",
)
def rows_names(spark, sf):
    days = rows(spark, [("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 7), ("4-NOT SPECIFIED", 14), ("5-LOW", 30)], ["o_orderpriority", "days"])
    return table(spark, sf, "orders").join(F.broadcast(days), "o_orderpriority").select("o_orderkey", "days")


@query(
    "src_rows_objects",
    """SELECT v.label, count(*) AS lines FROM lineitem
       JOIN (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned')) v(l_returnflag, label) USING (l_returnflag) GROUP BY v.label""",
)
def rows_objects(spark, sf):
    labels = rows(spark, [Row(l_returnflag="A", label="accepted"), Row(l_returnflag="N", label="none"), Row(l_returnflag="R", label="returned")])
    joined = table(spark, sf, "lineitem").join(F.broadcast(labels), "l_returnflag")
    return joined.groupBy("label").agg(F.count(F.lit(1)).alias("lines"))


@query("sink_overwrite", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal < 0")
def overwrite(spark, sf):
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    warehouse.save(suppliers.drop("s_acctbal"), "supplier")
    return warehouse.save(suppliers.where("s_acctbal < 0").drop("s_acctbal"), "supplier")


@query(
    "sink_rebuild_in_place",
    """SELECT s_suppkey, CAST(s_acctbal AS DOUBLE) AS first_balance, greatest(s_acctbal, 0) AS balance FROM supplier
       WHERE s_acctbal < 5000""",
)
def rebuild_in_place(spark, sf):
    """A table that is twice replaced by what is made from itself; a reader of its first version keeps it."""
    tables = VersionedTables(spark, fresh_path(spark, "versions"))
    first = tables.save(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), "balances")
    second = tables.save(tables.load("balances").where("s_acctbal < 5000"), "balances", based_on=first)
    raised = tables.load("balances").withColumn("s_acctbal", F.greatest("s_acctbal", F.lit(0.0)))
    tables.save(raised, "balances", based_on=second)
    before = tables.load("balances", first).withColumnRenamed("s_acctbal", "first_balance")
    return before.join(tables.load("balances").withColumnRenamed("s_acctbal", "balance"), "s_suppkey")


@query("sink_managed_table", "SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey")
def save_managed_table(spark, sf):
    """A table in the catalog's own folder, replaced once; the rows come from the catalog."""
    root = fresh_path(spark, "tables")
    name = f"managed_{root.rsplit('-', 1)[1]}"
    warehouse = Warehouse(spark, root)
    customers = table(spark, sf, "customer")
    warehouse.save_table(customers.select("c_nationkey", F.lit(0).cast("bigint").alias("customers")), name, managed=True)
    return warehouse.save_table(customers.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers")), name, managed=True)


@query("sink_save_table", "SELECT n_nationkey, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey")
def save_table(spark, sf):
    root = fresh_path(spark, "tables")
    warehouse = Warehouse(spark, root)
    name = f"customers_{root.rsplit('-', 1)[1]}"
    per_nation = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey"))
    warehouse.save_table(per_nation.agg(F.max("c_custkey").alias("customers")), name)
    return warehouse.save_table(per_nation.agg(F.count(F.lit(1)).alias("customers")), name)


# --- projections and scalars ---------------------------------------------------------------------


@query("proj_select_alias", "SELECT o_orderkey AS OrderKey, o_totalprice AS Total, o_orderstatus AS Status FROM orders")
def select_alias(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("OrderKey"), F.col("o_totalprice").alias("Total"), F.col("o_orderstatus").alias("Status")
    )


@query("proj_drop", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem")
def drop(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.drop("l_shipdate", lines.l_tax).drop("l_discount", "l_linestatus")


@query(
    "sc_cast",
    """SELECT p_partkey, CAST(trunc(p_retailprice) AS INTEGER) AS whole_price, CAST(p_size AS BIGINT) AS size_long,
              TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_number, TRY_CAST(p_name AS INTEGER) AS not_a_number
       FROM part""",
)
def cast(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_retailprice").cast("int").alias("whole_price"),
        F.col("p_size").cast("bigint").alias("size_long"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).try_cast("int").alias("brand_number"),
        F.col("p_name").try_cast("int").alias("not_a_number"),
    )


@query("sc_upper", "SELECT p_partkey, upper(p_name) AS name_upper FROM part")
def upper(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("name_upper"))


@query("sc_year", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders")
def year_of_text(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf, "orders").select("o_orderkey", F.year(text.cast("date")).alias("order_year"))


@query("sc_regexp_replace", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_number FROM orders")
def regexp_replace(spark, sf):
    text = F.col("o_orderdate").cast("date").cast("string")
    return table(spark, sf, "orders").select("o_orderkey", F.regexp_replace(text, "-", "").cast("bigint").alias("date_number"))


# --- filters and nulls ---------------------------------------------------------------------------


@query("flt_compare", over_sales('SELECT "OrderKey", "LineNumber", "UnitPrice" FROM sales_flat WHERE "UnitPrice" < 0'))
def compare(spark, sf):
    return sales(spark, sf, ["OrderKey", "LineNumber", "UnitPrice"]).where(F.col("UnitPrice") < 0)


@query(
    "flt_or_null",
    over_sales('SELECT "OrderKey", "LineNumber", "UnitPrice", "UnitsSold" FROM sales_flat WHERE "UnitPrice" < 0 OR "UnitsSold" IS NULL'),
)
def or_null(spark, sf):
    rows_ = sales(spark, sf, ["OrderKey", "LineNumber", "UnitPrice", "UnitsSold"])
    return rows_.where((F.col("UnitPrice") < 0) | F.col("UnitsSold").isNull())


@query(
    "flt_dropna",
    over_sales("""SELECT "OrderKey", "LineNumber", "ProductName", "UnitsSold", "Discount" FROM sales_flat
                  WHERE "ProductName" IS NOT NULL AND "UnitsSold" IS NOT NULL AND "Discount" IS NOT NULL"""),
)
def dropna(spark, sf):
    return sales(spark, sf, ["OrderKey", "LineNumber", "ProductName", "UnitsSold", "Discount"]).dropna()


@query(
    "flt_fillna_map",
    over_sales("""SELECT "OrderKey", "LineNumber", coalesce("Region", 'Unknown') AS "Region", coalesce("UnitsSold", 0) AS "UnitsSold"
                  FROM sales_flat"""),
)
def fillna_map(spark, sf):
    return sales(spark, sf, ["OrderKey", "LineNumber", "Region", "UnitsSold"]).fillna({"Region": "Unknown", "UnitsSold": 0})


@query(
    "flt_fillna_scalar",
    over_sales("""SELECT "OrderKey", "LineNumber", "ProductName", coalesce("UnitsSold", 0) AS "UnitsSold",
                         coalesce("Discount", 0) AS "Discount" FROM sales_flat"""),
)
def fillna_scalar(spark, sf):
    return sales(spark, sf, ["OrderKey", "LineNumber", "ProductName", "UnitsSold", "Discount"]).fillna(0)


# --- joins ---------------------------------------------------------------------------------------


@query("join_inner_project", "SELECT p_partkey, p_name, l_extendedprice FROM part JOIN lineitem ON p_partkey = l_partkey")
def inner_project(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    lines = table(spark, sf, "lineitem")
    return parts.join(lines, parts.p_partkey == lines.l_partkey, "inner").select(parts["*"], lines.l_extendedprice)


_LOOKUP_SQL = """SELECT o_orderkey, c_name FROM orders
                 LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey"""


def _orders_and_builders(spark, sf):
    builders = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey"), builders


@query("join_left_lookup", _LOOKUP_SQL)
def left_lookup(spark, sf):
    orders, builders = _orders_and_builders(spark, sf)
    return orders.join(builders, orders.o_custkey == builders.c_custkey, "left").select("o_orderkey", "c_name")


@query("join_broadcast", _LOOKUP_SQL)
def broadcast_lookup(spark, sf):
    """The lookup side is measured and broadcast if it is small."""
    orders, builders = _orders_and_builders(spark, sf)
    return to_dimensions(orders, [Side(builders, {"o_custkey": "c_custkey"}, ["c_name"])]).select("o_orderkey", "c_name")


@query("join_spread_lookup", _LOOKUP_SQL)
def spread_lookup(spark, sf):
    """The way for a lookup side too large to broadcast: shuffled, with hot keys spread."""
    orders, builders = _orders_and_builders(spark, sf)
    joined = to_dimensions(orders, [Side(builders, {"o_custkey": "c_custkey"}, ["c_name"])], broadcast_bytes=0)
    return joined.select("o_orderkey", "c_name")


@query(
    "join_null_safe",
    over_sales(
        """SELECT s."OrderKey", s."LineNumber", s."Region", t."RegionUnits" FROM sales_flat s
           JOIN (SELECT "Region", CAST(sum("UnitsSold") AS DOUBLE) AS "RegionUnits" FROM sales_flat GROUP BY "Region") t
             ON s."Region" IS NOT DISTINCT FROM t."Region" """
    ),
)
def null_safe(spark, sf):
    lines = sales(spark, sf, ["OrderKey", "LineNumber", "Region"])
    units = _total("UnitsSold").alias("RegionUnits")
    # One row per region and one for null; staged, so that Spark knows how small it is.
    per_region = stage(sales(spark, sf, ["Region", "UnitsSold"]).groupBy(F.col("Region").alias("_region")).agg(units), "regions")
    return null_safe_join(lines, per_region, {"Region": "_region"}).drop("_region")


# --- aggregates ----------------------------------------------------------------------------------


def _total(column: str, scale: int = 2):
    """The tables hold amounts with two decimal places; a value with more fails the query."""
    return F.sum(exact(F.col(column), DoubleType(), scale)).cast("double")


@query(
    "agg_total_per_key",
    "SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value FROM events GROUP BY user_id",
)
def total_per_key(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(_total("value").alias("total_value"))


@query(
    "agg_avg_per_key",
    "SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS avg_quantity FROM lineitem GROUP BY l_partkey",
)
def avg_per_key(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.avg("l_quantity").alias("avg_quantity"))


@query("agg_count_per_key", over_sales('SELECT "Region", count("UnitsSold") AS sold_rows FROM sales_flat GROUP BY "Region"'))
def count_per_key(spark, sf):
    return sales(spark, sf, ["Region", "UnitsSold"]).groupBy("Region").agg(F.count("UnitsSold").alias("sold_rows"))


@query("agg_min_max_global", 'SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders')
def min_max_global(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


@query(
    "agg_sum_two_keys",
    over_sales("""SELECT "CustomerSegment", "Region", CAST(sum(CAST("Revenue" AS DECIMAL(18,2))) AS DOUBLE) AS "TotalRevenue"
                  FROM sales_flat GROUP BY "CustomerSegment", "Region" """),
)
def sum_two_keys(spark, sf):
    lines = sales(spark, sf, ["CustomerSegment", "Region", "Revenue"])
    return lines.groupBy("CustomerSegment", "Region").agg(_total("Revenue").alias("TotalRevenue"))


_NET = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * (1 + CAST(l_tax AS DECIMAL(4,2)))"


def _charges(spark, sf):
    """What is charged for each line, with six decimal places, held as double."""
    factors = [exact(F.col(c), DoubleType(), 2) for c in ("l_extendedprice", "l_discount", "l_tax")]
    amount = factors[0].cast("decimal(12,2)") * (1 - factors[1].cast("decimal(4,2)")) * (1 + factors[2].cast("decimal(4,2)"))
    lines = table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_suppkey", amount.cast("double").alias("charge"))


@query(
    "agg_sum_fine_fractions",
    f"SELECT l_suppkey, CAST(sum({_NET}) AS DOUBLE) AS total_charge FROM lineitem GROUP BY l_suppkey",
)
def sum_fine_fractions(spark, sf):
    """Sums of a measure with six decimal places that was saved as double."""
    return _charges(spark, sf).groupBy("l_suppkey").agg(_total("charge", 6).alias("total_charge"))


@query(
    "win_running_fine_fractions",
    f"""SELECT l_orderkey, l_linenumber, CAST(sum({_NET}) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, {_NET}
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_charge FROM lineitem""",
)
def running_fine_fractions(spark, sf):
    lines = previous_and_running(
        _charges(spark, sf), ["l_suppkey"], ["l_orderkey", "l_linenumber", "charge"], "charge", running="running_charge", scale=6
    )
    return lines.select("l_orderkey", "l_linenumber", "running_charge")


#: A double of at least 64 is a whole number of 2**-46; both halves of the sum are whole numbers, and adding them rounds once.
_SEVENTH = """CAST(floor(l_extendedprice / 7 * 1048576) AS BIGINT) AS h,
              CAST((l_extendedprice / 7 * 1048576 - floor(l_extendedprice / 7 * 1048576)) * 67108864 AS BIGINT) AS l"""
_HALVES = "(CAST({h} + ({l} >> 26) AS DOUBLE) + CAST({l} & 67108863 AS DOUBLE) / 67108864) / 1048576"


def _sevenths(spark, sf):
    """Fractions that no decimal holds."""
    lines = table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_suppkey", (F.col("l_extendedprice") / 7).alias("share"))


@query(
    "agg_sum_any_double",
    f"""SELECT l_suppkey, {_HALVES.format(h="sum_h", l="sum_l")} AS total_share
        FROM (SELECT l_suppkey, CAST(sum(h) AS BIGINT) AS sum_h, CAST(sum(l) AS BIGINT) AS sum_l
              FROM (SELECT l_suppkey, {_SEVENTH} FROM lineitem) GROUP BY l_suppkey)""",
)
def sum_any_double(spark, sf):
    """Sums of binary fractions, each the double that is nearest to the true sum."""
    return exact_sums(_sevenths(spark, sf), ["l_suppkey"], {"total_share": "share"})


@query(
    "win_running_any_double",
    f"""SELECT l_orderkey, l_linenumber, {_HALVES.format(h="sum_h", l="sum_l")} AS running_share
        FROM (SELECT l_orderkey, l_linenumber, CAST(sum(h) OVER w AS BIGINT) AS sum_h, CAST(sum(l) OVER w AS BIGINT) AS sum_l
              FROM (SELECT l_orderkey, l_linenumber, l_extendedprice, l_suppkey, {_SEVENTH} FROM lineitem)
              WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_extendedprice ROWS UNBOUNDED PRECEDING))""",
)
def running_any_double(spark, sf):
    lines = previous_and_running(
        _sevenths(spark, sf), ["l_suppkey"], ["l_orderkey", "l_linenumber", "share"], "share", running="running_share"
    )
    return lines.select("l_orderkey", "l_linenumber", "running_share")


# --- windows and sorts ---------------------------------------------------------------------------


@query(
    "win_top_1",
    """SELECT day, event_id, value FROM (
         SELECT CAST(ts AS DATE) AS day, event_id, value,
                row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY value DESC, event_id) AS n FROM events)
       WHERE n = 1""",
)
def top_1(spark, sf):
    daily = table(spark, sf, "events").select(F.col("ts").cast("date").alias("day"), "event_id", "value")
    return top_n(daily, ["day"], [F.col("value").desc(), F.col("event_id")], 1)


@query(
    "win_top_n",
    """SELECT c_nationkey, c_custkey, c_acctbal FROM (
         SELECT c_nationkey, c_custkey, c_acctbal,
                row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer)
       WHERE n <= 2""",
)
def top_2(spark, sf):
    customers = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return top_n(customers, ["c_nationkey"], [F.col("c_acctbal").desc(), F.col("c_custkey")], 2)


def _order_history(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice"
    )
    return previous_and_running(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", scale=2)


@query(
    "win_lag",
    """SELECT o_custkey, o_orderkey, lag(o_totalprice, 1, 0)
              OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_value FROM orders""",
)
def lag(spark, sf):
    return _order_history(spark, sf).select("o_custkey", "o_orderkey", "previous_value")


@query(
    "win_running_total",
    """SELECT o_custkey, o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
                PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM orders""",
)
def running_total(spark, sf):
    return _order_history(spark, sf).select("o_custkey", "o_orderkey", "running_total")


@query("sort_asc", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey")
def sort_asc(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey")


@query("top_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20")
def top_limit(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey").limit(20)


# --- sets and generators -------------------------------------------------------------------------


@query("set_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query(
    "set_union_all",
    """SELECT l_partkey AS item, l_quantity AS amount FROM lineitem WHERE l_returnflag = 'A'
       UNION ALL SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'""",
)
def union_all(spark, sf):
    lines = table(spark, sf, "lineitem")
    accepted = lines.where("l_returnflag = 'A'").select(F.col("l_partkey").alias("item"), F.col("l_quantity").alias("amount"))
    return accepted.unionAll(lines.where("l_returnflag = 'R'").select("l_suppkey", "l_quantity"))


@query(
    "set_except_all",
    "SELECT l_partkey, l_quantity FROM lineitem EXCEPT ALL SELECT l_partkey, l_quantity FROM lineitem WHERE l_returnflag <> 'N'",
)
def except_all(spark, sf):
    lines = table(spark, sf, "lineitem")
    settled = lines.where("l_returnflag <> 'N'")
    return lines.select("l_partkey", "l_quantity").exceptAll(settled.select("l_partkey", "l_quantity"))


@query("gen_split_explode", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def split_explode(spark, sf):
    return split_to_rows(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", " ", "word")


@query(
    "gen_split_explode_outer",
    over_sales("""SELECT "OrderKey", "LineNumber", unnest(string_split("ProductName", ' ')) AS word
                  FROM sales_flat WHERE "ProductName" IS NOT NULL
                  UNION ALL SELECT "OrderKey", "LineNumber", NULL FROM sales_flat WHERE "ProductName" IS NULL"""),
)
def split_explode_outer(spark, sf):
    lines = sales(spark, sf, ["OrderKey", "LineNumber", "ProductName"])
    return split_to_rows(lines, "ProductName", " ", "word", outer=True)
