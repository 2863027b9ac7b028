"""Queries on dimensions, facts, checks and reports of the star schema."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from starkit.functions import UNKNOWN_KEY, exact
from starkit.operators import checks, dims, facts, reports
from starkit.operators.dims import CompositeDim
from starkit.operators.reports import Attribute
from starkit.plans import star
from starkit.plans.flat import sales, table
from starkit.plans.registry import over_sales, query
from starkit.session import stage

# --- dimensions ----------------------------------------------------------------------------------


def _attribute_sql(spec) -> str:
    return over_sales(
        f'SELECT DISTINCT "{spec.source}" AS "{spec.target}", false AS is_unknown FROM sales_flat '
        f"""WHERE "{spec.source}" IS NOT NULL UNION ALL SELECT 'N/A', true"""
    )


for _name, _spec in {
    "dim_attribute_hash": star.REGION,
    "dim_category": star.CATEGORY,
    "dim_subcategory": star.SUBCATEGORY,
    "dim_channel": star.CHANNEL,
    "dim_segment": star.SEGMENT,
    "dim_rep": star.REP,
    "dim_store_type": star.STORE_TYPE,
}.items():

    @query(_name, _attribute_sql(_spec))
    def attribute_hash(spark, sf, spec=_spec):
        """The key itself has no counterpart in the SQL; only whether it is the unknown one."""
        built = star.attribute_dim(spark, sf, spec)
        return built.select(spec.target, (F.col(spec.key) == UNKNOWN_KEY).alias("is_unknown"))


def _composite_sql(spec) -> str:
    pairs = ", ".join(f'"{old}" AS "{new}"' for old, new in spec.columns.items())
    names = ", ".join(f'"{c}"' for c in spec.natural)
    known = " AND ".join(f'"{c}" IS NOT NULL' for c in spec.columns)
    unknown = ", ".join("'N/A'" for _ in spec.columns)
    return over_sales(
        f'SELECT {names}, CAST(row_number() OVER (ORDER BY {names}) AS BIGINT) AS "{spec.key}" '
        f"FROM (SELECT DISTINCT {pairs} FROM sales_flat WHERE {known}) UNION ALL SELECT {unknown}, -1"
    )


for _name, _spec in {"dim_surrogate": star.PRODUCT, "dim_store": star.STORE, "dim_employee": star.EMPLOYEE}.items():

    @query(_name, _composite_sql(_spec))
    def surrogate(spark, sf, spec=_spec):
        return star.composite_dim(spark, sf, spec)


@query(
    "dim_stable",
    over_sales(
        """SELECT "SalesRep", "Nation", CAST(row_number() OVER (ORDER BY early DESC, "SalesRep", "Nation") AS BIGINT) AS "EmployeeKey"
           FROM (SELECT "SalesRep", "RepNation" AS "Nation", "RepNation" < 'NATION_2' AS early
                 FROM sales_flat WHERE "SalesRep" IS NOT NULL AND "RepNation" IS NOT NULL GROUP BY "SalesRep", "RepNation")
           UNION ALL SELECT 'N/A', 'N/A', -1"""
    ),
)
def stable(spark, sf):
    """A dimension built while about half of the nations had sales, carried over to all sales."""
    members = star.sales_values(spark, sf, list(star.EMPLOYEE.columns))
    early = members.where(F.col("RepNation") < "NATION_2")
    before = stage(dims.composite_dimension(early, star.EMPLOYEE), "employee-before")
    return dims.composite_dimension(members, star.EMPLOYEE, "stable", before)


@query(
    "dim_from_source",
    """SELECT s_name, s_nationkey, s_acctbal, CAST(row_number() OVER (ORDER BY s_name) AS BIGINT) AS "SupplierKey" FROM supplier
       UNION ALL SELECT 'N/A', NULL, NULL, -1""",
)
def from_source(spark, sf):
    return dims.dimension_from_source(table(spark, sf, "supplier"), ["s_name"], ["s_suppkey"], "SupplierKey")


@query(
    "dim_unknown_member",
    over_sales(
        " UNION ALL ".join(
            f"""SELECT '{spec.key}' AS dimension, member FROM (
                  SELECT row_number() OVER (ORDER BY m) AS k, m AS member FROM (SELECT DISTINCT "{spec.source}" AS m FROM sales_flat)
                  WHERE m IS NOT NULL UNION ALL SELECT -1, 'N/A') WHERE k = -1"""
            for spec in star.ATTRIBUTES
        )
        + """ UNION ALL SELECT 'DateKey', member FROM (
                SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS k, monthname(d) AS member FROM (SELECT DISTINCT "SalesDate" AS d FROM sales_flat)
                WHERE d IS NOT NULL UNION ALL SELECT -1, 'N/A') WHERE k = -1"""
    ),
)
def unknown_members(spark, sf):
    """The unknown row of every dimension."""
    built = star.all_dims(sales(spark, sf, star.ALL_ATTRIBUTES))
    shown = [(spec.key, built[spec.key], spec.target) for spec in star.ATTRIBUTES]
    shown.append(("DateKey", built["DateKey"], "MonthName"))
    found = [
        dim.where(F.col(key) == UNKNOWN_KEY).select(F.lit(key).alias("dimension"), F.col(column).alias("member"))
        for key, dim, column in shown
    ]
    return reduce(lambda a, b: a.unionByName(b), found)


@query(
    "dim_date",
    over_sales(
        """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS "DateKey", CAST(d AS DATE) AS "Date", monthname(d) AS "MonthName",
                  CAST(year(d) AS INTEGER) AS "Year", CAST(quarter(d) AS INTEGER) AS "Quarter",
                  CASE WHEN month(d) >= 8 THEN 'Fall' WHEN month(d) <= 5 THEN 'Spring' ELSE 'Summer' END AS "Semester"
           FROM (SELECT unnest(generate_series(make_date(year(min("SalesDate")), 1, 1)::TIMESTAMP,
                                               make_date(year(max("SalesDate")), 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS d
                 FROM sales_flat)
           UNION ALL SELECT -1, NULL, 'N/A', NULL, NULL, 'N/A'"""
    ),
)
def date_dimension(spark, sf):
    return star.date_dim(spark, sf)


_FOCUS = """focus AS (
  SELECT "ProductCategory", "CustomerSegment", "Region",
         concat_ws(' / ', "Region", "ProductCategory", "CustomerSegment") AS "MappingLabel",
         CAST(row_number() OVER (ORDER BY "ProductCategory", "CustomerSegment", "Region") AS BIGINT) AS "CustomMappingKey"
  FROM (SELECT "ProductCategory", "CustomerSegment", "Region",
               row_number() OVER (PARTITION BY "ProductCategory", "Region" ORDER BY revenue DESC, "CustomerSegment") AS n
        FROM (SELECT "ProductCategory", "CustomerSegment", "Region", sum(CAST("Revenue" AS DECIMAL(18,2))) AS revenue
              FROM sales_flat WHERE "Region" IS NOT NULL GROUP BY 1, 2, 3))
  WHERE n <= 2)"""


@query("dim_custom_mapping", over_sales("SELECT * FROM focus UNION ALL SELECT 'N/A', 'N/A', 'N/A', 'N/A', -1", _FOCUS))
def custom_mapping(spark, sf):
    return star.focus_dim(spark, sf)


# --- facts ---------------------------------------------------------------------------------------

_NAMES = {
    "Region": star.REGION,
    "Category": star.CATEGORY,
    "SubCategory": star.SUBCATEGORY,
    "Channel": star.CHANNEL,
    "Segment": star.SEGMENT,
    "Rep": star.REP,
    "StoreType": star.STORE_TYPE,
}


def _detail(spark, sf, keep):
    extract = star.staged_sales(spark, sf, [*star.ALL_ATTRIBUTES, *keep])
    built = star.all_dims(extract)
    by = {out: Attribute(built[spec.key], spec.key, spec.target) for out, spec in _NAMES.items()}
    by["Date"] = Attribute(built["DateKey"], "SalesDateKey", "Date", "DateKey")
    return reports.detail(facts.key_by_hash(extract, star.ATTRIBUTES, star.DATES), by, keep)


_DETAIL = ", ".join(f"""coalesce("{spec.source}", 'N/A') AS "{out}" """ for out, spec in _NAMES.items())


@query(
    "fact_hash_keys",
    over_sales(f'SELECT "OrderKey", "LineNumber", {_DETAIL}, "SalesDate" AS "Date" FROM sales_flat'),
)
def hash_keys(spark, sf):
    """Keys have no counterpart in the SQL, so they are resolved to names again."""
    return _detail(spark, sf, ["OrderKey", "LineNumber"])


@query("fact_hash_keys_murmur3", over_sales(f'SELECT "OrderKey", "LineNumber", {_DETAIL} FROM sales_flat'))
def hash_keys_murmur3(spark, sf):
    """All attribute dimensions keyed by the 32-bit hash, resolved to names again."""
    specs = {out: replace(spec, algorithm="murmur3") for out, spec in _NAMES.items()}
    extract = star.staged_sales(spark, sf, ["OrderKey", "LineNumber", *[spec.source for spec in specs.values()]])
    built = dims.star_dimensions(extract, list(specs.values()))
    by = {out: Attribute(built[spec.key], spec.key, spec.target) for out, spec in specs.items()}
    return reports.detail(facts.key_by_hash(extract, list(specs.values())), by, ["OrderKey", "LineNumber"])


@query(
    "fact_lookup_single",
    over_sales(
        """SELECT s."OrderKey", s."LineNumber", s."Revenue", CAST(coalesce(r.k, -1) AS BIGINT) AS "RegionKey",
                  CAST(coalesce(n.k, -1) AS BIGINT) AS "StoreKey", CAST(coalesce(p.k, -1) AS BIGINT) AS "SalesRepKey"
           FROM sales_flat s
           LEFT JOIN (SELECT r_name, row_number() OVER (ORDER BY r_name) AS k FROM region) r ON s."Region" = r.r_name
           LEFT JOIN (SELECT n_name, row_number() OVER (ORDER BY n_name) AS k FROM nation) n ON s."StoreName" = n.n_name
           LEFT JOIN (SELECT s_name, row_number() OVER (ORDER BY s_name) AS k FROM supplier) p ON s."SalesRep" = p.s_name"""
    ),
)
def lookup_single(spark, sf):
    fact = sales(spark, sf, ["OrderKey", "LineNumber", "Revenue", "Region", "StoreName", "SalesRep"])
    return facts.key_by_lookup(fact, star.source_lookups(spark, sf))


def _keyed(spec, name: str) -> str:
    names = ", ".join(f'"{c}"' for c in spec.columns)
    known = " AND ".join(f'"{c}" IS NOT NULL' for c in spec.columns)
    return (
        f"{name} AS (SELECT {names}, CAST(row_number() OVER (ORDER BY {names}) AS BIGINT) AS k "
        f"FROM (SELECT DISTINCT {names} FROM sales_flat WHERE {known}))"
    )


_CLEAN = """cleaned AS (
  SELECT * REPLACE (coalesce("UnitsSold", 0) AS "UnitsSold", greatest(coalesce("UnitPrice", 0), 0) AS "UnitPrice",
                    coalesce("ProductName", 'N/A') AS "ProductName", coalesce("Discount", 0) AS "Discount")
  FROM sales_flat)"""
_NET = """CAST("UnitsSold" AS DECIMAL(12,2)) * CAST("UnitPrice" AS DECIMAL(12,2))
          * CAST(1 - CAST("Discount" AS DECIMAL(5,2)) * 0.01 AS DECIMAL(7,4))"""


@query(
    "fact_lookup_keys",
    over_sales(
        f"""SELECT c."OrderKey", c."LineNumber", c."UnitsSold", c."UnitPrice", c."Discount",
                   coalesce(p.k, -1) AS "ProductKey", coalesce(t.k, -1) AS "StoreKey", coalesce(e.k, -1) AS "EmployeeKey",
                   CAST({_NET} AS DOUBLE) AS "NetRevenue"
            FROM cleaned c LEFT JOIN products p USING ("ProductName", "ProductCategory", "ProductSubCategory")
            LEFT JOIN stores t USING ("Region", "StoreName", "StoreType")
            LEFT JOIN reps e USING ("SalesRep", "RepNation")""",
        _keyed(star.PRODUCT, "products"), _keyed(star.STORE, "stores"), _keyed(star.EMPLOYEE, "reps"), _CLEAN,
    ),
)
def lookup_keys(spark, sf):
    fact, _ = star.revenue_star(spark, sf, star.PRODUCT, star.STORE, star.EMPLOYEE)
    return fact.withColumn("NetRevenue", F.col("NetRevenue").cast("double"))


@query(
    "fact_custom_mapping",
    over_sales(
        """SELECT s."OrderKey", s."LineNumber", s."Revenue", coalesce(f."CustomMappingKey", -1) AS "CustomMappingKey"
           FROM sales_flat s LEFT JOIN focus f USING ("ProductCategory", "CustomerSegment", "Region")""",
        _FOCUS,
    ),
)
def apply_mapping(spark, sf):
    fact = sales(spark, sf, ["OrderKey", "LineNumber", "Revenue", *star.MAPPED])
    return facts.key_by_lookup(fact, [star.focus_lookup(spark, sf)])


@query(
    "fact_clean",
    over_sales('SELECT "OrderKey", "LineNumber", "ProductName", "UnitsSold", "UnitPrice", "Discount" FROM cleaned', _CLEAN),
)
def fact_clean(spark, sf):
    return star.clean_sales(spark, sf, ["OrderKey", "LineNumber", "ProductName", "UnitsSold", "UnitPrice", "Discount"])


@query(
    "fact_clean_counts",
    over_sales(
        """SELECT 'FillNull(UnitsSold)' AS rule, count(*) - count("UnitsSold") AS touched_rows FROM sales_flat
           UNION ALL SELECT 'FillNull(UnitPrice)', count(*) - count("UnitPrice") FROM sales_flat
           UNION ALL SELECT 'FillNull(ProductName)', count(*) - count("ProductName") FROM sales_flat
           UNION ALL SELECT 'FillNull(Discount)', count(*) - count("Discount") FROM sales_flat
           UNION ALL SELECT 'RaiseTo(UnitPrice)', count(*) FROM sales_flat WHERE "UnitPrice" < 0"""
    ),
)
def fact_clean_counts(spark, sf):
    return facts.rule_counts(sales(spark, sf, ["UnitsSold", "UnitPrice", "ProductName", "Discount"]), star.CLEANING)


@query("fact_measures", over_sales(f'SELECT "OrderKey", "LineNumber", CAST({_NET} AS DOUBLE) AS "NetRevenue" FROM cleaned', _CLEAN))
def measures(spark, sf):
    extract = star.clean_sales(spark, sf, ["OrderKey", "LineNumber", "UnitsSold", "UnitPrice", "Discount"])
    net = facts.net_revenue("UnitsSold", "UnitPrice", "Discount").cast("double")
    return extract.select("OrderKey", "LineNumber", net.alias("NetRevenue"))


@query(
    "fact_measures_any_double",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) * (l_extendedprice / 7) * (1.0 - (l_discount * 100) / 100.0) AS "NetRevenue" FROM lineitem""",
)
def measures_any_double(spark, sf):
    """Net revenue of prices that no decimal holds."""
    price, percent = F.col("l_extendedprice") / 7, F.col("l_discount") * 100
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", price.alias("price"), percent.alias("percent"))
    return lines.select("l_orderkey", "l_linenumber", facts.net_revenue_of_doubles("l_quantity", "price", "percent").alias("NetRevenue"))


# --- checks --------------------------------------------------------------------------------------


_UNKNOWN = {
    "ProductKey": '"ProductName" IS NULL OR "ProductCategory" IS NULL OR "ProductSubCategory" IS NULL',
    "StoreKey": '"Region" IS NULL OR "StoreName" IS NULL OR "StoreType" IS NULL',
    "EmployeeKey": '"SalesRep" IS NULL OR "RepNation" IS NULL',
}
_SOURCES = {spec.key: [spec.source] for spec in star.ATTRIBUTES} | {"SalesDateKey": ["SalesDate"]}
_SOURCES |= {spec.key: list(spec.columns) for spec in star.COMPOSITES}
_NO_MEMBER = {key: " OR ".join(f'"{c}" IS NULL' for c in columns) for key, columns in _SOURCES.items()}


def _member_text(key: str) -> str:
    return "upper(concat_ws('|', " + ", ".join(f'CAST("{c}" AS VARCHAR)' for c in _SOURCES[key]) + "))"


def _members_sql(key: str) -> str:
    """The members of a dimension as texts, with the unknown one, made from the extract."""
    return f"SELECT DISTINCT {_member_text(key)} AS m FROM sales_flat WHERE NOT ({_NO_MEMBER[key]}) UNION ALL SELECT 'N/A'"


def _referential_sql(keys) -> str:
    """Each fact's member, as a text, against the members of its dimension."""
    return over_sales(
        " UNION ALL ".join(
            f"""SELECT '{key}' AS key_column, count(*) AS fact_rows, count(*) FILTER (m IS NULL) AS unmatched_rows, count(*) FILTER (m IS NULL) = 0 AS passed
                FROM (SELECT CASE WHEN {_NO_MEMBER[key]} THEN 'N/A' ELSE {_member_text(key)} END AS k FROM sales_flat) f
                LEFT JOIN ({_members_sql(key)}) d ON f.k = d.m"""
            for key in keys
        )
    )


def _hash_star(spark, sf):
    extract = star.staged_sales(spark, sf, star.ALL_ATTRIBUTES)
    built = star.all_dims(extract)
    sides = {spec.key: (built[spec.key], spec.key) for spec in star.ATTRIBUTES}
    sides["SalesDateKey"] = (built["DateKey"], "DateKey")
    return facts.key_by_hash(extract, star.ATTRIBUTES, star.DATES), sides


_KEYS = [spec.key for spec in star.ATTRIBUTES] + ["SalesDateKey"]


@query("chk_referential", _referential_sql(_KEYS))
def referential(spark, sf):
    fact, sides = _hash_star(spark, sf)
    return checks.referential(fact, sides)


@query(
    "chk_referential_fail",
    over_sales("""SELECT CAST(99999 AS BIGINT) AS "StoreTypeKey", "Revenue" FROM sales_flat WHERE "LineNumber" = 7 AND "StoreType" = 'R'"""),
)
def referential_fail(spark, sf):
    """Facts that are given a key that no dimension holds: exactly those rows come back."""
    extract = star.staged_sales(spark, sf, [star.STORE_TYPE.source, "LineNumber", "Revenue"])
    stray = (F.col("LineNumber") == 7) & (F.col("StoreType") == "R")
    fact = facts.key_by_hash(extract.withColumn("_stray", stray), [star.STORE_TYPE])
    spoiled = fact.withColumn("StoreTypeKey", F.when(F.col("_stray"), F.lit(99999).cast("bigint")).otherwise(F.col("StoreTypeKey")))
    found = checks.unmatched(spoiled, dims.attribute_dimension(extract, star.STORE_TYPE), "StoreTypeKey")
    return found.select("StoreTypeKey", "Revenue")


@query(
    "chk_referential_partial",
    over_sales(
        """SELECT 'RegionKey' AS key_column, count(*) AS fact_rows, CAST(0 AS BIGINT) AS unmatched_rows, true AS passed FROM sales_flat
           UNION ALL SELECT 'StoreTypeKey', count(*), CAST(sum(CASE WHEN "StoreType" = 'R' THEN 1 ELSE 0 END) AS BIGINT),
                            sum(CASE WHEN "StoreType" = 'R' THEN 1 ELSE 0 END) = 0 FROM sales_flat"""
    ),
)
def referential_partial(spark, sf):
    """A store type dimension that was built without one of the types."""
    extract = star.staged_sales(spark, sf, [star.REGION.source, star.STORE_TYPE.source])
    fact = facts.key_by_hash(extract, [star.REGION, star.STORE_TYPE])
    types = dims.attribute_dimension(extract.where("StoreType <> 'R'"), star.STORE_TYPE)
    regions = dims.attribute_dimension(extract, star.REGION)
    return checks.referential(fact, {"RegionKey": (regions, "RegionKey"), "StoreTypeKey": (types, "StoreTypeKey")})


LOOKUP_SPECS = (star.PRODUCT, star.STORE, star.EMPLOYEE)
LOOKUP_KEYS = [spec.key for spec in LOOKUP_SPECS]


def _revenue_star(spark, sf):
    fact, _ = star.revenue_star(spark, sf, *LOOKUP_SPECS)
    return fact


@query("chk_referential_lookup", _referential_sql(LOOKUP_KEYS))
def referential_lookup(spark, sf):
    """All three keys of the looked-up star."""
    fact, built = star.revenue_star(spark, sf, *LOOKUP_SPECS)
    return checks.referential(fact, {key: (built[key], key) for key in LOOKUP_KEYS})


@query(
    "chk_row_count",
    over_sales(
        """SELECT (SELECT count(*) FROM lineitem) AS source_rows, count(*) AS fact_rows,
                  (SELECT count(*) FROM lineitem) = count(*) AS passed FROM sales_flat"""
    ),
)
def row_count(spark, sf):
    return checks.row_count(table(spark, sf, "lineitem"), _revenue_star(spark, sf))


@query(
    "chk_row_count_fail",
    """SELECT count(*) AS source_rows, count(*) FILTER (l_linenumber <> 7) AS fact_rows,
              count(*) = count(*) FILTER (l_linenumber <> 7) AS passed FROM lineitem""",
)
def row_count_fail(spark, sf):
    """A fact without the lines of one number."""
    lines = table(spark, sf, "lineitem")
    return checks.row_count(lines, lines.where("l_linenumber <> 7"))


@query(
    "chk_measure_sum_fail",
    """SELECT 'l_extendedprice' AS measure, CAST(a AS DOUBLE) AS source_total, CAST(b AS DOUBLE) AS fact_total, a = b AS passed
       FROM (SELECT sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS a,
                    sum(CAST(l_extendedprice AS DECIMAL(18,4)) + CASE WHEN l_orderkey = 1 AND l_linenumber = 1 THEN 0.0001 ELSE 0 END) AS b
             FROM lineitem)""",
)
def measure_sum_fail(spark, sf):
    """A fact that is off by a hundredth of a cent in one row."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    price = exact(F.col("l_extendedprice"), DoubleType(), 4)
    off = F.when((F.col("l_orderkey") == 1) & (F.col("l_linenumber") == 1), F.lit("0.0001")).otherwise(F.lit("0"))
    fact = lines.withColumn("l_extendedprice", (price + off.cast("decimal(5,4)")).cast("double"))
    return checks.measure_sum(lines, fact, {"l_extendedprice": "l_extendedprice"}, scales={"l_extendedprice": 4})


@query(
    "chk_measure_sum",
    over_sales(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS measure, CAST(a AS DOUBLE) AS source_total, CAST(b AS DOUBLE) AS fact_total, a = b AS passed
                FROM (SELECT sum(CAST("{c}" AS DECIMAL(18,2))) AS a FROM sales_flat),
                     (SELECT sum(CAST(s."{c}" AS DECIMAL(18,2))) AS b
                      FROM sales_flat s LEFT JOIN focus f USING ("ProductCategory", "CustomerSegment", "Region"))"""
            for c in ("Revenue", "UnitsSold")
        ),
        _FOCUS,
    ),
)
def measure_sum(spark, sf):
    extract = sales(spark, sf, ["UnitsSold", "Revenue"])
    fact = sales(spark, sf, ["UnitsSold", "Revenue", *star.MAPPED])
    mapped = facts.key_by_lookup(fact, [star.focus_lookup(spark, sf)])
    return checks.measure_sum(
        extract, mapped, {"UnitsSold": "UnitsSold", "Revenue": "Revenue"}, scales={"UnitsSold": 2, "Revenue": 2}
    )


@query(
    "chk_mapping_unique_fail",
    """SELECT count(*) AS combinations, count(*) FILTER (n > 1) AS duplicated, count(*) FILTER (n > 1) = 0 AS passed
       FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2)""",
)
def mapping_unique_fail(spark, sf):
    """Combinations that line items repeat."""
    return checks.mapping_unique(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"])


@query(
    "chk_key_collision_fail",
    """SELECT 'size' AS dimension, count(*) AS keys, count(*) FILTER (n > 1) AS collisions, count(*) FILTER (n > 1) = 0 AS passed
       FROM (SELECT p_size, count(DISTINCT upper(p_brand)) AS n FROM part GROUP BY p_size)""",
)
def key_collision_fail(spark, sf):
    """A key that several brands share."""
    return checks.key_collision({"size": (table(spark, sf, "part"), "p_size", ["p_brand"])})


_STORE_HASH = CompositeDim("StoreKey", star.STORE.columns)


@query(
    "dim_composite_hash",
    over_sales(
        """SELECT min("Region") AS "Region", min("StoreName") AS "Name", min("StoreType") AS "Type", false AS is_unknown FROM sales_flat
           WHERE "Region" IS NOT NULL AND "StoreName" IS NOT NULL AND "StoreType" IS NOT NULL
           GROUP BY upper("Region"), upper("StoreName"), upper("StoreType") UNION ALL SELECT 'N/A', 'N/A', 'N/A', true"""
    ),
)
def composite_hash(spark, sf):
    built = dims.composite_dimension(star.sales_values(spark, sf, list(_STORE_HASH.columns)), _STORE_HASH, "xxhash64")
    return built.select("Region", "Name", "Type", (F.col("StoreKey") == UNKNOWN_KEY).alias("is_unknown"))


@query(
    "fact_composite_hash",
    over_sales(
        """SELECT "OrderKey", "LineNumber", CASE WHEN "Region" IS NULL THEN 'N/A' ELSE "StoreName" END AS "Store" FROM sales_flat"""
    ),
)
def fact_composite_hash(spark, sf):
    """Facts keyed by the hash of three columns, some in another spelling, resolved to names again."""
    extract = star.staged_sales(spark, sf, ["OrderKey", "LineNumber", *_STORE_HASH.columns])
    built = dims.composite_dimension(extract, _STORE_HASH, "xxhash64")
    shouted = extract.withColumn("Region", F.when(F.col("LineNumber") % 2 == 0, F.lower("Region")).otherwise(F.col("Region")))
    fact = facts.key_by_hash(shouted, [_STORE_HASH])
    return reports.detail(fact, {"Store": Attribute(built, "StoreKey", "Name")}, ["OrderKey", "LineNumber"])


_MEASURES = ["SalesDate", "UnitsSold", "UnitPrice", "Discount"]


def _bag_sql(source: str) -> str:
    names = ", ".join(f'"{c}"' for c in _MEASURES)
    return over_sales(
        f"""SELECT {names}, CAST(greatest(sum(s), 0) AS BIGINT) AS missing_in_fact, CAST(greatest(-sum(s), 0) AS BIGINT) AS extra_in_fact
            FROM (SELECT {names}, 1 AS s FROM {source} UNION ALL SELECT {names}, -1 FROM cleaned)
            GROUP BY {names} HAVING sum(s) <> 0""",
        _CLEAN,
    )


@query("chk_bag_diff", _bag_sql("cleaned"))
def bag_diff(spark, sf):
    """Dates and measures of the keyed fact against the cleaned extract: no difference."""
    fact, _ = star.revenue_star(spark, sf, *LOOKUP_SPECS, keep=["SalesDate"])
    return checks.bag_difference(star.clean_sales(spark, sf, _MEASURES), fact, _MEASURES)


@query("chk_range_diff", _bag_sql("sales_flat"))
def range_diff(spark, sf):
    """As chk_bag_diff_raw, by fingerprints of ranges."""
    extract = sales(spark, sf, ["OrderKey", *_MEASURES])
    return checks.range_difference(extract, star.clean_sales(spark, sf, ["OrderKey", *_MEASURES]), _MEASURES, ["SalesDate"], ranges=512)


@query("chk_range_diff_equal", _bag_sql("cleaned"))
def range_diff_equal(spark, sf):
    """The saved fact against the cleaned extract, every line in its place: only fingerprints move."""
    saved = star.saved_star(spark, sf).facts
    days = star.saved_star(spark, sf).dims["SalesDateKey"][0].select(F.col("DateKey").alias("SalesDateKey"), F.col("Date").alias("SalesDate"))
    dated = saved.join(F.broadcast(days), "SalesDateKey")
    return checks.range_difference(star.clean_sales(spark, sf, _MEASURES), dated.select(*_MEASURES), _MEASURES, ["SalesDate"])


@query("chk_referential_bitmap", _referential_sql(LOOKUP_KEYS))
def referential_bitmap(spark, sf):
    """The dense keys of the saved star by bitmaps of keys."""
    saved = star.saved_star(spark, sf)
    return checks.referential_by_bitmaps(saved.facts, {key: saved.dims[key] for key in LOOKUP_KEYS})


@query(
    "chk_referential_bitmap_fail",
    """SELECT 'l_suppkey' AS key_column, count(*) AS fact_rows, count(*) FILTER (s_suppkey IS NULL) AS unmatched_rows,
              count(*) FILTER (s_suppkey IS NULL) = 0 AS passed
       FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) ON l_suppkey = s_suppkey
       UNION ALL SELECT 'l_partkey', count(*), count(*) FILTER (p_partkey IS NULL), count(*) FILTER (p_partkey IS NULL) = 0
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def referential_bitmap_fail(spark, sf):
    """Suppliers in debt are missing from one of two dimensions."""
    suppliers = table(spark, sf, "supplier").where("s_acctbal >= 0")
    sides = {"l_suppkey": (suppliers, "s_suppkey"), "l_partkey": (table(spark, sf, "part"), "p_partkey")}
    return checks.referential_by_bitmaps(table(spark, sf, "lineitem"), sides)


@query("chk_bag_diff_raw", _bag_sql("sales_flat"))
def bag_diff_raw(spark, sf):
    """Against the raw extract: what cleaning changed, in both directions."""
    return checks.bag_difference(sales(spark, sf, _MEASURES), star.clean_sales(spark, sf, _MEASURES), _MEASURES)


@query(
    "chk_null_keys",
    over_sales(
        " UNION ALL ".join(
            f"""SELECT '{spec.key}' AS key_column, count(*) - count(k) AS null_rows, count(*) = count(k) AS passed
                FROM (SELECT coalesce(d.k, -1) AS k FROM cleaned LEFT JOIN {name} d USING ({", ".join(f'"{c}"' for c in spec.columns)}))"""
            for spec, name in ((star.PRODUCT, "products"), (star.STORE, "stores"), (star.EMPLOYEE, "reps"))
        ),
        _keyed(star.PRODUCT, "products"), _keyed(star.STORE, "stores"), _keyed(star.EMPLOYEE, "reps"), _CLEAN,
    ),
)
def null_keys(spark, sf):
    return checks.null_keys(_revenue_star(spark, sf), LOOKUP_KEYS)


@query(
    "chk_null_keys_raw",
    over_sales(
        """SELECT 'Region' AS key_column, count(*) - count("Region") AS null_rows, count(*) = count("Region") AS passed FROM sales_flat
           UNION ALL SELECT 'SalesDate', count(*) - count("SalesDate"), count(*) = count("SalesDate") FROM sales_flat
           UNION ALL SELECT 'SalesRep', count(*) - count("SalesRep"), count(*) = count("SalesRep") FROM sales_flat"""
    ),
)
def null_keys_raw(spark, sf):
    """The natural keys of the raw extract, of which two hold nulls."""
    columns = ["Region", "SalesDate", "SalesRep"]
    return checks.null_keys(sales(spark, sf, columns), columns)


@query(
    "chk_unknown_keys",
    over_sales(
        " UNION ALL ".join(
            f"SELECT '{key}' AS key_column, count(*) AS unknown_rows FROM cleaned WHERE {missing}"
            if key != "ProductKey"
            else f"""SELECT '{key}' AS key_column, count(*) AS unknown_rows FROM cleaned WHERE "ProductName" = 'N/A' """
            for key, missing in _UNKNOWN.items()
        ),
        _CLEAN,
    ),
)
def unknown_keys(spark, sf):
    return checks.unknown_keys(_revenue_star(spark, sf), LOOKUP_KEYS)


def _price_rules():
    return {"negative": F.col("UnitPrice") < 0, "missing": F.col("UnitPrice").isNull()}


def _range_sql(source: str) -> str:
    return over_sales(
        f"""SELECT 'negative' AS rule, count(*) AS bad_rows, count(*) = 0 AS passed FROM {source} WHERE "UnitPrice" < 0
            UNION ALL SELECT 'missing', count(*), count(*) = 0 FROM {source} WHERE "UnitPrice" IS NULL""",
        _CLEAN,
    )


@query("chk_measure_range", _range_sql("cleaned"))
def measure_range(spark, sf):
    return checks.measure_range(star.clean_sales(spark, sf, ["UnitPrice"]), _price_rules())


@query("chk_measure_range_raw", _range_sql("sales_flat"))
def measure_range_raw(spark, sf):
    return checks.measure_range(sales(spark, sf, ["UnitPrice"]), _price_rules())


@query(
    "chk_mapping_unique",
    over_sales(
        """SELECT count(*) AS combinations, count(*) FILTER (n > 1) AS duplicated, count(*) FILTER (n > 1) = 0 AS passed
           FROM (SELECT count(*) AS n FROM focus GROUP BY "ProductCategory", "CustomerSegment", "Region")""",
        _FOCUS,
    ),
)
def mapping_unique(spark, sf):
    return checks.mapping_unique(star.focus_mapping(spark, sf), star.MAPPED)


@query(
    "chk_mapping_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def mapping_duplicates(spark, sf):
    return checks.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "chk_key_collision",
    over_sales(
        " UNION ALL ".join(
            f"""SELECT '{spec.key}' AS dimension, count(*) AS keys, count(*) FILTER (n > 1) AS collisions, count(*) FILTER (n > 1) = 0 AS passed
                FROM (SELECT CASE WHEN m = 'N/A' THEN -1 ELSE CAST(hash(m) AS HUGEINT) END AS k, count(DISTINCT m) AS n
                      FROM ({_members_sql(spec.key)}) GROUP BY 1)"""
            for spec in star.ATTRIBUTES
        )
    ),
)
def key_collision(spark, sf):
    built = star.all_dims(sales(spark, sf, star.ALL_ATTRIBUTES))
    return checks.key_collision({spec.key: (built[spec.key], spec.key, [spec.target]) for spec in star.ATTRIBUTES})


# --- reports -------------------------------------------------------------------------------------

_TOTALS = {"TotalUnitSold": "UnitsSold", "TotalRevenue": "Revenue"}
_SCALES = {"TotalUnitSold": 2, "TotalRevenue": 2}
_SUMS = """CAST(sum(CAST("UnitsSold" AS DECIMAL(18,2))) AS DOUBLE) AS "TotalUnitSold",
           CAST(sum(CAST("Revenue" AS DECIMAL(18,2))) AS DOUBLE) AS "TotalRevenue" """
_NET_SUMS = f"""CAST(sum(CAST("UnitsSold" AS DECIMAL(18,2))) AS DOUBLE) AS "TotalUnitSold",
                CAST(sum({_NET}) AS DOUBLE) AS "TotalRevenue" """


def _report_star(spark, sf, *specs, with_date=False):
    """Fact and dimensions of one report, from one reading of the tables."""
    dates = star.DATES if with_date else {}
    extract = star.staged_sales(spark, sf, [*[spec.source for spec in specs], *dates, "UnitsSold", "Revenue"])
    return facts.key_by_hash(extract, specs, dates), dims.star_dimensions(extract, specs, *dates)


@query(
    "rpt_by_rep",
    over_sales(f"""SELECT coalesce("SalesRep", 'N/A') AS "Name", {_SUMS} FROM sales_flat GROUP BY 1"""),
)
def by_rep(spark, sf):
    fact, built = _report_star(spark, sf, star.REP)
    return reports.totals(fact, {"Name": Attribute(built[star.REP.key], star.REP.key, "Name")}, _TOTALS, scales=_SCALES)


@query(
    "rpt_by_region",
    over_sales(f"""SELECT coalesce("Region", 'N/A') AS "StoreRegion", {_NET_SUMS} FROM cleaned GROUP BY 1""", _CLEAN),
)
def by_region(spark, sf):
    fact, built = star.revenue_star(spark, sf, star.STORE)
    net = {"TotalUnitSold": "UnitsSold", "TotalRevenue": "NetRevenue"}
    return reports.totals(fact, {"StoreRegion": Attribute(built["StoreKey"], "StoreKey", "Region")}, net)


@query(
    "rpt_by_employee",
    over_sales(f"""SELECT coalesce("SalesRep", 'N/A') AS "SalesRep", {_NET_SUMS} FROM cleaned GROUP BY 1""", _CLEAN),
)
def by_employee(spark, sf):
    fact, built = star.revenue_star(spark, sf, star.EMPLOYEE)
    net = {"TotalUnitSold": "UnitsSold", "TotalRevenue": "NetRevenue"}
    return reports.totals(fact, {"SalesRep": Attribute(built["EmployeeKey"], "EmployeeKey", "SalesRep")}, net)


@query(
    "rpt_store_type_year",
    over_sales(
        f"""SELECT coalesce("StoreType", 'N/A') AS "StoreType", CAST(year("SalesDate") AS INTEGER) AS "Year", {_SUMS}
            FROM sales_flat GROUP BY 1, 2"""
    ),
)
def store_type_year(spark, sf):
    fact, built = _report_star(spark, sf, star.STORE_TYPE, with_date=True)
    by = {
        "StoreType": Attribute(built[star.STORE_TYPE.key], star.STORE_TYPE.key, "Name"),
        "Year": Attribute(built["DateKey"], "SalesDateKey", "Year", "DateKey"),
    }
    return reports.totals(fact, by, _TOTALS, scales=_SCALES)


@query(
    "rpt_channel_subcat",
    over_sales(
        f"""SELECT "SalesChannel", "ProductSubCategory" AS "SubCategory", {_SUMS} FROM sales_flat
            WHERE "ProductSubCategory" IN ('Brand#1', 'Brand#2') GROUP BY 1, 2"""
    ),
)
def channel_subcategory(spark, sf):
    fact, built = _report_star(spark, sf, star.CHANNEL, star.SUBCATEGORY)
    by = {
        "SalesChannel": Attribute(built[star.CHANNEL.key], star.CHANNEL.key, "Name"),
        "SubCategory": Attribute(built[star.SUBCATEGORY.key], star.SUBCATEGORY.key, "Title"),
    }
    chosen = (F.col("SubCategory") == "Brand#1") | (F.col("SubCategory") == "Brand#2")
    return reports.totals(fact, by, _TOTALS, chosen, _SCALES)


@query(
    "rpt_detail_all_dims",
    over_sales(f'SELECT {_DETAIL}, "SalesDate" AS "Date", "UnitsSold", "Revenue" FROM sales_flat'),
)
def detail_all_dims(spark, sf):
    return _detail(spark, sf, ["UnitsSold", "Revenue"])


# --- checks and reports over the saved star ------------------------------------------------------


@query(
    "rpt_saved_by_rep",
    over_sales(f"""SELECT coalesce("SalesRep", 'N/A') AS "Name", {_SUMS} FROM sales_flat GROUP BY 1"""),
)
def saved_by_rep(spark, sf):
    saved, sold = star.saved_star(spark, sf), {"TotalUnitSold": "SoldUnits", "TotalRevenue": "Revenue"}
    return saved.totals({"Name": (star.REP.key, "Name")}, sold, scales=_SCALES)


@query(
    "rpt_saved_by_region",
    over_sales(
        f"""SELECT CASE WHEN "Region" IS NULL OR "StoreName" IS NULL OR "StoreType" IS NULL THEN 'N/A' ELSE "Region" END AS "StoreRegion", {_NET_SUMS}
            FROM cleaned GROUP BY 1""",
        _CLEAN,
    ),
)
def saved_by_region(spark, sf):
    net = {"TotalUnitSold": "UnitsSold", "TotalRevenue": "NetRevenue"}
    return star.saved_star(spark, sf).totals({"StoreRegion": ("StoreKey", "Region")}, net, scales={"TotalUnitSold": 2})


@query(
    "rpt_saved_by_employee",
    over_sales(
        f"""SELECT coalesce("SalesRep", 'N/A') AS "SalesRep", CASE WHEN "Region" IS NULL THEN 'N/A' ELSE "StoreName" END AS "Store",
                   CASE WHEN "Region" IS NULL THEN 'N/A' ELSE "Region" END AS "StoreRegion", {_NET_SUMS}
            FROM cleaned GROUP BY 1, 2, 3""",
        _CLEAN,
    ),
)
def saved_by_employee(spark, sf):
    """What each employee sold in each store: two looked-up dimensions of one fact."""
    net = {"TotalUnitSold": "UnitsSold", "TotalRevenue": "NetRevenue"}
    by = {"SalesRep": ("EmployeeKey", "SalesRep"), "Store": ("StoreKey", "Name"), "StoreRegion": ("StoreKey", "Region")}
    return star.saved_star(spark, sf).totals(by, net, scales={"TotalUnitSold": 2})


@query(
    "rpt_saved_store_type_year",
    over_sales(
        f"""SELECT coalesce("StoreType", 'N/A') AS "StoreType", CAST(year("SalesDate") AS INTEGER) AS "Year", {_SUMS}
            FROM sales_flat GROUP BY 1, 2"""
    ),
)
def saved_store_type_year(spark, sf):
    saved, sold = star.saved_star(spark, sf), {"TotalUnitSold": "SoldUnits", "TotalRevenue": "Revenue"}
    return saved.totals({"StoreType": (star.STORE_TYPE.key, "Name"), "Year": ("SalesDateKey", "Year")}, sold, scales=_SCALES)


@query(
    "rpt_saved_channel_subcat",
    over_sales(
        f"""SELECT "SalesChannel", "ProductSubCategory" AS "SubCategory", {_SUMS} FROM sales_flat
            WHERE "ProductSubCategory" IN ('Brand#1', 'Brand#2') GROUP BY 1, 2"""
    ),
)
def saved_channel_subcategory(spark, sf):
    """Relations by name: the fact and two dimensions under aliases, with every column qualified."""
    saved = star.saved_star(spark, sf)
    channels, kinds = saved.dims[star.CHANNEL.key][0].alias("channel"), saved.dims[star.SUBCATEGORY.key][0].alias("kind")
    amounts = [exact(F.col(f"sale.{c}"), DoubleType(), 2).alias(out) for c, out in (("SoldUnits", "units"), ("Revenue", "revenue"))]
    sale = saved.facts.alias("sale")
    return (
        sale.join(channels, F.col("sale.SalesChannelKey") == F.col("channel.SalesChannelKey"))
        .join(kinds, F.col("sale.SubCategoryKey") == F.col("kind.SubCategoryKey"))
        .where((F.col("kind.Title") == "Brand#1") | (F.col("kind.Title") == "Brand#2"))
        .select(F.col("channel.Name").alias("SalesChannel"), F.col("kind.Title").alias("SubCategory"), *amounts)
        .groupBy("SalesChannel", "SubCategory")
        .agg(F.sum("units").cast("double").alias("TotalUnitSold"), F.sum("revenue").cast("double").alias("TotalRevenue"))
    )


@query(
    "rpt_saved_detail",
    over_sales(
        f"""SELECT "OrderKey", "LineNumber", {_DETAIL}, "SalesDate" AS "Date",
                   CASE WHEN "ProductName" IS NULL THEN 'N/A' ELSE "ProductName" END AS "Product",
                   "UnitsSold" AS "SoldUnits", "Revenue" FROM sales_flat"""
    ),
)
def saved_detail(spark, sf):
    by = {out: (spec.key, spec.target) for out, spec in _NAMES.items()}
    by |= {"Date": ("SalesDateKey", "Date"), "Product": ("ProductKey", "Title")}
    return star.saved_star(spark, sf).detail(by, ["OrderKey", "LineNumber", "SoldUnits", "Revenue"])


@query(
    "chk_saved_profile",
    over_sales(
        """SELECT 'rows' AS "check", 'fact' AS subject, count(*) AS counted, true AS passed FROM lineitem"""
        + "".join(
            f""" UNION ALL SELECT 'unknown key', '{key}', count(*), true FROM sales_flat WHERE {missing}
                 UNION ALL SELECT 'null key', '{key}', count(*) - count(CASE WHEN {missing} THEN -1 ELSE 1 END),
                                  count(*) = count(CASE WHEN {missing} THEN -1 ELSE 1 END) FROM sales_flat"""
            for key, missing in _NO_MEMBER.items()
        )
        + """ UNION ALL SELECT 'rule', 'negative', count(*), count(*) = 0 FROM cleaned WHERE "UnitPrice" < 0
              UNION ALL SELECT 'rule', 'no units', count(*), count(*) = 0 FROM cleaned WHERE "UnitsSold" = 0""",
        _CLEAN,
    ),
)
def saved_profile(spark, sf):
    """Counts of rows, null keys, unknown keys and broken rules from one pass over the saved fact."""
    rules = {"negative": F.col("UnitPrice") < 0, "no units": F.col("UnitsSold") == 0}
    return star.saved_star(spark, sf).profile(rules)


@query("chk_saved_referential", _referential_sql(list(_NO_MEMBER)))
def saved_referential(spark, sf):
    """Every key of the saved fact against its dimension; the SQL builds members and keys from the extract and joins them."""
    return star.saved_star(spark, sf).referential()
