"""The star schema over the flat sales extract: specs and the steps that build it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from starkit.functions import exact
from starkit.operators import dims, facts
from starkit.operators.dims import AttributeDim, CompositeDim
from starkit.operators.facts import FillNull, Lookup, RaiseTo
from starkit.operators.saved import SavedStar, save_star
from starkit.operators.windows import top_n
from starkit.plans.flat import sales, sales_values, table
from starkit.session import fresh_path, stage, staging
from starkit.sources.versions import VersionedTables

REGION = AttributeDim("Region", "Region", "RegionKey")
CATEGORY = AttributeDim("ProductCategory", "Title", "CategoryKey")
SUBCATEGORY = AttributeDim("ProductSubCategory", "Title", "SubCategoryKey")
CHANNEL = AttributeDim("SalesChannel", "Name", "SalesChannelKey")
SEGMENT = AttributeDim("CustomerSegment", "Segment", "CustomerSegmentKey")
REP = AttributeDim("SalesRep", "Name", "SalesRepKey")
STORE_TYPE = AttributeDim("StoreType", "Name", "StoreTypeKey")
ATTRIBUTES = (REGION, CATEGORY, SUBCATEGORY, CHANNEL, SEGMENT, REP, STORE_TYPE)
DATES = {"SalesDate": "SalesDateKey"}

PRODUCT = CompositeDim("ProductKey", {"ProductName": "Title", "ProductCategory": "Category", "ProductSubCategory": "Brand"})
STORE = CompositeDim("StoreKey", {"Region": "Region", "StoreName": "Name", "StoreType": "Type"})
EMPLOYEE = CompositeDim("EmployeeKey", {"SalesRep": "SalesRep", "RepNation": "Nation"})

MAPPED = ("ProductCategory", "CustomerSegment", "Region")

CLEANING = (
    FillNull("UnitsSold", 0),
    FillNull("UnitPrice", 0),
    FillNull("ProductName", "N/A"),
    FillNull("Discount", 0),
    RaiseTo("UnitPrice", 0),
)


def attribute_dim(spark: SparkSession, sf: str, spec: AttributeDim) -> DataFrame:
    return dims.attribute_dimension(sales_values(spark, sf, [spec.source]), spec)


def staged_sales(spark: SparkSession, sf: str, columns) -> DataFrame:
    """The extract written once, for queries that build several dimensions and a fact from it:
    its joins run once, and each later step reads only the columns it needs."""
    return stage(sales(spark, sf, columns), "sales")


def all_dims(extract: DataFrame) -> dict[str, DataFrame]:
    """The seven attribute dimensions and the calendar, by key name, from one pass over the extract."""
    return dims.star_dimensions(extract, ATTRIBUTES, *DATES)


ALL_ATTRIBUTES = [*[spec.source for spec in ATTRIBUTES], *DATES]


def date_dim(spark: SparkSession, sf: str) -> DataFrame:
    return dims.date_dimension(sales(spark, sf, ["SalesDate"]), "SalesDate")


def composite_dim(spark: SparkSession, sf: str, spec: CompositeDim) -> DataFrame:
    return dims.composite_dimension(sales_values(spark, sf, list(spec.columns)), spec)


def clean_sales(spark: SparkSession, sf: str, columns) -> DataFrame:
    """Cleaned extract; rules on columns that were not asked for are left out."""
    return facts.clean(sales(spark, sf, columns), [rule for rule in CLEANING if rule.column in columns])


def revenue_star(
    spark: SparkSession, sf: str, *specs: CompositeDim, keep: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Cleaned facts with net revenue, keyed by lookup in the dimensions of ``specs``; dimensions by key name.

    For one dimension the extract is read twice, once reduced to the members; for more it is written first.
    """
    attributes = [c for spec in specs for c in spec.columns]
    measures = ["UnitsSold", "UnitPrice", "Discount"]
    columns = ["OrderKey", "LineNumber", *keep, *measures, *attributes]
    if len(specs) == 1:
        extract = sales(spark, sf, columns)
        built = {specs[0].key: composite_dim(spark, sf, specs[0])}
    else:
        extract = staged_sales(spark, sf, columns)
        built = {spec.key: dims.composite_dimension(extract, spec) for spec in specs}
    cleaned = facts.clean(extract, [rule for rule in CLEANING if rule.column in extract.columns])
    measured = cleaned.withColumn("NetRevenue", facts.net_revenue(*measures))
    lookups = [facts.composite_lookup(spec, built[spec.key]) for spec in specs]
    return facts.key_by_lookup(measured, lookups, check_unique=False), built


def focus_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """A label for the two strongest segments of each category and region."""
    revenue = (
        sales(spark, sf, [*MAPPED, "Revenue"])
        .dropna(subset=list(MAPPED))
        .groupBy(*MAPPED)
        .agg(F.sum(exact(F.col("Revenue"), DoubleType(), 2)).alias("revenue"))
    )
    strongest = top_n(
        revenue, ["ProductCategory", "Region"], [F.col("revenue").desc(), F.col("CustomerSegment")], 2
    )
    label = F.concat_ws(" / ", "Region", "ProductCategory", "CustomerSegment")
    return stage(strongest.select(*MAPPED, label.alias("MappingLabel")), "focus-mapping")


def focus_dim(spark: SparkSession, sf: str) -> DataFrame:
    return dims.custom_mapping_dimension(focus_mapping(spark, sf), list(MAPPED), "CustomMappingKey")


def source_lookups(spark: SparkSession, sf: str) -> list[Lookup]:
    """Dimensions from source tables, each with its own id replaced by a dense key."""
    regions = table(spark, sf, "region").withColumnRenamed("r_name", "Region")
    stores = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("StoreName"))
    reps = table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("SalesRep"), "s_acctbal")
    return [
        Lookup(dims.dimension_from_source(source, [column], [own_id], key), {column: column}, key)
        for source, column, own_id, key in (
            (regions, "Region", "r_regionkey", "RegionKey"),
            (stores, "StoreName", "n_nationkey", "StoreKey"),
            (reps, "SalesRep", "s_suppkey", "SalesRepKey"),
        )
    ]


def focus_lookup(spark: SparkSession, sf: str) -> Lookup:
    return Lookup(focus_dim(spark, sf), {c: c for c in MAPPED}, "CustomMappingKey")


COMPOSITES = (PRODUCT, STORE, EMPLOYEE)
_saved: dict[tuple[str, str], SavedStar] = {}


def build_saved_star(spark: SparkSession, sf: str, tables: VersionedTables) -> SavedStar:
    """All dimensions and the cleaned fact, from one extract, written for checks and reports.

    The fact has the keys of all dimensions, units as they are sold and as they are after cleaning, revenue and net revenue.
    """
    measures = ["UnitsSold", "UnitPrice", "Discount"]
    columns = dict.fromkeys(["OrderKey", "LineNumber", *ALL_ATTRIBUTES, *[c for spec in COMPOSITES for c in spec.columns], *measures, "Revenue"])
    extract = staged_sales(spark, sf, list(columns))
    groups = [list(spec.columns) for spec in COMPOSITES]
    groups.append([c for c in ALL_ATTRIBUTES if all(c not in group for group in groups)])
    values = stage(dims.dimension_values(extract, groups), "dimension-values")
    dim_of = {spec.key: (dim, spec.key) for spec, dim in zip(ATTRIBUTES, map(all_dims(values).get, [s.key for s in ATTRIBUTES]))}
    dim_of["SalesDateKey"] = (dims.date_dimension(values, "SalesDate"), "DateKey")
    dim_of |= {spec.key: (stage(dims.composite_dimension(values, spec), "dimension"), spec.key) for spec in COMPOSITES}
    cleaned = facts.clean(extract.withColumn("SoldUnits", F.col("UnitsSold")), CLEANING)
    measured = cleaned.withColumn("NetRevenue", facts.net_revenue(*measures))

    def keyed(specs: Sequence[CompositeDim]) -> DataFrame:
        lookups = [facts.composite_lookup(spec, dim_of[spec.key][0]) for spec in specs]
        found = facts.key_by_lookup(measured, lookups, check_unique=False, drop_attributes=False)
        return facts.key_by_hash(found, ATTRIBUTES, DATES)

    kept = ["OrderKey", "LineNumber", *dim_of, "SoldUnits", *measures, "Revenue", "NetRevenue"]
    key_alone = lambda key: keyed([spec for spec in COMPOSITES if spec.key == key]).select(key)
    return save_star(tables, keyed(COMPOSITES).select(*kept), dim_of, stored=True, key_alone=key_alone)


def saved_star(spark: SparkSession, sf: str) -> SavedStar:
    """The saved star of an application, written when it is first asked for."""
    place = (spark.sparkContext.applicationId, sf)
    if place not in _saved:
        with staging(spark):
            _saved[place] = build_saved_star(spark, sf, VersionedTables(spark, fresh_path(spark, "star")))
    return _saved[place]
