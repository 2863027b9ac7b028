"""Whole pipelines on small inputs with known results."""

import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from frames import (
    CATEGORIES, CUSTOMER_TYPES, DIRTY, DIRTY_BY_EMPLOYEE, DIRTY_BY_REGION, DIRTY_SALES, DIRTY_SALES_SCHEMA, DIRTY_SCHEMA, MAPPING,
    REGIONS, SALES, SALES_SCHEMA, TRANSACTIONS, as_set, bag,
)
from starkit.operators import checks, dims, facts, reports
from starkit.operators.dims import AttributeDim, CompositeDim
from starkit.operators.facts import FillNull, Lookup, RaiseTo
from starkit.operators.reports import Attribute
from starkit.plans.star import ATTRIBUTES, CHANNEL, REP, STORE_TYPE, SUBCATEGORY
from starkit.session import fresh_path
from starkit.sources import Warehouse, read_csv


@pytest.fixture(scope="module")
def extract(spark):
    path = fresh_path(spark, "sales-csv")
    spark.createDataFrame(SALES, SALES_SCHEMA).write.option("header", True).csv(path)
    return read_csv(spark, path, SALES_SCHEMA, {"SalesDate": "M/d/yyyy"})


@pytest.fixture(scope="module")
def star(spark, extract):
    built = dims.star_dimensions(extract, ATTRIBUTES, "SalesDate")
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    stored = {key: warehouse.save(dim, f"dim_{key}") for key, dim in built.items()}
    fact = warehouse.save(facts.key_by_hash(extract, ATTRIBUTES, {"SalesDate": "SalesDateKey"}), "fact_sales")
    return fact, stored


TOTALS = {"units": "UnitsSold", "revenue": "Revenue"}


def test_dimension_sizes(star):
    _, stored = star
    assert {key: dim.count() for key, dim in stored.items()} == {
        **{spec.key: 5 for spec in ATTRIBUTES}, "DateKey": 2192 + 1,
    }


def test_calendar_rows(star):
    calendar = star[1]["DateKey"]
    day = datetime.date
    assert calendar.where("DateKey = 20210801").collect() == [
        Row(DateKey=20210801, Date=day(2021, 8, 1), MonthName="August", Year=2021, Quarter=3, Semester="Fall")
    ]
    terms = calendar.where("Year = 2022").groupBy("Semester").agg(F.min("Date"), F.max("Date"))
    assert as_set(terms) == {
        ("Spring", day(2022, 1, 1), day(2022, 5, 31)),
        ("Summer", day(2022, 6, 1), day(2022, 7, 31)),
        ("Fall", day(2022, 8, 1), day(2022, 12, 31)),
    }
    assert calendar.where("DateKey = -1").collect() == [
        Row(DateKey=-1, Date=None, MonthName="N/A", Year=None, Quarter=None, Semester="N/A")
    ]


def test_fact_holds_keys_and_measures_only(star):
    fact, _ = star
    assert set(fact.columns) == {spec.key for spec in ATTRIBUTES} | {"SalesDateKey", "UnitsSold", "Revenue"}
    assert fact.count() == 30
    assert fact.where("SalesDateKey = 20230721").count() == 1


def test_totals_by_rep(star):
    fact, stored = star
    found = reports.totals(fact, {"rep": Attribute(stored[REP.key], REP.key, "Name")}, TOTALS)
    assert as_set(found) == {("Alice", 88, 8400), ("Bob", 180, 16000), ("Charlie", 126, 11400), ("Diana", 174, 17400)}


def test_totals_by_store_type_and_year(star):
    fact, stored = star
    by = {
        "type": Attribute(stored[STORE_TYPE.key], STORE_TYPE.key, "Name"),
        "year": Attribute(stored["DateKey"], "SalesDateKey", "Year", "DateKey"),
    }
    assert as_set(reports.totals(fact, by, TOTALS)) == {
        ("Metro", 2021, 48, 4800), ("Metro", 2023, 60, 6000), ("Metro", 2024, 66, 6600),
        ("Rural", 2021, 15, 1200), ("Rural", 2022, 44, 4400), ("Rural", 2023, 15, 1200),
        ("Rural", 2024, 15, 1200), ("Rural", 2025, 37, 3400),
        ("Suburban", 2021, 45, 4000), ("Suburban", 2022, 70, 6500), ("Suburban", 2023, 25, 2500),
        ("Suburban", 2024, 40, 3000),
        ("Urban", 2020, 12, 1100), ("Urban", 2021, 22, 2100), ("Urban", 2023, 32, 3100), ("Urban", 2025, 22, 2100),
    }


def test_channel_by_chosen_subcategories(star):
    fact, stored = star
    by = {
        "channel": Attribute(stored[CHANNEL.key], CHANNEL.key, "Name"),
        "sub": Attribute(stored[SUBCATEGORY.key], SUBCATEGORY.key, "Title"),
    }
    chosen = F.col("sub").isin("Mobile", "Vegetables")
    assert as_set(reports.totals(fact, by, TOTALS, chosen)) == {
        ("Online", "Mobile", 88, 8400), ("Wholesale", "Vegetables", 174, 17400),
    }


def test_two_attributes_of_one_dimension(star):
    fact, stored = star
    by = {out: Attribute(stored["DateKey"], "SalesDateKey", out, "DateKey") for out in ("Year", "Semester")}
    found = reports.totals(fact, by, {"units": "UnitsSold"}, F.col("Year") == 2022)
    assert as_set(found) == {(2022, "Spring", 22 + 25), (2022, "Summer", 22 + 20), (2022, "Fall", 25)}
    assert bag(reports.detail(fact, by, ["UnitsSold"]).groupBy("Year").count(), "Year", "count") == bag(
        reports.detail(fact, {"Year": by["Year"]}, []).groupBy("Year").count()
    )


def test_every_key_is_found_and_no_key_collides(star):
    fact, stored = star
    sides = {spec.key: (stored[spec.key], spec.key) for spec in ATTRIBUTES}
    sides["SalesDateKey"] = (stored["DateKey"], "DateKey")
    report = checks.referential(fact, sides)
    checks.require(report)
    assert as_set(report.select("fact_rows", "unmatched_rows").distinct()) == {(30, 0)}
    checks.require(checks.key_collision({s.key: (stored[s.key], s.key, [s.target]) for s in ATTRIBUTES}))


def test_single_pass_equals_one_dimension_at_a_time(extract, star):
    for spec in ATTRIBUTES:
        assert bag(dims.attribute_dimension(extract, spec)) == bag(star[1][spec.key])
    assert bag(dims.date_dimension(extract, "SalesDate")) == bag(star[1]["DateKey"])


# --- transactions with a custom mapping ----------------------------------------------------------


@pytest.fixture(scope="module")
def mapped(spark):
    fact = spark.createDataFrame(
        TRANSACTIONS, "TransactionID int, ProductCategory string, StoreRegion string, CustomerType string, Amount int"
    )
    sources = [
        ("ProductCategory", spark.createDataFrame(CATEGORIES, "ProductCategory string, ProductCategoryID int, CategoryGroup string")),
        ("StoreRegion", spark.createDataFrame(REGIONS, "StoreRegion string, RegionID int, Territory string")),
        ("CustomerType", spark.createDataFrame(CUSTOMER_TYPES, "CustomerType string, CustomerTypeID int, Segment string")),
    ]
    lookups = [
        Lookup(dims.dimension_from_source(source, [name], [source.columns[1]], f"{name}Key"), {name: name}, f"{name}Key")
        for name, source in sources
    ]
    natural = ["ProductCategory", "StoreRegion", "CustomerType"]
    mapping = spark.createDataFrame(MAPPING, "ProductCategory string, StoreRegion string, CustomerType string, MappingLabel string")
    checks.require(checks.mapping_unique(mapping, natural))
    labels = dims.custom_mapping_dimension(mapping, natural, "CustomMappingKey")
    lookups.append(Lookup(labels, {c: c for c in natural}, "CustomMappingKey"))
    return fact, facts.key_by_lookup(fact, lookups), labels, lookups


def test_mapping_totals(mapped):
    _, keyed, labels, _ = mapped
    found = reports.totals(keyed, {"label": Attribute(labels, "CustomMappingKey", "MappingLabel")}, {"amount": "Amount"})
    assert as_set(found) == {("Side Head", 650), ("Premium Box", 1500), ("N/A", 6800)}
    assert keyed.where("CustomMappingKey = -1").count() == 7


def test_mapping_preserves_rows_and_amounts(mapped):
    fact, keyed, _, _ = mapped
    checks.require(checks.row_count(fact, keyed))
    sums = checks.measure_sum(fact, keyed, {"Amount": "Amount"})
    checks.require(sums)
    assert sums.collect()[0]["source_total"] == 8950
    assert checks.bag_difference(fact, keyed, ["Amount", "TransactionID"]).isEmpty()


def test_source_dimensions_are_numbered_in_natural_order(mapped):
    territories = mapped[3][1].dim
    assert territories.columns == ["StoreRegion", "Territory", "StoreRegionKey"]
    assert as_set(territories) == {
        ("East", "C", 1), ("North", "A", 2), ("South", "B", 3), ("West", "D", 4), ("N/A", "N/A", -1),
    }


# --- dirty extract -------------------------------------------------------------------------------

PRODUCT = CompositeDim("ProductKey", {"ProductName": "Title", "Brand": "Brand"})
STORE = CompositeDim("StoreKey", {"Region": "Region", "Store": "Name"})
REP_DIM = CompositeDim("RepKey", {"Rep": "Rep"})
RULES = [
    FillNull("UnitsSold", 0), FillNull("UnitPrice", 0), FillNull("ProductName", "N/A"), FillNull("Discount", 0),
    RaiseTo("UnitPrice", 0),
]


@pytest.fixture(scope="module")
def dirty(spark):
    raw = spark.createDataFrame(DIRTY, DIRTY_SCHEMA)
    built = [(spec, dims.composite_dimension(raw, spec)) for spec in (PRODUCT, STORE, REP_DIM)]
    cleaned = facts.clean(raw, RULES).withColumn("Net", facts.net_revenue("UnitsSold", "UnitPrice", "Discount"))
    keyed = facts.key_by_lookup(cleaned, [facts.composite_lookup(*pair) for pair in built], check_unique=False)
    return raw, keyed, dict((spec.key, dim) for spec, dim in built)


def test_dirty_dimensions(dirty):
    built = dirty[2]
    assert as_set(built["ProductKey"]) == {
        ("Chair", "B1", 1), ("Desk", "B1", 2), ("Desk", "B2", 3), ("chair", "B1", 4), ("N/A", "N/A", -1),
    }
    assert built["StoreKey"].count() == 4 + 1
    assert built["RepKey"].count() == 3 + 1


def test_dirty_fact(dirty):
    found = [(r.UnitsSold, r.UnitPrice, r.Discount, float(r.Net), r.ProductKey, r.StoreKey, r.RepKey) for r in dirty[1].collect()]
    assert sorted(found) == sorted([
        (4.0, 25.5, 10.0, 91.8, 2, 1, 1),
        (0.0, 25.5, 10.0, 0.0, 2, 1, 1),
        (3.0, 0.0, 5.0, 0.0, 3, 2, 2),
        (2.0, 100.0, 0.0, 200.0, -1, 3, 2),
        (1.0, 19.99, 15.0, 16.9915, 1, -1, 3),
        (6.0, 0.0, 0.0, 0.0, 1, 4, -1),
        (7.0, 10.1, 12.5, 61.8625, 4, 4, 3),
    ])


def test_dirty_report(dirty):
    by = {"region": Attribute(dirty[2]["StoreKey"], "StoreKey", "Region")}
    found = reports.totals(dirty[1], by, {"units": "UnitsSold", "net": "Net"})
    assert as_set(found) == {("East", 7.0, 91.8), ("West", 15.0, 261.8625), ("N/A", 1.0, 16.9915)}


def test_rule_counts(dirty):
    assert as_set(facts.rule_counts(dirty[0], RULES)) == {
        ("FillNull(UnitsSold)", 1), ("FillNull(UnitPrice)", 1), ("FillNull(ProductName)", 1), ("FillNull(Discount)", 2),
        ("RaiseTo(UnitPrice)", 1),
    }


def test_checks_on_dirty_data(dirty):
    raw, keyed, built = dirty
    rules = {"negative": F.col("UnitPrice") < 0, "missing": F.col("UnitPrice").isNull()}
    checks.require(checks.measure_range(keyed, rules))
    with pytest.raises(checks.CheckFailed):
        checks.require(checks.measure_range(raw, rules))
    checks.require(checks.null_keys(keyed, ["ProductKey", "StoreKey", "RepKey"]))
    with pytest.raises(checks.CheckFailed):
        checks.require(checks.null_keys(raw, ["ProductName", "Region"]))
    assert as_set(checks.unknown_keys(keyed, ["ProductKey", "StoreKey", "RepKey"])) == {
        ("ProductKey", 1), ("StoreKey", 1), ("RepKey", 1),
    }
    stray = keyed.limit(1).withColumns({k: F.lit(99).cast("bigint") for k in ("ProductKey", "StoreKey", "RepKey")})
    spoiled = keyed.unionByName(stray)
    assert checks.unmatched(spoiled, built["RepKey"], "RepKey").select("RepKey").collect() == [Row(RepKey=99)]
    report = checks.referential(spoiled, {key: (dim, key) for key, dim in built.items()})
    assert as_set(report) == {(key, 8, 1, False) for key in built}


# --- dirty extract of 30 rows, from saved tables --------------------------------------------------

BIG_PRODUCT = CompositeDim("ProductKey", {"ProductCategory": "Category", "ProductName": "Name", "Brand": "Brand"})
BIG_STORE = CompositeDim("StoreKey", {"StoreRegion": "Region", "StoreName": "Name", "StoreType": "Type"})
BIG_EMPLOYEE = CompositeDim("EmployeeKey", {"SalesRep": "Name", "Department": "Department", "EmployeeRole": "Role"})
BIG_SPECS = (BIG_PRODUCT, BIG_STORE, BIG_EMPLOYEE)


@pytest.fixture(scope="module")
def saved(spark):
    """Dimensions and fact as they are read back, net revenue held as double."""
    warehouse = Warehouse(spark, fresh_path(spark, "dirty-warehouse"))
    raw = spark.createDataFrame(DIRTY_SALES, DIRTY_SALES_SCHEMA)
    built = {spec.key: warehouse.save(dims.composite_dimension(raw, spec), f"dim_{spec.key}") for spec in BIG_SPECS}
    cleaned = facts.clean(raw, RULES)
    measured = cleaned.withColumn("NetRevenue", facts.net_revenue("UnitsSold", "UnitPrice", "Discount").cast("double"))
    keyed = facts.key_by_lookup(measured, [facts.composite_lookup(spec, built[spec.key]) for spec in BIG_SPECS])
    return raw, warehouse.save(keyed, "fact_sales"), built


def test_saved_dimensions(saved):
    assert {key: dim.count() for key, dim in saved[2].items()} == {"ProductKey": 24, "StoreKey": 21, "EmployeeKey": 26}
    assert as_set(checks.unknown_keys(saved[1], ["ProductKey", "StoreKey", "EmployeeKey"])) == {
        ("ProductKey", 3), ("StoreKey", 0), ("EmployeeKey", 0),
    }


def test_saved_totals(saved):
    _, fact, built = saved
    net = {"units": "UnitsSold", "net": "NetRevenue"}
    by_region = reports.totals(fact, {"region": Attribute(built["StoreKey"], "StoreKey", "Region")}, net)
    assert as_set(by_region) == DIRTY_BY_REGION
    by_employee = reports.totals(fact, {"name": Attribute(built["EmployeeKey"], "EmployeeKey", "Name")}, net, broadcast_bytes=0)
    assert as_set(by_employee) == DIRTY_BY_EMPLOYEE
    assert checks.measure_sum(fact, fact, {"NetRevenue": "NetRevenue"}).first()["source_total"] == 91221.767


def test_saved_checks(saved):
    raw, fact, built = saved
    sides = {key: (dim, key) for key, dim in built.items()}
    checks.require(checks.row_count(raw, fact))
    checks.require(checks.referential(fact, sides))
    checks.require(checks.null_keys(fact, list(sides)))
    checks.require(checks.measure_range(fact, {"negative": F.col("UnitPrice") < 0}))
    columns = ["SaleDate", "UnitsSold", "UnitPrice", "Discount"]
    assert checks.bag_difference(facts.clean(raw, RULES), fact, columns).isEmpty()
    stray = fact.limit(1).withColumns({key: F.lit(99).cast("bigint") for key in sides})
    report = checks.referential(fact.unionByName(stray), sides)
    assert as_set(report) == {(key, 31, 1, False) for key in sides}


# --- region dimension in miniature ---------------------------------------------------------------


def test_miniature(spark):
    # Eight transactions.
    data = [
        (1, "Alice", "East", 200.0), (2, "Bob", "West", 150.0), (3, "Alice", "East", 400.0), (4, "David", "South", 300.0),
        (5, "Eve", "North", 500.0), (6, "Bob", "West", 100.0), (7, "Frank", "East", 250.0), (8, "Alice", "East", 350.0),
    ]
    fact = spark.createDataFrame(data, "TransactionID int, CustomerName string, Region string, Amount double")
    sums = fact.groupBy("CustomerName", "Region").agg(F.sum("Amount"))
    assert as_set(sums) == {
        ("Alice", "East", 950.0), ("Bob", "West", 250.0), ("David", "South", 300.0), ("Eve", "North", 500.0),
        ("Frank", "East", 250.0),
    }
    spec = AttributeDim("Region", "Region", "RegionId", algorithm="murmur3")
    dim = dims.attribute_dimension(fact, spec)
    assert dim.count() == 5
    joined = facts.key_by_hash(fact, [spec]).join(dim, "RegionId")
    assert bag(joined, "TransactionID", "Region") == bag(fact, "TransactionID", "Region")
    by_sql = spark.sql("SELECT CAST(hash('EAST') AS BIGINT) AS k")
    assert dim.where("Region = 'East'").select("RegionId").collect()[0][0] == by_sql.first()[0]
