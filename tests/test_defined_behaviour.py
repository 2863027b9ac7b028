"""Behaviour on the inputs where a straightforward star schema goes wrong."""

import datetime

import pytest
from pyspark.sql import functions as F

from frames import as_set, bag
from starkit.functions import hash_key
from starkit.operators import checks, dims, facts, reports
from starkit.operators.dims import AttributeDim, CompositeDim
from starkit.operators.facts import Lookup
from starkit.operators.reports import Attribute
from starkit.operators.windows import previous_and_running
from starkit.plans.flat import table
from starkit.session import fresh_path, stage
from starkit.sources import CORRUPT, Warehouse, read_csv, rejected_dates, rejected_rows

REGION = AttributeDim("Region", "Region", "RegionKey")


def _regions(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "Region string")


def test_null_attribute_is_no_member(spark):
    dim = dims.attribute_dimension(_regions(spark, "North", None), REGION)
    assert as_set(dim.select("Region", F.col("RegionKey") == -1)) == {("North", False), ("N/A", True)}


@pytest.mark.parametrize("algorithm", ["xxhash64", "murmur3"])
def test_spellings_that_differ_in_case_are_one_member(spark, algorithm):
    spec = AttributeDim("Region", "Region", "RegionKey", algorithm)
    extract = _regions(spark, "north", "North", "NORTH", "South", None)
    dim = dims.attribute_dimension(extract, spec)
    assert sorted(r.Region for r in dim.collect()) == ["N/A", "NORTH", "South"]
    assert bag(dims.star_dimensions(extract, [spec])["RegionKey"]) == bag(dim)
    joined = facts.key_by_hash(extract.withColumn("n", F.lit(1)), [spec]).join(dim, "RegionKey")
    assert bag(joined, "Region") == {("NORTH",): 3, ("South",): 1, ("N/A",): 1}


def test_blanks_count_unless_trimmed(spark):
    extract = _regions(spark, "North", " north ")
    assert dims.attribute_dimension(extract, REGION).count() == 3
    trimmed = AttributeDim("Region", "Region", "RegionKey", trim=True)
    assert dims.attribute_dimension(extract, trimmed).count() == 2
    assert facts.key_by_hash(extract, [trimmed]).distinct().count() == 1


def test_unknown_hash_algorithm_is_refused():
    with pytest.raises(ValueError):
        hash_key([], "md5")


def test_key_collision_is_found(spark):
    dim = spark.createDataFrame([("a", 7), ("b", 7), ("B", 7), ("c", 8)], "Name string, K bigint")
    assert as_set(checks.key_collision({"names": (dim, "K", ["Name"])})) == {("names", 2, 1, False)}
    taken = spark.createDataFrame([("N/A", -1), ("real", -1)], "Name string, K bigint")
    assert as_set(checks.key_collision({"names": (taken, "K", ["Name"])})) == {("names", 1, 1, False)}


def test_keys_do_not_depend_on_partitioning(spark):
    spec = CompositeDim("K", {"a": "a", "b": "b"})
    data = [(f"v{i % 17}", f"w{i % 5}") for i in range(400)]
    once = spark.createDataFrame(data, "a string, b string")
    assert bag(dims.composite_dimension(once.repartition(1), spec)) == bag(dims.composite_dimension(once.repartition(13), spec))


@pytest.mark.parametrize("strategy", ["xxhash64", "murmur3"])
def test_composite_hash_keys(spark, strategy):
    df = spark.createDataFrame([("a", "x"), ("A", "X"), ("b", "x"), (None, "x")], "p string, q string")
    dim = dims.composite_dimension(df, CompositeDim("K", {"p": "p", "q": "q"}), strategy)
    assert as_set(dim, "p", "q") == {("A", "X"), ("b", "x"), ("N/A", "N/A")}
    assert dim.select("K").distinct().count() == 3


def test_keys_survive_a_rebuild(spark):
    spec = CompositeDim("K", {"a": "a"})
    old = spark.createDataFrame([("m",), ("t",)], "a string")
    before = stage(dims.composite_dimension(old, spec), "before")
    after = dims.composite_dimension(spark.createDataFrame([("b",), ("m",), ("z",)], "a string"), spec, "stable", before)
    assert as_set(after) == {("m", 1), ("t", 2), ("b", 3), ("z", 4), ("N/A", -1)}
    assert as_set(dims.composite_dimension(old, spec, "stable")) == {("m", 1), ("t", 2), ("N/A", -1)}


def test_unmatched_returns_only_unmatched_rows(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k bigint, v int")
    dim = spark.createDataFrame([(1,), (3,)], "k bigint")
    assert as_set(checks.unmatched(fact, dim, "k")) == {(2, 20), (None, 30)}
    assert as_set(checks.referential(fact, {"k": (dim, "k")})) == {("k", 3, 2, False)}


def test_facts_without_a_date_stay_in_reports(spark):
    extract = spark.createDataFrame([(datetime.date(2020, 3, 1), 5), (None, 7)], "d date, v int")
    calendar = dims.date_dimension(extract, "d")
    fact = facts.key_by_hash(extract, [], {"d": "DateKey"})
    found = reports.totals(fact, {"Year": Attribute(calendar, "DateKey", "Year")}, {"v": "v"})
    assert as_set(found) == {(2020, 5), (None, 7)}


def test_calendar_of_no_dates_is_the_unknown_member(spark):
    assert dims.date_dimension(spark.createDataFrame([(None,)], "d date"), "d").count() == 1


def test_dates_as_text_need_a_format(spark):
    path = fresh_path(spark, "dates")
    texts = [(1, "7/21/2023"), (2, "2023-07-21"), (3, "13/13/2023"), (4, None)]
    spark.createDataFrame(texts, "i int, d string").write.option("header", True).csv(path)
    parsed = read_csv(spark, path, "i int, d string", {"d": "M/d/yyyy"})
    assert bag(parsed, "d") == {(datetime.date(2023, 7, 21),): 1, (None,): 3}
    assert as_set(rejected_dates(read_csv(spark, path, "i int, d string"), {"d": "M/d/yyyy"})) == {("d", 2)}


def test_inferred_and_declared_csv_types(spark):
    path = fresh_path(spark, "typed")
    spark.createDataFrame([(1, "x", 2.5)], "i int, s string, d double").write.option("header", True).csv(path)
    assert read_csv(spark, path).dtypes == [("i", "int"), ("s", "string"), ("d", "double")]
    assert read_csv(spark, path, "i bigint, s string, d double").dtypes[0] == ("i", "bigint")


def test_unknown_member_is_built_by_name(spark):
    df = spark.createDataFrame([(5, "x", 1.5, datetime.date(2020, 1, 1))], "K bigint, Name string, amount double, day date")
    row = dims.unknown_member(df, "K")
    assert row.dtypes == df.dtypes
    assert row.collect() == [(-1, "N/A", None, None)]


def test_every_lookup_key_is_defaulted(spark):
    fact = spark.createDataFrame([("a", "q"), (None, "q"), ("zz", None)], "x string, y string")
    dim_x = spark.createDataFrame([("a", 1), ("N/A", -1)], "x string, XK bigint")
    dim_y = spark.createDataFrame([("q", 4), ("N/A", -1)], "y string, YK bigint")
    keyed = facts.key_by_lookup(fact, [Lookup(dim_x, {"x": "x"}, "XK"), Lookup(dim_y, {"y": "y"}, "YK")])
    assert bag(keyed, "XK", "YK") == {(1, 4): 1, (-1, 4): 1, (-1, -1): 1}


def test_literal_unknown_text_does_not_multiply_facts(spark):
    source = spark.createDataFrame([("N/A", 9), ("a", 8)], "x string, id int")
    dim = dims.dimension_from_source(source, ["x"], ["id"], "XK")
    keyed = facts.key_by_lookup(spark.createDataFrame([("N/A",), ("a",)], "x string"), [Lookup(dim, {"x": "x"}, "XK")])
    assert bag(keyed) == {(1,): 1, (2,): 1}


def test_null_parts_are_dropped_from_every_composite_dimension(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert as_set(dims.composite_dimension(df, CompositeDim("K", {"x": "x", "y": "y"}))) == {("a", "b", 1), ("N/A", "N/A", -1)}


def test_bag_difference_sees_both_directions(spark):
    source = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "i int, s string")
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "i int, s string")
    assert as_set(checks.bag_difference(source, fact, ["i", "s"])) == {(1, "a", 1, 0), (3, "c", 0, 1)}


def test_repeated_natural_keys_are_reported_and_refused(spark):
    mapping = spark.createDataFrame([("a", "b", None), ("a", "b", "L"), ("c", "d", "M")], "x string, y string, label string")
    assert as_set(checks.duplicates(mapping, ["x", "y"])) == {("a", "b", 2)}
    assert as_set(checks.mapping_unique(mapping, ["x", "y"])) == {(2, 1, False)}
    dim = dims.custom_mapping_dimension(mapping, ["x", "y"], "K")
    fact = spark.createDataFrame([("a", "b")], "x string, y string")
    with pytest.raises(checks.CheckFailed):
        facts.key_by_lookup(fact, [Lookup(dim, {"x": "x", "y": "y"}, "K")])


def test_warehouse_writes_and_reads_one_path(spark):
    warehouse = Warehouse(spark, fresh_path(spark, "w"))
    first = spark.range(3)
    warehouse.save(first, "t")
    assert warehouse.save(spark.range(5, 7), "t").count() == 2
    assert warehouse.load("t").count() == 2


@pytest.mark.parametrize("managed", [False, True])
def test_catalog_tables_are_replaced(spark, managed):
    warehouse = Warehouse(spark, fresh_path(spark, "tables"))
    name = "replaced_managed" if managed else "replaced"
    warehouse.save_table(spark.range(3), name, managed)
    assert warehouse.save_table(spark.range(1), name, managed).count() == 1
    assert spark.catalog.getTable(name).tableType == ("MANAGED" if managed else "EXTERNAL")


def test_failed_checks_raise(spark):
    small, large = spark.range(2), spark.range(3)
    with pytest.raises(checks.CheckFailed):
        checks.require(checks.row_count(small, large))
    with pytest.raises(checks.CheckFailed):
        checks.require(checks.measure_sum(small, large, {"id": "id"}))
    assert checks.row_count(small.limit(0), large.limit(0)).collect() == [(0, 0, True)]


def test_empty_extract(spark):
    empty = spark.createDataFrame([], "Region string")
    assert as_set(dims.attribute_dimension(empty, REGION)) == {("N/A", -1)}
    assert as_set(dims.star_dimensions(empty, [REGION])["RegionKey"]) == {("N/A", -1)}
    assert as_set(dims.composite_dimension(empty, CompositeDim("K", {"Region": "R"}))) == {("N/A", -1)}
    assert facts.key_by_hash(empty, [REGION]).count() == 0


# --- measures are never rounded ------------------------------------------------------------------


def _fractions(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")


def test_small_fractions_are_summed_whole(spark):
    df = _fractions(spark, *[0.004] * 1000)
    keyed = df.withColumn("K", F.lit(1).cast("bigint"))
    dim = spark.createDataFrame([(1, "a")], "K bigint, name string")
    found = reports.totals(keyed, {"name": Attribute(dim, "K", "name")}, {"total": "v"})
    assert as_set(found) == {("a", 4.0)}
    running = previous_and_running(df.withColumn("g", F.lit(1)), ["g"], ["i"], "v")
    assert running.orderBy("i").first()["running_total"] == 0.004


@pytest.mark.parametrize("value", [0.0001, 1e30, float("nan")])
def test_a_value_that_does_not_fit_its_stated_places_is_refused(spark, value):
    df = _fractions(spark, value).withColumn("K", F.lit(1).cast("bigint"))
    dim = spark.createDataFrame([(1, "a")], "K bigint, name string")
    with pytest.raises(Exception, match="not exact"):
        reports.totals(df, {"name": Attribute(dim, "K", "name")}, {"total": "v"}, scales={"total": 2}).collect()


@pytest.mark.parametrize(
    ("units", "price", "discount", "expected"), [(1000.0, 0.004, 12.345, 3.5062), (1.0, 9.999, 0.0, 9.999), (2e10, 0.5, 50.0, 5e9), (3.0, 7.5, 100.0, 0.0)]
)
def test_net_revenue_is_exact(spark, units, price, discount, expected):
    df = spark.createDataFrame([(units, price, discount)], "u double, p double, d double")
    assert float(df.select(facts.net_revenue("u", "p", "d")).first()[0]) == expected


def test_unequal_totals_do_not_pass(spark):
    left, right = _fractions(spark, *[1.004] * 1000), _fractions(spark, *[0.996] * 1000)
    assert not checks.measure_sum(left, right, {"v": "v"}).first()["passed"]
    assert checks.measure_sum(left, right, {"v": "v"}, tolerance=8.1).first()["passed"]
    big = [spark.createDataFrame([(n,)], "v bigint") for n in (2**53, 2**53 + 1)]
    assert not checks.measure_sum(*big, {"v": "v"}).first()["passed"]
    assert checks.measure_sum(big[0], big[0].select(F.col("v").cast("double")), {"v": "v"}).first()["passed"]


def test_cleaning_refuses_values_that_do_not_fit(spark):
    df = spark.createDataFrame([(None,), (2,)], "v int")
    with pytest.raises(ValueError):
        facts.clean(df, [facts.RaiseTo("v", 3.5)])
    with pytest.raises(ValueError):
        facts.clean(df, [facts.FillNull("v", 0.9)])
    rules = [facts.FillNull("v", 0), facts.RaiseTo("v", 1), facts.RaiseTo("v", 3)]
    assert as_set(facts.rule_counts(df, rules)) == {("FillNull(v)", 1), ("RaiseTo(v)", 1), ("RaiseTo(v)#2", 2)}


def test_facts_find_their_composite_member_in_any_spelling(spark):
    spec = CompositeDim("K", {"p": "p", "q": "q"})
    df = spark.createDataFrame([("a", "x"), ("A", "X"), ("b", "x"), (None, "x")], "p string, q string")
    dim = dims.composite_dimension(df, spec, "xxhash64")
    joined = facts.key_by_hash(df, [spec]).join(dim, "K")
    assert bag(joined, "p", "q") == {("A", "X"): 2, ("b", "x"): 1, ("N/A", "N/A"): 1}


def test_attributes_of_several_types_in_one_pass(spark):
    df = spark.createDataFrame([("a", 3), ("b", 4), (None, 4)], "name string, size int")
    specs = [AttributeDim("name", "Name", "NK"), AttributeDim("size", "Size", "SK")]
    built = dims.star_dimensions(df, specs)
    assert built["SK"].schema["Size"].dataType.simpleString() == "int"
    for spec in specs:
        assert bag(built[spec.key]) == bag(dims.attribute_dimension(df, spec))


def test_an_empty_fact_is_checked_for_every_key(spark):
    dim = spark.createDataFrame([(1,)], "k bigint")
    fact = spark.createDataFrame([], "k bigint, j bigint")
    assert as_set(checks.referential(fact, {"k": (dim, "k"), "j": (dim, "k")})) == {("k", 0, 0, True), ("j", 0, 0, True)}


def test_an_output_may_have_the_name_of_a_key(spark):
    fact = spark.createDataFrame([(1, 5), (1, 6)], "K bigint, v int")
    dim = spark.createDataFrame([(1, "a")], "K bigint, name string")
    assert as_set(reports.totals(fact, {"K": Attribute(dim, "K", "name")}, {"v": "v"})) == {("a", 11.0)}
    small = reports.totals(fact, {"K": Attribute(dim, "K", "name")}, {"v": "v"}, F.col("K") == "a", broadcast_bytes=0)
    assert as_set(small) == {("a", 11.0)}


def test_rows_without_a_natural_key_are_no_members(spark):
    source = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "name string, id int")
    dim = dims.dimension_from_source(source, ["name"], ["id"], "K")
    assert as_set(dim) == {("a", 1), ("N/A", -1)}


def test_a_table_is_read_with_the_schema_that_it_has(spark):
    folder = fresh_path(spark, "tables")
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{folder}/t.parquet")
    assert table(spark, folder, "t").columns == ["a"]
    spark.createDataFrame([(1,)], "b int").write.mode("overwrite").parquet(f"{folder}/t.parquet")
    assert table(spark, folder, "t").collect() == [(1,)] and table(spark, folder, "t").columns == ["b"]


def test_errors_say_how_many_rows_failed(spark):
    report = spark.range(25).select("id", F.lit(False).alias("passed"))
    with pytest.raises(checks.CheckFailed, match="and 5 more"):
        checks.require(report)


def test_csv_headers_and_bad_rows(spark, tmp_path):
    (tmp_path / "swapped.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "swapped.csv"), "a int, b int").collect()
    (tmp_path / "mixed.csv").write_text("a,b\n1,x\nnone,y\n3\n4,z,more\n5,\n")
    kept = read_csv(spark, str(tmp_path / "mixed.csv"), "a int, b string", keep_corrupt=True)
    assert rejected_rows(kept).collect() == [(5, 3, False)]
    assert as_set(stage(kept, "kept").where(F.col(CORRUPT).isNull()).select("a", "b")) == {(1, "x"), (5, None)}
