"""The saved star: its layout, its plans, and the same rows as a star built for one query."""

import re

import pytest
from pyspark.sql import functions as F

from compare import plan_of
from frames import bag
from starkit.operators import checks, dims, facts, reports
from starkit.operators.dims import AttributeDim, CompositeDim
from starkit.operators.reports import Attribute
from starkit.operators.saved import open_star, save_star
from starkit.plans import star as sales_star
from starkit.session import fresh_path, stage
from starkit.sources import VersionedTables

SF = "/root/testdata/sf0.001"
SPECS = (AttributeDim("region", "Region", "RegionKey"), AttributeDim("item", "Item", "ItemKey"))


@pytest.fixture(scope="module")
def built(spark):
    """A third of all facts are of one item, some have none."""
    df = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("r"), F.col("id") % 3)).alias("region"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("i"), F.col("id") % 101)).alias("item"),
        (F.col("id") % 10).cast("double").alias("units"),
    )
    made = {spec.key: (dims.attribute_dimension(df, spec), spec.key) for spec in SPECS}
    return facts.key_by_hash(df, SPECS), made


@pytest.fixture(scope="module")
def saved(spark, built):
    tables = VersionedTables(spark, fresh_path(spark, "saved"))
    return save_star(tables, *built, buckets=4, group_rows=500), tables


def test_hot_and_unknown_facts_are_kept_apart(saved, built):
    star, _ = saved
    assert star.bucket_key == "ItemKey"
    assert bag(star.facts) == bag(built[0])
    assert star.hot.select("ItemKey").distinct().count() == 2 and star.hot.count() == built[0].join(star.hot, "id", "left_semi").count()
    assert star.fact.groupBy("ItemKey").count().agg(F.max("count")).first()[0] <= 500


@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 0])
def test_saved_reports_and_checks_are_those_of_a_new_star(saved, built, broadcast_bytes):
    (star, _), (fact, made) = saved, built
    by = {"Region": ("RegionKey", "Region"), "Item": ("ItemKey", "Item")}
    attributes = {out: Attribute(made[key][0], key, column) for out, (key, column) in by.items()}
    assert bag(star.totals(by, {"units": "units"}, broadcast_bytes=broadcast_bytes)) == bag(reports.totals(fact, attributes, {"units": "units"}))
    assert bag(star.detail(by, ["id", "units"], broadcast_bytes)) == bag(reports.detail(fact, attributes, ["id", "units"]))
    assert bag(star.detail({"Region": by["Region"]}, ["id"], broadcast_bytes)) == bag(reports.detail(fact, {"Region": attributes["Region"]}, ["id"]))
    assert bag(star.referential()) == bag(checks.referential(fact, made))
    profile = {(r["check"], r["subject"]): (r["counted"], r["passed"]) for r in star.profile({"none": F.col("units") == 0}).collect()}
    unknown = {r["key_column"]: r["unknown_rows"] for r in checks.unknown_keys(fact, list(made)).collect()}
    assert profile["rows", "fact"] == (3000, True) and profile["rule", "none"] == (300, False)
    assert {key: profile["unknown key", key][0] for key in made} == unknown and profile["null key", "ItemKey"] == (0, True)


def test_a_star_is_read_as_it_was_written(saved, built):
    star, tables = saved
    assert bag(open_star(tables).facts) == bag(star.facts)
    smaller = save_star(tables, built[0].where("id < 100"), built[1], buckets=4)
    assert smaller.facts.count() == 100 and star.facts.count() == 3000
    assert open_star(tables, 1).facts.count() == 3000 and open_star(tables).facts.count() == 100


def test_facts_meet_the_dimension_of_their_buckets_without_a_shuffle(spark, saved):
    star, _ = saved
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim, key = star.dims["ItemKey"]
        plan = plan_of(star.fact.join(dim, key))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" not in plan_of(star.fact.groupBy("ItemKey").agg(F.sum("units")))
        summed = plan_of(star.totals({"Item": ("ItemKey", "Item")}, {"units": "units"}, scales={"units": 0}, broadcast_bytes=0))
        # facts are summed before anything is exchanged
        assert not re.search(r"Exchange[^\n]*\n[^\n]*FileScan", summed)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["rpt_saved_by_rep", "rpt_saved_by_region", "rpt_saved_by_employee", "rpt_saved_store_type_year", "rpt_saved_channel_subcat", "rpt_saved_detail", "chk_saved_profile", "chk_saved_referential"])
def test_a_report_scans_the_saved_fact_once_and_does_not_move_it(spark, name):
    from starkit.plans import catalog

    saved = sales_star.saved_star(spark, SF)
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    try:
        plan = plan_of(catalog.queries()[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    folders = [re.search(r"/data/(\w+)/", part.inputFiles()[0]).group(1) for part in (saved.fact, saved.hot)]
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert [sum(folder in line for line in scans) for folder in folders] == [1, 1] and "lineitem.parquet" not in plan
    # no exchange lies between a scan of facts and the first sum or join above it
    lines, moved = plan.splitlines(), 0
    for i, line in enumerate(lines):
        if any(folder in line for folder in folders):
            above = next(x for x in reversed(lines[:i]) if re.search("Exchange|Join|Aggregate", x) and "BroadcastExchange" not in x)
            moved += "Exchange" in above
    assert moved == 0


def test_dimension_of_several_columns_is_saved_too(spark):
    df = spark.range(50).select("id", (F.col("id") % 3).cast("string").alias("a"), (F.col("id") % 2).cast("string").alias("b"))
    spec = CompositeDim("PairKey", {"a": "A", "b": "B"})
    dim = dims.composite_dimension(df, spec)
    fact = facts.key_by_lookup(df, [facts.composite_lookup(spec, dim)])
    star = save_star(VersionedTables(spark, fresh_path(spark, "saved")), fact, {"PairKey": (dim, "PairKey")}, buckets=2)
    assert bag(star.detail({"A": ("PairKey", "A")}, ["id"], 0)) == bag(df.select("id", F.col("a").alias("A")))


@pytest.mark.parametrize("bucket_key", ["ItemKey", "RegionKey"])
def test_stored_facts_are_not_written_once_more(spark, built, bucket_key, monkeypatch):
    """Rows of null, unknown and frequent keys, and repeated rows, are in one of the two tables as often as in the fact."""
    from starkit.operators import saved as module

    fact, made = built
    fact = fact.withColumn("ItemKey", F.when(F.col("id") % 11 > 0, F.col("ItemKey")))
    fact = fact.unionAll(fact.where("id % 4 = 0"))
    written, counted = [], []
    monkeypatch.setattr(module, "stage", lambda df, label: written.append(label) or stage(df, label))
    alone = lambda key: counted.append(key) or fact.select(key)
    stars = [
        save_star(VersionedTables(spark, fresh_path(spark, "saved")), fact, made, bucket_key, 4, 500, **given)
        for given in ({}, {"stored": True, "key_alone": alone})
    ]
    assert written == ["facts", "hot-keys", "hot-keys"] and counted == [bucket_key]
    frequent = fact.groupBy(bucket_key).count().where("count > 500").select(bucket_key)
    apart = fact.join(frequent, bucket_key, "left_semi").select(*fact.columns).unionAll(fact.where(F.col(bucket_key).isNull() | (F.col(bucket_key) == -1)))
    for star in stars:
        assert bag(star.facts) == bag(fact) and bag(star.hot.distinct()) == bag(apart.distinct()) and star.fact.count() + star.hot.count() == fact.count()


def test_the_build_writes_facts_once_and_counts_them_without_lookups(spark, monkeypatch):
    from starkit.operators import saved as module

    plans = {}
    monkeypatch.setattr(module, "stage", lambda df, label: plans.setdefault(label, plan_of(df)) and stage(df, label))
    star = sales_star.build_saved_star(spark, SF, VersionedTables(spark, fresh_path(spark, "saved")))
    assert list(plans) == ["hot-keys"] and "Join" not in plans["hot-keys"]
    assert bag(star.facts) == bag(sales_star.saved_star(spark, SF).facts)


def test_dimensions_are_the_same_from_combinations_of_their_columns(spark):
    rows = [("a", "x", 1), ("A", "x", None), (None, "y", 2), ("b", None, 2), (None, None, None), ("b", "z", 1), ("b", "z", 1)]
    df = spark.createDataFrame(rows, "t string, u string, v int").withColumn("d", F.make_date(F.lit(2000) + F.col("v"), F.lit(3), F.lit(1)))
    values = dims.dimension_values(df, [["t", "u"], ["d"], ["v"]])
    pair = CompositeDim("PairKey", {"t": "T", "u": "U"})
    assert values.columns == ["t", "u", "d", "v"] and values.count() == 6 + 3 + 3
    assert bag(dims.composite_dimension(values, pair)) == bag(dims.composite_dimension(df, pair))
    assert bag(dims.date_dimension(values, "d")) == bag(dims.date_dimension(df, "d"))
    specs = [AttributeDim("t", "T", "TKey"), AttributeDim("u", "U", "UKey")]
    ours, theirs = dims.star_dimensions(values, specs, "d"), dims.star_dimensions(df, specs, "d")
    assert list(ours) == list(theirs) and all(bag(ours[key]) == bag(theirs[key]) for key in ours)
