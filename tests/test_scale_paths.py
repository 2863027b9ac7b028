"""The ways taken for large groups and large dimensions give what the short ways give."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from frames import bag
from starkit.operators import checks, dims, facts
from starkit.operators.dims import AttributeDim, CompositeDim
from starkit.operators.joins import Side, to_dimensions
from starkit.operators.numbering import dense_key
from starkit.operators.sizes import GROUP_ROWS, hot_groups, payload_bytes
from starkit.operators.windows import previous_and_running, top_n


def _history(spark, seed):
    """One key holds a third of all rows, some keys and values are null."""
    rng = random.Random(seed)
    data = []
    for i in range(1200):
        key = "hot" if rng.random() < 0.34 else rng.choice([None, *[f"k{j}" for j in range(40)]])
        value = None if rng.random() < 0.1 else round(rng.uniform(-50, 500), 2)
        data.append((key, rng.randrange(60), i, value))
    return spark.createDataFrame(data, "k string, day int, id int, v double").repartition(7)


def _brute_force(df):
    expected, groups = {}, {}
    for r in df.collect():
        groups.setdefault(r.k, []).append(r)
    for key, found in groups.items():
        total, before = None, 0.0
        for r in sorted(found, key=lambda r: (r.day, r.id)):
            if r.v is not None:
                total = round((total or 0) + r.v, 2)
            expected[r.id] = (key, before, total)
            before = r.v
    return expected


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("group_rows", [GROUP_ROWS, 100, 10])
def test_previous_and_running(spark, seed, group_rows):
    df = _history(spark, seed)
    got = previous_and_running(df, ["k"], ["day", "id"], "v", group_rows=group_rows)
    assert got.columns == ["k", "day", "id", "v", "previous_value", "running_total"]
    found = {r.id: (r.k, r.previous_value, r.running_total) for r in got.collect()}
    assert found == _brute_force(df)


@pytest.mark.parametrize("kind", ["int", "double", "decimal(12,2)", "decimal(30,10)"])
def test_types_and_values_do_not_depend_on_the_size_of_a_group(spark, kind):
    df = _history(spark, 3).withColumn("v", F.col("v").cast(kind))
    short = previous_and_running(df, ["k"], ["day", "id"], "v")
    long = previous_and_running(df, ["k"], ["day", "id"], "v", group_rows=50)
    assert bag(short) == bag(long) and short.dtypes == long.dtypes


def test_equal_and_null_rows_spread_over_tasks(spark):
    """Rows of a hot key and rows without a key, all alike, end in more than one task, whatever columns the fact has."""
    fact = spark.createDataFrame([("hot",)] * 4000 + [(None,)] * 4000 + [("k1",)] * 10, "k string").withColumn("m", F.create_map(F.lit(1), F.lit(2)))
    dim = spark.createDataFrame([("hot", 1), ("k1", 2)], "name string, number bigint")
    side = [Side(dim, {"k": "name"}, ["number"])]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = to_dimensions(fact, side, broadcast_bytes=0, group_rows=1000)
        tasks = {(r.k, r.p) for r in spread.withColumn("p", F.spark_partition_id()).select("k", "p").distinct().collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(k == "hot" for k, _ in tasks) > 1 and sum(k is None for k, _ in tasks) > 1
    assert spread.dtypes == to_dimensions(fact, side).dtypes
    assert bag(spread.select("k", "number")) == bag(to_dimensions(fact, side).select("k", "number"))


def test_top_n_of_many_rows(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), "id").repartition(6)
    found = top_n(df, ["g"], [F.col("id").desc()], 1500)
    assert bag(found) == {(i % 2, i): 1 for i in range(2000, 5000)}
    assert found.columns == ["g", "id"]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("group_rows", [GROUP_ROWS, 30])
def test_spread_join(spark, how, group_rows):
    fact = _history(spark, 4)
    dim = spark.createDataFrame([("hot", 1, "x"), ("k1", 2, "y"), ("k2", 3, None), ("none", 4, "z")], "name string, K bigint, t string")
    sides = [Side(dim, {"k": "name"}, ["K", "t"])]
    spread = to_dimensions(fact, sides, how, broadcast_bytes=0, group_rows=group_rows)
    assert bag(spread) == bag(to_dimensions(fact, sides, how))
    plain = fact.join(dim, fact.k == dim.name, how).drop("name")
    assert bag(spread) == bag(plain)


def test_spread_join_on_two_columns(spark):
    fact = _history(spark, 5).withColumn("half", F.col("day") % 2)
    dim = fact.select("k", "half").distinct().dropna().withColumn("K2", F.xxhash64("k", "half"))
    side = Side(dim.withColumnRenamed("half", "h"), {"k": "k", "half": "h"}, ["K2"])
    spread = to_dimensions(fact, [side], broadcast_bytes=0, group_rows=25)
    assert bag(spread) == bag(to_dimensions(fact, [side]))


def test_lookup_by_spread_join(spark):
    fact = _history(spark, 6)
    spec = CompositeDim("NameKey", {"k": "name"})
    dim = dims.composite_dimension(fact, spec)
    found = [facts.composite_lookup(spec, dim)]
    spread = facts.key_by_lookup(fact, found, broadcast_bytes=0, group_rows=20)
    assert bag(spread) == bag(facts.key_by_lookup(fact, found))
    checks.require(checks.row_count(fact, spread))


def test_hot_groups(spark):
    hot = hot_groups(_history(spark, 7), ["k"], 200).collect()
    assert [r.k for r in hot] == ["hot"] and hot[0]["_rows"] > 300


def test_payload(spark):
    texts = spark.createDataFrame([("abc", 1), (None, 2), ("é", 3)], "t string, n int")
    lists = spark.createDataFrame([([1],)], "a array<int>")
    size, unknown, empty = payload_bytes([texts, lists, texts.limit(0)])
    assert size == 3 * (32 + 2 * 16) + 5 and unknown is None and empty == 0


@pytest.mark.parametrize("partitions", [1, 9])
def test_dense_keys_over_many_ranges(spark, partitions):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(8)
        data = list({(f"a{rng.randrange(50)}", rng.randrange(1000)) for _ in range(3000)})
        df = spark.createDataFrame(data, "a string, b int").repartition(partitions)
        numbered = dense_key(df, ["a", "b"], "K", start=5)
        expected = df.withColumn("K", (F.row_number().over(W.orderBy("a", "b")) + 5).cast("bigint"))
        assert bag(numbered) == bag(expected)
        assert numbered.schema["K"].dataType.simpleString() == "bigint"
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# --- properties on seeded random frames ----------------------------------------------------------


def _random_sales(spark, seed):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice([None, *values])
    data = [
        (pick("North", "north", "South"), pick("a", "b", "c", "N/A"), pick("x", "y"), rng.randrange(100), round(rng.uniform(0, 9), 2))
        for _ in range(500)
    ]
    return spark.createDataFrame(data, "Region string, P string, Q string, units int, amount double").repartition(5)


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_keying_keeps_rows_totals_and_coverage(spark, seed):
    extract = _random_sales(spark, seed)
    region, pq = AttributeDim("Region", "Region", "RegionKey"), CompositeDim("PQKey", {"P": "P", "Q": "Q"})
    region_dim, pq_dim = dims.attribute_dimension(extract, region), dims.composite_dimension(extract, pq)
    fact = facts.key_by_lookup(facts.key_by_hash(extract, [region]), [facts.composite_lookup(pq, pq_dim)])
    checks.require(checks.row_count(extract, fact))
    checks.require(checks.measure_sum(extract, fact, {"units": "units", "amount": "amount"}))
    checks.require(checks.referential(fact, {"RegionKey": (region_dim, "RegionKey"), "PQKey": (pq_dim, "PQKey")}))
    checks.require(checks.null_keys(fact, ["RegionKey", "PQKey"]))
    keys = sorted(r.PQKey for r in pq_dim.collect())
    assert keys == [-1, *range(1, len(keys))]


@pytest.mark.parametrize("seed", [21, 22])
def test_bag_difference_agrees_with_except_all(spark, seed):
    a = _random_sales(spark, seed).select("Region", "P", "Q")
    b = _random_sales(spark, seed + 100).select("Region", "P", "Q")
    report = checks.bag_difference(a, b, a.columns).collect()
    one_way = {tuple(r[:3]): r.missing_in_fact for r in report if r.missing_in_fact}
    other_way = {tuple(r[:3]): r.extra_in_fact for r in report if r.extra_in_fact}
    assert one_way == dict(bag(a.exceptAll(b))) and other_way == dict(bag(b.exceptAll(a)))
    assert bag(a.unionAll(b).exceptAll(b)) == bag(a)
