"""Comparisons that move fingerprints and bitmaps give what those that move rows and keys give."""

import random

import pytest
from pyspark.sql import functions as F

from compare import plan_of
from frames import bag
from starkit.operators import checks


def _rows(spark, seed, n=600):
    chosen = random.Random(seed)
    data = [(chosen.randrange(80), chosen.choice([None, "a", "b"]), chosen.choice([0.0, -0.0, 1.5, float("nan"), None])) for _ in range(n)]
    return spark.createDataFrame(data, "k int, t string, v double").repartition(4)


@pytest.mark.parametrize("ranges, levels", [(4096, 2), (3, 1), (2, 4)])
def test_range_difference_is_the_bag_difference(spark, ranges, levels):
    a = _rows(spark, 1)
    # some rows changed, some repeated, some gone, one with another key
    b = a.withColumn("t", F.when(F.col("k") == 7, "z").otherwise(F.col("t"))).where("k <> 9").unionAll(a.where("k = 11"))
    b = b.withColumn("k", F.when((F.col("k") == 13) & F.col("t").isNull(), -1).otherwise(F.col("k")))
    for left, right in ((a, b), (b, a), (a, a.limit(0)), (a.limit(0), a)):
        found = checks.range_difference(left, right, a.columns, ["k"], ranges, levels)
        expected = checks.bag_difference(left, right, a.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) and found.columns == expected.columns


def test_equal_sides_are_not_read_for_rows(spark):
    a = _rows(spark, 2)
    same = a.withColumn("v", F.when(F.col("v") == 0, F.lit(0.0)).otherwise(F.col("v"))).repartition(7)
    found = checks.range_difference(a, same, a.columns, ["k"])
    assert found.collect() == [] and "Exchange" not in plan_of(found)
    with pytest.raises(ValueError, match="k is int here and bigint there"):
        checks.range_difference(a, a.withColumn("k", F.col("k").cast("bigint")), a.columns, ["k"])


def test_bitmaps_give_the_report_of_referential(spark):
    chosen = random.Random(3)
    keys = [None, -1, 0, 1, -32768, -32769, 32767, 32768, 32769, 10**12, -(10**12)]
    fact = spark.createDataFrame([(chosen.choice(keys), chosen.randrange(200), i) for i in range(2000)], "a bigint, b int, c int").repartition(5)
    small = spark.createDataFrame([(k,) for k in (None, -1, 0, 32768, 10**12)], "id bigint")
    dense = spark.range(-5, 150).unionAll(spark.range(10))
    every = spark.createDataFrame([(k,) for k in keys if k is not None], "id bigint")
    whole = spark.range(2000)
    for sides in ({"a": (small, "id"), "b": (dense, "id")}, {"a": (every, "id"), "c": (whole, "id")}, {"c": (whole.limit(0), "id")}):
        assert bag(checks.referential_by_bitmaps(fact, sides)) == bag(checks.referential(fact, sides))
        assert bag(checks.referential_by_bitmaps(fact.limit(0), sides)) == bag(checks.referential(fact.limit(0), sides))
