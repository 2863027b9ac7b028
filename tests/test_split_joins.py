"""Joins whose keys are split or whose facts stay where they are give the rows of the plain join."""

import random

import pytest
from pyspark.sql import functions as F

from compare import plan_of
from frames import bag
from starkit.operators.joins import filter_words, join_members, member_filter, null_fan_out, null_safe_join


def _sides(spark):
    """Nulls and one key hold most rows; other keys are on one side only."""
    chosen = random.Random(1)
    keys = [None] * 40 + ["hot"] * 30 + [f"k{i}" for i in range(12)]
    left = [(chosen.choice(keys), chosen.choice([None, 1]), i) for i in range(300)]
    right = [(chosen.choice([*keys, "r1", "r2"]), chosen.choice([None, 1]), i) for i in range(90)]
    return (
        spark.createDataFrame(left, "k string, h int, i int").repartition(3), spark.createDataFrame(right, "r string, g int, j int").repartition(3)
    )


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("on", [{"k": "r"}, {"k": "r", "h": "g"}])
def test_split_keys_give_the_plain_join(spark, how, on):
    left, right = _sides(spark)
    plain = null_safe_join(left, right, on, how)
    for a, b, pairs in ((left, right, on), (right, left, {v: k for k, v in on.items()})):
        whole, split = (null_safe_join(a, b, pairs, how, group_pairs=n) for n in (10**9, 50))
        assert bag(split) == bag(whole) and split.columns == whole.columns
    assert plain.columns == [*left.columns, *right.columns]


def test_null_pairs_spread_over_tasks(spark):
    left, right = (spark.range(2000).select(F.lit(None).cast("string").alias(c), F.col("id").alias(f"{c}_id")) for c in ("a", "b"))
    assert null_fan_out(left, right, {"a": "b"}).first()["null_pairs"] == 4_000_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = null_safe_join(left, right, {"a": "b"}, group_pairs=100_000)
        tasks = split.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(t["count"] for t in tasks) == 4_000_000 and len(tasks) >= 6 and max(t["count"] for t in tasks) < 2_000_000


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("missing", [0, 50, 100])
def test_facts_without_a_member_stay_where_they_are(spark, how, missing):
    dim = spark.range(4000).select(F.concat(F.lit("m"), F.col("id")).alias("name"), (F.col("id") % 3).cast("int").alias("g"), F.col("id").alias("K"))
    fact = spark.range(8000).select(
        F.when(F.col("id") % 50 > 0, F.concat(F.when(F.col("id") % 100 < missing, "x").otherwise("m"), F.col("id") % 4000)).alias("n"),
        ((F.col("id") % 4000) % 3).cast("int").alias("h"), "id",
    )
    found = join_members(fact, dim, {"n": "name", "h": "g"}, ["K"], how)
    plain = fact.join(dim, (fact["n"] == dim["name"]) & (fact["h"] == dim["g"]), how).select(*fact.columns, "K")
    assert bag(found) == bag(plain) and found.dtypes == plain.dtypes
    assert bag(join_members(fact, dim, {"n": "name", "h": "g"}, ["K"], how, limit=100)) == bag(plain)


def test_a_filter_has_the_size_that_its_members_need(spark):
    assert [filter_words(n) for n in (0, 1, 256, 300, 4000, 10**6)] == [64, 64, 128, 128, 1024, 1 << 18]
    dim = spark.range(4000).select(F.concat(F.lit("m"), "id").alias("name"))
    bits, words = member_filter(dim, ["name"])
    assert words == 1024 and bits.count() <= words
    others = spark.range(20_000).select(F.concat(F.lit("x"), "id").alias("name"))
    from starkit.operators.joins import _filter_place

    word, mask = _filter_place(["name"], words)
    for keys, least, most in ((dim, 4000, 4000), (others, 0, 1000)):
        met = keys.select(word.alias("w"), mask.alias("m")).join(bits, F.col("w") == F.col("_word"))
        assert least <= met.where(F.col("m").bitwiseAND(F.col("_bits")) == F.col("m")).count() <= most
    assert member_filter(dim, ["name"], limit=1000) is None


def test_only_facts_that_may_have_a_member_are_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim = spark.range(100).select("id", (F.col("id") * 2).alias("K"))
        fact = spark.range(1000).select((F.col("id") + 5000).alias("f"))
        plan = plan_of(join_members(fact, dim, {"f": "id"}, ["K"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Union" in plan and plan.count("Exchange hashpartitioning") == 2 and plan.count("BroadcastExchange") + plan.count("ReusedExchange") >= 1
