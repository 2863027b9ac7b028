"""Tables that are replaced as a whole: rebuilt from themselves, pinned, and left alone by writes that fail."""

import os

import pytest
from pyspark.sql import functions as F

from starkit.sources import TableChanged, VersionedTables


@pytest.fixture
def tables(spark, tmp_path):
    return VersionedTables(spark, f"file://{tmp_path}/tables")


def ids(df):
    return sorted(row["id"] for row in df.collect())


def test_a_table_is_rebuilt_from_itself(spark, tables):
    assert tables.save(spark.range(5), "t") == 1
    first = tables.load("t")
    assert tables.save(tables.load("t").select((F.col("id") * 10).alias("id")), "t") == 2
    assert ids(tables.load("t")) == [0, 10, 20, 30, 40]
    assert ids(first) == ids(tables.load("t", 1)) == [0, 1, 2, 3, 4]
    assert tables.versions("t") == [1, 2]


def test_a_write_that_dies_leaves_the_old_version(spark, tables, tmp_path):
    tables.save(spark.range(5), "t")
    broken = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("dies"))).alias("id")).repartition(4)
    with pytest.raises(Exception, match="dies"):
        tables.save(broken, "t")
    assert ids(tables.load("t")) == [0, 1, 2, 3, 4] and tables.versions("t") == [1]
    # killed while the manifest was written
    with open(f"{tmp_path}/tables/t/versions/000000000002.json", "w") as manifest:
        manifest.write('{"folder": "data/x"')
    assert tables.versions("t") == [1] and ids(tables.load("t")) == [0, 1, 2, 3, 4]
    assert tables.save(spark.range(2), "t") == 3 and ids(tables.load("t")) == [0, 1]
    with pytest.raises(ValueError, match="no version 2"):
        tables.load("t", 2)


def test_versions_expire(spark, tables, tmp_path):
    for n in range(1, 5):
        tables.save(spark.range(n), "t")
    os.makedirs(f"{tmp_path}/tables/t/data/left-behind")
    assert tables.expire("t", keep=2) == [1, 2]
    assert len(os.listdir(f"{tmp_path}/tables/t/data")) == 5  # young folders stay
    assert tables.expire("t", keep=2, grace_seconds=0) == []
    assert len(os.listdir(f"{tmp_path}/tables/t/data")) == 2 and tables.versions("t") == [3, 4]
    assert ids(tables.load("t", 3)) == [0, 1, 2] and tables.save(spark.range(1), "t") == 5
    with pytest.raises(ValueError):
        tables.load("t", 1)


def test_a_change_of_an_old_version_is_refused(spark, tables):
    base = tables.save(spark.range(5), "t")
    tables.save(spark.range(6), "t", based_on=base)
    with pytest.raises(TableChanged):
        tables.save(spark.range(7), "t", based_on=base)
    assert len(ids(tables.load("t"))) == 6


def test_a_table_in_buckets_is_joined_without_a_shuffle(spark, tables):
    from compare import plan_of

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables.save(spark.range(100).select("id", (F.col("id") % 7).alias("k")).repartition(3), "facts", bucket=("k", 4))
        tables.save(spark.range(7).select(F.col("id").alias("k"), F.lit("x").alias("name")), "members", bucket=("k", 4))
        joined = tables.load("facts").join(tables.load("members"), "k")
        assert "Exchange" not in plan_of(joined) and joined.count() == 100
        assert "Exchange" not in plan_of(tables.load("facts").groupBy("k").count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("starkit_")] == []


def test_there_is_no_such_table(tables):
    with pytest.raises(ValueError, match="there is no table"):
        tables.load("none")
    assert tables.versions("none") == [] and tables.expire("none") == []
