"""Single operators on tiny inputs."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from frames import as_set, bag
from starkit.operators.joins import null_fan_out, null_safe_join
from starkit.operators.rows import split_to_rows
from starkit.operators.windows import previous_and_running, top_n
from starkit.sources import rows


def test_previous_and_running(spark):
    data = [("u", 5, 7), ("u", 9, -2), ("u", 11, 40), ("w", 3, 13)]
    df = rows(spark, data, "shop string, week int, sold bigint")
    expected = {("u", 5, 7, 0, 7), ("u", 9, -2, 7, 5), ("u", 11, 40, -2, 45), ("w", 3, 13, 0, 13)}
    assert as_set(previous_and_running(df, ["shop"], ["week"], "sold")) == expected
    assert as_set(previous_and_running(df, ["shop"], ["week"], "sold", group_rows=1)) == expected


def test_split_to_rows(spark):
    df = rows(spark, [(1, "red,green,blue"), (2, "oak"), (4, ""), (5, None)], "id int, tags string")
    known = {(1, "red"), (1, "green"), (1, "blue"), (2, "oak"), (4, "")}
    assert as_set(split_to_rows(df, "tags", ",", "tag")) == known
    assert as_set(split_to_rows(df, "tags", ",", "tag", outer=True)) == known | {(5, None)}


def test_top_two_with_ties(spark):
    df = rows(
        spark,
        [("pear", "k", 4), ("pear", "m", 9), ("pear", "l", 1), ("fig", "o", 2), ("plum", "u", 5), ("plum", "t", 5), ("plum", "s", 5)],
        ["fruit", "crate", "weight"],
    )
    best = top_n(df, ["fruit"], [F.col("weight").desc(), F.col("crate")], 2)
    assert as_set(best) == {("pear", "m", 9), ("pear", "k", 4), ("fig", "o", 2), ("plum", "s", 5), ("plum", "t", 5)}


def test_null_safe_join_by_type(spark):
    left = rows(spark, [(7, "p"), (None, "q"), (8, "r"), (None, "s")], "id int, name string")
    right = rows(spark, [(7, 70), (None, 1), (None, 2), (None, 3)], "rid int, salary int")
    on = {"id": "rid"}
    counts = {how: null_safe_join(left, right, on, how).count() for how in ("inner", "left", "right", "full")}
    assert counts == {"inner": 7, "left": 8, "right": 7, "full": 8}
    nulls = null_safe_join(left, right, on, "full").where("id IS NULL AND name IS NOT NULL AND salary IS NOT NULL")
    assert bag(nulls, "name") == {("q",): 3, ("s",): 3}
    assert null_fan_out(left, right, on).collect() == [Row(left_nulls=2, right_nulls=3, null_pairs=6)]
