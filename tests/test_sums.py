"""Exact sums of any double against whole-number arithmetic."""

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from starkit.functions.sums import Sums, exact_sums
from starkit.operators import checks, reports
from starkit.operators.reports import Attribute
from starkit.operators.windows import previous_and_running


def nearest(values):
    total = sum(map(Fraction, values))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def one_of(chosen, kind):
    if kind == 0:
        return chosen.uniform(-1, 1) * 10 ** chosen.randint(-300, 300)
    if kind == 1:
        return chosen.choice([-1, 1]) * chosen.randint(1, 300) / 300 + chosen.choice([0, 1e-19])
    if kind == 2:
        return chosen.choice([5e-324, -5e-324, 1.5e-310, 2.2250738585072014e-308, 1 / 3])
    if kind == 3:
        return chosen.choice([2.0**-53, -1.0, 2.0**-52, 2.0**-1074, 1 + 2.0**-52, 2.0**52, 2.0**53, 0.5])
    if kind == 4:
        return chosen.choice([1.7976931348623157e308, -1.7976931348623157e308, 1e308, -9e307])
    if kind == 5:
        return 2.0 ** chosen.randint(-1074, 1023) * chosen.choice([1, -1])
    return math.nextafter(2.0 ** chosen.randint(-1000, 1023), chosen.choice([0, math.inf]))


@pytest.fixture(scope="module")
def groups():
    chosen = random.Random(5)
    found = {}
    for g in range(400):
        # one value that no decimal of 18 places holds
        values = [2.0**-70 / 3] + [one_of(chosen, g % 7) for _ in range(chosen.randint(1, 12))]
        found[g] = values + ([-v for v in values[1:]] if g % 5 == 0 else [])
    return found


def rows_of(spark, groups, seed=0, parts=7):
    rows = [(g, i, v) for g, values in groups.items() for i, v in enumerate(values)]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "g int, i int, v double").repartition(parts)


def test_sums_are_the_nearest_doubles_in_any_order(spark, groups):
    expected = {g: nearest(values) for g, values in groups.items()}
    for seed, parts in ((1, 7), (2, 1)):
        found = exact_sums(rows_of(spark, groups, seed, parts), ["g"], {"total": "v"})
        assert {r.g: r.total for r in found.collect()} == expected
    fsum = {g: math.fsum(values) for g, values in groups.items() if abs(expected[g]) < 1e300 and max(map(abs, values)) < 1e300}
    assert fsum == {g: expected[g] for g in fsum} and len(fsum) > 200


def test_sums_of_everything_that_is_no_number(spark):
    inf, nan = math.inf, math.nan
    groups = {0: [nan, 1.0], 1: [inf, 1.0], 2: [inf, -inf], 3: [-inf, 1e308], 4: [None], 5: [None, 2.5], 6: [0.0, -0.0], 7: [1e308, 1e308], 8: [inf, inf]}
    found = {r.g: r.total for r in exact_sums(rows_of(spark, groups), ["g"], {"total": "v"}).collect()}
    assert math.isnan(found.pop(0)) and math.isnan(found.pop(2))
    assert found == {1: inf, 3: -inf, 4: None, 5: 2.5, 6: 0.0, 7: inf, 8: inf} and str(found[6]) == "0.0"
    empty = rows_of(spark, groups).where("g < 0")
    assert [tuple(r) for r in exact_sums(empty, [], {"total": "v"}).collect()] == [(None,)]
    assert exact_sums(empty, ["g"], {"total": "v"}).collect() == []


def test_values_that_are_written_with_few_places_are_summed_as_written(spark):
    groups = {1: [0.1, 0.2], 2: [0.1, 0.2, 1 / 3], 3: [1e19] * 30, 4: [0.004] * 1000, 5: [100 / 7] * 9, 6: [0.1, 123456.123456789, 1e14, 999999999.5]}
    df = rows_of(spark, groups).withColumns({"f": F.col("v").cast("float"), "n": F.col("i") + 1})
    found = {r.g: (r.d, r.n) for r in exact_sums(df, ["g"], {"d": "v", "n": "n"}).collect()}
    sixth = float(Decimal("0.1") + Decimal("123456.123456789") + 10**14 + Decimal("999999999.5"))
    assert found == {
        1: (0.3, 3.0), 2: (nearest(groups[2]), 6.0), 3: (3e20, 465.0), 4: (4.0, 500500.0), 5: (nearest(groups[5]), 45.0), 6: (sixth, 10.0),
    }
    assert {r.g: r.f for r in exact_sums(df.where("g < 2"), ["g"], {"f": "f"}).collect()} == {1: 0.3}


def test_several_measures_at_once(spark, groups):
    df = rows_of(spark, groups).withColumns({"w": F.col("v") * 0.5, "price": F.lit(1.25)})
    found = exact_sums(df, ["g"], {"a": "v", "b": "w", "c": "price"}, {"c": 2})
    for r in found.collect():
        values = groups[r.g]
        assert (r.a, r.b, r.c) == (nearest(values), nearest([v * 0.5 for v in values]), 1.25 * len(values))


@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 0])
def test_totals_of_thirds(spark, broadcast_bytes):
    groups = {g: [chosen / 300 for chosen in range(1, 50 + g)] for g in range(5)}
    dim = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "c"), (4, "c")], "g int, name string")
    found = reports.totals(rows_of(spark, groups), {"name": Attribute(dim, "g", "name")}, {"total": "v"}, broadcast_bytes=broadcast_bytes)
    expected = {"a": nearest(groups[0] + groups[1]), "b": nearest(groups[2]), "c": nearest(groups[3] + groups[4])}
    assert {r.name: r.total for r in found.collect()} == expected


def test_running_totals_of_any_double(spark, groups):
    chosen = {g: values for g, values in groups.items() if g < 12} | {100: [i / 7 for i in range(500)], 101: [math.nan, 1.0], 102: [None, 1 / 3, None]}
    for group_rows in (40,):
        found = previous_and_running(rows_of(spark, chosen), ["g"], ["i"], "v", group_rows=group_rows)
        for r in found.collect():
            values = [v for v in chosen[r.g][: r.i + 1] if v is not None]
            if r.g == 101:
                assert math.isnan(r.running_total)
            elif not values:
                assert r.running_total is None
            elif all(round(v, 9) == v and float(f"{v:.15g}") == v and abs(v) < 1e6 for v in values):
                assert r.running_total == float(sum(map(Decimal, map(repr, values))))
            else:
                assert r.running_total == nearest(values)


def test_totals_that_doubles_do_not_tell_apart_are_unequal(spark):
    left = spark.createDataFrame([(1e300,), (1.0,)], "v double")
    right = spark.createDataFrame([(1e300,), (2.0,)], "v double")
    assert not checks.measure_sum(left, right, {"v": "v"}).first()["passed"]
    assert checks.measure_sum(left, left.repartition(3), {"v": "v"}).first()["passed"]
    thirds = spark.createDataFrame([(1 / 300,), (1e21,)], "v double")
    report = checks.measure_sum(thirds, thirds, {"v": "v"}).first()
    assert report["passed"] and report["source_total"] == 1e21
    assert checks.measure_sum(left.where("v < 0"), left.where("v < 0"), {"v": "v"}).first()["passed"]
    assert not checks.measure_sum(left, left.where("v < 0"), {"v": "v"}).first()["passed"]


def test_a_running_total_is_dealt_once(spark):
    """One shuffle of the rows, by range; the windows over the ranges need none."""
    from compare import plan_of

    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id", (F.col("id") / 7).alias("v"))
    plan = plan_of(previous_and_running(df, ["g"], ["id"], "v"))
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Window" in plan


def test_totals_with_a_revenue_are_short_enough_for_the_jvm_to_compile(spark, capsys):
    """A method of more than 8000 bytes of code is interpreted, at several times the time."""
    from starkit.operators.facts import net_revenue

    df = spark.range(100).select((F.col("id") % 3).alias("g"), *[F.col("id").cast("double").alias(c) for c in ("units", "price", "discount")])
    sold = df.withColumn("net", net_revenue("units", "price", "discount"))
    measured = Sums(sold.schema, {"units": "units", "net": "net"})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        measured.combine(measured.states(sold, {"g": F.col("g")}), ["g"]).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(line.split("maxMethodCodeSize:")[1].split(";")[0]) for line in capsys.readouterr().out.splitlines() if "maxMethodCodeSize:" in line]
    assert sizes and max(sizes) < 8000


def test_values_at_the_edges_of_bins_and_of_decimals(spark):
    edges = [s * math.nextafter(2.0 ** (20 * k), to) for k in (-53, -2, 0, 1, 2, 3, 51) for to in (0.0, 1e308) for s in (1, -1)]
    edges += [2.0 ** (20 * k) for k in (-53, -1, 0, 2, 51)] + [0.1, 2.0**53, 999999999999.999, 123456.789012345, -0.0, 1 / 3]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(edges)] + [(-1, v) for v in edges[:28]], "g long, v double")
    found = {r["g"]: r["v"] for r in exact_sums(df, ["g"], {"v": "v"}).collect()}
    assert found == {-1: math.fsum(edges[:28]), **dict(enumerate(edges))}
