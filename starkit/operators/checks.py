"""Checks on dimensions and facts. Each returns a DataFrame; reports hold a ``passed`` column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkit.functions.keys import UNKNOWN_KEY, normalise
from starkit.functions.sums import Sums
from starkit.session import stage


#: Failed rows that an error shows.
SHOWN = 20


class CheckFailed(AssertionError):
    """A check found rows that break its rule."""


def require(report: DataFrame) -> None:
    """Raise unless every row of a report has passed; the message shows some failed rows and says how many there are."""
    failed = report.where(~F.col("passed"))
    shown = failed.take(SHOWN)
    if shown:
        more = failed.count() - len(shown) if len(shown) == SHOWN else 0
        raise CheckFailed("; ".join(str(row.asDict()) for row in shown) + (f"; and {more} more" if more else ""))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations held by more than one row; rows are counted, whatever is null in them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def mapping_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-row report on ``duplicates``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    report = per_key.agg(F.count(F.lit(1)).alias("combinations"), F.count_if(F.col("n") > 1).alias("duplicated"))
    return report.withColumn("passed", F.col("duplicated") == 0)


def require_unique(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> None:
    """Raise if any table ``name -> (table, keys)`` repeats a key; all are checked in one job."""
    reports = [mapping_unique(df, keys).withColumn("keys_of", F.lit(name)) for name, (df, keys) in tables.items()]
    require(reduce(DataFrame.unionByName, reports))


def key_collision(dims: Mapping[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """One row per dimension ``name -> (dimension, key, attributes)``: keys that different members share.

    The unknown member counts, so a real member that was given its key is found too.
    """
    members = [
        dim.select(
            F.lit(name).alias("dimension"),
            F.col(key).cast("bigint").alias("key"),
            F.array(*[normalise(F.col(c)) for c in attributes]).alias("member"),
        )
        for name, (dim, key, attributes) in dims.items()
    ]
    per_key = (
        reduce(DataFrame.unionByName, members).distinct().groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("n"))
    )
    report = per_key.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("collisions")
    )
    return report.withColumn("passed", F.col("collisions") == 0)


def unmatched(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key is not in the dimension (a null key never is)."""
    return fact.join(dim.select(F.col(dim_key or key).alias(key)), key, "left_anti")


def referential(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per fact key ``key -> (dimension, its key column)``: rows and unmatched rows.

    All keys are counted in one pass over the fact, before anything is joined. An empty fact has a row for each key too.
    """
    keys = list(dims)
    counted = (
        fact.select(*[F.col(k).cast("bigint").alias(k) for k in keys])
        .unpivot([], keys, "key_column", "key_value")
        .groupBy("key_column", "key_value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    members = [
        dim.select(
            F.lit(key).alias("key_column"), F.col(dim_key).cast("bigint").alias("key_value"), F.lit(True).alias("known")
        )
        for key, (dim, dim_key) in dims.items()
    ]
    known = reduce(DataFrame.unionByName, members).distinct()
    every = fact.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.array(*[F.lit(k) for k in keys])).alias("key_column"),
        F.lit(None).cast("bigint").alias("key_value"), F.lit(0).cast("bigint").alias("n"),
    )
    counted = counted.unionByName(every)
    missing = F.when(F.col("known").isNull(), F.col("n")).otherwise(0)
    return (
        counted.join(known, ["key_column", "key_value"], "left")
        .groupBy("key_column")
        .agg(F.sum("n").alias("fact_rows"), F.sum(missing).alias("unmatched_rows"))
        .withColumn("passed", F.col("unmatched_rows") == 0)
    )


def row_count(source: DataFrame, fact: DataFrame) -> DataFrame:
    """One-row report: as many facts as source rows."""
    sides = source.select(F.lit(1).alias("s"), F.lit(0).alias("f")).unionAll(
        fact.select(F.lit(0).alias("s"), F.lit(1).alias("f"))
    )
    return sides.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"), F.coalesce(F.sum("f"), F.lit(0)).alias("fact_rows")
    ).withColumn("passed", F.col("source_rows") == F.col("fact_rows"))


def measure_sum(
    source: DataFrame,
    fact: DataFrame,
    measures: Mapping[str, str],
    scales: Mapping[str, int] | None = None,
    tolerance: float = 0,
) -> DataFrame:
    """One row per measure ``source column -> fact column``: equal totals on both sides.

    Totals are compared as they truly are and shown as doubles: as decimals where both sides are written with a limited number of places (see
    ``Sums``), else as sums of binary fractions. ``scales`` states decimal places by source column; ``tolerance`` allows totals to
    differ by so much.
    """
    names = {ours: f"_m{i}" for i, ours in enumerate(measures)}

    def totals(df: DataFrame, columns: Mapping[str, str], side: str) -> DataFrame:
        stated = {names[ours]: places for ours, places in (scales or {}).items()}
        sums = Sums(df.schema, {names[ours]: c for ours, c in columns.items()}, stated)
        found = sums.finish(sums.states(df, {}), [], text="")
        rows = [
            F.struct(
                F.lit(measures[ours]).alias("measure"), F.col(name).alias("total"), F.col(f"{name}_written").alias("written"),
                (F.col(f"{name}_binary") if f"{name}_binary" in found.columns else F.lit(None).cast("string")).alias("binary"),
            )
            for ours, name in names.items()
        ]
        return found.select(F.explode(F.array(*rows)).alias("r")).select("r.measure", F.col("r").alias(side))

    both = totals(source, {c: c for c in measures}, "_source").join(totals(fact, measures, "_fact"), "measure")
    as_written = F.col("_source.written").isNotNull() & F.col("_fact.written").isNotNull()
    empty = F.col("_source.total").isNull() & F.col("_fact.total").isNull()
    binary = F.coalesce(F.col("_source.binary") == F.col("_fact.binary"), F.lit(False))
    same = F.when(as_written, F.col("_source.written") == F.col("_fact.written")).otherwise(empty | binary)
    if tolerance:
        wide = "decimal(38,18)"
        apart = F.when(as_written, F.abs(F.col("_source.written").try_cast(wide) - F.col("_fact.written").try_cast(wide)).cast("double"))
        apart = F.coalesce(apart, F.abs(F.col("_source.total") - F.col("_fact.total")))
        same = same | F.coalesce(apart <= F.lit(tolerance), F.lit(False))
    shown = [F.col("_source.total").alias("source_total"), F.col("_fact.total").alias("fact_total")]
    return both.select("measure", *shown, same.alias("passed"))


def bag_difference(source: DataFrame, fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that the two sides do not hold equally often, with how often each side lacks them.

    Both directions come from one signed count, combined before the only shuffle.
    """
    sides = source.select(*columns, F.lit(1).alias("_sign")).unionByName(
        fact.select(*columns, F.lit(-1).alias("_sign"))
    )
    return (
        sides.groupBy(*columns)
        .agg(F.sum("_sign").alias("_balance"))
        .where(F.col("_balance") != 0)
        .select(
            *columns,
            F.greatest(F.col("_balance"), F.lit(0)).alias("missing_in_fact"),
            F.greatest(-F.col("_balance"), F.lit(0)).alias("extra_in_fact"),
        )
    )


def null_keys(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key column: how many keys are null."""
    nulls = fact.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    return nulls.unpivot([], list(keys), "key_column", "null_rows").withColumn("passed", F.col("null_rows") == 0)


def unknown_keys(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key column: facts that point to the unknown member."""
    unknown = fact.agg(*[F.count_if(F.col(k) == UNKNOWN_KEY).alias(k) for k in keys])
    return unknown.unpivot([], list(keys), "key_column", "unknown_rows")


def measure_range(fact: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """One row per rule ``name -> condition of a bad row``."""
    counted = fact.agg(*[F.count_if(bad).alias(name) for name, bad in violations.items()])
    return counted.unpivot([], list(violations), "rule", "bad_rows").withColumn("passed", F.col("bad_rows") == 0)


# --- comparisons that move little ----------------------------------------------------------------


def _fingerprints(df: DataFrame, columns: Sequence[str], place: Column, side: str) -> DataFrame:
    """Row count, and sum and xor of row hashes, of each range: the same for the same rows in any order."""
    values = F.xxhash64(*columns)
    # halves, so that a sum of them fits a long for 2**31 rows of one range and one task
    halves = {"low": F.pmod(values, F.lit(1 << 32)), "high": F.shiftright(values, 32)}
    hashed = df.select(place.alias("_place"), values.alias("_value"), *[half.alias(f"_{name}") for name, half in halves.items()])
    return hashed.groupBy("_place").agg(
        F.struct(F.count(F.lit(1)), F.sum("_low"), F.sum("_high"), F.bit_xor("_value")).alias(side)
    )


def range_difference(
    source: DataFrame, fact: DataFrame, columns: Sequence[str], key: Sequence[str], ranges: int = 4096, levels: int = 2
) -> DataFrame:
    """``bag_difference``, moving only rows of ranges that differ.

    Rows are in ``ranges`` ranges by a hash of ``key``. Each side makes one fingerprint of each range (count, sum and xor of row hashes);
    ranges with different fingerprints are cut into ``ranges`` finer ones, ``levels`` times in all, and rows of the finest ones that
    differ are compared themselves. Equal sides move one row for each range and input task. Rows that differ are missed only if two different bags of
    a range have equal fingerprints, 128 bits. ``key`` should be columns that both sides hold alike; rows whose keys differ are found all the same.

    Both sides are read once for each level and, if they differ, once more.
    """
    left, right = source.select(*columns), fact.select(*columns)
    for name in columns:
        if left.schema[name].dataType != right.schema[name].dataType:
            raise ValueError(f"{name} is {left.schema[name].dataType.simpleString()} here and {right.schema[name].dataType.simpleString()} there")
    left, right = _canonical(left), _canonical(right)
    place, differing = F.lit(0).cast("bigint"), None
    for level in range(levels):
        finer = F.pmod(F.xxhash64(F.lit(level), *key), F.lit(ranges))
        place = place * ranges + finer
        sides = []
        for df, side in ((left, "_source"), (right, "_fact")):
            here = df if differing is None else _within(df, differing, coarser)
            sides.append(_fingerprints(here, columns, place, side))
        both = sides[0].join(sides[1], "_place", "full")
        differing = stage(both.where(~F.col("_source").eqNullSafe(F.col("_fact"))).select("_place"), "differing-ranges")
        if differing.isEmpty():
            return bag_difference(left.where(F.lit(False)), right.where(F.lit(False)), columns)
        coarser = place
    return bag_difference(_within(left, differing, place), _within(right, differing, place), columns)


def _canonical(df: DataFrame) -> DataFrame:
    """Rows that grouping holds equal have equal hashes: 0.0 and -0.0 are one value, and so are all NaN."""
    fractions = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(F.col(c) == 0, F.lit(0.0).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in fractions})


def _within(df: DataFrame, places: DataFrame, place: Column) -> DataFrame:
    """Rows of the ranges that are listed; Spark broadcasts the list where it is small, as it is written."""
    return df.withColumn("_place", place).join(places, "_place", "left_semi").drop("_place")


def referential_by_bitmaps(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``referential`` for whole-number keys, moving bitmaps of distinct keys in place of keys.

    Keys are bits of maps of 32,768 keys each, made in the input tasks on either side, so a dense key costs a bit, however many facts have it. A map of the
    fact that adds no bit to the dimension's holds no unmatched key. Only the rows of keys in other maps are counted key by key.
    """
    keys = list(dims)

    def maps(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
        rows = df.select(*[F.col(c).cast("bigint").alias(k) for k, c in columns.items()]).unpivot([], list(columns), "key_column", "key_value")
        placed = rows.select(
            "key_column", F.bitmap_bucket_number("key_value").alias("bucket"), F.bitmap_bit_position("key_value").alias("bit"),
            F.col("key_value").isNull().alias("is_null"),
        )
        return placed.groupBy("key_column", "bucket").agg(
            F.bitmap_construct_agg("bit").alias("bits"), F.count(F.lit(1)).alias("n"), F.count_if("is_null").alias("nulls")
        )

    ours = maps(fact, {k: k for k in keys})
    theirs = [maps(dim.where(F.col(dim_key).isNotNull()), {key: dim_key}) for key, (dim, dim_key) in dims.items()]
    count_of = F.bitmap_count("bits")
    none = F.lit(0).cast("bigint")
    sides = ours.withColumn("held", none).unionByName(
        reduce(DataFrame.unionByName, theirs).withColumns({"held": count_of, "n": none, "nulls": none})
    )
    united = sides.groupBy("key_column", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"), F.sum("held").alias("held"), F.sum("n").alias("n"), F.sum("nulls").alias("nulls")
    )
    judged = stage(united.select("key_column", "bucket", "n", "nulls", (F.col("all") > F.col("held")).alias("_extra")), "judged-maps")
    counted = judged.groupBy("key_column").agg(F.sum("n").alias("fact_rows"), F.sum("nulls").alias("_nulls"))
    doubtful = judged.where("_extra").select(F.col("key_column").alias("_key"), F.col("bucket").alias("_bucket"))
    some = {row["_key"] for row in doubtful.select("_key").distinct().collect()}
    every = fact.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(k) for k in keys])).alias("key_column"))
    unmatched_rows = F.coalesce(F.col("_nulls"), F.lit(0))
    report = every.join(counted, "key_column", "left")
    if some:
        # keys of the maps in doubt, against the members one by one
        parts = []
        for key in sorted(some):
            dim, dim_key = dims[key]
            here = doubtful.where(F.col("_key") == key).select("_bucket")
            rows = fact.select(F.col(key).cast("bigint").alias("key_value")).where(F.col("key_value").isNotNull())
            found = rows.join(here, F.bitmap_bucket_number("key_value") == F.col("_bucket"), "left_semi").groupBy("key_value").count()
            missing = found.join(dim.select(F.col(dim_key).cast("bigint").alias("key_value")), "key_value", "left_anti")
            parts.append(missing.agg(F.lit(key).alias("key_column"), F.sum("count").alias("_missing")))
        report = report.join(reduce(DataFrame.unionByName, parts), "key_column", "left")
        unmatched_rows = unmatched_rows + F.coalesce(F.col("_missing"), F.lit(0))
    report = report.select("key_column", F.coalesce("fact_rows", F.lit(0)).alias("fact_rows"), unmatched_rows.alias("unmatched_rows"))
    return report.withColumn("passed", F.col("unmatched_rows") == 0)
