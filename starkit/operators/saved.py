"""A star that is written once, laid out for its joins, and read by checks and reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.functions.keys import UNKNOWN_KEY
from starkit.operators import checks, reports
from starkit.operators.joins import Side, equal_on, to_dimensions
from starkit.operators.reports import Attribute
from starkit.operators.sizes import BROADCAST_BYTES, GROUP_ROWS, fits_broadcast, hot_groups
from starkit.session import stage
from starkit.sources.versions import VersionedTables

#: The fact is two tables: rows of hot keys, which no bucket could hold, are kept apart.
FACT, HOT, STAR = "fact", "fact_of_hot_keys", "star"


@dataclass(frozen=True)
class SavedStar:
    """A star as it was at one version of each of its tables.

    ``fact`` is in buckets of ``bucket_key``, and so is the dimension of that key. ``hot`` has the facts whose ``bucket_key`` is frequent, -1 or null, in
    files without buckets. ``dims`` are the dimensions by fact key, each with the name of its own key.
    """

    fact: DataFrame
    hot: DataFrame
    dims: Mapping[str, tuple[DataFrame, str]]
    bucket_key: str

    @property
    def facts(self) -> DataFrame:
        """All facts; each is read once."""
        return self.fact.unionByName(self.hot)

    def attribute(self, fact_key: str, column: str) -> Attribute:
        dim, dim_key = self.dims[fact_key]
        return Attribute(dim, fact_key, column, dim_key)

    def totals(
        self,
        by: Mapping[str, tuple[str, str]],
        measures: Mapping[str, str],
        where: Column | None = None,
        scales: Mapping[str, int] | None = None,
        broadcast_bytes: int = BROADCAST_BYTES,
    ) -> DataFrame:
        """``reports.totals`` by ``output -> (fact key, column of its dimension)``. Facts are summed where they lie, whatever the dimensions' size."""
        attributes = {out: self.attribute(*place) for out, place in by.items()}
        return reports.totals(self.facts, attributes, measures, where, scales, broadcast_bytes)

    def detail(self, by: Mapping[str, tuple[str, str]], keep: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """``reports.detail``. Facts meet the dimension of the bucket key in their buckets, where it is not small enough to be broadcast."""
        dim, dim_key = self.dims[self.bucket_key]
        near = {out: column for out, (key, column) in by.items() if key == self.bucket_key}
        others = {out: self.attribute(*place) for out, place in by.items() if place[0] != self.bucket_key}
        if not near or fits_broadcast([dim], broadcast_bytes)[0]:
            attributes = {out: self.attribute(*place) for out, place in by.items()}
            return reports.detail(self.facts, attributes, keep, broadcast_bytes)
        keys = dict.fromkeys(a.fact_key for a in others.values())
        named = dim.select(F.col(dim_key).alias("_member"), *[F.col(c).alias(out) for out, c in near.items()])
        taken = [*dict.fromkeys([*keep, *keys]), *near]
        fact = self.fact.join(named, self.fact[self.bucket_key] == named["_member"]).select(*taken)
        # the members of hot keys are as few as hot keys are; they are found by their keys
        few = stage(named.join(F.broadcast(self.hot.select(self.bucket_key).distinct()), F.col(self.bucket_key) == F.col("_member"), "left_semi"), "hot-members")
        hot = to_dimensions(self.hot, [Side(few, {self.bucket_key: "_member"}, list(near))], "inner", broadcast_bytes).select(*taken)
        both = fact.unionByName(hot)
        if not others:
            return both.select(*keep, *by)
        rest = reports.detail(both, others, [*keep, *near], broadcast_bytes)
        return rest.select(*keep, *by)

    def referential(self) -> DataFrame:
        return checks.referential(self.facts, self.dims)

    def profile(self, rules: Mapping[str, Column] | None = None) -> DataFrame:
        """Row count, null keys, unknown keys and rows that break rules, all in one aggregate over the saved facts.

        Rows (check, subject, bad_rows, passed). Unknown keys are shown and never fail.
        """
        keys = list(self.dims)
        counts = {("rows", "fact"): F.count(F.lit(1))}
        counts |= {("null key", k): F.count_if(F.col(k).isNull()) for k in keys}
        counts |= {("unknown key", k): F.count_if(F.col(k) == UNKNOWN_KEY) for k in keys}
        counts |= {("rule", name): F.count_if(bad) for name, bad in (rules or {}).items()}
        counted = self.facts.agg(*[count.alias(f"_c{i}") for i, count in enumerate(counts.values())])
        rows = [
            F.struct(F.lit(check).alias("check"), F.lit(subject).alias("subject"), F.col(f"_c{i}").alias("counted"))
            for i, (check, subject) in enumerate(counts)
        ]
        shown = counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        return shown.withColumn("passed", F.col("check").isin("rows", "unknown key") | (F.col("counted") == 0))


def save_star(
    tables: VersionedTables,
    fact: DataFrame,
    dims: Mapping[str, tuple[DataFrame, str]],
    bucket_key: str | None = None,
    buckets: int | None = None,
    group_rows: int = GROUP_ROWS,
    stored: bool = False,
    key_alone: Callable[[str], DataFrame] | None = None,
) -> SavedStar:
    """Writes the fact and its dimensions (``fact key -> (dimension, its key)``) and reads them back.

    The fact is bucketed by the key of the dimension with the most members, or ``bucket_key``. Facts of keys with more than ``group_rows`` rows, of the unknown
    member and of no key are written apart, as their bucket would be one task's. Every other table is written as it is. What was written is
    listed in a table STAR at the end, so a reader has the tables of one writing, the old or the new ones.

    The fact is staged first, as it is read three times: its bucket key, and the rows of either table. ``stored`` says that it is a plan over stored tables which
    gives the same rows each time, so it need not be; then the rows of the other table are left out before they are keyed, where the bucket key comes without a
    lookup. ``key_alone`` gives the column of a key, a row for each fact, by a shorter plan than the fact's.
    """
    spark = fact.sparkSession
    if bucket_key is None:
        sizes = [dim.select(F.lit(key).alias("key")) for key, (dim, _) in dims.items()]
        found = reduce(DataFrame.unionByName, sizes).groupBy("key").count().collect()
        bucket_key = max(found, key=lambda row: (row["count"], row["key"]))["key"] if found else next(iter(dims))
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    versions = {}
    for key, (dim, dim_key) in dims.items():
        if key == bucket_key:
            versions[key] = tables.save(dim.repartition(buckets, dim_key), key, bucket=(dim_key, buckets))
        else:
            versions[key] = tables.save(dim, key)
    if not stored:
        fact = stage(fact, "facts")
    alone = key_alone(bucket_key) if key_alone else fact.select(bucket_key)
    frequent = hot_groups(alone, [bucket_key], group_rows).select(F.col(bucket_key).alias("_hot"))
    kind = fact.schema[bucket_key].dataType
    others = spark.range(0, 1, 1, 1).select(F.explode(F.array(F.lit(UNKNOWN_KEY).cast(kind), F.lit(None).cast(kind))).alias("_hot"))
    # at most rows / group_rows keys, and two
    apart = F.broadcast(stage(frequent.unionAll(others), "hot-keys"))
    is_apart = equal_on(fact, apart, {bucket_key: "_hot"}, null_safe=True)
    versions[HOT] = tables.save(fact.join(apart, is_apart, "left_semi"), HOT)
    placed = fact.join(apart, is_apart, "left_anti").repartition(buckets, bucket_key)
    versions[FACT] = tables.save(placed, FACT, bucket=(bucket_key, buckets))
    rows = [(name, version, dims[name][1] if name in dims else None, name == bucket_key) for name, version in versions.items()]
    number = tables.save(spark.createDataFrame(rows, "name string, version long, dim_key string, is_bucket_key boolean").coalesce(1), STAR)
    return open_star(tables, number)


def open_star(tables: VersionedTables, version: int | None = None) -> SavedStar:
    """A saved star, in any session: the newest one, or the one of a version of STAR."""
    written = {row["name"]: row for row in tables.load(STAR, version).collect()}
    loaded = {name: tables.load(name, row["version"]) for name, row in written.items()}
    dims = {name: (loaded[name], row["dim_key"]) for name, row in written.items() if row["dim_key"]}
    bucket_key = next(name for name, row in written.items() if row["is_bucket_key"])
    return SavedStar(loaded[FACT], loaded[HOT], dims, bucket_key)
