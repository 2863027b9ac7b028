"""Dimension tables: members, keys and the unknown member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkit.functions.keys import UNKNOWN_KEY, UNKNOWN_TEXT, date_key, hash_key, normalise, semester
from starkit.operators.numbering import dense_key, stable_key
from starkit.operators.windows import top_n
from starkit.session import stage


@dataclass(frozen=True)
class AttributeDim:
    """Dimension of one text column: ``source`` in the extract, ``target`` in the dimension.

    ``key`` names the key column in the dimension and in the fact.
    """

    source: str
    target: str
    key: str
    algorithm: str = "xxhash64"
    trim: bool = False


@dataclass(frozen=True)
class CompositeDim:
    """Dimension of several columns (``source -> target``), found in facts by all of them.

    ``algorithm`` is that of its keys where they are hashes.
    """

    key: str
    columns: Mapping[str, str] = field(default_factory=dict)
    algorithm: str = "xxhash64"

    @property
    def natural(self) -> list[str]:
        return list(self.columns.values())


def unknown_member(df: DataFrame, key: str) -> DataFrame:
    """One row in the schema of ``df``: key -1, texts ``N/A``, all else null."""
    cells = []
    for column in df.schema.fields:
        if column.name == key:
            value = F.lit(UNKNOWN_KEY)
        elif isinstance(column.dataType, T.StringType):
            value = F.lit(UNKNOWN_TEXT)
        else:
            value = F.lit(None)
        cells.append(value.cast(column.dataType).alias(column.name))
    return df.sparkSession.range(0, 1, 1, 1).select(*cells)


def with_unknown(df: DataFrame, key: str) -> DataFrame:
    return df.unionByName(unknown_member(df, key))


def without_unknown(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key) != UNKNOWN_KEY)


def _least_spelling(values: DataFrame, text: Column, trim: bool, *within: str) -> DataFrame:
    # Spellings that differ in case only are one member, shown by the least spelling. The input is
    # distinct already, by a hash aggregate; taking the first row keeps it so, where a minimum of
    # texts would let Spark drop the distinct and sort the whole extract.
    spelled = values.select(*within, text.alias("member"), normalise(text, trim).alias("_same"))
    return top_n(spelled, [*within, "_same"], [F.col("member")], 1).drop("_same")


def _dimension(members: DataFrame, spec: AttributeDim, kind: T.DataType) -> DataFrame:
    member = F.col("member")
    keyed = members.select(
        member.cast(kind).alias(spec.target), hash_key([member], spec.algorithm, spec.trim).alias(spec.key)
    )
    return with_unknown(keyed, spec.key)


def attribute_dimension(extract: DataFrame, spec: AttributeDim) -> DataFrame:
    """Hash-keyed dimension of one column, with its unknown member; nulls are not members."""
    text = F.col(spec.source)
    values = extract.select(text).where(text.isNotNull()).distinct()
    return _dimension(_least_spelling(values, text, spec.trim), spec, extract.schema[spec.source].dataType)


def dimension_values(extract: DataFrame, groups: Sequence[Sequence[str]]) -> DataFrame:
    """The distinct combinations of each group of columns, one group below the other, with nulls in the columns of other groups.

    Dimensions whose columns are all in one group are the same from these rows as from the extract, as nulls are no members. Each group
    is made distinct within the input tasks.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [extract.select(*group).distinct() for group in groups])


def star_dimensions(
    extract: DataFrame, specs: Sequence[AttributeDim], date_column: str | None = None, date_key_name: str = "DateKey"
) -> dict[str, DataFrame]:
    """All attribute dimensions of an extract, and its calendar, from a single pass over it; by key name.

    Every row is turned into one ``(attribute, value)`` pair per column, and the pairs are made
    distinct within the input tasks before anything is shuffled. Dates take part by year.
    """
    trims = {spec.trim for spec in specs}
    if len(trims) > 1:
        raise ValueError("specs of one pass must agree on trim")
    columns = {spec.source: F.col(spec.source).cast("string") for spec in specs}
    if date_column:
        columns[date_column] = F.year(date_column).cast("string")
    values = (
        extract.select(*[value.alias(name) for name, value in columns.items()])
        .unpivot([], list(columns), "attribute", "value")
        .where(F.col("value").isNotNull())
        .distinct()
    )
    members = stage(_least_spelling(values, F.col("value"), trims.pop(), "attribute"), "members")
    built = {
        spec.key: _dimension(members.where(F.col("attribute") == spec.source), spec, extract.schema[spec.source].dataType)
        for spec in specs
    }
    if date_column:
        year = F.col("member").cast("int")
        years = members.where(F.col("attribute") == date_column).agg(F.min(year).alias("low"), F.max(year).alias("high"))
        built[date_key_name] = _calendar(years, date_key_name)
    return built


def composite_members(extract: DataFrame, spec: CompositeDim) -> DataFrame:
    """Distinct combinations without those that hold a null, which no equality could find."""
    return extract.select(*[F.col(old).alias(new) for old, new in spec.columns.items()]).distinct().dropna("any")


def composite_dimension(
    extract: DataFrame, spec: CompositeDim, strategy: str = "dense", existing: DataFrame | None = None
) -> DataFrame:
    """Dimension of several columns with its unknown member.

    ``dense`` numbers members in natural order, ``stable`` keeps the keys of ``existing`` and
    numbers the rest, ``xxhash64`` and ``murmur3`` hash the normalised columns.
    """
    members = composite_members(extract, spec)
    if strategy == "stable" and existing is not None:
        return stable_key(existing, members, spec.natural, spec.key)
    if strategy in ("dense", "stable"):
        return with_unknown(dense_key(members, spec.natural, spec.key), spec.key)
    same = [f"_{c}" for c in spec.natural]
    spelled = members.withColumns({name: normalise(F.col(c)) for name, c in zip(same, spec.natural)})
    shown = top_n(spelled, same, [F.col(c) for c in spec.natural], 1).drop(*same)
    return with_unknown(shown.withColumn(spec.key, hash_key([F.col(c) for c in spec.natural], strategy)), spec.key)


def dimension_from_source(source: DataFrame, natural: Sequence[str], drop: Sequence[str], key: str) -> DataFrame:
    """A source table as a dimension: its own id dropped, a dense key in natural order added.

    Rows without a natural key are no members. Repeated natural keys are kept here and reported by ``checks.duplicates``.
    """
    kept = source.drop(*drop).dropna("any", subset=list(natural))
    others = [c for c in kept.columns if c not in natural]
    return with_unknown(dense_key(kept, [*natural, *others], key), key)


def custom_mapping_dimension(mapping: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """A table of labels per combination of attributes, keyed densely in natural order."""
    return dimension_from_source(mapping, natural, [], key)


def date_dimension(extract: DataFrame, column: str, key: str = "DateKey") -> DataFrame:
    """Every day from the first year to the last year of ``column``, with the unknown member.

    The bounds stay inside the plan: one aggregate row becomes one row per day.
    """
    year = F.year(column)
    return _calendar(extract.agg(F.min(year).alias("low"), F.max(year).alias("high")), key)


def _calendar(years: DataFrame, key: str) -> DataFrame:
    first_day = F.make_date("low", F.lit(1), F.lit(1))
    last_day = F.make_date("high", F.lit(12), F.lit(31))
    days = years.select(F.explode(F.sequence(first_day, last_day, F.expr("interval 1 day"))).alias("Date"))
    day = F.col("Date")
    calendar = days.select(
        date_key(day).alias(key),
        day,
        F.date_format(day, "MMMM").alias("MonthName"),
        F.year(day).alias("Year"),
        F.quarter(day).alias("Quarter"),
        semester(day).alias("Semester"),
    )
    return with_unknown(calendar, key)
