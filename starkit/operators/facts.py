"""Fact tables: cleaning, measures and keys in place of attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkit.functions.keys import UNKNOWN_KEY, date_key, exact, hash_key
from starkit.operators.checks import require_unique
from starkit.operators.dims import AttributeDim, CompositeDim, without_unknown
from starkit.operators.joins import Side, to_dimensions
from starkit.operators.sizes import BROADCAST_BYTES, GROUP_ROWS


@dataclass(frozen=True)
class FillNull:
    """Replace nulls of a column."""

    column: str
    value: object

    def touches(self, current: Column) -> Column:
        return current.isNull()


@dataclass(frozen=True)
class RaiseTo:
    """Replace values below a floor by the floor; nulls stay null."""

    column: str
    floor: float

    def touches(self, current: Column) -> Column:
        return current < F.lit(self.floor)


def _apply(rule: FillNull | RaiseTo, current: Column) -> Column:
    if isinstance(rule, FillNull):
        return F.coalesce(current, F.lit(rule.value))
    return F.when(current < F.lit(rule.floor), F.lit(rule.floor)).otherwise(current)


def _fitting(rule: FillNull | RaiseTo, kind: T.DataType) -> None:
    """Refuse a value that the type of its column would change."""
    value = rule.value if isinstance(rule, FillNull) else rule.floor
    if isinstance(kind, T.IntegralType) and value != int(value):
        raise ValueError(f"{value!r} is no {kind.simpleString()} for {rule.column}")
    if isinstance(kind, T.DecimalType) and round(Decimal(str(value)), kind.scale) != Decimal(str(value)):
        raise ValueError(f"{value!r} is no {kind.simpleString()} for {rule.column}")


def clean(fact: DataFrame, rules: Sequence[FillNull | RaiseTo]) -> DataFrame:
    """Apply the rules, in order, in one projection; column types do not change, and a value that does not fit its type is refused."""
    changed: dict[str, Column] = {}
    for rule in rules:
        _fitting(rule, fact.schema[rule.column].dataType)
        changed[rule.column] = _apply(rule, changed.get(rule.column, F.col(rule.column)))
    return fact.withColumns({name: value.cast(fact.schema[name].dataType) for name, value in changed.items()})


def rule_counts(fact: DataFrame, rules: Sequence[FillNull | RaiseTo]) -> DataFrame:
    """How many rows each rule changes, in order, all counted in one pass; repeated rules of one kind on a column are numbered."""
    current: dict[str, Column] = {}
    counts: dict[str, Column] = {}
    for rule in rules:
        before = current.get(rule.column, F.col(rule.column))
        name = f"{type(rule).__name__}({rule.column})"
        number = sum(other == name or other.startswith(f"{name}#") for other in counts)
        counts[f"{name}#{number + 1}" if number else name] = F.count_if(rule.touches(before))
        current[rule.column] = _apply(rule, before)
    counted = fact.agg(*[count.alias(name) for name, count in counts.items()])
    return counted.unpivot([], [F.col(f"`{name}`") for name in counts], "rule", "touched_rows")


#: Digits and decimal places of units and price; places of the discount in percent. Their product fits a decimal of 38 digits.
UNITS, PRICE, DISCOUNT_PLACES = (14, 3), (15, 6), 3


def net_revenue(units: str, price: str, discount: str) -> Column:
    """units x price x (1 - discount percent / 100), exact: decimal(38,14).

    Units may have three decimal places, prices six, discounts three; what has more fails the query, as do units from 1e11 and prices from 1e9 on.
    """
    decimal = lambda name, digits, places: exact(F.col(name).cast("double"), T.DoubleType(), places, digits)
    percent = decimal(discount, DISCOUNT_PLACES + 3, DISCOUNT_PLACES)
    share = (F.lit(1) - percent * F.lit("0.01").cast("decimal(2,2)")).cast(T.DecimalType(7, DISCOUNT_PLACES + 2))
    return decimal(units, *UNITS) * decimal(price, *PRICE) * share


def net_revenue_of_doubles(units: str, price: str, discount: str) -> Column:
    """units x price x (1 - discount percent / 100) of any numbers, as a double: each operation rounds once, in this order.

    A row's value depends on the row alone; ``Sums`` adds such values up exactly, so totals do not depend on the order of rows either.
    """
    number = lambda name: F.col(name).cast("double")
    return number(units) * number(price) * (F.lit(1.0) - number(discount) / F.lit(100.0))


def key_by_hash(
    fact: DataFrame, specs: Sequence[AttributeDim | CompositeDim], dates: Mapping[str, str] | None = None
) -> DataFrame:
    """Replace attributes, or combinations of them, by their hash keys and dates by ``yyyymmdd`` in one projection: no join.

    A combination has the key that ``composite_dimension`` with the strategy of its ``algorithm`` gives its member, whatever
    the spelling.
    """
    sources = {s.key: list(s.columns) if isinstance(s, CompositeDim) else [s.source] for s in specs}
    keys = {
        s.key: hash_key([F.col(c) for c in sources[s.key]], s.algorithm, isinstance(s, AttributeDim) and s.trim) for s in specs
    }
    keys.update({key: date_key(F.col(column)) for column, key in (dates or {}).items()})
    return fact.withColumns(keys).drop(*[c for columns in sources.values() for c in columns], *(dates or {}))


@dataclass(frozen=True)
class Lookup:
    """Find ``key`` in ``dim`` by its natural key (``fact column -> dimension column``)."""

    dim: DataFrame
    on: Mapping[str, str]
    key: str


def composite_lookup(spec: CompositeDim, dim: DataFrame) -> Lookup:
    return Lookup(dim, spec.columns, spec.key)


def key_by_lookup(
    fact: DataFrame,
    lookups: Sequence[Lookup],
    check_unique: bool = True,
    drop_attributes: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Replace attributes by the keys of the members that hold them, -1 where there is none.

    The unknown member is left out of the search, so a fact that literally says ``N/A`` is not
    matched twice. A dimension that repeats a natural key is refused, as it would repeat facts;
    ``check_unique`` may be off for dimensions built by ``composite_dimension``.
    """
    known = {found.key: without_unknown(found.dim, found.key) for found in lookups}
    if check_unique:
        require_unique({found.key: (known[found.key], list(found.on.values())) for found in lookups})
    sides = [Side(known[found.key], found.on, [found.key]) for found in lookups]
    joined = to_dimensions(fact, sides, "left", broadcast_bytes, group_rows)
    unknown = F.lit(UNKNOWN_KEY).cast("bigint")
    keyed = joined.withColumns({key: F.coalesce(F.col(key), unknown) for key in known})
    attributes = dict.fromkeys(column for found in lookups for column in found.on)
    return keyed.drop(*attributes) if drop_attributes else keyed
