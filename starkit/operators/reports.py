"""Star joins: totals by dimension attributes, and detail rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.functions.sums import Sums
from starkit.operators.joins import Side, equal_on, to_dimensions
from starkit.operators.sizes import BROADCAST_BYTES, GROUP_ROWS, fits_broadcast_together


@dataclass(frozen=True)
class Attribute:
    """A column of a dimension, reached from a fact key."""

    dim: DataFrame
    fact_key: str
    column: str
    dim_key: str | None = None


def _sides(by: Mapping[str, Attribute]) -> list[Side]:
    """One side per dimension and fact key, however many attributes are taken from it."""
    grouped: dict[tuple, dict[str, Attribute]] = {}
    for out, a in by.items():
        grouped.setdefault((a.fact_key, id(a.dim), a.dim_key), {})[out] = a
    sides = []
    for (fact_key, _, dim_key), wanted in grouped.items():
        dim = next(iter(wanted.values())).dim
        named = [F.col(a.column).alias(out) for out, a in wanted.items()]
        sides.append(Side(dim.select(F.col(dim_key or fact_key).alias(f"_{fact_key}"), *named), {fact_key: f"_{fact_key}"}, list(wanted)))
    return sides


def totals(
    fact: DataFrame,
    by: Mapping[str, Attribute],
    measures: Mapping[str, str],
    where: Column | None = None,
    scales: Mapping[str, int] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Sums of ``measures`` (``output -> fact column``) by attributes (``output -> Attribute``).

    ``scales`` states the decimal places of measures that are binary fractions, by output; sums are exact (see ``Sums``). ``where`` is a
    condition on the output attributes; facts without a member fall out, as in an inner join.

    Dimensions that are measured to fit are broadcast, cut by ``where`` first if it only needs one of them, and the facts
    are summed by attribute inside the input tasks. If they do not fit, facts are summed by their keys before
    any join, so that neither the size of a dimension nor a hot key matters.
    """
    sides = [_renamed(side, place) for place, side in enumerate(_sides(by))]
    fits = fits_broadcast_together([side.dim for side in sides], broadcast_bytes)
    keys = {ours: f"_k{place}" for place, ours in enumerate(dict.fromkeys(ours for side in sides for ours in side.on))}
    sums = Sums(fact.schema, measures, scales)
    narrow = sums.states(fact, {key: F.col(ours) for ours, key in keys.items()})
    if not fits:
        narrow = sums.combine(narrow, list(keys.values()))
    for side in sides:
        dim = side.dim if where is None else _cut(side, where)
        joined = F.broadcast(dim) if fits else dim
        narrow = narrow.join(joined, equal_on(narrow, dim, {keys[ours]: theirs for ours, theirs in side.on.items()})).drop(
            *side.on.values()
        )
    if where is not None:
        narrow = narrow.where(where)
    return sums.finish(narrow, list(by))


def _renamed(side: Side, place: int) -> Side:
    """The side with a name for its key that no output has."""
    (ours, theirs), name = next(iter(side.on.items())), f"_dim{place}"
    return Side(side.dim.withColumnRenamed(theirs, name), {ours: name}, side.take)


def _cut(side: Side, where: Column) -> DataFrame:
    """The members that ``where`` leaves, if it is a condition on this side alone."""
    try:
        return side.dim.where(where)
    except AnalysisException:
        return side.dim


def detail(
    fact: DataFrame,
    by: Mapping[str, Attribute],
    keep: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Fact rows with attributes in place of keys: one inner join per dimension."""
    keyed = fact.select(*keep, *dict.fromkeys(a.fact_key for a in by.values()))
    return to_dimensions(keyed, _sides(by), "inner", broadcast_bytes, group_rows).select(*keep, *by)
