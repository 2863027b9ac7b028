"""Column expressions that dimensions and facts must agree on."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the data model.
UNKNOWN_KEY = -1
UNKNOWN_TEXT = "N/A"


def normalise(value: Column, trim: bool = False) -> Column:
    """The form of a text under which two spellings are the same member."""
    return F.upper(F.trim(value)) if trim else F.upper(value)


def any_null(values: list[Column]) -> Column:
    return reduce(or_, [value.isNull() for value in values])


def hash_key(values: list[Column], algorithm: str = "xxhash64", trim: bool = False) -> Column:
    """64-bit key of one or more texts, -1 if any of them is null.

    ``murmur3`` is the 32-bit ``hash`` widened to 64 bits; it collides at about 77,000 members.
    """
    parts = [normalise(value, trim) for value in values]
    if algorithm == "xxhash64":
        hashed = F.xxhash64(*parts)
    elif algorithm == "murmur3":
        hashed = F.hash(*parts).cast("bigint")
    else:
        raise ValueError(f"unknown hash algorithm {algorithm!r}")
    return F.when(any_null(values), F.lit(UNKNOWN_KEY).cast("bigint")).otherwise(hashed)


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as a 64-bit integer, -1 if null; integer arithmetic, no text."""
    number = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.coalesce(number, F.lit(UNKNOWN_KEY)).cast("bigint")


def semester(day: Column) -> Column:
    """Fall from August, Spring to May, Summer between."""
    month = F.month(day)
    return F.when(month >= 8, "Fall").when(month <= 5, "Spring").otherwise("Summer")


def is_fractional(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def unit_of(places: int) -> Column:
    """The unit of a last decimal place: 0.001 for three."""
    return F.lit(Decimal(1).scaleb(-places)).cast(T.DecimalType(places + 1, places))


def counted_in(value: Column, places: int, below: float) -> tuple[Column, Column]:
    """A double as a count of units of its last decimal place, and whether it is that decimal, with a count below ``below`` (2**53 at most).

    A quotient of two exact numbers is the double that is nearest to the decimal, so this is what a cast to a decimal and back would
    find, in a few operations on doubles.
    """
    unit = F.lit(10.0**places)
    count = F.rint(value * unit)
    return count, (F.abs(count) < F.lit(below)) & (count / unit == value)


#: Decimal places that a binary fraction may have where a measure states none.
SCALE = 18


def exact(column: Column, kind: T.DataType, scale: int | None = None, precision: int | None = None) -> Column:
    """A binary fraction as the decimal that it is written as, so that sums do not depend on the order of rows.

    ``scale`` is how many decimal places values have. Nothing is rounded: a value with more places, or too large, fails the query, as
    does NaN. Other types are left as they are.
    """
    if not is_fractional(kind):
        return column
    scale = SCALE if scale is None else scale
    precision = precision or (18 if scale <= 6 else 38)
    refused = F.raise_error(F.concat(F.lit(f"not exact with {scale} decimal places: "), column.cast("string")))
    if isinstance(kind, T.DoubleType) and precision <= 15:
        count, whole = counted_in(column, scale, 10.0**precision)
        decimal = (count.cast("bigint").cast("decimal(15,0)") * unit_of(scale)).cast(T.DecimalType(precision, scale))
        return F.when(column.isNull() | whole, decimal).otherwise(refused)
    decimal = column.try_cast(T.DecimalType(precision, scale))
    return F.when(column.isNull() | (decimal.cast(kind) == column), decimal).otherwise(refused)
