"""Exact sums of binary fractions: a superaccumulator of built-in functions.

A finite double is a whole number of 53 bits times a power of two. It is cut into pieces of DIGIT_BITS bits that lie on a grid of bins, the same for all
values, by scaling with powers of two, which is exact. Pieces are whole numbers, so sums over a bin depend neither on the order of
rows nor on how they are combined, and there is a single rounding at the end, to the nearest double and of two equally near ones to the even one, as in
``math.fsum``. No value is refused and none is rounded before that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkit.functions.keys import counted_in, exact, is_fractional, unit_of

#: Bits of a piece. A sum of pieces fits a long for 2**43 values of one magnitude in one group; beyond that ANSI arithmetic fails the query.
DIGIT_BITS = 20
#: Pieces that the 53 bits of a value may touch.
PIECES = 4
_BASE = 1 << DIGIT_BITS
#: Bins of the smallest and the largest double.
LOWEST, HIGHEST = -1074 // DIGIT_BITS, 1023 // DIGIT_BITS


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _left(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits)


def _right(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def _power(exponent: Column) -> Column:
    """A power of two; Java gives it exactly wherever a double can hold it."""
    return F.pow(F.lit(2.0), exponent)


def top_bin(value: Column) -> Column:
    """The bin of the highest bit of a finite value; 0 for zero, which has no logarithm.

    Where a logarithm is rounded to a whole number of bins it may be the next bin: then the first piece has one bit more, or none and
    the others hold all 53.
    """
    return F.coalesce(F.floor(F.log2(F.abs(value)) / DIGIT_BITS).cast("int"), F.lit(0))


def pieces(value: Column, bin_: Column) -> list[Column]:
    """Whole numbers of up to DIGIT_BITS bits with value = sum of piece i times 2 ** (DIGIT_BITS * (bin - i))."""
    half = _power(bin_ * (-DIGIT_BITS // 2))
    rest, found = value * half * half, []
    for _ in range(PIECES):
        whole = rest.cast("bigint")
        found.append(whole)
        rest = (rest - whole) * _BASE
    return found


def finite(value: Column) -> Column:
    return F.when(F.abs(value) < float("inf"), value)  # NaN is larger


def special(value: Column) -> Column:
    """1 for infinity, 2 for minus infinity, 4 for NaN; bits of a group are or-ed."""
    bits = F.when(F.isnan(value), 4).when(value == float("inf"), 1).when(value == -float("inf"), 2).otherwise(0)
    return F.when(value.isNotNull(), bits)


def normalised(low: Column, sums: Column) -> Column:
    """Sums of bins from ``low`` on as (negative, low, digits): digits from 0 to 2 ** DIGIT_BITS - 1 from the lowest bin up, without leading zeros.

    One number has one such form, up to zeros at the low end.
    """

    def carried(values: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

        def step(state: Column, value: Column) -> Column:
            total = value + state["carry"]
            digit = total.bitwiseAND(F.lit(_BASE - 1).cast("bigint"))
            return F.struct(F.shiftright(total, DIGIT_BITS).alias("carry"), F.array_append(state["digits"], digit).alias("digits"))

        # four more bins take up the carry of a sum of 63 bits
        return F.aggregate(F.concat(values, F.array_repeat(F.lit(0).cast("bigint"), 4)), start, step)

    def signed(first: Column) -> Column:
        negative = first["carry"] < 0
        digits = F.when(negative, carried(F.transform(sums, lambda x: -x))["digits"]).otherwise(first["digits"])
        return F.struct(negative.alias("negative"), low.alias("low"), digits.alias("digits"))

    return _let(carried(sums), signed)


def rounded(number: Column) -> Column:
    """The double that is nearest to a normalised number; infinity beyond the largest."""
    digits = number["digits"]
    indices = F.sequence(F.lit(0), F.size(digits) - 1)
    highest = F.aggregate(indices, F.lit(-1), lambda top, i: F.when(F.get(digits, i) != 0, i).otherwise(top))

    def value(top: Column) -> Column:
        four = F.transform(
            F.array(*[F.lit(i) for i in range(4)]),
            lambda i: F.coalesce(F.get(digits, F.when(top - i >= 0, top - i)), F.lit(0).cast("bigint")),
        )
        return _let(four, lambda d: nearest(top, d[0], d[1], d[2], d[3]))

    def nearest(top: Column, d0: Column, d1: Column, d2: Column, d3: Column) -> Column:
        one = F.lit(1).cast("bigint")
        # of the four highest digits (61 to 80 bits) the highest 53 bits are kept
        dropped = F.length(F.bin(d0)) + F.lit(3 * DIGIT_BITS - 53)
        over = F.greatest(dropped - DIGIT_BITS, F.lit(0))  # bits that go from the third digit
        under = F.least(dropped, F.lit(DIGIT_BITS))  # bits that go from the fourth
        upper = _left(d0, F.lit(2 * DIGIT_BITS) - over) + _left(d1, F.lit(DIGIT_BITS) - over) + _right(d2, over)
        mantissa = _left(upper, F.lit(DIGIT_BITS) - under) + _right(d3, under)
        gone = F.shiftleft(d2.bitwiseAND(_left(one, over) - 1), DIGIT_BITS) + d3.bitwiseAND(_left(one, under) - 1)
        half = _left(one, dropped - 1)
        rest = F.exists(F.slice(digits, F.lit(1), F.greatest(top - 3, F.lit(0))), lambda d: d != 0)
        up = (gone > half) | ((gone == half) & (rest | (mantissa % 2 == 1)))
        size = (mantissa + up.cast("bigint")).cast("double")
        exponent = (number["low"] + top - 3) * DIGIT_BITS + dropped
        # in two steps, as a power may be out of range where the result is not
        part = F.floor(exponent / 2).cast("int")
        return F.when(number["negative"], -size).otherwise(size) * _power(part) * _power(exponent - part)

    return _let(highest, lambda top: F.when(top < 0, F.lit(0.0)).otherwise(value(top)))


def canonical(number: Column) -> Column:
    """A text that two normalised numbers share just if they are equal."""
    digits = number["digits"]
    indices = F.sequence(F.lit(0), F.size(digits) - 1)
    held = F.filter(indices, lambda i: F.get(digits, i) != 0)
    shown = F.transform(held, lambda i: F.concat_ws(":", (number["low"] + i).cast("string"), F.get(digits, i).cast("string")))
    sign = F.when(number["negative"], "-").otherwise("+")
    return F.when(F.size(held) == 0, "0").otherwise(F.concat(sign, F.array_join(shown, " ")))


def with_special(special: Column, finite: Column, kind: str) -> Column:
    """Null without values; NaN if there is one or infinities of both signs; else an infinity if there is one."""
    texts = {"double": (float("nan"), float("inf"), -float("inf")), "string": ("NaN", "Infinity", "-Infinity")}[kind]
    return (
        F.when(special.isNull(), F.lit(None).cast(kind))
        .when(special.bitwiseAND(F.lit(4)) + special.bitwiseAND(F.lit(3)) >= 3, F.lit(texts[0]))
        .when(special == 1, F.lit(texts[1]))
        .when(special == 2, F.lit(texts[2]))
        .otherwise(finite)
    )


#: A double that holds a decimal of so many digits, at most PLACES of them after the point, is that decimal: no other one has the same double.
DIGITS, PLACES = 15, 9
WRITTEN = T.DecimalType(38, PLACES)


def as_written(value: Column, kind: T.DataType) -> Column:
    """A binary fraction as the decimal of up to DIGITS digits that it was written as; null for any other value, such as 1/3."""
    if isinstance(kind, T.FloatType):
        found = F.lit(None).cast(WRITTEN)
        # a float is the decimal that it is written as, not that of the double that it widens to
        for places in range(0, PLACES + 1, 3):  # with more places first, there are fewer digits before the point
            # whole numbers are exact up to 2**53, which has a digit more
            decimal = value.cast("string").try_cast(T.DecimalType(DIGITS if places else DIGITS + 1, places))
            found = F.when((decimal.cast(kind) == value) & (F.abs(value) <= F.lit(2.0**53)), decimal.cast(WRITTEN)).otherwise(found)
        return found
    # one cast with the fewest places that hold it, as four would make a stage too long for the JVM to compile
    held = {places: counted_in(value, places, 10.0**DIGITS if places else 2.0**53 + 2)[1] for places in range(0, PLACES + 1, 3)}
    first = lambda shown: F.coalesce(*[F.when(whole, shown(places)) for places, whole in held.items()])
    count = F.rint(value * first(lambda places: F.lit(10.0**places))).cast("bigint")
    return (count.cast("decimal(16,0)") * first(lambda places: unit_of(places).cast(T.DecimalType(PLACES + 1, PLACES)))).cast(WRITTEN)


class Sums:
    """Sums of measures ``output -> column`` as states that may be combined any number of times before they are finished.

    - A measure that is no binary fraction, or whose decimal places ``scales`` states by output, is summed as ``exact`` has it.
    - Any other double or float: a group of values that all hold decimals of up to DIGITS digits sums them as decimals (see ``as_written``); every
      other group has the double that is nearest to the true sum of its values. Neither depends on the order of rows.

    Null values are left out; a group without values has a null sum. NaN, or infinities of both signs, give NaN, an infinity of one sign
    that infinity, a sum beyond the largest double an infinity. Zeros sum to 0.0.

    A state is a row for the values of one magnitude, so values are summed in the input tasks whatever their magnitudes are.
    """

    def __init__(self, schema: T.StructType, measures: Mapping[str, str], scales: Mapping[str, int] | None = None):
        self.schema, self.measures, self.scales = schema, dict(measures), dict(scales or {})
        self.free = {i: out for i, (out, c) in enumerate(measures.items()) if is_fractional(schema[c].dataType) and out not in self.scales}
        self.bins = [f"_b{i}" for i in self.free]

    def states(self, df: DataFrame, keep: Mapping[str, Column]) -> DataFrame:
        """One state for each row, beside the columns ``output -> column`` that are kept."""
        columns = {}
        for i, (out, c) in enumerate(self.measures.items()):
            if i not in self.free:
                columns[f"_d{i}"] = exact(F.col(c), self.schema[c].dataType, self.scales.get(out))
        df = df.select(
            *[value.alias(name) for name, value in keep.items()], *[value.alias(name) for name, value in columns.items()],
            *[F.col(self.measures[out]).alias(f"_v{i}") for i, out in self.free.items()],
        )
        if not self.free:
            return df
        df = df.withColumns({f"_b{i}": top_bin(finite(F.col(f"_v{i}").cast("double"))) for i in self.free})
        columns = {}
        for i, out in self.free.items():
            raw, value = F.col(f"_v{i}"), F.col(f"_v{i}").cast("double")
            columns |= {f"_p{i}_{j}": piece for j, piece in enumerate(pieces(finite(value), F.col(f"_b{i}")))}
            kind = self.schema[self.measures[out]].dataType
            columns |= {f"_s{i}": special(value), f"_d{i}": as_written(raw, kind)}
        df = df.withColumns(columns)
        return df.withColumns({f"_u{i}": F.col(f"_v{i}").isNotNull() & F.col(f"_d{i}").isNull() for i in self.free}).drop(*[f"_v{i}" for i in self.free])

    def combine(self, states: DataFrame, keys: Sequence[str]) -> DataFrame:
        """States by ``keys`` and magnitude."""
        sums = []
        for i in range(len(self.measures)):
            if i in self.free:
                sums += [F.sum(f"_p{i}_{j}").alias(f"_p{i}_{j}") for j in range(PIECES)]
                sums += [F.bit_or(f"_s{i}").alias(f"_s{i}"), F.bool_or(f"_u{i}").alias(f"_u{i}")]
                # decimals that overflow leave the sum to the pieces; a null sum stays one
                total = F.try_sum(f"_d{i}")
                lost = total.isNull() & (F.count(f"_d{i}") > 0)
                sums[-1] = (F.bool_or(f"_u{i}") | lost).alias(f"_u{i}")
                sums.append(F.coalesce(total, F.lit(0)).cast(WRITTEN).alias(f"_d{i}"))
            else:
                sums.append(F.sum(f"_d{i}").alias(f"_d{i}"))
        return states.groupBy(*keys, *self.bins).agg(*sums)

    def finish(self, states: DataFrame, keys: Sequence[str], text: str | None = None) -> DataFrame:
        """One row for each group, one without ``keys``: a double for each measure.

        With ``text``, a measure also has ``output + text + "_written"``, the decimal sum as text (null where the group is not summed as written),
        and, if it is a binary fraction, ``output + text + "_binary"``: a text that tells any two true sums apart, which doubles do not.
        """
        combined = self.combine(states, keys)
        if not self.free:
            return self._shown(combined, keys, text)
        low = F.lit(0).cast("bigint")
        lifted = []
        for i in range(len(self.measures)):
            bins = []
            if i in self.free:
                part = lambda j, k: _digit(F.coalesce(F.col(f"_p{i}_{j}"), low), k)  # noqa: B023, E731
                # each sum is cut into four digits again, so that sums over magnitudes fit longs as well
                for up in range(1 - PIECES, 4):
                    total = reduce(add, [part(j, up + j) for j in range(PIECES) if 0 <= up + j < 4])
                    bins.append(F.struct((F.col(f"_b{i}") + up).alias("bin"), total.alias("sum")))
            else:
                bins.append(F.struct(F.lit(0).alias("bin"), low.alias("sum")))
            lifted.append(F.struct(F.lit(i).alias("measure"), F.array(*bins).alias("bins")))
        numbers = range(len(self.measures))
        rest = {f"_d{i}": F.sum for i in numbers} | {f"_s{i}": F.bit_or for i in self.free} | {f"_u{i}": F.bool_or for i in self.free}
        # the other sums go with the first bin of the first measure
        others = F.struct(*[F.col(name) for name in rest]).alias("_rest")
        rows = combined.select(*keys, others, F.explode(F.array(*lifted)).alias("_m"))
        rows = rows.select(*keys, "_rest", "_m.measure", F.posexplode("_m.bins").alias("_place", "_bin"))
        first = (F.col("measure") == 0) & (F.col("_place") == 0)
        rows = rows.select(*keys, "measure", "_bin.bin", "_bin.sum", *[F.when(first, F.col(f"_rest.{name}")).alias(name) for name in rest])
        by_bin = rows.groupBy(*keys, "measure", "bin").agg(F.sum("sum").alias("sum"), *[self._again(name, f).alias(name) for name, f in rest.items()])
        # one entry for each bin that a measure of a group touches, about a hundred at most
        entries = {i: F.collect_list(F.when(F.col("measure") == i, F.struct("bin", "sum"))) for i in self.free}
        whole = by_bin.groupBy(*keys).agg(
            *[self._again(name, f).alias(name) for name, f in rest.items()], *[found.alias(f"_n{i}") for i, found in entries.items()]
        )
        return self._shown(whole.withColumns({f"_n{i}": normalised(*_dense(F.col(f"_n{i}"))) for i in self.free}), keys, text)

    def _again(self, name: str, function) -> Column:
        if name.startswith("_u"):
            return F.bool_or(name) | (F.try_sum(f"_d{name[2:]}").isNull() & (F.count(f"_d{name[2:]}") > 0))
        if name.startswith("_d") and int(name[2:]) in self.free:
            return F.coalesce(F.try_sum(name), F.lit(0)).cast(WRITTEN)
        return function(name)

    def _shown(self, whole: DataFrame, keys: Sequence[str], text: str | None) -> DataFrame:
        out = []
        for i, name in enumerate(self.measures):
            written = F.col(f"_d{i}")
            if i in self.free:
                written = F.when(F.col(f"_s{i}").isNotNull() & ~F.col(f"_u{i}"), written)
                number = F.col(f"_n{i}")
                found = F.when(written.isNotNull(), written.cast("double")).otherwise(with_special(F.col(f"_s{i}"), rounded(number), "double"))
            else:
                found = written.cast("double")
            out.append(found.alias(name))
            if text is not None:
                out.append(_plain(written, whole.schema[f"_d{i}"].dataType).alias(f"{name}{text}_written"))
                if i in self.free:
                    out.append(with_special(F.col(f"_s{i}"), canonical(number), "string").alias(f"{name}{text}_binary"))
        return whole.select(*keys, *out)


def _plain(number: Column, kind: T.DataType) -> Column:
    """A whole or decimal number as text that is the same for equal numbers of any type."""
    if not isinstance(kind, T.DecimalType):
        number, kind = number.cast(T.DecimalType(38, 0)), T.DecimalType(38, 0)
    form = "S" + "9" * max(kind.precision - kind.scale - 1, 0) + "0" + ("." + "0" * kind.scale if kind.scale else "")
    shown = F.replace(F.to_char(number, F.lit(form)), F.lit(" "), F.lit(""))
    shown = F.regexp_replace(F.regexp_replace(shown, r"(\.[0-9]*?)0*$", "$1"), r"\.$", "")
    return F.regexp_replace(shown, r"^([+-])0+", "$1")


def _digit(total: Column, k: int) -> Column:
    """Digit k of a sum of pieces; the highest takes the sign."""
    if k == 3:
        return F.shiftright(total, DIGIT_BITS * 3)
    return F.shiftright(total, DIGIT_BITS * k).bitwiseAND(F.lit(_BASE - 1).cast("bigint"))


def exact_sums(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str], scales: Mapping[str, int] | None = None) -> DataFrame:
    """Sums of measures ``output -> column`` by ``keys`` as doubles; see ``Sums``. Only sums are shuffled."""
    sums = Sums(df.schema, measures, scales)
    return sums.finish(sums.states(df, {key: F.col(key) for key in keys}), keys)


def _dense(entries: Column) -> tuple[Column, Column]:
    """The lowest bin of (bin, sum) entries, and the sums of all bins from there on."""
    bins = F.transform(entries, lambda e: e["bin"])
    low = F.coalesce(F.array_min(bins), F.lit(0))
    held = F.map_from_entries(entries)
    every = F.sequence(low, F.coalesce(F.array_max(bins), F.lit(0)))
    return low, F.transform(every, lambda b: F.coalesce(F.try_element_at(held, b), F.lit(0).cast("bigint")))
