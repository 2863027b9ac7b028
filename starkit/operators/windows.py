"""Top rows per group, previous values and running totals."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkit.functions import sums
from starkit.functions.keys import SCALE, exact, is_fractional
from starkit.operators.joins import equal_on
from starkit.session import stage, stage_bucketed


#: Up to so many rows Spark limits groups inside the input tasks by itself.
SPARK_GROUP_LIMIT = 1000


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group; ``order`` should end in a unique column.

    Up to SPARK_GROUP_LIMIT rows, Spark limits each group within the input tasks as well. For more, each group is first
    limited within parts of it, one for each input task, so that a large group is never sorted whole in one task.
    """

    def first(rows: DataFrame, *within: str) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*within).orderBy(*order))
        return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")

    if n > SPARK_GROUP_LIMIT:
        df = first(df.withColumn("_part", F.spark_partition_id()), *keys, "_part").drop("_part")
    return first(df, *keys)


def previous_and_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    previous: str = "previous_value",
    running: str = "running_total",
    default: float = 0,
    group_rows: int | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Add the value of the row before (``default`` in the first row) and the total so far.

    Totals of binary fractions are given as the type of the values: with ``scale`` they are summed as decimals with so many places; without it a total of
    values that all hold short decimals is summed as written, and any other one is the double nearest to the true sum of the values so far
    (see ``Sums``). Totals of decimals keep all places in 38 digits, those of whole numbers are bigint, however large a group is.

    Rows are dealt by ranges of (keys, order), once: a range holds whole groups, but for its first and its last one, which may go on in
    others. What those two hold, their last value and their sums, is carried from range to range; a group of any size is
    spread over as many ranges as it needs. ``group_rows`` asks for so many ranges that each has about that many rows at most.
    """
    keys, order = list(keys), list(order)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if group_rows is not None:
        ranges = max(ranges, -(-df.count() // group_rows))
    total = _Running(df, value, scale)
    dealt = df.repartitionByRange(ranges, *keys, *order).withColumns({"_range": F.spark_partition_id(), **total.split()})
    ranged = stage_bucketed(dealt, "ranges", "_range", ranges)
    group = F.struct(*keys) if keys else F.lit(0)
    ends = ranged.groupBy("_range").agg(F.min(group).alias("_first_group"), F.max(group).alias("_last_group"), *total.measures())
    # one row for each range
    ends = stage(ends, "range-ends")
    total.measured(ends)
    states = ranged.withColumns(total.states())
    edge = F.broadcast(ends.select(F.col("_range").alias("_end_of"), "_first_group", "_last_group"))
    at_edge = states.join(edge, F.col("_range") == F.col("_end_of"))
    at_edge = at_edge.where(group.eqNullSafe(F.col("_first_group")) | group.eqNullSafe(F.col("_last_group")))
    held = at_edge.groupBy(*keys, "_range").agg(*total.summed(), F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
    earlier = W.partitionBy(*keys).orderBy("_range")
    # two rows for each range at most
    carried = stage(
        held.select(
            *[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_range").alias("_c_range"),
            *total.over(earlier.rowsBetween(W.unboundedPreceding, -1), "_before"), F.lag("_last").over(earlier).alias("_last_before"),
        ),
        "range-carries",
    )
    pairs = {**{k: f"_c_{k}" for k in keys}, "_range": "_c_range"}
    joined = states.join(F.broadcast(carried), equal_on(states, carried, pairs, null_safe=True), "left")
    ordered = W.partitionBy("_range", *keys).orderBy(*order)
    within = joined.select(
        "*", *total.over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow), "_within"),
        (F.row_number().over(ordered) == 1).alias("_is_first"), F.lag(value).over(ordered).alias("_lag"),
    )
    before = (
        F.when(~F.col("_is_first"), F.col("_lag"))
        .when(F.col("_last_before").isNotNull(), F.col("_last_before")[value])
        .otherwise(F.lit(default).cast(df.schema[value].dataType))
    )
    within = within.withColumns(total.together())
    return within.select(*df.columns, before.alias(previous), total.shown().alias(running))


class _Running:
    """The sums that make a running total, as columns that add up over rows and over ranges."""

    def __init__(self, df: DataFrame, value: str, scale: int | None):
        self.value, self.kind = F.col(value), df.schema[value].dataType
        self.free = is_fractional(self.kind) and scale is None
        if self.free:
            self.addend, self.type = F.col("_written"), sums.WRITTEN
        else:
            self.addend, self.type = exact(self.value, self.kind, scale), _sum_type(self.kind, scale)
        self.bins: range = range(0)
        self.binary = False

    @property
    def _unfit(self) -> Column:
        return self.value.isNotNull() & self.addend.isNull()

    def split(self) -> dict[str, Column]:
        """Pieces of the values, which are written with the rows, as there may be many bins to choose them for."""
        if not self.free:
            return {}
        number = sums.finite(self.value.cast("double"))
        top = sums.top_bin(number)
        found = {f"_piece{j}": F.coalesce(piece, F.lit(0).cast("bigint")) for j, piece in enumerate(sums.pieces(number, top))}
        return {"_written": sums.as_written(self.value, self.kind), "_top": top, "_s": sums.special(self.value.cast("double")), **found}

    def measures(self) -> list[Column]:
        """What a range tells about its values: the bins that they touch, and whether sums of decimals would do."""
        if not self.free:
            return []
        bin_ = F.col("_top")
        size = F.try_sum(F.abs(self.addend)).cast(self.type)
        return [F.min(bin_).alias("_low"), F.max(bin_).alias("_high"), F.bool_or(self._unfit).alias("_unfit"), size.alias("_size")]

    def measured(self, ends: DataFrame) -> None:
        if self.free:
            # sizes that decimals cannot add up are null; a range without values has no size, and its values are not unfit
            too_large = F.bool_or(~F.col("_unfit") & F.col("_size").isNull()) | F.try_sum("_size").isNull()
            low, high, binary = ends.agg(F.min("_low"), F.max("_high"), F.bool_or("_unfit") | too_large).first()
            self.binary = bool(binary) and low is not None
            self.bins = range(low - sums.PIECES + 1, high + 1) if self.binary else range(0)

    def states(self) -> dict[str, Column]:
        if not self.binary:
            return {"_x": self.addend}
        states = {"_x": self.addend, "_u": self._unfit}
        top, zero = F.col("_top"), F.lit(0).cast("bigint")
        for b in self.bins:
            found = zero
            for j in range(sums.PIECES):
                found = F.when(top == b + j, F.col(f"_piece{j}")).otherwise(found)
            states[f"_w{b - self.bins.start}"] = found
        return states

    def _functions(self) -> dict[str, Callable[[str], Column]]:
        add = F.try_sum if self.free else F.sum
        functions = {"_x": lambda name: add(name).cast(self.type)}
        if self.binary:
            functions |= {"_u": F.bool_or, "_s": F.bit_or} | {f"_w{i}": F.sum for i in range(len(self.bins))}
        return functions

    def summed(self) -> list[Column]:
        return [f(name).alias(name) for name, f in self._functions().items()]

    def over(self, window, suffix: str) -> list[Column]:
        add = F.try_sum if self.free else F.sum
        plain = self._functions() | {"_x": add}
        found = {name: f(name).over(window) for name, f in plain.items()}
        found["_x"] = found["_x"].cast(self.type)
        return [column.alias(name + suffix) for name, column in found.items()]

    def together(self) -> dict[str, Column]:
        """Sums before a range and within it as one."""
        found = {}
        for name in self._functions():
            a, b = F.col(f"{name}_before"), F.col(f"{name}_within")
            if name == "_u":
                found["_u_all"] = F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False))
            elif name == "_s":
                found["_s_all"] = F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a.bitwiseOR(b))
            else:
                both = F.try_add(a, b).cast(self.type) if name == "_x" and self.free else (a + b)
                found[f"{name}_all"] = F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)
        return found

    def shown(self) -> Column:
        written = F.col("_x_all")
        if not self.free:
            return written.cast(_total_type(self.kind))
        if not self.binary:
            return written.cast(self.kind)
        digits = F.array(*[F.col(f"_w{i}_all") for i in range(len(self.bins))])
        number = sums.normalised(F.lit(self.bins.start), digits)
        whole = sums.with_special(F.col("_s_all"), F.get(F.transform(F.array(number), sums.rounded), F.lit(0)), "double")
        lost = F.col("_u_all") | written.isNull()
        return F.when(lost, whole).otherwise(written.cast("double")).cast(self.kind)


def _total_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, kind.scale)
    return kind if is_fractional(kind) else T.LongType()


def _sum_type(kind: T.DataType, scale: int | None) -> T.DataType:
    """A type whose sums of two lose no decimal place."""
    if is_fractional(kind):
        return T.DecimalType(37, SCALE if scale is None else scale)
    return T.DecimalType(37, kind.scale) if isinstance(kind, T.DecimalType) else T.LongType()
