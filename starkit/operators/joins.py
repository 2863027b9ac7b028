"""Joins from facts to dimensions, and the null-safe join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.functions.keys import any_null
from starkit.operators.sizes import BROADCAST_BYTES, GROUP_ROWS, fits_broadcast, hot_groups
from starkit.session import stage


def equal_on(left: DataFrame, right: DataFrame, on: Mapping[str, str], null_safe: bool = False):
    """Join condition over pairs ``left column -> right column``."""
    condition = None
    for ours, theirs in on.items():
        pair = left[ours].eqNullSafe(right[theirs]) if null_safe else left[ours] == right[theirs]
        condition = pair if condition is None else condition & pair
    return condition


#: Pairs that a key may make in one task.
GROUP_PAIRS = 50_000_000


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner", group_pairs: int = GROUP_PAIRS
) -> DataFrame:
    """Equi-join in which null matches null: inner, left, right or full. Spark plans it as an equi-join, with no cross product.

    Rows with a null key meet each other m x n, as any other repeated key does (``null_fan_out`` says how many rows nulls give). Keys, null or not, that make more than
    ``group_pairs`` pairs are counted before anything is joined, and are split: the rows of the side that has more of them are
    dealt over as many parts as the pairs need, the other side's rows go to each part. As such keys are on both sides, none of their rows
    is without a partner, whatever the kind of join.
    """
    hot = _hot_pairs(left, right, on, group_pairs)
    found = hot.agg(F.count(F.lit(1)), F.max("_parts")).first()
    if not found[0]:
        return left.join(right, equal_on(left, right, on, null_safe=True), how)
    sides = []
    for df, columns in ((left, list(on)), (right, list(on.values()))):
        named = hot.select(*[F.col(f"_k{i}").alias(f"_h{i}") for i in range(len(on))], "_parts", "_split_left")
        # at most all pairs / group_pairs keys
        marked = df.join(F.broadcast(named), equal_on(df, named, {c: f"_h{i}" for i, c in enumerate(columns)}, null_safe=True), "left")
        sides.append(marked.drop(*[f"_h{i}" for i in range(len(on))]))
    cold_left, cold_right = (side.where(F.col("_parts").isNull()).select(*df.columns) for side, df in zip(sides, (left, right)))
    cold = cold_left.join(cold_right, equal_on(cold_left, cold_right, on, null_safe=True), how)
    parts = []
    for side, df, splits in zip(sides, (left, right), (F.col("_split_left"), ~F.col("_split_left"))):
        dealt = F.array(F.pmod(F.monotonically_increasing_id(), F.col("_parts")))
        every = F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)
        held = side.where(F.col("_parts").isNotNull()).withColumn("_dealt", F.when(splits, dealt).otherwise(every))
        parts.append(held.select(*df.columns, F.explode("_dealt").alias("_part")))
    parts[1] = parts[1].withColumnRenamed("_part", "_part_of")
    met = parts[0].join(parts[1], equal_on(*parts, on, null_safe=True) & (F.col("_part") == F.col("_part_of")))
    kept = [parts[0][c] for c in left.columns] + [parts[1][c] for c in right.columns]
    return cold.unionAll(met.select(*kept))


def _hot_pairs(left: DataFrame, right: DataFrame, on: Mapping[str, str], group_pairs: int) -> DataFrame:
    """Keys with more than ``group_pairs`` pairs, into how many parts they go, and which side is split. Counts are combined before they are shuffled."""
    names = [f"_k{i}" for i in range(len(on))]
    counts = []
    for df, columns, n in ((left, on, "_left"), (right, on.values(), "_right")):
        keys = df.select(*[F.col(c).alias(name) for c, name in zip(columns, names)])
        counts.append(keys.groupBy(*names).agg(F.count(F.lit(1)).alias(n)))
    both = counts[0].join(counts[1], equal_on(*counts, {name: name for name in names}, null_safe=True))
    pairs = F.col("_left").cast("double") * F.col("_right")
    found = both.where(pairs > group_pairs).select(
        *[counts[0][name] for name in names], (F.col("_left") >= F.col("_right")).alias("_split_left"),
        F.least(F.ceil(pairs / group_pairs), F.greatest("_left", "_right")).alias("_parts"),
    )
    return stage(found, "hot-pairs")


def null_fan_out(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """One row: null-key rows on either side and the pairs an inner null-safe join makes of them."""
    nulls_left = left.select(any_null([F.col(c) for c in on]).alias("left_null"), F.lit(False).alias("right_null"))
    nulls_right = right.select(
        F.lit(False).alias("left_null"), any_null([F.col(c) for c in on.values()]).alias("right_null")
    )
    counts = nulls_left.unionByName(nulls_right).agg(
        F.count_if("left_null").alias("left_nulls"), F.count_if("right_null").alias("right_nulls")
    )
    return counts.withColumn("null_pairs", F.col("left_nulls") * F.col("right_nulls"))


#: Bits of a member filter for each member, and words of 64 bits that it has at least.
FILTER_BITS, LEAST_WORDS = 16, 64
_WORD_BYTES = 64  # of a word with its number in a broadcast


def filter_words(members: int) -> int:
    """Words of a filter for so many members: a power of two."""
    return max(LEAST_WORDS, 1 << (max(members, 1) * FILTER_BITS // 64).bit_length())


def _filter_place(keys: Sequence[str], words: int) -> tuple[Column, Column]:
    """The word of a key and its four bits in it."""
    bits = F.xxhash64(F.lit(1), *keys)
    one = F.lit(1).cast("bigint")
    places = [F.shiftright(bits, 6 * i).bitwiseAND(F.lit(63).cast("bigint")).cast("int") for i in range(4)]
    mask = reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", one, place) for place in places])
    return F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(words)), mask


def member_filter(dim: DataFrame, keys: Sequence[str], limit: int = BROADCAST_BYTES) -> tuple[DataFrame, int] | None:
    """A Bloom filter over the members of ``dim``, sized by their measured number, as rows (_word, _bits), and its words.

    None if a filter for them would not fit ``limit`` bytes.
    """
    members = dim.select(*keys).dropna()
    words = filter_words(members.count())
    if words * _WORD_BYTES > limit:
        return None
    word, mask = _filter_place(keys, words)
    return stage(members.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_bits")), "member-filter"), words


def join_members(
    fact: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Sequence[str], how: str = "left", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Facts with what is taken from a dimension that is too large to be broadcast; facts without a member are not shuffled.

    A filter of the members tells most of those facts apart in the input tasks, and facts with a null key all; they stay where they are. The
    others, with the few that the filter lets through, meet the members by a join, which decides. ``on`` must be unique in ``dim``. The
    fact is read twice, so it should be a table rather than a plan that is dear. If no filter fits ``limit`` it is a plain join.
    """
    ours = list(on)
    named = dim.select(*[F.col(theirs).alias(f"_on{i}") for i, theirs in enumerate(on.values())], *[F.col(c).alias(f"_t_{c}") for c in take])
    matched = {c: f"_on{i}" for i, c in enumerate(ours)}
    shown = [*[F.col(c) for c in fact.columns], *[F.col(f"_t_{c}").alias(c) for c in take]]
    found = member_filter(named, list(matched.values()), limit)
    if found is None:
        return fact.join(named, equal_on(fact, named, matched), how).select(*shown)
    bits, words = found
    word, mask = _filter_place(ours, words)
    looked = fact.withColumns({"_at": word, "_mask": mask}).join(F.broadcast(bits), F.col("_at") == F.col("_word"), "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False)) & ~any_null([F.col(c) for c in ours])
    looked = looked.withColumn("_maybe", maybe)
    near = looked.where("_maybe").select(*fact.columns)
    joined = near.join(named, equal_on(near, named, matched), how).select(*shown)
    if how == "inner":
        return joined
    nothing = [F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in take]
    return joined.unionByName(looked.where("NOT _maybe").select(*fact.columns, *nothing))


@dataclass(frozen=True)
class Side:
    """A dimension to join: its unique columns (``fact column -> dimension column``) and what to take."""

    dim: DataFrame
    on: Mapping[str, str]
    take: Sequence[str]


def to_dimensions(
    fact: DataFrame,
    sides: Sequence[Side],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """All fact columns plus what is taken from each dimension.

    Dimensions that together are measured to be small are broadcast and the fact does not move. For the others the
    fact is shuffled by key, but for two sorts of rows, which are spread evenly: null keys match nothing, and
    hot keys, counted once on the fact before anything is joined, find their members in a broadcast of just those.
    """
    narrowed = [side.dim.select(*dict.fromkeys([*side.on.values(), *side.take])) for side in sides]
    fits = fits_broadcast(narrowed, broadcast_bytes)
    hot = [None if small else _hot_keys(fact, list(side.on), group_rows) for side, small in zip(sides, fits)]
    for side, dim, small, keys in zip(sides, narrowed, fits, hot):
        named = dim.select(*[F.col(c).alias(f"_on_{c}") for c in side.on.values()], *side.take)
        pairs = {ours: f"_on_{theirs}" for ours, theirs in side.on.items()}
        if small:
            joined = fact.join(F.broadcast(named), equal_on(fact, named, pairs), how)
            fact = joined.select(*[fact[c] for c in fact.columns], *[named[c] for c in side.take])
        else:
            fact = _spread_join(fact, named, pairs, side.take, how, keys, broadcast_bytes)
    return fact


def _hot_keys(fact: DataFrame, ours: list[str], group_rows: int) -> DataFrame:
    return stage(hot_groups(fact.select(*ours).dropna(), ours, group_rows).select(*ours), "hot-keys")


def _spread_join(
    fact: DataFrame, side: DataFrame, pairs: Mapping[str, str], take: Sequence[str], how: str, hot: DataFrame, broadcast_bytes: int
) -> DataFrame:
    """Rows of hot keys are joined to the broadcast members of those keys, the rest by shuffle.

    For the shuffle, rows whose key is null or hot get no key and a running number, so that they spread over all tasks
    whatever they hold; the number decides only where a row goes.
    """
    ours, theirs = list(pairs), list(pairs.values())
    named = hot.select(*[F.col(name).alias(f"_hot_{name}") for name in ours])
    members = side.join(named, equal_on(side, named, {pairs[c]: f"_hot_{c}" for c in ours}), "left_semi")
    if hot.isEmpty() or not fits_broadcast([members], broadcast_bytes or BROADCAST_BYTES)[0]:
        left = fact.select("*", F.lit(False).alias("_held"))
    else:
        held = members.select(*[F.col(c).alias(f"_h{i}") for i, c in enumerate(theirs)], *[F.col(c).alias(f"_t_{c}") for c in take])
        held = held.withColumn("_held", F.lit(True))
        found = fact.join(F.broadcast(held), equal_on(fact, held, {c: f"_h{i}" for i, c in enumerate(ours)}), "left")
        left = found.drop(*[f"_h{i}" for i in range(len(ours))]).withColumn("_held", F.coalesce("_held", F.lit(False)))
    apart = F.col("_held") | any_null([F.col(c) for c in ours])
    keys = {f"_key{i}": F.when(~apart, F.col(c)) for i, c in enumerate(ours)}
    left = left.withColumns({**keys, "_salt": F.when(apart, F.monotonically_increasing_id()).otherwise(F.lit(0))})
    # exploded, as a constant would be folded out of the join keys
    right = side.select(
        *[F.col(c).alias(f"_r{i}") for i, c in enumerate(theirs)], *[F.col(c).alias(f"_s_{c}") for c in take],
        F.explode(F.array(F.lit(0).cast("bigint"))).alias("_salt_side"), F.lit(True).alias("_met"),
    )
    matched = equal_on(left, right, {**{key: f"_r{i}" for i, key in enumerate(keys)}, "_salt": "_salt_side"})
    joined = left.join(right, matched, "left")
    if how == "inner":
        joined = joined.where(F.col("_held") | F.col("_met").isNotNull())
    taken = [
        (F.when(F.col("_held"), F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}")) if f"_t_{c}" in left.columns else F.col(f"_s_{c}")).alias(c)
        for c in take
    ]
    return joined.select(*fact.columns, *taken)
