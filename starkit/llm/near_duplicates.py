"""Near duplicates by bottom-k sketches from one hash function.

1. Each document's set of shingles is hashed once; the k least values are its sketch. Documents with equal
   sets are one class, so copies are never compared.
2. Inverted lists of the retained values generate overlaps. Two sets that are similar enough share so many
   retained values that they also share one among the rarest few of each, so only those are listed: passages that many
   documents share are left out by their frequency, not by a cap. Sets with a partner there are listed again by
   longer sketches, which for most are the whole sets and leave few lists.
3. In each list all members are held against the most central one; only members that are in different
   components after that are held against each other.
4. The union of two sketches estimates the similarity and filters; the full sets confirm.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import batch_of, map_arrow, membership, release, with_membership
from starkit.llm.graph import components
from starkit.session import stage

WORDS = 5
#: Linked from this similarity on, in hundredths, where nothing else is asked for.
PERCENT = 85
#: Values of a sketch, of those whose union estimates a similarity, and of those in the lists of sets that have a partner by the first ones.
SKETCH, MIDDLE, WIDE = 32, 256, 1024
#: Probability with which a pair at the threshold may share fewer values of a sketch than is asked for.
MISSED = 1e-8
#: Rounds of comparison with one member of each list before the rest is compared member by member.
STAR_ROUNDS = 3


def shared_of(size: int, percent: int) -> int:
    """How many of ``size`` retained values a pair at the threshold shares, but with a probability of MISSED at most."""
    p, below, shared = percent / 100, 0.0, 0
    while shared < size:
        chances = math.lgamma(size + 1) - math.lgamma(shared + 1) - math.lgamma(size - shared + 1)
        below += math.exp(chances + shared * math.log(p) + (size - shared) * math.log(1 - p))
        if below > MISSED:
            break
        shared += 1
    return shared


@dataclass(frozen=True)
class Bounds:
    """A threshold in hundredths, and how many values a pair at it shares of each kind of sketch."""

    percent: int
    sketch: int
    middle: int
    wide: int

    @classmethod
    @functools.cache
    def of(cls, percent: int) -> Bounds:
        if not 0 < percent < 100:
            raise ValueError("percent must be between 1 and 99")
        return cls(percent, *(shared_of(size, percent) for size in (SKETCH, MIDDLE, WIDE)))


_UPPER = bytes(range(65, 91))
_LOWERED = bytes.maketrans(_UPPER, _UPPER.lower())
_POWERS = np.array([pow(0x9E3779B97F4A7C15, WORDS - 1 - i, 1 << 64) for i in range(WORDS)], np.uint64)


class Shingler:
    """Sorted distinct 64-bit hashes of the shingles of texts; word hashes are kept for one batch."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.words
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").translate(_LOWERED).split() if text else []
            if not words:
                yield np.empty(0, np.int64)
                continue
            hashed = self._hashes(words)
            if len(words) < WORDS:
                mixed = np.array([xxhash.xxh3_64_intdigest(hashed.tobytes())], np.uint64)
            else:
                n = len(words) - WORDS + 1
                mixed = sum(hashed[i : i + n] * power for i, power in enumerate(_POWERS))
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            yield np.unique((mixed ^ (mixed >> np.uint64(29))).view(np.int64))
        self.words.clear()


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n (shingles), f1 and f2 (128-bit fingerprint of the set) and sketch of each row; written once."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            ids, hashes = batch.column("doc_id"), batch.column("text_hash")
            texts = batch.column("text").to_pylist()
            for start in range(0, len(texts), 500):
                found = [(len(s), xxhash.xxh3_128_digest(s), s[:SKETCH]) for s in shingler.sets(texts[start : start + 500])]
                prints = np.frombuffer(b"".join(f for _, f, _ in found), "<i8").reshape(-1, 2)
                yield batch_of({
                    "doc_id": (ids.slice(start, len(found)), pa.int64()), "text_hash": (hashes.slice(start, len(found)), pa.int64()),
                    "n": ([n for n, _, _ in found], pa.int64()),
                    "f1": (prints[:, 0], pa.int64()), "f2": (prints[:, 1], pa.int64()),
                    "sketch": (_lists([s for _, _, s in found]), None),
                })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    schema = "doc_id long, text_hash long, n long, f1 long, f2 long, sketch array<long>"
    return stage(map_arrow(rows, sketched, schema), "sketches")


def classes_of(rows: DataFrame) -> DataFrame:
    """One row for each set that is not empty: node, f1, f2, least (doc_id), text_hash (of a row with it), n, sketch; written once,
    which fixes the numbers."""
    shown = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("shown")
    each = rows.where("n > 0").groupBy("f1", "f2").agg(shown, F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    named = each.select("f1", "f2", F.col("shown.doc_id").alias("least"), "shown.text_hash", "n", "sketch")
    return stage(named.withColumn("node", F.monotonically_increasing_id()), "classes")


def _listed(size: int, shared: int, percent: int):
    """How many of its rarest values a set of n shingles must list, if sketches have ``size`` values.

    A set and its partner share that part of the larger one, if both have their whole sets for sketches. Where the partner
    may be larger than its sketch they share that or ``shared``; so the lesser of the two holds for both.
    """
    n = F.col("n")
    whole = F.ceil(n * percent / 100)
    needed = F.when(n <= size * percent // 100, whole).otherwise(F.least(F.lit(shared), whole))
    return F.least(n, F.lit(size)) - needed + 1


def inverted_lists(sketched: DataFrame, size: int, shared: int, percent: int) -> DataFrame:
    """value, node, n, centre (how common the values of the node are) and place (of the value among those of the node, the rarest
    being 0), in lists of two nodes at least; written once.

    ``sketched``: node, n, sketch. Counting needs all values; a list holds only nodes that have its value among their rarest.
    """
    values = sketched.select("node", "n", F.explode("sketch").alias("value"))
    common = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    held = values.join(common, "value").groupBy("node", "n").agg(
        F.sum("df").alias("centre"), F.array_sort(F.collect_list(F.struct("df", "value"))).alias("found")
    )
    alone = F.least("n", F.lit(size)) - F.size("found")  # values that no other node has come first in the order
    room = F.greatest(_listed(size, shared, percent) - alone, F.lit(0)).cast("int")
    centre = (F.col("centre") / F.least("n", F.lit(size))).alias("centre")
    listed = held.select("node", "n", centre, alone.alias("alone"), F.posexplode(F.slice("found", F.lit(1), room)).alias("i", "v"))
    listed = stage(listed.select("v.value", "node", "n", "centre", (F.col("alone") + F.col("i")).alias("place")), "postings")
    several = listed.groupBy("value").agg(F.count("*").alias("_k")).where("_k > 1").select("value")
    return stage(listed.join(several, "value"), "lists")


def full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, n, full (sorted hashes of all shingles) of the given nodes; written once.

    A filter of fixed size keeps most other texts from being shuffled.
    """

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start in range(0, len(texts), 500):
                found = list(shingler.sets(texts[start : start + 500]))
                prints = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, found)), "<i8").reshape(-1, 2)
                part = batch.slice(start, len(found))
                same = (part.column("f1").to_numpy() == prints[:, 0]) & (part.column("f2").to_numpy() == prints[:, 1])
                kept = [s for s, yes in zip(found, same) if yes]
                yield batch_of({
                    "node": (part.column("node").filter(pa.array(same)), pa.int64()),
                    "n": ([len(s) for s in kept], pa.int64()), "full": (_lists(kept), None),
                })

    wanted = stage(classes.join(nodes, "node").select("least", "text_hash", "f1", "f2", "node"), "wanted")
    members = membership(wanted, F.xxhash64("least", "text_hash"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text", F.xxhash64("text").alias("_hash"))
    texts = with_membership(texts, F.xxhash64("_id", "_hash"), members).where("_maybe").drop("_maybe")
    match = F.col("_id").eqNullSafe(F.col("least")) & (F.col("_hash") == F.col("text_hash"))
    found = texts.join(wanted.hint("shuffle_hash"), match).select("node", "f1", "f2", "text")
    sets = map_arrow(found, shingled, "node long, n long, full array<long>")
    return stage(sets.dropDuplicates(["node"]), "full-sets")


def similar(pairs: DataFrame, sets: DataFrame, bounds: Bounds) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar: first by the union of their sketches, then by the full sets."""
    brief = sets.select("node", "n", F.slice("full", 1, MIDDLE).alias("sketch"))
    side = lambda df, name: df.select([F.col(c).alias(name if c == "node" else f"{c}_{name}") for c in df.columns])
    estimated = pairs.select("a", "b").distinct().join(side(brief, "a"), "a").join(side(brief, "b"), "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, MIDDLE)
    least, most, common = F.least("n_a", "n_b"), F.greatest("n_a", "n_b"), F.array_intersect("sketch_a", "sketch_b")
    # sketches that are whole sets are counted whole: their union may hold more values than a sketch
    both = F.size(F.when(most <= MIDDLE, common).otherwise(F.array_intersect(common, union)))
    needed = F.when(most <= MIDDLE, F.ceil(most * bounds.percent / 100)).otherwise(F.lit(bounds.middle))
    passed = estimated.where((100 * least >= bounds.percent * most) & (both >= needed)).select("a", "b")
    full = sets.select("node", "n", "full")
    held = passed.join(side(full, "a"), "a").join(side(full, "b"), "b")
    shared = F.size(F.array_intersect("full_a", "full_b"))
    return held.where(100 * shared >= bounds.percent * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b")


def _possible(n_a, place_a, n_b, place_b, bounds: Bounds):
    """Whether two sets whose first shared value has these places can be similar: by their sizes, and by what is left after the value.

    A pair is met in the list of its first shared value too, so the bound may be wrong for later ones.
    """
    least, most = F.least(n_a, n_b), F.greatest(n_a, n_b)
    needed = F.when(most <= WIDE, F.ceil((n_a + n_b) * bounds.percent / (100 + bounds.percent))).otherwise(F.lit(bounds.wide))
    left = F.least(F.least(n_a, F.lit(WIDE)) - place_a, F.least(n_b, F.lit(WIDE)) - place_b)
    return (100 * least >= bounds.percent * most) & (left >= needed)


def _with_roots(lists: DataFrame, roots: DataFrame) -> DataFrame:
    return lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _unsettled(lists: DataFrame) -> DataFrame:
    """Members of lists that still hold several components."""
    spread = lists.groupBy("value").agg(F.min("root").alias("_l"), F.max("root").alias("_h")).where("_l < _h").select("value")
    return lists.join(spread, "value")


def links(docs: DataFrame, classes: DataFrame, bounds: Bounds) -> DataFrame:
    """Roots of the components that similar classes form: node, root, for all but the roots themselves.

    Every pair that shares a listed value is compared, or is in one component by other links.
    """
    near = inverted_lists(classes.select("node", "n", "sketch"), SKETCH, bounds.sketch, bounds.percent).select("node").distinct()
    sets = full_sets(docs, classes, near)
    wide = sets.select("node", "n", F.slice("full", 1, WIDE).alias("sketch"))
    open_lists = inverted_lists(wide, WIDE, bounds.wide, bounds.percent)
    roots = None
    open_lists = open_lists.withColumn("root", F.col("node"))
    for _ in range(STAR_ROUNDS):
        heads = open_lists.groupBy("value").agg(F.max(F.struct("centre", "node", "root", "n", "place")).alias("head"))
        fits = _possible(F.col("n"), F.col("place"), F.col("head.n"), F.col("head.place"), bounds)
        pairs = open_lists.join(heads, "value").where((F.col("root") != F.col("head.root")) & fits).select(
            F.least("node", "head.node").alias("a"), F.greatest("node", "head.node").alias("b")
        )
        roots = _joined(roots, stage(similar(pairs, sets, bounds), "links"))
        # a head has met all others of its list, so it is left out of the next round
        rest = open_lists.join(heads.select("value", F.col("head.node").alias("node")), ["value", "node"], "left_anti")
        open_lists = stage(_unsettled(_with_roots(rest.drop("root"), roots)), "lists")
        if open_lists.isEmpty():
            return roots
    side = lambda name: open_lists.select("value", *(F.col(c).alias(f"{c}_{name}") for c in ("node", "root", "n", "place")))
    fits = _possible(F.col("n_a"), F.col("place_a"), F.col("n_b"), F.col("place_b"), bounds)
    met = side("a").join(side("b"), "value").where((F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")) & fits)
    pairs = met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return _joined(roots, stage(similar(pairs, sets, bounds), "links"))


def _joined(roots: DataFrame | None, found: DataFrame) -> DataFrame:
    """Roots of the components that ``roots`` and new links make: a node and its root stand for all links that made them."""
    release(found.sparkSession)
    if roots is None:
        return components(found)
    return roots if found.isEmpty() else components(found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Sets are linked from a Jaccard similarity of ``percent`` hundredths on.
    component_id is the least doc_id that links reach, kept tells whether it is the row's own. A text without
    words is linked with nothing. Rows with one doc_id and different texts are grouped by their texts. A null doc_id counts
    only where its whole group has none, and then all its rows are kept. Repeated rows have equal
    results; other columns are ignored; no rows give no rows.
    """
    rows = sketches(docs)
    classes = classes_of(rows)
    roots = links(docs, classes, Bounds.of(percent))
    known = classes.select("node", "f1", "f2", "least").join(roots, "node", "left")
    known = known.withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = known.join(least, "root").select("f1", "f2", "component_id")
    worded = rows.where("n > 0").select("doc_id", "n", "f1", "f2").join(named, ["f1", "f2"])
    empty = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    both = worded.select("doc_id", "n", "component_id").unionByName(empty)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return both.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
