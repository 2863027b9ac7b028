"""Vectors as codes of their nearest codebook entries, found by a GNAT over the entries of each codebook.

A node of a GNAT holds some split points of its entries; every other entry belongs to the nearest of them. For each split point and
each child the node stores the least and the greatest distance between them. A search that has found an entry at distance r
leaves out a child if for some split point the child's range lies further than r from the query's own distance to that point: by the
triangle inequality each of its entries is then strictly further than r. All is done in whole numbers: squared distances are exact, their roots are
rounded down where a bound must not be too high and up where it must not be too low, and an entry wins by its squared distance, then its index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkit.llm.common import batch_of, map_arrow
from starkit.llm.vectors import length, limit_of, matrix, products, usable, whole
from starkit.operators.joins import Side, to_dimensions
from starkit.session import stage

#: Split points of a node, and entries up to which a child is a list.
DEGREE = 16
LEAF = 32
#: Vectors that a task searches at a time.
STEP = 4096

CODED = "_id long, _label string, code string, error long"


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of two integer matrices, exact."""
    most = max((int(np.abs(x).max(initial=0)) for x in (left, right)))
    if 4 * most * most * max(left.shape[1], 1) < 1 << 62:
        return (left * left).sum(1)[:, None] + (right * right).sum(1) - 2 * products(left, right)
    return np.stack([((left - row) ** 2).sum(1) for row in right], 1)


def root_down(squares: np.ndarray) -> np.ndarray:
    """The whole part of square roots; the floating-point root is only a first guess."""
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


def root_up(squares: np.ndarray) -> np.ndarray:
    """Square roots rounded up to whole numbers."""
    root = root_down(squares)
    return root + (root * root < squares)


class Gnat:
    """A node over the entries ``index`` of ``points``."""

    def __init__(self, points: np.ndarray, index: np.ndarray | None = None):
        self.index = np.arange(len(points)) if index is None else index
        self.points = points[self.index]
        self.children: list[Gnat | None] = []
        if len(self.index) <= LEAF:
            return
        between = squared(self.points, self.points)
        chosen, nearest = [0], between[0].copy()
        while len(chosen) < min(DEGREE, len(self.index)) and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))  # the entry that lies furthest from those chosen
            nearest = np.minimum(nearest, between[chosen[-1]])
        if len(chosen) == 1:  # all entries are equal: a list
            return
        owner = between[:, chosen].argmin(1)
        owner[chosen] = np.arange(len(chosen))
        member = owner[:, None] == np.arange(len(chosen))
        to_splits = between[:, chosen]
        most = np.iinfo(np.int64).max
        low = np.array([[to_splits[m, i].min(initial=most) for m in member.T] for i in range(len(chosen))])
        high = np.array([[to_splits[m, i].max(initial=0) for m in member.T] for i in range(len(chosen))])
        #: For split point i and child j: bounds of their distances.
        self.low, self.high = root_down(low), root_up(high)
        self.split_index, self.splits = self.index[chosen], self.points[chosen]
        rest = [self.index[m & ~np.isin(np.arange(len(owner)), chosen)] for m in member.T]
        self.children = [Gnat(points, r) if len(r) else None for r in rest]

    def search(self, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, found: np.ndarray) -> int:
        """Improves ``best`` (squared distances) and ``found`` (entries) of the queries ``rows``; how many distances were computed."""
        entries, points = (self.split_index, self.splits) if self.children else (self.index, self.points)
        near = squared(queries[rows], points)
        _take(near, entries, rows, best, found)
        if not self.children:
            return near.size
        down, up = root_down(near), root_up(near)
        home = near.argmin(1)
        computed = near.size
        visited = np.zeros((len(rows), len(self.children)), bool)
        for at_home in (True, False):
            for j, child in enumerate(self.children):
                if child is None:
                    continue
                if at_home:
                    open_ = home == j
                else:
                    radius = root_up(best[rows])
                    gone = (down - self.high[:, j] > radius[:, None]) | (self.low[:, j] - up > radius[:, None])
                    open_ = ~gone.any(1) & ~visited[:, j]
                visited[:, j] |= open_
                if open_.any():
                    computed += child.search(queries, rows[open_], best, found)
        return computed

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each query, of equally near ones the first, and the squared distances."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        found = np.full(len(queries), len(self.index))
        for at in range(0, len(queries), STEP):
            self.search(queries, np.arange(at, min(at + STEP, len(queries))), best, found)
        return found, best


def _take(near: np.ndarray, entries: np.ndarray, rows: np.ndarray, best: np.ndarray, found: np.ndarray) -> None:
    """The nearest of some entries where it is nearer than what was found, or as near with a lower index."""
    order = np.argsort(entries)
    at = order[near[:, order].argmin(1)]
    least, entry = near[np.arange(len(rows)), at], entries[at]
    better = (least < best[rows]) | ((least == best[rows]) & (entry < found[rows]))
    best[rows[better]], found[rows[better]] = least[better], entry[better]


def _partial_sums(sent, width: int):
    """Sums and counts of the parts that are nearest to each entry, one row for each entry that a task has used."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        trees = [Gnat(book) for book in books]
        part_width = width // len(books)
        totals = np.zeros((len(books), len(books[0]), part_width), np.int64)
        counts = np.zeros((len(books), len(books[0])), np.int64)
        for batch in batches:
            rows = matrix(batch.column("_v"), width)
            for p, tree in enumerate(trees):
                piece = rows[:, p * part_width : (p + 1) * part_width]
                found, _ = tree.nearest(piece)
                np.add.at(totals[p], found, piece)
                counts[p] += np.bincount(found, minlength=len(counts[p]))
        part, entry = np.nonzero(counts)
        yield batch_of({
            "part": (part.tolist(), pa.int32()), "entry": (entry.tolist(), pa.int32()), "n": (counts[part, entry].tolist(), pa.int64()),
            "sums": (totals[part, entry].tolist(), pa.list_(pa.int64())),
        })

    return sums


def _codes(sent, width: int):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in sent.value]
        part_width = width // len(trees)
        for batch in batches:
            rows = matrix(batch.column("_v"), width)
            found = [tree.nearest(rows[:, p * part_width : (p + 1) * part_width]) for p, tree in enumerate(trees)]
            digits = max(2, len(f"{len(sent.value[0]) - 1:x}"))
            codes = ["".join(f"{int(i):0{digits}x}" for i in entries) for entries in zip(*(entry for entry, _ in found))]
            error = sum((distance for _, distance in found), np.zeros(len(rows), np.int64))
            yield batch_of({
                "_id": (batch.column("_id"), pa.int64()), "_label": (batch.column("_label"), pa.string()), "code": (codes, pa.string()),
                "error": (error, pa.int64()),
            })

    return coded


def _improved(held: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Codebooks after one round: each entry in use becomes the floored mean of its parts."""
    sent = held.sparkSession.sparkContext.broadcast(books)
    parts = map_arrow(held.select("_v"), _partial_sums(sent, width), "part int, entry int, n long, sums array<long>")
    wide = T.DecimalType(20, 0)  # sums of longs over all tasks may need more digits than a long
    columns = [F.sum(F.col("sums")[i].cast(wide)).alias(f"s{i}") for i in range(width // len(books))]
    # parts x entries rows at most
    rows = parts.groupBy("part", "entry").agg(F.sum("n").alias("n"), *columns).collect()
    books = [book.copy() for book in books]
    for row in rows:
        books[row["part"]][row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width // len(books))]
    return books


def encode(
    rows: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of vectors (vec_id, code, error, label_error), and the codebooks.

    Components become floor(scale * x); a vector is cut into ``parts`` equal parts. A codebook starts as that part of the ``entries`` rows with the
    least ids and is improved ``rounds`` times: every part goes to its nearest entry (of equally near ones the first), and an entry becomes the
    floored mean of its parts. ``code`` has the hexadecimal index of each part's entry, ``error`` is the sum of squared
    distances and ``label_error`` the sum of errors over rows of one label, null being one too.

    Rows without a vector, or with a component that is null or not finite, are left out. Fewer rows than entries make smaller
    codebooks. Rows without id are coded but start no entry; of rows with one id, the least vector comes first. Shorter vectors, and a length that the parts do
    not divide, end in zeros. A component so large that an error would not fit 64 bits is cut to the largest that does; a sum of
    errors beyond 64 bits is null. No rows give no rows, and codebooks without entries.

    The driver holds the codebooks only; tasks send it one sum for each entry.
    """
    spark = rows.sparkSession
    taken = rows.select(F.col(id).cast("long").alias("_id"), F.col(label).cast("string").alias("_label"), F.col(vector).alias("_vector"))
    taken = taken.where(usable(F.col("_vector")))
    width = -(-length(taken, "_vector") // parts) * parts
    held = stage(taken.select("_id", "_label", whole(F.col("_vector"), scale, limit_of(4 * width)).alias("_v")), "vectors")
    least = held.where("_id IS NOT NULL").orderBy("_id", "_v").select("_v").limit(entries).collect()
    start = np.zeros((len(least), width), np.int64)
    for i, row in enumerate(least):
        start[i, : len(row["_v"])] = row["_v"]
    books = [part.copy() for part in np.split(start, parts, axis=1)] if width else [start[:, :0]] * parts
    if len(least):
        for _ in range(rounds):
            books = _improved(held, books, width)
        coded = stage(map_arrow(held, _codes(spark.sparkContext.broadcast(books), width), CODED), "codes")
    else:
        coded = spark.createDataFrame([], CODED)
    # a text in which no label is null, so that null is a key as any other
    keyed = coded.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("_label")), F.lit("")))
    total = F.sum(F.col("error").cast(T.DecimalType(20, 0))).try_cast("long")
    sums = stage(keyed.groupBy("_key").agg(total.alias("label_error")), "label-errors")
    summed = to_dimensions(keyed, [Side(sums, {"_key": "_key"}, ["label_error"])])
    return summed.select(F.col("_id").alias(id), "code", "error", "label_error"), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256, in lowercase hex, of all components of the codebooks as decimal numbers with commas between them."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()
