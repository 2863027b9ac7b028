"""Hard negatives by a secondary sort of (anchor, descending score, id).

Each task holds its rows against a block of anchors and keeps, for every anchor, the rows that can still be among the answers: the best of
the same label, then the best below each positive. What is left are pairs with a key of 25 bytes that sorts as (anchor, descending score,
positives first, id). They are dealt by anchor and sorted within partitions, and one pass over the sorted pairs opens a window
at each positive and emits negatives into the windows that are open, with no more than the open windows of one anchor in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import batch_of, map_arrow
from starkit.llm.vectors import length, limit_of, matrix, products, usable, whole
from starkit.session import fresh_path, stage

#: Bytes of anchors that are sent to the tasks at a time, and scores that a task holds at a time.
BLOCK_BYTES = 16 << 20
CELLS = 1 << 21

PAIRS = "anchor long, key binary"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
POSITIVE, NEGATIVE = 0, 1
_SIGN = np.uint64(1 << 63)
_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])


def pack(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> pa.RecordBatch:
    """Pairs whose keys, as bytes, sort by anchor, descending score, kind and id."""
    keys = np.empty(len(anchor), _KEY)
    keys["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ _SIGN
    keys["score"] = ~(score.astype(np.int64).view(np.uint64) ^ _SIGN)
    keys["kind"] = kind
    keys["id"] = ids.astype(np.int64).view(np.uint64) ^ _SIGN
    offsets = pa.py_buffer((np.arange(len(keys) + 1, dtype=np.int32) * _KEY.itemsize).tobytes())
    column = pa.Array.from_buffers(pa.binary(), len(keys), [None, offsets, pa.py_buffer(keys.tobytes())])
    return batch_of({"anchor": (anchor.tolist(), pa.int64()), "key": (column, pa.binary())})


def unpack(column: pa.Array) -> tuple[list[int], list[int], list[int], list[int]]:
    """anchor, score, kind and id of packed keys."""
    keys = np.frombuffer(b"".join(column.to_pylist()), _KEY)
    plain = lambda x: (x.astype(np.uint64) ^ _SIGN).view(np.int64).tolist()
    return plain(keys["anchor"]), plain(~keys["score"].astype(np.uint64)), keys["kind"].tolist(), plain(keys["id"])


def first_of_rows(scores: np.ndarray, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the ``k`` highest wanted scores of each row; of equal scores those of the first columns."""
    counts = wanted.sum(1)
    few = counts <= k
    rows, columns = np.nonzero(wanted & few[:, None])
    dense = np.flatnonzero(~few)
    if not len(dense):
        return rows, columns
    n = scores.shape[1]
    part, held = scores[dense], wanted[dense]
    if np.abs(part).max(initial=0) < (1 << 62) // n:
        ranked = np.where(held, part * n + np.arange(n - 1, -1, -1), np.iinfo(np.int64).min)
        best = np.argpartition(ranked, n - k, axis=1)[:, n - k :]
    else:
        best = np.array([sorted(np.flatnonzero(h).tolist(), key=lambda c: (-int(s[c]), c))[:k] for s, h in zip(part, held)])
    return np.concatenate([rows, np.repeat(dense, k)]), np.concatenate([columns, best.ravel()])


class Best:
    """The ``k`` best rows of each of ``n`` lists: highest scores first, of equal ones the least id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.lists, self.scores, self.ids = (np.empty(0, np.int64) for _ in range(3))
        #: Scores from which on a row can enter a list.
        self.least = np.full(n, np.iinfo(np.int64).min)

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(lists):
            return
        lists, scores, ids = (np.concatenate(x) for x in ((self.lists, lists), (self.scores, scores), (self.ids, ids)))
        order = np.lexsort((ids, ~scores, lists))
        lists, scores, ids = lists[order], scores[order], ids[order]
        first = np.searchsorted(lists, lists)
        place = np.arange(len(lists)) - first
        full = place == self.k - 1
        self.least[lists[full]] = scores[full]
        self.lists, self.scores, self.ids = (x[place < self.k] for x in (lists, scores, ids))


class Anchors:
    """A block of anchors: row numbers, labels, vectors, and the score windows of their negatives once positives are known."""

    def __init__(self, rows: list, width: int):
        self.width = width
        self.row = np.array([r["_row"] for r in rows], np.int64)
        self.label = np.array([r["_label"] for r in rows], np.int64)
        self.vector = np.zeros((len(rows), width), np.int64)
        for i, r in enumerate(rows):
            self.vector[i, : len(r["_v"])] = r["_v"]
        self.window_of, self.low, self.high = (np.empty(0, np.int64) for _ in range(3))

    def open_windows(self, pairs: list[tuple[int, int]], low: int, high: int) -> None:
        """Windows low * p <= high * n <= high * p for the pairs (anchor row, positive score); equal ones of an anchor are one."""
        at = {row: i for i, row in enumerate(self.row.tolist())}
        found = sorted({(at[row], -(-low * score // high), score) for row, score in pairs})
        found = [w for w in found if w[1] <= w[2]]
        self.window_of, self.low, self.high = (np.array([w[i] for w in found], np.int64) for i in range(3))


def _slices(batches: Iterator[pa.RecordBatch], anchors: Anchors) -> Iterator[tuple]:
    """(ids, row numbers, labels, scores of all anchors) of a few rows at a time, rows in the order of their ids."""
    step = max(CELLS // max(len(anchors.row), 1), 16)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            ids, row, label = (part.column(name).to_numpy() for name in ("_id", "_row", "_label"))
            order = np.lexsort((row, ids))
            scores = products(anchors.vector, matrix(part.column("_v"), anchors.width)[order])
            yield ids[order], row[order], label[order], scores


def _positive_pairs(sent, k: int):
    """The best rows of the anchor's label in this task, the anchor itself left out."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = sent.value
        best = Best(len(anchors.row), k)
        for ids, row, label, scores in _slices(batches, anchors):
            wanted = (label == anchors.label[:, None]) & (row != anchors.row[:, None]) & (scores >= best.least[:, None])
            a, c = first_of_rows(scores, wanted, k)
            best.add(a, scores[a, c], ids[c])
        yield pack(anchors.row[best.lists], best.scores, POSITIVE, best.ids)

    return pairs


def _negative_pairs(sent, k: int):
    """The best rows of other labels in each window of an anchor in this task; a row in several windows is one pair."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = sent.value
        best = Best(len(anchors.window_of), k)
        # windows of one number within their anchors are looked at together
        turn = np.arange(len(anchors.window_of)) - np.searchsorted(anchors.window_of, anchors.window_of)
        turns = [np.flatnonzero(turn == i) for i in range(int(turn.max(initial=-1)) + 1)]
        for ids, row, label, scores in _slices(batches, anchors):
            other = label != anchors.label[:, None]
            for windows in turns:
                of = anchors.window_of[windows]
                part = scores[of]
                low = np.maximum(anchors.low[windows], best.least[windows])
                wanted = other[of] & (part >= low[:, None]) & (part <= anchors.high[windows][:, None])
                w, c = first_of_rows(part, wanted, k)
                # row numbers make rows with one id and score different pairs
                best.add(windows[w], part[w, c], ids[c])
        found = np.stack([anchors.row[anchors.window_of[best.lists]], best.scores, best.ids], 1)
        a, s, i = _once(found, best.lists).T
        yield pack(a, s, NEGATIVE, i)

    return pairs


def _once(found: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """Equal pairs as often as the window that holds most of them has them."""
    if not len(found):
        return found
    order = np.lexsort((lists, found[:, 2], found[:, 1], found[:, 0]))
    found, lists = found[order], lists[order]
    same = np.concatenate([[False], (found[1:] == found[:-1]).all(1)])
    group = np.cumsum(~same) - 1
    in_window = np.concatenate([[False], same[1:] & (lists[1:] == lists[:-1])])
    place = np.arange(len(found)) - np.maximum.accumulate(np.where(in_window, 0, np.arange(len(found))))
    _, first = np.unique(np.stack([group, place], 1), axis=0, return_index=True)
    return found[first]


def _first(k: int):
    """The first ``k`` pairs of each anchor of sorted pairs."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n = None, 0
        for batch in batches:
            rows, scores, ids = [], [], []
            for anchor, score, _, id_ in zip(*unpack(batch.column("key"))):
                current, n = anchor, (n + 1 if anchor == current else 1)
                if n <= k:
                    rows.append(anchor)
                    scores.append(score)
                    ids.append(id_)
            yield pack(np.array(rows, np.int64), np.array(scores, np.int64), POSITIVE, np.array(ids, np.int64))

    return kept


def _emit(ids_of, k: int, low: int, high: int):
    """Negatives for the windows that positives have opened, from sorted pairs."""

    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_ = None, []
        for batch in batches:
            out = []
            for anchor, score, kind, id_ in zip(*unpack(batch.column("key"))):
                if anchor != current:
                    current, open_ = anchor, []
                if kind == POSITIVE:
                    open_.append([id_, score, 0])
                    continue
                open_ = [w for w in open_ if w[2] < k and low * w[1] <= high * score]
                for window in open_:
                    window[2] += 1
                    out.append((ids_of.value[anchor], window[0], window[2], id_, window[1], score))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = [field.split()[0] for field in MINED.split(", ")]
            columns = zip(*out) if out else [()] * len(names)
            yield batch_of({name: (values, kind) for name, values, kind in zip(names, columns, kinds)})

    return mined


def _sorted(pairs: DataFrame) -> DataFrame:
    """The secondary sort: all pairs of an anchor in one partition, by their packed keys. An anchor has a few pairs from each task at most."""
    return pairs.repartition("anchor").sortWithinPartitions("key")


def mine(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Hard negatives of the rows for which ``anchors`` holds: MINED.

    A row's score is the inner product of floor(scale * x) with the anchor's. An anchor's positives are the ``positives`` best
    other rows of its label; for each, the ``negatives`` best rows of other labels with low * positive <= high * negative <= high * positive
    are returned. Higher scores come first, of equal ones the smaller id.

    Rows without id, label (a whole number) or vector, or with a component that is null or not finite, take no part. Vectors of different
    length are compared as if the shorter ended in zeros. A component so large that scores would not fit 64 bits is cut to the largest
    that does. Repeated rows are rows of their own: each anchor among them has its own results, in which the others are positives.
    No rows or no anchors give no rows. Other columns are ignored, whatever their names.

    Anchors are sent to the tasks in blocks of ``block_bytes``; every block is held against all rows, twice.
    """
    spark = rows.sparkSession
    taken = rows.select(
        F.col(id).cast("long").alias("_id"), F.col(label).cast("long").alias("_label"), F.col(vector).alias("_vector"),
        F.coalesce(anchors, F.lit(False)).alias("_anchor"),
    )
    taken = taken.where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & usable(F.col("_vector")))
    width = length(taken, "_vector")
    numbers = whole(F.col("_vector"), scale, limit_of(width)).alias("_v")
    # numbered once and written, so that a row keeps its number
    held = stage(taken.select(F.monotonically_increasing_id().alias("_row"), "_id", "_label", numbers, "_anchor"), "vectors")
    n = held.where("_anchor").count()
    path = fresh_path(spark, "hard-negatives")
    spark.createDataFrame([], MINED).write.parquet(f"{path}/block=-1")
    blocks = -(-n * max(width, 1) * 8 // block_bytes)
    block_of = F.pmod(F.xxhash64("_row"), F.lit(max(blocks, 1)))
    for block in range(blocks):
        chosen = held.where(F.col("_anchor") & (block_of == block)).select("_row", "_id", "_label", "_v").collect()
        data = Anchors(chosen, width)
        sent = spark.sparkContext.broadcast(data)
        best = stage(map_arrow(_sorted(map_arrow(held, _positive_pairs(sent, positives), PAIRS)), _first(positives), PAIRS), "positives")
        # at most ``positives`` short rows for each anchor of the block
        keys = best.select("key").toArrow().column("key").combine_chunks()
        data.open_windows(list(zip(*unpack(keys)[:2])), low, high)
        opened = spark.sparkContext.broadcast(data)
        ids_of = spark.sparkContext.broadcast({r["_row"]: r["_id"] for r in chosen})
        pairs = best.unionByName(map_arrow(held, _negative_pairs(opened, negatives), PAIRS))
        map_arrow(_sorted(pairs), _emit(ids_of, negatives, low, high), MINED).write.parquet(f"{path}/block={block}")
    return spark.read.schema(MINED).parquet(path).select(*[field.split()[0] for field in MINED.split(", ")])
