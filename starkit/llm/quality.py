"""Quality rules over statistics of whole texts, and isolation forests for what no fixed rule catches.

Statistics are taken in one pass and written. One forest is grown over all statistics and one over each alone, on a bounded
sample of labelled good rows; their thresholds are calibrated from all labelled rows, and every row is scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from starkit.llm.common import batch_of, map_arrow
from starkit.session import stage

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Trees of each forest and rows of each tree; their product bounds the sample that the forests are fitted on.
TREES, TREE_ROWS = 64, 256
#: Scores are counted in so many steps to calibrate the thresholds.
STEPS = 1000
#: Share of bad rows that a threshold must have among the labelled rows over it.
PRECISION = 0.75
#: Words that a text is taken to have beyond its own when shares are taken, so that short texts are not extreme by chance.
PRIOR_WORDS = 30
PRIOR_CHARS = 150

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("f_word_chars", "f_symbols", "f_dup_lines", "f_repeats", "f_upper", "f_digits", "f_punctuation")
#: The statistics of each forest.
FORESTS = (FEATURES, *((name,) for name in FEATURES))

_ASCII_UPPER = re.compile(r"[A-Z]")
_DIGIT = re.compile(r"[0-9]")
_PUNCTUATION = re.compile(r"[!-/:-@\[-`{-~]")


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict = {}
    codes = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    done = 1
    while done < window:  # codes[i] stands for the ``done`` words from i on
        step = min(done, window - done)
        pairs = codes[: len(codes) - step] * (int(codes.max()) + 1) + codes[step:]
        found, codes = np.unique(pairs, return_inverse=True)
        done += step
        if len(found) == len(pairs):
            return 0
    hits = np.flatnonzero(np.bincount(codes)[codes] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, hits, 1)
    np.add.at(edges, hits + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measure(text: str) -> tuple:
    """COUNTS and FEATURES of one text."""
    words = text.encode("utf-8", "surrogatepass").split()  # white space of bytes: \\x20 and \\x09-\\x0D
    lines = text.split("\n")
    worded = [line for line in lines if line.strip(" \t\n\x0b\x0c\r")]
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    repeats, n = repeated_words(words), len(words)
    doubled = len(worded) - len(set(worded))
    shares = [symbols, len(worded) and doubled * n / len(worded), repeats]
    marks = [len(pattern.findall(text)) for pattern in (_ASCII_UPPER, _DIGIT, _PUNCTUATION)]
    return (
        n, chars, symbols, doubled, repeats, (chars + PRIOR_CHARS) / (n + PRIOR_WORDS),
        *(share / (n + PRIOR_WORDS) for share in shares), *(mark / (chars + PRIOR_CHARS) for mark in marks),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the COUNTS, the FEATURES and base_failed of every row; written once. A null text has no words."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*(measure(text or "") for text in batch.column("text").to_pylist())))
            columns = columns or [[]] * (len(COUNTS) + len(FEATURES))
            kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(FEATURES)
            named = {name: (values, kind) for name, values, kind in zip(COUNTS + FEATURES, columns, kinds)}
            yield batch_of({"doc_id": (batch.column("doc_id"), pa.int64())} | named)

    schema = "doc_id long, " + ", ".join([f"{c} long" for c in COUNTS] + [f"{f} double" for f in FEATURES])
    found = map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), measured, schema)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return stage(found.withColumn("base_failed", failed), "quality-statistics")


@dataclass
class Forest:
    """Isolation trees as arrays: feature (-1 for a leaf), value and children of each split, the depth that a leaf stands for."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    roots: list[int]
    usual: float

    @staticmethod
    def average_depth(n: int) -> float:
        """Mean depth of an unsuccessful search in a binary tree of n rows."""
        return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n

    @classmethod
    def fit(cls, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 17) -> Forest:
        """``rows``: in a fixed order. Each tree is grown on rows of its own as far as there are enough."""
        random = np.random.default_rng(seed)
        size = min(tree_rows, len(rows))
        limit = max(1, int(np.ceil(np.log2(max(size, 2)))))
        order = np.concatenate([random.permutation(len(rows)) for _ in range(-(-trees * size // len(rows)))])
        nodes: list[list] = []

        def grow(part: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append((-1, 0.0, -1, -1, depth + cls.average_depth(len(part))))
            low, high = part.min(0), part.max(0)
            varied = np.flatnonzero(high > low)
            if depth >= 2 * limit or len(part) < 2 or not len(varied):
                return at
            feature = int(random.choice(varied))
            value = random.uniform(low[feature], high[feature])
            below = part[:, feature] < value
            if below.any() and not below.all():
                nodes[at] = (feature, value, grow(part[below], depth + 1), grow(part[~below], depth + 1), 0.0)
            return at

        roots = [grow(rows[order[t * size : (t + 1) * size]], 0) for t in range(trees)]
        return cls(*(np.array(column) for column in zip(*nodes)), roots, cls.average_depth(size) or 1.0)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path length over the usual one: near 1 is anomalous."""
        total = np.zeros(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            while True:
                inner = np.flatnonzero(self.feature[at] >= 0)
                if not len(inner):
                    break
                node = at[inner]
                below = rows[inner, self.feature[node]] < self.value[node]
                at[inner] = np.where(below, self.left[node], self.right[node])
            total += self.depth[at]
        return np.exp2(-total / len(self.roots) / self.usual)


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of rows with a quality label; several labels of one document count as good if most are."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    one = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).alias("_good"))
    return stats.join(one, "doc_id")


def fit_forests(stats: DataFrame, known: DataFrame) -> list[Forest]:
    """A forest for each of FORESTS over good rows: labelled ones, or all that pass the base rules if there are none.

    The sample has about TREES * TREE_ROWS rows and never more than twice that, chosen by the hash of what is in a row, so
    what reaches the driver does not grow with the number of tasks. No rows: no forests.
    """
    bound = TREES * TREE_ROWS
    for source in (known.where("_good AND NOT base_failed"), stats.where("NOT base_failed")):
        total = source.count()
        place = F.pmod(F.xxhash64("doc_id", *FEATURES), F.lit(1 << 30)) / (1 << 30)
        part = source.where(place < bound / total) if total > bound else source
        sample = sorted(tuple(row) for row in part.select(*FEATURES).limit(2 * bound).collect())
        if sample:
            columns = dict(zip(FEATURES, np.array(sample, float).T))
            return [Forest.fit(np.column_stack([columns[name] for name in names])) for names in FORESTS]
    return []


def score(stats: DataFrame, forests: list[Forest]) -> DataFrame:
    """``stats`` with a column ``scores``: one score for each forest."""
    shared = stats.sparkSession.sparkContext.broadcast(forests)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in FEATURES}
            each = [
                forest.scores(np.column_stack([columns[name] for name in names]))
                for names, forest in zip(FORESTS, shared.value)
            ]
            flat = pa.array(np.column_stack(each).ravel() if each else [], pa.float64())
            offsets = pa.array(np.arange(batch.num_rows + 1) * len(each), pa.int32())
            scores = pa.ListArray.from_arrays(offsets, flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "scores"])

    return map_arrow(stats, scored, StructType([*stats.schema, StructField("scores", ArrayType(DoubleType()))]))


def calibrate(scored: DataFrame, forests: int, precision: float = PRECISION) -> list[float]:
    """For each forest the score from which it rejects.

    Forests are taken in turn, each time the one and the threshold that reject most bad labelled rows beyond the good
    ones it costs, counted over all labelled rows that pass the base rules and that no forest has rejected yet. At least ``precision`` of the
    rows over a threshold must be bad. A forest that gains nothing more rejects nothing, nor does any without labels.
    """
    thresholds = [2.0] * forests
    rows = stage(scored.where("NOT base_failed").select("_good", "scores"), "labelled-scores")
    for _ in range(forests):
        counts = np.zeros((2, forests, STEPS))
        left = rows.where(~rejected(thresholds)).select("_good", F.posexplode("scores").alias("forest", "score"))
        step = F.least(F.floor(F.col("score") * STEPS), F.lit(STEPS - 1)).cast("int").alias("step")
        for row in left.groupBy("_good", "forest", step).count().collect():
            counts[int(row["_good"]), row["forest"], row["step"]] = row["count"]
        good, bad = np.cumsum(counts[:, :, ::-1], axis=2)[:, :, ::-1][[1, 0]]
        gain = np.where(bad >= precision * (bad + good), bad - good, 0)
        forest, at = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if gain[forest, at] <= 0:
            break
        thresholds[forest] = float(at / STEPS)
    return thresholds


def rejected(thresholds: list[float]) -> Column:
    """Whether a score of a row reaches the threshold of its forest."""
    found = F.lit(False)
    for i, limit in enumerate(thresholds):
        found = found | F.coalesce(F.get("scores", F.lit(i)) >= limit, F.lit(False))
    return found


def assess(docs: DataFrame, labels: DataFrame, precision: float = PRECISION) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, the COUNTS, base_failed, scores, kept.

    kept is false where a base rule fails, else where a score reaches the calibrated threshold of its forest.
    Null and empty texts have no words and fail. Repeated rows have equal results, null doc_ids have no
    label, other columns are ignored; no rows give no rows, and without labels the base rules alone reject.
    """
    stats = statistics(docs)
    known = stage(labelled(stats, labels), "labelled")
    forests = fit_forests(stats, known)
    scored = score(stats, forests)
    thresholds = calibrate(score(known, forests), len(forests), precision) if forests else []
    kept = ~F.col("base_failed") & ~rejected(thresholds)
    return scored.select("doc_id", *COUNTS, "base_failed", "scores", kept.alias("kept"))
