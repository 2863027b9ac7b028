"""Benchmark decontamination over a distributed positional inverted index.

The index is a table of shards. A shard holds the postings of the documents of one block: its terms in order,
how often each occurs, and the positions of each, ascending, in the block. It is built where the documents are read; no posting is
shuffled, so that a term that a third of all words are splits like everything else.

A phrase is found by intersecting the lists of its terms, each moved by the term's offset, from the rarest term in the corpus to the most common one.
Phrases of many items are looked up together: a list is a range of one sorted array, an intersection a binary search in it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import batch_of, map_arrow
from starkit.session import stage

WINDOW = 10
#: A shard is closed once it holds so many words; a longer document is a shard of its own.
SHARD_WORDS = 1 << 19
#: Words of the items that are searched for at a time; what is broadcast is bounded by it.
BLOCK_WORDS = 1_000_000
#: Words between documents of a shard, so that no phrase or neighbourhood reaches from one into the next.
GAP = 1 << 10

SHARDS = "shard long, terms binary, counts binary, positions binary, doc_ids array<long>, lengths array<long>"
HITS = "shard long, place int, doc_id long, n_words long, items array<string>, spans array<long>, near array<string>"

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: A-Z to a-z, other ASCII that is no digit or small letter to a space; bytes of other characters stay.
_WORDS = bytes(c if c in _KEPT or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text after A-Z are lower-cased: digits, small letters and all characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split() if text else []


# ---------------------------------------------------------------- index


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written once. A document without words is in it, without postings."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        ids: list[int | None] = []
        lengths: list[int] = []
        codes: list[int] = []
        terms: defaultdict[bytes, int] = defaultdict(lambda: len(terms))

        def close() -> pa.RecordBatch:
            names = sorted(terms)
            rank = np.empty(len(names), np.int64)
            rank[np.fromiter((terms[name] for name in names), np.int64, len(names))] = np.arange(len(names))
            ranks = rank[np.array(codes, np.int64)]
            places = np.arange(len(codes)) + GAP * np.repeat(np.arange(len(lengths)), lengths)
            order = np.argsort(ranks, kind="stable")
            counts = np.bincount(ranks, minlength=len(names))
            return batch_of({
                "shard": ([number], pa.int64()), "terms": ([b" ".join(names)], pa.binary()),
                "counts": ([counts.astype("<i4").tobytes()], pa.binary()),
                "positions": ([np.diff(places[order], prepend=0).astype("<i4").tobytes()], pa.binary()),
                "doc_ids": ([ids], pa.list_(pa.int64())), "lengths": ([lengths], pa.list_(pa.int64())),
            })

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                ids.append(doc_id)
                lengths.append(len(words))
                codes.extend(map(terms.__getitem__, words))
                if len(codes) >= shard_words:
                    yield close()
                    number, ids, lengths, codes = number + 1, [], [], []
                    terms.clear()
        if ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stage(map_arrow(rows, shards, SHARDS), "postings")


class Shard:
    """Lists of one shard as one ascending array of (term, position)."""

    def __init__(self, terms: bytes, counts: bytes, positions: bytes, lengths: list[int]):
        self.terms = terms.split(b" ") if terms else []
        self.counts = np.frombuffer(counts, "<i4").astype(np.int64)
        self.places = np.cumsum(np.frombuffer(positions, "<i4"), dtype=np.int64)
        self.lengths = np.array(lengths, np.int64)
        ends = np.cumsum(self.lengths)
        self.starts = ends - self.lengths + GAP * np.arange(len(lengths))
        self.firsts = np.concatenate(([0], np.cumsum(self.counts)))
        self.width = int(ends[-1] if len(ends) else 0) + GAP * (len(lengths) + 1)
        self.keys = np.repeat(np.arange(len(self.terms)), self.counts) * self.width + self.places

    def numbers(self, vocabulary: dict[bytes, int]) -> np.ndarray:
        """For each term of the vocabulary its number here, or -1."""
        found = np.full(len(vocabulary) + 1, -1, np.int64)
        for i, term in enumerate(self.terms):
            at = vocabulary.get(term)
            if at is not None:
                found[at] = i
        return found

    def occurs(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each term stands at each place."""
        keys = terms * self.width + places
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return (terms >= 0) & (places >= 0) & (self.keys[at] == keys) if len(self.keys) else np.zeros(len(keys), bool)

    def nearest(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How far the nearest occurrence of each term is from each place."""
        far = np.int64(1) << 40
        if not len(self.keys):
            return np.full(len(places), far)
        keys = terms * self.width + places
        at = np.searchsorted(self.keys, keys)
        after, before = np.minimum(at, len(self.keys) - 1), np.maximum(at - 1, 0)
        gaps = [np.where(self.keys[i] // self.width == terms, abs(self.keys[i] - keys), far) for i in (after, before)]
        return np.where(terms >= 0, np.minimum(*gaps), far)

    def postings(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions of each term: which of the terms, and the position."""
        counts = np.where(terms >= 0, self.counts[terms] if len(self.counts) else 0, 0)
        which = np.repeat(np.arange(len(terms)), counts)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        return which, self.places[self.firsts[terms[which]] + inner]

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1


# ---------------------------------------------------------------- search


@dataclass
class Phrases:
    """Phrases of one block of items, each with its terms ordered from the rarest one.

    Phrases are grouped by length; ``groups`` has for each the terms and offsets (a row for each
    phrase) and the items. ``rare`` has an item and the rarest distinct terms of one of its texts in each entry.
    """

    vocabulary: dict[bytes, int]
    items: list[str]
    groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    rare: list[tuple[int, np.ndarray]]

    @classmethod
    def of(cls, items: list[tuple[str, list[bytes]]], frequency: Counter, window: int, terms: int) -> Phrases:
        vocabulary = {term: i for i, term in enumerate(sorted({w for _, words in items for w in words}))}
        names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(names)}
        by_length: defaultdict[int, dict] = defaultdict(dict)
        rare: dict[tuple, None] = {}
        for name, words in items:
            if not words:
                continue
            for start in range(max(1, len(words) - window + 1)):
                phrase = tuple(words[start : start + window])
                by_length[len(phrase)][(phrase, number[name])] = None
            distinct = sorted(set(words), key=lambda w: (frequency[w], w))[:terms]
            rare[number[name], tuple(distinct)] = None
        groups = []
        for phrases in by_length.values():
            order = [sorted(range(len(p)), key=lambda i: (frequency[p[i]], i)) for p, _ in phrases]
            coded = [[vocabulary[p[i]] for i in o] for (p, _), o in zip(phrases, order)]
            groups.append((np.array(coded), np.array(order), np.array([item for _, item in phrases])))
        nearby = [(item, np.array([vocabulary[w] for w in distinct], np.int64)) for item, distinct in rare]
        return cls(vocabulary, names, groups, nearby)

    def exact(self, shard: Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences: item, first position, number of words."""
        here, found = shard.numbers(self.vocabulary), []
        for terms, offsets, items in self.groups:
            which, places = shard.postings(here[terms[:, 0]])
            starts = places - offsets[which, 0]
            for i in range(1, terms.shape[1]):
                kept = shard.occurs(here[terms[which, i]], starts + offsets[which, i])
                which, starts = which[kept], starts[kept]
            found.append((items[which], starts, np.full(len(which), terms.shape[1])))
        return tuple(map(np.concatenate, zip(*found))) if found else (np.empty(0, np.int64),) * 3

    def proximity(self, shard: Shard, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Item and place of each occurrence of a text's rarest term with its other rare terms at most ``slop`` words off."""
        here = shard.numbers(self.vocabulary)
        items = np.array([item for item, _ in self.rare], np.int64)
        if not len(items):
            return items, items
        size = max(len(r) for _, r in self.rare)
        terms = np.array([[*r, *[r[-1]] * (size - len(r))] for _, r in self.rare])  # a repeated term changes nothing
        which, places = shard.postings(here[terms[:, 0]])
        for i in range(1, size):
            kept = shard.nearest(here[terms[which, i]], places) <= slop
            which, places = which[kept], places[kept]
        return items[which], places


def frequencies(index: DataFrame, terms: set[bytes]) -> Counter:
    """How often each of ``terms`` occurs in the corpus; only terms and counts of the index are read."""
    wanted = index.sparkSession.sparkContext.broadcast(terms)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for names, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist()):
                for name, n in zip(names.split(b" "), np.frombuffer(counts, "<i4").tolist()):
                    if name in wanted.value:
                        total[name] += n
        yield batch_of({"term": (list(total), pa.binary()), "n": (list(total.values()), pa.int64())})

    found = map_arrow(index.select("terms", "counts"), counted, "term binary, n long")
    return Counter({bytes(r["term"]): r["n"] for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect()})


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of about so many characters of text; a block at a time is on the driver."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // (4 * block_words)))
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        rows = [(row["item_id"], words_of(row["text"])) for row in part.distinct().toLocalIterator()]
        yield sorted(rows)


def search(index: DataFrame, items: list[tuple[str, list[bytes]]], window: int = WINDOW, terms: int = 4, slop: int = 20) -> DataFrame:
    """Every document of the index with its exact and its proximity matches of ``items``.

    items: item_ids with a window in the document; spans: first position and end of each occurrence in turn;
    near: item_ids with a text whose ``terms`` rarest distinct terms stand at most ``slop`` words from an occurrence of the rarest.
    """
    if slop >= GAP:
        raise ValueError(f"slop must be below {GAP}")
    phrases = Phrases.of(items, frequencies(index, {w for _, words in items for w in words}), window, terms)
    shared = index.sparkSession.sparkContext.broadcast(phrases)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                shard = Shard(row["terms"], row["counts"], row["positions"], row["lengths"])
                n = len(row["lengths"])
                matches: list[set[str]] = [set() for _ in range(n)]
                nearby: list[set[str]] = [set() for _ in range(n)]
                spans: list[list[int]] = [[] for _ in range(n)]
                item, start, size = wanted.exact(shard)
                place = shard.document(start)
                first = start - shard.starts[place]
                for d, name, a, b in zip(place.tolist(), item.tolist(), first.tolist(), (first + size).tolist()):
                    matches[d].add(wanted.items[name])
                    spans[d] += (a, b)
                item, at = wanted.proximity(shard, slop)
                for d, name in zip(shard.document(at).tolist(), item.tolist()):
                    nearby[d].add(wanted.items[name])
                yield batch_of({
                    "shard": ([row["shard"]] * n, pa.int64()), "place": (range(n), pa.int32()),
                    "doc_id": (row["doc_ids"], pa.int64()), "n_words": (row["lengths"], pa.int64()),
                    "items": ([sorted(s) for s in matches], pa.list_(pa.string())),
                    "spans": (spans, pa.list_(pa.int64())), "near": ([sorted(s) for s in nearby], pa.list_(pa.string())),
                })

    return map_arrow(index, matched, HITS)


def covered(spans):
    """How many positions lie in any of the spans (first and end in turn)."""
    starts = F.filter(spans, lambda _, i: i % 2 == 0)
    ends = F.filter(spans, lambda _, i: i % 2 == 1)
    pairs = F.array_sort(F.arrays_zip(starts.alias("a"), ends.alias("b")))
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    add = lambda s, p: F.struct(
        (s["n"] + F.greatest(p["b"] - F.greatest(p["a"], s["to"]), F.lit(0))).alias("n"),
        F.greatest(s["to"], p["b"]).alias("to"),
    )
    return F.aggregate(pairs, state, add, lambda s: s["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, items, near, contaminated.

    n_hit counts words inside any occurrence of a window of an item. Items without text, words or item_id match nothing; items
    with one item_id count once, with the windows of all their texts. A null text has no words. Repeated
    rows and null doc_ids have results of their own; other columns are ignored; no rows give no rows.
    """
    index = build_index(docs)
    found = None
    for items in item_blocks(benchmark, block_words):
        part = search(index, items, window)
        found = part if found is None else found.unionByName(part)
        several = found is not part
    if several:
        found = found.groupBy("shard", "place").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            *(F.flatten(F.collect_list(name)).alias(name) for name in ("items", "spans", "near")),
        )
    hit = covered(F.col("spans"))
    once = [F.array_sort(F.array_distinct(name)).alias(name) for name in ("items", "near")]
    return found.select("doc_id", "n_words", hit.alias("n_hit"), *once, (F.size("spans") > 0).alias("contaminated"))
