"""Token ids in files with Elias-Fano coded document boundaries.

A file set is a table of blocks (one row each, in a store that Spark writes and reads). A block holds the ids of
consecutive documents as one array and two Elias-Fano sequences: the ends of its documents in that array and their
doc_ids. Two bits and the low bits of each value are all that a boundary takes, and sampled select
positions find the i-th boundary without a table of 64-bit offsets.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import batch_of, byte_level_encoder, map_arrow
from starkit.session import stage

MAGIC = b"SKEF"
#: A select position is stored for every so many values.
SAMPLE = 64
#: A block is closed once it holds so many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 18

FILES = "part int, block int, start_in_part long, n_docs long, n_null_ids long, n_ids long, payload binary"
DOCUMENTS = "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long"


class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        pack = lambda x: np.packbits(x.astype(np.uint8).ravel(), bitorder="little")
        return cls(n, low_bits, pack(bits), pack(unary), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = struct.pack("<QBQQQ", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        """The sequence that begins at ``at`` and where it ends."""
        n, low_bits, lows, highs, samples = struct.unpack_from("<QBQQQ", data, at)
        at += struct.calcsize("<QBQQQ")
        low = np.frombuffer(data, np.uint8, lows, at)
        high = np.frombuffer(data, np.uint8, highs, at + lows)
        sampled = np.frombuffer(data, "<u4", samples, at + lows + highs)
        return cls(n, low_bits, low, high, sampled), at + lows + highs + 4 * samples

    def _low(self, i: int) -> int:
        first, last = i * self.low_bits, (i + 1) * self.low_bits
        word = int.from_bytes(self.low[first // 8 : (last + 7) // 8].tobytes(), "little")
        return (word >> first % 8) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value i, from the nearest sampled position before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        while left:
            byte = at // 8
            bits = np.unpackbits(self.high[byte : byte + 64], bitorder="little")
            ones = np.flatnonzero(bits[at % 8 + 1 :])
            if len(ones) >= left:
                at, left = at + 1 + int(ones[left - 1]), 0
            else:
                at, left = byte * 8 + len(bits) - 1, left - len(ones)
        return ((at - i) << self.low_bits) | self._low(i)

    def values(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | low


class Block:
    """One block: ids of any document in it by position."""

    def __init__(self, payload: bytes):
        data = memoryview(payload)
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a block of token ids")
        self.width, self.least = struct.unpack_from("<Bq", data, 4)
        self.ends, at = EliasFano.from_bytes(data, 13)
        self.doc_ids, at = EliasFano.from_bytes(data, at)
        self.ids = np.frombuffer(data, f"<u{self.width}", -1, at)

    @staticmethod
    def encode(doc_ids: list[int], lengths: list[int], ids: np.ndarray, width: int) -> bytes:
        """``doc_ids``: ascending, of the last of the documents whose lengths are given (those before have none)."""
        least = doc_ids[0] if doc_ids else 0
        gaps = np.array([doc_id - least for doc_id in doc_ids], np.uint64)
        head = MAGIC + struct.pack("<Bq", width, least)
        ends = EliasFano.of(np.cumsum(lengths, dtype=np.int64)).to_bytes()
        return head + ends + EliasFano.of(gaps).to_bytes() + ids.astype(f"<u{width}").tobytes()

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]

    def all_doc_ids(self) -> list[int | None]:
        known = [self.least + int(gap) for gap in self.doc_ids.values()]
        return [None] * (self.ends.n - len(known)) + known


def write(docs: DataFrame, tokenizer: str, end_id: int = 0, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Writes the ids of ``docs`` (doc_id, text) in ascending doc_id order; returns the table of blocks as read back.

    A null text is empty, so its document is the end id alone. Null doc_ids come first. Rows with one
    doc_id are ordered by the hash of their text; equal rows are all written. Other columns are ignored. No
    rows: a table without blocks. Rows are dealt by ranges of (doc_id, hash, row number), so that one repeated doc_id is split.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_level_encoder(tokenizer)
        width = 2 if max(encoder.vocabulary, end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()
        part, block, start = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        parts: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            known = [doc_id for doc_id in doc_ids if doc_id is not None]
            payload = Block.encode(known, lengths, np.frombuffer(b"".join(parts), "<u4"), width)
            values = (part, block, start, len(doc_ids), len(doc_ids) - len(known), held, payload)
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ("part", "block", "start_in_part", "n_docs", "n_null_ids", "n_ids", "payload")
            return batch_of({name: ([value], type_) for name, value, type_ in zip(names, values, types)})

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist())):
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4 + 1)
                parts += (ids, end)
                held += lengths[-1]
                if held >= block_ids:
                    yield close()
                    block, start = block + 1, start + held
                    doc_ids, lengths, parts, held = [], [], [], 0
        if doc_ids:
            yield close()

    order = ["doc_id", "_hash", "_row"]
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
    )
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return stage(map_arrow(dealt, blocks, FILES), "token-files")


def read(files: DataFrame) -> DataFrame:
    """Documents of a table of blocks: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    The only data on the driver is one count for each part (the tasks that wrote).
    """

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("part", "start_in_part")}
                block = Block(batch.column("payload")[i].as_py())
                ends = block.ends.values().astype(np.int64)
                starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
                ids = block.ids.astype("<u4")
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield batch_of({
                    "part": ([row["part"]] * len(ends), pa.int32()), "doc_id": (block.all_doc_ids(), pa.int64()),
                    "start_in_part": (starts + row["start_in_part"], pa.int64()),
                    "n_tokens": (ends - starts, pa.int64()), "ids_crc32": (sums, pa.int64()),
                })

    spark = files.sparkSession
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    bases, base = [], 0
    for row in totals:
        bases.append((row["part"], base))
        base += row["n"]
    before = spark.createDataFrame(bases, "part int, before long")
    found = map_arrow(files.select("part", "start_in_part", "payload"), documents, DOCUMENTS)
    return found.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32"
    )
