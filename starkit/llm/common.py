"""What several operators share: Arrow batches and cached tokenizers."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import json
import pathlib
import tempfile
import zipfile
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.session import stage

# Fixed value: how byte-level BPE cuts texts before it merges.
GPT2_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts whose ids are compared when a file is loaded.
PROBES = ("It's  a\n\n test, we'll see: 123 456.", " \t\r\n x\u00a0\u2003y ", "na\u00efve \u6f22\u5b57 \U0001f600!?", "")

#: Entries of each of the two generations of a worker's cache, and the longest text that it keeps.
CACHE_ENTRIES = 350_000
CACHED_CHARS = 64
#: Characters of text whose units are looked up, and encoded where missing, at a time.
CHUNK_CHARS = 2_000_000


BATCH_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of a batch that a task gets, besides one more row.
BATCH_BYTES = 4 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the executors of an application, once, so that tasks can import it wherever they run.

    Batches are made smaller where the session has Spark's default of 64 MB for them, as a task holds several copies of one in both processes.
    """
    if spark.conf.get(BATCH_BYTES_SETTING).lower() in ("64mb", "67108864b", "67108864"):
        spark.conf.set(BATCH_BYTES_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = pathlib.Path(__file__).resolve().parent.parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="starkit-")) / "starkit.zip"
    with zipfile.ZipFile(archive, "w") as files:
        for module in sorted(package.rglob("*.py")):
            files.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Return memory that this process has freed to the system: a worker waits for other tasks with all that it once held."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every system's library has it
        ctypes.CDLL(None).malloc_trim(0)


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffles and broadcasts of steps that are done: it does so only once the driver has collected its garbage, which a
    driver that runs many small steps may put off for long."""
    spark.sparkContext._jvm.System.gc()


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this library at hand in the tasks."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


#: Words of 64 bits of a membership filter: 1 MB whatever it holds. Beyond some millions of keys it lets everything through.
FILTER_WORDS = 1 << 17


def _place(key: Column) -> tuple[Column, Column]:
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(key, 20), F.lit(64)).cast("int"))
    return F.pmod(key, F.lit(FILTER_WORDS)), bit


def membership(keys: DataFrame, key: Column) -> DataFrame:
    """A filter over the hashes ``key`` of ``keys``: word, bits; at most FILTER_WORDS rows, written once."""
    word, bit = _place(key)
    return stage(keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits")), "filter")


def with_membership(df: DataFrame, key: Column, members: DataFrame) -> DataFrame:
    """``df`` with a column ``_maybe``: false where the filter tells that a row's key is not among the keys. Nothing is shuffled."""
    word, bit = _place(key)
    known = df.join(F.broadcast(members), word == F.col("_word"), "left")
    return known.withColumn("_maybe", F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))).drop("_word", "_bits")


def batch_of(columns: dict[str, tuple[Iterable, pa.DataType]]) -> pa.RecordBatch:
    """A record batch from ``{name: (values, type)}``."""
    arrays = [v if isinstance(v, pa.Array) else pa.array(v, kind) for v, kind in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


class Cache:
    """A bounded map from short texts to values in two generations: what was used lately is kept, the rest goes."""

    def __init__(self, encode: Callable[[list[str]], list], entries: int = CACHE_ENTRIES):
        self.encode, self.entries, self.young, self.old = encode, entries, {}, {}

    def look_up(self, texts: list[str]) -> np.ndarray:
        """The value of each text, as objects; those that are not here are encoded together."""
        if not texts:
            return np.empty(0, object)
        coded = pa.array(texts, pa.string()).dictionary_encode()
        codes = coded.indices.to_numpy()
        first = np.empty(len(coded.dictionary), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        distinct = [texts[i] for i in first.tolist()]
        values = list(map(self.young.get, distinct))
        gaps = [i for i, value in enumerate(values) if value is None]
        for i in gaps:
            values[i] = self.old.get(distinct[i])
        new = [i for i in gaps if values[i] is None]
        for i, value in zip(new, self.encode([distinct[i] for i in new])):
            values[i] = value
        if len(self.young) > self.entries:
            self.old, self.young = self.young, {}
        self.young.update((distinct[i], values[i]) for i in gaps if len(distinct[i]) <= CACHED_CHARS)
        objects = np.empty(len(values), object)
        objects[:] = values
        return objects[codes]


def chunks(texts: list[str], chars: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about so many characters together."""
    chunk, size = [], 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= chars:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


class ByteLevelEncoder:
    """Ids of whole texts as the ``tokenizers`` library gives them for a byte-level BPE file.

    The file is loaded by the library, and its vocabulary is run by ``tiktoken``, which applies the same merges several times faster.
    That is the same where merges are ordered by the ids that they make, which is checked when the file is loaded, as are the ids of a
    few texts. Files where it is not so, and texts with an added token, are left to the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.encoding = self._same_merges(json.loads(self.tokenizer.to_str()))

    def _same_merges(self, file: dict):
        import tiktoken

        model, before = file["model"], file["pre_tokenizer"] or {}
        made = [model["vocab"].get("".join(merge if isinstance(merge, list) else merge.split(" "))) for merge in model.get("merges", [])]
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        extras = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if not plain or file["normalizer"] or any(model.get(x) for x in extras) or None in made or made != sorted(made):
            return None
        byte_of = {sign: byte for byte, sign in enumerate(byte_signs())}
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in model["vocab"].items() if token not in self.added}
        encoding = tiktoken.Encoding("file", pat_str=GPT2_PATTERN, mergeable_ranks=ranks, special_tokens={})
        same = all(encoding.encode_ordinary(text) == ids for text, ids in zip(PROBES, map(self._library, PROBES)))
        return encoding if same else None

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text in order as little-endian unsigned 32-bit integers; null is the empty text."""
        for text in texts:
            if not text:
                yield b""
            elif self.encoding is None or any(token in text for token in self.added):
                yield array("I", self._library(text)).tobytes()
            else:
                yield array("I", self.encoding.encode_ordinary(text)).tobytes()


def byte_signs() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is printable, else one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(byte if byte in shown else next(others)) for byte in range(256)]


@functools.lru_cache(maxsize=4)
def byte_level_encoder(path: str) -> ByteLevelEncoder:
    """One encoder for each worker process and file."""
    return ByteLevelEncoder(path)
