"""WARC archives of pages, and a capture index that is merged from the sorted runs of their records.

Writing and reading are Spark's: an archive is a gzipped file of WARC/1.1 records that Spark's text writer makes in whatever store the shared folder is
in, and it is read record by record. The index is an external merge sort. Every reading task sorts its captures into a run of blocks; blocks are
cut at the bounds of key ranges and dealt by range; a task merges the runs of a range with a loser tree whose leaves are the blocks that
are open. Blocks come in the order of their first keys, so a block is opened only when the merge has reached it, and at most
one block of a run is open at a time.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.llm.common import batch_of, map_arrow
from starkit.operators.joins import Side, to_dimensions
from starkit.session import fresh_path, stage

# Of the WARC 1.1 format.
VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 100
#: Captures in a block, and runs that are merged at a time.
BLOCK = 2048
FAN_IN = 512
#: Blocks for each range whose first keys are sampled for the bounds of ranges.
SAMPLED = 20

RECORDS = (
    "url_key string, captured string, page_id long, file string, offset long, length long, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long"
)
_FIELDS = [tuple(field.split()) for field in RECORDS.split(", ")]
_TYPES = {"string": pa.string(), "long": pa.int64()}
_SCHEMA = pa.schema([(name, _TYPES[kind]) for name, kind in _FIELDS])
BLOCKS = "run int, seq long, key string, captured string, page_id long, file string, offset long, n long, payload binary"
#: What captures are ordered by; file and offset make every key different.
ORDER = ["url_key", "captured", "page_id", "file", "offset"]


# --- archives ------------------------------------------------------------------------------------


def capture_time(page_id: Column) -> Column:
    """Seconds since 1970 for tables that do not say when a page was captured: its id."""
    return F.pmod(F.coalesce(page_id.cast("long"), F.lit(0)), F.lit(1 << 31))


def _first_captures(rows: DataFrame) -> DataFrame:
    """For each digest that occurs more than once: the capture that the others revisit.

    The one with the least page_id; of those with one page_id the one with the least url, null being last; of those the first row.
    """
    order = F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url", "_row")
    found = rows.where(F.col("_bytes") >= LEAST_BYTES).groupBy("_digest").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return found.where("n > 1").select(
        "_digest", F.col("first.page_id").alias("_first"), F.col("first.url").alias("_first_url"), F.col("first._row").alias("_first_row"),
        F.lit(True).alias("_repeated"),
    )


def _repeats(rows: DataFrame) -> bool:
    """Whether a capture that others revisit is a row that occurs several times."""
    same = rows.where(F.col("_bytes") >= LEAST_BYTES).groupBy("page_id", "url", "_digest").agg(F.count(F.lit(1)).alias("n"))
    return not same.where("n > 1").limit(1).isEmpty()


def _record_id(page_id: Column, digest: Column, url: Column) -> Column:
    place = F.substring(F.md5(F.coalesce(url, F.lit(""))), 1, 16)
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("-")), F.lit(":"), F.substring(digest, 1, 16), F.lit(":"), place, F.lit(">"))


def _target(url: Column) -> Column:
    """The address as it may stand in a header: control characters and spaces are percent-encoded."""
    encoded = url
    for code in [*range(0x21), 0x7F]:
        encoded = F.replace(encoded, F.lit(chr(code)), F.lit(quote(chr(code))))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), encoded).otherwise(F.coalesce(url, F.lit("")))


def write(pages: DataFrame, seconds: Column | None = None) -> str:
    """Writes a WARC record for each row of ``pages`` (page_id, url, html); returns the folder of the archives.

    The payload is the html in UTF-8; null is empty. Of records with equal payloads (by SHA-256) of at least LEAST_BYTES bytes, the one with the least
    page_id is a response and the others are revisits of it; smaller payloads are always responses. Null page_ids come last. Of rows with
    one page_id the least url comes first, and of equal rows one is the response. ``seconds`` is when a page was captured. A null url is an empty address.
    No rows: a folder without records. Other columns are ignored.

    Only digests move: those that repeat are grouped, and rows meet them by broadcast as long as they are measured to fit, else by a join that spreads
    rows without a repeated payload and rows of frequent payloads over all tasks.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("_html"),
        (capture_time(F.col("page_id")) if seconds is None else seconds.cast("long")).alias("_seconds"), F.lit(0).cast("long").alias("_row"),
    )
    hashed = rows.withColumns({"_bytes": F.octet_length("_html").cast("long"), "_digest": F.sha2("_html", 256)})
    if _repeats(hashed):
        # equal rows differ by a number only; it is written with them, so that a row keeps it
        hashed = stage(hashed.withColumn("_row", F.monotonically_increasing_id()), "numbered-pages")
    first = stage(_first_captures(hashed), "repeated-payloads")
    met = to_dimensions(
        hashed.withColumn("_long", F.when(F.col("_bytes") >= LEAST_BYTES, F.col("_digest"))),
        [Side(first, {"_long": "_digest"}, ["_first", "_first_url", "_first_row", "_repeated"])],
    )
    itself = F.col("page_id").eqNullSafe(F.col("_first")) & F.col("url").eqNullSafe(F.col("_first_url")) & (F.col("_row") == F.col("_first_row"))
    revisit = F.coalesce(F.col("_repeated") & ~itself, F.lit(False))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("_bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("_html")))
    moment = F.to_utc_timestamp(F.timestamp_seconds("_seconds"), F.current_timezone())
    headers = F.concat(
        F.lit(VERSION), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _record_id(F.col("page_id"), F.col("_digest"), F.col("url")),
        F.lit("\r\nWARC-Date: "), F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nWARC-Target-URI: "), _target(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("_digest"),
        F.when(revisit, F.concat(
            F.lit(f"\r\nWARC-Profile: {IDENTICAL}\r\nWARC-Refers-To: "), _record_id(F.col("_first"), F.col("_digest"), F.col("_first_url"))
        )).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END),
    )
    path = fresh_path(spark, "archives")
    met.select(F.concat(headers, block).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)
    return path


_PAGE = re.compile(rb"<urn:page:(-|-?\d+):")


def _page_of(record_id: bytes | None) -> int | None:
    found = _PAGE.match(record_id or b"")
    return None if not found or found[1] == b"-" else int(found[1])


def url_key(url: str) -> str:
    """The address in the order of an index: host names from the last to the first in lower case, without scheme, user, usual port and fragment."""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url.partition("#")[0])
    at = re.search(r"[/?]|$", rest).start()
    host = re.sub(r":(80|443)$", "", rest[:at].rpartition("@")[2].lower())
    return ",".join(reversed(host.split("."))) + ")" + (rest[at:] or "/")


def _parsed(file: str, offset: int, head: bytes, block: bytes) -> tuple:
    """One record as a row of RECORDS; the payload of a response is held against its digest."""
    fields = {}
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip()
    digest = fields[b"warc-payload-digest"].decode().removeprefix("sha256:")
    kind = fields[b"warc-type"].decode()
    http, _, payload = block.partition(b"\r\n\r\n")
    if kind == "response":
        n_bytes = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"the payload at {offset} in {file} does not have its digest")
    else:
        n_bytes = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    captured = re.sub(r"\D", "", fields[b"warc-date"].decode())
    key = url_key(fields[b"warc-target-uri"].decode())
    page, refers = _page_of(fields[b"warc-record-id"]), _page_of(fields.get(b"warc-refers-to"))
    length = len(VERSION) + len(head) + 2 * len(END) + len(block)
    return key, captured, page, file, offset, length, kind, n_bytes, digest, refers


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of archives that Spark has cut wherever a record could end; what Content-Length says is missing is put back."""
    separator = (END + VERSION).encode()
    file, offset, held, missing = None, 0, [], 0
    for batch in batches:
        out = []
        for data, name in zip(batch.column("value"), batch.column("file").to_pylist()):
            data = data.as_py()
            if name != file:
                if held:
                    raise ValueError(f"{file} ends within a record")
                file, offset = name, 0
                data = data.removeprefix(VERSION.encode())
            if held:
                held.append(data)
                missing -= len(separator) + len(data)
            else:
                head, _, block = data.partition(END.encode())
                held = [data]
                missing = len(head) + len(END) + int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)[1]) - len(data)
            if missing > 0:
                continue
            whole = separator.join(held)
            # the last record of a file still has its end
            whole = whole[: len(whole) + missing] if missing else whole
            head, _, block = whole.partition(END.encode())
            out.append(_parsed(file, offset, head, block))
            offset += out[-1][5]
            held = []
        if out:
            yield batch_of({name: (values, _TYPES[kind]) for (name, kind), values in zip(_FIELDS, zip(*out))})
    if held:
        raise ValueError(f"{file} ends within a record")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives: RECORDS. Offsets and lengths are those in the uncompressed file."""
    lines = spark.read.option("lineSep", END + VERSION).text(path)
    return map_arrow(lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_name").alias("file")), _records, RECORDS)


# --- index ---------------------------------------------------------------------------------------


def _pack(rows: list[tuple]) -> bytes:
    table = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _SCHEMA) as writer:
        writer.write_batch(table)
    return sink.getvalue().to_pybytes()


def _unpack(payload: bytes) -> list[tuple]:
    with pa.ipc.open_stream(payload) as reader:
        return [row for batch in reader for row in zip(*(column.to_pylist() for column in batch.columns))]


def key_of(row: tuple) -> tuple:
    """What a capture is ordered by; a null page_id comes first."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[3], row[4]


def _block(run: int, seq: int, rows: list[tuple]) -> tuple:
    return run, seq, *rows[0][:5], len(rows), _pack(rows)


def _block_batch(blocks: list[tuple], extra: dict | None = None) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "binary": pa.binary(), **_TYPES}
    names = [field.split() for field in BLOCKS.split(", ")]
    columns = zip(*blocks) if blocks else [()] * len(names)
    return batch_of({**(extra or {}), **{name: (values, kinds[kind]) for (name, kind), values in zip(names, columns)}})


def _runs(block: int):
    """The sorted captures of a task as blocks of a run."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, seq, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            held += zip(*(column.to_pylist() for column in batch.columns))
            while len(held) >= block:
                yield _block_batch([_block(run, seq, held[:block])])
                seq, held = seq + 1, held[block:]
        if held:
            yield _block_batch([_block(run, seq, held)])

    return packed


class LoserTree:
    """The least of several sorted lists; inner nodes hold the losers of their games, so that one path is played anew after each step.

    ``lists`` hold (keys, rows); a list that is at its end loses every game.
    """

    def __init__(self, lists: list[tuple[list, list, int]]):
        self.lists = [list(x) for x in lists]
        self.size = 1 << max(len(lists) - 1, 0).bit_length()
        self.games = [-1] * self.size
        self.winner = self._play(1) if self.lists else -1

    def _key(self, i: int):
        if i >= len(self.lists) or i < 0:
            return None
        keys, _, at = self.lists[i]
        return keys[at] if at < len(keys) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._key(a), self._key(b)
        return y is None or (x is not None and x <= y)

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        first, second = (a, b) if self._beats(a, b) else (b, a)
        self.games[node] = second
        return first

    def runner_up(self):
        """The least key apart from the winner's list, None without one: it lost to the winner."""
        keys, node = [], (self.winner + self.size) // 2
        while node:
            keys.append(self._key(self.games[node]))
            node //= 2
        return min((key for key in keys if key is not None), default=None)

    def least(self):
        return self._key(self.winner)

    def take(self, until) -> list:
        """Rows of the winner's list up to the runner-up's key and before the key ``until``; then its path is played anew."""
        keys, rows, at = self.lists[self.winner]
        limit = self.runner_up()
        end = len(keys) if limit is None else bisect.bisect_right(keys, limit, at)
        if until is not None:
            end = min(end, bisect.bisect_left(keys, until, at))
        self.lists[self.winner][2] = end
        node, player = (self.winner + self.size) // 2, self.winner
        while node:
            if not self._beats(player, self.games[node]):
                player, self.games[node] = self.games[node], player
            node //= 2
        self.winner = player
        return rows[at:end]

    def open(self) -> list[tuple[list, list, int]]:
        """The lists that are not at their ends."""
        return [tuple(x) for x in self.lists if x[2] < len(x[0])]


def merge_blocks(blocks: Iterator[tuple[tuple, bytes]]) -> Iterator[list[tuple]]:
    """Merged rows of blocks (first key, payload) that come in the order of their first keys, a few at a time."""
    tree, coming = LoserTree([]), next(blocks, None)
    while coming is not None or tree.least() is not None:
        until = coming[0] if coming else None
        if tree.least() is None or (until is not None and until <= tree.least()):
            lists = tree.open()
            # every block that starts before the least open capture is opened, so that no capture is passed over
            least = tree.least()
            while coming is not None and (least is None or coming[0] <= least):
                rows = _unpack(coming[1])
                lists.append(([key_of(row) for row in rows], rows, 0))
                least = lists[-1][0][0] if least is None else min(least, lists[-1][0][0])
                coming = next(blocks, None)
            tree = LoserTree(lists)
            continue
        yield tree.take(until)


def _cut(bounds: list[tuple], groups: int):
    """Blocks cut at the bounds of ranges: group and range of each piece besides what a block has."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, seq, payload in zip(*(batch.column(name).to_pylist() for name in ("run", "seq", "payload"))):
                rows = _unpack(payload)
                keys = [key_of(row) for row in rows]
                ends = [bisect.bisect_left(keys, bound) for bound in bounds] + [len(rows)]
                ranges, found = [], []
                for i, (start, end) in enumerate(zip([0, *ends], ends)):
                    if start < end:
                        ranges.append(i)
                        found.append(_block(run, seq, rows[start:end]))
                yield _block_batch(found, {"group": ([run % groups] * len(found), pa.int32()), "range": (ranges, pa.int32())})

    return pieces


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator]]:
    """(group, range) and its blocks, in turn; the blocks are to be used up before the next is asked for."""

    def blocks():
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("group", "range", *["key", "captured", "page_id", "file", "offset"], "payload")}
                key = key_of((row["key"], row["captured"], row["page_id"], row["file"], row["offset"]))
                yield (row["group"], row["range"]), (key, row["payload"])

    source = blocks()
    ahead = next(source, None)
    while ahead is not None:
        place = ahead[0]

        def of_place():
            nonlocal ahead
            while ahead is not None and ahead[0] == place:
                found = ahead[1]
                ahead = next(source, None)
                yield found

        yield place, of_place()


def _merged_runs(block: int):
    """Blocks of the runs that groups of runs are merged into."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (group, range_), blocks in _grouped(batches):
            held, seq = [], range_ << 32
            for rows in merge_blocks(blocks):
                held += rows
                while len(held) >= block:
                    yield _block_batch([_block(group, seq, held[:block])])
                    seq, held = seq + 1, held[block:]
            if held:
                yield _block_batch([_block(group, seq, held)])

    return merged


def _merged_captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Captures in order, with their range and their place in it."""
    for (_, range_), blocks in _grouped(batches):
        place, held = 0, []

        def flush(rows, start):
            columns = {name: (values, _TYPES[kind]) for (name, kind), values in zip(_FIELDS, zip(*rows))}
            return batch_of({"range": ([range_] * len(rows), pa.int32()), "place": (range(start, start + len(rows)), pa.int64()), **columns})

        for rows in merge_blocks(blocks):
            held += rows
            if len(held) >= BLOCK:
                yield flush(held, place)
                place, held = place + len(held), []
        if held:
            yield flush(held, place)


def _bounds(blocks: DataFrame, ranges: int) -> list[tuple]:
    """First captures of ranges of about equal size, from a bounded sample of the first keys of blocks."""
    names = ["key", "captured", "page_id", "file", "offset"]
    sample = blocks.select(*names).orderBy(F.xxhash64("run", "seq"), "run", "seq").limit(SAMPLED * ranges).collect()
    keys = sorted(key_of(tuple(row)) for row in sample)
    return sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []


def _dealt(blocks: DataFrame, bounds: list[tuple], groups: int, ranges: int) -> DataFrame:
    pieces = map_arrow(blocks.select("run", "seq", "payload"), _cut(bounds, groups), f"group int, range int, {BLOCKS}")
    keys = ["group", "range", "key", "captured", F.col("page_id").asc_nulls_first(), "file", "offset"]
    return pieces.repartitionByRange(ranges * groups, "group", "range").sortWithinPartitions(*keys)


def histories(records: DataFrame, ranges: int | None = None, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """The capture index of ``records``: RECORDS with ``position``, the place of a capture in the order of (url_key, captured, page_id) from 0 on.

    Captures of one url follow each other in time. A url with any number of captures is cut by time and id, as the bounds of ranges are whole keys. Equal
    keys are told apart by file and offset. A null page_id comes first.

    More than ``fan_in`` runs are merged in several passes. The driver holds bounds and counts of ranges only.
    """
    spark = records.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = records.select(*_SCHEMA.names).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ORDER])
    blocks = stage(map_arrow(ordered, _runs(block), BLOCKS), "capture-runs")
    runs = (blocks.agg(F.max("run")).first()[0] or 0) + 1
    bounds = _bounds(blocks, ranges)
    while runs > fan_in:
        groups = -(-runs // fan_in)
        blocks = stage(map_arrow(_dealt(blocks, bounds, groups, ranges), _merged_runs(block), BLOCKS), "capture-runs")
        runs = groups
    merged = stage(map_arrow(_dealt(blocks, bounds, 1, ranges), _merged_captures, f"range int, place long, {RECORDS}"), "capture-index")
    base, bases = 0, []
    for row in merged.groupBy("range").count().orderBy("range").collect():
        bases.append((row["range"], base))
        base += row["count"]
    before = spark.createDataFrame(bases, "range int, before long")
    placed = merged.join(F.broadcast(before), "range")
    return placed.select((F.col("before") + F.col("place")).alias("position"), *_SCHEMA.names)
