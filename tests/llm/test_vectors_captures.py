"""Vector codes, hard negatives and the capture index against brute force."""

import gzip
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import CLASHING

from starkit.llm import capture_index, hard_negatives, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows, extra=True):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    return df.select("*", *(F.lit("x").alias(name) for name in (*CLASHING, "_id", "_v", "key")[5:])) if extra else df


def random_rows(seed, n, width=8, labels=3):
    chosen = random.Random(seed)
    rows = [(i, [round(chosen.gauss(0, 0.3), 2) for _ in range(width)], chosen.randrange(labels)) for i in range(n)]
    odd = [(n, None, 1), (n + 1, [None] * width, 1), (n + 2, [math.nan] * width, 1), (n + 3, [math.inf] * width, 1), (n + 4, rows[0][1], None)]
    return rows + odd + rows[:7] + [(None, rows[1][1], 2), (200, [], 1), (300, [0.5, -0.25], 0), (400, [1e30, -1e30, 3.0], 0)]


def usable(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def whole(row, scale, width, limit):
    floats = [float(np.float32(x)) for x in row] + [0.0] * (width - len(row))
    return [max(-limit, min(limit, math.floor(x * scale))) for x in floats]


# --- hard negatives ------------------------------------------------------------------------------


def mined_by_hand(rows, every, k=5, low=80, high=100):
    held = [r for r in usable(rows) if r[0] is not None and r[2] is not None]
    width = max(len(r[1]) for r in held)
    limit = math.isqrt(((1 << 63) - 1) // width)
    numbers = [whole(r[1], 256, width, limit) for r in held]
    found = []
    for i, (anchor, _, label) in enumerate(held):
        if anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(numbers[i], numbers[j])), r[0], r[2]) for j, r in enumerate(held) if j != i]
        scored.sort(key=lambda x: x[:2])
        for p, positive, _ in [x for x in scored if x[2] == label][:k]:
            fitting = [x for x in scored if x[2] != label and low * -p <= high * -x[0] <= high * -p][:k]
            found += [(anchor, positive, rank, x[1], -p, -x[0]) for rank, x in enumerate(fitting, 1)]
    return Counter(found)


@pytest.mark.parametrize("seed, labels, cells", [(1, 3, 1 << 21), (2, 2, 64), (3, 7, 1000)])
def test_hard_negatives_are_those_of_brute_force(spark, monkeypatch, seed, labels, cells):
    monkeypatch.setattr(hard_negatives, "CELLS", cells)
    rows = random_rows(seed, 300, labels=labels)
    expected = mined_by_hand(rows, 10)
    assert expected
    found = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert Counter(map(tuple, found.collect())) == expected
    blocks = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0, block_bytes=600)
    assert Counter(map(tuple, blocks.collect())) == expected


def test_equal_vectors_are_told_apart_by_id(spark):
    rows = [(i, [0.5, 0.5], i % 2) for i in range(400)]
    found = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 100 == 0)
    assert Counter(map(tuple, found.collect())) == mined_by_hand(rows, 100)


@pytest.mark.parametrize("rows", [[], [(100, None, 1)], [(1, [0.1], 1), (2, [0.2], 2)], [(100, [0.1], 1)], [(0, [], 1), (1, [], 1), (2, [], 2)]])
def test_hard_negatives_of_few_rows(spark, rows):
    found = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 100 == 0)
    expected = mined_by_hand(rows, 100) if any(r[1] for r in usable(rows)) else Counter({(0, 1, 1, 2, 0, 0): 1} if len(rows) == 3 else {})
    assert Counter(map(tuple, found.collect())) == expected


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(*[st.integers(-(1 << 63), (1 << 63) - 1)] * 3), min_size=1, max_size=30), st.integers(0, 1))
def test_packed_keys_sort_by_anchor_score_and_id(pairs, kind):
    columns = [np.array(column, np.int64) for column in zip(*pairs)]
    batch = hard_negatives.pack(columns[0], columns[1], kind, columns[2])
    keys = batch.column("key").to_pylist()
    order = sorted(range(len(pairs)), key=lambda i: (pairs[i][0], -pairs[i][1], pairs[i][2]))
    assert sorted(keys) == [keys[i] for i in order]
    assert list(zip(*(hard_negatives.unpack(batch.column("key"))[i] for i in (0, 1, 3)))) == pairs


# --- vector codes --------------------------------------------------------------------------------


def nearest_by_hand(points, queries):
    found = []
    for q in queries:
        squares = [sum((a - b) ** 2 for a, b in zip(q, p)) for p in points]
        found.append((squares.index(min(squares)), min(squares)))
    return found


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 4), st.sampled_from([2, 30, 10**6, 1 << 29]))
def test_gnat_finds_the_first_of_the_nearest(seed, n, width, spread):
    chosen = random.Random(seed)
    point = lambda: [chosen.randint(-spread, spread) for _ in range(width)]
    points, queries = [point() for _ in range(n)], [point() for _ in range(20)]
    queries += points[:5]
    found, best = vector_codes.Gnat(np.array(points, np.int64)).nearest(np.array(queries, np.int64))
    assert list(zip(found.tolist(), best.tolist())) == nearest_by_hand(points, queries)


def test_gnat_leaves_out_subtrees():
    generator = np.random.default_rng(1)
    centres = generator.integers(-10_000, 10_000, (16, 4))
    points = np.repeat(centres, 16, 0) + generator.integers(-50, 50, (256, 4))
    queries = points[generator.permutation(256)] + generator.integers(-20, 20, (256, 4))
    tree = vector_codes.Gnat(points)
    best, found = np.full(256, np.iinfo(np.int64).max), np.full(256, 256)
    computed = tree.search(queries, np.arange(256), best, found)
    assert list(zip(found.tolist(), best.tolist())) == nearest_by_hand(points.tolist(), queries.tolist())
    assert computed < 256 * 256 / 4


@settings(max_examples=300, deadline=None)
@given(st.integers(0, (1 << 62) - 1))
def test_roots_are_rounded_to_the_safe_side(square):
    down, up = (f(np.array([square])).item() for f in (vector_codes.root_down, vector_codes.root_up))
    assert down == math.isqrt(square) and up == down + (down * down < square)


def coded_by_hand(rows, entries, rounds=4, parts=4):
    held = usable(rows)
    width = -(-max(len(r[1]) for r in held) // parts) * parts
    limit = math.isqrt(((1 << 63) - 1) // (4 * width))
    numbers = [whole(r[1], 1024, width, limit) for r in held]
    first = sorted((r[0], v) for r, v in zip(held, numbers) if r[0] is not None)[:entries]
    w, codes, errors, books = width // parts, [""] * len(held), [0] * len(held), []
    for p in range(parts):
        pieces = [v[p * w : (p + 1) * w] for v in numbers]
        book = [v[p * w : (p + 1) * w] for _, v in first]
        for _ in range(rounds):
            members = defaultdict(list)
            for piece, (entry, _) in zip(pieces, nearest_by_hand(book, pieces)):
                members[entry].append(piece)
            for entry, found in members.items():
                book[entry] = [sum(column) // len(found) for column in zip(*found)]
        for i, (entry, square) in enumerate(nearest_by_hand(book, pieces)):
            codes[i] += f"{entry:02x}"
            errors[i] += square
        books += [str(x) for entry in book for x in entry]
    totals = Counter()
    for r, error in zip(held, errors):
        totals[r[2]] += error
    kept = lambda x: x if x < 1 << 63 else None
    expected = Counter((r[0], code, error, kept(totals[r[2]])) for r, code, error in zip(held, codes, errors))
    return expected, hashlib.sha256(",".join(books).encode()).hexdigest()


@pytest.mark.parametrize("seed, n, entries", [(1, 200, 16), (2, 30, 256), (3, 150, 3)])
def test_codes_are_those_of_brute_force(spark, seed, n, entries):
    rows = random_rows(seed, n)
    found, books = vector_codes.encode(vectors(spark, rows), entries=entries)
    expected, digest = coded_by_hand(rows, entries)
    assert Counter(map(tuple, found.collect())) == expected and vector_codes.digest(books) == digest


def test_codes_of_no_rows(spark):
    for rows in ([], [(1, None, 1)], [(None, [math.nan], None)]):
        found, books = vector_codes.encode(vectors(spark, rows))
        assert found.collect() == [] and vector_codes.digest(books) == hashlib.sha256(b"").hexdigest()
    found, _ = vector_codes.encode(vectors(spark, [(1, [], None), (2, [], 3)]))
    assert sorted(map(tuple, found.collect())) == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]


# --- capture index -------------------------------------------------------------------------------

SEPARATOR = "\r\n\r\nWARC/1.1\r\n"
LONG = "<p>" + "x" * 300
PAGES = [
    (5, "http://A.example.com:80/x y?b#c", LONG), (3, "https://u@a.example.com/", LONG), (3, "https://a.example.com", LONG), (9, None, LONG),
    (None, "b.example.org?q=1", LONG), (7, "", None), (8, "http://b.example.org/1", ""), (10, "http://b.example.org/2", "short"),
    (11, "http://b.example.org/2", "short"), (12, "x", f"{SEPARATOR}WARC-Type: response{SEPARATOR}{SEPARATOR}" * 9), (13, "x", "\r\n\r\n" * 60),
    (14, "x", f"é😀 {SEPARATOR}"), (15, "x", SEPARATOR * 40), (15, "x", SEPARATOR * 40), (15, "x", SEPARATOR * 40), (-4, "x", "WARC/1.1\r\n" * 30),
    (16, "tab\tand\nline", "\r\n\r\nWARC/1.1\r" * 50), (17, "x", "z" * 3_000_000),
]


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return df.select("*", *(F.lit("x").alias(name) for name in (*CLASHING, "file", "offset", "_digest", "url_key")[10:]))


def judged_by_hand(rows):
    groups, out = defaultdict(list), []
    for i, (page_id, url, html) in enumerate(rows):
        payload = (html or "").encode()
        groups[hashlib.sha256(payload).hexdigest()].append((page_id is None, page_id or 0, url is None, url or "", i, page_id, len(payload)))
    for digest, members in groups.items():
        for place, member in enumerate(sorted(members)):
            revisit = member[-1] >= 100 and place > 0
            out.append((member[-2], member[-1], digest, "revisit" if revisit else "response", min(members)[-2] if revisit else None))
    return Counter(out)


def index_of(spark, rows, **sizes):
    path = capture_index.write(pages(spark, rows))
    return capture_index.histories(capture_index.read(spark, path), **sizes), path


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_records_come_back_as_they_were_written(spark):
    found, path = index_of(spark, PAGES)
    rows = found.collect()
    assert Counter(tuple(row[c] for c in COLUMNS) for row in rows) == judged_by_hand(PAGES)
    files = {row["file_name"]: row for row in spark.read.format("binaryFile").load(path).selectExpr("_metadata.file_name", "content").collect()}
    payloads = {hashlib.sha256((html or "").encode()).hexdigest(): (html or "").encode() for _, _, html in PAGES}
    for row in rows:
        data = gzip.decompress(files[row["file"]]["content"])[row["offset"] : row["offset"] + row["length"]]
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: " + row["record_type"].encode()) and data.endswith(b"\r\n\r\n")
        if row["record_type"] == "response":
            assert data.endswith(payloads[row["payload_digest"]] + b"\r\n\r\n")


def test_captures_are_in_the_order_of_url_and_time(spark):
    rows = [(i, f"http://h{i % 7}.example.com/{i % 3}", f"<p>{i % 50}" * 40) for i in range(500)] + [(1000 + i, "http://hot.example.com/", "x") for i in range(700)]
    for sizes in ({}, {"block": 7, "ranges": 5}, {"block": 3, "ranges": 4, "fan_in": 2}):
        found, _ = index_of(spark, rows, **sizes)
        held = sorted(found.collect(), key=lambda row: row["position"])
        assert [row["position"] for row in held] == list(range(len(rows)))
        keys = [(row["url_key"], row["captured"], row["page_id"]) for row in held]
        assert keys == sorted(keys) and sorted(row["page_id"] for row in held) == sorted(r[0] for r in rows)


def test_index_of_no_pages(spark):
    assert index_of(spark, [])[0].collect() == []


def test_a_damaged_archive_is_refused(spark, tmp_path):
    path = capture_index.write(pages(spark, [(1, "x", LONG)]))
    text = spark.read.text(path, lineSep="\n\n\n").first()[0]
    for name, changed in {"payload": text.replace("xxx", "xyx", 1), "cut": text[:-30]}.items():
        spark.createDataFrame([(changed,)], "value string").coalesce(1).write.option("lineSep", "\r\n").text(f"{tmp_path}/{name}")
        with pytest.raises(Exception, match="does not have its digest|ends within a record"):
            capture_index.read(spark, f"{tmp_path}/{name}").collect()


@pytest.mark.parametrize("url, key", [
    ("http://www.Example.com:80/A?b=C#d", "com,example,www)/A?b=C"), ("https://u:p@example.com:443", "com,example)/"),
    ("example.com?x", "com,example)?x"), ("ftp://h:8080/", "h:8080)/"), ("", ")/"), ("#a", ")/"),
])
def test_url_keys(url, key):
    assert capture_index.url_key(url) == key


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=12), max_size=9), st.integers(1, 4))
def test_merged_blocks_are_sorted_and_whole(runs, size):
    rows = [(run, sorted((str(x), "0", x, f"f{run}", i) for i, x in enumerate(run_rows))) for run, run_rows in enumerate(runs)]
    blocks = [found[i : i + size] for _, found in rows for i in range(0, len(found), size)]
    full = lambda row: (*row, 0, "response", 0, "", None)
    packed = sorted((capture_index.key_of(full(block[0])), capture_index._pack([full(row) for row in block])) for block in blocks)
    merged = [row for found in capture_index.merge_blocks(iter(packed)) for row in found]
    assert merged == sorted((full(row) for _, found in rows for row in found), key=capture_index.key_of)
