"""Packing, token files and token counts against the tokenizer libraries."""

import random
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import LONG, ODD, documents, split_over, tuples
from tokenizers import Tokenizer

from starkit.llm import packing, token_counts, token_output
from starkit.llm.common import Cache, byte_level_encoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(BYTE)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abZé1'st  \n\t\r\x0b\x1c\x85\xa0 .,!<|>endoftx漢😀​")), max_size=30), max_size=8))
def test_cached_ids_are_the_librarys(texts):
    texts = [*texts, "<|endoftext|> a", " ", "x  ", "a   b", "it's we'll"]
    found = list(byte_level_encoder(BYTE).encode(texts))
    assert found == [array("I", ids_of(text)).tobytes() for text in texts]


def test_cache_forgets_but_stays_right():
    cache = Cache(lambda texts: [text.encode() for text in texts], entries=3)
    chosen = random.Random(3)
    for _ in range(50):
        texts = [str(chosen.randint(0, 20)) for _ in range(10)]
        assert cache.look_up(texts).tolist() == [text.encode() for text in texts]
        assert len(cache.young) <= 3 + 10


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=300), st.booleans())
def test_elias_fano_round_trip(values, dense):
    values = sorted(v % 50 if dense else v for v in values)
    data = token_output.EliasFano.of(np.array(values, np.uint64)).to_bytes()
    read, end = token_output.EliasFano.from_bytes(memoryview(b"?" + data), 1)
    assert end == len(data) + 1
    assert read.values().tolist() == values
    assert [read.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        read.select(len(values))


def test_boundaries_take_few_bits():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 1000, 10_000))
    assert len(token_output.EliasFano.of(ends).to_bytes()) < 10_000 * 12 / 8 + 1000


def test_token_files(spark):
    files = token_output.write(split_over(documents(spark)), BYTE, end_id=0, block_ids=50)
    found = tuples(token_output.read(files), "doc_id", "start", "n_tokens", "ids_crc32")
    ids = {(d, crc([*ids_of(t), 0])): len(ids_of(t)) + 1 for d, t, *_ in ODD}
    assert Counter((d, c, n) for d, _, n, c in found) == Counter((d, crc([*ids_of(t), 0]), len(ids_of(t)) + 1) for d, t, *_ in ODD)
    at = 0
    for d, start, n, _ in sorted(found, key=lambda row: row[1]):
        assert start == at
        at += n
    order = [d for d, *_ in sorted(found, key=lambda row: row[1])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    block = token_output.Block(files.where("n_docs > 1").first()["payload"])
    for i, doc_id in enumerate(block.all_doc_ids()):
        assert (doc_id, crc(block.document(i).tolist())) in ids
    empty = token_output.read(token_output.write(documents(spark, []), BYTE))
    assert empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and empty.count() == 0


LIMITS = packing.Limits(tokens=64, segments=3, loss_tokens=40)


def check_sequences(found, limits):
    by_sequence = defaultdict(list)
    for row in found:
        by_sequence[row["sequence_id"]].append(row)
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda p: p["offset"]):
            assert piece["offset"] == at and piece["length"] > 0
            at += piece["length"]
        assert at <= limits.tokens and len(pieces) <= limits.segments
    return {key: sum(p["length"] for p in pieces) for key, pieces in by_sequence.items()}


def test_packing_is_whole_and_within_limits(spark):
    limits = packing.Limits(tokens=64, segments=8, loss_tokens=64)
    found = packing.pack(split_over(documents(spark)), BYTE, limits).collect()
    totals = check_sequences(found, limits)
    assert sum(totals.values()) == sum(len(ids_of(t)) + 1 for _, t, *_ in ODD)
    padded = [n for n in totals.values() if n & (n - 1)]
    assert sum(64 - n for n in padded) <= 0.05 * sum(totals.values())
    wanted = {(d, len(ids_of(t)) + 1): [*ids_of(t), 1] for d, t, *_ in ODD}
    for row in found:
        ids = wanted[row["doc_id"], row["doc_tokens"]]
        assert row["ids_crc32"] == crc(ids[row["start"] : row["start"] + row["length"]])
    once = Counter((r["doc_id"], r["doc_tokens"], r["start"] + i) for r in found for i in range(r["length"]))
    copies = Counter((d, len(ids_of(t)) + 1) for d, t, *_ in ODD)
    assert all(n == copies[d, tokens] for (d, tokens, _), n in once.items())
    assert packing.pack(documents(spark, []), BYTE, limits).count() == 0


def test_packing_bounds_tokens_that_bear_loss(spark):
    rows = [(i, "word " * (5 * i % 90), None, None, 3 * i % 50 if i % 4 else None) for i in range(60)]
    found = packing.pack(documents(spark, rows, extra=False), BYTE, LIMITS, loss_column="n_chars").collect()
    check_sequences(found, LIMITS)
    loss = {i: n or 0 for i, _, _, _, n in rows}
    held = Counter()
    for r in found:
        quiet = max(0, r["doc_tokens"] - loss[r["doc_id"]])
        held[r["sequence_id"]] += max(0, r["start"] + r["length"] - max(r["start"], quiet))
    assert max(held.values()) <= LIMITS.loss_tokens
    with pytest.raises(ValueError):
        packing.pack(documents(spark, []), BYTE, packing.Limits(0, 1, 1))


def test_dot_product_prefers_what_fits_best():
    pool = packing.Pool(packing.Limits(10, 2, 10))
    for doc_id, length in enumerate((3, 7, 4)):
        pool.add(packing.Piece(doc_id, length, 0, 0, bytes(4 * length)))
    assert [p.doc_id for p in pool.sequence()] == [1, 0]


def pieces_of(texts):
    return [len(ids) for ids in token_counts.piece_counter(PIECE).model.encode([t or "" for t in texts], num_threads=1)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab Zé1. \n\t▁<s>漢😀\xa0ﬁ ")), max_size=30), max_size=8))
def test_piece_counts_are_the_librarys(texts):
    assert list(token_counts.piece_counter(PIECE).count(texts)) == pieces_of(texts)


@pytest.mark.parametrize("table", [None, {}])
def test_token_counts(spark, table):
    found = token_counts.count(split_over(documents(spark)), PIECE, 100, table)
    wanted = Counter((d, len((t or "").encode()), n, n > 100) for (d, t, *_), n in zip(ODD, pieces_of([t for _, t, *_ in ODD])))
    assert Counter(tuples(found, "doc_id", "n_bytes", "n_tokens", "over_limit")) == wanted
    assert token_counts.count(documents(spark, []), PIECE, 100, table).count() == 0
    assert len(LONG) > 100_000


@pytest.mark.parametrize("words", [1, 6])
def test_short_texts_are_packed_without_padding(spark, words):
    """Thousands of documents of a few ids: the limit on segments closes sequences, which then end at powers of two."""
    rows = [(i, " ".join(["a"] * (i % words + 1)), None, None, None) for i in range(6000)]
    limits = packing.Limits(tokens=2048, segments=128, loss_tokens=2048)
    pieces = packing.pack(documents(spark, rows, extra=False).coalesce(2), BYTE, limits, end_id=1).collect()
    lengths = defaultdict(int)
    for piece in pieces:
        lengths[piece["sequence_id"]] += piece["length"]
    rooms = [n if n & (n - 1) == 0 else 2048 for n in lengths.values()]
    assert sum(lengths.values()) == sum(len(ids_of(row[1])) + 1 for row in rows)
    assert sum(rooms) - sum(lengths.values()) <= 0.02 * sum(rooms)
    assert max(Counter(piece["sequence_id"] for piece in pieces).values()) <= 128


def test_loss_demands_place_examples_as_first_fit_cannot(spark):
    """Examples with long questions and long answers: a sequence is filled under both limits at once."""
    chosen = random.Random(4)
    answers = [chosen.choice([10, 250]) for _ in range(1500)]
    rows = [(i, " ".join(["a"] * 300), None, None, n) for i, n in enumerate(answers)]
    limits = packing.Limits(tokens=2048, segments=64, loss_tokens=1024)
    pieces = packing.pack(documents(spark, rows, extra=False).coalesce(1), BYTE, limits, end_id=1, loss_column="n_chars").collect()
    loss, used = defaultdict(int), defaultdict(int)
    for piece in pieces:
        used[piece["sequence_id"]] += piece["length"]
        quiet = piece["doc_tokens"] - min(answers[piece["doc_id"]], piece["doc_tokens"])
        loss[piece["sequence_id"]] += max(0, piece["start"] + piece["length"] - max(piece["start"], quiet))
    assert max(loss.values()) <= 1024 and max(used.values()) <= 2048
    first_fit, sizes = [], [len(ids_of(rows[0][1])) + 1] * len(rows)
    for size, answer in zip(sizes, answers):
        for bin_ in first_fit:
            if bin_[0] + size <= 2048 and bin_[1] + answer <= 1024:
                bin_[0], bin_[1] = bin_[0] + size, bin_[1] + answer
                break
        else:
            first_fit.append([size, answer])
    room = lambda lengths: sum(n if n & (n - 1) == 0 else 2048 for n in lengths)
    assert room(used.values()) < room([n for n, _ in first_fit])
