"""Near duplicates against all pairs."""

import random
import re

import pytest
from rows import ODD, documents, sentence, split_over, tuples

import corpus_pipeline
from starkit.llm import near_duplicates
from starkit.llm.graph import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_force(rows):
    sets = [shingles(text) for _, text, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            if one and 100 * len(one & sets[j]) >= 85 * len(one | sets[j]):
                root[find(i)] = find(j)
    found = []
    for i, (doc_id, *_) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(group, default=None)
        found.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(found, key=str)


def found_in(spark, rows, extra=False):
    found = near_duplicates.group(split_over(documents(spark, rows, extra)))
    return sorted(tuples(found, "doc_id", "n_shingles", "component_id", "kept"), key=str)


def test_odd_rows(spark):
    assert found_in(spark, None, extra=True) == brute_force(ODD)


def test_rows_without_ids_are_linked_by_their_texts(spark):
    texts = family(20, 60, 1, 8) + family(10, 8, 1, 9)
    rows = [(None, text, None, None, None) for text in texts] + [(5, texts[0], None, None, None), (5, texts[25], None, None, None)]
    assert found_in(spark, rows) == brute_force(rows)


def test_no_rows(spark):
    assert found_in(spark, []) == []


def edited(text, chosen, edits):
    words = text.split()
    for _ in range(edits):
        words[chosen.randrange(len(words))] = f"new{chosen.randrange(10**6)}"
    return " ".join(words)


def family(size, base, edits, seed, passage=""):
    chosen = random.Random(seed)
    body = sentence(seed, base)
    return [f"{passage} {edited(body, chosen, chosen.randint(0, edits))}" for _ in range(size)]


@pytest.mark.parametrize("rounds", [1, 3])
def test_families_of_near_copies_and_a_common_passage(spark, monkeypatch, rounds):
    """Similarities on both sides of the threshold, short and long texts, a passage in all of them, chains."""
    monkeypatch.setattr(near_duplicates, "STAR_ROUNDS", rounds)
    passage = sentence(99, 60)
    texts = family(40, 150, 4, 1) + family(30, 30, 1, 2) + family(25, 12, 1, 3, passage) + family(20, 400, 12, 4, passage)
    texts += family(10, 4, 1, 5) + family(10, 7, 1, 6)
    chain = sentence(7, 200).split()
    texts += [" ".join(chain[i : i + 150]) for i in range(0, 50, 4)]
    rows = [(1000 - i, text, None, None, None) for i, text in enumerate(texts)]
    assert found_in(spark, rows) == brute_force(rows)


def overlapping(one, other, shared, seed):
    """Two texts of ``one`` and ``other`` shingles, ``shared`` of them in both."""
    words = [f"w{seed}x{i}" for i in range(one + 4)]
    return [" ".join(words), " ".join(words[one - shared :] + [f"v{seed}x{i}" for i in range(other - shared)])]


def test_long_sets_whose_sizes_differ(spark):
    """Cut copies, and copies with an end of their own, around the length of the longer sketches."""
    sizes = [(n, max(shared, -(-n * 85 // 100)), shared) for n in range(860, 1101, 8) for shared in (-(-n * 87 // 100), -(-n * 93 // 100))]
    sizes += [(n, n - 20, n - 95) for n in range(864, 1101, 24)]
    texts = [text for seed, (one, other, shared) in enumerate(sizes) for text in overlapping(one, other, shared, seed)]
    rows = [(i, text, None, None, None) for i, text in enumerate(texts)]
    assert found_in(spark, rows) == brute_force(rows)


def test_sets_about_as_long_as_the_sketches_of_the_filter(spark):
    """Pairs that are just similar enough: most of their unions hold more values than a sketch."""
    sizes = [(256, 240, 228), (256, 248, 232), (256, 256, 236), (255, 245, 230), (254, 254, 234), (240, 240, 221), (260, 250, 235)]
    sizes = [size for size in sizes for _ in range(12)] + [(256, 240, 227), (256, 256, 235)]  # the last two are not
    texts = [text for seed, (one, other, shared) in enumerate(sizes) for text in overlapping(one, other, shared, seed)]
    rows = [(i, text, None, None, None) for i, text in enumerate(texts)]
    assert found_in(spark, rows) == brute_force(rows)


def test_the_pipeline_links_from_80_hundredths_on(spark):
    """Similarities around 0.80 and between it and 0.85, short and long: one row of such a group stays."""
    sizes = [(n, n, -(-16 * n // 18) - off) for n in (18, 90, 250, 256, 900, 1100) for off in (0, 1)] + [(900, 760, 735)]
    texts = [text for seed, (one, other, shared) in enumerate(sizes) for text in overlapping(one, other, shared, seed)]
    docs = documents(spark, [(i, text, None, None, None) for i, text in enumerate(texts)], extra=False)
    linked = [100 * shared >= 80 * (one + other - shared) for one, other, shared in sizes]
    wanted = [i for i in range(len(texts)) if i % 2 == 0 or not linked[i // 2]]
    kept = corpus_pipeline.near_duplicate_groups(spark, docs, "").collect()
    assert sorted(row["doc_id"] for row in kept) == wanted
    assert near_duplicates.Bounds.of(80) != near_duplicates.Bounds.of(85)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, 500 + i) for i in range(1, 40)] + [(900, 901), (901, 900)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    wanted = {(i, 0) for i in range(1, 61)} | {(500 + i, 500) for i in range(1, 40)} | {(901, 900)}
    assert set(tuples(found, "node", "root")) == wanted and found.count() == len(wanted)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_that_are_stars_already_take_no_further_step(spark, monkeypatch):
    from starkit.llm import graph

    written = []
    monkeypatch.setattr(graph, "stage", lambda df, label: written.append(label) or df.localCheckpoint())
    pairs = spark.createDataFrame([(i, 1000 + i) for i in range(50)] + [(7, 2000), (7, 2001)], "a long, b long")
    assert {(r["node"], r["root"]) for r in components(pairs).collect()} == {(b, a) for a, b in pairs.collect()}
    assert len(written) == 1
    path = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (99, 98)], "a long, b long")
    assert {(r["node"], r["root"]) for r in components(path).collect()} == {(i, 0) for i in range(1, 41)} | {(99, 98), (100, 98)}
    assert components(path.where("a < 0")).isEmpty()
