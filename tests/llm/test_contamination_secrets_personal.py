"""Phrase and proximity search, secrets, personal data: against plain searches of each text."""

import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import LONG, ODD, documents, sentence, split_over, tuples

from starkit.llm import decontamination, personal_data, secret_scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def matched(text, items, window=10):
    words, hit, found = words_of(text), set(), set()
    for item_id, item in items:
        wanted = words_of(item)
        n = min(window, len(wanted))
        phrases = {tuple(wanted[i : i + n]) for i in range(len(wanted) - n + 1)} if n and item_id is not None else ()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in phrases:
                hit.update(range(i, i + n))
                found.add(str(item_id))
    return len(words), len(hit), sorted(found)


def near(text, items, terms, slop, frequency):
    words, found = words_of(text), set()
    places = defaultdict(list)
    for i, word in enumerate(words):
        places[word].append(i)
    for item_id, item in items:
        rare = sorted(set(words_of(item)), key=lambda w: (frequency[w], w.encode()))[:terms]
        if rare and any(all(any(abs(p - q) <= slop for q in places[w]) for w in rare) for p in places[rare[0]]):
            found.add(str(item_id))
    return sorted(found)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("aZ9 é\xa0\x85\n-{`@[^_😀\x00")), max_size=40))
def test_words(text):
    assert [word.decode() for word in decontamination.words_of(text)] == words_of(text)


BODY = sentence(50, 300)
ITEMS = [
    (1, " ".join(BODY.split()[20:45])), (2, " ".join(BODY.split()[100:104])), (3, "never-there, not once"), (10, "magna"),
    (4, None), (5, ""), (None, "magna"), (6, sentence(70, 14)), (6, "ipsum sit"), (7, sentence(70, 14)), (7, sentence(70, 14)),
]


def rows_of():
    chosen = random.Random(9)
    rows = [(20 + i, sentence(200 + i, chosen.randint(0, 200)), None, None, None) for i in range(40)]
    passage = " ".join(BODY.split()[22:40])
    rows += [(100 + i, f"{sentence(300 + i, i)} {passage.upper()}! {passage}-{passage[:30]}", None, None, None) for i in range(8)]
    return [*ODD, *rows]


@pytest.mark.parametrize("block_words", [1_000_000, 10])
def test_decontamination(spark, block_words):
    rows = rows_of()
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = decontamination.decontaminate(split_over(documents(spark, rows)), benchmark, block_words=block_words)
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in found.collect())
    wanted = Counter()
    for doc_id, text, *_ in rows:
        n, hit, items = matched(text, ITEMS)
        wanted[doc_id, n, hit, tuple(items), hit > 0] += 1
    assert got == wanted


def test_proximity_and_shards(spark):
    rows = rows_of()
    index = decontamination.build_index(documents(spark, rows, extra=False).coalesce(2), shard_words=200)
    assert index.count() > 5
    items = [(i, t) for i, t in ITEMS if i in (1, 2, 6, 10)]
    frequency = Counter(w for _, text, *_ in rows for w in words_of(text))
    coded = [(str(i), decontamination.words_of(t)) for i, t in items if t != "ipsum sit"]
    found = decontamination.search(index, coded, terms=3, slop=6)
    wanted = Counter((d, tuple(near(t, [x for x in items if x[1] != "ipsum sit"], 3, 6, frequency))) for d, t, *_ in rows)
    assert Counter((r["doc_id"], tuple(r["near"])) for r in found.collect()) == wanted
    with pytest.raises(ValueError):
        decontamination.search(index, coded, slop=5000)


def test_proximity_searches_each_text_of_an_item(spark):
    rows = [(1, "uno x dos y tres", None, None, None), (2, "cuatro x cinco y seis", None, None, None), (3, "uno cinco", None, None, None)]
    items = spark.createDataFrame([(6, "cuatro cinco seis"), (6, "tres dos uno"), (7, "uno seis")], "item_id long, text string")
    found = decontamination.decontaminate(documents(spark, rows, extra=False), items)
    assert {r["doc_id"]: r["near"] for r in found.collect()} == {1: ["6"], 2: ["6"], 3: []}


def test_nothing_to_search_or_find(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontamination.decontaminate(documents(spark), none).collect()} == {0}
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.decontaminate(documents(spark, []), items).count() == 0


PATTERNS = {
    "assign": re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": 8, "access": 16, "hex": 32}


def secrets_of(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= LEAST[kind]:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(name for *_, name in sorted(found))


def secret_texts(n):
    chosen = random.Random(11)
    bits = ["password", "PassWd", "secret", "token", "API_KEY", "apikey", "=", ":", " ", '"', "'", "abcdef12", "é", "😀", "\n", "AKIA", "ABCDEFGHIJ12", "0123456789abcdef" * 2, "Zq81", "-", "ſecret", "toKen"]
    return ["".join(chosen.choice(bits) for _ in range(chosen.randint(0, 25))) for _ in range(n)]


def test_base_secrets_are_those_of_the_patterns(spark):
    rows = [*ODD, *((100 + i, text, None, f"s{i % 7}", None) for i, text in enumerate(secret_texts(600)))]
    found = secret_scan.scan(split_over(documents(spark, rows)))
    got = Counter(tuples(found.select("doc_id", secret_scan.listing("base").alias("base")), "doc_id", "base"))
    assert got == Counter((doc_id, secrets_of(text)) for doc_id, text, *_ in rows)
    missing = found.where(F.size(F.array_except("base", "spans")) > 0)
    assert missing.count() == 0
    assert secret_scan.scan(documents(spark, [])).count() == 0


KEY = "Zq81LmPq90XyZvBn7TrWq2Ks"


def test_owner_specific_values_are_added_and_copied_ones_are_not(spark):
    rows = [(i, f"see {KEY} here", None, f"owner{i}", None) for i in range(5)]
    rows += [(10 + i, f"see {KEY[::-1]} here", None, "one", None) for i in range(5)]
    rows += [(20, "see abcdefghijklmnopqrstuvwxyzabc", None, "one", None), (21, f"token={KEY}", None, "nobody", None)]
    found = {r["doc_id"]: r for r in secret_scan.scan(documents(spark, rows, extra=False)).collect()}
    for i in range(5):
        assert [s["kind"] for s in found[10 + i]["spans"]] == ["key"] and found[10 + i]["n_live"] == 1
        assert found[i]["spans"] == [] and found[i]["n_example"] == 1
    assert found[20]["spans"] == [] and [s["kind"] for s in found[21]["spans"]] == ["assign"]


def test_values_in_many_repositories_of_one_owner_are_examples(spark):
    many = secret_scan.EXAMPLE_REPOSITORIES
    rows = [(i, f"see {KEY} here", None, "one", None) for i in range(many)]
    rows += [(100 + i, f"see {KEY[::-1]} here", None, "one", None) for i in range(many - 1)] + [(100, f"see {KEY[::-1]} here", None, "one", None)] * 3
    found = secret_scan.scan(documents(spark, rows, extra=False)).collect()
    for row in found:
        copied = row["doc_id"] < 100
        assert (row["n_example"], row["n_live"], len(row["spans"])) == ((1, 0, 0) if copied else (0, 1, 1))


def test_texts_with_very_many_secrets(spark):
    n = 30_000
    text = " ".join(f"token=abcdef{i:06d}" for i in range(n))
    started = time.perf_counter()
    row = secret_scan.candidates(documents(spark, [(1, text, None, "one", None)], extra=False), "source", "doc_id").select("base").first()
    assert time.perf_counter() - started < 60
    assert [(s["start"], s["end"]) for s in row["base"]] == [(19 * i, 19 * i + 18) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 700])
def test_running_totals(spark, n):
    numbers = [i % 7 for i in range(n)]
    df = spark.createDataFrame([(numbers,)], "a array<int>")
    assert df.select(secret_scan.running_totals(F.col("a"))).first()[0] == np.cumsum(numbers).tolist()


def test_masking(spark):
    df = documents(spark, [(1, "é token=abcdef123456 x 😀password: 12345678", None, "a", None), (2, "none", None, "a", None), (3, None, None, None, None)], extra=False)
    found = secret_scan.scan(df).withColumnRenamed("doc_id", "id").join(df, F.col("id") == F.col("doc_id"))
    got = dict(tuples(found.select("id", secret_scan.redacted(F.col("text"), F.col("spans")).alias("t")), "id", "t"))
    assert got == {1: "é [SECRET] x 😀[SECRET]", 2: "none", 3: None}


PERSONAL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def personal_of(text):
    found = []
    for rank, (kind, pattern) in enumerate(PERSONAL.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(name for *_, name in sorted(found))


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from(list("a.@+-%1 2(05)é")), max_size=60))
def test_base_spans_of_any_text(text):
    base = [f"{personal_data.KINDS[rank]}:{start}:{end}" for start, rank, end, base, _ in personal_data.spans_of(text) if base]
    assert ",".join(base) == personal_of(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1 " * 100_000, "1" * 5000 + ".1.1.1"):
        personal_data.spans_of(text)


def test_personal_data(spark):
    rows = [*ODD, *((500 + i, f"call phone (555) 010-{1000 + i} now", None, None, None) for i in range(40))]
    rows += [(600 + i, f"Dear Mr. James Smith{i}, contact {i}@x{i}.example.com soon", None, None, None) for i in range(40)]
    found = personal_data.find(split_over(documents(spark, rows)))
    listed = found.select("doc_id", secret_scan.listing("base").alias("base"), secret_scan.listing("spans").alias("spans"))
    assert Counter(tuples(listed, "doc_id", "base")) == Counter((d, personal_of(t)) for d, t, *_ in rows)
    spans = dict(tuples(listed.where("doc_id >= 500"), "doc_id", "spans"))
    assert all(spans[500 + i] == "local:11:25" for i in range(40))
    assert found.where(F.size(F.array_except("base", "spans")) > 0).count() == 0
    assert personal_data.find(documents(spark, [])).count() == 0


def test_labelers_are_told_apart_by_their_agreement():
    """Three labelers that are right nine times in ten and one that guesses."""
    chosen = np.random.default_rng(5)
    counts, truth_of = Counter(), defaultdict(Counter)
    for _ in range(20_000):
        truth = int(chosen.random() < 0.6)
        votes = [truth if chosen.random() < 0.9 else 1 - truth for _ in range(3)] + [int(chosen.random() < 0.5)]
        code = sum(v * 3**i for i, v in enumerate(votes))
        counts[0, code] += 1
        truth_of[0, code][truth] += 1
    model = personal_data.LabelModel(counts)
    reliable = [model.rates[i][1, 1] for i in range(4)]
    assert all(abs(r - 0.9) < 0.03 for r in reliable[:3]) and abs(reliable[3] - 0.5) < 0.05
    for combination, p in model.probabilities().items():
        share = truth_of[combination][1] / counts[combination]
        assert (p >= 0.5) == (share >= 0.5)
    assert personal_data.LabelModel({}).probabilities() == {} and len(LONG) > 0


def test_the_label_model_is_the_right_way_up(spark):
    """On the given tables, valid mails, cards, phones and addresses are likely, numbers that fail their check digits are not."""
    found = personal_data.candidates(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    model = personal_data.label_model(found)
    spans = found.select(F.explode("spans").alias("s")).select("s.*", model.score(F.col("s.rank"), F.col("s.code")).alias("odds"))
    likely = spans.withColumn("p", 1 / (1 + F.exp(-F.col("odds"))))
    report = {row["rank"]: row for row in likely.where("base").groupBy("rank").agg(F.min("p").alias("p"), F.count("*").alias("n")).collect()}
    assert all(report[rank]["p"] >= 0.9 and report[rank]["n"] > 100 for rank in range(4))
    failed = likely.where((F.col("rank") == personal_data.KINDS.index("card")) & ~F.col("base"))
    assert failed.count() > 100 and failed.agg(F.max("p")).first()[0] < 0.1
    # the score of the plan is that of the model
    odds = {(row["rank"], row["code"]): row["odds"] for row in spans.select("rank", "code", "odds").distinct().collect()}
    assert all(abs(1 / (1 + np.exp(-odds[c])) - p) < 1e-9 for c, p in model.probabilities().items())


def test_added_spans_are_those_of_the_classifier(spark):
    """Local numbers, account numbers and names that no base rule knows, in texts of which most hold base spans."""
    texts = [f"write to a{i}@b.example.com or call +1 (555) 010-{1000 + i} now" for i in range(60)]
    texts += [f"call (555) 010-{2000 + i} today" for i in range(20)] + ["bank account DE89 3704 0044 0532 0130 00 please", "order DE12 3704 0044 0532 0130 00 no"]
    rows = [(i, text, None, None, None) for i, text in enumerate(texts)]
    found = {row["doc_id"]: row for row in personal_data.find(documents(spark, rows, extra=False)).collect()}
    kinds = {i: [span["kind"] for span in row["spans"]] for i, row in found.items()}
    assert all(kinds[i] == ["email", "phone"] for i in range(60)) and all(kinds[i] == ["local"] for i in range(60, 80))
    assert kinds[80] == ["iban"] and kinds[81] == []
