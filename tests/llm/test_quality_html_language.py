"""Quality statistics and forests, HTML extraction, language mixtures."""

import random
import re
import time
import zlib
from collections import Counter
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import ODD, documents, sentence, split_over, tuples

from starkit.llm import html_extraction, language_id, quality

LABELS = "doc_id long, quality int, toxic int"


def counts_of(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    inside = {i + j for i, window in enumerate(windows) if seen[window] > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab \n\t\x0b\xa0\x1c#|é😀")), max_size=200))
def test_statistics_of_any_text(text):
    assert quality.measure(text)[:5] == counts_of(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60), st.integers(1, 9))
def test_repeated_words_for_any_window(words, window):
    windows = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    seen = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(window)}
    assert quality.repeated_words(words, window) == len(inside)


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 1), (99, 1, 0), (10, 1, None)], LABELS)
    found = quality.assess(split_over(documents(spark)), labels)
    wanted = []
    for doc_id, text, *_ in ODD:
        n, *rest = counts_of(text)
        wanted.append((doc_id, n, *rest, n < 20 or 100 * rest[-1] > 30 * n))
    assert Counter(tuples(found, "doc_id", *quality.COUNTS, "base_failed")) == Counter(wanted)
    assert all(not row["kept"] for row in found.where("base_failed").collect())
    for none in (documents(spark, []), documents(spark)):
        bare = quality.assess(none, spark.createDataFrame([], LABELS))
        assert all(row["kept"] != row["base_failed"] for row in bare.collect())
    assert quality.assess(documents(spark, []), labels).count() == 0


def test_forest_rejects_what_labels_call_bad_and_keeps_the_rest(spark):
    chosen = random.Random(4)
    rows, labels, junk = [], [], set()
    for i in range(600):
        text = sentence(i, chosen.randint(25, 200))
        if i % 10 == 0:
            text = " ".join(word + "|$" for word in text.split())
            junk.add(i)
        rows.append((i, text, None, None, None))
        if i % 3:
            labels.append((i, int(i not in junk), 0))
    found = quality.assess(documents(spark, rows, extra=False), spark.createDataFrame(labels, LABELS))
    rejected = {row["doc_id"] for row in found.where("NOT kept AND NOT base_failed").collect()}
    failed = {row["doc_id"] for row in found.where("base_failed").collect()}
    assert junk <= rejected | failed and len(rejected - junk) <= 5


def test_isolated_rows_have_short_paths():
    random_rows = np.random.default_rng(2).normal(size=(1000, 3))
    forest = quality.Forest.fit(random_rows)
    scores = forest.scores(np.vstack([random_rows[:200], [[9.0, 9.0, 9.0]]]))
    assert scores[-1] > scores[:-1].max() and 0 < scores.min()
    assert quality.Forest.fit(np.ones((5, 2))).scores(np.ones((3, 2))).shape == (3,)


ARTICLE = "First sentence, with a comma. Second one &amp; more; it goes on. " * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<script>var a='<p>no</p>'</script><style>p{}</style>", ""),
        ("just text", "just text"),
        ("<p>open <b>bold<br><p>next &lt;x&gt; &#233;&nbsp;y", "open bold next <x> é y"),
        ("<article><h1>T</h1><p>a<b>b</b>c</p><p>d\n\n e</p></article>", "T abc d e"),
        (f"<nav><a href=x>Home</a></nav><article><p>{ARTICLE}</p></article><aside><p>{ARTICLE}</p></aside>", " ".join(ARTICLE.replace("&amp;", "&").split())),
        ("<article><p>One, two.</p><div class='comments'><p>Reader, says.</p></div><form><p>Name, here.</p></form></article>", "One, two."),
        ("<div class=ad>Buy, now.</div><main><header><h1>Head</h1></header><p>Text, it is.</p></main><footer>F, f.</footer>", "Head Text, it is."),
        ("<!-- c --><div id='cookie-notice'>We use, cookies.</div><p>Body, text.</p>", "Body, text."),
        ("<p>cut in a tag <a hre", "cut in a tag"),
        ("<P>Upper<BR/>case</P><IMG SRC='a>b'>", "Upper case"),
        ("<body class='no-sidebar header-small'><p>Whole, page.</p></body>", "Whole, page."),
    ],
)
def test_main_text(page, text):
    assert html_extraction.main_text(page) == text


def test_main_text_without_elements_for_articles():
    paragraphs = "".join(f"<p>{ARTICLE}</p>" for _ in range(4))
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(8))
    page = f"<div><ul>{links}</ul></div><div class=x><h2>Head</h2><div class=y>{paragraphs}<p>Short.</p></div></div><div>Small print</div>"
    body = " ".join(ARTICLE.replace("&amp;", "&").split())
    assert html_extraction.main_text(page) == f"Head {' '.join([body] * 4)} Short."


def test_main_text_in_several_elements():
    lead, end = (" ".join([f"{part} of it, with a comma; it goes on, as it is."] * 4) for part in ("Lead", "End"))
    body = "".join(f"<p>{ARTICLE}</p>" for _ in range(24))
    page = f"<article><div class=l><p>{lead}</p></div><h2>Sub</h2><div class=b>{body}</div><div class=e><p>{end}</p></div></article><footer>F, f.</footer>"
    whole = " ".join(ARTICLE.replace("&amp;", "&").split())
    assert html_extraction.main_text(page) == f"{lead} Sub {' '.join([whole] * 24)} {end}"


PROSE = "<p>" + "Some real words of prose, and more of them. " * 5 + "</p>"
READ = " ".join(["Some real words of prose, and more of them."] * 5)


@pytest.mark.parametrize("inside, text", [
    ('<p title="a hidden gem" data-id="share">Kept.</p>', "Kept."), ('<a href="/x?id=social">words</a>', "words"),
    ('<div class="entry-header"><h1>Title</h1></div>', "Title"), ('<section id="search-algorithms">Kept.</section>', "Kept."),
    ('<div class="topic social-science">Kept.</div>', "Kept."), ('<div id="legal">Kept.</div>', "Kept."),
    ('<ul><li><a href="x">One</a></li><li><a href="y">two</a></li></ul>', "One two"), ("<!-->a<p>b<!-- c --!>d", "a bd"),
    ('<div class="comments">Gone.</div>', ""), ("<div class='share-buttons'>Gone.</div>", ""), ("<div class=ad>Gone.</div>", ""),
    ('<div id="related_posts">Gone.</div>', ""), ("<p hidden>Gone.</p>", ""), ('<p title=hidden id="k">Kept.</p>', "Kept."),
])
def test_words_of_attributes_decide_only_where_they_name_a_part(inside, text):
    assert html_extraction.main_text(f"<article title='the hidden story'>{inside}{PROSE}</article>") == f"{text} {READ}".strip()


class ArticleReader(HTMLParser):
    """Another way to the main text of pages whose article holds nothing but headings and paragraphs."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.within, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.within |= tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.within &= tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.within:
            self.blocks[-1] += data


def test_given_pages_against_another_parser():
    rows = duckdb.connect().execute("SELECT html FROM '/root/testdata/sf0.1/pages.parquet'").fetchall()
    for (page,) in rows:
        reader = ArticleReader()
        reader.feed(page)
        reader.close()
        assert html_extraction.main_text(page) == " ".join(" ".join(block.split()) for block in reader.blocks if block.strip())
    assert len(rows) == 2500


def test_paths_decide_where_no_element_does():
    """Without an article and without names, long punctuated text tells content from captions."""
    captions = "".join(f"<table><tr><td>Item {i}</td><td>{i}</td></tr></table>" for i in range(12))
    page = f"<body><div><span>Home</span></div><div>{captions}</div><div>{PROSE * 3}</div><div>{captions}</div></body>"
    assert html_extraction.main_text(page) == " ".join([READ] * 3)


@pytest.mark.parametrize("page, length", [
    ("<div>x" * 50_000, 99_999), ("<b>" * 20_000 + "y" + "</i>" * 20_000, 1), ("<li><div>" + "<b>" * 20_000 + "<li>z" * 20_000, 39_999),
    ("<p>" + "<b>" * 20_000 + "<p>z" * 3000, 5999),
])
def test_deep_pages_take_seconds(page, length):
    started = time.perf_counter()
    assert len(html_extraction.main_text(page)) == length
    assert time.perf_counter() - started < 20


def test_pages(spark):
    rows = [(1, "u", "<p>a, b.</p>"), (1, "u", "<p>a, b.</p>"), (None, None, "<p>é😀</p>"), (2, "v", None), (3, None, ""), (4, "w", "<div>" * 5000 + "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' AS text", "1 AS n_chars")
    found = tuples(html_extraction.extract(pages), "page_id", "url", "text", "n_chars")
    wanted = [(1, "u", "a, b.", 5)] * 2 + [(None, None, "é😀", 2), (2, "v", "", 0), (3, None, "", 0), (4, "w", "x", 1)]
    assert Counter(found) == Counter(wanted)
    assert html_extraction.extract(pages.limit(0)).count() == 0


WORDS = {
    "en": "the of and thing other with this that from have would there", "de": "der und nicht schön über ein mit auf zwischen gewöhnlich",
    "fr": "le être où déjà avec dans une leur français cette même", "es": "el niño mañana según también donde esta había corazón",
}


def prose(lang, seed, words):
    chosen = random.Random(seed)
    return " ".join(chosen.choice(WORDS[lang].split()) for _ in range(words))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(prose(lang, i, 30), lang) for lang in WORDS for i in range(60)] + [(None, "en"), ("x", None), ("123", "zz")]
    return language_id.learn(spark.createDataFrame(rows, "text string, lang string"))


def test_languages_and_mixtures(spark, model):
    assert model.languages == sorted(WORDS)
    for lang in WORDS:
        assert list(model.mixture(prose(lang, 1000, 25))) == [lang]
    mixed = model.mixture(prose("en", 1, 200) + " " + prose("fr", 2, 100))
    assert list(mixed) == ["en", "fr"] and 0.25 < mixed["fr"] < 0.45 and abs(sum(mixed.values()) - 1) < 1e-6
    found = language_id.identify(split_over(documents(spark)), model)
    assert Counter(tuples(found, "doc_id")) == Counter((row[0],) for row in ODD)
    for row in found.join(documents(spark, extra=False).distinct(), "doc_id").collect():
        assert 0 <= row["score"] <= 1
        if not any(map(str.isalpha, row["text"] or "")) and row["doc_id"] != 10:
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    assert language_id.identify(documents(spark, []), model).count() == 0


def test_nothing_learned(spark):
    empty = language_id.learn(spark.createDataFrame([], "text string, lang string"))
    assert {row["lang_pred"] for row in language_id.identify(documents(spark), empty).collect()} == {"und"}


def test_held_out_rows(spark):
    found = spark.range(200).select("id", language_id.is_held_out(F.col("id")).alias("h"))
    assert all(row["h"] == (zlib.crc32(str(row["id"]).encode()) % 4 == 2) for row in found.collect())


@pytest.mark.parametrize("scale", ["0.01"])
def test_held_out_accuracy(spark, scale):
    from starkit.llm import queries

    found = queries.QUERIES["op8_language_mixture"](spark, f"/root/testdata/sf{scale}").where("held_out")
    docs = spark.read.parquet(f"/root/testdata/sf{scale}/documents.parquet")
    right = found.join(docs, "doc_id").selectExpr("avg(CAST(lang = lang_pred AS INT)) AS a").first()["a"]
    assert right > 0.97


def test_a_minority_language_behind_many_relatives_of_the_main_one():
    """The minority ranks last alone, behind the main language and eleven relatives."""
    main, minor = " ".join(["lorem ipsum dolor sit amet tempor magna aliqua"] * 12), " ".join(["привет большой город зима"] * 6)

    def rates(text):
        counts = np.zeros(language_id.SLOTS)
        slots, n = language_id.slots_of(text)
        counts[slots] += n
        return 0.99 * counts / counts.sum() + 0.01 / language_id.SLOTS

    spread = np.random.default_rng(3).random((11, language_id.SLOTS))
    relatives = [0.9 * rates(main) + 0.1 * noise / noise.sum() for noise in spread]
    names = ["main", *(f"r{i}" for i in range(11)), "minor"]
    model = language_id.Model(names, np.array([rates(main), *relatives, rates(minor)]))
    found = model.mixture(f"{main} {minor}")
    assert list(found) == ["main", "minor"] and 0.1 < found["minor"] < 0.35
