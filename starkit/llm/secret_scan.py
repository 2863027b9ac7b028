"""Secrets in whole texts, told apart by who owns the text they stand in.

Built-in functions only. Candidates are cut out of each text once and written; their hashes are counted by distinct repositories and
owners over the corpus. A value that several owners have, or that an owner has in many repositories, is an example that was copied; a
random-looking value of one owner and few repositories is taken for live. Candidates of the base kinds always count; further ones, of no base kind, count where they look live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.operators.joins import Side, to_dimensions
from starkit.session import stage

#: The base kinds in order, then the further one.
PATTERNS = {
    "assign": (
        "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    ),
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]{32,}",
    "key": (
        "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"
        "|(gh[pousr]_|sk_live_|xox[abprs]-)[A-Za-z0-9_-]{16,}"
        "|[A-Za-z0-9+/_-]{24,}"
    ),
}
BASE = ("assign", "access", "hex")
#: What a text must hold for a kind to be there at all: cheap to look for.
HINTS = {"assign": "[:=]", "access": "AKIA"}
LEAST = {"assign": 8, "access": 16, "hex": 32, "key": 24}
#: A value of so many owners, or in so many repositories whoever owns them, is an example.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 20
#: Different characters that a live-looking value has at least.
LIVE_CHARS = 8


#: Elements that a running total is made over at a time.
CHUNK = 256


def running_totals(numbers: Column) -> Column:
    """For each of an array of numbers the sum up to it. Totals are made within chunks, then over chunks, so no long array is copied for each element."""

    def totals(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        add = lambda s, x: F.struct((s["at"] + x).alias("at"), F.array_append(s["out"], s["at"] + x).alias("out"))
        return F.aggregate(values, start, add, lambda s: s["out"])

    def chunked(values: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int"))
        within = F.transform(places, lambda i: totals(F.slice(values, i * CHUNK + 1, F.lit(CHUNK))))
        return F.when(F.size(values) > 0, _let(within, joined)).otherwise(F.array().cast("array<int>"))

    def joined(parts: Column) -> Column:
        return _let(totals(F.transform(parts, lambda part: F.element_at(part, -1))), lambda before: shifted(parts, before))

    def shifted(parts: Column, before: Column) -> Column:
        return F.flatten(F.transform(parts, lambda part, i: F.transform(part, lambda x: x + F.when(i > 0, F.get(before, i - 1)).otherwise(0))))

    return _let(numbers, chunked)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spans(text: Column, kind: str, rank: int) -> Column:
    """start, rank, end, kind, value of all matches, failing ones dropped: positions add up lengths of matches and of what is between."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")

    def placed(matches: Column) -> Column:
        pairs = F.slice(F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("gap"), matches.alias("match")), F.lit(1), F.size(matches))
        ends = running_totals(F.transform(pairs, lambda p: F.length(p["gap"]) + F.length(p["match"])))
        return F.transform(F.arrays_zip(matches.alias("match"), ends.alias("end")), span)

    def span(pair: Column) -> Column:
        value = F.regexp_extract(pair["match"], PATTERNS[kind], 2) if kind == "assign" else pair["match"]
        return F.struct(
            (pair["end"] - F.length(pair["match"])).alias("start"), F.lit(rank).alias("rank"), pair["end"].alias("end"),
            F.lit(kind).alias("kind"), value.alias("value"),
        )

    cut = F.filter(_let(found, placed), lambda s: F.length(s["value"]) >= LEAST[kind])
    there = text.rlike(PATTERNS[kind])
    return F.when((text.rlike(HINTS[kind]) & there) if kind in HINTS else there, cut).otherwise(empty)


def candidates(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """row (a number), doc_id, owner, repository, text_hash, base and further spans of each row; written once, which fixes the numbers."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"), F.xxhash64("text").alias("text_hash"),
        *(_spans(text, kind, rank).alias(kind) for rank, kind in enumerate(PATTERNS)),
    )
    mixed = lambda value: value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
    apart = lambda span: ~F.exists("base", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
    found = rows.select("doc_id", "owner", "repository", "text_hash", F.array_sort(F.concat(*BASE)).alias("base"), "key")
    further = F.filter("key", lambda span: mixed(span["value"]) & apart(span))
    numbered = found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", "text_hash", "base", further.alias("further"))
    return stage(numbered, "secret-candidates")


def ownership(found: DataFrame) -> DataFrame:
    """For each hash of a candidate: owners and repositories that have it. Counted inside the input tasks before anything moves."""
    values = found.select("owner", "repository", F.explode(F.concat("base", "further")).alias("span"))
    hashed = values.select(F.sha2("span.value", 256).alias("hash"), "owner", "repository")
    owners = hashed.groupBy("hash", "owner").count().groupBy("hash").agg(F.count("*").alias("owners"))
    places = hashed.groupBy("hash", "repository").count().groupBy("hash").agg(F.count("*").alias("repositories"))
    return owners.join(places, "hash")


def scan(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """For each row of ``docs`` (doc_id, text, owner, repository): row, doc_id, text_hash, base, spans, n_live, n_example.

    base: the spans of the base kinds (start, rank, end, kind, value); spans: those and the further ones that look live, in order. n_live and
    n_example count the candidates of the row that are taken for live, or for copied examples. A null text
    is empty. A null owner or repository is one of its own. Repeated rows have results of their own; other
    columns are ignored; no rows give no rows.
    """
    found = candidates(docs, owner, repository)
    known = ownership(found)
    each = found.select("row", F.explode(F.concat("base", "further")).alias("span")).withColumn("hash", F.sha2("span.value", 256))
    copied = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories)
    verdicts = stage(known.select("hash", copied.alias("example")), "secret-verdicts")
    example = F.col("example")
    different = F.size(F.array_distinct(F.regexp_extract_all("span.value", F.lit("."), F.lit(0))))
    live = ~example & (different >= LIVE_CHARS) & F.col("span.value").rlike("[0-9]")
    # the verdicts are broadcast if they are measured to fit; else rows of hashes that are copied very often do not meet in one task
    met = to_dimensions(each, [Side(verdicts, {"hash": "hash"}, ["example"])], "inner")
    judged = met.select("row", "span", "example", live.alias("live"))
    by_row = judged.groupBy("row").agg(
        F.collect_list(F.when(F.col("live") & (F.col("span.rank") >= len(BASE)), F.col("span"))).alias("added"),
        F.sum(F.col("live").cast("long")).alias("n_live"), F.sum(F.col("example").cast("long")).alias("n_example"),
    )
    spans = F.array_sort(F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added")))
    counts = [F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in ("n_live", "n_example")]
    return found.join(by_row, "row", "left").select("row", "doc_id", "text_hash", "base", spans.alias("spans"), *counts)


def listing(spans: Column | str) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def n_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by ``mask``."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        between = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        out = F.when(fresh, F.concat(state["out"], between, F.lit(mask))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    rest = lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, state, add, rest)).otherwise(text)
