"""Languages of texts as mixtures: which languages a text holds, and in what proportions.

Each language has a distribution over hashed character n-grams, learned from labelled texts. Expectation-maximisation finds the
proportions under which a text's n-grams are likeliest; a language is in the set if it raises the likelihood by
more than the penalty for one more proportion.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import batch_of, map_arrow

#: Sizes of n-grams and slots that they are hashed to.
SIZES = (1, 2, 3)
SLOTS = 1 << 14
#: Rows, on average, of each language that its distribution is learned from.
ROWS_PER_LANGUAGE = 4000
#: Languages that can be learned: the table of their distributions has SLOTS numbers for each (64 MB at most).
MOST_LANGUAGES = 1000
#: Mass of n-grams that were not seen, spread over all slots.
SMOOTHING = 0.01
STEPS, CLOSE = 60, 1e-4
#: Languages that start a mixture: those with the highest likelihoods alone. Others are added where they gain enough.
STARTERS = 8
#: A language is in the set if the log-likelihood falls by more than this times the log of the n-gram count without it.
PENALTY = 2.0
UNKNOWN = "und"

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def slots_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams of the letters of a text, words apart, and how often each occurs."""
    letters = f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} "
    codes = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    hashed, found = np.zeros(len(codes), np.uint64), []
    for i in range(max(SIZES)):
        if len(codes) <= i:
            break
        hashed = (hashed[: len(codes) - i] + codes[i:]) * _MULTIPLIERS[i]
        hashed ^= hashed >> np.uint64(15)
        if i + 1 in SIZES:
            found.append(hashed % np.uint64(SLOTS))
    counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=SLOTS)
    slots = np.flatnonzero(counts)
    return slots, counts[slots]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    """languages, and for each the probabilities of all slots."""

    languages: list[str]
    probabilities: np.ndarray

    def mixture(self, text: str | None) -> dict[str, float]:
        """Proportions of the languages in the set of a text, largest first; empty without a letter."""
        if not self.languages or not has_letter(text):
            return {}
        slots, counts = slots_of(text)
        likely = self.probabilities[:, slots]
        alone = np.log(likely) @ counts
        ranked = np.argsort(-alone, kind="stable")
        likely, total = likely[ranked], counts.sum()
        penalty = PENALTY * np.log(total)
        chosen, shares, best = self._without_minor(likely, counts, np.arange(min(STARTERS, len(ranked))), penalty)
        while len(chosen) < len(ranked):  # add a language that was left out and gains more than the penalty, until none does
            slopes = likely @ (counts / (shares @ likely[chosen])) - total
            # the log-likelihood is concave, so no gain is above the largest slope of the languages of a mixture
            able = np.setdiff1d(np.flatnonzero(np.maximum(slopes, slopes[chosen].max()) > penalty), chosen)
            for language in able[np.argsort(-slopes[able], kind="stable")]:
                more = np.sort(np.append(chosen, language))
                wider, value = self._fit(likely[more], counts)
                if value - best > penalty:
                    break
            else:
                break
            chosen, shares, best = self._without_minor(likely, counts, more, penalty, (wider, value))
        chosen = ranked[chosen]
        order = np.argsort(-shares, kind="stable")
        return {self.languages[chosen[i]]: float(shares[i]) for i in order}

    def _without_minor(self, likely: np.ndarray, counts: np.ndarray, chosen: np.ndarray, penalty: float, fitted=None) -> tuple:
        """Languages, proportions and log-likelihood when those have gone that are missed by no more than the penalty."""
        shares, best = fitted or self._fit(likely[chosen], counts)
        while len(chosen) > 1:  # drop the language that is missed least, as long as that costs less than the penalty
            least = int(np.argmin(shares))
            rest = np.delete(chosen, least)
            fewer, value = self._fit(likely[rest], counts)
            if best - value > penalty:
                break
            chosen, shares, best = rest, fewer, value
        return chosen, shares, best

    @staticmethod
    def _fit(likely: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions by expectation-maximisation and the log-likelihood under them."""
        n = len(likely)
        shares = np.full(n, 1 / n)
        if n > 1:
            weights = counts / counts.sum()
            for _ in range(STEPS):
                new = shares * (likely @ (weights / (shares @ likely)))
                moved = np.abs(new - shares).max()
                shares = new
                if moved < CLOSE:
                    break
        return shares, float(np.log(shares @ likely) @ counts)


def is_held_out(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text leaves 2 when divided by 4; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 4 == 2


def learn(rows: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """The model from ``rows`` (text, lang), those with a null or letterless side left out.

    Of each language about ``rows_per_language`` rows are read, chosen by the hash of their text. Their n-grams are
    counted inside the tasks; a task sends one row of SLOTS counts for each language.
    """
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {row["lang"]: row["count"] for row in known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return Model([], np.empty((0, SLOTS)))
    share = F.create_map(*(F.lit(x) for pair in sizes.items() for x in (pair[0], min(1.0, rows_per_language / pair[1]))))
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / (1 << 30)
    part = known.where(place < share[F.col("lang")]).select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if has_letter(text):
                    slots, counts = slots_of(text)
                    total.setdefault(lang, np.zeros(SLOTS, np.int64))[slots] += counts
        used = [(lang, int(slot), int(counts[slot])) for lang, counts in total.items() for slot in np.flatnonzero(counts)]
        kinds = {"lang": pa.string(), "slot": pa.int32(), "n": pa.int64()}
        yield batch_of({name: ([row[i] for row in used], kind) for i, (name, kind) in enumerate(kinds.items())})

    summed = map_arrow(part, counted, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    table = {lang: np.zeros(SLOTS) for lang in sizes}
    for row in summed.toLocalIterator():
        table[row["lang"]][row["slot"]] = row["n"]
    languages = sorted(lang for lang, counts in table.items() if counts.any())
    rates = np.array([table[lang] / table[lang].sum() for lang in languages]).reshape(len(languages), SLOTS)
    return Model(languages, (1 - SMOOTHING) * rates + SMOOTHING / SLOTS)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, lang_pred, score, languages, proportions.

    lang_pred is the language with the largest proportion of the text's set, score that proportion. ``und`` and 0 for
    null, empty and letterless texts, and where nothing was learned. Ties go to the likelier language alone. Repeated
    rows have equal results; other columns are ignored; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.mixture(text) for text in batch.column("text").to_pylist()]
            first = [next(iter(mixture.items()), (UNKNOWN, 0.0)) for mixture in found]
            yield batch_of({
                "doc_id": (batch.column("doc_id"), pa.int64()), "lang_pred": ([lang for lang, _ in first], pa.string()),
                "score": ([min(1.0, share) for _, share in first], pa.float64()),
                "languages": ([list(mixture) for mixture in found], pa.list_(pa.string())),
                "proportions": ([list(mixture.values()) for mixture in found], pa.list_(pa.float64())),
            })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, lang_pred string, score double, languages array<string>, proportions array<double>"
    return map_arrow(rows, identified, schema)
