"""Personal data in whole texts by weak supervision.

Patterns propose spans; labelers of three sorts vote on each: patterns and check digits, gazetteers, and words around it. How far each labeler can be
relied on for each kind is estimated by expectation-maximisation from how they agree over the whole corpus; a prior that labelers are better than chance, and
rules that no personal span breaks, say which way is up. A classifier of the votes and of what a span and its surroundings look like is trained on the
resulting labels and decides on each span. All of this only needs the number of spans with each combination of votes and looks.
Spans of the base kinds that pass their rules always count; the classifier adds others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import batch_of, map_arrow
from starkit.session import stage

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "national", "iban", "local", "name")
LABELERS = ("pattern", "gazetteer", "context", "edge")
YES, NO, SILENT = 1, 0, 2
VOTES = 3 ** len(LABELERS)
#: Characters on either side in which context words are looked for.
AROUND = 40
#: Spans with this probability or more are added.
ADD_FROM = 0.9

#: Kinds whose check digits or number ranges every true span passes: a candidate that fails them is a known negative.
CHECKED = ("card", "phone", "national", "iban")
#: Weight of the prior on a labeler's rates for a kind, as a share of the kind's spans, and at least so many spans.
PRIOR_SHARE, PRIOR_SPANS = 0.02, 20.0
#: Rates of votes for no, yes and silent that the prior has: of spans that are not personal, and of those that are.
PRIOR_RATES = ((0.55, 0.15, 0.30), (0.05, 0.65, 0.30))
#: How many values each feature of a span has: length, separators, what stands before it and after it.
LOOKS = (4, 2, 4, 3)

# Gazetteers and context words; choices, not parts of the contract.
TOP_DOMAINS = set("com org net edu gov info biz io de fr es it nl at ch be eu uk us ca au jp cn in br mx pl se no dk fi pt ru".split())
CARD_PREFIXES = re.compile(r"4|5[1-5]|2[2-7]|3[47]|36|38|30|35|6011|65|50|5[6-9]|6")
TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra"
GIVEN_NAMES = (
    "James|John|Robert|Michael|William|David|Richard|Joseph|Thomas|Charles|Mary|Patricia|Jennifer|Linda|Elizabeth|Barbara|Susan|Jessica|"
    "Sarah|Karen|Daniel|Matthew|Anthony|Mark|Paul|Steven|Andrew|Peter|Hans|Klaus|Jürgen|Wolfgang|Sabine|Monika|Ursula|Petra|Pierre|Jean|"
    "Michel|Philippe|Marie|Nathalie|Isabelle|Sylvie|José|Juan|Carlos|Luis|Javier|María|Carmen|Ana|Laura|Lucía"
)
CONTEXT = {
    "email": "mail|e-mail|contact|write|reach|kontakt|courriel|correo",
    "ip": "ip|address|host|server|login|client|adresse",
    "card": "card|visa|mastercard|amex|credit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|cell|contact|telefon|téléphone|teléfono",
    "national": "ssn|social|security|national|insurance|passport",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "local": "phone|tel|call|mobile|fax|cell|contact|telefon|téléphone|teléfono",
    "name": "name|contact|dear|signed|regards|author|patient|customer|sehr geehrte|cher|estimad",
}
DENIED = "version|release|isbn|issn|sku|order|invoice|section|figure|page|chapter|example|sample|dummy|part no"

_CONTEXT = {kind: re.compile(rf"\b(?:{words})", re.I) for kind, words in CONTEXT.items()}
_DENIED = re.compile(rf"\b(?:{DENIED})\b", re.I)
_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match of four numbers starts at the first digit of a run: where a run fails from there, it fails from each of its digits.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_FURTHER = {
    "national": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "local": re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])"),
    "name": re.compile(rf"(?<!\w)(?=[A-Z])(?:(?:{TITLES})\.? (?:[A-Z][\w'-]+ )?|(?:{GIVEN_NAMES}) )[A-Z][\w'-]+"),
}
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        total += digit if i % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    turned = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in turned[4:] + turned[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain; time is linear also where long runs have no @."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_PART:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def passes(kind: str, match: str) -> bool:
    """The rule of a kind for what its pattern matches."""
    digits = "".join(_DIGITS.findall(match))
    if kind == "ip":
        parts = [part.lstrip("0") or "0" for part in match.split(".")]
        return all(len(part) <= 3 and int(part) <= 255 for part in parts)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "national":
        return match[:3] not in ("000", "666") and match[0] != "9" and match[4:6] != "00" and match[7:] != "0000"
    if kind == "iban":
        return iban_valid(match)
    return True


def listed(kind: str, match: str) -> int:
    """The vote of the gazetteers."""
    if kind == "email":
        return YES if match.rpartition(".")[2].lower() in TOP_DOMAINS else NO
    if kind == "ip":
        first, second = (int(part.lstrip("0")[:4] or "0") for part in match.split(".")[:2])
        private = first in (0, 10, 127) or first > 223 or (first, second) == (192, 168) or first == 172 and 16 <= second < 32
        return NO if private else SILENT
    if kind == "card":
        return YES if CARD_PREFIXES.match(match) else NO
    if kind == "name":
        return YES if re.match(rf"(?:{TITLES})\.? |(?:{GIVEN_NAMES}) ", match) else NO
    return SILENT


def around(kind: str, text: str, start: int, end: int) -> int:
    """The vote of the words before and after."""
    near = f"{text[max(0, start - AROUND) : start]} {text[end : end + AROUND]}"
    return YES if _CONTEXT[kind].search(near) else NO if _DENIED.search(near) else SILENT


def edges(text: str, start: int, end: int) -> int:
    """The vote of what touches the span: a part of a longer token is no span of its own."""
    touches = text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()
    return NO if touches else YES


def looks(text: str, start: int, end: int) -> int:
    """Code of the features of a span: length, separators within, the last character before it and the first after it."""
    size = sum(end - start > limit for limit in (10, 16, 24))
    parted = any(c in " -()/" for c in text[start:end])
    before = text[max(0, start - 4) : start].rstrip(" ")[-1:]
    preceded = 0 if before in ("", "\n") else 1 if before.isalnum() else 2 if before in ":=(<\"'[" else 3
    after = text[end : end + 1]
    followed = 0 if after in ("", " ", "\n", "\t", "\r") else 1 if after.isalnum() else 2
    code = 0
    for value, values in zip((size, int(parted), preceded, followed), LOOKS):
        code = code * values + value
    return code


def spans_of(text: str | None) -> list[tuple[int, int, int, bool, int]]:
    """start, rank of the kind, end, whether it is a base span, and the code of the votes, of each candidate."""
    if not text:
        return []
    found: list[tuple[int, int, int]] = []
    if "@" in text:
        found += [(start, 0, end) for start, end in emails(text)]
    if _DIGITS.search(text):
        for rank, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
            found += [(m.start(), rank, m.end()) for m in pattern.finditer(text)]
        for kind in ("national", "iban", "local"):
            found += [(m.start(), KINDS.index(kind), m.end()) for m in _FURTHER[kind].finditer(text)]
    found += [(m.start(), KINDS.index("name"), m.end()) for m in _FURTHER["name"].finditer(text)]
    judged = []
    for start, rank, end in found:
        kind, match = KINDS[rank], text[start:end]
        if kind == "card" and end - start < 12:
            continue  # numbers too short for a card: neither base nor worth a vote
        passed = passes(kind, match)
        if kind == "ip" and not passed:
            continue
        votes = (YES if passed else NO, listed(kind, match), around(kind, text, start, end), edges(text, start, end))
        code = sum(vote * 3**i for i, vote in enumerate(votes)) + VOTES * looks(text, start, end)
        judged.append((start, rank, end, passed and kind in BASE, code))
    return sorted(judged)


def votes_of(code: int) -> list[int]:
    return [code // 3**i % 3 for i in range(len(LABELERS))]


def looks_of(code: int) -> list[int]:
    rest, found = code // VOTES, []
    for values in reversed(LOOKS):
        rest, value = divmod(rest, values)
        found.append(value)
    return found[::-1]


class LabelModel:
    """Reliabilities of the labelers and the classifier trained on their labels; both are fitted on counts of combinations of kind, votes and looks."""

    def __init__(self, counts: dict[tuple[int, int], int], steps: int = 200):
        self.combinations = sorted(counts)
        self.weights = np.array([counts[c] for c in self.combinations], float)
        self.votes = np.array([votes_of(code) for _, code in self.combinations], int).reshape(-1, len(LABELERS))
        self.looks = np.array([looks_of(code) for _, code in self.combinations], int).reshape(-1, len(LOOKS))
        self.kinds = np.array([rank for rank, _ in self.combinations], int)
        self.posterior = self._expectation_maximisation(steps)
        self.coefficients = self._classifier()

    def _expectation_maximisation(self, steps: int) -> np.ndarray:
        """Probability that a span with each combination is personal; labelers err independently of each other, each in its own way for each kind."""
        checked = np.isin(self.kinds, [KINDS.index(kind) for kind in CHECKED])
        known = checked & (self.votes[:, LABELERS.index("pattern")] == NO)
        size = np.array([self.weights[self.kinds == rank].sum() for rank in range(len(KINDS))])
        pseudo = np.maximum(PRIOR_SPANS, PRIOR_SHARE * size)[:, None, None, None] * np.array(PRIOR_RATES)[None, None]
        # kind, labeler, side (no, yes), vote
        rates = np.tile(np.array(PRIOR_RATES), (len(KINDS), len(LABELERS), 1, 1))
        prior = np.full(len(KINDS), 0.5)
        posterior = np.full(len(self.weights), 0.5)
        for _ in range(steps):
            logs = np.log(np.clip(np.stack([1 - prior, prior])[:, self.kinds], 1e-6, 1))
            for labeler in range(len(LABELERS)):
                logs = logs + np.log(rates[self.kinds, labeler, :, self.votes[:, labeler]].T)
            before = posterior
            posterior = np.where(known, 0.0, 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50))))
            sides = np.stack([(1 - posterior) * self.weights, posterior * self.weights])
            counted = np.broadcast_to(pseudo, rates.shape).copy()
            for labeler in range(len(LABELERS)):
                for side in range(2):
                    np.add.at(counted, (self.kinds, labeler, side, self.votes[:, labeler]), sides[side])
            rates = counted / counted.sum(-1, keepdims=True)
            for rank in range(len(KINDS)):
                # the prior share of known negatives says nothing about the others
                own = sides[:, (self.kinds == rank) & ~known].sum(1)
                prior[rank] = (own[1] + 1) / (own.sum() + 2)
            if len(before) == 0 or np.abs(posterior - before).max() < 1e-6:
                break
        #: By kind, labeler, side and vote, and over all kinds.
        self.rates_of_kind, self.rates = rates, np.average(rates, axis=0, weights=size + 1e-9)
        return posterior

    #: Columns of the classifier for the kind, for each labeler's votes on each kind, and for each look.
    WIDTHS = (len(KINDS), *[3 * len(KINDS)] * len(LABELERS), *LOOKS)

    def _features(self) -> np.ndarray:
        one_hot = lambda values, n: (values[:, None] == np.arange(n)).astype(float)
        parts = [one_hot(self.kinds, len(KINDS))]
        parts += [one_hot(self.kinds * 3 + self.votes[:, i], 3 * len(KINDS)) for i in range(len(LABELERS))]
        parts += [one_hot(self.looks[:, i], n) for i, n in enumerate(LOOKS)]
        return np.hstack(parts)

    def _classifier(self, steps: int = 200, penalty: float = 1e-5) -> np.ndarray:
        """Logistic regression of the estimated labels on kind, votes and looks, by Newton steps over all combinations."""
        features = self._features()
        coefficients = np.zeros(features.shape[1])
        if not len(features):
            return coefficients
        # each kind counts as much as any other, however rare it is
        size = np.array([self.weights[self.kinds == rank].sum() for rank in range(len(KINDS))])
        weights = self.weights / size[self.kinds] / (size > 0).sum()
        for _ in range(steps):
            predicted = 1 / (1 + np.exp(-np.clip(features @ coefficients, -50, 50)))
            slope = features.T @ (weights * (predicted - self.posterior)) + penalty * coefficients
            curve = (features * (weights * predicted * (1 - predicted))[:, None]).T @ features
            step = np.linalg.solve(curve + (penalty + 1e-6) * np.eye(len(coefficients)), slope)
            coefficients -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        return coefficients

    def probabilities(self) -> dict[tuple[int, int], float]:
        scores = 1 / (1 + np.exp(-self._features() @ self.coefficients))
        return dict(zip(self.combinations, scores.tolist()))

    def score(self, rank: Column, code: Column) -> Column:
        """The classifier's log odds of a span, as built-in functions."""
        ends = np.cumsum(self.WIDTHS)
        tables = [F.array(*map(F.lit, part.tolist())) for part in np.split(self.coefficients, ends[:-1])]
        digit = lambda value, by, n: F.pmod(F.floor(value / by), F.lit(n)).cast("int")
        total = F.get(tables[0], rank)
        for i in range(len(LABELERS)):
            total += F.get(tables[1 + i], rank * 3 + digit(code, 3**i, 3))
        by = VOTES
        for i, n in reversed(list(enumerate(LOOKS))):
            total += F.get(tables[1 + len(LABELERS) + i], digit(code, by, n))
            by *= n
        return total


SPAN = "struct<start:int,rank:int,end:int,base:boolean,code:int>"


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and the candidate spans of each row; written once."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "rank", "end", "base", "code")
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32())
        for batch in batches:
            each = [spans_of(text) for text in batch.column("text").to_pylist()]
            flat = [span for spans in each for span in spans]
            columns = [pa.array([span[i] for span in flat], kind) for i, kind in enumerate(kinds)]
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(spans) for spans in each]))), pa.int32())
            spans = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, names))
            yield batch_of({"doc_id": (batch.column("doc_id"), pa.int64()), "spans": (spans, None)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stage(map_arrow(rows, judged, f"doc_id long, spans array<{SPAN}>"), "personal-data")


def label_model(found: DataFrame) -> LabelModel:
    """Fitted on the number of spans of each kind with each combination of votes and looks: 8 times 81 times 96 rows at most."""
    spans = found.select(F.explode("spans").alias("s")).groupBy("s.rank", "s.code").count()
    return LabelModel({(row["rank"], row["code"]): row["count"] for row in spans.collect()})


def find(docs: DataFrame, add_from: float = ADD_FROM) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, base and spans (start, rank, end, kind).

    base: spans of the base kinds that pass their rules, in order; spans: those and further ones that the classifier gives
    ``add_from`` or more and that overlap no base span. A null text is empty. Repeated rows have equal
    results; other columns are ignored; no rows give no rows.
    """
    found = candidates(docs)
    model = label_model(found)
    odds = float(np.log(add_from / (1 - add_from)))
    base = F.filter("spans", lambda s: s["base"])
    further = F.filter("spans", lambda s: ~s["base"] & (model.score(s["rank"], s["code"]) >= F.lit(odds)))
    apart = F.filter("further", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    kinds = F.array(*(F.lit(kind) for kind in KINDS))

    def named(spans):
        return F.transform(
            F.array_sort(spans),
            lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), F.get(kinds, s["rank"]).alias("kind")),
        )

    split = found.select("doc_id", base.alias("base"), further.alias("further"))
    return split.select("doc_id", named("base").alias("base"), named(F.concat("base", apart)).alias("spans"))
