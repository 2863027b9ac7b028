"""Main text of web pages by tag-path ratios.

Text is aggregated by the path of tags from the root to the block that holds it: characters, punctuation marks and nodes. Characters and
marks a node are smoothed along the page and fused into one score; paths over a threshold taken from the
spread of the scores are content. The result is their text and that of the smallest element that holds nine tenths of it, without what is
no article by its element or name.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import batch_of, map_arrow

# Elements of HTML by what they mean for the text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe object svg math textarea title xmp noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr br img".split()
)
NEVER = set("head nav header footer aside form button select option fieldset dialog menu menuitem datalist audio video canvas map".split())
ARTICLE = set("article main".split())
#: An element of the key is ended by the start of one of the values.
ENDED_BY = {
    "p": set(
        "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
        "header hr main menu nav ol p pre section table ul".split()
    ),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    **{f"h{i}": {f"h{j}" for j in range(1, 7)} for i in range(1, 7)},
}
#: Where the search for an element to end stops.
SCOPE = set("html body table ul ol dl select div section article main aside nav header footer form td th blockquote".split())
#: Parts of a page that are not the article, as words of class, id or role. These are left out wherever they stand ...
CLUTTER = (
    r"ads?|adverts?|advertis\w*|sponsor\w*|promo\w*|banner|side-?bar|breadcrumbs?|comments?|respond|replies|disqus|cookies?|consent|gdpr|notices?|"
    r"pop-?up|modal|overlay|newsletter|subscri\w*|sign-?up|log-?in|share|sharing|related|recommend\w*|widget|pagination|pager|"
    r"complementary|navigation|contentinfo"
)
#: ... and these outside an article only, as an article may be about them.
FURNITURE = r"rail|menu|nav\w*|foot(?:er)?|masthead|site-?header|page-?header|header|alert|social|toolbar|search|copyright|legal"
#: In an article a word counts alone, or before one of these; elsewhere also within a longer name that does not speak of the article.
PARTS = r"area|bars?|blocks?|box|buttons?|container|content|form|inner|items?|lists?|links|panel|posts?|row|section|slot|thread|units?|widgets?|wrap(?:per)?"
IN_ARTICLE = re.compile(rf"(?<!\S)(?:{CLUTTER})(?:[_-](?:{PARTS}))*(?!\S)", re.I)
ELSEWHERE = re.compile(rf"(?<!\S)(?!(?:article|content|entry|main|post|story)[_-])(?:\S*[_-])?(?:{CLUTTER}|{FURNITURE})(?=[\s_-]|\Z)", re.I)
#: The elements that a start tag ends.
ENDS: dict[str, list[str]] = {}
for _ended, _starts in ENDED_BY.items():
    for _start in _starts:
        ENDS.setdefault(_start, []).append(_ended)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？·«»\"“”„()'’]")

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S
)
#: One attribute after another; what stands in the value of one is no attribute.
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>]+)))?|[\"']")

HEADING = re.compile(r"h[1-3](\.|\Z)")

#: Blocks before and after that a ratio is smoothed over, with weights of a bell curve.
RADIUS = 2
#: How much weight the score of text in an element for articles has.
ARTICLE_WEIGHT = 4.0
#: Share of its characters in links from which a path is a list of links.
LINK_SHARE = 0.6


class Paths:
    """Tag paths as numbers: each has a parent, with a lower number, and the name of its last tag. 0 is the empty path."""

    def __init__(self):
        self.parent, self.name, self._known = [0], [""], {}

    def below(self, parent: int, name: str) -> int:
        found = self._known.get((parent, name))
        if found is None:
            found = self._known[parent, name] = len(self.parent)
            self.parent.append(parent)
            self.name.append(name)
        return found


@dataclass
class Block:
    """Text between two boundaries of block elements."""

    path: int
    text: str
    linked: int
    article: bool


@dataclass
class _Open:
    tag: str
    path: int
    never: bool
    article: bool
    link: bool


class _Stack:
    """Open elements, with the places of each tag and of those that limit the search for an element to end."""

    def __init__(self):
        self.open = [_Open("", 0, False, False, False)]
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.scopes = [0]

    def push(self, element: _Open) -> None:
        self.places[element.tag].append(len(self.open))
        if element.tag in SCOPE:
            self.scopes.append(len(self.open))
        self.open.append(element)

    def cut(self, depth: int) -> bool:
        """Ends all elements from ``depth`` on; whether a block is among them."""
        blocks = False
        while len(self.open) > depth:
            tag = self.open.pop().tag
            self.places[tag].pop()
            if tag in SCOPE:
                self.scopes.pop()
            blocks |= tag not in INLINE
        return blocks

    def ended_by(self, tag: str) -> int:
        """Place of the innermost element that the start of ``tag`` ends, 0 if there is none in scope."""
        places = [self.places[ended][-1] for ended in ENDS.get(tag, ()) if self.places[ended]]
        return max((place for place in places if place >= self.scopes[-1]), default=0)


def _opened(tag: str, attributes: str, above: _Open, paths: Paths) -> _Open:
    names, hidden = [], False
    if attributes:
        for match in _ATTRIBUTE.finditer(attributes):
            key, value = (match[1] or "").lower(), match[2] or match[3] or match[4] or ""
            if key == "style":
                hidden |= "display:none" in value.replace(" ", "").lower()
            elif key in ("hidden", "aria-hidden"):
                hidden |= value.lower() != "false"
            elif key in ("class", "id", "role") and value:
                names.append(value)
    named = " ".join(names)
    whole = tag in ("html", "body") or tag in ARTICLE
    header = tag == "header" and above.article  # of the article, not of the page
    words = IN_ARTICLE if above.article else ELSEWHERE
    never = above.never or hidden or tag in NEVER and not header or bool(named and not whole and words.search(named))
    path = above.path if tag in INLINE else paths.below(above.path, f"{tag}.{named}" if named else tag)
    return _Open(tag, path, never, above.article or tag in ARTICLE, above.link or tag == "a")


def blocks_of(page: str) -> tuple[list[Block], Paths]:
    """Blocks of text in page order, without those that are no article by their element or name, and their paths."""
    paths, stack = Paths(), _Stack()
    found, parts, linked = [], [], 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            found.append(Block(stack.open[-1].path, text, linked, stack.open[-1].article))
        parts.clear()
        linked = 0

    def text(raw: str) -> None:
        nonlocal linked
        if raw and not stack.open[-1].never:
            decoded = html.unescape(raw)
            parts.append(decoded)
            if stack.open[-1].link:
                linked += len(decoded.strip())

    at = 0
    while True:
        match = _TOKEN.search(page, at)
        if not match:
            text(page[at:])
            break
        text(page[at : match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if stack.places[tag]:
                depth = stack.places[tag][-1]
                if any(x.tag not in INLINE for x in stack.open[depth:]):
                    flush()
                stack.cut(depth)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = at if match[3].rstrip().endswith("/") and tag in ("svg", "math") else end.end() if end else len(page)
            continue
        if tag not in INLINE:
            flush()
            depth = stack.ended_by(tag)
            if depth:
                stack.cut(depth)
        elif tag == "br":
            parts.append("\n")
        if tag not in VOID:
            stack.push(_opened(tag, match[3], stack.open[-1], paths))
    flush()
    return found, paths


def _smoothed(values: np.ndarray) -> np.ndarray:
    weights = np.exp(-np.arange(-RADIUS, RADIUS + 1) ** 2 / 2.0)
    padded = np.pad(values, RADIUS, mode="edge")
    return np.convolve(padded, weights / weights.sum(), mode="valid")


def content_of(blocks: list[Block], paths: Paths) -> list[Block]:
    """The blocks that are content."""
    if not blocks:
        return []
    chars, marks, nodes, links = (defaultdict(float) for _ in range(4))
    for block in blocks:
        chars[block.path] += len(block.text)
        marks[block.path] += len(PUNCTUATION.findall(block.text))
        nodes[block.path] += 1
        links[block.path] += block.linked
    in_article = {block.path for block in blocks if block.article}
    # a list of links is a menu, unless it stands in an article
    lists = {path for path in chars if links[path] > LINK_SHARE * chars[path] and path not in in_article}
    text_ratio = _smoothed(np.array([chars[b.path] / nodes[b.path] for b in blocks]))
    mark_ratio = _smoothed(np.array([marks[b.path] / nodes[b.path] for b in blocks]))
    prior = np.array([0.0 if b.path in lists else ARTICLE_WEIGHT if b.article else 1.0 for b in blocks])
    fused = text_ratio * (1 + mark_ratio) * prior
    score: defaultdict[int, list[float]] = defaultdict(list)
    for block, value in zip(blocks, fused):
        score[block.path].append(value)
    means = {path: float(np.mean(values)) for path, values in score.items()}
    limit = min(0.8 * float(np.std(fused)), max(means.values()))
    chosen = {path for path, mean in means.items() if mean >= limit and path not in lists} or set(means) - lists
    total = sum(chars[path] for path in chosen)
    held = [0.0] * len(paths.parent)
    heaviest: dict[int, int] = {}
    for path in chosen:
        held[path] += chars[path]
    for path in range(len(held) - 1, 0, -1):  # from the leaves up
        parent = paths.parent[path]
        if held[path] and held[path] >= held[heaviest.get(parent, path)]:
            heaviest[parent] = path
        held[parent] += held[path]
    within = 0
    # down to the smallest element with nine tenths of the chosen text
    while (best := heaviest.get(within)) is not None and held[best] >= 0.9 * total and best not in chosen:
        within = best
    inside = [False] * len(held)
    for path in range(len(held)):
        inside[path] = path == within or (path > 0 and inside[paths.parent[path]])
    # what the paths chose stays, also outside that element, which only adds blocks: of an article all, else those between chosen ones, as
    # other elements may have its path
    places = [i for i, b in enumerate(blocks) if b.path in chosen]
    first, last = (places[0], places[-1]) if places else (0, -1)
    added = (i for i, b in enumerate(blocks) if inside[b.path] and b.path not in lists and (b.article or first <= i <= last))
    kept = {*places, *added}
    for first in sorted(kept):  # the headings right before the content belong to it
        while first and HEADING.match(paths.name[blocks[first - 1].path]) and blocks[first - 1].path not in lists:
            first -= 1
            kept.add(first)
    return [blocks[i] for i in sorted(kept)]


def main_text(page: str | None) -> str:
    """Main text of one page; empty if there is none."""
    return " ".join(block.text for block in content_of(*blocks_of(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """For each row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Null and empty html give an empty text. Pages that end inside a tag, element or reference are read as far as they go. Repeated
    rows and null ids have results of their own; other columns are ignored; no rows give no rows. Each page is
    read alone, so nothing is shuffled.
    """

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield batch_of({
                "page_id": (batch.column("page_id"), pa.int64()), "url": (batch.column("url"), pa.string()),
                "text": (texts, pa.string()), "n_chars": ([len(text) for text in texts], pa.int64()),
            })

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return map_arrow(rows, extracted, "page_id long, url string, text string, n_chars long")
