"""Main text of pages by the maximum-scoring contiguous region.

A linear scan turns a page into blocks of words.  Words score positive and tags negative; the
blocks with the largest sum that follow one another are the content.  Weights are learned from
labelled pages, those that mark their content themselves with ``<article>`` or ``<main>``: that of a
tag is its log-odds outside against inside, that of a name in ``class`` or ``id`` the log-odds of the
blocks that it encloses, and so is that of lying outside the marks of a page.  Words below a name that
weighs ``OUT`` or less score negative and are left out of the region's text; so are those in elements
that the HTML standard has for menus, footers, asides, forms and the like.  A region that touches a
marked element is widened to all of it.

Names that too few labelled pages show go by what they say (``NAMES``); labelled pages' own adverts,
notices and reader comments that lie in the marked element are told by it, too, and count as outside.

Defined cases: a null or empty page, and one without words, has an empty text; unclosed and
stray tags are read as browsers do; pages are read one by one, so null ids, null urls, ties and
repeated rows are no matter; without labelled pages all tags weigh ``PLAIN``; an empty table gives
an empty result; extra columns are ignored.  One page must fit in memory.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import settle

# Fixed values of the HTML standard: elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main"
    " menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
INLINE = frozenset("a abbr b cite code em font i img q s small span strong sub sup u br".split())
#: Elements that end an open element of their own kind.
SIBLING = frozenset("li dt dd tr td th option".split())
MARKED = frozenset(("article", "main"))

BOILERPLATE = frozenset(
    "nav footer aside form button select menu dialog noscript template svg canvas object audio"
    " video map head search".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form"
    " status toolbar".split()
)
#: Names in ``class`` or ``id``.
NAMES = re.compile(
    r"(?:^|[-_])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|notification"
    r"|newsletter|subscribe|subscription|signup|sidebar|menu|nav|navbar|navigation|breadcrumbs?|pagination"
    r"|share|sharing|social|related|recommended|popup|modal|overlay|comments?|disqus|replies|login|search)"
    r"(?:$|[-_])|(?:^|(?:site|page|main|global|top)[-_]?)(?:header|footer|banner|masthead)$",
    re.I,
)
#: Names that say what an element goes with, not what it is.
ABOUT = re.compile(r"^(?:has|with|no|without|is|not)[-_]|^no-?(?:ads?|comments?)$", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

#: Weights of a word, of a word in boilerplate or outside the page's marked elements, of a tag.
WORD, AGAINST, PLAIN = 1.0, -2.0, -0.5
#: A name of this weight or less is boilerplate; no weight is larger than ``MOST``.
OUT, MOST = -2.0, 6.0
#: Blocks that must show a name before it is learned, and names that are, the most frequent first.
SHOWN, LEARNED = 5, 50_000
#: What stands for any block, and for one outside the marks of its page.
ANY, OUTSIDE = "*", "*outside"


class Block:
    """Words that no block element parts, and the names of the elements around it."""

    __slots__ = ("text", "words", "tags", "boilerplate", "marked", "names")

    def __init__(self, text: str, tags: list[str], boilerplate: bool, marked: int, names: list[str]):
        self.text, self.tags, self.boilerplate, self.marked = text, tags, boilerplate, marked
        self.names = names
        self.words = text.count(" ") + 1 if text else 0


def _names(tag: str, attributes: str) -> tuple[list[str], list[str]]:
    """The names that an element has in ``class`` (.name) and ``id`` (#name), and its roles."""
    names, roles = [], []
    if attributes and tag not in ("html", "body", "main"):
        for attribute, *values in ATTRIBUTE.findall(attributes):
            kind = attribute.lower()
            for value in "".join(values).split():
                if kind == "role":
                    roles.append(value.lower())
                else:
                    names.append(("." if kind == "class" else "#") + value)
    return names, roles


def _weight(name: str, weights: dict[str, float]) -> float:
    learned = weights.get(name.lower())
    if learned is not None:
        return learned
    return -MOST if NAMES.search(name[1:]) and not ABOUT.search(name[1:]) else 0.0


def _is_boilerplate(tag: str, names: list[str], roles: list[str], marked: bool, weights: dict) -> bool:
    if tag in BOILERPLATE or tag == "header" and not marked or not ROLES.isdisjoint(roles):
        return True
    return any(_weight(name, weights) <= OUT for name in names)


def blocks(page: str, weights: dict[str, float] | None = None, marks: bool = True) -> list[Block]:
    """The page's blocks in order; ``marked`` numbers the outermost marked element, from 1.

    Without ``marks`` the page's own marks are not looked at.
    """
    weights = weights or {}
    found: list[Block] = []
    text: list[str] = []
    tags: list[str] = []
    stack: list[tuple[str, bool, bool, list[str]]] = []  # tag, boilerplate, marked, names
    around: list[str] = []
    boilerplate = depth = marked = 0

    def flush() -> None:
        nonlocal text, tags
        words = " ".join(unescape("".join(text)).split())
        if words:
            found.append(Block(words, tags, boilerplate > 0, marked if depth else 0, around[:]))
            tags = []
        text = []

    def close(n: int) -> None:
        nonlocal boilerplate, depth
        while len(stack) > n:
            _, ad, content, names = stack.pop()
            del around[len(around) - len(names) :]
            boilerplate -= ad
            depth -= content

    def ended(tag: str, until: frozenset[str]) -> None:
        """Close the nearest open ``tag`` that lies inside all of ``until``."""
        for n in range(len(stack) - 1, -1, -1):
            if stack[n][0] == tag:
                return close(n)
            if stack[n][0] in until:
                return None

    at = 0
    while token := TOKEN.search(page, at):
        if token.start() > at:
            text.append(page[at : token.start()])
        at = token.end()
        closing, tag, attributes = token.groups()
        if tag is None:
            if token[0].startswith("<![CDATA["):
                text.append(token[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        block = tag in BLOCK
        if block:
            flush()
        elif tag == "br":
            text.append(" ")
        tags.append(tag)
        if closing:
            if tag not in VOID:
                # an inline end tag doesn't reach out of its block
                ended(tag, frozenset() if block else BLOCK)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = end.start() if end else len(page) if tag in ("script", "style") else at
        if block:
            ended("p", BLOCK - {"p"})
        if tag in SIBLING:
            ended(tag, frozenset(("ul", "ol", "dl", "table", "tbody", "thead", "select", "menu")))
        if tag in VOID or attributes.endswith("/") and not block:
            continue
        names, roles = _names(tag, attributes)
        ad = _is_boilerplate(tag, names, roles, depth > 0, weights)
        content = marks and tag in MARKED and not ad and not boilerplate
        if content and not depth:
            marked += 1
        stack.append((tag, ad, content, names))
        around += names
        boilerplate += ad
        depth += content
    text.append(page[at:])
    flush()
    return found


def region(found: list[Block], weights: dict[str, float]) -> tuple[int, int]:
    """First and last + 1 of the blocks with the largest sum, widened to marked elements."""
    labelled = any(block.marked for block in found) and weights.get(OUTSIDE, -MOST) <= OUT
    best, span, total, first = 0.0, (0, 0), 0.0, 0
    for n, block in enumerate(found):
        against = block.boilerplate or labelled and not block.marked
        score = block.words * (AGAINST if against else WORD)
        # the tags in front of a block part it from the one before
        total += sum(weights.get(tag, PLAIN) for tag in block.tags)
        if total <= 0:
            total, first = 0.0, n
        total += score
        if total > best:
            best, span = total, (first, n + 1)
    start, stop = span
    touched = {block.marked for block in found[start:stop] if block.marked}
    if touched:
        inside = [n for n, block in enumerate(found) if block.marked in touched]
        start, stop = min(start, inside[0]), max(stop, inside[-1] + 1)
    return start, stop


def main_text(page: str, weights: dict[str, float], marks: bool = True) -> str:
    found = blocks(page, weights, marks)
    start, stop = region(found, weights)
    chosen = found[start:stop]
    if any(block.marked for block in chosen) and weights.get(OUTSIDE, -MOST) <= OUT:
        chosen = [block for block in chosen if block.marked]
    return "\n".join(block.text for block in chosen if not block.boilerplate)


def learn(pages: DataFrame) -> dict[str, float]:
    """The weights of elements and of names, from all labelled pages."""
    known = BLOCK | INLINE

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())  # outside, inside

        def rows() -> pa.RecordBatch:
            outside, inside = counts
            features = sorted(outside.keys() | inside.keys())
            columns = [features, [inside[t] for t in features], [outside[t] for t in features]]
            kinds = (pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["tag", "inside", "outside"]
            )

        for batch in batches:
            for page in batch.column(0):
                found = blocks(page.as_py())
                if any(block.marked for block in found):
                    for block in found:
                        own = counts[bool(block.marked and not block.boilerplate)]
                        own.update(t for t in block.tags if t in known)
                        own.update({name.lower() for name in block.names} | {ANY})
                        if not block.marked:
                            own[OUTSIDE] += 1
            if sum(map(len, counts)) > 200_000:
                yield rows()
                for own in counts:
                    own.clear()
        yield rows()

    sums = (
        pages.select(F.coalesce("html", F.lit("")))
        .mapInArrow(counted, "tag string, inside long, outside long")
        .groupBy("tag")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    )
    sums = settle(sums, "weights")  # read twice, counted once
    of_name = F.col("tag").rlike(r"^[.#]")
    names = sums.where(of_name & (F.col("inside") + F.col("outside") >= SHOWN))
    names = names.orderBy(F.desc(F.col("inside") + F.col("outside")), "tag").limit(LEARNED)
    ratio = {r["tag"]: log((r["outside"] + 1) / (r["inside"] + 1)) for r in sums.where(~of_name).collect()}
    base = ratio.pop(ANY, 0.0)
    weights = {OUTSIDE: base - ratio.pop(OUTSIDE)} if OUTSIDE in ratio else {}
    weights |= {tag: -min(max(odds, 0.02), MOST) for tag, odds in ratio.items()}
    for r in names.collect() if ratio else []:
        weights[r["tag"]] = base - log((r["outside"] + 1) / (r["inside"] + 1))
    return {name: min(max(w, -MOST), MOST) for name, w in weights.items()}


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``."""
    weights = learn(pages) if weights is None else weights

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), weights) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array(list(map(len, texts)), pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")))
    return rows.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
