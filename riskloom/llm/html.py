"""Main text of web pages by minimum-cut labelling.

A page is parsed into blocks of text. A classifier's log odds that a block is content become its capacities to
the terminals; neighbouring blocks, and blocks with the same parent, are joined by smoothness edges that weigh
less the farther apart the blocks are in the tree. The minimum cut separates content from boilerplate.

The classifier is a logistic regression on what a block looks like (length, links, punctuation, place,
neighbours), on how much of the page's text its parent holds, and on what its containers say: in an article, in
an element of boilerplate, outside of a page's article, below a class name that hints. None of these is a verdict.
It is trained here, without labels given: in a bounded sample of about ``PAGES`` pages, blocks in an article are
content and blocks in menus, footers and the like, or outside of a page's article, are not. Each page is learned twice, once as it is and once as
if its containers said nothing, so pages of plain ``div`` are told by their looks. Weights are drawn to ``PRIOR``,
which stands alone where a sample has not both kinds.

A hint counts if it is a whole class token, teaches nothing, and ends at a <main> or <article> below it (at an
<article> only if the hint is of no thread or list of other texts). Only scripts, styles, titles and text areas
are never text; hidden elements, formulas and what stands for scripts and frames are text like any other.

Defined cases: a null or empty page, and one without content, has an empty text; tags that are cut off at
the end, unclosed or closed twice are tolerated; repeated rows each have a result; an empty table gives
no rows, and a sample without both kinds of blocks leaves ``PRIOR``.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import free_name, slices
from riskloom.llm.mincut import label

PAGES, BLOCKS_OF_A_PAGE, STEPS, PENALTY = 2000, 60, 400, 1e-3
#: Smoothness of neighbours and of siblings, in log odds; capacities are whole numbers of this part of one.
NEAR, SIBLING, UNIT = 0.3, 1.0, 1000
#: What the looks may say at most, whatever the sample: long texts in odd places would outweigh everything.
MOST = 4.0
#: Measures of a block: ten looks with a constant, three of its family, then what containers say.
LOOKS, FAMILY = 10, 3
SAYS = ("article", "boilerplate", "outside", "hinted")
PRIOR = np.array([0.0] * (LOOKS + FAMILY) + [4.0, -7.0, -3.0, -8.0])

# Element names of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol optgroup option p pre section select summary"
    " table tbody td template textarea tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title".split())
PARAGRAPH_TAGS = frozenset("dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
BOILERPLATE_TAGS = frozenset("aside dialog footer form head menu nav option select".split())
ARTICLE_TAGS = frozenset(("article", "main"))
#: A start tag of the first kind closes an open element of the second, unless one of the third is between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
#: Class names and ids of what is no article, alone or joined to one another or to a place; those of threads and of lists of other texts.
_LAYOUT = "ads?|adverts?|advertisement|banner|breadcrumbs?|consent|cookies?|footer|menu|modal|nav|navbar|navigation|newsletter|notices?|popup|share|sharing|sidebar|skip|social|subscribe|widget"
_THREAD = "comments?|disqus|promo|related|replies|reply|respond|sponsored"
HINTS = re.compile(rf"(?:(?:site|main|primary|secondary|top|bottom)[_-])?(?:{_LAYOUT}|{_THREAD})(?:[_-](?:{_LAYOUT}|{_THREAD}))*", re.I)
THREADS = re.compile(rf"(?:^|[_-])(?:{_THREAD})(?:$|[_-])", re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|<[/a-zA-Z!?][^>]*\Z", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())


@dataclass
class Block:
    text: str
    linked: int
    depth: int
    parent: int
    #: Steps in the tree from the block before.
    far: int
    article: bool
    boilerplate: bool
    hinted: bool = False


@dataclass
class _Open:
    """Open elements and the text that has come since the last boundary of a block."""

    tags: list[str] = field(default_factory=list)
    ids: list[int] = field(default_factory=list)
    article: list[bool] = field(default_factory=list)
    boilerplate: list[bool] = field(default_factory=list)
    #: 0, or 1 below a class that hints at boilerplate, 2 at a thread or a list of other texts.
    hint: list[int] = field(default_factory=list)
    count: int = 0

    def push(self, tag: str, attributes: str) -> None:
        self.count += 1
        self.tags.append(tag)
        self.ids.append(self.count)
        before = self.boilerplate[-1] if self.boilerplate else False
        inside = self.article[-1] if self.article else False
        hint = self.hint[-1] if self.hint else 0
        if tag == "main" or (tag == "article" and hint == 1 and "article" not in self.tags[:-1]):
            hint = 0
        says = bool(attributes) and tag not in ("html", "body")
        self.article.append(inside or tag in ARTICLE_TAGS)
        self.boilerplate.append(before or tag in BOILERPLATE_TAGS or (tag == "header" and not inside) or (says and _told(attributes)))
        self.hint.append(max(hint, _hint(attributes)) if says else hint)

    def pop_to(self, k: int) -> None:
        for x in (self.tags, self.ids, self.article, self.boilerplate, self.hint):
            del x[k:]


def _told(attributes: str) -> bool:
    """Does an element's role say that it is boilerplate?"""
    return any(name.lower() == "role" and value.strip("\"'").lower() in _ROLES for name, value in _ATTRIBUTE.findall(attributes))


def _hint(attributes: str) -> int:
    """Do an element's class or id hint at boilerplate (1), or at a thread or a list of other texts (2)?"""
    found = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for token in value.strip("\"'").split():
                if HINTS.fullmatch(token):
                    found = max(found, 2 if THREADS.search(token) else 1)
    return found


def parse(page: str) -> list[Block]:
    blocks: list[Block] = []
    now = _Open()
    said: list[str] = []
    linked, in_link, low = 0, 0, 0
    at = 0

    def close() -> None:
        """The text so far is a block."""
        nonlocal linked, low
        text = " ".join(entities.unescape("".join(said)).split())
        if text:
            depth = len(now.tags)
            low_now = min(low, depth)
            far = (blocks[-1].depth - low_now) + (depth - low_now) if blocks else depth
            up = 2 if now.tags and now.tags[-1] in PARAGRAPH_TAGS else 1  # what holds this block and the next
            blocks.append(Block(text, linked, depth, now.ids[-up] if len(now.ids) >= up else 0, far, bool(now.article and now.article[-1]), bool(now.boilerplate and now.boilerplate[-1]), bool(now.hint and now.hint[-1])))
            low = depth
        said.clear()
        linked = 0

    def hear(text: str) -> None:
        nonlocal linked
        if text:
            said.append(text)
            linked += len(text) if in_link else 0

    while m := _MARK.search(page, at):
        hear(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0][:2] in ("<!", "<?", "</") or at == len(page):
                continue
        closing, tag, attributes = m[1], m[2].lower(), m[3]
        if tag == "a":
            in_link = 0 if closing else 1
        elif tag == "br":
            hear(" ")
        elif tag in RAW_TAGS and not closing:
            if tag in BLOCK_TAGS:
                close()
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at) if not attributes.endswith("/") else None
            if end or tag in ("script", "style"):
                at = end.end() if end else len(page)
        elif tag in BLOCK_TAGS:
            close()
            if closing:
                for k in range(len(now.tags) - 1, -1, -1):
                    if now.tags[k] == tag:
                        now.pop_to(k)
                        break
                low = min(low, len(now.tags))
            else:
                in_link = 0
                closes, stops = CLOSES.get(tag, ({"p"}, {"td", "th", "li", "button", "table", "div", "article", "section", "blockquote"}))
                for k in range(len(now.tags) - 1, -1, -1):
                    if now.tags[k] in closes:
                        now.pop_to(k)
                        break
                    if now.tags[k] in stops:
                        break
                low = min(low, len(now.tags))
                if tag not in VOID_TAGS:
                    now.push(tag, attributes)
    hear(page[at:])
    close()
    return blocks


def looks(blocks: list[Block]) -> np.ndarray:
    """What a block's text looks like, and what its parent holds."""
    n = len(blocks)
    rows = np.zeros((n, LOOKS + FAMILY))
    size_of: dict[int, int] = {}
    linked_of: dict[int, int] = {}
    count_of: dict[int, int] = {}
    for k, b in enumerate(blocks):
        t, size = b.text, len(b.text)
        rows[k, :7] = (
            np.log1p(size), min(b.linked / size, 1.0), t[-1] in ".!?…\"'", (t.count(".") + t.count(",")) / (1 + t.count(" ")),
            sum(c.isdigit() for c in t[:200]) / min(size, 200), "©" in t or "|" in t, k / n,
        )
        size_of[b.parent] = size_of.get(b.parent, 0) + size
        linked_of[b.parent] = linked_of.get(b.parent, 0) + min(b.linked, size)
        count_of[b.parent] = count_of.get(b.parent, 0) + 1
    rows[1:, 7] = rows[:-1, 0]
    rows[:-1, 8] = rows[1:, 0]
    rows[:, 9] = 1
    whole = sum(size_of.values())
    for k, b in enumerate(blocks):
        rows[k, LOOKS:] = size_of[b.parent] / whole, linked_of[b.parent] / size_of[b.parent], np.log1p(count_of[b.parent])
    return rows


def says(blocks: list[Block]) -> np.ndarray:
    """What containers say of each block."""
    some = any(b.article for b in blocks)
    return np.array([(b.article and not b.boilerplate, b.boilerplate, some and not b.article, b.hinted and not b.boilerplate) for b in blocks], float).reshape(-1, len(SAYS))


def odds(blocks: list[Block], weights: np.ndarray) -> np.ndarray:
    """The classifier's log odds of content."""
    seen = np.clip(looks(blocks) @ weights[: LOOKS + FAMILY], -MOST, MOST)
    return seen + says(blocks) @ weights[LOOKS + FAMILY :]


def leans(blocks: list[Block], weights: np.ndarray) -> list[int]:
    """Log odds of content, in units of 1/1000."""
    return np.rint(odds(blocks, weights) * UNIT).astype(int).tolist()


def edges(blocks: list[Block]) -> list[tuple[int, int, int]]:
    out = [(k - 1, k, round(UNIT * NEAR / (1 + b.far))) for k, b in enumerate(blocks) if k]
    last: dict[int, int] = {}
    for k, b in enumerate(blocks):
        if b.parent in last:
            out.append((last[b.parent], k, round(UNIT * SIBLING)))
        last[b.parent] = k
    return out


def labels(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    return label(leans(blocks, weights), edges(blocks))


def extract(page: str, weights: np.ndarray) -> str:
    blocks = parse(page)
    return "\n".join(b.text for b, kept in zip(blocks, labels(blocks, weights), strict=True) if kept)


def fit(df: DataFrame, key: str = "url", html: str = "html", pages: int = PAGES) -> np.ndarray:
    """The classifier's weights, from about ``pages`` pages drawn by hash of their key and text."""
    n = df.count()
    drawn = F.pmod(F.xxhash64(F.lit("page"), F.col(key).cast("string"), F.col(html)), F.lit(1 << 30)) / float(1 << 30)
    rows = df.select(key, html).where(drawn < min(1.0, pages / max(n, 1)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            seen, content = [], []
            for page in part.column(1).to_pylist():
                x, y = examples(parse(page or ""))
                seen += x.tolist()
                content += y.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.list_(pa.float64())), pa.array(content, pa.bool_())], names=["x", "y"])

    # A page that is there many times is one; the bound holds however the copies are drawn.
    held = rows.dropDuplicates([html]).orderBy(F.xxhash64(F.lit("order"), html)).limit(2 * pages).mapInArrow(run, "x array<double>, y boolean").toArrow()
    if not held.num_rows:
        return PRIOR
    return train(np.array(held["x"].to_pylist()), held["y"].to_numpy().astype(float))


def examples(blocks: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """(measures, content or not) of blocks whose containers tell, at most about ``BLOCKS_OF_A_PAGE``."""
    some = any(b.article for b in blocks)
    told = [k for k, b in enumerate(blocks) if b.boilerplate or (b.article and not b.hinted) or (some and not b.article)]
    told = told[:: max(1, len(told) // BLOCKS_OF_A_PAGE)]  # spread over the page
    if not told:
        return np.zeros((0, len(PRIOR))), np.zeros(0, bool)
    table = np.concatenate([looks(blocks), says(blocks)], axis=1)[told]
    return table, np.array([blocks[k].article and not blocks[k].boilerplate for k in told])


def train(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by logistic regression, drawn to ``PRIOR``; each example also as if containers said nothing."""
    if not len(y) or y.min() == y.max():
        return PRIOR
    order = np.lexsort((*x.T, y))  # rows come in no fixed order
    x, y = x[order], y[order]
    plain = x.copy()
    plain[:, LOOKS + FAMILY :] = 0.0
    x, y = np.concatenate([x, plain]), np.concatenate([y, y])
    spread = x.std(axis=0) + 1e-9
    spread[[9, *range(LOOKS + FAMILY, len(PRIOR))]] = 1
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    prior = PRIOR * spread
    w = prior.copy()
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x / spread @ w, -50, 50)))
        w -= 0.5 * ((x / spread * (weight * (p - y))[:, None]).mean(axis=0) + PENALTY * (w - prior))
    return w / spread


def extract_all(df: DataFrame, weights: np.ndarray, html: str = "html") -> tuple[DataFrame, str]:
    """The rows of ``df`` and the name of the new column with the main text."""
    at, name = df.columns.index(html), free_name(df, "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            texts = [extract(x or "", weights) for x in part.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, name])

    return df.mapInArrow(run, df.select("*", F.lit("").alias(name)).schema), name
