"""Main text of web pages by the maximum-scoring run of words and tags."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from meterlake.llm.common import fresh

LABELLED_PAGES = 2000

# Names of HTML elements and of the parts that are no article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math title textarea select head".split())
INLINE = frozenset(
    "a abbr b bdi bdo br cite code data dfn em font i img kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# Elements that have a weight of their own; other names share one.
KNOWN = VOID | RAW | INLINE | frozenset(
    "address article aside audio blockquote body button canvas caption center colgroup datalist dd "
    "details dialog div dl dt fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 "
    "h6 header hgroup html legend li main map menu meter nav object ol optgroup option output p "
    "picture pre progress rp rt ruby section summary table tbody td tfoot th thead tr ul "
    "video".split()
)
APART = frozenset("nav aside footer form menu dialog button fieldset".split())
LABELS = frozenset(("article", "main"))
# Of the elements that are set apart, these may also hold a whole page.
WRAPPERS = frozenset("form fieldset dialog header".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo promotion sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent "
    "notice alert popup modal overlay subscribe subscription newsletter signup share sharing "
    "social related recommended recommendations comment comments discussion disqus reply replies "
    "respond login search widget pagination pager toolbar skip gdpr".split()
)

# Words that say where or in what form, beside one of the above.
PLACE_WORDS = frozenset(
    "area bar block bottom box button buttons center col column container content desktop fixed "
    "float floating footer form global group head header heading icon icons inline inner item items "
    "label left link links list lower main mobile outer page panel post posts primary right row "
    "secondary section site slot small sticky strip tab text title top unit upper wrap wrapper "
    "zone".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<[!?][^<>]*>"
    r"""|<(/?)([A-Za-z][^\s/<>]*)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+|[^<>]*+)>""",
    re.DOTALL,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"\w+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
# A class like has-sidebar or no-comments says what a page has, not what the element is.
_STATE = re.compile(r"(?<![\w-])(?:has|no|with|without|hide|show|is)[-_][\w-]*", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Item:
    """A tag, or the text between two. `key` is what its weight depends on."""

    key: str
    text: str = ""
    words: int = 0
    breaks: bool = False
    apart: bool = False
    labelled: bool = False


@dataclass
class _Open:
    """An open element; `mark` and `core` are the innermost ones it is in, or -1, and
    `block` is the place of the innermost open element that is no inline one.
    """

    name: str
    mark: int = -1
    core: int = -1
    block: int = -1


class _Stack:
    """Open elements, and for each name the places where it is open, the last one last."""

    def __init__(self) -> None:
        self.open: list[_Open] = []
        self.places: dict[str, list[int]] = {}

    def top(self) -> _Open:
        return self.open[-1] if self.open else _Open("")

    def last(self, name: str) -> int:
        at = self.places.get(name)
        return at[-1] if at else -1

    def push(self, element: _Open) -> None:
        element.block = self.top().block if element.name in INLINE else len(self.open)
        self.places.setdefault(element.name, []).append(len(self.open))
        self.open.append(element)

    def close(self, place: int) -> None:
        """Close the element at a place and all within it."""
        while len(self.open) > place:
            self.places[self.open.pop().name].pop()

    def block(self) -> str:
        at = self.top().block
        return self.open[at].name if at >= 0 else ""


@dataclass
class _Mark:
    """An element that may be set apart, within mark `outer` and core `core`."""

    outer: int
    core: int
    wrapper: bool
    words: int = 0
    opened: bool = False


@dataclass
class _Core:
    """An article or main element within no other, and the mark it is in."""

    mark: int
    named: bool
    words: int = 0


@dataclass
class PageModel:
    """Weight of a word or tag by key; others have the weight of their sort.

    What is set apart is cut out of any run, so it costs a run nothing to go on beyond it.
    """

    weights: dict[str, float] = field(default_factory=dict)
    word: float = 1.0
    tag: float = -0.5
    # Least weights within an article or main element, where all words are as if labelled.
    inner_word: float = 0.5
    inner_tag: float = -0.05

    def of(self, item: Item) -> float:
        if item.apart or not item.key:
            return 0.0
        if item.words:
            weight = self.weights.get(item.key, self.word)
            return item.words * (max(weight, self.inner_word) if item.labelled else weight)
        weight = self.weights.get(item.key, self.tag)
        return max(weight, self.inner_tag) if item.labelled else weight


def _names_aside(attributes: str) -> bool:
    """Whether a class, id or role names a part that is no article text: one of its names
    is made of words for such a part, and of words for places and forms beside them. A
    name that says something else as well, like social-studies, is no such name.
    """
    for found in _NAMES.finditer(attributes):
        value = next(x for x in found.groups() if x is not None)
        for name in _STATE.sub(" ", value).split():
            parts = {part.lower() for part in _PARTS.findall(name) if len(part) > 1}
            if parts & ASIDE_WORDS and parts <= ASIDE_WORDS | PLACE_WORDS:
                return True
    return False


def _open_wrappers(marks: list[_Mark], cores: list[_Core], words: int) -> None:
    """Note which of the marked elements are not set apart, as they hold the page.

    `marks` and `cores` come with the words directly in them. Opened are those around
    the page's core, which is the longest article or main element, one not named as an
    aside rather than one that is; and wrappers with more than half of the words of the
    core they are in or, on a page without cores, of the page.
    """
    for mark in reversed(marks):
        if mark.outer >= 0:
            marks[mark.outer].words += mark.words
    filled = [core for core in cores if core.words]
    if filled:
        at = max(filled, key=lambda c: (not c.named, c.words)).mark
        while at >= 0:
            marks[at].opened = True
            at = marks[at].outer
    for mark in marks:
        if mark.core >= 0:
            scope = cores[mark.core].words
        else:
            scope = 0 if filled else words
        if mark.wrapper and scope and 2 * mark.words > scope:
            mark.opened = True


def read_items(page: str) -> list[Item]:
    """Tags and texts in order, scripts, styles and comments left out.

    What is in a form, an aside and the like, or in an element named as such, is set
    apart, unless that element holds the page (see `_open_wrappers`).

    Unclosed and stray tags are taken as browsers do for the most part: a block closes
    an open paragraph, an end tag closes what is open above its start.
    """
    items: list[Item] = []
    places: list[int] = []
    stack = _Stack()
    marks: list[_Mark] = []
    cores: list[_Core] = []
    endless: set[str] = set()
    total = at = 0

    def put(item: Item, mark: int) -> None:
        items.append(item)
        places.append(mark)

    def text(raw: str) -> None:
        nonlocal total
        words = len(_WORD.findall(raw))
        if not words and not raw.strip():
            if raw and items:
                put(Item("", raw), -1)
            return
        top = stack.top()
        words = max(words, 1)
        total += words
        if top.mark >= 0:
            marks[top.mark].words += words
        if top.core >= 0:
            cores[top.core].words += words
        block = stack.block()
        key = f"w {block if not block or block in KNOWN else '?'}"
        key = f"{key}/a" if stack.last("a") >= 0 else key
        put(Item(key, raw, words, labelled=top.core >= 0), top.mark)

    while found := _TOKEN.search(page, at):
        text(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        top = stack.top()
        if found[1]:
            place = stack.last(name)
            if place >= 0:
                stack.close(place)
            top = stack.top()
        elif name in RAW:
            # once a name has no end tag ahead, it has none further on
            end = None
            if name not in endless:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            else:
                endless.add(name)
                if name in ("script", "style", "textarea", "title"):
                    at = len(page)
            continue
        elif name not in VOID:
            if name not in INLINE and stack.block() == "p":
                stack.close(top.block)
            if name == "li":
                place = stack.last("li")
                if place > max(stack.last("ul"), stack.last("ol")):
                    stack.close(place)
            top = stack.top()
            named = name != "body" and _names_aside(found[3])
            header = name == "header" and top.core < 0
            mark, core = top.mark, top.core
            if name in LABELS:
                if core < 0:
                    core = len(cores)
                    cores.append(_Core(mark, named))
            elif name in APART or header or named:
                mark = len(marks)
                wrapper = name in WRAPPERS or name not in APART
                marks.append(_Mark(top.mark, core, wrapper))
            top = _Open(name, mark, core)
            if not found[3].endswith("/"):
                stack.push(top)
        key = "" if name in LABELS else f"t {name if name in KNOWN else '?'}"
        put(Item(key, " ", 0, name not in INLINE, labelled=top.core >= 0), top.mark)
    text(page[at:])
    _open_wrappers(marks, cores, total)
    apart: list[bool] = []
    for mark in marks:
        apart.append(not mark.opened or (mark.outer >= 0 and apart[mark.outer]))
    for item, place in zip(items, places, strict=True):
        item.apart = place >= 0 and apart[place]
    return items


def best_run(items: list[Item], model: PageModel) -> tuple[int, int]:
    """First and last + 1 of the items with the highest total; the first of equal ones.

    One scan: a run that has fallen to nothing is never worth going on with.
    """
    best, span = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, item in enumerate(items):
        if total <= 0:
            total, start = 0.0, i
        total += model.of(item)
        if total > best + 1e-9:
            best, span = total, (start, i + 1)
    return span


def main_text(page: str | None, model: PageModel) -> str:
    """Text of the best run, by blocks, without the parts set apart within it."""
    items = read_items(page or "")
    first, last = best_run(items, model)
    blocks, block = [], []

    def end() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(block))).strip()
        if text:
            blocks.append(text)
        block.clear()

    for item in items[first:last]:
        if item.breaks:
            end()
        elif not item.apart:
            block.append(item.text)
    end()
    return "\n".join(blocks)


def count_keys(page: str) -> Counter[tuple[str, bool]]:
    """How often each key is inside and outside of a page's labelled part."""
    counts: Counter[tuple[str, bool]] = Counter()
    for item in read_items(page):
        if item.key and not item.apart:
            counts[item.key, item.labelled] += max(item.words, 1)
    return counts


def fit(counts: list[tuple[str, int, int]]) -> PageModel:
    """Weights from (key, inside, outside): words in the log odds of being inside, tags
    by how much rather they are outside, so that none gains."""
    model = PageModel()
    for key, inside, outside in counts:
        odds = math.log((inside + 1) / (outside + 1))
        if key.startswith("w "):
            model.weights[key] = max(-3.0, min(1.0, odds))
        else:
            model.weights[key] = max(-3.0, min(-0.05, odds))
    return model


def train(pages: DataFrame, labelled_pages: int = LABELLED_PAGES) -> PageModel:
    """Fit on about `labelled_pages` of the pages that mark their article.

    Pages with an article or main element are the labelled ones: what is inside of it
    is article text. Which are taken follows from a hash of their content, at a rate
    from their number. The driver receives a count for each element name that HTML has,
    in and out of links. Without labelled pages words and tags have the weights of
    `PageModel`.
    """
    marked = pages.select("html").where(F.col("html").rlike("(?i)<(?:article|main)[\\s>]"))
    n = marked.count()
    if not n:
        return PageModel()
    place = F.pmod(F.xxhash64(F.lit("page"), "html"), F.lit(1 << 30)) / (1 << 30)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter[tuple[str, bool]] = Counter()
            for page in batch.column(0).to_pylist():
                total.update(count_keys(page))
            keys = sorted({key for key, _ in total})
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.string()),
                    pa.array([total[k, True] for k in keys], pa.int64()),
                    pa.array([total[k, False] for k in keys], pa.int64()),
                ],
                names=["key", "inside", "outside"],
            )

    found = (
        marked.where(place < labelled_pages / n)
        .mapInArrow(counted, "key string, inside long, outside long")
        .groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    )
    return fit([tuple(r) for r in found.collect()])


def extract(pages: DataFrame, model: PageModel, keep: list[str]) -> DataFrame:
    """Columns `keep` of `pages` with text, the main text of its column html.

    `keep` has no column text. The whole page is read; null is an empty page. A page
    without words has empty text. Repeated rows get equal answers, an empty table gives
    no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)
    schema = StructType([pages.schema[c] for c in keep]).add("text", StringType())
    names = [f.name for f in schema]

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), shared.value) for page in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string())], names=names
            )

    page = fresh(pages, "page")
    return pages.select(F.col("html").alias(page), *keep).mapInArrow(extracted, schema)
