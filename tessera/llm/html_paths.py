"""Main-text extraction by tag-path ratios.

A page is read into blocks of text, each with the path of elements from the root to the block
element that holds it. Per path, text length and punctuation are aggregated over its blocks; each
block's ratio (of its path, less what is link text) is smoothed with its neighbours in page order;
the smoothed ratios are fused per path with what the path's elements hint at, and the paths above a
share of the page's mean are content. Whole paths are selected, so that short paragraphs stay with
the long ones around them.

What elements, roles and classes say (a menu, a footer, a sidebar, reader comments) is a weight of the
path, not a filter ahead of it: a page whose whole text stands in a form or in ``class='sidebar'``
keeps it, as paths are measured against each other. Inside an article or main region, which is
scored together, a path without such a hint always goes with its region (lists, tables, links and
all), and one whose class hints at boilerplate stays if its own ratio is high. Only what is no text
of the page at all (scripts, styles, the head, controls, embedded media) is left out in reading.

Character references are decoded, white space inside a block becomes one space (``br`` too), and
blocks are joined by newlines in page order. Nothing is dropped for its length or place. Time is
linear in the length of the page, whatever its markup.

Results in special cases: null, empty and textless html give an empty text; html without elements
is one block; unclosed and stray tags are read as browsers do for paragraphs, items and cells;
unclosed comments, scripts and styles end with the page; repeated rows are each in the result; an
empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as references
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import in_slices, small_batches

#: A path is content if its fused ratio reaches this share of the page's mean, weighted by text length.
THRESHOLD = 0.2
#: What a path inside an article or main region counts for, against others.
REGION = 8.0
#: Weights of a block and its neighbours in page order.
SMOOTHING = (0.1, 0.2, 0.4, 0.2, 0.1)

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is raw text, and all whose content is no text of the page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NO_TEXT = RAW | frozenset("head noscript template button select datalist svg canvas object audio video".split())
#: Weights of elements by what they hint at, and of classes inside and outside of regions.
TAGS = {"nav": 0.005, "header": 0.005, "footer": 0.005, "aside": 0.005, "menu": 0.005, "dialog": 0.005, "form": 0.05, "label": 0.05, "fieldset": 0.05}
STRONG, CLASS, CLASS_IN_REGION = 0.005, 0.01, 0.3
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar tablist toolbar".split())
#: Words of classes and ids that hint at boilerplate, and those that do so strongly, on an article too.
NAMES = frozenset(
    "adsense adslot advertising adverts banner breadcrumb breadcrumbs consent cookie cookies copyright disclaimer dropdown footer form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promotion respond search share sharing sidebar signup skip social sponsor subscribe subscription toolbar topbar widget widgets".split()
)
ON_ARTICLES = frozenset("ad ads advert advertisement comment comments commentlist disqus promo related reply sponsored teaser".split())
#: Words that make a class or id say what an element has or may do, not what it is.
STATES = frozenset("has with without no enabled disabled".split())
REGIONS = frozenset(("article", "main"))
#: Open elements that a start tag closes, up to the elements that bound them.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}), "body": ({"head"}, set()),
}
_CLOSES_P = BLOCKS - {"body", "head", "html", "title", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend"}

_COMMENT = r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>"
_QUOTED = re.compile(rf"""{_COMMENT}|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_PLAIN = re.compile(rf"{_COMMENT}|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>[^>]*)>", re.S)
#: Tags with a quote that nothing closes, before quotes are no longer looked at in a page.
_UNCLOSED = 32
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_PUNCTUATION = re.compile(r"[.,;:!?…。、！？]")
_LEADING_ZEROS = re.compile(r"&#([xX]?)0+(?=[0-9a-fA-F])")
_NO_CHARACTER = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")


@dataclass
class Element:
    tag: str
    path: int
    region: int = 0
    hint: float = 1.0
    marked: bool = False  # inside of adverts or comments
    out: bool = False
    link: bool = False


@dataclass
class Block:
    path: int
    region: int
    hint: float
    parts: list[str] = field(default_factory=list)
    linked: int = 0


def _hint(tag: str, attrs: str, in_region: bool) -> tuple[float, bool, str]:
    """The weight of an element, whether it is marked as advert or comment, and the class as part of the path."""
    weight, marked, label = TAGS.get(tag, 1.0), False, ""
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            words = {w for token in value.split() if not STATES & (own := {w.lower() for w in _WORD.findall(token)}) for w in own}
            label = value if name == "class" else label
            if words & ON_ARTICLES and tag not in ("html", "body"):
                weight, marked = min(weight, STRONG), True
            elif words & NAMES and tag not in ("html", "body", *REGIONS):
                weight = min(weight, CLASS_IN_REGION if in_region else CLASS)
        elif name == "role" and value.strip().lower() in ROLES:
            weight = min(weight, STRONG)
        elif not in_region and (name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))):
            weight = min(weight, STRONG)
    return weight, marked, label


def _is_open(token: str) -> bool:
    """Whether it is a comment that nothing closes."""
    return token.startswith("<!--") and not token.endswith(("-->", "--!>"))


def _tokens(page: str) -> Iterator[re.Match]:
    """Tags, comments and declarations. Nothing is one after the last ``>``, save a comment that nothing closes."""
    at, end, unclosed = 0, page.rfind(">") + 1, 0
    while at < end:
        m = _PLAIN.search(page, at, end)
        if not m:
            break
        if m["tag"] and unclosed < _UNCLOSED and ('"' in m["attrs"] or "'" in m["attrs"]):
            quoted = _QUOTED.match(page, m.start(), end)
            unclosed += quoted is None
            m = quoted or m
        yield m
        if _is_open(m[0]):
            return
        at = m.end()
    if m := re.compile(r"<!--.*", re.S).search(page, max(at, end)):
        yield m


class _Stack:
    """The open elements, with the places of each tag and of blocks, so that no look-up walks through them."""

    def __init__(self) -> None:
        self.elements = [Element("", 0)]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def push(self, element: Element) -> None:
        at = len(self.elements)
        self.places[element.tag].append(at)
        if element.tag in BLOCKS:
            self.blocks.append(at)
        self.elements.append(element)

    def pop(self) -> bool:
        """Close the innermost element; whether it was a block."""
        tag = self.elements.pop().tag
        self.places[tag].pop()
        if tag in BLOCKS:
            self.blocks.pop()
        return tag in BLOCKS

    def close(self, tags: Iterable[str], bounds: Iterable[str] | None) -> bool:
        """Close the innermost of ``tags`` that is open within the bounds (None: any block), and what is open inside it; whether a block closed."""
        last = lambda names: max((self.places[t][-1] for t in names if self.places[t]), default=0)
        at = last(tags)
        if not at or at < (last(bounds) if bounds is not None else self.blocks[-1] if self.blocks else 0):
            return False
        broken = False
        while len(self.elements) > at:
            broken |= self.pop()
        return broken


def blocks_of(page: str) -> list[Block]:
    """The page's blocks of text, in page order."""
    paths: dict[tuple, int] = {}
    path_of = lambda parent, key: paths.setdefault((parent, key), len(paths) + 1)
    stack, found, regions, broken, at = _Stack(), [], 0, True, 0

    def text(raw: str) -> None:
        nonlocal broken
        top = stack.elements[-1]
        if not raw or top.out:
            return
        if broken or not found:
            if not raw.strip():
                return
            found.append(Block(top.path, top.region, top.hint))
            broken = False
        if "&" in raw:
            raw = references.unescape(_NO_CHARACTER.sub("�", _LEADING_ZEROS.sub(r"&#\1", raw)))
        found[-1].parts.append(raw)
        if top.link:
            found[-1].linked += len(raw)

    for m in _tokens(page):
        if m.start() < at:  # inside of raw text
            continue
        text(page[at : m.start()])
        at = len(page) if _is_open(m[0]) else m.end()
        tag = (m.groupdict().get("tag") or "").lower()
        if not tag:
            continue
        if m["end"]:
            broken |= stack.close((tag,), () if tag in BLOCKS else None)
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in _CLOSES_P:
            broken |= stack.close(("p",), ("td", "th", "table", "button", "caption", "object"))
        if tag in _CLOSES:
            for _ in range(2):  # a row closes its cell and the row before it
                broken |= stack.close(*_CLOSES[tag])
        broken |= tag in BLOCKS
        if tag in VOID:
            continue
        top = stack.elements[-1]
        attrs = m["attrs"].strip(" /")
        weight, marked, label = _hint(tag, attrs, top.region > 0) if attrs else (TAGS.get(tag, 1.0), False, "")
        region, hint, marked = top.region, top.hint * weight, top.marked or marked
        if tag in REGIONS and weight == 1 and not marked and hint > STRONG:  # a region's weights start anew
            regions += 1
            region, hint = regions, 1.0
        path = path_of(top.path, (tag, label, weight)) if tag in BLOCKS else top.path
        element = Element(tag, path, region, hint, marked, top.out or tag in NO_TEXT, top.link or tag == "a")
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.push(element)
    text(page[at:])
    return found


def _smooth(values: list[float], groups: list[tuple]) -> list[float]:
    """Each value with its neighbours, as far as these are of its group."""
    half, out = len(SMOOTHING) // 2, []
    for i, group in enumerate(groups):
        near = [(w, values[j]) for w, j in zip(SMOOTHING, range(i - half, i + half + 1)) if 0 <= j < len(values) and groups[j] == group]
        out.append(sum(w * x for w, x in near) / sum(w for w, _ in near))
    return out


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """The content blocks of a page, joined by newlines."""
    blocks = [(b, t) for b in blocks_of(page or "") if (t := " ".join("".join(b.parts).split()))]
    # per path: text length, punctuation and link text of its blocks
    totals: dict[int, list[float]] = defaultdict(lambda: [0.0] * 4)
    for b, t in blocks:
        for k, x in enumerate((1, len(t), len(_PUNCTUATION.findall(t)), min(b.linked, len(t)))):
            totals[b.path][k] += x
    ratio = {p: (size / n) ** 0.5 * (0.5 + min(signs / n, 6.0)) * max(1 - linked / size, 0.1) ** 2 for p, (n, size, signs, linked) in totals.items()}
    # smoothed in page order, as far as neighbours are of one region and weight
    smooth = _smooth([ratio[b.path] for b, _ in blocks], [(b.region, b.hint) for b, _ in blocks])
    # regions with enough text are scored as one
    weight: dict[int, float] = defaultdict(float)
    worth: dict[int, float] = defaultdict(float)
    for (b, t), x in zip(blocks, smooth):
        weight[b.region] += len(t) * b.hint
        worth[b.region] += len(t) * b.hint * x
    largest = max((n for r, n in weight.items() if r), default=0)
    chosen = {r: worth[r] / n for r, n in weight.items() if r and n >= 0.3 * largest}
    # fused per path with its hints and its region
    fused: dict[int, list[float]] = defaultdict(list)
    for (b, _), x in zip(blocks, smooth):
        fused[b.path].append(REGION * max(x, chosen[b.region]) if b.region in chosen and b.hint == 1 else REGION * x * b.hint if b.region in chosen else x * b.hint)
    score = {p: sum(x) / len(x) for p, x in fused.items()}
    heavy = sum(len(t) * b.hint for b, t in blocks)
    mean = sum(score[b.path] * len(t) * b.hint for b, t in blocks) / heavy if heavy else 0
    return "\n".join(t for b, t in blocks if score[b.path] >= threshold * mean)


def extract(pages: DataFrame, page_id: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text): the main text of every page."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = [main_text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url {rows.schema['url'].dataType.simpleString()}, text string")
