"""Main text of web pages by tag-path ratios.

All text nodes with the same path from the root are judged together: how much text and how much punctuation a node of
that path holds on average, how much of it is links, and whether a class or id on the way names something else than an
article. The ratios are smoothed along the page, fused, and paths above the spread of the scores are content. On a path,
containers carry their place among those beside them, so that a notice and the article in two boxes of one kind
are two paths.

The element that holds all content and its headline is the region. In it a block stays if its path is content, or if it is a
short one beside content: in a box that holds content itself, or between its blocks. All of it is linear in the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import column_type, text_or_empty

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp svg select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img math mi mn mo mtext mrow mfrac msqrt mroot msub msup msubsup mover munder semantics object".split())
DROPPED = frozenset("nav footer header aside button fieldset dialog menu head label legend".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of a class or id that name something other than the article, if the words beside them say nothing.
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs footer header masthead sidebar sidebars aside widget widgets cookie cookies consent gdpr notice notices popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social comment comments commentlist disqus reply replies respond "
    "related recommended teaser teasers pagination pager toolbar".split())
PLAIN_NAMES = frozenset(
    "container wrapper wrap box block list area bar section top bottom left right main site page inner outer buttons button links link item items "
    "row col column module panel group content body text message thread form global primary secondary small large js x y z".split())
#: Start tags before which an open paragraph ends.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split())
#: Start tags that end an open element of these kinds, up to the nearest of the bounds.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that can hold a whole article, whose place counts on a path; others are parts of one, whatever their length.
CONTAINERS = frozenset(("article", "body", "div", "form", "html", "main", "td", ""))
WHOLE_PAGE = frozenset(("", "html", "body"))
#: Factors of a path that is named as something else and of one in an article or main part; the share of the best ratio that content has at least.
NAMED, ARTICLE, FLOOR = 0.02, 3.0, 0.1
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？]")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</[a-zA-Z][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z][^\s/>]*+(?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+>|<[a-zA-Z][^>]*+(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Page:
    """Elements of a page in the order of their start tags, in parallel lists, and its text nodes.

    Element 0 is the root. ``path`` numbers the path of an element; inline elements but links share that of their parent.
    """

    def __init__(self):
        self.tag, self.parent, self.depth, self.path = [""], [-1], [0], [0]
        self.linked, self.named, self.dropped, self.box = [False], [False], [False], [0]
        self.article, self.heading = [False], [0]  # whether an element lies in an article; the h1 or h2 it is or is in, or 0
        self.text: list[str] = []
        self.owner: list[int] = []
        self.block: list[int] = []
        self._paths: dict[tuple, int] = {(): 0}
        self._places: dict[tuple[int, str], int] = {}

    def open(self, tag: str, parent: int, token: str) -> int:
        new = len(self.tag)
        container = tag in CONTAINERS
        own = tag
        if container:
            place = self._places[parent, tag] = self._places.get((parent, tag), 0) + 1
            own = f"{tag}:{place}"
        dropped, named = _judge(tag, token, self.article[parent])
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.path.append(self.path[parent] if tag in INLINE and tag != "a" else self._paths.setdefault((self.path[parent], own), len(self._paths)))
        self.linked.append(self.linked[parent] or tag == "a")
        self.named.append(self.named[parent] or named and tag not in ("p", "li", "blockquote", "td", "h1", "h2", "h3"))
        self.dropped.append(self.dropped[parent] or dropped)
        self.box.append(new if container else self.box[parent])
        self.article.append(self.article[parent] or tag in ("article", "main"))
        self.heading.append(new if tag in ("h1", "h2") else self.heading[parent] if tag in INLINE else 0)
        return new

    def sums(self, values: dict[int, int]) -> list[int]:
        """For each element what it and all elements in it hold."""
        out = [values.get(e, 0) for e in range(len(self.tag))]
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out

    def inside(self, element: int) -> list[bool]:
        out = [False] * len(self.tag)
        out[element] = True
        for e in range(element + 1, len(out)):
            out[e] = out[self.parent[e]]
        return out


def _judge(tag: str, token: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is no part of an article by its kind, and whether its class or id names something else."""
    heading = in_article and tag == "header"
    dropped, named = tag in DROPPED and not heading, False
    if tag in ("html", "body", "main", "article") or len(token) == len(tag) + 2:
        return dropped, False
    for name, a, b, c in _ATTRIBUTE.findall(token, len(tag) + 1):
        value, name = (a or b or c).lower(), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in DROPPED_ROLES:
            dropped = True
        if name in ("class", "id"):
            for label in value.split():
                words = [w for w in re.split(r"[^a-z]+", label) if w]
                other = DROPPED_NAMES.intersection(words) - ({"header"} if in_article else set())
                named |= bool(other) and all(w in DROPPED_NAMES or w in PLAIN_NAMES for w in words)
    return dropped, named


def read_page(page: str) -> Page:
    """Text nodes outside scripts and other raw elements, with their element and block."""
    out = Page()
    here, block, at = 0, 0, 0
    stack: dict[str, int] = {}  # open elements of each kind

    def close_to(element: int) -> None:
        nonlocal here
        while here != element:
            stack[out.tag[here]] -= 1
            here = out.parent[here]

    def add(raw: str) -> None:
        text = html.unescape(raw)
        if text:
            out.text.append(text)
            out.owner.append(here)
            out.block.append(block)

    def end_of(kinds: set[str], bounds: set[str]) -> None:
        if any(stack.get(k) for k in kinds):
            e = here
            while e and out.tag[e] not in bounds:
                if out.tag[e] in kinds:
                    close_to(out.parent[e])
                    return
                e = out.parent[e]

    while at < len(page):
        token = _TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        if token.start() > at:
            add(page[at:token.start()])
        at, raw = token.end(), token[0]
        if raw.startswith("<![CDATA["):
            continue
        named = _NAME.match(raw)
        if named is None:
            continue
        tag = named[1].lower()
        if tag not in INLINE:
            block += 1
        if raw[1] == "/":
            if stack.get(tag):
                while out.tag[here] != tag:
                    close_to(out.parent[here])
                close_to(out.parent[here])
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in ENDS_PARAGRAPH:
            end_of({"p"}, {"td", "th", "li", "div", "article", "section", "button", "body"})
        if tag in ENDS:
            end_of(*ENDS[tag])
        if not raw.endswith("/>") or tag in INLINE or tag in ("p", "div"):
            here = out.open(tag, here, raw)
            stack[tag] = stack.get(tag, 0) + 1
    return out


def _smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    if len(values) < 3:
        return values
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    whole = np.convolve(values, kernel)[reach:reach + len(values)]
    return whole / np.convolve(np.ones(len(values)), kernel)[reach:reach + len(values)]


def path_ratios(page: Page, nodes: Sequence[int]) -> dict[int, float]:
    """Text of a node of each path on average, times one more than its punctuation, less its links, less where it is named and more in an article."""
    sums: dict[int, list[float]] = {}
    for k in nodes:
        own, e = sums.setdefault(page.path[page.owner[k]], [0, 0, 0, 0, 0, 0]), page.owner[k]
        size = len(page.text[k].strip())
        for i, value in enumerate((size, len(PUNCTUATION.findall(page.text[k])), size * page.linked[e], page.named[e], page.article[e], 1)):
            own[i] += value
    return {path: size / n * (1 + marks / n) * (1 - linked / max(size, 1)) * (1 - (1 - NAMED) * named / n) * (1 + (ARTICLE - 1) * article / n)
            for path, (size, marks, linked, named, article, n) in sums.items()}


def content_paths(page: Page, nodes: Sequence[int], sigma: float = 1.0, spread: float = 1.0) -> set[int]:
    """Paths whose ratio, alone and smoothed along the page, is at least ``spread`` standard deviations of all nodes' ratios, and not far below the best."""
    ratio = path_ratios(page, nodes)
    paths = [page.path[page.owner[k]] for k in nodes]
    fused = _smoothed(np.array([ratio[p] for p in paths], float), sigma)
    sums: dict[int, list[float]] = {}
    for path, value in zip(paths, fused):
        own = sums.setdefault(path, [0.0, 0])
        own[0] += value
        own[1] += 1
    means = {path: total / n for path, (total, n) in sums.items()}
    best = max(ratio.values())
    limit = min(max(spread * float(np.std(fused)), FLOOR * best), best)
    chosen = {path for path, mean in means.items() if mean >= limit and ratio[path] >= limit}
    return chosen or {max(ratio, key=ratio.get)}


def main_text(page: str, sigma: float = 1.0, spread: float = 1.0) -> str:
    """The article of a page: blocks in page order, each with single spaces, joined by line breaks."""
    tree = read_page(page)
    drop = _dropped(tree)
    shown = [k for k, e in enumerate(tree.owner) if not drop[e]]
    nodes = [k for k in shown if tree.text[k].strip()]
    if not nodes:
        return ""
    chosen = content_paths(tree, nodes, sigma, spread)
    kept = _kept_blocks(tree, nodes, chosen)
    blocks: dict[int, list[str]] = {}
    for k in shown:
        if tree.block[k] in kept:
            blocks.setdefault(tree.block[k], []).append(tree.text[k])
    out = [" ".join("".join(parts).split()) for parts in blocks.values()]
    return "\n".join(t for t in out if t)


def _dropped(tree: Page) -> list[bool]:
    """What is no part of an article by its kind; a form is one, unless most of the page's text is in it."""
    sizes: dict[int, int] = {}
    for k, e in enumerate(tree.owner):
        if not tree.dropped[e]:
            sizes[e] = sizes.get(e, 0) + len(tree.text[k].strip())
    held = tree.sums(sizes)
    out = list(tree.dropped)
    for e in range(1, len(out)):
        out[e] = out[e] or out[tree.parent[e]] or tree.tag[e] == "form" and 2 * held[e] < held[0]
    return out


def _kept_blocks(tree: Page, nodes: Sequence[int], chosen: set[int]) -> set[int]:
    content = [k for k in nodes if tree.path[tree.owner[k]] in chosen]
    counts: dict[int, int] = {}
    for k in content:
        counts[tree.owner[k]] = counts.get(tree.owner[k], 0) + 1
    held = tree.sums(counts)
    region = max((e for e in range(len(held)) if held[e] == len(content)), key=lambda e: tree.depth[e])
    region = _widened(tree, nodes, region)
    inside = tree.inside(region)
    direct = {tree.box[tree.owner[k]] for k in content}  # boxes with content of their own
    own = [k for k in nodes if inside[tree.owner[k]]]
    heads = [k for k in own if tree.heading[tree.owner[k]] and not tree.linked[tree.owner[k]]]
    first, last = min([content[0], *heads[:1]]), content[-1]
    # Links of a block, which decide at the borders of a page that has no region of its own.
    linked: dict[int, list[int]] = {}
    for k in own:
        both = linked.setdefault(tree.block[k], [0, 0])
        both[0] += len(tree.text[k].strip()) * tree.linked[tree.owner[k]]
        both[1] += len(tree.text[k].strip())
    kept = {tree.block[k] for k in content}
    trusted = tree.tag[region] in ("article", "main")
    for k in own:
        e, between = tree.owner[k], first <= k <= last
        if tree.named[e] and not tree.named[region]:
            continue
        box = tree.box[e]
        if box in direct or box == region or held[box]:
            links, size = linked[tree.block[k]]
            if between or tree.tag[box] not in WHOLE_PAGE or box in direct and 2 * links < size:
                kept.add(tree.block[k])
        elif between or trusted:
            kept.add(tree.block[k])
    return kept


def _widened(tree: Page, nodes: Sequence[int], found: int) -> int:
    """The article or main part around ``found``, or else the box around it with a headline, if one comes before it.

    A headline is a h1 that is no link, or any h1 or h2 right inside an element that holds ``found``.
    """
    while tree.tag[found] not in CONTAINERS:
        found = tree.parent[found]
    around, e = [found], found
    while e:
        e = tree.parent[e]
        around.append(e)
    for e in around:
        if tree.tag[e] in ("article", "main"):
            return e
    inside = tree.inside(found)
    holders = set(around)
    first = next(n for n, k in enumerate(nodes) if inside[tree.owner[k]])
    head = tree.heading[tree.owner[nodes[first]]]
    if head or any(inside[h] and tree.tag[h] == "h1" for h in (tree.heading[tree.owner[k]] for k in nodes) if h):
        return found
    wider = []
    for k in nodes[:first]:
        h = tree.heading[tree.owner[k]]
        if h and (tree.parent[h] in holders or tree.tag[h] == "h1" and not tree.linked[tree.owner[k]]):
            e = tree.parent[h]
            while e not in holders:
                e = tree.parent[e]
            wider.append(e)
    return max(wider, key=lambda e: tree.depth[e]) if wider else found


def extract(df: DataFrame, page: str = "html", keep: Sequence[str] = ("page_id", "url"), sigma: float = 1.0,
            spread: float = 1.0) -> DataFrame:
    """Columns ``keep`` with ``text``, the main text of each whole page, and ``n_chars``, its code points.

    A null or empty page, or one without text outside of dropped parts, gives an empty text. Broken markup is
    read as far as it goes: tags that are never closed end with their parents, a tag cut off at the end is
    markup. Repeated rows are all returned, an empty table gives no rows, other columns are not read.
    """
    clash = set(keep) & {"text", "n_chars"}
    if clash:
        raise ValueError(f"output names in keep: {sorted(clash)}")
    keep = list(keep)
    schema = ", ".join([f"`{c}` {column_type(df, c)}" for c in keep] + ["text string", "n_chars bigint"])

    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(p, sigma, spread) for p in batch["_page"]]
            yield batch[keep].assign(text=texts, n_chars=[len(t) for t in texts])

    return df.select(*[F.col(c) for c in keep], text_or_empty(page).alias("_page")).mapInPandas(rows, schema)
