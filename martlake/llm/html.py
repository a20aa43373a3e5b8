"""Main text of web pages by the ratios of their tag paths.

A page is read into text nodes, each with the path of open elements from the root to it (name, and id and classes
where present; plain elements of the line, such as bold text, are no step of a path). Per path, text length, punctuation
and the part inside links are summed over its blocks; the path's ratio is the mean text per block weighted by punctuation
and by the share outside links, as a logarithm. Ratios are smoothed with a Gaussian over the paths in page order, so a short
heading between long paragraphs rises and a stray sentence between menus falls, and fused with what names say: an article or
main element, or a class or id with such a word, adds up to `EVIDENCE`, in proportion to the page's text that lies in such
elements (all of it from one half on), so a teaser that calls itself an article decides nothing; classes and ids of
menus, notices, adverts, comments and the like take `AGAINST` off. Both are bounded, and a ratio can outweigh them.

One threshold decides every page: the fused score that paths with at least `SHARE` of the page's text reach, less `DROP`, and
never below zero. Paths above it are content. The innermost container (no paragraph, heading or list item) that holds
`MOST` of their text is completed: paths in it that no name speaks against and that are not links for the most part
belong to it, such as a list of single words. All text of content paths is kept.

Navigation, footer, aside and menu elements, scripts, styles and other elements without page text are never content. A form is
left out unless it holds most of the page's text, as where it frames the whole page.

Blocks are separated by block elements; white space within a block becomes one space, blocks are joined by two line
feeds.

Time and memory are linear in the page: a path is its parent's number and one step, open elements are found by name, and a
tag's end is looked for once. Defined cases: null and empty html, and pages without content, give an empty text; unclosed
elements last to the end of what can hold them, unclosed comments and scripts to the end of the page; a `<` that opens no tag is
text, and so is all that follows the page's last `>`; from a tag on whose quotes never close, tags end at their next `>`;
rows that repeat an id are extracted each by itself; pages of any length are read whole, each in one task; an empty table gives
no rows; only the id, url and html are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import lean

#: What may start at a `<`, a tag's name, and what ends a comment.
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
COMMENT_END = re.compile(r"--!?>")
OUTSIDE = re.compile(r"[>\"']")
#: An attribute with its value, which is consumed whole, so that words in quoted values are not taken for names.
ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s"'>/=]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]++))?""")
READ = set("id class role hidden style".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

#: Fixed values of the HTML standard: elements without content, elements whose content is not markup or not shown,
#: elements that end a paragraph, and elements that lie in the line.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes iframe".split())
UNSHOWN = set(
    "head script style textarea title noscript template iframe object embed applet svg math canvas audio video map"
    " select option button datalist input label fieldset legend dialog xmp noembed noframes".split()
)
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
#: An opening tag closes an open element of these names, up to the given borders.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
PARAGRAPH = {"table", "td", "th", "article", "main", "body", "section", "div"}
#: Blocks of text, which contain no other blocks of an article.
LEAVES = set("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption caption".split())

#: What names of elements, ids, classes and roles say about their content.
ASIDE = set("nav footer aside menu".split())
BOILERPLATE = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar pagination pager"
    " header masthead footer copyright legal sidebar aside widget related recommended teaser"
    " comment comments disqus respond reply replies discussion reactions"
    " cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription"
    " signup login search form share sharing social complementary contentinfo".split()
)
CONTENT = {"article", "main", "story"}
HEADS = {"header", "masthead", "banner"}
#: Classes such as "with-sidebar" speak of what stands beside an element.
QUALIFIED = {"with", "has", "no", "without"}

PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

#: Smoothing width in paths, and the most that names add to a score or take off it.
SIGMA, EVIDENCE, AGAINST = 1.0, 4.0, 5.0
#: The share of the page's text whose score sets the threshold, what a path may stay below it, and the share of the content's
#: text that its container holds. Text that names speak against counts `DOUBTED` of its length for the first.
SHARE, DROP, MOST, DOUBTED = 0.2, 3.0, 0.8, 0.25


@dataclass(slots=True)
class Node:
    path: int
    block: int
    text: str
    linked: bool


@dataclass(slots=True)
class Path:
    parent: int
    name: str
    kind: int  # what names say: 1 content, -1 boilerplate
    form: bool


@dataclass(slots=True)
class Open:
    name: str
    path: int
    shown: bool
    linked: bool


class Elements:
    """The open elements, found by name without a walk through them."""

    def __init__(self):
        self.stack = [Open("", 0, True, False)]
        self.places: dict[str, list[int]] = {}

    def push(self, element: Open) -> None:
        self.places.setdefault(element.name, []).append(len(self.stack))
        self.stack.append(element)

    def pop(self) -> None:
        self.places[self.stack.pop().name].pop()

    def last(self, names: set[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def close(self, names: set[str], borders: set[str]) -> None:
        """Close the last open element of these names with all in it, unless a border lies in between."""
        at = self.last(names)
        if at > self.last(borders):
            while len(self.stack) > at:
                self.pop()


def name_words(attributes: str) -> tuple[set[str], bool]:
    """Words of id, class and role, and whether the element is hidden."""
    words: set[str] = set()
    hidden = False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key not in READ:
            continue
        if key == "hidden":
            hidden = True
        elif key == "style":
            hidden = hidden or bool(HIDDEN.search(value))
        else:
            words.update(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()))
    return words - {""}, hidden


def tags(page: str) -> Iterator[tuple[int, int, re.Match | None]]:
    """Start and end of every tag, and its name; comments and declarations have none.

    Who reads an element as raw text sends the place to go on from.
    """
    last, at, quoted = page.rfind(">"), 0, True
    while (start := page.find("<", at)) >= 0:
        at = start + 1
        name = None
        if page.startswith("<!--", start):
            found = COMMENT_END.search(page, start + 2)
            end = found.end() if found else len(page)
        elif start > last:
            # No tag ends any more; only an open comment could still follow.
            start = page.find("<!--", start)
            if start >= 0:
                yield start, len(page), None
            return
        elif page.startswith(("<!", "<?"), start):
            end = page.find(">", start) + 1
        elif name := NAME.match(page, start):
            end = tag_end(page, name.end()) if quoted else 0
            if not end:
                quoted, end = False, page.find(">", start) + 1
        else:
            continue
        at = (yield start, end, name) or end


def tag_end(page: str, at: int) -> int:
    """Behind the next `>` outside quotes, or 0 without one."""
    while found := OUTSIDE.search(page, at):
        if found[0] == ">":
            return found.end()
        at = page.find(found[0], found.end()) + 1
        if not at:
            return 0
    return 0


def read_nodes(page: str) -> tuple[list[Node], list[Path]]:
    """Text nodes in page order, and the paths they refer to; a path comes after its parent."""
    nodes: list[Node] = []
    paths = [Path(0, "", 0, False)]
    numbers: dict[tuple[int, str], int] = {}
    elements = Elements()
    block = at = 0

    def add(text: str) -> None:
        top = elements.stack[-1]
        if text and top.shown:
            nodes.append(Node(top.path, block, entities.unescape(text), top.linked))

    def step(above: int, name: str, words: set[str]) -> int:
        key = (above, ".".join([name, *sorted(words)]))
        if key not in numbers:
            kind = paths[above].kind
            said = set() if name in ("html", "body") or words & QUALIFIED else words & BOILERPLATE
            if kind > 0 or name in CONTENT:
                said -= HEADS  # an article has a heading of its own
            if name == "form":
                said -= {"form"}
            if said or (name == "header" and kind <= 0):
                kind = -1
            elif kind == 0 and name not in ("html", "body") and (name in CONTENT or words & CONTENT):
                kind = 1
            numbers[key] = len(paths)
            paths.append(Path(above, name, kind, paths[above].form or name == "form"))
        return numbers[key]

    scan = tags(page)
    place = next(scan, None)
    while place:
        start, end, tag = place
        add(page[at:start])
        at = end
        raw = None
        if tag:
            name = tag[2].lower()
            if name not in INLINE:
                block += 1
            if tag[1]:
                if name == "br":
                    if nodes:
                        nodes.append(Node(nodes[-1].path, block, " ", False))
                elif name == "p":
                    elements.close({"p"}, PARAGRAPH)
                else:
                    elements.close({name}, {"body"} if name != "html" else set())
            elif name == "br":
                add(" ")
            elif name not in VOID:
                if name not in INLINE:
                    elements.close({"p"}, PARAGRAPH | {"blockquote", "li"})
                if name in CLOSES:
                    elements.close(*CLOSES[name])
                attributes = page[tag.end() : end - 1]
                if name in RAW:
                    if not attributes.rstrip().endswith("/"):
                        found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
                        raw = at = (page.find(">", found.end()) + 1 if found else 0) or len(page)
                else:
                    words, hidden = name_words(attributes)
                    above = elements.stack[-1]
                    path = above.path if name in INLINE and not words else step(above.path, name, words)
                    shown = above.shown and name not in UNSHOWN and name not in ASIDE and not hidden
                    elements.push(Open(name, path, shown, above.linked or name == "a"))
        try:
            place = scan.send(raw)
        except StopIteration:
            place = None
    add(page[at:])
    return nodes, paths


def smoothed(values: np.ndarray) -> np.ndarray:
    """A Gaussian mean over neighbours."""
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    n = len(values)
    return np.convolve(values, kernel)[reach : reach + n] / np.convolve(np.ones(n), kernel)[reach : reach + n]


def content_paths(nodes: list[Node], paths: list[Path]) -> np.ndarray:
    """Which paths are content."""
    n = len(paths)
    length, marks, linked, count = (np.zeros(n) for _ in range(4))
    block = np.full(n, -1)
    order: dict[int, None] = {}
    for node in nodes:
        text = node.text.strip()
        if text:
            order[node.path] = None
            length[node.path] += len(text)
            marks[node.path] += len(PUNCTUATION.findall(text))
            linked[node.path] += len(text) if node.linked else 0
            count[node.path] += block[node.path] != node.block
            block[node.path] = node.block
    content = np.zeros(n, dtype=bool)
    kind, form = np.array([p.kind for p in paths]), np.array([p.form for p in paths])
    plain = length - linked
    if plain[form].sum() <= plain.sum() / 2:
        plain[form] = 0
        used = np.array([p for p in order if not form[p]], dtype=int)
    else:
        used = np.array(list(order), dtype=int)
    if not plain.sum():
        return content
    # Paths in the order in which their text appears, so neighbours are near each other on the page.
    ratio = np.log1p(plain[used] / count[used] * (1 + marks[used] / count[used]) * (plain[used] / length[used]))
    named = plain[kind > 0].sum() / max(plain[kind >= 0].sum(), 1)
    evidence = EVIDENCE * min(1.0, 2 * named) * (kind[used] > 0) - AGAINST * (kind[used] < 0)
    fused = np.maximum(smoothed(ratio), ratio) + evidence
    mass = plain[used] * np.where(kind[used] < 0, DOUBTED, 1.0)
    falling = np.argsort(-fused, kind="stable")
    reached = np.searchsorted(np.cumsum(mass[falling]), SHARE * mass.sum())
    least = max(fused[falling[min(reached, len(used) - 1)]] - DROP, 0.0)
    mostly_text = linked[used] <= length[used] / 2
    strong = (fused > least) & mostly_text
    # A title may be a link.
    strong |= (fused > least) & (kind[used] > 0)
    content[used[strong]] = True
    if not strong.any():
        return content

    within = np.where(content, plain, 0.0)
    for k in range(n - 1, 0, -1):
        within[paths[k].parent] += within[k]
    inner = int(np.flatnonzero(within >= MOST * within[0])[-1])
    while paths[inner].name in LEAVES:
        inner = paths[inner].parent
    inside = np.zeros(n, dtype=bool)
    inside[inner] = True
    for k in range(inner + 1, n):
        inside[k] = inside[paths[k].parent]
    content[used[inside[used] & (kind[used] >= 0) & (mostly_text | (kind[used] > 0))]] = True
    return content


def main_text(page: str | None) -> str:
    if not page:
        return ""
    nodes, paths = read_nodes(page)
    if not nodes:
        return ""
    content = content_paths(nodes, paths)
    blocks: list[list[str]] = []
    last = None
    for node in nodes:
        if content[node.path]:
            if node.block != last:
                blocks.append([])
                last = node.block
            blocks[-1].append(node.text)
    texts = (" ".join("".join(parts).split()) for parts in blocks)
    return "\n\n".join(t for t in texts if t)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    read = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return read.mapInArrow(lean(run), "page_id long, url string, text string, n_chars long")
