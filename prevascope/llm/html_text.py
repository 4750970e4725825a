"""Main text of web pages by tag-path ratios.

Every text block of a page belongs to its root-to-leaf tag path. A path's text and punctuation per block are
smoothed over the page order, fused and held against a threshold. The paths above it find the content nodes: the articles that hold
nearly all of their text, else the containers whose text is mostly theirs. All blocks below a content node are the text, tables, lists
and quotes of any length included, but for lists and blocks of links and for what has a name of boilerplate; and so are blocks of
chosen paths elsewhere, with the headings right before them, unless articles or a main element hold nearly all that is chosen. What is
boilerplate by nature is left out. A name of boilerplate lowers the ratio of the paths below it, unless the element holds most of the
page. Names that also stand for subjects (search, related) count only if nothing else is in the name, and not for
blocks with sentences.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.llm.common import bounded_batches

#: Tag names and words of class, id and role, as HTML and common usage have them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT = frozenset("head nav header footer aside button select option menu dialog".split()) | RAW
LEFT_OUT_WORDS = frozenset(
    "advert advertisement adverts advertising breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer "
    "login menu modal nav navbar navigation newsletter pager pagination popup sidebar signup sponsor sponsored subscribe contentinfo".split()
)
#: Words that name subjects as well, and words that may stand beside them in a name of boilerplate.
SUBJECT_WORDS = frozenset(
    "ad ads alert banner complementary header masthead notice notices promo promotion related replies respond search share sharing skip social "
    "toolbar widget".split()
)
BESIDE = frozenset(
    "area articles bar block bottom box buttons container content cookie header icons inner item items left link links list main media "
    "outer page panel post posts right section site stories text title top wrap wrapper".split()
)
#: Parts of a name that turn it around: with-sidebar, no-header, ad-free.
TURNING = frozenset("with without no non not has have free".split())
COMMENT_WORDS = frozenset("comment comments replies respond disqus reply".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl table".split())
#: Parts of what a container holds.
PARTS = LISTS | HEADINGS | frozenset("p li dt dd tr td th tbody thead tfoot caption blockquote pre figure figcaption address details summary".split())
#: Share of the chosen text that articles must hold for the rest to go; share of the mean that a path must reach.
HOLDS, THRESHOLD = 0.9, 0.5
#: What an article around it makes of a path's ratio.
IN_ARTICLE = 2.0
#: What a name of boilerplate makes of it, and the share of the page's text from which an element's name says nothing.
NAMED, MOST = 0.2, 0.5

#: Share of a container's text that must be chosen to make it a content node, and of links that make a list or block one of links.
NODE, LINKED = 0.5, 0.8
#: A block of so many characters with a stop has sentences.
SENTENCES = 60

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[a-z]+")
_STOP = re.compile(r"[.!?…。！？]")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、¡¿]")


class Page:
    """Elements and text blocks of a page; ``parents`` and ``tags`` are by element, 0 is the root."""

    def __init__(self, source: str):
        self.parents, self.tags, self.dropped, self.named = [0], [""], [False], [0]
        self.paths: dict[tuple[int, str], int] = {}
        self.path_of = [0]
        self.blocks: list[tuple[str, int]] = []  # text, element
        self.linked: list[int] = []  # characters of each block that are links
        self._links = 0
        self._pending: list[str] = []
        self._owner = 0
        self._stack, self._open = [0], Counter()
        at = 0
        while at < len(source):
            start = source.find("<", at)
            if start < 0:
                self._text(source[at:])
                break
            if start > at:
                self._text(source[at:start])
            token = _TOKEN.match(source, start)
            if not token:
                self._text("<")
                at = start + 1
                continue
            at = token.end()
            if token[2] is None:
                continue
            tag = token[2].lower()
            if token[1]:
                self._end(tag)
            else:
                self._start(tag, token[3] or "")
                if tag in RAW and not (token[3] or "").endswith("/"):
                    close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                    at = close.end() if close else len(source)
                    self._end(tag)
        self._flush()

    def _text(self, raw: str) -> None:
        element = self._stack[-1]
        if self.dropped[element]:
            return
        if not self._pending:
            self._owner = element
        elif element != self._owner and not raw.isspace() and not "".join(self._pending).strip():
            self._owner = element
        self._pending.append(raw)
        if self._open["a"]:
            self._links += len(raw.strip())

    def _flush(self) -> None:
        if self._pending:
            text = " ".join(html.unescape("".join(self._pending)).split())
            if text:
                self.blocks.append((text, self._owner))
                self.linked.append(self._links)
            self._pending, self._links = [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "hr":
                self._flush()
            elif tag == "br":
                self._text(" ")
            return
        if tag in BLOCK:
            self._flush()
            if self._open["p"]:
                self._end("p")
            if tag in CLOSES and self.tags[self._stack[-1]] in CLOSES[tag]:
                self._pop()
        top = self._stack[-1]
        self.parents.append(top)
        self.tags.append(tag)
        left_out, named = self._is_boilerplate(tag, attributes)
        self.dropped.append(self.dropped[top] or left_out)
        self.named.append(named)
        key = (self.path_of[top], tag)
        self.path_of.append(self.paths.setdefault(key, len(self.paths) + 1))
        self._stack.append(len(self.parents) - 1)
        self._open[tag] += 1

    def _is_boilerplate(self, tag: str, attributes: str) -> tuple[bool, int]:
        """Whether an element is left out by nature, and whether its name is one of boilerplate: 2, or 1 if it may be a subject."""
        if tag in ("html", "body"):
            return False, 0
        if tag in LEFT_OUT and not (tag == "header" and (self._open["article"] or self._open["main"])):
            return True, 0
        names, hidden = [], False
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id", "role"):
                names += [set(_NAME_PART.findall(token)) for token in value.split()]
            hidden |= name == "hidden" or (name == "aria-hidden" and value == "true")
            hidden |= name == "style" and "display:none" in value.replace(" ", "")
        words = COMMENT_WORDS if tag in ("article", "main") else LEFT_OUT_WORDS
        names = [parts for parts in names if not parts & TURNING]
        if tag == "form" or any(parts & words for parts in names):
            return hidden, 2
        subject = tag not in ("article", "main") and any(parts & SUBJECT_WORDS and parts <= SUBJECT_WORDS | BESIDE for parts in names)
        return hidden, int(subject)

    def named_below(self) -> list[int]:
        """The strongest name of boilerplate that each element is under, of elements with less than ``MOST`` of the page's text."""
        whole = [0] * len(self.parents)
        for block, element in self.blocks:
            whole[element] += len(block)
        for i in range(len(whole) - 1, 0, -1):
            whole[self.parents[i]] += whole[i]
        named = [0] * len(whole)
        for i in range(1, len(whole)):
            named[i] = max(named[self.parents[i]], self.named[i] if whole[i] < MOST * whole[0] else 0)
        return named

    def inherited(self, tags: frozenset[str]) -> list[int]:
        """For each element the innermost one around it, itself included, that has one of ``tags``; 0 without any."""
        found = [0] * len(self.parents)
        for i in range(1, len(found)):
            found[i] = i if self.tags[i] in tags else found[self.parents[i]]
        return found

    def _pop(self) -> None:
        self._open[self.tags[self._stack.pop()]] -= 1

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        if self._open[tag]:
            while self.tags[self._stack[-1]] != tag:
                self._pop()
            self._pop()


def below(page: Page, *tags: str) -> list[bool]:
    """Whether each element is one of ``tags`` or inside of one."""
    inside = [False] * len(page.parents)
    for i in range(1, len(inside)):
        inside[i] = inside[page.parents[i]] or page.tags[i] in tags
    return inside


def chosen_blocks(page: Page, named: list[int]) -> list[bool]:
    """Whether each block's tag path (one apart below names of boilerplate) has a fused ratio that reaches the threshold."""
    text, marks, nodes = Counter(), Counter(), Counter()
    series = [(page.path_of[element], named[element] > 0) for _, element in page.blocks]
    for (block, _), path in zip(page.blocks, series):
        text[path] += len(block)
        marks[path] += len(_PUNCTUATION.findall(block))
        nodes[path] += 1

    def smoothed(values: list[float]) -> list[float]:
        padded = [values[0], *values, values[-1]]
        return [(padded[i] + 2 * padded[i + 1] + padded[i + 2]) / 4 for i in range(len(values))]

    length = smoothed([text[p] / nodes[p] for p in series])
    stops = smoothed([marks[p] / nodes[p] for p in series])
    fused = Counter()
    for path, x, y in zip(series, length, stops):
        fused[path] += math.sqrt(x * (1 + y)) / nodes[path]
    plain = [p for p in fused if not p[1]] or list(fused)
    mean = sum(fused[p] * text[p] for p in plain) / sum(text[p] for p in plain)
    inside = below(page, "article", "main")
    raised = {page.path_of[element] for _, element in page.blocks if inside[element]}
    weight = {p: NAMED if p[1] else IN_ARTICLE if p[0] in raised else 1 for p in fused}
    return [fused[p] * weight[p] >= THRESHOLD * mean for p in series]


def _links_only(page: Page) -> list[bool]:
    """Whether each block is of links, or in a list or table that is."""
    lists, text, linked = page.inherited(LISTS), Counter(), Counter()
    for (block, element), link in zip(page.blocks, page.linked):
        text[lists[element]] += len(block)
        linked[lists[element]] += link
    return [
        linked[at] >= LINKED * text[at] if (at := lists[element]) else link >= LINKED * len(block)
        for (block, element), link in zip(page.blocks, page.linked)
    ]


def _below_containers(page: Page, by_path: list[bool]) -> list[bool]:
    """Whether each block is below a container whose text is mostly of chosen paths.

    The body itself is one only from its first chosen block to its last, as what is around them is often not in any container.
    """
    container = page.inherited(BLOCK - PARTS)
    own = [container[element] for _, element in page.blocks]
    top = [page.tags[at] in ("", "html", "body") for at in own]
    whole, chosen = [0] * len(page.parents), [0] * len(page.parents)
    for (block, _), at, c in zip(page.blocks, own, by_path):
        whole[at] += len(block)
        chosen[at] += len(block) * c
    direct = {k for k, at in enumerate(own) if by_path[k]}
    holders = {own[k] for k in direct if not top[k]}
    for i in range(len(whole) - 1, 0, -1):
        whole[page.parents[i]] += whole[i]
        chosen[page.parents[i]] += chosen[i]
    inside = [False] * len(page.parents)
    for i in range(1, len(inside)):
        inside[i] = inside[page.parents[i]] or (i in holders and chosen[i] >= NODE * whole[i])
    loose = [k for k in direct if top[k]]
    first, last = min(loose, default=0), max(loose, default=-1)
    return [inside[element] or first <= k <= last for k, (_, element) in enumerate(page.blocks)]


def main_text(source: str | None) -> str:
    """The main text of a page, its blocks joined by an empty line."""
    page = Page(source or "")
    if not page.blocks:
        return ""
    named = page.named_below()
    by_path = chosen_blocks(page, named)
    chosen = list(by_path)
    whole = sum(len(block) for (block, _), c in zip(page.blocks, chosen) if c)
    links = _links_only(page)
    stays = [
        not link and (not named[element] or (named[element] == 1 and len(block) >= SENTENCES and bool(_STOP.search(block))))
        for (block, element), link in zip(page.blocks, links)
    ]
    heading = below(page, *HEADINGS)
    following = False
    for k in range(len(chosen) - 1, -1, -1):
        if heading[page.blocks[k][1]]:
            chosen[k] = chosen[k] or (following and not named[page.blocks[k][1]])
        elif chosen[k] or not named[page.blocks[k][1]]:
            following = chosen[k]
    held_by = {tag: below(page, tag) for tag in ("article", "main")}
    holds = {
        tag: whole > 0 and sum(len(b) for (b, e), c in zip(page.blocks, by_path) if c and inside[e]) >= HOLDS * whole
        for tag, inside in held_by.items()
    }
    if holds["article"]:
        inside = held_by["article"]
        chosen = [inside[e] and (c or s) for c, s, (_, e) in zip(chosen, stays, page.blocks)]
    else:
        nodes = _below_containers(page, by_path)
        chosen = [c or (n and s) for c, n, s in zip(chosen, nodes, stays)]
        if holds["main"]:
            chosen = [c and held_by["main"][e] for c, (_, e) in zip(chosen, page.blocks)]
    return "\n\n".join(block for (block, _), c in zip(page.blocks, chosen) if c)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html).

    text is empty for a null or empty page and one without content. Broken markup is read leniently: unclosed
    elements end with their parent, a paragraph ends at the next block, and what is no tag is text. Every row gives
    a row, repeated ones too; an empty table gives none. Time is linear in the length of a page.
    """
    bounded_batches(pages.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    source = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return source.mapInArrow(_extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
