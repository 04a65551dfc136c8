"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from argent.llm.common import add_columns, column

#: A comment, a declaration, a tag with its name and attributes, or (last group) the start of one without an end.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(<)(?=/?[a-zA-Z]|[!?])", re.S)
START = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z]))")
NAME_END = re.compile(r"[\s/>]")
QUOTES = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
PUNCTUATION = re.compile(r"[,.;:!?…。，、！？]")
SPACES = re.compile(r"\s+")
LONG_NUMBER = re.compile(r"&#\d{20}")

#: Fixed lists of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is not markup and, as in a browser, without an end tag the rest of the page is theirs.
RAW = frozenset("script style textarea title iframe".split())
#: Never text of the page.
AWAY = frozenset("head noscript template svg math object select datalist option optgroup button".split())
#: Not text of the article, unless they hold it.
ASIDE = frozenset("nav footer aside form menu dialog header".split())
#: A block's start tag ends an open one of these.
INLINE = frozenset("svg math select datalist option optgroup".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the first ends an open element of the second (up to a container).
ENDS = ({t: frozenset({"p"}) for t in BLOCKS} | {t: frozenset({"p"}) | HEADINGS for t in HEADINGS}
        | {"li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
           "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}),
           "option": frozenset({"option"}), "optgroup": frozenset({"option", "optgroup"}), "a": frozenset({"a"})})
CONTAINERS = frozenset("article aside blockquote body datalist div dl fieldset footer form header html main menu nav ol section select table ul".split())
#: Words in class, id or role that mark page furniture.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments comment-list consent cookie"
    " cookies disclaimer disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices notification"
    " pagination popup promo promoted reader-comments recommended related replies respond share sharing sidebar signup skip social"
    " sponsor sponsored subscribe toc toolbar widget alert complementary contentinfo search".split())
#: A name that starts with one of the first says what the page has; with one of the second, "header" is the article's own.
TELLS = frozenset("no has with without hide show is".split())
OWN = frozenset("article body content entry main page post story title".split())
#: Weights in a path's score: furniture by name, text in links, the best container.
MARKED, LINKED, HELD = 0.1, 0.9, 4.0


def _names(attributes: str) -> tuple[bool, bool, bool]:
    """Whether an element is hidden, has a name of furniture, and has a link."""
    hidden = marked = link = False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden":
            hidden |= not value.startswith(("false", "until"))
        elif name == "aria-hidden":
            hidden |= value.strip() == "true"
        elif name == "style":
            hidden |= bool(NOT_SHOWN.search(value))
        elif name == "href":
            link = True
        elif name in ("class", "id", "role"):
            for word in value.split():
                parts = re.split(r"[-_]+", word)
                found = {x for x in (word, *parts) if x in FURNITURE}
                if OWN.intersection(parts):
                    found.discard("header")
                marked |= bool(found) and parts[0] not in TELLS
    return hidden, marked, link


def _text(parts: list[str]) -> str:
    """Parts of a block as one line, character references decoded."""
    text = "".join(parts)
    if LONG_NUMBER.search(text):  # zeros in front say nothing; what is longer is no character
        text = re.sub(r"&#\d{8,}", "&#1114112", re.sub(r"&#0+(?=\d)", "&#", text))
    return SPACES.sub(" ", html.unescape(text)).strip()


class Tags:
    """The tokens of a page from left to right, in time linear in the page.

    A tag ends at the first ``>`` outside quotes. Where one has no end, it is
    text; from there on, the end of each tag is looked up in a table made once,
    so that no later tag reads to the end of the page again.
    """

    def __init__(self, page: str):
        self.page = page
        self.spots: list[int] | None = None  # places of > and quotes, and the tag end that each leads to
        self.ends: list[int] = []
        self.name_end = self.last = -1

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, slash of an end tag, name, attributes) of the first token from ``at`` on; no name if it is not a tag."""
        if self.spots is None:
            m = TOKEN.search(self.page, at)
            if m is None or not m[4]:
                return m and (m.start(), m.end(), m[1] or "", m[2] or "", m[3] or "")
            at = m.start()
            self._table(at)
        return self._slow(at)

    def _table(self, at: int) -> None:
        """Each ``>`` is an end; a quote leads to where its pair's other quote leads on."""
        page = self.page
        self.spots = [m.start() for m in QUOTES.finditer(page, at)]
        self.ends = [-1] * (len(self.spots) + 1)
        later: dict[str, int] = {}
        for i in range(len(self.spots) - 1, -1, -1):
            c = page[self.spots[i]]
            if c == ">":
                self.ends[i] = self.spots[i]
            else:
                if c in later:
                    self.ends[i] = self.ends[later[c] + 1]
                later[c] = i
        self.last = page.rfind(">")

    def _slow(self, at: int) -> tuple[int, int, str, str, str] | None:
        page = self.page
        for m in START.finditer(page, at):
            p = m.start()
            if m[1]:
                end = page.find("-->", m.end())
                return p, end + 3 if end >= 0 else len(page), "", "", ""
            if p > self.last:
                continue
            if m[2]:
                return p, page.find(">", p) + 1, "", "", ""
            if self.name_end < m.end():
                n = NAME_END.search(page, m.end())
                self.name_end = n.start() if n else len(page)
            end = self.ends[bisect_right(self.spots, self.name_end - 1)]
            if end >= 0:
                return p, end + 1, m[3], page[m.start(4):self.name_end], page[self.name_end:end]
        return None


class Element:
    """An element of a page: its tag, whether the tag or a name speaks against it, and what it holds.

    ``up`` is the element before it on the tag path. Only blocks and inline
    elements with a name of furniture are on paths.
    """

    __slots__ = ("tag", "aside", "marked", "inside", "link", "gone", "foreign", "up", "size", "holds", "h1", "dropped", "share", "path")

    def __init__(self, tag: str, aside: bool, marked: bool, inside: bool, link: bool, gone: bool, foreign: bool, up: Element | None):
        self.tag, self.aside, self.marked, self.inside, self.link = tag, aside, marked, inside, link
        self.gone, self.foreign, self.up = gone, foreign, up
        self.size, self.holds, self.h1 = 0, False, False

    @property
    def on_path(self) -> bool:
        return self.tag in BLOCKS and self.tag not in ("html", "body") or self.marked


class Open:
    """The stack of open elements, with the places of each tag in it, so that no question reads the stack."""

    def __init__(self) -> None:
        self.stack: list[Element] = []
        self.tags: defaultdict[str, list[int]] = defaultdict(list)
        #: Places of containers, of elements that no block is in, and of what keeps their end within.
        self.containers: list[int] = []
        self.inline: list[int] = []
        self.barriers: list[int] = []
        self.nodes: list[Element] = []
        self.gone = self.links = 0

    def kinds(self, tag: str) -> list[list[int]]:
        kinds = [self.tags[tag]]
        if tag in CONTAINERS:
            kinds.append(self.containers)
        if tag in INLINE:
            kinds.append(self.inline)
        elif tag in CONTAINERS or tag == "foreignobject":
            kinds.append(self.barriers)
        return kinds

    def push(self, e: Element) -> None:
        for places in self.kinds(e.tag):
            places.append(len(self.stack))
        self.stack.append(e)
        self.gone += e.gone
        self.links += e.link
        if e.on_path:
            self.nodes.append(e)

    def pop(self) -> None:
        e = self.stack.pop()
        for places in self.kinds(e.tag):
            places.pop()
        self.gone -= e.gone
        self.links -= e.link
        if e.on_path:
            self.nodes.pop()
        if self.stack:
            over = self.stack[-1]
            over.holds |= e.holds or e.tag in ("article", "main")
            over.h1 |= e.h1 or e.tag == "h1"

    def lowest(self, places: list[int], above: list[int]) -> int:
        """The lowest of ``places`` over the last of ``above``, or the height of the stack."""
        i = bisect_right(places, above[-1]) if above else 0
        return places[i] if i < len(places) else len(self.stack)


def blocks(page: str) -> tuple[list[tuple[Element | None, str, int]], list[Element]]:
    """(innermost element on its path, text, characters in links) of each block
    that is shown, in page order, and all elements on paths, parents first.

    The text of an inline element with a name of furniture is a block of its own.
    """
    out: list[tuple[Element | None, str, int]] = []
    elements: list[Element] = []
    parts: list[tuple[str, bool, Element | None]] = []
    open_, tags = Open(), Tags(page)
    stack = open_.stack

    def add(text: str) -> None:
        if not open_.gone:
            parts.append((text, open_.links > 0, open_.nodes[-1] if open_.nodes else None))

    def flush() -> None:
        if not parts:
            return
        groups: dict[Element | None, list[tuple[str, bool]]] = {}
        for text, link, leaf in parts:
            groups.setdefault(leaf, []).append((text, link))
        parts.clear()
        for leaf, some in groups.items():
            if text := _text([t for t, _ in some]):
                out.append((leaf, text, len(_text([t for t, k in some if k]))))

    def close(n: int) -> None:
        while len(stack) > n:
            if stack[-1].tag in BLOCKS:
                flush()
            open_.pop()

    at = 0
    while token := tags.next(at):
        start, end, slash, name, attributes = token
        if start > at:
            add(page[at:start])
        at, tag = end, name.lower()
        if not tag:
            continue
        if slash:
            places = open_.tags[tag]
            # an end tag does not reach out of the block that holds it
            if places and (tag in BLOCKS or not open_.containers or open_.containers[-1] <= places[-1]):
                close(places[-1])
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                add(" ")
            continue
        foreign = tag in ("svg", "math") or bool(stack) and stack[-1].foreign
        if foreign and attributes.endswith("/"):
            continue
        if tag in RAW:
            closing = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = closing.end() if closing else len(page)
            continue
        if tag in BLOCKS:
            close(open_.lowest(open_.inline, open_.barriers))
        if tag in ENDS:
            close(min(open_.lowest(open_.tags[t], open_.containers) for t in ENDS[tag]))
        if tag in BLOCKS:
            flush()
        if tag == "body" and open_.tags["head"]:  # the end tag of head may be left out
            close(open_.tags["head"][0])
        inside = bool(open_.tags["article"] or open_.tags["main"])
        hidden, marked, link = _names(attributes) if attributes else (False, False, False)
        if tag in ("html", "body", "article", "main"):
            hidden = marked = False
        e = Element(tag, tag in ASIDE and not (tag == "header" and inside), marked, inside, link and tag == "a",
                    hidden or tag in AWAY, foreign and tag != "foreignobject", open_.nodes[-1] if open_.nodes else None)
        if e.on_path:
            elements.append(e)
        open_.push(e)
    if at < len(page):
        add(page[at:])
    flush()
    close(0)
    return out, elements


def _smooth(x: np.ndarray) -> np.ndarray:
    """Each value with half of its neighbours in page order."""
    if len(x) < 2:
        return x
    p = np.pad(x, 1, mode="edge")
    return (p[:-2] / 2 + p[1:-1] + p[2:] / 2) / 2


def main_text(page: str | None) -> str:
    """The article of a page.

    Text length and punctuation are summed per root-to-leaf tag path and
    divided by the path's number of text nodes; both ratios are smoothed over
    the paths in page order and fused into one score. Names of furniture and
    text in links lower it. Paths are content whose score reaches half of the
    page's mean score weighted by text; for that, the score is raised by the
    share of the page's text in the <article> or <main> around it, and for
    paths in the container (the path without its leaf) with the most
    score-weighted text (not through an <article> below it, as of a teaser);
    what has a name of furniture is not raised, nor is text in links.

    A nav, footer, aside, form, menu, dialog or page header is left out, and a
    name of furniture counts, unless the element holds an article or main; but
    for nav and footer also unless it holds over half of the text of a page
    that has no article or main. A name of furniture does not count either
    within the article or main for an element that holds the h1.
    """
    if not page:
        return ""
    found, elements = blocks(page)
    for leaf, text, _ in found:
        if leaf:
            leaf.size += len(text)
    for e in reversed(elements):
        if e.up:
            e.up.size += e.size
    whole = sum(len(text) for _, text, _ in found)
    plain = not any(e.size and e.tag in ("article", "main") for e in elements)

    def against(e: Element, by_tag: bool) -> bool:
        most = plain and 2 * e.size > whole and not (by_tag and e.tag in ("nav", "footer"))
        return not (e.holds or most or (not by_tag and e.inside and e.h1))
    # paths by number: the path without its leaf, the leaf, its length, and whether an element on it has a name of furniture
    numbers: dict[tuple[int, str], int] = {}
    paths: list[tuple[int, str, int, bool]] = [(0, "", 0, False)]
    for e in elements:
        e.dropped = bool(e.up and e.up.dropped) or e.aside and against(e, True)
        e.share = max(e.up.share if e.up else 0, e.size if e.tag in ("article", "main") else 0)
        up, name = e.up.path if e.up else 0, e.marked and against(e, False)
        e.path = numbers.setdefault((up, e.tag + "!" * name), len(paths))
        if e.path == len(paths):
            paths.append((up, e.tag, paths[up][2] + 1, paths[up][3] or name))
    found = [x for x in found if not (x[0] and x[0].dropped)]
    if not found:
        return ""
    whole = sum(len(text) for _, text, _ in found)
    sums: dict[int, list[float]] = {}
    for leaf, text, linked in found:
        share = leaf.share / whole if leaf else 0
        s = sums.setdefault(leaf.path if leaf else 0, [0.0] * 5)
        for i, v in enumerate((len(text), len(PUNCTUATION.findall(text)), 1, linked, len(text) * min(1.0, share))):
            s[i] += v
    a = np.array(list(sums.values()))
    score = np.log1p(_smooth(a[:, 0] / a[:, 2])) * (1 + np.log1p(_smooth(a[:, 1] / a[:, 2])))
    marked = np.array([paths[p][3] for p in sums])
    score *= np.where(marked, MARKED, 1.0)
    linked = np.where([paths[p][1] == "h1" and not paths[p][3] for p in sums], 0.0, a[:, 3] / a[:, 0])
    score *= 1 - LINKED * linked
    limit = float((score * a[:, 0]).sum() / a[:, 0].sum()) / 2
    weight: dict[int, float] = {}
    for (path, s), v in zip(sums.items(), score):
        weight[paths[path][0]] = weight.get(paths[path][0], 0.0) + v * s[0]
    best = max(weight, key=lambda k: (weight[k], -paths[k][2]))
    within = [False] * len(paths)
    for p, (up, tag, _, _) in enumerate(paths[1:], 1):
        within[p] = p == best or within[up] and tag != "article"
    raised = (1 + a[:, 4] / a[:, 0]) * np.where([within[p] for p in sums], HELD, 1.0)
    score *= np.where(marked, 1.0, 1 + (raised - 1) * (1 - linked))
    content = {p for p, v in zip(sums, score) if v >= limit}
    return "\n".join(text for leaf, text, _ in found if (leaf.path if leaf else 0) in content)


def extract_main_text(pages: DataFrame, source: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of the whole page in ``text`` and its code
    points in n_chars (input columns with these names are replaced).

    Map-only, page by page. A null or empty page, or one without text outside
    its furniture, gives an empty text. Blocks keep page order, repeated ones
    included.
    """
    def run(b):
        texts = [main_text(t) for t in column(b, source)]
        return [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
    return add_columns(pages, run, [(text, "string"), ("n_chars", "bigint")])
