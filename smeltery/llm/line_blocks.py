"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block of the page. A line's length counts the text outside
links. Lines of menus, headers, footers, sidebars, notices, adverts, forms and reader comments are
blank lines, as are lines outside the page's article where it marks one that holds the largest block
of text. Over all lines, the lengths in a window of a few lines are summed. Text starts where that
sum surges past a threshold and ends where it dives to nothing. The threshold is half the length of
the lines that hold half of the page's text, and at most ``SURGE``. Within a surge the lines that
reach the threshold themselves are its core, and every line between the first and the last of them
is kept, short ones too. Short lines before and after the core are kept from the first to the last
that stands in the same part of the page as a line of the core; an advert or footer that merely
touches the text is not. A line that repeats the page's title counts as one of ``SURGE`` characters.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import decoded, slices, text_bytes

WINDOW = 3
SURGE = 80

# Fixed values of HTML: elements without content, with raw content, and those that begin a new line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noframes iframe xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav noscript ol option p pre section select summary table tbody td template tfoot "
    "th thead tr ul".split()
)
# Blocks that are a line or an item of text, not a part of a page.
ITEMS = frozenset(
    "body caption center dd dt figcaption h1 h2 h3 h4 h5 h6 html legend li option p pre summary td th tr".split()
)
# Elements, roles and words of class or id that mark what is not the article.
DROPPED = frozenset(
    "head nav header footer aside form script style noscript template select option button "
    "textarea input label fieldset iframe object embed svg canvas dialog menu title audio video "
    "datalist".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar status".split()
)
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial adbox adsense banner sponsor "
    "sponsored promo promoted promotion nav navbar navigation navi menu submenu breadcrumb "
    "breadcrumbs pagination pager header masthead topbar footer bottombar sidebar sidenav rail "
    "aside widget widgets related recommended recommendations notice notices cookie cookies consent "
    "gdpr alert popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social comment comments commentlist discussion replies respond disqus".split()
)
# These words are common on containers of an article as well, and so mark nothing inside one.
ARTICLE_HEAD = frozenset({"header"})
# As a whole class or id these name what is not the page's own text, though it may outgrow that.
FOREIGN = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial adbox adsense sponsor sponsored "
    "cookie cookies consent gdpr newsletter comment comments commentlist discussion replies respond "
    "disqus".split()
)

_markup = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>?)",
    re.S,
)
_attribute = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_words = re.compile(r"[a-z0-9]+")


@dataclass
class Hint:
    """A class or id that hides an element, unless the element turns out to be the page's text."""

    foreign: bool
    shown: bool = False


@dataclass(frozen=True, eq=False)
class Part:
    """An element that holds blocks, with the one around it; alike parts are siblings of one tag."""

    tag: str
    around: Part | None

    def alike(self) -> tuple[int, str]:
        return id(self.around), self.tag


@dataclass
class Line:
    text: str
    length: int  # characters outside links
    dropped: bool
    in_article: bool
    part: Part | None = None  # None: directly in the body
    headline: bool = False  # says what the page's title says


@dataclass
class _Element:
    name: str
    at: int  # where its start tag stands
    hides: bool  # by name or role
    hint: Hint | None
    article: bool
    part: Part | None  # the innermost part at its content


class _Page:
    """Reads markup into lines; knows which open elements hide their content."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.read: list[tuple[Line, list[Hint]]] = []
        self.title = ""
        self.open: list[_Element] = []
        self.hidden = self.articles = self.links = 0
        self.text: list[str] = []
        self.linked: list[str] = []

    @property
    def part(self) -> Part | None:
        return self.open[-1].part if self.open else None

    def add(self, text: str) -> None:
        self.text.append(text)
        if self.links:
            self.linked.append(text)

    def flush(self) -> None:
        whole = " ".join("".join(self.text).split())
        if whole:
            linked = len(" ".join("".join(self.linked).split()))
            # A closed article's hidden state is that of the elements open now, as blocks flush
            # before an element opens or closes.
            inside = any(e.article for e in self.open)
            length = max(0, len(whole) - linked)
            line = Line(whole, length, self.hidden > 0, inside, self.part)
            self.read.append((line, [e.hint for e in self.open if e.hint]))
        self.text, self.linked = [], []

    def start(self, name: str, rest: str, at: int) -> None:
        if name in BLOCKS:
            self.flush()
        if name in ("article", "main") and not self.articles:
            self._leave_unclosed()
        if name == "main":
            for element in self.open:
                if element.hint:
                    element.hint.shown = True  # the main part is in no advert or sidebar
        if _empty(name, rest):
            if name in ("br", "hr", "img"):
                self.add(" ")
            return
        if name == "p":
            self._close_within("p", BLOCKS - {"p"})
        elif name in ("li", "dt", "dd", "option", "tr", "td", "th"):
            self._close_within(name, {"ul", "ol", "dl", "menu", "table", "select"})
        article = name in ("article", "main")
        hides = self._hides(name, rest)
        hint = None if hides else self._hint(name, rest)
        part = self.part
        if name in BLOCKS and name not in ITEMS:
            part = Part(f"{name} {rest.strip()}", part)
        self.open.append(_Element(name, at, hides, hint, article, part))
        self.hidden += hides
        self.articles += article and not hides and not hint
        self.links += name == "a"

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].name == name:
                self._pop_to(i)
                return
            if self.open[i].name in ("article", "main") and name not in ("body", "html", "div"):
                return  # a stray end tag does not close the article around it

    def _hides(self, name: str, rest: str) -> bool:
        if name in DROPPED:
            # The head of an article is part of it.
            return not (name == "header" and self.articles)
        if "=" not in rest or name in ("html", "body"):
            return False
        roles = (
            a or b or c for key, a, b, c in _attribute.findall(rest) if key.lower() == "role"
        )
        return any(role.lower().strip() in ROLES for role in roles)

    def _hint(self, name: str, rest: str) -> Hint | None:
        if "=" not in rest or name in ("html", "body"):
            return None
        names = [
            (a or b or c).lower()
            for key, a, b, c in _attribute.findall(rest)
            if key.lower() in ("class", "id")
        ]
        marks = {word for value in names for word in _words.findall(value)}
        if name in ("article", "main"):
            marks &= {"comment", "comments", "related", "sponsored", "advert", "ad"}
        else:
            marks &= HINTS - ARTICLE_HEAD if self.articles else HINTS
        foreign = any(not FOREIGN.isdisjoint(value.split()) for value in names)
        return Hint(foreign) if marks else None

    def _leave_unclosed(self) -> None:
        """An article does not begin within a menu, header or advert that was left open.

        End tags close the innermost element of their name, so where one is missing it is an element
        further out that stays open.
        """
        if not any(e.hides or e.hint for e in self.open):
            return
        left: set[str] = set()
        for i, e in enumerate(self.open):
            if e.at in self.never_closed:
                left.add(e.name)
            hides = e.hides or e.hint
            if hides and e.name in left and e.name not in ("form", "template", "noscript", "dialog"):
                self._pop_to(i)
                break
        else:
            # A form around the whole page is a container, not a form to fill in.
            for e in self.open:
                if e.name == "form":
                    e.hides, e.hint = False, None
            self.hidden = sum(e.hides for e in self.open)

    @cached_property
    def never_closed(self) -> set[int]:
        """Where the start tags stand that no end tag of their name belongs to."""
        begun: dict[str, list[int]] = defaultdict(list)
        for found in _tags(self.page):
            name = (found["name"] or "").lower()
            if found["end"]:
                del begun[name][-1:]
            elif not _empty(name, found["rest"] or ""):
                begun[name].append(found.start())
        return {at for starts in begun.values() for at in starts}

    def lines(self) -> list[Line]:
        """The lines read, without those of elements that hints hide.

        A hint does not hide an element that holds most of the page's text outside links, nor all
        the page has; adverts and comments named as such stay hidden beside an article or a surge.
        """
        kept = [(line, hints) for line, hints in self.read if not line.dropped]
        total = sum(line.length for line, _ in kept)
        held: Counter[int] = Counter()
        for line, hints in kept:
            held.update({id(hint): line.length for hint in hints})

        def seen() -> list[Line]:
            return [line for line, hints in kept if all(hint.shown for hint in hints)]

        marks = list({id(hint): hint for _, hints in kept for hint in hints}.values())
        for foreign in (False, True):
            if foreign and (
                any(x.in_article for x in seen()) or sum(x.length for x in seen()) >= SURGE
            ):
                break
            for hint in marks:
                if hint.foreign == foreign and 2 * held[id(hint)] > total:
                    hint.shown = True
        if not any(line.length or line.in_article for line in seen()):
            for hint in marks:
                hint.shown |= not hint.foreign
        for line, hints in kept:
            line.dropped = not all(hint.shown for hint in hints)
            line.headline = line.length > 0 and line.text == self.title
        return [line for line, _ in self.read]

    def _close_within(self, name: str, limits: frozenset[str] | set[str]) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].name == name:
                self._pop_to(i)
                return
            if self.open[i].name in limits:
                return

    def _pop_to(self, i: int) -> None:
        for e in self.open[i:]:
            self.hidden -= e.hides
            self.articles -= e.article and not e.hides and not e.hint
            self.links -= e.name == "a"
        del self.open[i:]


def _empty(name: str, rest: str) -> bool:
    return name in VOID or rest.endswith("/>") and name not in BLOCKS


def _tags(page: str) -> Iterator[re.Match[str]]:
    """Markup in order; of elements with raw content the start tag, and nothing of the content."""
    at = 0
    while (found := _markup.search(page, at)) is not None:
        yield found
        at = found.end()
        name = (found["name"] or "").lower()
        if name in RAW and not found["end"]:
            at = _raw_end(page, name, at)


def _raw_end(page: str, name: str, at: int) -> int:
    close = re.compile(rf"</{re.escape(name)}[^>]*>", re.I).search(page, at)
    return close.end() if close else len(page)


def page_lines(page: str) -> list[Line]:
    """The page's lines in order; character references decoded, white space made one blank."""
    read, at = _Page(page), 0
    for found in _tags(page):
        if found.start() > at:
            read.add(html.unescape(page[at : found.start()]))
        at = found.end()
        if found["name"] is None:
            continue
        name = found["name"].lower()
        if found["end"]:
            read.end(name)
        elif name in RAW:
            if name in BLOCKS:
                read.flush()
            end = _raw_end(page, name, at)
            if name == "title" and not read.title:
                read.title = " ".join(html.unescape(page[at:end].rpartition("</")[0]).split())
            at = end
        else:
            read.start(name, found["rest"], found.start())
    if at < len(page):
        read.add(html.unescape(page[at:]))
    read.flush()
    return read.lines()


def threshold(lengths: list[int], surge: int) -> int:
    """Half the length of the lines that hold half of the text, at most ``surge``, at least 1."""
    left = sum(lengths) / 2
    for length in sorted(lengths, reverse=True):
        left -= length
        if left <= 0:
            return max(1, min(surge, length // 2))
    return 1


def surges(lengths: list[int], window: int, level: int) -> list[tuple[int, int]]:
    """First line and the one after the last, of each surge of the window sums up to its dive.

    A surge begins with the first line that isn't blank of a window that sums up to ``level`` or
    more, or with the text that runs into it without a blank line, and ends before a blank window.
    """
    sums = [sum(lengths[i : i + window]) for i in range(len(lengths))]
    found, i = [], 0
    while i < len(sums):
        if sums[i] < level:
            i += 1
            continue
        first = end = i
        while end < len(sums) and sums[end] > 0:
            end += 1
        while lengths[first] == 0:
            first += 1
        while first > 0 and lengths[first - 1] > 0:
            first -= 1
        found.append((first, end))
        i = end
    return found


def bounds(
    lines: list[Line | None], lengths: list[int], first: int, end: int, window: int, level: int
) -> tuple[int, int]:
    """The lines of a surge that are kept, first and one after the last; ``None`` is a blank line.

    All between its first and last line of ``level`` and more, or of the surge where no line is so
    long. Beyond these, all up to the farthest line in the surge, or among fewer than ``window``
    lines of links beside it, that stands in a part of the page that directly holds one of those
    long lines, in a part within it or in a sibling of the same tag.
    """
    core = [i for i in range(first, end) if lengths[i] >= level]
    if not core:
        return first, end
    parts = {line.part for i in core if (line := lines[i])}
    alike = {part.alike() for part in parts if part}

    def joins(line: Line | None) -> bool:
        if line is None:
            return False
        part = line.part
        if part in parts:
            return True
        while part is not None:
            if part in parts or part.alike() in alike:
                return True
            part = part.around
        return False

    low, high = first, end
    while low > 0 and lines[low - 1] and lengths[low - 1] == 0:
        low -= 1
    while high < len(lines) and lines[high] and lengths[high] == 0:
        high += 1
    low = low if first - low < window else first
    high = high if high - end < window else end
    start = next((i for i in range(low, core[0]) if joins(lines[i])), core[0])
    stop = next((i for i in range(high - 1, core[-1], -1) if joins(lines[i])), core[-1])
    return start, stop + 1


def _lengths(lines: list[Line | None], surge: int) -> list[int]:
    return [max(x.length, surge * x.headline) if x else 0 for x in lines]


def largest_block(lines: list[Line], in_article: bool, window: int, level: int) -> int:
    """Characters of the largest block inside the page's articles, or outside them."""
    lengths: list[int] = []
    for line in lines:
        if line.in_article != in_article and not line.dropped:
            # No block goes on across text of the other side.
            lengths += [0] * window if any(lengths[-window:]) else []
        elif not line.dropped:
            lengths.append(line.length)
        elif lengths and lengths[-1]:
            lengths.append(0)
    return max((sum(lengths[a:b]) for a, b in surges(lengths, window, level)), default=0)


def kept_lines(lines: list[Line], window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines between each surge of the window sums and the dive that follows it."""
    marked = any(line.in_article and not line.dropped for line in lines)
    level = threshold(_lengths([x for x in lines if not x.dropped], surge), surge)
    # A marked article that does not hold the largest block is a teaser, not the page's story.
    marked = marked and largest_block(lines, True, window, level) >= largest_block(
        lines, False, window, level
    )
    read: list[Line | None] = []
    for line in lines:
        outside = line.dropped or marked and not line.in_article
        if outside and read and read[-1] is None:
            continue  # a run of lines that are not the article's is one blank line
        read.append(None if outside else line)
    lengths = _lengths(read, surge)
    if marked and not any(lengths):
        lengths = [1 if line else 0 for line in read]  # an article of nothing but links
    level = threshold(lengths, surge)
    kept: list[str] = []
    done = 0
    for first, end in surges(lengths, window, level):
        a, b = bounds(read, lengths, first, end, window, level)
        kept += [line.text for line in read[max(a, done) : b] if line]
        done = max(done, b)
    return kept


def main_text(page: str) -> str:
    return "\n".join(kept_lines(page_lines(page)))


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html"
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    One scan without a shuffle, a slice of pages in memory at a time. A missing page is an empty one
    and gives an empty text, as does a page without text. Repeated rows come back each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [main_text(decoded(page)) for page in part.column(2).to_pylist()]
            yield pa.record_batch(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        text_bytes(markup),
    )
    return rows.mapInArrow(run, "page_id BIGINT, url STRING, text STRING, n_chars BIGINT")
