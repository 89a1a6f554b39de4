"""Main text of HTML pages by two passes over their blocks.

Method.  A page is cut into blocks at block-level tags.  The first pass judges
each block alone by its length, its link density and its share of stop words:
good, bad, or undecided (short, or near good).  The second pass settles undecided
blocks from the nearest decided ones on either side.  Parts that never hold an
article (menus, headers, footers, sidebars, forms, scripts, comments) are told
by their tags, roles and class names, and count as decided bad.  A name alone
is no proof: a named part that holds the page's article is read all the same.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm.common import map_batches, table

LANGUAGES = ("english", "french", "german", "spanish")
#: Blocks with a larger share of their characters in links are bad.
MAX_LINKS = 0.33
SHORT, LONG = 60, 160
STOP_LOW, STOP_HIGH = 0.10, 0.22

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
# Elements whose text is never shown as text.
_RAW = frozenset("script style noscript template svg math iframe object canvas textarea title head".split())
_SKIPPED = frozenset("nav header footer aside form button select menu dialog audio video map".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Class names, ids and roles of parts that are no article, as whole tokens:
# each hyphen part is one of these words or says only which or where.
_BOILERPLATE = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside widget widgets related recommended "
    "notice alert overlay modal subscribe subscription signup login search form share sharing social legal pagination pager tags toc skip "
    "complementary contentinfo dialog".split()
)
# The same, of parts that hold no article even where they hold the only text.
_NEVER = frozenset(
    "ad ads advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr popup newsletter "
    "comment comments respond replies reply disqus discussion copyright".split()
)
_WHICH = frozenset(
    "site global main top bottom left right primary secondary inner outer wrapper wrap container box bar block area section list links link "
    "buttons button icons posts articles stories items item policy thread text to content".split()
)
_TOKEN_PARTS = re.compile(r"[-_]+")


@dataclass
class Part:
    """An element whose name says it is no article."""

    around: int  # the named part it is in; 0 for none
    may_hold: bool  # whether it may hold an article all the same


@dataclass
class Block:
    text: str
    link_chars: int
    heading: bool
    boilerplate: bool
    inside_article: bool
    #: Innermost named part around it, and around its innermost article or
    #: main element; 0 for none.
    part: int = 0
    article_part: int = 0
    label: str = field(default="", compare=False)


class _Reader:
    """Collects blocks while the tags of a page pass by."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        # Name, starts a left-out part, starts a named part.
        self.open: list[tuple[str, bool, bool]] = []
        self.opened: Counter[str] = Counter()
        self.named: list[Part] = [Part(0, True)]  # all of the page, by number
        self.part = 0
        self.around: list[int] = []  # innermost named part around each open article
        self.parts: list[str] = []
        self.link_chars = self.links = self.left_out = self.articles = self.headings = 0

    def text(self, raw: str) -> None:
        clean = html.unescape(raw)
        if self.links:
            self.link_chars += len("".join(clean.split()))
        self.parts.append(clean)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(text, self.link_chars, self.headings > 0, self.left_out > 0, self.articles > 0, self.part, self.around[-1] if self.around else 0))
        self.parts, self.link_chars = [], 0

    def _count(self, name: str, left_out: bool, by: int) -> None:
        self.opened[name] += by
        self.links += by * (name == "a")
        self.articles += by * (name in ("article", "main"))
        self.headings += by * (name in _HEADINGS)
        self.left_out += by * left_out

    def start(self, name: str, tag: str) -> None:
        if name not in _INLINE:
            self.flush()
        elif name == "img":
            return
        if name in _VOID or tag.endswith("/>") and name not in ("p", "div"):
            return
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):  # closed by the next of its kind
            self._close_open(name, ("ul", "ol", "table", "dl", "div", "article", "section", "body", "blockquote"))
        inside_article = self.articles > 0 and name == "header"
        left_out = (name in _SKIPPED and not inside_article) or self._hidden(tag)
        words = frozenset() if left_out else self._named(name, tag)
        if words:
            self.named.append(Part(self.part, not words & _NEVER))
            self.part = len(self.named) - 1
        self.open.append((name, left_out, bool(words)))
        self._count(name, left_out, 1)
        if name in ("article", "main"):
            self.around.append(self.part)

    @staticmethod
    def _hidden(tag: str) -> bool:
        for key, value in _ATTRIBUTE.findall(tag):
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                return True
            if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        return False

    def _named(self, name: str, tag: str) -> frozenset[str]:
        """The telling words of the element's class, id and role."""
        if name in ("html", "body", "article", "main"):
            return frozenset()
        found: set[str] = set()
        for key, value in _ATTRIBUTE.findall(tag):
            if key.lower() in ("class", "id", "role"):
                for token in value.strip("\"'").lower().split():
                    words = {w for w in _TOKEN_PARTS.split(token) if w}
                    if token == "header" and self.articles:
                        continue  # like the element of that name
                    if words <= _BOILERPLATE | _NEVER | _WHICH:
                        found |= words - _WHICH
        return frozenset(found)

    def _close_open(self, name: str, walls: tuple[str, ...]) -> None:
        if not self.opened[name]:
            return
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == name:
                self._drop(depth)
                return
            if self.open[depth][0] in walls:
                return

    def _drop(self, depth: int) -> None:
        for name, left_out, named in reversed(self.open[depth:]):
            self._count(name, left_out, -1)
            if named:
                self.part = self.named[self.part].around
            if name in ("article", "main"):
                self.around.pop()
        del self.open[depth:]

    def end(self, name: str) -> None:
        if name not in _INLINE:
            self.flush()
        if not self.opened[name]:
            return
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == name:
                self._drop(depth)
                return
            # A stray inline end tag closes nothing beyond its block.
            if name in _INLINE and self.open[depth][0] not in _INLINE:
                return


class _Tags:
    """Finds the tags of a page in time linear to its length.

    A tag ends at the first ``>`` outside quotes.  Where it ends from a mark
    (``>`` or a quote) on is remembered, so tags that never end cost one look
    each and not the rest of the page.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.ends: dict[int, int] = {}  # mark to the end of its tag, -1 for none
        self.last_close = page.rfind(">")
        self.looked, self.mark = 0, -1  # no mark from the one to the other

    def _next_mark(self, at: int) -> int:
        if not self.looked <= at <= self.mark:
            found = _MARK.search(self.page, at)
            self.looked, self.mark = at, found.start() if found else len(self.page)
        return self.mark

    def _end(self, at: int) -> int:
        passed, size = [], len(self.page)
        while True:
            mark = self._next_mark(at)
            if mark == size:
                end = -1
                break
            if mark in self.ends:
                end = self.ends[mark]
                break
            passed.append(mark)
            if self.page[mark] == ">":
                end = mark + 1
                break
            close = self.page.find(self.page[mark], mark + 1)
            if close < 0:
                end = -1
                break
            at = close + 1
        for mark in passed:
            self.ends[mark] = end
        return end

    def after(self, at: int) -> tuple[int, int, str] | None:
        """Start, end and name of the next tag; comments and declarations
        have no name.  What never ends is text, but for comments."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>")):
                if page.startswith(opening, start):
                    close = page.find(closing, start + len(opening))
                    return start, close + 3 if close >= 0 else len(page), ""
            name = _NAME.match(page, start)
            if name:
                end = self._end(name.end())
                if end >= 0:
                    return start, end, name.group(1).lower()
            elif page[start + 1 : start + 2] in ("!", "?"):
                if start < self.last_close:
                    return start, page.index(">", start) + 1, ""
            at = start + 1
        return None


def _page(page: str) -> _Reader:
    """A reader that has seen the whole page; broken markup is read as it
    comes."""
    reader, tags, at, size = _Reader(), _Tags(page), 0, len(page)
    endless: set[str] = set()  # elements that are not closed any more
    while at < size:
        found = tags.after(at)
        if not found:
            reader.text(page[at:])
            break
        start, end, name = found
        if start > at:
            reader.text(page[at:start])
        tag, at = page[start:end], end
        if not name:
            continue
        if tag[1] == "/":
            reader.end(name)
        elif name in _RAW:
            if name == "head":
                continue
            reader.flush()
            close = None if name in endless else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if close:
                at = close.end()
            else:
                endless.add(name)
                at = size if name in ("script", "style") else at
        else:
            reader.start(name, tag)
    reader.flush()
    return reader


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in order."""
    return _page(page).blocks


def _first_pass(block: Block, stop_words: frozenset[str]) -> str:
    if block.boilerplate:
        return "bad"
    solid = len(block.text.replace(" ", ""))
    if block.link_chars > MAX_LINKS * solid:
        return "bad"
    words = block.text.lower().split()
    share = sum(w.strip(".,;:!?\"'()") in stop_words for w in words) / len(words)
    if len(block.text) < SHORT:
        # A line of copyright below a page without an article.
        return "bad" if "©" in block.text and not block.inside_article else "short"
    if share >= STOP_HIGH:
        return "good" if len(block.text) >= LONG else "near"
    if share >= STOP_LOW:
        return "near"
    return "near" if block.inside_article else "bad"


def _holders(blocks: list[Block], parts: list[Part], stop_words: frozenset[str]) -> list[bool]:
    """For each named part, whether it holds the page's article: text of an
    article or main element, or most of the page's good text, and no good text
    of an article or main element is outside."""
    labels = [_first_pass(b, stop_words) for b in blocks]
    wanted = "good" if "good" in labels else "near"
    chars, articles, below = ([0] * len(parts) for _ in range(3))
    for block, label in zip(blocks, labels, strict=True):
        if label == wanted:
            chars[block.part] += len(block.text)
            articles[block.part] += block.inside_article
            below[block.article_part] += 1  # an article in the part, not around it
    for number in range(len(parts) - 1, 0, -1):  # a part is numbered before those in it
        for sums in (chars, articles, below):
            sums[parts[number].around] += sums[number]
    return [
        (below[i] > 0 or (part.may_hold and 2 * chars[i] > chars[0])) and articles[i] == articles[0]
        for i, part in enumerate(parts)
    ]


def classify(blocks: list[Block], parts: list[Part], stop_words: frozenset[str]) -> None:
    """Sets ``label`` of each block to good or bad.

    An undecided block takes the label its nearest decided neighbours share.
    Where they differ, a near-good one is good, and so is a short one if the
    nearer neighbour (the following one on a tie, for headings) is good.
    Without any decided neighbour, near-good blocks and those inside an
    article are good.
    """
    if len(parts) > 1:
        read = _holders(blocks, parts, stop_words)
        read[0] = True
        for number in range(1, len(parts)):
            read[number] = read[number] and read[parts[number].around]
        for block in blocks:
            block.boilerplate |= not read[block.part]
    for block in blocks:
        block.label = _first_pass(block, stop_words)
    decided = [(i, b.label) for i, b in enumerate(blocks) if b.label in ("good", "bad")]
    final, k = [], 0
    for i, block in enumerate(blocks):
        while k < len(decided) and decided[k][0] < i:
            k += 1
        if block.label in ("good", "bad"):
            final.append(block.label)
            continue
        before, after = decided[k - 1] if k else None, decided[k] if k < len(decided) else None
        sides = {s[1] for s in (before, after) if s}
        if block.inside_article:
            # Inside an article only parts told by tags or links are no text.
            final.append("good")
        elif len(sides) == 1 and before and after:
            final.append(sides.pop())
        elif block.label == "near":
            final.append("good" if "good" in sides or not sides else "bad")
        elif not before or not after:
            final.append("bad")
        else:
            nearer = before if i - before[0] < after[0] - i else after
            final.append(nearer[1])
    for block, label in zip(blocks, final, strict=True):
        block.label = label


def main_text(page: str, stop_words: frozenset[str]) -> str:
    reader = _page(page)
    classify(reader.blocks, reader.named, stop_words)
    return " ".join(b.text for b in reader.blocks if b.label == "good")


def stop_word_list(spark: SparkSession, languages: tuple[str, ...] = LANGUAGES) -> frozenset[str]:
    """Spark's own lists."""
    return frozenset(w for name in languages for w in StopWordsRemover.loadDefaultStopWords(name))


def extract_text(pages: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row.

    NULL and empty pages, and pages without an article, have an empty text.
    Pages are read whole, in time linear to their length however broken their
    markup; repeated rows are read each; other columns are not read.  A short
    line with a copyright sign is left out only outside an article.
    """
    stop_words = stop_word_list(pages.sparkSession, languages)

    def work(ids: list, urls: list, documents: list) -> dict:
        texts = [main_text(d.decode(), stop_words) if d else "" for d in documents]
        return {"page_id": ids, "url": [u.decode() if u is not None else None for u in urls], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(pages.select("page_id", "url", "html"), "page_id bigint, url string, text string, n_chars bigint", work)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
