"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides what it can
from where a block stands, its link density, its stop-word density and its
length; short and unclear blocks stay open. In the second pass each open block
takes the label of the nearest decided block of its region, the article or the
rest of the page.

Names, forms and articles are evidence that a page's dense, long, link-poor blocks
can overrule: an element that holds most of them is not aside for its name or for
being a form, and an article that holds few of them does not shut out the rest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

#: Share of a block's characters that stand in links, from which it is not text.
LINK_DENSITY = 0.5
#: Length from which a block can be decided, and stop-word shares for the rest of the page and the article.
LENGTH = 70
STOP_DENSITY, ARTICLE_DENSITY = 0.15, 0.08

# Elements without text of their own, and what ends a block.
UNSEEN = "script style noscript template textarea select option button iframe object svg annotation annotation-xml head title canvas audio video datalist"
BLOCKS = (
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li legend main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
)
#: Elements that hold no main text wherever they stand.
ASIDE = "nav aside footer menu dialog"
#: Elements that are so too, unless most of the page stands in them.
FORMS = "form fieldset"
#: Words of class, id and role values that name what is not main text.
NAMES = (
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup sidebar widget widgets menu nav navbar navigation "
    "breadcrumb breadcrumbs masthead header footer contentinfo complementary comment comments reply replies disqus respond "
    "discussion related recommended share sharing social login search copyright disclaimer toolbar pagination pager paywall"
)
#: Of these, names of what can be longer than the main text.
TALK = "comment comments reply replies disqus respond discussion"
#: Names that sections of an article may bear as well: there dense text overrules them, unless readers' talk stands in it.
SECTIONS = "discussion related notice notices"
#: Words that make a name tell of the page's layout or state instead.
SIGNS = (
    "has no not non with without is are hide hides hidden show shows layout template page type format single open closed "
    "active fixed sticky enabled disabled"
)
#: Frequent function words.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you "
    "were all her she there would their we him been has when who will no more if out so said what its about than into them can "
    "only other time new some could these two may first then do any like my now over such our your how also after many "
    "der die das und in zu den von mit ist des im für auf nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sich dem einen "
    "le la les de des et un une du en que qui dans pour pas sur au par plus avec ce il est sont ne se son mais ou nous vous "
    "el los las y del se un una por con no para es al lo como más pero sus le ha o este sí porque esta entre cuando su"
)

_UNSEEN, _BLOCKS, _ASIDE, _FORMS, _NAMES, _TALK, _SECTIONS, _SIGNS, _STOP = (
    frozenset(x.split()) for x in (UNSEEN, BLOCKS, ASIDE, FORMS, NAMES, TALK, SECTIONS, SIGNS, STOP_WORDS)
)
_OUTER = frozenset({"article", "main"})
#: Elements that can be left open or do not nest; a name on them counts up to the next block.
_LOOSE = frozenset("p h1 h2 h3 h4 h5 h6 dd dt tr td th thead tbody tfoot hr html body".split())

TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(script|style|textarea|title|noscript|template|iframe)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\"<>])*)>|<[!?/][^>]*>",
    re.S | re.I,
)
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"']+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
WORD = re.compile(r"[^\W\d_]+")


#: Strength of a mark: overruled by most of a page's dense text, or only where no dense text is left without it.
WEAK, STRONG = 1, 2


@dataclass
class Mark:
    """What tells that an element holds no main text; ``around`` is the next mark outside it, or -1.

    ``inner`` says that the element stands in an article.
    """

    around: int
    strength: int
    name: str
    inner: bool = False

    @property
    def words(self) -> set[str]:
        return _NAMES.intersection(re.split(r"[^a-z]+", self.name))


@dataclass
class Block:
    """A block's text, how much of it stands in links, and where it stands; ``mark`` is the innermost mark around it, or -1."""

    aside: bool
    inner: bool
    mark: int = -1
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def named_aside(attributes: str, outer: bool = False) -> tuple[int, str]:
    """The strongest name that tells that an element holds no main text, and its strength; 0 if there is none.

    A name that is wholly made of such words is a strong mark, and so is one of
    readers' talk; another one that holds such a word is weak, and so are all names
    of an article. A sign such as ``has`` turns a name into one of the page.
    """
    best = (0, "")
    for name in " ".join(v.strip("\"'") for v in NAMED.findall(attributes)).lower().split():
        parts = {w for w in re.split(r"[^a-z]+", name) if w}
        if parts & _NAMES and not parts & _SIGNS:
            whole = parts <= _NAMES or parts & _TALK
            best = max(best, (STRONG if whole and not outer else WEAK, re.sub(r"\d+", "", name)))
    return best


def blocks(page: str) -> tuple[list[Block], list[Mark]]:
    """The blocks of a page that hold text, in page order, and the marks in the order of their elements."""
    marks: list[Mark] = []
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, int]] = []  # element, whether it holds no main text, whether it is in an article, its mark
    places: dict[str, list[int]] = {}  # for each element its positions in the stack
    now, links, unseen, at = Block(False, False), 0, 0, 0

    def cut(depth: int) -> None:
        for gone, *_ in stack[depth:]:
            places[gone].pop()
        del stack[depth:]

    def marked(around: int, strength: int, name: str, inner: bool = False) -> int:
        if not strength:
            return around
        marks.append(Mark(around, strength, name, inner))
        return len(marks) - 1

    def place(hidden: bool = False, named: tuple[int, str] = (0, "")) -> Block:
        aside, inner, around = stack[-1][1:] if stack else (False, False, -1)
        return Block(aside or hidden, inner, marked(around, *named, inner))

    def add(raw: str) -> None:
        text = html.unescape(raw)
        if text and not unseen:
            now.parts.append(text)
            if links:
                now.linked += len("".join(text.split()))

    for tag in TAG.finditer(page):
        add(page[at : tag.start()])
        at = tag.end()
        closing, name = tag[2], (tag[3] or "").lower()
        if not name:
            continue
        if name == "br":
            now.parts.append(" ")
        elif name == "a":
            links = 0 if closing else 1
        elif name in _UNSEEN:
            unseen = max(0, unseen - 1) if closing else unseen + (not tag[4].rstrip().endswith("/"))
        elif name in _BLOCKS:
            out.append(now)
            links = unseen = 0
            hidden = not closing and bool(HIDDEN.search(tag[4]))
            if name in _LOOSE:
                now = place(hidden, (0, "") if closing else named_aside(tag[4]))
                continue
            if not closing:
                aside, inner, around = stack[-1][1:] if stack else (False, False, -1)
                if name == "li" and stack and stack[-1][0] == "li":
                    cut(len(stack) - 1)
                head = name == "header" and not inner
                mark = marked(around, *max(named_aside(tag[4], name in _OUTER), (WEAK * (name in _FORMS), name)), inner)
                places.setdefault(name, []).append(len(stack))
                stack.append((name, aside or head or hidden or name in _ASIDE, inner or name in _OUTER, mark))
            elif places.get(name):
                cut(places[name][-1])
            now = place()
    add(page[at:])
    out.append(now)
    return [b for b in out if b.text], marks


def linked_most(block: Block, text: str) -> bool:
    return block.linked > LINK_DENSITY * len("".join(text.split()))


def stop_density(text: str) -> float:
    words = WORD.findall(text.lower())
    return sum(w in _STOP for w in words) / max(1, len(words))


def weigh(found: list[Block], marks: list[Mark]) -> None:
    """Decide by the dense text of a page which marks hold, and whether its articles hold its text.

    A weak mark is overruled by an element that holds most of the dense text and
    most of all unlinked text, and the mark of an article's section by dense text in it. Where no dense text and no article is left without
    marks, so is a strong one, and at last any whose name most of that text bears. If the articles hold less than half
    of the dense text that is not aside, they are elements like others.
    """
    sizes = np.zeros((len(found), 2), np.int64)  # of each block all unlinked text, and the dense one
    for at, b in enumerate(found):
        text = b.text
        if not b.aside and not linked_most(b, text):
            sizes[at] = len(text), len(text) * (len(text) >= LENGTH and stop_density(text) >= ARTICLE_DENSITY)
    dense = np.flatnonzero(sizes[:, 1])
    within, named = np.zeros((len(marks), 2), np.int64), {m.name: np.zeros(2, np.int64) for m in marks}
    for at, b in enumerate(found):
        if b.mark >= 0:
            within[b.mark] += sizes[at]
            named[marks[b.mark].name] += sizes[at]
    for k in range(len(marks) - 1, -1, -1):
        if marks[k].around >= 0:
            within[marks[k].around] += within[k]
    talked = [False] * len(marks)  # whether readers' talk stands in the element
    for k in range(len(marks) - 1, -1, -1):
        own = marks[k].words & _TALK - _SECTIONS
        if marks[k].around >= 0 and (own or talked[k]):
            talked[marks[k].around] = True
    section = [
        m.inner and bool(m.words) and m.words <= _SECTIONS and not talked[k] and within[k][1] > 0 for k, m in enumerate(marks)
    ]
    least = sizes.sum(axis=0) / 2
    holds = [True] * len(marks) + [False]  # the last one is that of no mark
    for strength, by_name in ((WEAK, False), (STRONG, False), (STRONG, True)):
        for k, m in enumerate(marks):
            overruled = m.strength <= strength and ((within[k] > least).all() or by_name and (named[m.name] > least).all())
            holds[k] = holds[m.around] or not (overruled or section[k])
        if not len(dense) or not all(holds[found[at].mark] for at in dense):
            break
        if any(b.inner and not b.aside and not holds[b.mark] for b in found):
            break
    for b in found:
        b.aside = b.aside or holds[b.mark]
    left = sum(int(size) for b, (_, size) in zip(found, sizes, strict=True) if not b.aside)
    inner = sum(int(size) for b, (_, size) in zip(found, sizes, strict=True) if not b.aside and b.inner)
    if inner < left / 2:
        for b in found:
            b.inner = False


def first_label(block: Block, article: bool) -> bool | None:
    """Whether a block is main text, as far as the block alone tells; ``article`` says that the page has one."""
    text = block.text
    if block.aside or article and not block.inner:
        return False
    if linked_most(block, text):
        return False
    if not block.inner and "\N{COPYRIGHT SIGN}" in text and len(text) < 2 * LENGTH:
        return False
    if len(text) < LENGTH:
        return None
    return True if stop_density(text) >= (ARTICLE_DENSITY if block.inner else STOP_DENSITY) else None


def labels(found: list[Block], marks: list[Mark]) -> list[bool]:
    """The labels of a page's blocks after both passes.

    The second pass looks for the nearest decided block of the same region; of
    two equally near ones the one that is main text counts. A region without a
    decided block is main text if it is the article, or if the page has none.
    """
    weigh(found, marks)
    article = any(b.inner and not b.aside for b in found)
    first = [first_label(b, article) for b in found]
    before, after = _distances(found, first), _distances(found[::-1], first[::-1])[::-1]
    out = []
    for label, back, on in zip(first, before, after, strict=True):
        near = min((x for x in (back, on) if x is not None), default=(0, 0), key=lambda x: (x[0], x[1]))
        out.append(label if label is not None else near[1] == 0)
    return out


def _distances(found: list[Block], first: list[bool | None]) -> list[tuple[int, int] | None]:
    """For each block the distance to the last decided block of its region, and 0 where that is main text.

    A block that stands aside is no neighbour in the article: it interrupts the text without bounding it.
    """
    last: dict[bool, tuple[int, int]] = {}
    out = []
    for at, (block, label) in enumerate(zip(found, first, strict=True)):
        seen = last.get(block.inner)
        out.append(None if seen is None else (at - seen[0], seen[1]))
        if label is not None and not (block.aside and block.inner):
            last[block.inner] = (at, int(not label))
    return out


def main_text(page: str | None) -> str:
    """The main blocks of a page, one on a line; empty if there is none."""
    found, marks = blocks(page or "")
    return "\n".join(b.text for b, keep in zip(found, labels(found, marks), strict=True) if keep)


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_col`` and its length ``n_chars`` in code points.

    A null page counts as empty and has the empty text. Extra columns pass
    through, but for those named like a result column.
    """

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in batches:
            yield pa.array([main_text(x) for x in some.to_pylist()], pa.string())

    pages = without(pages, [out, "n_chars"], keep=[html_col])
    done = pages.withColumn(out, run(F.col(f"`{html_col}`")))
    return done.withColumn("n_chars", F.length(out).cast("long"))
