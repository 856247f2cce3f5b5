"""Main text of HTML pages by a maximum-scoring subsequence.

A page is a sequence of tokens: words, and tags with what they say about their element.
Words score positive and tags zero or negative, by log odds of being part of the main text
counted on labelled pages. The contiguous region with the greatest sum, found in one scan,
is the main text. A boilerplate element costs as much as one bad tag, whatever is in it, and
is left out of a region that spans it; within an article it costs nothing.

Pages that mark their main text themselves (one `article` or `main` element, or else one
with the role `main`) serve as labels, wherever such pages can be found; other pages are
scored with the weights learned from them. Words of class and id that those pages have
around or in their main text speak for an element, words that stand far from it against it.
Without labels, whole words that name boilerplate decide, not parts of words.

Edge cases: NULL, empty and tag-only pages give an empty text; markup may be broken: a head
without an end tag ends at the first tag or text of a body, open elements end with their
parent or the page, open boilerplate also where the main text starts, and a quote that
nothing closes is a sign like others. An input column `text` is replaced; others, whatever
their names, are kept. Repeated rows give equal results; pages are
read whole, in time that grows with their length; without labelled pages fixed weights are
taken.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages that weights are counted on: those with the smallest hashes.
SAMPLE = 2_000
#: Added to each count of a kind of token, inside and outside the main text.
SMOOTHING = 1.0
#: A word scores at least this and at most that; a tag is held to the bounds below it.
WORD_SCORE = (0.02, 0.5)
TAG_SCORE = (-12.0, 0.0)
DROPPED_SCORE = -3.0
UNSEEN_TAG = -0.3
#: Log odds of the words of class and id; from OUTSIDE down a word tells boilerplate.
NAME_SCORE = (-12.0, 12.0)
OUTSIDE = -3.0

# Names of elements by what they hold, and words in class and id attributes
# that tell boilerplate.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "head script style noscript template nav header footer aside form button select option "
    "textarea iframe object embed svg canvas dialog menu xmp noembed noframes audio video map".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
KEPT_INSIDE = frozenset("article main body html".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies disqus footer gdpr menu modal nav navbar "
    "navigation newsletter notice outbrain pager pagination popup promo promoted recommended "
    "related share sharing sidebar signup skip social sponsor sponsored subscribe taboola toolbar "
    "widget".split()
)
# Words that say nothing beside the name of boilerplate: "site-footer", "ad-box".
PLAIN_NAMES = frozenset(
    "site page main top bottom left right header section block box bar list links container wrapper "
    "slot unit area content button buttons form form-inline area posts articles link".split()
)
BOILERPLATE_ROLES = frozenset(
    "navigation banner complementary contentinfo search dialog alert alertdialog menu form".split()
)


HEAD_ONLY = frozenset("base link meta title style script noscript template head html".split())
# What no unclosed element of boilerplate holds: the main text, and behind lists of links any text.
STARTS_MAIN = frozenset("article main h1".split())
STARTS_TEXT = STARTS_MAIN | frozenset("p section header footer aside nav h2 h3 h4 h5 h6 table pre blockquote".split())
LINKS = frozenset("nav menu button select option svg canvas dialog object noscript template map audio video".split())

# Attributes are read as browsers do: only a quote right behind `=` opens a quoted value, and
# a quote that nothing closes is a sign like others. A tag or comment may end with the page.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+))?+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+))?+")
PARTS = re.compile(r"[-_]+")

@dataclass
class Piece:
    """A tag (name set) or a stretch of text; dropped: inside a boilerplate element."""

    name: str = ""
    close: bool = False
    kind: str = ""
    text: str = ""
    dropped: bool = False
    main: bool = False
    within: bool = False  # an element around is an article or the main one
    names: tuple[str, ...] = ()  # words of class and id
    around: tuple[int, ...] = ()  # of the main one: numbers of the pieces that open elements around


@dataclass
class Weights:
    word: float = 0.5
    tags: dict[str, float] = field(default_factory=dict)

    def of(self, piece: Piece) -> float:
        return self.tags.get(piece.kind, UNSEEN_TAG)

    def outside(self, names: tuple[str, ...]) -> bool:
        """Whether labelled pages have a word of class or id far from the main text, and
        none of the others near it."""
        odds = [self.tags[f".{name}"] for name in names if f".{name}" in self.tags]
        return bool(odds) and min(odds) <= OUTSIDE and max(odds) < 0


def _names_boilerplate(name: str) -> bool:
    """Whether a whole word of class or id names boilerplate, all parts of it."""
    if name in BOILERPLATE_NAMES:
        return True
    parts = PARTS.split(name)
    return any(x in BOILERPLATE_NAMES for x in parts) and all(x in BOILERPLATE_NAMES or x in PLAIN_NAMES for x in parts)


def _says(name: str, attrs: str, scores: Weights | None) -> tuple[bool, bool, tuple[str, ...]]:
    """Whether an element is boilerplate, whether it is marked as the main text, and the
    words of its class and id."""
    if name in DROPPED:
        return True, False, ()
    drop, main, names = False, name in ("article", "main"), []
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return False, main, ()
    seen = set()
    for key, value in ATTRIBUTE.findall(attrs):
        key = key.lower()
        if key in seen:
            continue  # the first of equal attributes counts
        seen.add(key)
        value = (value[1:-1] if value[:1] in ("'", '"') else value).lower()
        if key == "role":
            drop = drop or value in BOILERPLATE_ROLES
            main = main or value == "main"
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            drop = drop or name not in KEPT_INSIDE
        elif key in ("class", "id"):
            names += value.split()
    if name not in KEPT_INSIDE and not main:
        drop = drop or any(map(_names_boilerplate, names)) or (scores is not None and scores.outside(tuple(names)))
    return drop, main and not drop, tuple(names)


class _Around:
    """The elements around a place: their names, numbers, and whether they are boilerplate."""

    def __init__(self):
        self.open: list[tuple[str, int, bool]] = []
        self.number: Counter = Counter()
        self.dropping = 0

    def push(self, name: str, at: int, drop: bool = False) -> None:
        self.open.append((name, at, drop))
        self.number[name] += 1
        self.dropping += drop

    def cut(self, depth: int) -> None:
        """End all elements from this depth on."""
        for name, _, drop in self.open[depth:]:
            self.number[name] -= 1
            self.dropping -= drop
        del self.open[depth:]

    def within(self) -> bool:
        return self.number["article"] + self.number["main"] > 0

    def depth(self, name: str, beyond_blocks: bool) -> int | None:
        """Where the last open element of that name is; one beyond a block may not count."""
        if not self.number[name]:
            return None
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                return i
            if not beyond_blocks and self.open[i][0] in BLOCKS:
                return None
        return None

    def starts(self, name: str) -> None:
        """End what the start tag of an element ends: the head, and the same p or li."""
        if name not in HEAD_ONLY and self.number["head"]:
            self.cut(self.depth("head", True))
        depth = self.depth(name, False) if name in ("p", "li") else None
        if depth is not None:
            self.cut(depth)


def _tokens(page: str) -> Iterator[tuple[str, re.Match | None]]:
    """Texts, and tags, each as (text, tag) with one of the two."""
    at, end = 0, len(page)
    while at < end:
        match = TOKEN.search(page, at)
        stop = match.start() if match else end
        if stop > at:
            yield page[at:stop], None
        if not match:
            return
        at = match.end()
        if match["name"]:
            yield "", match
            name = match["name"].lower()
            if name in RAW and not match["close"]:  # up to its end tag there are no tags
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
                stop = close.start() if close else end
                if stop > at:
                    yield page[at:stop], None
                at = stop


def _unclosed(tokens: list[tuple[str, re.Match | None]]) -> set[int]:
    """Numbers of the start tags that no end tag of their own closes."""
    around, left = _Around(), set()
    for i, (_, tag) in enumerate(tokens):
        name = tag["name"].lower() if tag else ""
        if not name or name in VOID:
            continue
        if not tag["close"]:
            around.starts(name)
            around.push(name, i)
            left.add(i)
            continue
        depth = around.depth(name, name in BLOCKS)
        if depth is not None:
            left.discard(around.open[depth][1])
            around.cut(depth)
    return left


def pieces(page: str, scores: Weights | None = None) -> list[Piece]:
    """Tags and texts of a page in order, with the elements they stand in.

    Boilerplate that no end tag closes ends with its parent, or where the main text starts;
    behind lists of links any text ends it.
    """
    found: list[Piece] = []
    tokens = list(_tokens(page))
    unclosed = _unclosed(tokens)
    around = _Around()
    loose: list[tuple[int, str]] = []  # unclosed boilerplate around: depth, name
    for i, (text, tag) in enumerate(tokens):
        if tag is None:
            if around.open and around.open[-1][0] == "head" and not text.isspace():
                around.cut(len(around.open) - 1)
            found.append(Piece(text=text, dropped=around.dropping > 0))
            continue
        name = tag["name"].lower()
        if tag["close"]:
            inside = around.dropping > 0
            depth = around.depth(name, name in BLOCKS)
            if depth is not None:
                around.cut(depth)
            found.append(Piece(name=name, close=True, kind="/" + name, dropped=inside, within=around.within()))
            continue
        around.starts(name)
        drop, main, names = _says(name, tag["attrs"], scores)
        while loose and loose[-1][0] >= len(around.open):
            loose.pop()
        if main or name in STARTS_TEXT:
            for at, (depth, over) in enumerate(loose):
                if main or name in STARTS_MAIN or over in LINKS:
                    around.cut(depth)
                    del loose[at:]
                    break
        if name == "header":  # that of an article is part of it
            drop = not around.within()
        kind = f"{name}!" if drop and name not in DROPPED else name
        piece = Piece(
            name=name, kind=kind, dropped=around.dropping > 0 or drop, main=main, within=around.within(), names=names
        )
        if main:
            piece.around = tuple(x for _, x, _ in around.open)
        found.append(piece)
        if name in VOID:
            continue
        if drop and i in unclosed and name not in RAW and name != "head":
            loose.append((len(around.open), name))
        around.push(name, i, drop)
    return found


def _main_span(found: list[Piece]) -> tuple[int, int] | None:
    """Pieces of the one element that is marked as the main text."""
    starts = [i for i, x in enumerate(found) if x.main and not x.dropped]
    if len(starts) != 1:
        return None
    start, depth = starts[0], 0
    name = found[start].name
    for i in range(start + 1, len(found)):
        if found[i].name == name:
            depth += -1 if found[i].close else 1
            if depth < 0:
                return start + 1, i
    return start + 1, len(found)


def counts(page: str | None) -> Counter:
    """Times of each kind of token (kind, inside) if the page marks its main text."""
    found = pieces(page or "")
    span = _main_span(found)
    told: Counter = Counter()
    if span is None:
        return told
    around = frozenset(found[span[0] - 1].around)
    for i, piece in enumerate(found):
        inside = span[0] <= i < span[1]
        if not piece.dropped:
            told[piece.kind, inside] += 1 if piece.name else len(piece.text.split())
            near = inside or i == span[0] - 1 or i in around
            for name in set(piece.names):
                told[f".{name}", near] += 1
    return told


def weights(told: dict[tuple[str, bool], int]) -> Weights:
    """Log odds of kinds of tokens; the empty kind is a word."""
    if not told:
        return Weights()
    total = {side: sum(n for (_, s), n in told.items() if s == side) + SMOOTHING for side in (True, False)}

    def odds(kind: str, low: float, high: float) -> float:
        inside, outside = (told.get((kind, side), 0) + SMOOTHING for side in (True, False))
        if kind:  # tags: seen more often outside or inside
            return min(high, max(low, math.log(inside / outside)))
        return min(high, max(low, math.log(inside / total[True]) - math.log(outside / total[False])))

    bounds = {False: TAG_SCORE, True: NAME_SCORE}
    tags = {kind: odds(kind, *bounds[kind[0] == "."]) for kind in sorted({k for k, _ in told if k})}
    return Weights(odds("", *WORD_SCORE), tags)


def fit(pages: DataFrame, number: int = SAMPLE, key: str = "page_id", source: str = "html") -> Weights:
    """Weights counted on at most `number` pages that mark their main text."""

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, s, n) for page in batch["page"] for (k, s), n in counts(page).items()]
            yield pd.DataFrame(rows, columns=["kind", "inside", "n"])

    marked = pages.where(F.lower(source).rlike(r"<(article|main)[\s>]|role=.?main"))
    ids = marked.select(key).where(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key).limit(number)
    chosen = pages.join(F.broadcast(ids), key, "left_semi").select(F.col(source).alias("page"))  # `number` ids
    names = (F.length("kind") <= 24) & F.col("kind").rlike(r"^/?[a-z][a-z0-9]*!?$|^\.[a-z][a-z0-9_-]*$|^$")
    total = chosen.mapInPandas(told, "kind string, inside boolean, n long").where(names)
    total = total.groupBy("kind", "inside").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "kind").limit(1000)
    return weights({(row["kind"], row["inside"]): row["n"] for row in total.collect()})


def _region(found: list[Piece], scores: Weights) -> tuple[int, int]:
    """Pieces of the region with the greatest sum; the earliest and shortest of equals."""
    best, best_at, total, start, dropped = 0.0, (0, 0), 0.0, 0, False
    for i, piece in enumerate(found):
        if piece.dropped:
            total += 0.0 if dropped or piece.within else DROPPED_SCORE
        elif piece.name:
            total += scores.of(piece)
        else:
            total += len(piece.text.split()) * scores.word
        dropped = piece.dropped
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best + 1e-9:
            best, best_at = total, (start, i + 1)
    return best_at


def extract(page: str | None, scores: Weights) -> str:
    """Main text, its blocks joined by newlines."""
    found = pieces(page or "", scores)
    start, stop = _region(found, scores)
    blocks: list[str] = []
    now: list[str] = []
    for piece in found[start:stop]:
        if piece.name in BLOCKS:
            blocks.append("".join(now))
            now = []
        elif piece.name == "br":
            now.append(" ")
        elif not piece.name and not piece.dropped:
            now.append(piece.text)
    blocks.append("".join(now))
    clean = (" ".join(html.unescape(block).split()) for block in blocks)
    return "\n".join(block for block in clean if block)


def with_text(pages: DataFrame, scores: Weights, source: str = "html") -> DataFrame:
    """Pages with `text`, their main text."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract(page, scores) for page in batch], dtype="object")

    return pages.withColumn("text", text(F.col(source)))
