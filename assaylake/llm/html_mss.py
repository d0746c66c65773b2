"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative, the
more so the more often a tag of its kind stands outside the content of labelled
pages. The contiguous run of the highest sum, found in one scan, is the content
region; menus, adverts, forms and the like inside it are left out.

What is left out inside is decided for whole parts, elements whose kind or name speaks
against content, after the page is read: a part that wraps the page's content is none,
whatever its name, and neither is running text under a doubtful name.

Labelled pages are those that mark their content themselves (``article`` or
``main``); the weights learned from them serve all pages.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import batch_of, texts_of

#: Labelled pages to learn from, at the most, chosen by a hash of the id.
MOST_PAGES = 2000
#: Score of a word; of a tag that only occurs inside content; and what is added for one that never does.
WORD, TAG, OUTSIDE = 1.0, -0.1, -40.0
#: A word or tag of a part that is left out anyway.
LEFT_OUT = -0.05
#: Weight, in tags, of the first guess at the share outside content.
GUESS = 10.0

# ---- fixed values: HTML's elements ------------------------------------------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements inside a line of text; all others begin a new block.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: Elements whose content is no text of the page; the first ones run to the end of the page if not closed.
RAW = "script|style|textarea"
EMBEDDED = "noscript|template|svg|iframe|object|title|math|canvas|audio|video"
PARTS = set("nav aside footer header button select dialog menu fieldset option input".split())
CONTENT = ("article", "main")
# ---- end of fixed values ----------------------------------------------------

#: Words of a class, id or role that name a part which is not content, and words that may.
SURE = set(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored banner cookie cookies consent "
    "gdpr popup modal newsletter subscription menu nav navbar navigation breadcrumb breadcrumbs sidebar aside footer "
    "masthead comment comments commentlist reply replies disqus recommended recommendations widget widgets "
    "pagination pager complementary contentinfo hidden".split()
)
DOUBTFUL = set(
    "header notice notices alert overlay promo promotion subscribe signup login respond discussion share sharing "
    "social related toolbar copyright disclaimer search skip".split()
)
#: Words that turn a name into the state of something else.
STATES = set("has with without no is enabled disabled open opened closed on off".split())
#: A part under a doubtful name with more words than this, and less than this share of them in links, is running text.
PROSE_WORDS, PROSE_LINKS = 40, 0.3
#: An ``article`` or ``main`` with this share of a page's words marks its content.
MARK_SHARE = 0.25

#: First guess at the share of a tag's kind outside content.
GUESSES = {"article": 1.0, "main": 1.0, "body": 1.0, "html": 1.0, "head": 1.0, "section": 0.2, "div": 0.2}
INSIDE_GUESS = 0.005

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + RAW + r")(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<closed>svg|math)(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*+(?<=/)>"
    r"|<(?P<embedded>" + EMBEDDED + r")(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?</(?P=embedded)\s*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<[!?/][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

#: How sure it is that a part is no content.
CONTENT_PART, MAYBE, NAMED, ELEMENT, HIDDEN = range(5)


class Token(NamedTuple):
    """``kind`` of a tag, or "" of a text; ``out``: inside a part that is not content."""

    kind: str
    text: str
    out: bool
    marked: bool


class Part:
    """An element that may be no content, with what is inside it."""

    __slots__ = ("around", "sure", "words", "linked", "marked", "headed", "marks", "out")

    def __init__(self, around: Part | None, sure: int, marked: bool):
        self.around, self.sure, self.marked = around, sure, marked
        self.words = self.linked = 0
        self.headed = self.out = False
        self.marks: list[Part] = []


def attributes(text: str) -> dict[str, str]:
    """Names, in lower case, and values of a tag's attributes; the first of a name counts."""
    found: dict[str, str] = {}
    for name, value in _ATTR.findall(text):
        found.setdefault(name.lower(), value.strip("\"'") if value[:1] in "\"'" else value)
    return found


def _named(values: str, in_content: bool) -> int:
    """What the words of classes, ids and roles say of an element."""
    best = CONTENT_PART
    for name in values.split():
        words = [w.lower() for w in _PIECES.findall(name)]
        if in_content:
            words = [w for w in words if w != "header"]
        if len(words) > 1 and not STATES.isdisjoint(words):
            continue
        known = [w for w in words if w in SURE or w in DOUBTFUL]
        if known:
            best = max(best, NAMED if len(known) == len(words) or not SURE.isdisjoint(known) else MAYBE)
    return best


def _sure(name: str, attrs: str, in_content: bool) -> int:
    """How sure it is, by its tag alone, that an element is no content."""
    if name in ("html", "body"):
        return CONTENT_PART
    given = attributes(attrs) if attrs and attrs != "/" else {}
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or _HIDING.search(given.get("style", "")):
        return HIDDEN
    if name in PARTS and (name != "header" or not in_content):
        return ELEMENT
    by_name = _named(" ".join(given.get(a, "") for a in ("class", "id", "role")), in_content)
    if name == "form":
        return max(by_name, NAMED)
    return by_name if name not in CONTENT or by_name == NAMED else CONTENT_PART


def _decide(parts: list[Part], words: int, headings: int) -> None:
    """Which parts are left out; parts come after those around them.

    A named part is kept if it wraps the content: it holds an article or main that
    marks content, or the page's only heading of the first rank, or most of the page's
    words while no article does. Under a doubtful name marked content's running text is kept.
    """
    marked = any(2 * m.words > words for p in parts for m in p.marks)
    for p in parts:
        if p.sure in (MAYBE, NAMED):
            wraps = any(m.words >= MARK_SHARE * words for m in p.marks) or p.headed and headings == 1 and not p.marked
            most = 2 * p.words > words and not marked and not p.marked and (not headings or p.headed)
            prose = p.marked and p.words > PROSE_WORDS and p.linked < PROSE_LINKS * p.words
            p.out = not (wraps or most or p.sure == MAYBE and prose)
        else:
            p.out = p.sure >= ELEMENT
        p.out = p.out or p.around is not None and p.around.out


def tokens(html: str) -> Iterator[Token]:
    """Tags and texts of a page; scripts, styles, comments and the like are skipped.

    An element that is never closed ends with the one around it.
    """
    open_: list[tuple[str, Part | None, bool]] = []  # name, innermost part, within marked content
    found: list[tuple[str, str, Part | None, bool]] = []
    parts: list[Part] = []
    marks: list[tuple[str, Part]] = []  # open articles and mains
    words = links = headings = 0
    for m in _TOKEN.finditer(html):
        part, marked = (open_[-1][1], open_[-1][2]) if open_ else (None, False)
        if (text := m["text"]) is not None:
            n = len(text.split())
            if part is None or part.sure < ELEMENT:
                words += n
            at = part
            while at is not None:
                at.words, at.linked, at = at.words + n, at.linked + (n if links else 0), at.around
            for _, mark in marks:
                mark.words += n
            found.append(("", text, part, marked))
            continue
        if m["raw"] or m["closed"] or m["embedded"]:
            found.append(("raw", " ", part, marked))
            continue
        if not m["name"]:
            continue
        name = m["name"].lower()
        space = "" if name in INLINE else " "
        if m["close"]:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    # a part that is left out ends only with itself or what is around it
                    part, marked = open_[k][1], open_[k][2]
                    closed = [e[0] for e in open_[k:]]
                    links -= closed.count("a")
                    for _ in range(min(len(marks), sum(c in CONTENT for c in closed))):
                        marks.pop()
                    del open_[k:]
                    found.append(("/" + name, space, part, marked and name not in CONTENT))
                    break
            else:
                found.append(("/" + name, space, part, marked))
            continue
        if name == "h1":
            headings += 1
            at = part
            while at is not None:
                at.headed, at = True, at.around
        if sure := _sure(name, m["attrs"], marked):
            part = Part(part, sure, marked)
            parts.append(part)
        mark = name in CONTENT and not sure
        found.append((name, space, part, marked))
        if name not in VOID and not m["attrs"].endswith("/"):
            open_.append((name, part, marked or mark))
            links += name == "a"
            if name in CONTENT:
                own = Part(None, CONTENT_PART, marked)
                marks.append((name, own))
                at = part
                while mark and at is not None:
                    at.marks.append(own)
                    at = at.around
    _decide(parts, words, headings)
    for kind, text, part, marked in found:
        yield Token(kind, text, kind == "raw" or part is not None and part.out, marked)


def kind_counts(html: str) -> Counter:
    """(kind, inside content) of the tags of a page that marks its content; else none."""
    found = list(tokens(html))
    if not any(t.marked and not t.out for t in found):
        return Counter()
    return Counter((t.kind, t.marked) for t in found if t.kind and not t.out)


def tag_weights(counts: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Weight of each kind of tag from how often it is inside and outside content."""
    weights = {}
    for kind in {*counts, *GUESSES, *("/" + k for k in GUESSES)}:
        inside, outside = counts.get(kind, (0.0, 0.0))
        guess = GUESSES.get(kind.lstrip("/"), INSIDE_GUESS)
        weights[kind] = TAG + OUTSIDE * (outside + GUESS * guess) / (inside + outside + GUESS)
    return weights


def main_text(html: str, weights: dict[str, float]) -> str:
    """Text of the content region: blocks in page order, joined by one space."""
    unseen = TAG + OUTSIDE * INSIDE_GUESS
    found = list(tokens(html))
    best, best_span, total, begin = 0.0, (0, 0), 0.0, 0
    for k, t in enumerate(found):
        if t.kind:
            total += LEFT_OUT if t.out else weights.get(t.kind, unseen)
        else:
            total += (LEFT_OUT if t.out else WORD) * len(t.text.split())
        if total <= 0:
            total, begin = 0.0, k + 1
        elif total > best:
            best, best_span = total, (begin, k + 1)
    # references are decoded last, text by text: what they stand for is no markup
    kept = [unescape(t.text) if not t.kind else t.text for t in found[slice(*best_span)] if t.kind or not t.out]
    return " ".join("".join(kept).split())


def learn_weights(pages: DataFrame, most: int = MOST_PAGES) -> dict[str, float]:
    """Weights from at most ``most`` pages that mark their content."""
    schema = pa.schema([("kind", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for html in texts_of(batch.column(0)):
                total.update(kind_counts(html))
        kinds = sorted({k for k, _ in total})
        yield batch_of(schema, [kinds, [total[k, True] for k in kinds], [total[k, False] for k in kinds]])

    marked = pages.filter(F.col("html").rlike("(?i)<(article|main)[\\s>]")).select("page_id").distinct()
    chosen = marked.filter("page_id is not null").orderBy(F.xxhash64("page_id"), "page_id").limit(most)
    sample = pages.join(F.broadcast(chosen), "page_id").select(F.col("html").cast("string"))
    # the kinds of tags that some thousand pages use, an invented name each at worst
    rows = sample.mapInArrow(count, "kind string, inside long, outside long").groupBy("kind").agg(
        F.sum("inside").alias("inside"), F.sum("outside").alias("outside")
    ).filter("inside + outside >= 3").collect()
    return tag_weights({r["kind"]: (r["inside"], r["outside"]) for r in rows})


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Character references are decoded, white space becomes one space, nothing else
    is changed or cut. A null html is an empty one; a page without words outside
    menus and the like has the empty text. Rows with null ids or urls and repeated
    rows are extracted like others; other columns are not read. ``weights`` come
    from ``learn_weights``, by default of these pages.
    """
    weights = learn_weights(pages) if weights is None else weights
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, weights) for html in texts_of(batch.column(2))]
            yield batch_of(schema, [batch.column(0), batch.column(1), texts, [len(t) for t in texts]])

    columns = [F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")]
    return pages.select(columns).mapInArrow(read, "page_id long, url string, text string, n_chars long")
