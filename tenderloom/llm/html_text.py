"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of tags and text runs.  Tags score negative; words score
positive, but for those in elements that labelled pages show outside the
article.  One linear scan finds the contiguous region with the highest sum.

All weights are log-odds of lying inside the article, learned from labelled
pages, for tags and for the classes, ids and roles they carry; labelled pages
are those whose markup names the article by ``article`` or ``main``, and these
two tags themselves score nothing.  Weights come from a bounded sample
(``SAMPLE_PAGES``) and are a bounded table (``FEATURES``).

What such pages can't teach, since they hardly show it, is which elements
inside the article are none of it: from the chosen region's text, elements are
left out by fixed lists of tags and names.  Only where there are no labelled pages
do these lists take part in the scan.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prepared_tasks

SAMPLE_PAGES = 2000
FEATURES = 1000

# Fixed values of HTML: elements without end, elements whose content is not markup, blocks.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript noembed noframes xmp template svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
# Elements that are not the article.
OUTSIDE = frozenset("nav header footer aside form script style noscript template head title svg math iframe noembed noframes button select textarea input dialog menu canvas object audio video map xmp".split())
# Of those, elements whose content is never shown as text.
HIDDEN = frozenset("script style template head title noscript noembed noframes iframe svg math canvas object xmp textarea".split())
# Names that classes, ids and roles give to what is not the article: whole ones, and words that may stand beside them.
# A name with any other word in it, such as post-header or related-work, says nothing.
NAMES = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner menu menubar nav navbar navigation breadcrumb breadcrumbs "
    "sidebar header footer masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login comment comments "
    "disqus reply replies respond discussion share sharing social related recommended recommendations widget complementary contentinfo search toolbar pagination pager skip".split()
)
BESIDE = frozenset(
    "site page global top bottom left right main primary secondary upper lower box block section wrap wrapper container inner outer area list item items bar panel slot unit "
    "links buttons icons user reader readers visitor facebook google policy message text title form thread count box row col column group module links".split()
)

_open = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_stop = re.compile(r"[>\"']")
_attribute = re.compile(r"(?:^|\s)(class|id|role|aria-label|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_name = re.compile(r"[a-z]+(?:[^a-z\s]+[a-z]+)*")
_hump = re.compile(r"(?<=[a-z])(?=[A-Z])")
_part = re.compile(r"[a-z]+")
_zeros = re.compile(r"&#([xX]?)00+(?=[0-9a-fA-F])")
_number = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")
_word = re.compile(r"\S+")
_space = re.compile(r"\s+")

#: Weights of tags that the labelled pages don't show: those that articles are written with, and others.
WRITTEN = frozenset("h1 h2 h3 h4 h5 h6 p br hr blockquote pre ul ol li dl dt dd table thead tbody tr td th figure figcaption".split()) | INLINE
UNSEEN_WRITTEN, UNSEEN = -0.02, -1.0
WORD = 1.0
LEAST, MOST = -30.0, -0.02  # of learned tags
DARK = -2.0  # a word in an element that is none of the article


def outside(tag: str, attributes: str) -> bool:
    """Whether an element is none of the article, by its tag or by a class, id or role that is a name of such elements as a whole."""
    if tag in OUTSIDE:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for m in _attribute.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name in ("class", "id", "role"):
            for one in _name.findall(_hump.sub("-", value).lower()):
                parts = set(_part.findall(one))
                if parts & NAMES and parts <= NAMES | BESIDE:
                    return True
    return False


def features(tag: str, attributes: str) -> str:
    """The words of an element's class, id and role, as names of weights, blank between; a few at most."""
    found = []
    for m in _attribute.finditer(attributes) if attributes else ():
        name = m[1].lower()
        if name in ("class", "id", "role"):
            found += [f"{name}:{w[:40]}" for w in (m[2] or m[3] or m[4] or "").lower().split()[:4]]
    return " ".join(found[:8])


def tags(page: str) -> Iterator[tuple[int, int, str, bool, str, bool]]:
    """Start, end, name, whether it closes, attributes of each tag, and whether what lies between it and its fellow is no markup.

    Comments and declarations have no name.

    One pass: what was not found ahead of one place is not looked for again
    from a later one.  A tag ends at the next ``>`` outside quotes.  Once a
    quote has run to the end of the page, quotes count no more.  Where no
    ``>`` follows, ``<`` is text.
    """
    at, quotes, unended = 0, True, set()
    while True:
        start = page.find("<", at)
        if start < 0:
            return
        if page.startswith(("<!", "<?"), start):
            mark = "-->" if page.startswith("<!--", start) else "]]>" if page.startswith("<![CDATA[", start) else ">"
            end = page.find(mark, start + 2)
            at = len(page) if end < 0 else end + len(mark)
            yield start, at, "", False, "", False
            continue
        m = _open.match(page, start)
        if not m or ">" in unended:
            at = start + 1
            continue
        end, look = -1, m.end()
        while quotes:
            stop = _stop.search(page, look)
            if not stop:
                quotes = False
            elif stop[0] == ">":
                end = stop.start()
                break
            else:
                close = page.find(stop[0], stop.end())
                if close < 0:
                    quotes = False
                look = close + 1
        if end < 0:
            end = page.find(">", m.end())
        if end < 0:
            unended.add(">")
            at = start + 1
            continue
        name, attributes = m[2].lower(), page[m.end() : end]
        at = end + 1
        close, end = None, -1
        if not m[1] and name in RAW and name not in unended and not attributes.rstrip().endswith("/"):
            close = _raw_end(name).search(page, at)
            end = page.find(">", close.end()) if close else -1
            if end < 0:
                unended.add(name)
        yield start, at, name, bool(m[1]), attributes, end >= 0
        if end >= 0:
            at = end + 1
            yield close.start(), at, name, True, "", True


@cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?![^\s/>])", re.IGNORECASE)


def pieces(page: str) -> list[tuple[str, str, str, int]]:
    """(kind, name, text, out) of each tag and text run; kind: "open", "close", "text".

    The text of an opening tag is its ``features``.  out: 1 in an element that
    is outside by the lists, 2 in one that is not shown, else 0.
    """
    out, at, skip, depth, level = [], 0, None, 0, 0
    for start, end, name, closing, attributes, raw in tags(page):
        if start > at and not (raw and closing):
            out.append(("text", "", page[at:start], level))
        at = end
        if not name:
            continue
        if raw:
            out.append(("close" if closing else "open", name, "", 2))
            continue
        if skip is not None:
            if name in ("article", "main") and not closing and skip not in ("article", "main"):
                skip, level = None, 0  # an element that was never closed does not hold the article
            elif name == skip:
                depth += -1 if closing else 1
                if depth == 0:
                    out.append(("close", name, "", level))
                    skip, level = None, 0
                    continue
        elif not closing and name not in VOID and outside(name, attributes) and not attributes.rstrip().endswith("/"):
            skip, depth, level = name, 1, 2 if name in HIDDEN else 1
        out.append(("close" if closing else "open", name, "" if closing else features(name, attributes), level))
    if at < len(page):
        out.append(("text", "", page[at:], level))
    return out


class Inside:
    """Which weights decide about words at a place: those of the innermost open element that has some."""

    def __init__(self, known):
        self.known, self.open = known, []

    def step(self, kind: str, name: str, text: str) -> None:
        if kind == "close":
            for k in range(len(self.open) - 1, max(-1, len(self.open) - 65), -1):  # a closing tag far from its opening one closes nothing
                if self.open[k][0] == name:
                    del self.open[k:]
                    break
        elif name not in VOID:
            # tags that articles are written with say nothing about the words in them
            own = [f for f in text.split() if self.known(f)] or ([name] if name not in WRITTEN and self.known(name) else [])
            self.open.append((name, own or (self.open[-1][1] if self.open else [])))

    def names(self) -> list[str]:
        return self.open[-1][1] if self.open else []


def scores(parts: list[tuple[str, str, str, int]], weights: dict[str, float]) -> list[float]:
    """What each part adds to the sum of a region.

    With learned weights only what is not shown scores nothing.  Without, all
    that is outside by the lists, and tags in a marked article cost what those
    cost that articles are written with.
    """
    word, learned, out, marks = weights.get("word", WORD), "learned" in weights, [], 0
    where = Inside(lambda f: f"in {f}" in weights or learned and f in OUTSIDE)
    for kind, name, text, dark in parts:
        if dark == 2 or dark and not learned:
            out.append(0.0)
        elif kind == "text":
            own = [weights.get(f"in {f}", DARK) for f in where.names()] if learned else []
            out.append(len(_word.findall(text)) * (min(own) if own else word))
        elif name in ("article", "main"):
            marks = marks + 1 if kind == "open" else max(0, marks - 1)
            out.append(0.0)
        else:
            where.step(kind, name, text)
            own = [weights[f] for f in (name, *text.split()) if f in weights] if kind == "open" else []
            value = min(own) if own else weights.get(name, UNSEEN_WRITTEN if name in WRITTEN else UNSEEN)
            if learned and name in WRITTEN and not text:
                value = max(value, 25 * UNSEEN_WRITTEN)  # an article may have lists where the labelled ones have none
            elif not learned and marks:
                value = max(value, UNSEEN_WRITTEN)
            out.append(value)
    return out


def region(parts: list[tuple[str, str, str, int]], weights: dict[str, float]) -> tuple[int, int]:
    """[start, end) of the parts with the highest sum; (0, 0) if no sum is positive.  Of ties the first."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, value in enumerate(scores(parts, weights)):
        if total <= 0:
            total, start = 0.0, i
        total += value
        if total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def main_text(page: str, weights: dict[str, float]) -> str:
    """The article's blocks, one a line."""
    parts = pieces(page)
    a, b = region(parts, weights)
    blocks, own = [], []

    def close():
        # numbers beyond all code points, however long
        plain = _number.sub("\ufffd", _zeros.sub(r"&#\1", "".join(own)))
        text = _space.sub(" ", html_lib.unescape(plain)).strip()
        own.clear()
        if text:
            blocks.append(text)

    for kind, name, text, dark in parts[a:b]:
        if kind == "text":
            if not dark:
                own.append(text)
        elif name in BLOCKS:
            close()
        elif name == "br":
            own.append(" ")
    close()
    return "\n".join(blocks)


def learn_weights(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", sample_pages: int = SAMPLE_PAGES) -> dict[str, float]:
    """Log-odds of words and tags inside the article; tags are held below zero, words outside shown elements above.

    Keys: tags and features (``class:x``); ``in`` one of these, for words in
    such elements; ``word`` for all others.  Labelled pages are those with an
    ``article`` or ``main`` element; of them the ``sample_pages`` with the
    smallest hash of the id are counted, and all others of the same id.  Tags
    that HTML knows and the most frequent features are kept, so the table is
    bounded.  Empty without labelled pages: then the defaults hold.
    """
    prepared_tasks(pages.sparkSession)
    known = VOID | RAW | BLOCKS | INLINE | OUTSIDE
    hashed = pages.select(F.xxhash64(id_col).alias("h"), F.col(html_col).cast("string").alias("html"))
    article = F.col("html").rlike("(?i)<(article|main)[\\s>]")
    # the largest of the smallest hashes; only hashes move
    last = hashed.filter(article).select("h").orderBy("h").limit(sample_pages).agg(F.max("h")).first()[0]
    if last is None:
        return {}
    sample = hashed.filter((F.col("h") <= last) & article).select("html")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                depth, where = 0, Inside(lambda f: True)
                for kind, name, text, dark in pieces(page):
                    if name in ("article", "main"):
                        depth = max(0, depth + (1 if kind == "open" else -1))
                    elif dark == 2:
                        continue
                    elif kind == "text":
                        n = len(_word.findall(text))
                        total["word", depth > 0] += n
                        for f in where.names():
                            total[f"in {f}", depth > 0] += n
                    else:
                        where.step(kind, name, text)
                        for f in (name, *text.split()):
                            if ":" in f or name in known:
                                total[f, depth > 0] += 1
        yield pa.record_batch([pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.bool_()), pa.array(list(total.values()), pa.int64())], ["name", "inside", "n"])

    n = lambda inside: F.sum(F.when(F.col("inside") == inside, F.col("n")).otherwise(0))
    found = sample.mapInArrow(counted, "name string, inside boolean, n long").groupBy("name").agg(n(True).alias("a"), n(False).alias("b"))
    out = {"learned": 1.0}
    for r in found.orderBy(F.desc(F.col("a") + F.col("b")), "name").limit(FEATURES).collect():
        odds = math.log((r["a"] + 1) / (r["b"] + 1))
        if r["name"] == "word":
            out["word"] = max(0.5, odds)
        elif r["name"].startswith("in "):
            if odds < 0:
                out[r["name"]] = max(DARK, odds)
        else:
            out[r["name"]] = min(MOST, max(LEAST, 3 * (odds - 1)))
    return out


def extract(pages: DataFrame, weights: dict[str, float], html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (its code points) instead of ``html_col``.

    Null or empty pages, and pages without a region of positive sum, have the
    empty text.  Repeated rows are read each.  A page costs time in proportion
    to its length, however malformed.  Columns named text or n_chars are
    replaced.  No shuffle (``learn_weights`` reads the pages before, and moves
    hashes and counts).
    """
    prepared_tasks(pages.sparkSession)

    @F.pandas_udf("string")
    def text_of(html):
        return html.map(lambda x: main_text(x, weights) if x else "")

    out = pages.drop("text", "n_chars") if html_col != "text" else pages.drop("n_chars")
    out = out.withColumn("text", text_of(F.col(html_col).cast("string")))
    out = out if html_col == "text" else out.drop(html_col)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
