"""Main text of web pages: the maximum-scoring run of words and tags.

A page becomes a sequence of words and tags.  Every item has a *kind*: a tag
by its name, a word by the element that encloses it.  Words score positive
and tags negative; words enclosed by an element that labelled pages keep
outside their article score negative too.  One linear scan (Kadane) finds
the contiguous run with the highest score; elements inside the run that are
no part of an article (menus, forms, adverts, comments, ...) are left out.
A class may also name furniture on an element that holds the article (``<div
class="no-comments">``): such an element is scanned on its own as well, and
if its best run, at a quarter of its score, is the page's best, neither it
nor an element around it is furniture.  An ``<h1>`` in the header of an article
is its title and stays.  A run that lies wholly in the page's only ``<article>``,
else only ``<main>``, is read in that element's bounds.  Of equal runs the one
that ends first is taken, of those the shortest.

Weights come from labelled pages: pages whose markup names their content
with exactly one ``<article>`` or ``<main>``.  For each kind, Spark counts
its items inside and outside that element over *all* labelled pages; the
weight is the log odds.  Kinds that occur in no labelled page fall back to
the fixed lists below.  The counts table has one row per kind: element
names and the class or id words of the fixed list, a closed set, so its
size does not grow with the corpus.

Text rules: character references are decoded, white space inside a block is
one space, blocks are trimmed, empty blocks dropped and the rest joined by
``\\n``.  Inline elements do not split words.  Null or empty html, and pages
without words, give an empty text.  Broken markup (unclosed elements, cut
pages) is read leniently; nothing is capped, and the time is linear in the page
however deep or broken it is.  Repeated rows are extracted one by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship

# Element names of the HTML standard by their role.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg",
       "select", "title", "canvas", "audio", "video"}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "head", "button", "menu", "dialog",
               "fieldset", "label", "input", "option"}
CONTENT = {"article", "main"}
WHOLE = CONTENT | {"html", "body"}  # never furniture, whatever their class says
BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "center", "dd", "details",
         "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1",
         "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "menu", "nav",
         "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
         "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
# Class, id and role words that name page furniture.
FURNITURE = {"ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb",
             "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright",
             "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar",
             "navigation", "newsletter", "notice", "notification", "pagination", "popup", "promo",
             "promoted", "related", "replies", "reply", "share", "sharing", "sidebar", "signup",
             "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
#: Share of a score that text inside an element of a furniture class keeps.
FURNITURE_SHARE = 0.25

# A tag, quotes counted after "=" only; and one read without regard to quotes.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTR = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _furniture(attrs: str) -> str:
    for m in _ATTR.finditer(attrs):
        for word in re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower()):
            if word in FURNITURE:
                return word
    return ""


def _markup(html: str) -> Iterator[tuple[str, re.Match | None, int]]:
    """Texts ``(text, None, end)`` and tags ``("", match, end)``; comments and
    declarations are left out.  A consumer may send the place to go on from.

    Every step reads on from where the last one ended, so a page is read once,
    whatever its markup: ``>`` is looked for only where one follows, and after
    the first tag that no ``>`` ends outside quotes, quotes are not counted.
    """
    pos = at = 0  # start of the pending text, place of the search
    last, tag = html.rfind(">"), _TAG
    while (at := html.find("<", at)) >= 0:
        m, text = None, ""
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4) + 3
        elif html.startswith("<![CDATA[", at):
            end = html.find("]]>", at + 9) + 3
            text = html[at + 9:end - 3 if end > 2 else None].replace("&", "&amp;")
        elif html.startswith(("<!", "<?"), at):
            end = html.find(">", at) + 1
        else:
            if at < last and (html[at + 1].isalpha() or html[at + 1] == "/"):
                m = tag.match(html, at)
                if m is None and tag is _TAG and _PLAIN_TAG.match(html, at):
                    tag = _PLAIN_TAG
                    m = tag.match(html, at)
            if m is None:  # a plain "<"
                at += 1
                continue
            end = m.end()
        if end < 3 and m is None:  # never closed
            end = len(html)
        if at > pos:
            yield html[pos:at], None, at
        if text:
            yield text, None, end
        elif m is not None:
            end = (yield "", m, end) or end
        pos = at = end
    if pos < len(html):
        yield html[pos:], None, len(html)


class _Open(NamedTuple):
    """An open element: the context its texts are in, whether they are in a
    link there, and its frame."""
    name: str
    ctx: str
    link: bool
    frame: int


def items(html: str) -> Iterator[tuple[str, str, str, int, str]]:
    """``(what, kind, text, frame, plain)`` in page order; ``what`` is open,
    close or text.

    A text's kind is ``word:<context>``: the nearest enclosing furniture or
    boilerplate element, else ``word:a`` inside a link, else ``word:text``;
    ``plain`` is its kind without furniture.  ``frame`` is 0, or the number of
    the nearest element of a furniture class; ``~frame`` inside a boilerplate
    element there.  An ``<h1>`` in the header of an ``<article>`` or ``<main>``
    is its title: it has the context and frame of that element.
    """
    top = _Open("", "", False, 0)
    stack: list[_Open] = []
    opened: Counter[str] = Counter()
    contents: list[_Open] = []  # open articles and mains
    endless: set[str] = set()   # raw elements whose end tag no longer comes
    frames, n, last = 0, len(html), html.rfind(">") + 1

    def pop():
        left = stack.pop()
        opened[left.name] -= 1
        if left.name in CONTENT:
            contents.pop()

    found = _markup(html)
    resume = None
    while True:
        try:
            text, m, pos = found.send(resume)
        except StopIteration:
            return
        resume = None
        near = stack[-1] if stack else top
        if m is None:
            plain = "word:a" if near.link else "word:text"
            yield "text", f"word:{near.ctx}" if near.ctx else plain, text, near.frame, plain
            continue
        name = m[2].lower()
        if m[1]:
            if opened[name]:
                while stack[-1].name != name:
                    pop()
                pop()
            kind = f"tag:{name}" if name in BLOCK | CONTENT else "tag:inline"
            yield "close", kind, name, stack[-1].frame if stack else 0, kind
            continue
        furniture = "" if name in WHOLE else _furniture(m[3])
        if furniture:
            kind, ctx = f"tag:.{furniture}", f".{furniture}"
        elif name in BOILERPLATE:
            kind, ctx = f"tag:{name}", name
        else:
            kind, ctx = (f"tag:{name}" if name in BLOCK | CONTENT | RAW else "tag:inline"), ""
        yield "open", kind, name, near.frame, kind
        if name in VOID or m[3].rstrip().endswith("/"):
            continue
        if name in RAW:  # its content is no markup: skip to its end tag
            end = None if name in endless else \
                re.compile(rf"</{re.escape(name)}\b[^>]*+>", re.I).search(html, pos, last)
            if end is None:
                endless.add(name)
            resume = end.end() if end else (n if name in ("script", "style") else pos)
            continue
        if name == "p":  # a new paragraph ends an open one
            while opened["p"] and stack[-1].name in ("p", "b", "i", "em", "strong", "span", "a", "u"):
                pop()
        near = stack[-1] if stack else top
        at = near.frame
        if name in BOILERPLATE and at >= 0:
            at = ~at
        elif furniture and at >= 0:
            frames += 1
            at = frames
        entry = _Open(name, ctx or near.ctx, name == "a" or (near.link and not ctx), at)
        if name == "h1" and not ctx and contents and near.ctx in ("header", ".header"):
            entry = contents[-1]._replace(name=name)
        stack.append(entry)
        opened[name] += 1
        if name in CONTENT:
            contents.append(entry)


def _label_counts(html: str) -> dict[str, list[int]] | None:
    """Items per kind [inside, outside] the page's only article, else None."""
    seq = list(items(html))
    for mark in ("article", "main"):
        opens = [i for i, (w, _, t, *_) in enumerate(seq) if w == "open" and t == mark]
        closes = [i for i, (w, _, t, *_) in enumerate(seq) if w == "close" and t == mark]
        if len(opens) == 1 and len(closes) == 1 and opens[0] < closes[0]:
            counts: dict[str, list[int]] = {}
            for i, (what, kind, text, _, _) in enumerate(seq):
                if what == "open" and text == mark or what == "close" and text == mark:
                    continue
                n = len(text.split()) if what == "text" else 1
                if n:
                    counts.setdefault(kind, [0, 0])[not opens[0] < i < closes[0]] += n
            return counts
    return None


def _count_batches(batches):
    import pyarrow as pa
    total: dict[str, list[int]] = {}
    for batch in batches:
        for html in batch.column(0).to_pylist():
            for kind, (a, b) in ((_label_counts(html) or {}) if html else {}).items():
                t = total.setdefault(kind, [0, 0])
                t[0] += a
                t[1] += b
    yield pa.RecordBatch.from_pylist(
        [{"kind": k, "inside": a, "outside": b} for k, (a, b) in total.items()],
        schema=pa.schema([("kind", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())]))


def prior(kind: str) -> float:
    """Weight of a kind that no labelled page shows."""
    what, name = kind.split(":", 1)
    if what == "word":
        return 1.0 if name == "text" else 0.3 if name == "a" else -2.0
    if name.startswith(".") or name in BOILERPLATE:
        return -6.0
    return -0.2


def fit_weights(pages: DataFrame, html: str = "html") -> dict[str, float]:
    """Log-odds weight of every kind, counted over all labelled pages.

    Words outside furniture stay positive and tags negative whatever the
    counts; word kinds never seen inside an article are negative.
    """
    ship()
    rows = (pages.select(html).mapInArrow(_count_batches, "kind string, inside long, outside long")
            .groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
            .collect())  # one row per kind: a closed set
    out = {}
    for kind, inside, outside in rows:
        odds = math.log((inside + 0.5) / (outside + 0.5))
        if kind.startswith("word:"):
            furniture = kind[5:].startswith(".") or kind[5:] in BOILERPLATE
            out[kind] = max(0.1, min(odds, 3.0)) if not furniture else max(-6.0, min(odds, -0.5))
        else:
            out[kind] = max(-9.0, min(odds - 2.0, -0.05))
    return out


class _Scan:
    """Kadane's scan over the items of one frame."""
    __slots__ = ("parent", "run", "at", "best", "start", "stop", "outside")

    def __init__(self, parent: int):
        self.parent, self.at, self.start, self.stop = parent, 0, 0, 0
        self.run = self.best = self.outside = 0.0

    def add(self, i: int, inside: float, outside: float) -> None:
        self.outside += outside  # what the frame weighs for the frames around it
        if self.run <= 0:
            self.run, self.at = 0.0, i
        self.run += inside
        if self.run > self.best:
            self.best, self.start, self.stop = self.run, self.at, i + 1


def extract_text(html: str | None, weights: dict[str, float]) -> str:
    """Text of the best-scoring run of one page."""
    if not html:
        return ""
    seq = list(items(html))
    marks = [(i, w) for i, (w, _, t, *_) in enumerate(seq) if t in CONTENT and w != "text"]

    def weight(kind: str) -> float:
        w = weights.get(kind)
        return prior(kind) if w is None else w

    # one scan; a run lies in one frame, and frames inside that one count as furniture
    scans = [_Scan(0)]
    live = [0]
    for i, (what, kind, text, frame, plain) in enumerate(seq):
        at = frame if frame >= 0 else ~frame
        while live[-1] > at:
            left = scans[live.pop()]
            scans[live[-1]].add(i, left.outside, left.outside)
        if live[-1] < at:
            scans += [_Scan(live[-1]) for _ in range(at + 1 - len(scans))]
            live.append(at)
        n = len(text.split()) if what == "text" else 1
        outside = -0.05 if what != "text" and text in CONTENT else weight(kind) * n
        inside = weight(plain) * n if what == "text" and frame >= 0 else outside
        scans[at].add(i, inside, outside)
    won = max(range(len(scans)), key=lambda f: (scans[f].best * (FURNITURE_SHARE if f else 1), -f))
    start, stop = scans[won].start, scans[won].stop
    shown = {0, won}  # the frame of the run and those around it
    while won:
        won = scans[won].parent
        shown.add(won)
    # A run that lies wholly in the only marked element is read in its bounds.
    opens = [i for i, w in marks if w == "open"]
    closes = [i for i, w in marks if w == "close"]
    if len(opens) == 1 and start < stop:
        end = closes[-1] if closes and closes[-1] > opens[0] else len(seq)
        if opens[0] < start and stop <= end:
            start, stop = opens[0], end
    blocks: list[str] = []
    line: list[str] = []

    def flush():
        text = " ".join(unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    for what, _, text, frame, _ in seq[start:stop]:
        if what == "text":
            if frame in shown:
                line.append(text)
        elif text in BLOCK or text in CONTENT:
            flush()
    flush()
    return "\n".join(blocks)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
            weights: dict[str, float] | None = None) -> DataFrame:
    """One row per page: ``key, url, text, n_chars`` (code points)."""
    ship()
    weights = fit_weights(pages, html) if weights is None else weights

    @F.pandas_udf("string")
    def text_of(col: pd.Series) -> pd.Series:
        return pd.Series([extract_text(h, weights) for h in col], dtype=object)

    return (pages.select(F.col(key), F.col(url), text_of(F.col(html)).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
