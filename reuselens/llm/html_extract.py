"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events once. Each block (what
stands between two block borders: block tags, ``br``) is one line with its
text, the number of tags in it, and the open containers around it.  Lines in
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments, known by tag or role, are never content, nor are those
known by class or id. A class or id tells by its first or last word, words
from one like ``has`` or ``no`` on left out. The ratios below, taken over such
lines as well, overrule the name of a container (no ``article``) that holds
``HOLD`` of the page's high-ratio text, all of it where the name is one of
remarks or teasers, at ``PROSE`` characters per tag or more.

The other lines' ratios (characters per tag) are smoothed by a Gaussian and
cut in two clusters; the lines of the upper cluster vote, with their length,
for the containers around them.  The content region is all ``article``
elements with such lines (or ones at ``PROSE``), else all such ``main`` elements, else the deepest container that still holds ``HOLD`` of all votes.  Every
line of the region is kept, however short.

Defined results: null or empty html, or a page without content lines, gives
an empty text; references are decoded; white space in a line becomes one
space; lines are joined by one ``\\n`` in page order; unclosed and misnested
tags are closed where their parent ends; repeated pages give repeated rows.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0
RADIUS = 2
HOLD = 0.75
PROSE = 30

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option "
    "p pre section select summary table tbody td template tfoot th thead title tr ul".split())
NEVER = frozenset(
    "nav footer aside form script style noscript template iframe object svg canvas button select textarea dialog "
    "head title menu datalist".split())
CONTAINER = frozenset("body main article section div td center details blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCK - {"br", "html", "body", "head", "title", "option"}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar "
                  "toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsbygoogle sponsor sponsored sponsors promo "
    "promos promotion banner banners cookie cookies consent gdpr notice notices notification notifications alert "
    "alerts popup modal overlay newsletter subscribe subscription signup login share sharing social nav navbar "
    "navigation menu menus breadcrumb breadcrumbs sidebar sidebars side aside widget widgets related recommended "
    "recommendations teaser teasers footer foot header masthead topbar comment comments commentlist discussion "
    "replies reply respond disqus toolbar pagination pager skip search form copyright disclaimer".split())
TITLED = frozenset(["header", "masthead"])
REMARKS = frozenset("comment comments commentlist discussion replies reply teaser teasers related ad ads advert promo "
                    "sponsored".split())
STATES = frozenset("has have with without no not non is show hide".split())
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _named(attrs: dict) -> set[str]:
    """The first and last word of each class and id, up to a word of state."""
    out = set()
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        words = [w.lower() for w in TOKEN.findall(name)]
        states = [i for i, w in enumerate(words) if w in STATES]
        words = words[:states[0]] if states else words
        out.update(words[:1] + words[-1:])
    return out


class Lines(HTMLParser):
    """Collects ``(text, tags, containers, named)`` of the lines that may be
    content; ``named``: those of the containers that are hidden by name."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, ...], tuple[int, ...]]] = []
        self.kinds = ["root"]            # tag of each container, by number
        self.named: dict[int, bool] = {}  # containers hidden by name, and whether as remarks
        self.open: list[tuple[str, bool, bool, int | None]] = []  # tag, hidden, heading only, container
        self.text: list[str] = []
        self.tags = 0

    def _flush(self):
        if self.text:
            line = " ".join("".join(self.text).split())
            if line:
                around = tuple(c for _, _, _, c in self.open if c is not None)
                self.lines.append((line, self.tags, (0, *around), tuple(c for c in around if c in self.named)))
            self.text = []
        self.tags = 0

    def _hides(self, tag: str, attrs: dict) -> tuple[bool, bool, set[str]]:
        """Whether an element hides what is in it, wholly or but for headings;
        and the names by which alone it hides it wholly."""
        hidden, titled = self._known(tag, attrs)
        if not hidden or tag not in CONTAINER or tag == "article" or self._known(tag, {**attrs, "class": "", "id": ""})[0]:
            return hidden, titled, set()
        return False, False, _named(attrs) & NAMES

    def _known(self, tag: str, attrs: dict) -> tuple[bool, bool]:
        if tag in NEVER or attrs.get("role", "") in ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True, False
        if "display:none" in (attrs.get("style") or "").replace(" ", ""):
            return True, False
        names = _named(attrs) if "class" in attrs or "id" in attrs else set()
        if tag in ("html", "body", "main"):
            return False, False
        if tag == "article":
            return bool(names & REMARKS), False
        inside = any(t in ("article", "main") for t, _, _, _ in self.open)
        if tag == "header" or names & TITLED:
            rest = names & (NAMES - TITLED)
            return (True, False) if not inside or rest else (False, True)
        return bool(names & NAMES), False

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            if tag in CLOSES_P:
                self._close_p()
            self._flush()
        self.tags += 1
        if tag in VOID:
            return
        attrs = {k: v or "" for k, v in attrs}
        hidden, titled, names = self._hides(tag, attrs)
        if self.open:
            _, was_hidden, was_titled, _ = self.open[-1]
            hidden, titled = hidden or was_hidden, titled or was_titled
        number = None
        if tag in CONTAINER:
            number = len(self.kinds)
            self.kinds.append(tag)
            if names:
                self.named[number] = bool(names & REMARKS)
        self.open.append((tag, hidden, titled, number))

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:  # <div/> opens an element in HTML
            self.handle_starttag(tag, attrs)

    def _close_p(self):
        for i in range(len(self.open) - 1, -1, -1):
            tag = self.open[i][0]
            if tag == "p":
                self._flush()
                del self.open[i:]
                return
            if tag in BLOCK:
                return

    def handle_endtag(self, tag):
        if tag in VOID:
            if tag == "br":
                self._flush()
            return
        if tag in BLOCK:
            self._flush()
        self.tags += 1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return
            if self.open[i][0] in ("article", "main", "body", "td") and tag not in ("body", "html", "main", "article"):
                return  # a stray end tag doesn't close what holds it

    def handle_data(self, data):
        if self.open:
            _, hidden, titled, _ = self.open[-1]
            if hidden or titled and not any(t in HEADINGS for t, _, _, _ in self.open):
                return
        self.text.append(data)

    def unknown_decl(self, data):
        """CDATA and the like are no text."""


def smooth(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing; the border values go on beyond the ends."""
    at = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-at ** 2 / (2 * SIGMA ** 2))
    return np.convolve(np.pad(ratios, RADIUS, mode="edge"), kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """Border between two clusters (means with least squares on a line); equal
    values are one cluster."""
    low, high = values.min(), values.max()
    for _ in range(32):
        border = (low + high) / 2
        upper = values >= border
        if upper.all():
            return float(low)
        new = values[~upper].mean(), values[upper].mean()
        if new == (low, high):
            break
        low, high = new
    return float((low + high) / 2)


def clusters(lines: list) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line's smoothed ratio is in the upper cluster, and whether
    it's there or at ``PROSE`` or more."""
    smoothed = smooth(np.array([len(line[0]) / max(1, line[1]) for line in lines]))
    border = threshold(smoothed)
    return smoothed >= border, smoothed >= min(border, PROSE)


def unnamed(lines: list, named: dict[int, bool]) -> list:
    """The lines but those hidden by a name that the ratios don't overrule."""
    if not any(line[3] for line in lines):
        return lines
    high = clusters(lines)[1]
    total, votes = 0, dict.fromkeys(named, 0)
    for line, yes in zip(lines, high, strict=True):
        if yes and len(line[0]) >= PROSE * line[1]:
            total += len(line[0])
            for c in line[3]:
                votes[c] += len(line[0])
    shown = {c for c, v in votes.items() if v and v >= (1 if named[c] else HOLD) * total}
    return [line for line in lines if shown.issuperset(line[3])]


def main_text(html: str) -> str:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser._flush()
    lines = unnamed(parser.lines, parser.named)
    if not lines:
        return ""
    votes: dict[int, int] = {}
    named: set[int] = set()                  # containers with content lines
    for (text, _, around, _), yes, prose in zip(lines, *clusters(lines), strict=True):
        if prose:
            named.update(around)
        if yes:
            for c in around:
                votes[c] = votes.get(c, 0) + len(text)
    region = {c for c in named if parser.kinds[c] == "article"} or {c for c in named if parser.kinds[c] == "main"}
    if not region:
        region = {max(c for c, v in votes.items() if v >= HOLD * votes[0])}
    return "\n".join(t for t, _, around, _ in lines if not region.isdisjoint(around))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py() or "") for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    return pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(html).cast("string").alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
