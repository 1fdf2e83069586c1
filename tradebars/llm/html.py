"""Main-text extraction from web pages by a maximum-scoring subsequence.

A page is a sequence of tokens: words, told apart by the element they stand in, and tags. Each token's score is the
logarithm of how much likelier it is within the main text than outside; words of running text come out positive, tags of
menus and frames negative. The contiguous stretch with the greatest sum, found in one linear scan (`best_stretch`), is
the content region. It is completed to the element that holds it: the one marked as content, or else the innermost container
around all its blocks, or the one around that which is named so. Every block there is kept, whatever its own weight, but for those in a frame: an element that its
tag, or the words of its class, id or role, name as menu, header, footer, sidebar, notice, advert, form or comments.
Where a page marks its article, words outside the mark score as frame.

Class words condemn less than tags do. A class such as `post tags-ai`, of which one name says content, is no frame, nor
is `has-sidebar`, which tells of another element. Where no marked article lies outside of frames, an element that only
its class (or `form`) condemns is pardoned if it holds a marked article or most words of the page. Within a marked article,
a section that only its class condemns is pardoned by its score: if it has a heading and its tokens sum to more than
`PARDON` words of a paragraph do, with what frames it holds left out. Comments and related articles are never pardoned. Headings in the `header` of an article are its title and stay.

Weights are fitted on labelled pages: those that mark their main text themselves (`article`, `main` or an articleBody
property) label their tokens. Counts are gathered by a Spark aggregation over a bounded sample of such pages, on top of
pseudo-counts for elements and class names whose use is settled by convention.

Defined results: a null or empty page, or one without a positive stretch, has the empty text; unclosed elements end with
the page or where HTML implies their end; a truncated tag is dropped; repeated rows are extracted each; other columns play
no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages that the weights are fitted on at most: those of the least hash.
SAMPLE = 4000

#: Elements by how they are shown, and class, id and role words.
HIDDEN = ("script", "style", "noscript", "template", "svg", "iframe", "title", "textarea", "select", "object", "canvas")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul button label".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
FRAME = frozenset("aside dialog fieldset footer header menu nav button label".split())
FRAME_WORDS = frozenset("ad ads adbox advert advertisement banner breadcrumb breadcrumbs cookie consent disclaimer footer form header login menu modal nav navbar navigation newsletter notice overlay pager pagination popup promo promoted promotion share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget".split())
FRAME_ROLES = frozenset("alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
OTHERS_WORDS = frozenset("comment comments disqus recommended related replies reply respond".split())
CONTENT_WORDS = frozenset("article articlebody body content entry main post story text".split())
STATE_WORDS = frozenset("has is no with without".split())
#: An open element of the first kind ends where one of the second begins, unless the third stands between.
IMPLIED_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)), "tr": (("tr", "td", "th"), ("table",)),
    "tbody": (("thead", "tbody", "tr"), ("table",)), "tfoot": (("thead", "tbody", "tr"), ("table",)),
}
PSEUDO = 200.0
#: Words of running text that a section's score must be worth to outweigh a class that names it as a frame.
PARDON = 40

_ATTRIBUTES = r"""((?>[^>"']+|"[^"]*"|'[^']*')*)"""
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<svg\b[^>]*/>|<({"|".join(HIDDEN)})\b(?>[^>"']+|"[^"]*"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*){_ATTRIBUTES}(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|([^<]+|<)""",
    re.S | re.I,
)
_HINT = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
NONE, SOFT, HARD = 0, 1, 2


def judge(tag: str, attributes: str) -> tuple[int, bool, bool]:
    """Whether the element is a frame (NONE, SOFT: by its words only, HARD), whether it is marked as content, and whether one of
    its names says content."""
    frame = HARD if tag in FRAME else SOFT if tag == "form" else NONE
    marked = tag in ("article", "main")
    if "=" not in attributes or tag in ("html", "body"):
        return frame, marked, False
    named: list[list[str]] = []
    for m in _HINT.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role" and value.lower() in FRAME_ROLES:
            frame = max(frame, SOFT)
        named += [parts for token in value.split() if (parts := _PART.findall(_CAMEL.sub(" ", token).lower())) and parts[0] not in STATE_WORDS]
    marked |= any("articlebody" in parts or {"article", "body"} <= set(parts) for parts in named)
    content = any(all(p in CONTENT_WORDS for p in parts) for parts in named)
    if tag == "main":
        return frame, marked, content
    for parts in named:
        others = OTHERS_WORDS.intersection(parts)
        if others and (tag != "article" or parts[0] in OTHERS_WORDS and all(p in OTHERS_WORDS or p in CONTENT_WORDS for p in parts)) and (parts[0] in others or parts[-1] in others):
            return HARD, marked, content
    if tag != "article":
        if any(FRAME_WORDS.intersection(parts) and (not content or all(p in FRAME_WORDS for p in parts)) for parts in named):
            frame = max(frame, SOFT)
    return frame, marked, content


Token = tuple[str, int]


class Page:
    """Tokens of a page in order, as (type, count), and the blocks of text: (token, element, text)."""

    def __init__(self, source: str):
        self.blocks: list[tuple[int, int, str]] = []
        self.parents, self.tags, self.frames, self.marks, self.named = [0], ["body"], [NONE], [False], [False]
        self._tokens: list[tuple[str, int, int]] = []  # a tag, or "" for words; how many; the element
        self._held: list[str] = []
        self._open = [0]
        for m in _TOKEN.finditer(source):
            if m[8] is not None:
                self._held.append(m[8])
            elif m[3] is not None:
                self._tag(m[3].lower(), bool(m[2]), m[4])
            elif m[6] is not None:
                self._tag(m[6].lower(), bool(m[5]), m[7])
        self._flush()
        self._settle()

    def _flush(self) -> None:
        if self._held:
            words = unescape("".join(self._held)).split()
            self._held = []
            if words:
                self.blocks.append((len(self._tokens), self._open[-1], " ".join(words)))
                self._tokens.append(("", len(words), self._open[-1]))

    def _close(self, kinds: tuple[str, ...], borders: tuple[str, ...] | frozenset[str]) -> None:
        """End the outermost open element of the kinds this side of the borders, with all in it."""
        found = None
        for place in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[place]]
            if tag in kinds:
                found = place
            elif tag in borders:
                break
        if found is not None:
            del self._open[found:]

    def _tag(self, tag: str, closing: bool, attributes: str) -> None:
        block = tag in BLOCK
        if block:
            self._flush()
        if closing:
            at = next((i for i in range(len(self._open) - 1, 0, -1) if self.tags[self._open[i]] == tag or (not block and self.tags[self._open[i]] in BLOCK)), None)
            element = self._open[-1]
            if at is not None and self.tags[self._open[at]] == tag:
                if not block and self.frames[self._open[at]]:
                    self._flush()
                element = self._open[at]
                del self._open[at:]
            self._tokens.append((tag, 1, element))
            return
        if block and tag not in ("br", "hr"):
            self._close(("p",), BLOCK - {"p"})
            if tag in IMPLIED_ENDS:
                self._close(*IMPLIED_ENDS[tag])
        if tag in VOID:
            self._tokens.append((tag, 1, self._open[-1]))
            return
        if not block and any(self.tags[e] in ("pre", "code") for e in self._open[-3:]):
            frame, marked, named = NONE, False, False
        else:
            frame, marked, named = judge(tag, attributes)
        if frame and not block:
            self._flush()
        self.parents.append(self._open[-1])
        self.tags.append(tag)
        self.frames.append(frame)
        self.marks.append(marked)
        self.named.append(named)
        self._open.append(len(self.tags) - 1)
        self._tokens.append((tag, 1, self._open[-1]))

    def _settle(self) -> None:
        """Which elements lie in a frame, after pardons, and in which marked element, if any."""
        n = len(self.tags)
        hard, soft = [False] * n, [False] * n
        for e in range(n):
            p = self.parents[e]
            hard[e] = (e > 0 and hard[p]) or self.frames[e] == HARD
            soft[e] = (e > 0 and soft[p]) or self.frames[e] == SOFT
        frames = list(self.frames)
        if not any(self.marks[e] and not hard[e] and not soft[e] for e in range(n)):
            held = [0] * n
            for at, e, _ in self.blocks:
                if not hard[e]:
                    held[e] += self._tokens[at][1]
            inner = [self.marks[e] and not hard[e] and not self.frames[e] for e in range(n)]
            total = sum(held)
            for e in range(n - 1, 0, -1):
                held[self.parents[e]] += held[e]
                inner[self.parents[e]] |= inner[e]
            for e in range(n):
                if frames[e] == SOFT and (inner[e] or 2 * held[e] > total and not any(inner)):
                    frames[e] = NONE
        self._own = frames
        self._spread()

    def _spread(self) -> None:
        """Carry frames and marks down to the elements in them."""
        n = len(self.tags)
        frames = self._own
        self.framed = [False] * n
        self.region = [-1] * n  # the outermost element marked as content around each
        title = [False] * n
        for e in range(n):
            p = self.parents[e]
            if e:
                self.region[e] = self.region[p]
                title[e] = title[p]
            own = frames[e] != NONE
            if e and self.tags[e] in HEADINGS and self.tags[p] in ("header", "hgroup", "div") and self.region[e] >= 0 and self.framed[p] and not title[p]:
                title[e] = self._heads_article(p)
            self.framed[e] = own or (e > 0 and self.framed[p] and not title[e])
            if self.marks[e] and not self.framed[e] and self.region[e] < 0:
                self.region[e] = e
        self.marked = any(r >= 0 for r in self.region)

    def pardon(self, weight: dict[str, float]) -> None:
        """Lift the frame of sections of a marked article whose own score says that they are text of it."""
        n = len(self.tags)
        least = PARDON * weight.get("word@p", 0.0)
        if least <= 0 or not any(self._condemned(e) for e in range(1, n)):
            return
        total, headed = [0.0] * n, [False] * n
        for tag, count, e in self._tokens:
            total[e] += count * weight.get("<" + tag if tag else "word@" + self._leaf(e), weight[""])
            headed[e] |= tag in HEADINGS
        for e in range(n - 1, 0, -1):
            if self._own[e] == NONE:
                total[self.parents[e]] += total[e]
                headed[self.parents[e]] |= headed[e]
        kept = [e for e in range(1, n) if self._condemned(e) and headed[e] and total[e] > least]
        for e in kept:
            self._own[e] = NONE
        if kept:
            self._spread()

    def _condemned(self, e: int) -> bool:
        """Whether only its class makes this section of a marked article a frame."""
        p = self.parents[e]
        return self._own[e] == SOFT and self.tags[e] in ("section", "div") and self.region[p] >= 0 and not self.framed[p]

    def _heads_article(self, e: int) -> bool:
        """Whether this is the header of an article in no other frame."""
        while self.tags[e] in ("div", "hgroup") and self.frames[e] == NONE:
            e = self.parents[e]
        return self.tags[e] == "header" and self.frames[e] == HARD and not self.framed[self.parents[e]]

    def _leaf(self, e: int) -> str:
        while e:
            tag = self.tags[e]
            if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "td", "li", "pre", "blockquote"):
                return tag
            if tag in BLOCK:
                break
            e = self.parents[e]
        return "other"

    def tokens(self, outside_is_frame: bool = True) -> list[Token]:
        """The tokens by type. In pages that mark their article, words outside it count as frame, but not in the fit."""
        out = []
        for tag, n, e in self._tokens:
            if tag:
                own = self._own[e] if self.tags[e] == tag else NONE
                out.append(("<frame" if own and self.framed[e] else "<content" if self.marks[e] and self.tags[e] == tag else "<" + tag, n))
            elif self.framed[e] or (outside_is_frame and self.marked and self.region[e] < 0):
                out.append(("word@frame", n))
            else:
                out.append(("word@" + self._leaf(e), n))
        return out

    def inside(self) -> list[bool]:
        """Of each token, whether it lies in an element marked as content and in no frame; the label of the fit."""
        return [self.region[e] >= 0 and not self.framed[e] and not (self.region[e] == e and tag) for tag, _, e in self._tokens]

    def _around(self, elements: list[int]) -> int:
        """The innermost container around all, or one around that whose name says content; 0 where it is the body."""
        path = []
        e = elements[0]
        while e:
            path.append(e)
            e = self.parents[e]
        place = {e: i for i, e in enumerate(path)}
        at = 0
        for e in elements[1:]:
            while e and e not in place:
                e = self.parents[e]
            at = max(at, place.get(e, len(path)))
        path = [e for e in path[at:] if self.tags[e] not in ("html", "body")]
        named = [e for e in path if self.named[e]]
        return (named or [e for e in path if self.tags[e] in ("div", "section", "td", "center", "form")] or [0])[0]

    def text(self, first: int, last: int) -> str:
        """The blocks of the region that the stretch of tokens lies in, without those in frames."""
        open_blocks = [(at, e, text) for at, e, text in self.blocks if not self.framed[e]]
        core = [(at, e) for at, e, _ in open_blocks if first <= at < last]
        if not core:
            return ""
        regions = {self.region[e] for _, e in core} - {-1}
        around = 0 if regions else self._around([e for _, e in core])
        within = [False] * len(self.tags)
        for e in range(1, len(self.tags)):
            within[e] = within[self.parents[e]] or e in regions or (around > 0 and e == around)
        begin = core[0][0]
        if not regions and not around:  # the body itself: headings right before the stretch belong to it
            for at, e, _ in reversed([b for b in open_blocks if b[0] < begin]):
                if self._leaf(e) not in HEADINGS:
                    break
                begin = at
        return " ".join(text for at, e, text in open_blocks if within[e] or (not regions and begin <= at <= core[-1][0]))


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """First and last + 1 of the contiguous stretch of greatest sum, the first of equals; (0, 0) if none is positive."""
    best = total = 0.0
    begin, span = 0, (0, 0)
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, span = total, (begin, i + 1)
    return span


#: Pseudo-counts (inside, outside) by token type.
PRIOR = {
    "word@p": (30, 3), "word@h1": (3, 1), "word@h2": (3, 1), "word@h3": (3, 1), "word@pre": (3, 1), "word@blockquote": (3, 1), "word@td": (1, 1), "word@li": (1, 2), "word@other": (2, 2), "word@frame": (0.01, 20),
    "<p": (3, 0.5), "<b": (1, 0.5), "<i": (1, 0.5), "<em": (1, 0.5), "<strong": (1, 0.5), "<br": (1, 0.5), "<h1": (1, 1), "<h2": (1, 1), "<h3": (1, 1), "<blockquote": (1, 0.5), "<li": (0.5, 3), "<ul": (0.5, 2), "<a": (0.5, 4),
    "<div": (0.5, 4), "<span": (0.5, 1), "<frame": (0.05, 5), "<content": (0.05, 5), "<section": (0.5, 2), "<img": (0.5, 1), "<html": (0.01, 1), "<body": (0.01, 1),
}


def weights(inside: dict[str, float], outside: dict[str, float]) -> dict[str, float]:
    """Log-ratios by token type; "" is for types never seen."""
    sums = [sum(p[side] for p in PRIOR.values()) for side in (0, 1)]
    scaled = {t: (PSEUDO * a / sums[0], PSEUDO * b / sums[1]) for t, (a, b) in PRIOR.items()}
    types = {*scaled, *inside, *outside}
    total_in = sum(inside.values()) + PSEUDO + len(types)
    total_out = sum(outside.values()) + PSEUDO + len(types)
    out = {"": math.log((1 / total_in) / (4 / total_out))}
    for t in types:
        a, b = scaled.get(t, (0.5, 2.0))
        out[t] = math.log(((inside.get(t, 0) + a) / total_in) / ((outside.get(t, 0) + b) / total_out))
    return out


def fit(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from a sample of the pages that mark their main text."""
    labelled = pages.where(F.col(html).rlike(r"(?i)<(?:article|main)\b|articlebody")).select(html, F.xxhash64(html).alias("h"))
    ids = labelled.select("h").distinct().orderBy("h").limit(sample)
    chosen = labelled.join(F.broadcast(ids), "h", "left_semi").dropDuplicates(["h"]).select(html)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[str, bool]] = Counter()
        for batch in it:
            for source in batch.column(0).to_pylist():
                page = Page(source)
                if page.marked:
                    for (t, n), inside in zip(page.tokens(False), page.inside(), strict=True):
                        if t.startswith("word@") or t[1:] in BLOCK or t in PRIOR:
                            seen[t, inside] += n
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in seen], pa.string()), pa.array([i for _, i in seen], pa.bool_()), pa.array(list(seen.values()), pa.int64())], names=["token", "inside", "n"])

    rows = chosen.mapInArrow(count, "token string, inside boolean, n bigint").groupBy("token", "inside").agg(F.sum("n").alias("n")).collect()
    return weights({r.token: r.n for r in rows if r.inside}, {r.token: r.n for r in rows if not r.inside})


def main_text(source: str | None, weight: dict[str, float]) -> str:
    if not source:
        return ""
    page = Page(source)
    page.pardon(weight)
    unseen = weight[""]
    return page.text(*best_stretch([weight.get(t, unseen) * n for t, n in page.tokens()]))


def extract(pages: DataFrame, weight: dict[str, float] | None = None, html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    weight = fit(pages, html) if weight is None else weight

    def texts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [main_text(s, weight) for s in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", html).mapInArrow(texts, "page_id bigint, url string, text string, n_chars bigint")
