"""HTML extraction: maximum-scoring subsequence. Words score by where they stand, tags score negative; the best
contiguous run of blocks is the content region.

Weights come from labelled pages: those that mark their content with one ``article`` or ``main`` element (or
an element of the class or role for it). Over them, the words under every context (an enclosing tag, a class or
id word of an enclosing element, being a link) are counted inside and outside the content, and so are the
tags; a weight is the log ratio of the two, smoothed, starting from the fixed list of names below. Names that are
not on the lists are counted under a hash, of bounded range; none is left out. A page's
words get the sum of the weights of their contexts, cut off at both ends; a tag costs its own weight. One
linear scan finds the run of blocks with the largest sum; blocks in it whose words score negative (a menu
or an advert inside the article) are left out.

Inside marked content an element is left out for its tag, or for a name that is made of words of the fixed list
only (``_names_ban``); never one that encloses most of the marked words or the one inner mark. Elsewhere, and in
other names, the list is the prior of the weights.

Blocks end at the tags of BLOCKS; scripts, styles and the like, comments and markup are never text; character
references are decoded, white space in a block becomes one space. A paragraph or heading of marked content is kept though all
of it is a link, and so is an ``h1`` right before the region.

Defined cases: null or empty html, or a page without a block of positive score, gives an empty text; broken or
unclosed markup is read as far as it goes, a ``<`` that starts no tag is text; without labelled pages the
fixed list decides; repeated rows and null ids give rows like others; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solidspark.llm.common import as_long, as_text

TAG = re.compile(r"</?[a-zA-Z](?:\"[^\"]*\"|'[^']*'|[^'\">])*+>")
STARTS = re.compile(r"</?[a-zA-Z]")
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9-]*)")
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[a-z]+")
# Names of the HTML standard.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "xmp"}
#: Of these, whose content is text up to their end tag, or the end of the page; a slash in their start tag closes nothing.
TEXTUAL = {"script", "style", "textarea", "title", "iframe", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr", "input"}
#: Elements whose start ends an open one of the same name.
ALONE = {"p", "li", "td", "th", "tr", "dt", "dd", "option", "h1", "h2", "h3", "h4", "h5", "h6"}
# Names of what is not the article, where the labelled pages say nothing else.
NOT_CONTENT_TAGS = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset", "label", "head"}
NOT_CONTENT_WORDS = {
    "ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter",
    "subscribe", "signup", "login", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "aside", "widget", "related", "recommended",
    "share", "sharing", "social", "comment", "comments", "reply", "replies", "disqus", "respond", "pagination", "pager", "tags", "search", "copyright", "toolbar", "alert", "contentinfo", "complementary",
}
CONTENT_TAGS = {"article", "main"}
CONTENT_WORDS = {"articlebody", "mainentity", "main"}
#: What names an element inside marked content that is never part of it: labelled pages cannot teach this, for their
#: mark takes in all it encloses. An article's own header holds its title.
BANNED_TAGS, BANNED_WORDS = NOT_CONTENT_TAGS - {"header", "label", "head"}, NOT_CONTENT_WORDS - {"header", "masthead"}
#: What may stand beside such words in one name ("related-posts"; not "related-work" or "with-sidebar").
PLAIN = {"area", "articles", "bar", "block", "box", "button", "buttons", "container", "form", "icons", "inner", "item", "items", "links", "list", "post", "posts", "section", "wrap", "wrapper"}
#: Elements whose id and label are anchors of their text.
ANCHORED = {"section", "h1", "h2", "h3", "h4", "h5", "h6"}
#: Contexts of running text, and of titles.
PROSE = {f"tag {t}" for t in ("p", "blockquote", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6")}
#: Words that a name of the fixed lists counts for, and the largest weight.
PRIOR_WORDS, MOST, STRUCTURE = 50.0, 3.0, 0.75
#: What a block that is no content takes from a run at most, so that an advert does not part an article.
PARTS = 4.0


#: Names of features that are counted by themselves; all others under a hash, so that the counts have a bounded size.
BUCKETS = 1 << 18
NAMED = {"link", "all"} | {f"{kind} {t}" for kind in ("tag", "open") for t in RAW | VOID | INLINE | ALONE | NOT_CONTENT_TAGS | CONTENT_TAGS | {"html", "body", "div", "section", "ul", "ol", "dl", "table", "blockquote", "figure"}}
NAMED |= {f"word {w}" for w in NOT_CONTENT_WORDS | CONTENT_WORDS}


def key_of(feature: str) -> str:
    return feature if feature in NAMED else f"#{zlib.crc32(feature.encode()) % BUCKETS}"


def tokens(html: str) -> Iterator[str]:
    """Tags, comments and texts of a page in order, without what RAW elements hold, in linear time.

    A tag ends at the first ``>`` that is not quoted. Where a quote is still open at the end of the page, quotes count for nothing from that
    tag on; a ``<`` that no ``>`` follows is text. RAW elements that are none of TEXTUAL and have no end tag hold nothing."""
    at, last, quotes, ends = 0, html.rfind(">"), True, {}
    while at < len(html):
        if html[at] != "<":
            end = html.find("<", at)
        elif html.startswith("<!--", at):
            end = html.find("-->", at + 4) + 3 if html.find("-->", at + 4) >= 0 else -1
        elif html.startswith("<![CDATA[", at):
            end = html.find("]]>", at + 9) + 3 if html.find("]]>", at + 9) >= 0 else -1
        elif at < last and (html[at + 1] in "!?" or STARTS.match(html, at)):
            whole = TAG.match(html, at) if quotes and html[at + 1] not in "!?" else None
            if not whole and html[at + 1] not in "!?":
                quotes = False
            end = whole.end() if whole else html.find(">", at) + 1
        else:
            end = at + 1
        end = len(html) if end < 0 else end
        token = html[at:end]
        yield token
        at = end
        n = NAME.match(token) if len(token) > 1 and token[0] == "<" and token[1] != "/" else None
        name = n[1].lower() if n else ""
        if name not in RAW or (token.endswith("/>") and name in ("svg", "math")):
            continue
        # the next end tag of each name is looked for once, until it is passed
        if ends.get(name, 0) >= 0 and ends.get(name, -1) < at:
            found = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            ends[name] = found.start() if found else -1
        if ends[name] >= 0:
            closed = html.find(">", ends[name])
            at = closed + 1 if closed >= 0 else len(html)
        elif name in TEXTUAL and not token.endswith("/>"):
            at = len(html)


class Block:
    __slots__ = ("banned", "bans", "contexts", "labelled", "links", "tags", "text", "words")

    def __init__(self, text: str, links: int, tags: Counter, contexts: frozenset, labelled: bool, bans: tuple[int, ...]):
        self.text, self.links, self.tags, self.contexts, self.labelled, self.bans = text, links, tags, contexts, labelled, bans
        self.words, self.banned = len(text.split()), False


def _names_ban(value: str) -> bool:
    """A name made of words of the fixed list, and plain ones."""
    parts = set(WORDS.findall(value))
    return not parts.isdisjoint(BANNED_WORDS) and parts <= BANNED_WORDS | PLAIN


def _settle(blocks: list[Block], nested: list[tuple[int, ...]]) -> None:
    """Bans hold but for elements that enclose most of the marked words, or the one mark inside the mark."""
    total, of = 0, Counter()
    for b in blocks:
        if b.labelled:
            total += b.words
            for k in b.bans:
                of[k] += b.words
    free = {k for k, n in of.items() if 2 * n > total} | set(nested[0] if len(nested) == 1 else ())
    for b in blocks:
        b.banned = any(k not in free for k in b.bans)


def blocks_of(html: str) -> tuple[list[Block], int]:
    """The page's blocks in order, with the tags before each, and how many content elements it marks."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset, bool, tuple[int, ...]]] = []
    nested: list[tuple[int, ...]] = []
    pieces: list[str] = []
    tags: Counter = Counter()
    link_depth = links = marked = bans = 0

    def close_block() -> None:
        nonlocal links, tags
        text = " ".join(unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            top = stack[-1] if stack else ("", frozenset(), False, ())
            out.append(Block(text, links, tags, *top[1:]))
            tags = Counter()
        links = 0

    for tok in tokens(html):
        if tok[0] != "<" or len(tok) == 1:
            pieces.append(tok)
            if link_depth:
                links += len(tok.split())
            continue
        n = NAME.match(tok)
        if not n:
            continue
        name = n[1].lower()
        if tok[1] == "/":
            if name == "a":
                link_depth = max(0, link_depth - 1)
            elif name == "br" or name not in INLINE:
                close_block()
                tags[name] += 1
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
            continue
        tags[name] += 1
        if name in RAW:
            if name not in ("noscript", "svg", "math", "object"):
                close_block()
            continue
        if name in INLINE:
            if name == "a":
                link_depth = 1
            continue
        if name == "br":
            pieces.append("\n")
            continue
        close_block()
        if name in VOID:
            continue
        if name in ALONE and stack and stack[-1][0] == name:
            stack.pop()
        contexts, inside, within = stack[-1][1:] if stack else (frozenset(), False, ())
        own, words, ban = {"tag " + name}, set(), name in BANNED_TAGS
        for a in ATTRIBUTE.finditer(tok):
            value, kind = (a[2] or a[3] or a[4] or "").lower(), a[1].lower()
            words.update(WORDS.findall(value))
            if inside and not ban and not (kind in ("id", "aria-label") and name in ANCHORED):
                ban = any(map(_names_ban, value.split() if kind in ("class", "role") else [value]))
        own.update("word " + w for w in words)
        mark = name in CONTENT_TAGS or not words.isdisjoint(CONTENT_WORDS)
        if inside and mark:
            nested.append(within)
        if inside and ban:
            within = (*within, bans)
            bans += 1
        if not inside and mark:
            marked += 1
            inside = True
        stack.append((name, contexts | own, inside, within))
        if tok.endswith("/>") and name not in ALONE:
            stack.pop()
    close_block()
    _settle(out, nested)
    return out, marked


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(feature, inside, outside) of the labelled pages, summed over the task."""
    inside, outside = Counter(), Counter()
    for frame in frames:
        for html in frame["html"]:
            blocks, marked = blocks_of(html or "")
            if marked != 1:
                continue
            for b in blocks:
                to = inside if b.labelled and not b.banned else outside
                for c in b.contexts:
                    to[c] += b.words
                to["link"] += b.links
                to["all"] += b.words
                for t, k in b.tags.items():
                    to["open " + t] += k
    sums: dict[str, list[float]] = {}
    for feature in set(inside) | set(outside):
        row = sums.setdefault(key_of(feature), [0.0, 0.0])
        row[0] += inside[feature]
        row[1] += outside[feature]
    if sums:
        keys = sorted(sums)
        yield pd.DataFrame({"feature": keys, "inside": [sums[k][0] for k in keys], "outside": [sums[k][1] for k in keys]})


def _prior(feature: str) -> tuple[float, float]:
    """Words inside and outside that a feature starts with."""
    kind, _, name = feature.partition(" ")
    if kind == "tag" and name in NOT_CONTENT_TAGS or kind == "word" and name in NOT_CONTENT_WORDS or feature == "link":
        return 1.0, PRIOR_WORDS
    if kind == "tag" and name in CONTENT_TAGS or kind == "word" and name in CONTENT_WORDS:
        return PRIOR_WORDS, 1.0
    return 5.0, 5.0


class Weights:
    """Log ratios, from the counts of labelled pages."""

    def __init__(self, counts: dict[str, tuple[float, float]]):
        self.counts = counts
        self.known: dict[str, float] = {}
        i, o = counts.get("all", (0.0, 0.0))
        self.total = (i + 100.0, o + 100.0)

    def of(self, feature: str) -> float:
        if feature not in self.known:
            (i, o), (pi, po) = self.counts.get(key_of(feature), (0.0, 0.0)), _prior(feature)
            # shares of the words inside and outside that stand in this context
            w = math.log((i + pi) / (self.total[0] + pi)) - math.log((o + po) / (self.total[1] + po)) if i + o else math.log(pi / po)
            kind, _, name = feature.partition(" ")
            # a tag that only structures a page decides nothing by itself
            most = MOST if kind != "tag" or name in NOT_CONTENT_TAGS | CONTENT_TAGS else STRUCTURE
            self.known[feature] = max(-most, min(most, w))
        return self.known[feature]

    def word(self, block: Block) -> float:
        """Of a word that is no link: 1 and what its contexts say."""
        if block.banned:
            return -MOST
        return max(-MOST, min(MOST, 1.0 + sum(self.of(c) for c in block.contexts)))

    def tag(self, name: str) -> float:
        """What a tag costs: more, the likelier it stands outside; inline tags less."""
        i, o = self.counts.get(key_of("open " + name), (0.0, 0.0))
        return (0.1 + 0.9 * (o + 2) / (i + o + 4)) * (0.3 if name in INLINE else 1.0)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum; (0, 0) if none is positive."""
    best, at, now, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if now <= 0:
            now, start = 0.0, k
        now += s
        if now > best:
            best, at = now, (start, k + 1)
    return at


def main_text(html: str, weights: Weights) -> str:
    blocks, _ = blocks_of(html)
    kept, scores = [], []
    for b in blocks:
        word = weights.word(b)
        link = max(-MOST, min(word, word + weights.of("link")))
        words = (b.words - min(b.links, b.words)) * word + min(b.links, b.words) * link
        # a paragraph or heading of marked content that is all link is still the article's
        kept.append(words > 0 or (b.labelled and not b.banned and word > 0 and not b.contexts.isdisjoint(PROSE)))
        # what marked content encloses and never belongs to it is left out below and parts no region
        scores.append(0.0 if b.banned else max(words, -PARTS) - sum(weights.tag(t) * k for t, k in b.tags.items()))
    a, z = best_run(scores)
    # the tags before a first block stand outside the region
    while a > 0 and kept[a - 1] and blocks[a - 1].labelled and blocks[a].labelled:
        a -= 1
    # nor does its title cost the tags before it
    if 0 < a < z and kept[a - 1] and "tag h1" in blocks[a - 1].contexts:
        a -= 1
    while z and z < len(blocks) and kept[z] and blocks[z].labelled and blocks[z - 1].labelled:
        z += 1
    return "\n".join(b.text for b, k in zip(blocks[a:z], kept[a:z], strict=True) if k)


def learn(pages: DataFrame, html_col: str = "html") -> Weights:
    """Weights from the labelled ones of ``pages``: every feature has one, under at most BUCKETS and a few hundred keys."""
    counted = pages.select(F.col(html_col).alias("html")).mapInPandas(_counts, "feature string, inside double, outside double")
    total = counted.groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    return Weights({r.feature: (r.inside, r.outside) for r in total.collect()})


def extract(pages: DataFrame, weights: Weights | None = None, html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    weights = weights or learn(pages, html_col)

    def texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            text = [main_text(h or "", weights) for h in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"].tolist(), "text": text, "n_chars": [len(t) for t in text]})

    rows = pages.select(as_text("page_id").alias("page_id"), "url", F.col(html_col).alias("html"))
    return as_long(rows.mapInPandas(texts, "page_id string, url string, text string, n_chars long"), "page_id")
