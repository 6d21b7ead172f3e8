"""Main text of HTML pages: parser events, text-to-tag ratios, smoothing, clustering.

The page is read as a stream of parser events.  Block elements end lines; each line gets its text
length (links aside) and the tags since the line before, a ratio that is smoothed with a Gaussian.
Lines above the threshold form content clusters.  Some elements are never article text (navigation,
scripts, whatever is named an advert, ...).  Names that only hint at boilerplate, and forms, are weighed
against the clusters: what holds the clusters stays.  The element that holds the clusters' text is the
content region.  From its first cluster to its last all lines are kept, short ones too; beyond them an
article keeps what isn't links, another region its headings.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img".split())
SKIP = frozenset("script style noscript template head title nav footer aside button select option textarea iframe object svg canvas dialog menu audio video".split())
MAIN = frozenset("article main".split())
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr figcaption".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("head title style script noscript template base link meta".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
PLAIN = frozenset("a b i em strong font u small".split())
# Words of class, id or role that hint at boilerplate, words of reader comments, and
# words that make the next one a property ("has-sidebar").
NOISE = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies consent disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices popup promo promotion related replies search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split())
READERS = frozenset("comment comments disqus replies".split())
PROPERTY = frozenset("has hide is no not show toggle with without".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
CLEAR, HINT, OUT = 0, 1, 2  # what an element's tag and names say


def _names(tag: str, attrs, in_main: bool) -> int:
    """What the names of an element say: a whole name is proof, a part of a compound one a hint."""
    said = CLEAR
    for k, v in attrs:
        if k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and v and "display:none" in v.replace(" ", "").lower():
            return OUT
        if not v or k not in ("class", "id", "role") or tag in HEADING or k == "id" and tag in TEXT:
            continue  # the id of a heading or a paragraph is a link's target
        for name in v.split():
            parts = [p.lower() for p in _PARTS.findall(name)]
            for before, p in zip(["", *parts], parts, strict=False):
                if p not in NOISE or before in PROPERTY or in_main and p == "header":
                    continue
                if p in READERS or len(parts) == 1 and tag not in MAIN:
                    return OUT
                if tag not in MAIN:
                    said = HINT
    return said


class Lines(HTMLParser):
    """Collects the elements (parent, kind, what they say, inside an article?) and the lines of text
    (text, characters in links, tags since the line before, innermost element)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.kind, self.says, self.in_main = [0], ["body"], [CLEAR], [False]
        self.open: list[tuple[str, int]] = []  # tag, number
        self.at: dict[str, list[int]] = defaultdict(list)  # places of a tag in ``open``
        self.tags = self.links = self.in_link = 0
        self.parts: list[str] = []
        self.lines: list[tuple[str, int, int, int]] = []

    def _top(self) -> int:
        return self.open[-1][1] if self.open else 0

    def _end_line(self):
        if self.parts:
            if text := " ".join("".join(self.parts).split()):
                self.lines.append((text, min(self.links, len(text)), self.tags, self._top()))
                self.tags = 0
            self.parts = []
        self.links = 0

    def _push(self, tag, attrs, says):
        top = self._top()
        main = tag in MAIN or ("role", "main") in attrs or ("itemprop", "articleBody") in attrs
        self.parent.append(top)
        self.kind.append("main" if main else tag)
        self.says.append(OUT if self.says[top] == OUT else says)
        self.in_main.append(self.in_main[top] or main)
        self.at[tag].append(len(self.open))
        self.open.append((tag, len(self.parent) - 1))

    def _pop(self, place):
        while len(self.open) > place:
            self.at[self.open.pop()[0]].pop()

    def _close(self, tag, until):
        """End the innermost ``tag`` that is open, unless one of ``until`` stands in it."""
        if (places := self.at[tag]) and not any(self.at[u] and self.at[u][-1] > places[-1] for u in until if u in self.at):
            self._pop(places[-1])

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            if tag not in INLINE:
                self._end_line()
            return
        if tag == "a":
            self.in_link = 1
        if tag not in INLINE:
            self.in_link = 0
            self._end_line()
            if tag not in IN_HEAD:
                self._close("head", ())
            if tag in CLOSES_P:
                self._close("p", CLOSES_P - {"p"})
            elif tag in ("li", "dt", "dd", "tr", "td", "th"):
                self._close(tag, ("ul", "ol", "dl", "table", "tr") if tag in ("td", "th") else ("ul", "ol", "dl", "table"))
            in_main = self.in_main[self._top()]
            if tag in SKIP or tag == "header" and not in_main:
                says = OUT
            else:
                says = CLEAR if tag in ("html", "body") else max(_names(tag, attrs, in_main), HINT if tag == "form" else CLEAR)
            self._push(tag, attrs, says)
        elif attrs and tag not in PLAIN and _names(tag, attrs, self.in_main[self._top()]) == OUT or ("hidden", None) in attrs:
            self._end_line()
            self._push(tag, [], OUT)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.in_link = 0
        if tag in INLINE:
            if self.open and self.open[-1][0] == tag:
                self._end_line()
                self._pop(len(self.open) - 1)
            return
        self._end_line()
        if self.at[tag]:
            self._pop(self.at[tag][-1])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # no known keyword: up to the next ">" it is a comment
            return self.parse_bogus_comment(i)

    def handle_data(self, data):
        if not (self.open and self.open[-1][0] in ("script", "style")):
            self.parts.append(data)
            if self.in_link:
                self.links += len(data.strip())

    def close(self):
        super().close()
        self._end_line()


def smooth(ratios: list[float], sigma: float) -> list[float]:
    """Gaussian smoothing; at the ends the kernel is cut off and rescaled."""
    r = math.ceil(2 * sigma)
    kernel = [math.exp(-d * d / (2 * sigma * sigma)) for d in range(-r, r + 1)]
    out = []
    for i in range(len(ratios)):
        a, b = max(0, i - r), min(len(ratios), i + r + 1)
        w = kernel[a - i + r:b - i + r]
        out.append(sum(x * y for x, y in zip(ratios[a:b], w, strict=True)) / sum(w))
    return out


def clusters(ratios: list[float], sigma: float) -> list[bool]:
    """Which lines are content: the smoothed ratio reaches the lesser of its mean and its deviation."""
    ratio = smooth(ratios, sigma)
    mean = sum(ratio) / len(ratio)
    level = min(math.sqrt(sum((x - mean) ** 2 for x in ratio) / len(ratio)), mean)
    return [x >= level and x > 0 for x in ratio]


def _sums(parent: list[int], own: list[int]) -> list[int]:
    """Sums over each element and all that it holds (an element's number is above its parent's)."""
    total = own[:]
    for e in range(len(parent) - 1, 0, -1):
        total[parent[e]] += total[e]
    return total


def main_text(html: str, sigma: float = 1.0) -> str:
    """The page's main text, a line for each block."""
    p = Lines()
    p.feed(html)
    p.close()
    lines, parent, kind, says = p.lines, p.parent, p.kind, p.says
    size = [len(x[0]) for x in lines]
    place = [x[3] for x in lines]

    def held(which, weight) -> list[int]:
        own = [0] * len(parent)
        for i in which:
            own[place[i]] += weight[i]
        return _sums(parent, own)

    clean = [i for i, e in enumerate(place) if says[e] != OUT]
    if not clean:
        return ""
    own_text = [n - x[1] for n, x in zip(size, lines, strict=True)]
    tags = [max(1, x[2]) for x in lines]
    ratios = [n / t if says[e] != OUT else 0.0 for n, t, e in zip(own_text, tags, place, strict=True)]
    content = clusters(ratios, sigma)
    chosen = [i for i in clean if content[i]] or clean

    # Hints: inside an article the ratio of the element's own lines decides, elsewhere whether it holds the content.
    if HINT in says:
        good, inner, inner_tags = held(chosen, size), held(clean, own_text), held(clean, tags)
        usual = sum(ratios) / len(clean)
        mains = held([i for i in chosen if p.in_main[place[i]]], size)
        gone = [False] * len(parent)
        for e in range(1, len(parent)):
            gone[e] = gone[parent[e]]
            if says[e] == HINT and not gone[e]:
                holds = 2 * good[e] >= good[0] and mains[e] == mains[0]
                gone[e] = not (holds or p.in_main[parent[e]] and kind[e] != "form" and inner[e] >= usual * inner_tags[e] > 0)
        clean = [i for i in clean if not gone[place[i]]]
        chosen = [i for i in chosen if not gone[place[i]]] or clean
        if not clean:
            return ""

    weight, count = held(chosen, size), held(clean, [1] * len(lines))
    depth, outer = [0] * len(parent), [0] * len(parent)  # outer: the outermost article around
    for e in range(1, len(parent)):
        depth[e] = depth[parent[e]] + 1
        outer[e] = outer[parent[e]] or (e if kind[e] == "main" else 0)
    near = [e for e in range(1, len(parent)) if weight[e] and weight[e] >= 0.75 * weight[0] and kind[e] not in TEXT and (count[e] > 1 or len(clean) == 1)]
    articles = {outer[place[i]] for i in chosen} - {0}
    if mains := [e for e in near if kind[e] == "main"]:  # the innermost article that holds the text
        region = {max(mains, key=lambda e: (depth[e], e))}
    else:
        region = articles or {max(near, key=lambda e: (depth[e], e), default=0)}
    inside = [False] * len(parent)
    for e in range(len(parent)):
        inside[e] = e in region or e > 0 and inside[parent[e]]
    kept = [i for i in clean if inside[place[i]]]
    linked = [2 * x[1] >= n for n, x in zip(size, lines, strict=True)]  # mostly links
    span = [i for i in chosen if inside[place[i]] and not linked[i]] or kept
    first, last = kept.index(span[0]), kept.index(span[-1])
    while first and kind[place[kept[first - 1]]] in HEADING:
        first -= 1
    # Beyond the clusters an article keeps what isn't links; a region that only the clusters know, its title.
    marked = kind[min(region)] == "main"
    return "\n".join(lines[i][0] for at, i in enumerate(kept) if first <= at <= last or (not linked[i] if marked else kind[place[i]] == "h1"))


def main_text_of(html: Column, sigma: float = 1.0) -> Column:
    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(h.as_py() or "", sigma) for h in pages], type=pa.string())

    return extract(html)


def extract_main_text(pages: DataFrame, html_col: str = "html", out: str = "text", sigma: float = 1.0) -> DataFrame:
    """Adds ``out``, the main text of each page's whole html.

    Null, empty or text-free html gives "".  Rows are independent: null ids, repeated rows and
    ties need nothing, an empty table stays empty; an input column named ``out`` is replaced.
    """
    return pages.withColumn(out, main_text_of(pages[html_col], sigma))
