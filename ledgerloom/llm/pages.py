"""Main text of web pages by differencing each page against its nearest neighbours.

A page becomes lines, one for each block of markup. The pages of a host are ordered by URL path, each is aligned with its
nearest neighbours by the longest common subsequence of their lines, and shared lines are deleted: templates repeat, articles
don't. Copies of a page are one page there. The alignments also tell which boxes (containers of a host, by tag and class) are
template: where neighbours share a box at all, they share it whole, while articles share a quotation at most. So a box
of changing text, such as an advert, goes where the alignments show its like to be template.

Articles, menus, headers, footers, asides and forms are boxes like others, and only scripts, styles and hidden elements are left out unseen.
A class name counts as a few alignments. A tag that says what a box is settles it where the alignments show nothing, both, or the opposite
(near copies share their articles, and menus of a few changing words share little). Each page tells how much of its text was judged by either.
"""

from __future__ import annotations

import hashlib
import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dense_index, shuffle_partitions, table, written

#: Pages of a host that are aligned in one group, and those around them that are searched for a neighbour that is no copy.
SPAN, NEAR = 64, 8
#: Shared stretches that what markup says of a box counts for, and that what all hosts show of it counts for on one host.
PRIOR, SHARED = 8, 32
#: How the lines of a box are marked, and the share of its like that is template as far as markup tells: a tag of chrome; a class that names
#: chrome; a page with an article elsewhere; any other page; an article.
TAGGED, NAMED, BESIDE, PLAIN, ARTICLE = "tagged", "named", "beside", "plain", "article"
BELIEF = {TAGGED: 0.95, NAMED: 0.9, BESIDE: 0.6, PLAIN: 0.4, ARTICLE: 0.05}
#: Zones of lines: nothing said, in an article, named by a class, in an element of chrome, hidden.
FREE, CONTENT, CLASS, CHROME, HIDDEN = 0, 1, 2, 3, 4

# Fixed values of the markup language. -----------------------------------------------------------------------
RAW = "script style template textarea select iframe svg title"
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav noscript ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOXES = frozenset("center details div dl fieldset figure noscript ol section table ul".split())
CHROME_TAGS = frozenset("aside button dialog footer form header menu nav".split())
UNCLOSED = frozenset("button form menu nav".split())
CHROME_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
CONTENT_TAGS = frozenset(("article", "main"))
ENDS_ALONE = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
# Words of class names: what chrome is called, and words that go with these.
CHROME_WORDS = frozenset(
    "ad ads adslot advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain pager pagination popup "
    "promo promoted promotion related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar widget".split()
)
LAYOUT_WORDS = frozenset("area articles bar block box button buttons container content form icons inner items link links list panel posts section stories wrap wrapper".split())
# ------------------------------------------------------------------------------------------------------------

MARKED = {CHROME: TAGGED, CLASS: NAMED, CONTENT: ARTICLE}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<svg(?=[\s/>])(?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?<=/)>|<(?P<raw>" + RAW.replace(" ", "|") + r")(?=[\s/>])(?>[^>]*)>.*?(?:</(?P=raw)\s*>|\Z)|<!(?>[^>]*)>|<\?(?>[^>]*)>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*))>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?>[^>]*)>",
    re.S | re.I,
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)
_PARTS = re.compile(r"[a-z]+")


def _attributes(attrs: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'").lower() for k, v in reversed(_NAMED.findall(attrs))} if attrs else {}


def _zone(tag: str, said: dict[str, str], zone: int) -> int:
    """The zone of what an element holds; ``zone``: that around it."""
    if zone == HIDDEN or tag in ("html", "body"):
        return zone
    if "hidden" in said or said.get("aria-hidden") == "true" or "display:none" in said.get("style", "").replace(" ", ""):
        return HIDDEN
    if zone == CHROME or tag in CHROME_TAGS and not (tag == "header" and zone == CONTENT) or said.get("role") in CHROME_ROLES:
        return CHROME
    if zone == CLASS or tag == "noscript":
        return CLASS
    if tag in CONTENT_TAGS or said.get("role") in CONTENT_TAGS or said.get("itemprop") == "articlebody":
        return CONTENT
    # a name counts as a whole, inside an article only on an element that holds blocks
    if zone != CONTENT or tag in BOXES:
        for name in f"{said.get('class', '')} {said.get('id', '')}".split():
            parts = set(_PARTS.findall(name))
            if parts & CHROME_WORDS and parts <= CHROME_WORDS | LAYOUT_WORDS:
                return CLASS
    return zone


class Page:
    """The lines of a page that aren't hidden: text, zone, and the innermost box.

    boxes: (box around it, name, zone) of each; a name is the tag with its class and id, numbers left out.
    """

    def __init__(self, page: str | None):
        self.lines: list[str] = []
        self.zones: list[int] = []
        self.box_of: list[int] = []
        self.boxes: list[tuple[int, str, int]] = []
        self._read(page or "")

    def _read(self, page: str) -> None:
        parts: list[str] = []
        zone, box = FREE, -1
        stack: list[tuple[str, int, int]] = []  # open block elements: tag, zone and box around them
        count: Counter[str] = Counter()

        def flush() -> None:
            if parts:
                raw = "".join(parts)
                parts.clear()
                text = " ".join((htmllib.unescape(raw) if "&" in raw else raw).split())
                if text and zone != HIDDEN:
                    self.lines.append(text)
                    self.zones.append(zone)
                    self.box_of.append(box)

        def close(n: int) -> None:
            nonlocal zone, box
            while len(stack) > n:
                tag, zone, box = stack.pop()
                count[tag] -= 1

        at = 0
        for m in _TOKEN.finditer(page):
            if m.start() > at:
                parts.append(page[at : m.start()])
            at = m.end()
            tag = (m["tag"] or m["tag2"] or "").lower()
            if tag not in BLOCKS:
                continue
            flush()
            if m["end"] or m["end2"]:
                if count[tag]:
                    close(max(k for k in range(len(stack)) if stack[k][0] == tag) if stack[-1][0] != tag else len(stack) - 1)
                continue
            while stack and stack[-1][0] == "p":
                close(len(stack) - 1)
            alike, edge = ENDS_ALONE.get(tag, ((), ()))
            if any(count[x] for x in alike):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in alike:
                        close(k)
                        break
                    if stack[k][0] in edge:
                        break
            if tag in VOID:
                continue
            if tag in CONTENT_TAGS and zone == CHROME and stack[-1][0] in UNCLOSED:
                close(len(stack) - 1)  # an article doesn't begin in a menu: the menu's end tag was left out
            said = _attributes(m["attrs"] or "")
            stack.append((tag, zone, box))
            count[tag] += 1
            inner = _zone(tag, said, zone)
            if inner != HIDDEN and (tag in BOXES or inner != zone):
                name = ".".join([tag, *re.sub(r"[0-9]+", "", f"{said.get('class', '')} {said.get('id', '')}").split()])
                self.boxes.append((box, name, inner))
                box = len(self.boxes) - 1
            zone = inner
        if at < len(page):
            parts.append(page[at:])
        flush()

    def regions(self) -> list[str]:
        """For each line the name of the box that is judged as a whole.

        It is the outermost box of the line's zone, be that chrome, named by a class or an article; else the outermost one that holds no more
        than half of the page's text outside chrome. A line in neither is in no box (name ''). A name begins with how the box is marked.
        """
        holds, half = Counter(), 0.0
        for t, b, z in zip(self.lines, self.box_of, self.zones):
            half += len(t) / 2 if z != CHROME else 0
            while b >= 0 and z != CHROME:
                holds[b] += len(t)
                b = self.boxes[b][0]
        other = BESIDE if CONTENT in self.zones else PLAIN
        chosen: dict[tuple[int, int], str] = {}
        for key in set(zip(self.box_of, self.zones)):
            b, z = key
            chain = []
            while b >= 0:
                chain.append(b)
                b = self.boxes[b][0]
            chain = chain[::-1]
            names = [self.boxes[b][1] for b in chain]
            if z in MARKED:
                kind, k = MARKED[z], next(i for i, b in enumerate(chain) if self.boxes[b][2] == z)
            else:
                kind, k = other, next((i for i, b in enumerate(chain) if holds[b] <= half), None)
            chosen[key] = f"{kind}:" if k is None else f"{kind}:" + ">".join(names[max(0, k - 1) : k + 1])
        return [chosen[key] for key in zip(self.box_of, self.zones)]


def common_lines(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Positions in ``a`` and in ``b`` of a longest common subsequence, by bit-parallel rows.

    Long inputs are halved first (Hirschberg), so memory stays bounded.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    out = [(i, i) for i in range(head)]
    out += [(head + i, head + j) for i, j in _align(x, y)]
    out += [(len(a) - tail + i, len(b) - tail + i) for i in range(tail)]
    return [i for i, _ in out], [j for _, j in out]


def _rows(x: list[int], y: list[int], keep: bool) -> list[int]:
    """For each prefix of ``x``: a number whose zero bits mark where the common length with prefixes of ``y`` grows."""
    where: dict[int, int] = {}
    for j, v in enumerate(y):
        where[v] = where.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    row, rows = full, [full]
    for v in x:
        u = row & where.get(v, 0)
        row = ((row + u) | (row - u)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def _align(x: list[int], y: list[int]) -> list[tuple[int, int]]:
    if not x or not y or set(x).isdisjoint(y):
        return []
    if len(x) > 1 and len(x) * len(y) > 1 << 26:
        mid = len(x) // 2
        grow = lambda p, q: np.concatenate([[0], np.cumsum([c == "0" for c in f"{_rows(p, q, False)[0]:0{len(q)}b}"[::-1]])])
        cut = int(np.argmax(grow(x[:mid], y) + grow(x[mid:][::-1], y[::-1])[::-1]))
        return _align(x[:mid], y[:cut]) + [(mid + i, cut + j) for i, j in _align(x[mid:], y[cut:])]
    rows = _rows(x, y, True)
    i, j, out = len(x), len(y), []
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def witnesses(coded: list[list[int]], own: list[bool], near: int = NEAR, sets: list[set[int]] | None = None) -> list[list[set[int]]]:
    """For each page of ``own``, and in the order of their distance: positions of the lines that it shares with each of two neighbours.

    The neighbours are the nearest pages on either side (at the end of a host: the two nearest on one side), at most ``near`` away,
    that aren't its copy. A page without a line of its own (in ``sets``: lines to go by) beside another is its copy.
    """
    sets = sets or [set(x) for x in coded]
    shared: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
    out: list[list[set[int]]] = []
    for k in range(len(coded)):
        found: list[set[int]] = []
        if own[k]:
            side = [[j for j in js if not (sets[k] <= sets[j] or sets[j] <= sets[k])][:2] for js in (range(k + 1, min(len(coded), k + near + 1)), range(k - 1, max(-1, k - near - 1), -1))]
            pick = [s[0] for s in side if s]
            if len(pick) == 1:
                pick = max(side, key=len)
            for j in pick:
                a, b = min(k, j), max(k, j)
                if (a, b) not in shared:
                    shared[a, b] = common_lines(coded[a], coded[b])
                found.append(set(shared[a, b][k > j]))
        out.append(found)
    return out


def _host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    rest = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", ""), r"[?#].*$", "")
    path = F.regexp_replace(F.regexp_replace(rest, "^[^/]*", ""), r"(?:/|/index)?(?:\.html?)?$", "")
    return F.lower(F.regexp_extract(rest, "^([^/]*)", 1)), path


def _compared(pages: list[tuple]) -> tuple[list, list]:
    """``pages``: (codes, sizes, region of each line, regions, whether own) of a stretch of a host, in order of URL path.

    Gives for each own page its boxes (region, its lines, those of them that both neighbours share if not in an article, code points of
    either), and the evidence that it gives on its boxes (region, digest of what a neighbour shares of it, share of its text).
    """
    cells, evidence = [], []
    # pages that differ in their chrome alone are copies too, unless what is marked as chrome is most of their text
    sets = []
    for codes, sizes, where, names, _ in pages:
        plain = [not names[r].startswith(TAGGED) for r in where]
        most = 2 * sum(n for n, p in zip(sizes, plain) if p) >= sum(sizes)
        sets.append({c for c, p in zip(codes, plain) if p or not most})
    for (codes, sizes, where, names, own), found in zip(pages, witnesses([p[0] for p in pages], [p[4] for p in pages], sets=sets)):
        boxes: dict[int, list[int]] = {}
        for i, r in enumerate(where):
            boxes.setdefault(r, []).append(i)
        gone = set.intersection(*found) if found else set()
        both = {r: [i for i in lines if i in gone and not names[r].startswith(ARTICLE)] for r, lines in boxes.items()}
        chars = lambda at: sum(sizes[i] for i in at)
        cells.append([(names[r], lines, both[r], chars(lines), chars(both[r])) for r, lines in boxes.items()] if own else [])
        seen = []
        for same in found:
            for r, lines in boxes.items():
                if hit := [i for i in lines if i in same]:
                    digest = xxhash.xxh64_intdigest(np.array([codes[i] for i in hit], np.int64).tobytes()) >> 1
                    seen.append((names[r], digest, sum(sizes[i] for i in hit) / sum(sizes[i] for i in lines)))
        evidence.append(seen)
    return cells, evidence


def _template(evidence: DataFrame, cells: DataFrame) -> DataFrame:
    """``cells`` (host, region, more) plus whether the region is ``template``, and whether alignments ``told``: where they outweigh what markup says and
    point the same way as the result.

    A box counts by the share of its text that a neighbour has too, averaged over what was shared: the same text on more
    pages counts more, but only with the logarithm, so that a group of copies doesn't outweigh all. The estimate for a host begins from that for all,
    and that for all from what markup says (``SHARED`` and ``PRIOR``); boxes without a tag of their own,
    class or id have nothing in common between hosts. Lines in no box are judged one by one.
    """
    seen = written(evidence.groupBy("host", "region", "digest").agg(F.avg("share").alias("share"), (1 + F.log2(F.count("*").cast("double"))).alias("w")))
    here = seen.groupBy("host", "region").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("share")).alias("s"))
    everywhere = here.groupBy("region").agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
    belief = F.coalesce(*[F.when(F.col("region").startswith(f"{k}:"), F.lit(v)) for k, v in BELIEF.items()])
    known = cells.join(everywhere, "region", "left").join(here, ["host", "region"], "left")
    common = F.col("region").contains(".") | F.col("region").startswith(TAGGED) | F.col("region").startswith(ARTICLE)
    n, s = (F.coalesce(c, F.lit(0.0)) for c in ("n", "s"))
    all_n, all_s = (F.when(common, F.coalesce(c, F.lit(0.0))).otherwise(F.lit(0.0)) for c in ("all_n", "all_s"))
    wide = (all_s + PRIOR * belief) / (all_n + PRIOR)
    weight = F.when(common, SHARED).otherwise(PRIOR)
    close = (s + weight * wide) / (n + weight)
    in_box = ~F.col("region").endswith(":")
    tagged = F.col("region").startswith(TAGGED) | F.col("region").startswith(ARTICLE)
    template = F.when(in_box & ~tagged, close >= 0.5).otherwise(belief >= 0.5)
    # the host's evidence is part of that for all
    seen_n, seen_s = F.greatest(n, all_n), F.when(all_n > 0, all_s).otherwise(s)
    told = in_box & (seen_n > PRIOR) & ((seen_s / seen_n >= 0.5) == template)
    return known.withColumn("template", template).withColumn("told", F.coalesce(told, F.lit(False))).drop("all_n", "all_s", "n", "s")


def main_text(pages: DataFrame, align: bool = True, span: int = SPAN) -> DataFrame:
    """(page_id, url, text, n_chars, aligned_chars, marked_chars) for each row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one space in page
    order. Lines in template boxes go, and outside articles those that both neighbours share. aligned_chars and marked_chars: code points of the
    lines, kept or not, on which alignments decided, and of those that markup settled. Null or empty html, and html without text, gives an empty text.
    Pages without a URL count as one host; the only page of a host has no neighbour, and only what is known from other hosts tells its
    boxes. Copies of a page (equal lines in equal boxes) under other URLs of a host are one page there, at the least URL; each gets its text. Repeated rows
    give equal texts. Very long pages are
    read and compared whole. ``align``: False leaves the differencing out, so that all visible text stays, for comparison.

    Neighbours are found and aligned on codes of lines, so the text itself is shuffled once.
    """

    host, path = _host_and_path(F.col("url"))
    wanted = pages.select("page_id", "url", host.alias("host"), path.alias("path"), "html")
    kind = pages.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """Batches with the lines, codes, regions and digest of each page."""
        for b in batches:
            for lo in range(0, len(b), 256):
                some = b.iloc[lo : lo + 256]
                found = [Page(x) for x in some["html"]]
                flat = np.array([t for p in found for t in p.lines], object)
                codes = pd.util.hash_array(flat, categorize=False).view(np.int64) if len(flat) else np.zeros(0, np.int64)
                codes = np.split(codes, np.cumsum([len(p.lines) for p in found])[:-1])
                regions = [p.regions() for p in found]
                digests = [hashlib.blake2b(c.tobytes() + repr(r).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest() for c, r in zip(codes, regions)]
                yield some.drop(columns="html"), [p.lines for p in found], codes, regions, digests

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some, lines, codes, regions, digests in read(batches):
            names = [list(dict.fromkeys(r)) for r in regions]
            where = [[n.index(x) for x in r] for r, n in zip(regions, names)]
            yield some.drop(columns="url").assign(digest=digests, codes=list(codes), sizes=[[len(t) for t in page] for page in lines], place=where, regions=names)

    fields = f"page_id {kind}, host string, path string, digest string, codes array<long>, sizes array<int>, place array<int>, regions array<string>"
    least = F.min(F.struct("path", F.col("page_id").isNotNull().alias("known"), "page_id", "codes", "sizes", "place", "regions")).alias("k")
    unlike = wanted.mapInPandas(sketch, fields).groupBy("host", "digest").agg(least).select("host", "digest", "k.*")
    order = [F.col("path").asc(), F.col("page_id").asc_nulls_first(), F.col("digest").asc()]
    listed = dense_index(unlike, ["host"], order, "idx")
    # a stretch of pages, and those near it on either side
    at, stretch = F.col("idx") % span, F.floor(F.col("idx") / span)
    beside = F.array_compact(F.array(stretch, F.when((at < NEAR) & (stretch > 0), stretch - 1), F.when(at >= span - NEAR, stretch + 1)))
    dealt = listed.select("host", "digest", "codes", "sizes", "place", "regions", "idx", F.explode(beside).alias("stretch"))
    dealt = dealt.withColumn("own", F.floor(F.col("idx") / span) == F.col("stretch"))

    def difference(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        last = None

        def done() -> pd.DataFrame:
            cells, evidence = _compared([(r[1].tolist(), r[2].tolist(), r[3].tolist(), r[4].tolist(), r[5]) for r in held])
            rows = [(last[0], r[0], c, e) for r, c, e in zip(held, cells, evidence) if r[5] and c]
            return pd.DataFrame({n: pd.Series([r[i] for r in rows], dtype=object) for i, n in enumerate(("host", "digest", "cells", "evidence"))})

        for b in batches:
            for r in zip(b["host"], b["stretch"], b["digest"], b["codes"], b["sizes"], b["place"], b["regions"], b["own"]):
                if held and last != r[:2]:
                    yield done()
                    held = []
                last = r[:2]
                held.append(r[2:])
        if held:
            yield done()

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some, lines, _, _, digests in read(batches):
            yield some[["page_id", "url", "host"]].assign(digest=digests, lines=lines)

    near = dealt.repartition(shuffle_partitions(pages.sparkSession), "host", "stretch").sortWithinPartitions("host", "stretch", "idx")
    shape = "host string, digest string, cells array<struct<region:string,lines:array<int>,both:array<int>,chars:long,both_chars:long>>, evidence array<struct<region:string,digest:long,share:double>>"
    compared = written(near.mapInPandas(difference, shape))
    cells = compared.select("host", F.col("digest").alias("page"), F.inline("cells"))
    evidence = compared.select("host", F.inline("evidence"))
    judged = _template(evidence, cells)
    leaves = F.when(F.col("template"), F.col("lines")).otherwise(F.col("both"))
    by_lines = F.when(F.col("told"), F.col("chars")).when(F.col("template"), 0).otherwise(F.col("both_chars"))
    gone = judged.groupBy("host", F.col("page").alias("digest")).agg(F.flatten(F.collect_list(leaves)).alias("gone"), F.sum(by_lines).alias("aligned"), F.sum("chars").alias("chars"))
    if not align:
        gone = gone.select("host", "digest", F.array().cast("array<int>").alias("gone"), F.lit(0).cast("long").alias("aligned"), "chars")
    gone = written(gone)
    parsed = wanted.select("page_id", "url", "host", "html").mapInPandas(parse, f"page_id {kind}, url string, host string, digest string, lines array<string>")
    left = F.filter("lines", lambda x, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    by = [F.coalesce(c, F.lit(0)).cast("long") for c in (F.col("aligned"), F.col("chars") - F.col("aligned"))]
    texts = parsed.join(gone, ["host", "digest"], "left").select("page_id", "url", F.array_join(left, " ").alias("text"), by[0].alias("aligned_chars"), by[1].alias("marked_chars"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "aligned_chars", "marked_chars")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
