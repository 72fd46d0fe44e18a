"""Main text of web pages: text blocks by structure, and nearest-URL page differencing of every page.

A page is read as text blocks in page order. Blocks in menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments (by element, role, class or id) are left out.
If the page marks its article (``article``, else ``main``), its blocks are the candidates for the text, else all that are left.

Templates are found by differencing. Pages of a host with equal lines count as
one page, which is put in the order of the URL paths within the host. Neighbours that share nearly all
lines of both (of the shorter one, if their paths are equal) are copies of one article, not two articles in one
template; a run of such copies is passed over, and each of its pages is paired with the last page before
the run or the first one after it: first with the one that shares the longer path prefix, and with the
other if that is a copy, too, or has all lines of the page. The two pages' lines are aligned by a longest
common subsequence, and lines that both share are deleted. In a marked article, where neighbours also share paragraphs, a
shared line is deleted if both pages have it outside their articles, too, in a menu or a footer, say. Pages for which neither will do are left
whole, as where all pages of a host share nearly everything: then a short article in a large template and
a copy of an article cannot be told apart.

Only line hashes travel: the order, the pairs and the alignment work on them, and the deleted
line numbers are joined back to all pages with these lines.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_left
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: share of two pages' lines from which they count as copies
COPY_SHARE = 0.9
#: rows of deleted lines up to which they are broadcast; beyond, the join is a shuffle
BROADCAST_ROWS = 20_000

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)", re.S)
_OPEN = re.compile(r"<!--|<!\[CDATA\[")
_QUOTE_OR_END = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")

_SKIPPED = {"script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "select", "object", "canvas", "math"}
_ZONES = {"nav", "header", "footer", "aside", "form", "head", "menu", "dialog", "button"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
           "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
           "u", "var", "wbr"}
_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
          "banner", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe",
          "subscription", "signup", "login", "sidebar", "widget", "widgets", "menu", "nav", "navbar", "navigation", "breadcrumb",
          "breadcrumbs", "pager", "pagination", "footer", "masthead", "topbar", "share", "sharing", "social", "related",
          "recommended", "comment", "comments", "disqus", "respond", "replies", "toolbar", "search", "contentinfo",
          "complementary", "alert", "alertdialog", "dialog"}
_COMMENTS = {"comment", "comments", "disqus", "respond", "replies"}


def _is_zone(name: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """(the element is left out, it holds reader comments). ``inside``: within an article."""
    if name in _ZONES and not (name == "header" and inside):
        return True, False
    if not attributes or name in ("html", "body", "main"):
        return False, False
    words: set[str] = set()
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            return True, False
        if key in ("class", "id", "role"):
            words.update(_SPLIT.split(value))
    if "header" in words and not inside:
        return True, False
    return bool(words & _WORDS), bool(words & _COMMENTS)


def tag_ends(html: str):
    """Function that gives the place of the '>' that ends a tag, from a place within the tag and before some '>'.

    A '>' in a quoted value, however long, does not end it; if a quote is never closed, the first '>' does. A quote that has
    led to an unclosed one is not followed again, so that all tags of a page together take linear time.
    """
    final = {quote: html.rfind(quote) for quote in "\"'"}
    lost: set[int] = set()

    def end(at: int) -> int:
        quotes, place = [], at
        while found := _QUOTE_OR_END.search(html, place):
            start, mark = found.start(), found[0]
            if mark == ">":
                return start
            if start in lost or start >= final[mark]:
                break
            quotes.append(start)
            place = html.find(mark, start + 1) + 1
        lost.update(quotes)
        return html.find(">", at)
    return end


def page_lines(html: str) -> tuple[list[str], bool]:
    """(text lines of a page in order, whether they are the marked article)."""
    lines, marked, _ = page_blocks(html)
    return lines, marked


def page_blocks(html: str) -> tuple[list[str], bool, list[int]]:
    """``page_lines`` and the numbers of the lines of a marked article that the page has outside it, too."""
    low = html.lower()
    lines: list[tuple[str, int]] = []  # level -1: left out, 0: unmarked, 1: in main, 2: in article
    parts: list[str] = []
    article = main = 0
    zone, depth, strict = "", 0, False  # the element that opened the zone, its nesting
    at, last = 0, html.rfind(">")
    tag_end = tag_ends(html)

    def close() -> None:
        text = " ".join(_html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            lines.append((text, -1 if zone else 2 if article else 1 if main else 0))

    while True:
        if at > last:  # no tag can end any more; an open comment goes
            parts.append(html[at:].partition("<!--")[0])
            break
        tag = _TAG.search(html, at)
        if tag and tag[2] and tag.start() > last:  # no tag: it cannot end
            still_open = _OPEN.search(html, tag.end())
            tag = still_open and _TAG.match(html, still_open.start())
        if tag is None or tag.start() > at:
            parts.append(html[at:tag.start() if tag else len(html)])
        if tag is None:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            if tag[0].startswith("<![CDATA["):
                parts.append(_html.escape(tag[0][9:].removesuffix("]]>")))
            continue
        end = tag_end(at)
        closing, attributes, at = tag[1], html[at:end], end + 1
        if name not in _INLINE or name == zone:
            if name in ("td", "th"):
                parts.append(" ")
            else:
                close()
        if closing:
            if zone and name == zone:
                depth -= 1
                if not depth:
                    close()
                    zone = ""
            elif not zone and name == "article":
                article = max(0, article - 1)
            elif not zone and name == "main":
                main = max(0, main - 1)
            continue
        if name in _SKIPPED:
            if not attributes.endswith("/"):
                end = low.find(f"</{name}", at)
                stop = low.find(">", end) if end >= 0 else -1
                at = stop + 1 if stop >= 0 else len(html) if name in ("script", "style", "textarea", "title") else at
            continue
        if zone:
            if name in ("article", "main") and not strict and zone not in _ZONES:
                close()
                zone = ""  # a class that names a layout, not a part
            else:
                depth += name == zone
                continue
        out, comments = _is_zone(name, attributes, bool(article))
        # without an end tag there is no telling where the part ends
        if out and not attributes.endswith("/") and low.find(f"</{name}", at) >= 0:
            close()
            zone, depth, strict = name, 1, comments
        elif name == "article":
            article += 1
        elif name == "main" or "role" in attributes and re.search(r"role\s*=\s*[\"']?main\b", attributes):
            main += name == "main"
    close()
    best = max((level for _, level in lines if level >= 0), default=0)
    outside = {text for text, level in lines if level < best} if best else set()
    kept = [text for text, level in lines if level == best]
    return kept, best > 0, [i for i, text in enumerate(kept) if text in outside]


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Indexes in ``a`` of a longest common subsequence of two line lists."""
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    tails: list[int] = []
    ends: list[tuple | None] = []
    for i, x in enumerate(a):
        for j in reversed(places.get(x, ())):
            k = bisect_left(tails, j)
            node = (i, ends[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                ends.append(node)
            else:
                tails[k] = j
                ends[k] = node
    out, node = [], ends[-1] if ends else None
    while node:
        out.append(node[0])
        node = node[1]
    return out[::-1]


def split_url(url: str) -> tuple[str, str]:
    """(host, path) without scheme, ``www.``, query and fragment."""
    rest = url.split("://", 1)[-1].split("#", 1)[0].split("?", 1)[0]
    host, _, path = rest.partition("/")
    return host.lower().removeprefix("www."), "/" + path


def _line_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from .common import text_slices
    for batch, raws in text_slices(batches, "html"):
        host, path, hashes, marked, outside = [], [], [], [], []
        for url, raw in zip(batch.column(2).to_pylist(), raws):
            a, b = split_url(url or "")
            lines, known, outer = page_blocks(raw.decode())
            host.append(a)
            path.append(b)
            marked.append(known)
            outside.append(outer)
            hashes.append([xxhash.xxh64_intdigest(x) - (1 << 63) for x in lines])
        yield pa.RecordBatch.from_pydict({
            "k1": batch.column(0), "k2": batch.column(1), "host": pa.array(host, pa.string()), "path": pa.array(path, pa.string()),
            "marked": pa.array(marked, pa.bool_()), "lines": pa.array(hashes, pa.list_(pa.int64())),
            "outside": pa.array(outside, pa.list_(pa.int32()))})


def _are_copies(a_path: str, a: list[int], b_path: str, b: list[int], shared: int, copy_share: float) -> bool:
    return shared >= copy_share * (min if a_path == b_path else max)(len(a), len(b))


def _run_starts(copy_share: float):
    """mapInArrow function over pages in order, each range after the last page of the one before it: does a page start a run of copies?"""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            at, starts = [], []
            for row in zip(*[batch.column(i).to_pylist() for i in range(7)]):
                part, rank, place, host, path, marked, lines = row
                if not rank:
                    joined = (before and before[0] == part and before[3] == host and marked == before[5]
                              and _are_copies(path, lines, before[4], before[6], len(common_lines(lines, before[6])), copy_share))
                    at.append(place)
                    starts.append(not joined)
                before = row
            yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "starts": pa.array(starts, pa.bool_())})
    return run


def _difference(copy_share: float):
    """mapInArrow function over pages in order, each range between the pages next to its first and its last run (rank not 0).

    A run's pages wait in memory for the page after it: the line hashes of one range at most.
    """
    def answer(page, near):
        _, _, l1, l2, host, path, marked, lines, _, outside = page
        if marked and not outside:
            return None
        near = [p for p in near if p and p[4] == host and (p[6] or not marked)]
        for other in sorted(near, key=lambda p: -len(commonprefix([p[5], path]))):  # the preceding page of equals
            shared = common_lines(lines, other[7])
            if len(shared) < len(lines) and not _are_copies(path, lines, other[5], other[7], len(shared), copy_share):
                if marked:  # its neighbour is, too
                    there = {other[7][i] for i in other[9]}
                    shared = [i for i in shared if i in set(outside) and lines[i] in there]
                return (host, l1, l2, marked, shared) if shared else None
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, left, same = None, None, []

        def table(found):
            found = [x for x in found if x]
            return pa.RecordBatch.from_pydict({
                "host": pa.array([x[0] for x in found], pa.string()), "l1": pa.array([x[1] for x in found], pa.int64()),
                "l2": pa.array([x[2] for x in found], pa.int64()), "marked": pa.array([x[3] for x in found], pa.bool_()),
                "gone": pa.array([x[4] for x in found], pa.list_(pa.int32()))})
        for batch in batches:
            found = []
            for row in zip(*[batch.column(i).to_pylist() for i in range(10)]):
                if row[0] != part:
                    found += [answer(page, (left, None)) for page in same]
                    part, left, same = row[0], None, []
                if row[1] < 0:
                    left = row
                elif row[1] > 0 or row[8] and same:
                    found += [answer(page, (left, row)) for page in same]
                    left, same = same[-1] if same else left, [] if row[1] else [row]
                else:
                    same.append(row)
            yield table(found)
        yield table([answer(page, (left, None)) for page in same])
    return run


def _with_pages_across(placed: DataFrame, sent: list[tuple[int, int, int]], ranges: int) -> DataFrame:
    """Pages by range, in order, and the pages sent (place, range, -1: before or 1: after its own)."""
    rows = placed.withColumn("rank", F.lit(0))
    if sent:
        across = placed.sparkSession.createDataFrame(sent, "at long, into int, rank int")
        rows = rows.unionByName(placed.join(F.broadcast(across), "at").withColumn("part", F.col("into")).drop("into"))
    return rows.repartition(ranges, "part").sortWithinPartitions("part", "rank", "at")


def _keyed(pages: DataFrame) -> DataFrame:
    cells = [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
             F.col("html").cast("string").alias("html")]
    rows = pages.select(*cells)
    # equal keys are equal pages
    return rows.select(F.xxhash64("page_id", "url", "html").alias("k1"), F.xxhash64(F.lit(1), "page_id", "url", "html").alias("k2"),
                       "page_id", "url", "html")


def template_lines(pages: DataFrame, copy_share: float = COPY_SHARE) -> DataFrame:
    """(k1, k2, gone): numbers of the lines that a page shares with its nearest page that is no copy; of the lines of a marked
    article only those that both pages have outside their articles, too."""
    spark = pages.sparkSession
    rows = _keyed(pages).select("k1", "k2", "url", "html").mapInArrow(
        _line_hashes, "k1 long, k2 long, host string, path string, marked boolean, lines array<long>, outside array<int>").where(F.size("lines") > 0)
    same = lambda *seed: F.when(F.size("outside") == 0, F.xxhash64(*seed, "lines")).otherwise(F.xxhash64(*seed, "lines", "outside"))
    rows = cut_lineage(rows.withColumn("l1", same()).withColumn("l2", same(F.lit(1))))
    # pages with equal lines are one, under the first of their paths
    single = rows.groupBy("host", "marked", "l1", "l2").agg(F.min("path").alias("path"), F.first("lines").alias("lines"),
                                                            F.first("outside").alias("outside"))
    order = ["host", "path", "marked", "l1", "l2"]
    # kept as they are, the sorted ranges are the order of all pages; at is the place in it
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(cut_lineage(single).repartitionByRange(ranges, *order).sortWithinPartitions(*order))
    placed = placed.withColumn("at", F.monotonically_increasing_id())
    placed = placed.withColumn("part", F.shiftright("at", 33).cast("int"))
    # two numbers for each range
    ends = sorted(tuple(r) for r in placed.groupBy("part").agg(F.min("at"), F.max("at")).collect())
    last_of_previous = {ends[i][0]: ends[i - 1][2] for i in range(1, len(ends))}
    starts = cut_lineage(_with_pages_across(placed, [(at, part, -1) for part, at in last_of_previous.items()], ranges)
                         .select("part", "rank", "at", "host", "path", "marked", "lines")
                         .mapInArrow(_run_starts(copy_share), "at long, starts boolean"))
    by_range = {r.part: r for r in starts.where("starts").groupBy(F.shiftright("at", 33).cast("int").alias("part")).agg(
        F.min("at").alias("low"), F.max("at").alias("high")).collect()}
    sent, begun, first = [], None, {part: low for part, low, _ in ends}
    for part, low, _ in ends:  # the page before the run of the range's first page
        begun = low if part in by_range and by_range[part].low == low else begun
        before = last_of_previous.get(begun >> 33) if begun == first[begun >> 33] else begun - 1
        if before is not None:
            sent.append((before, part, -1))
        begun = by_range[part].high if part in by_range else begun
    after = None
    for part, _, _ in reversed(ends):  # the first page of the run after the range's last page
        if after is not None:
            sent.append((after, part, 1))
        after = by_range[part].low if part in by_range else after
    found = cut_lineage(_with_pages_across(placed.join(starts, "at"), sent, ranges)
                        .select("part", "rank", "l1", "l2", "host", "path", "marked", "lines", "starts", "outside")
                        .mapInArrow(_difference(copy_share), "host string, l1 long, l2 long, marked boolean, gone array<int>"))
    few = found.count() <= BROADCAST_ROWS
    found = found.select("host", "l1", "l2", "marked", "gone")
    return (rows.select("k1", "k2", "host", "l1", "l2", "marked").distinct()
            .join(F.broadcast(found) if few else found, ["host", "l1", "l2", "marked"]).select("k1", "k2", "gone"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from .common import text_slices
    for batch, raws in text_slices(batches, "html"):
        texts = []
        for raw, gone in zip(raws, batch.column(3).to_pylist()):
            lines = page_lines(raw.decode())[0]
            if gone:
                gone = set(gone)
                lines = [x for i, x in enumerate(lines) if i not in gone]
            texts.append("\n".join(lines))
        yield pa.RecordBatch.from_pydict({
            "page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(x) for x in texts], pa.int64())})


def main_text(pages: DataFrame, copy_share: float = COPY_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of every page row.

    ``text`` is the article's blocks joined by line feeds, with character references decoded and white
    space within a block turned into single spaces; empty if there is none, as for null or
    empty html. A null url is a page of the empty host. Repeated rows get equal answers.
    """
    gone = cut_lineage(template_lines(pages, copy_share))
    few = gone.count() <= BROADCAST_ROWS
    rows = _keyed(pages).join(F.broadcast(gone) if few else gone, ["k1", "k2"], "left").select("page_id", "url", "html", "gone")
    return rows.mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
