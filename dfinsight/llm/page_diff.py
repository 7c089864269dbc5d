"""Operator 5, HTML extraction by nearest-URL page differencing.

Pages are ordered by host, URL path and id. A page's nearest page is the neighbour in that order that is
on the same host and shares the longer run of leading path segments (the earlier one on a tie). Both
pages are cut into text lines, one per block of the markup, menus, headers and footers included (only
scripts, styles and the like hold no lines); all lines are aligned by a longest common subsequence and the
shared ones are template text. Markup follows as the check. It drops the menus, headers, footers, sidebars,
forms, adverts, notices and comments that the neighbour does not share, and it protects the article: lines
of an article element are never template. A class, id or role drops an element only if it names junk and nothing else,
and no form or class drops the page's only article or main. A page's lines inside article and main (where it has neither, all
lines that markup does not drop) also tell copies: if none of them differs from the neighbour's, the
neighbour is a copy and they stay; if some do, the shared ones go, however much of the text they are.

The order is cut into ranges at sampled keys, so a host with a third of all pages spreads over many
ranges; the pages at the two ends of a range are sent to the next range too, so the result does not
depend on the cuts. Page texts are shuffled once. What reaches the driver are two keys per range.

End tags that HTML lets a page omit (head, p, li, dt, dd, option, rows and cells) are inferred, so what a
dropped element drops ends where the element does; svg and math closed by a slash are empty.

Defined cases: null or empty html gives an empty text; a null or odd URL has an empty host and path;
repeated rows are neighbours like any others; a page alone on its host is cleaned by markup alone; very
long pages are taken whole; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .base import map_arrow, pieces, table

TOKEN = re.compile(r"<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>?|<[!?][^>]*>?", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
RAW = frozenset("script style noscript template iframe noframes object svg math textarea title".split())
#: Of these a slash closes only the two that are not HTML; one at the end of an unquoted value is part of it.
FOREIGN = frozenset(("svg", "math"))
UNQUOTED_END = re.compile(r"=\s*[^\s\"'=]+$")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th
thead tr ul""".split())
#: What may stand in head; any other element, or text, ends a head that is still open.
IN_HEAD = frozenset("base link meta noframes noscript script style template title".split())


def _ends() -> dict[str, list[tuple[frozenset, frozenset]]]:
    """Omitted end tags: an opening tag ends the open elements named first, out to the nearest one named second."""
    paragraph = (frozenset("p".split()), frozenset("button caption html table td th marquee".split()))
    item = lambda own: (frozenset(own.split()), BLOCK - frozenset(f"address div p {own}".split()))
    rows = "caption colgroup tr td th"
    out = {name: [paragraph] for name in """address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p pre search section summary table ul""".split()}
    for names, own in (("li", "li"), ("dt dd", "dt dd")):
        for name in names.split():
            out[name] = [item(own), paragraph]
    for names, ended, within in (("option", "option", "select datalist"), ("optgroup", "option optgroup", "select"), ("td th", "td th", "tr table"),
                                 ("tr", rows, "table thead tbody tfoot"), ("thead tbody tfoot", rows + " thead tbody tfoot", "table")):
        for name in names.split():
            out[name] = [(frozenset(ended.split()), frozenset(within.split()))]
    return out


ENDS = _ends()
#: Markup of the pages of one range of the URL order, so one task; more ranges than shuffle partitions where there are more.
RANGE_BYTES = 256 << 20
JUNK = frozenset("nav footer aside button select menu dialog head".split())
#: What markup says of a line, in the order of trust: dropped, nothing, inside main, inside an article.
DROPPED, LOOSE, IN_MAIN, IN_ARTICLE = range(4)
CORE = {"main": IN_MAIN, "article": IN_ARTICLE}
#: Why an element is dropped: not at all, a form, by its class, id or role, by its name.
KEPT, FORM, NAMED, JUNK_ELEMENT = range(4)
#: Marks of lines that are decided when the whole page is known: of a form, and of main or an article inside a form or
#: inside an element that is junk by its class (a multiple of SUSPECT more than their own mark).
FORM_LINE, SUSPECT = -1, 10
JUNK_NAMES = frozenset("""ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer
footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo promotion related share sharing sidebar social
sponsor sponsored subscribe widget complementary contentinfo search""".split())
#: Words that say nothing in a class of several words.
EMPTY_NAMES = frozenset(("global", "site"))


def is_junk_name(name: str, junk: frozenset) -> bool:
    """A class, id or role that names junk: a junk word, or several of them joined, and no other word."""
    words = set(re.split(r"[-_]+", name)) - {""}
    return name in junk or bool(words & junk) and words <= junk | EMPTY_NAMES


def junk_kind(name: str, attributes: str, inside_core: bool) -> int:
    if name in JUNK or name == "header" and not inside_core:
        return JUNK_ELEMENT
    if attributes and name not in ("html", "body", *CORE):
        junk = JUNK_NAMES - {"header"} if inside_core else JUNK_NAMES
        if any(is_junk_name(w, junk) for m in ATTRIBUTE.finditer(attributes) for w in (m[2] or m[3] or m[4] or "").lower().split()):
            return NAMED
    return FORM if name == "form" else KEPT


def _settled(lines: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The lines with what only the whole page tells. Where no main or article stands outside, one inside a form counts,
    and one inside an element that is junk by its class if it is most of the text. Lines of forms count if there is no
    main or article at all and they are most of the text that is left."""
    wrapped = not any(m in (IN_MAIN, IN_ARTICLE) for _, m in lines)
    inside, every = (sum(len(t) for t, m in lines if m >= least) for least in (FORM_LINE + NAMED * SUSPECT, FORM_LINE))
    counts = {FORM: wrapped, NAMED: wrapped and 2 * inside > every}
    lines = [(t, (m % SUSPECT if counts[m // SUSPECT] else DROPPED) if m >= SUSPECT else m) for t, m in lines]
    size = lambda mark: sum(len(t) for t, m in lines if m == mark)
    forms = not any(m > LOOSE for _, m in lines) and size(FORM_LINE) > size(LOOSE)
    return [(t, (LOOSE if forms else DROPPED) if m == FORM_LINE else m) for t, m in lines]


def marked_lines(html: str | None) -> list[tuple[str, int]]:
    """(text, what markup says of it) of every block of a page. Dropped text inside a block is a line of its own."""
    html = html or ""
    out: list[tuple[str, int]] = []
    texts: tuple[list[str], ...] = ([], [], [])  # of this block: kept, of a form, dropped
    stack: list[tuple[str, int, int]] = []  # name, why it is dropped, mark from here on
    opened: Counter = Counter()  # names in the stack
    at = 0

    def leave(depth: int):
        opened.subtract(x[0] for x in stack[depth:])
        del stack[depth:]

    def hold(text: str):
        if stack and stack[-1][0] == "head" and text.strip():
            leave(len(stack) - 1)
        texts[min(stack[-1][1], 2) if stack else KEPT].append(text)

    def flush():
        for some, mark in zip(texts, (stack[-1][2] if stack else LOOSE, FORM_LINE, DROPPED)):
            if some:
                if text := " ".join(unescape("".join(some)).split()):
                    out.append((text, mark))
                some.clear()

    for m in iter(lambda: TOKEN.search(html, at), None):
        if m.start() > at:
            hold(html[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name == "br":
            hold(" ")
            continue
        if m[1]:
            if name in BLOCK:
                flush()
            if opened[name] > 0:
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
                if any(stack[i][0] in BLOCK for i in range(depth, len(stack))):
                    flush()
                leave(depth)
            continue
        if stack and stack[-1][0] == "head" and name not in IN_HEAD:
            leave(len(stack) - 1)
        if name in RAW:
            if name in FOREIGN and m[3].endswith("/") and not UNQUOTED_END.search(m[3]):
                hold(" ")
                continue
            close = re.compile(f"</{re.escape(name)}\\b[^>]*>?", re.I).search(html, at)
            at = close.end() if close else len(html)
            hold(" ")
            continue
        if name in BLOCK or name in ENDS:
            flush()
        for ended, within in ENDS.get(name, ()):
            first = None
            if not any(opened[x] > 0 for x in ended):
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ended:
                    first = i
                elif stack[i][0] in within:
                    break
            if first is not None:
                leave(first)
        if name not in VOID and not m[3].endswith("/"):
            outer, mark = stack[-1][1:] if stack else (KEPT, LOOSE)
            core = CORE.get(name, LOOSE)
            if core > LOOSE and outer in (FORM, NAMED):
                outer, mark = KEPT, core + outer * SUSPECT
            else:
                mark = max(mark, core + mark // SUSPECT * SUSPECT)
            stack.append((name, max(outer, junk_kind(name, m[3], mark > LOOSE)), mark))
            opened[name] += 1
    if at < len(html):
        hold(html[at:])
    flush()
    return _settled(out)


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """The lines of a page that markup does not drop."""
    return [x for x in marked_lines(html) if x[1] != DROPPED]


def _bit_rows(a: list, b: list) -> np.ndarray:
    """Length of a longest common subsequence of ``b`` with each prefix of ``a``, by bit-parallel rows."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        if hit := row & places.get(x, 0):
            row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(a)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_lines(a: list[str], b: list[str]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``. Equal ends are taken at once; what is left is halved,
    each half given the part of ``a`` that serves both best (Hirschberg), with bit-parallel rows: memory is linear,
    and time that of (lines of a) x (lines of b) / 64 word operations, also where all lines are equal."""
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, n = todo.pop()
        while i < k and j < n and a[i] == b[j]:
            out.append(i)
            i, j = i + 1, j + 1
        while i < k and j < n and a[k - 1] == b[n - 1]:
            k, n = k - 1, n - 1
            out.append(k)
        if i == k or j == n:
            continue
        if n - j == 1:
            if b[j] in (some := a[i:k]):
                out.append(i + some.index(b[j]))
            continue
        middle = (j + n) // 2
        before, after = _bit_rows(a[i:k], b[j:middle]), _bit_rows(a[i:k][::-1], b[middle:n][::-1])
        cut = i + int(np.argmax(before + after[::-1]))
        todo += [(i, cut, j, middle), (cut, k, middle, n)]
    return sorted(out)


def template_lines(lines: list[tuple[str, int]], other: list[tuple[str, int]]) -> set[int]:
    """Positions of the lines of a page that are template text, told by its nearest page."""
    shared = set(common_lines([t for t, _ in lines], [t for t, _ in other]))
    least = max(LOOSE, min(IN_MAIN, max((m for _, m in lines), default=DROPPED)))
    body = {i for i, (_, m) in enumerate(lines) if m >= least}
    return shared - (body if body <= shared else {i for i in body if lines[i][1] == IN_ARTICLE})


def without_template(lines: list[tuple[str, int]], other: list[tuple[str, int]] | None) -> list[str]:
    """The lines of a page that neither its nearest page nor its markup tells to be template text."""
    template = template_lines(lines, other) if other else ()
    return [t for i, (t, m) in enumerate(lines) if m != DROPPED and i not in template]


def url_key(url: Column, page_id: Column) -> Column:
    """Sort key: host, path, whole URL and id, separated by a character no URL holds."""
    u = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.concat_ws("\x01", host, path, u, F.coalesce(page_id.cast("string"), F.lit("")))


def nearness(a: str, b: str) -> int:
    """-1 on different hosts, else the number of leading path segments in common."""
    (host, path, *_), (host2, path2, *_) = a.split("\x01"), b.split("\x01")
    if host != host2:
        return -1
    n = 0
    for x, y in zip(path.split("/"), path2.split("/")):
        if x != y:
            break
        n += 1
    return n


ROW = "bucket int, key string, own boolean, page_id {kind}, url string, lines array<string>, marks array<tinyint>"


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    spark = pages.sparkSession
    size = pages.agg(F.sum(F.octet_length(F.col(html)))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")) \
        .withColumn("key", url_key(F.col("url"), F.col("page_id")))
    ends = (rows.select("key").repartitionByRange(parts, "key").groupBy(F.spark_partition_id().alias("p"))
            .agg(F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("lo").collect())  # two keys per range
    lows, highs = [r.lo for r in ends], [r.hi for r in ends]
    kind = rows.schema["page_id"].dataType.simpleString()

    def cut(batches):
        for b in pieces(batches, 512):
            take, bucket, own, lines, marks = [], [], [], [], []
            for i, (k, h) in enumerate(zip(b.column(3).to_pylist(), b.column(2).to_pylist())):
                p = min(bisect_left(highs, k), len(highs) - 1)
                found = marked_lines(h)
                for to in (p, *([p - 1] if k <= lows[p] and p else []), *([p + 1] if k >= highs[p] and p + 1 < len(highs) else [])):
                    take.append(i)
                    bucket.append(to)
                    own.append(to == p)
                    lines.append([t for t, _ in found])
                    marks.append([c for _, c in found])
            idx = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), b.column(3).take(idx), pa.array(own, pa.bool_()), b.column(0).take(idx), b.column(1).take(idx),
                                              pa.array(lines, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.int8()))],
                                             names=["bucket", "key", "own", "page_id", "url", "lines", "marks"])

    def difference(batches):
        before = now = None  # (bucket, key, own, page_id, url, lines)

        def result(after):
            sides = [x for x in (before, after) if x and x[0] == now[0]]
            near = max(sides, key=lambda x: nearness(now[1], x[1]), default=None)
            if near and nearness(now[1], near[1]) < 0:
                near = None
            return now[3], now[4], "\n".join(without_template(now[5], near and near[5]))

        def batch_of(done):
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], id_type), pa.array([d[1] for d in done], pa.string()),
                                               pa.array([d[2] for d in done], pa.string()), pa.array([len(d[2]) for d in done], pa.int64())],
                                              names=["page_id", "url", "text", "n_chars"])

        id_type = None
        for b in pieces(batches, 512):
            id_type, done = b.schema.field("page_id").type, []
            cols = [c.to_pylist() for c in b.columns]
            for bucket, k, own, pid, u, lines, marks in zip(*cols):
                after = (bucket, k, own, pid, u, list(zip(lines, marks)))
                if now and now[2]:
                    done.append(result(after))
                before, now = now, after
            yield batch_of(done)
        if now and now[2]:
            yield batch_of([result(None)])

    cutted = map_arrow(rows.select("page_id", "url", "html", "key"), cut, ROW.format(kind=kind))
    placed = cutted.repartitionById(parts, F.col("bucket")).sortWithinPartitions("bucket", "key", "page_id")
    return map_arrow(placed, difference, f"page_id {kind}, url string, text string, n_chars long")


def q_page_diff(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
