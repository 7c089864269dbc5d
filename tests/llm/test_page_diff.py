"""Operator 5: what wraps an article, hyphenated classes, long pages, and the extraction over neighbours."""

from __future__ import annotations

import random
import time

import pytest

from dfinsight.llm import page_diff


def kept(html):
    return [t for t, _ in page_diff.page_lines(html)]


@pytest.mark.parametrize("html, want", [
    ("<form><article><p>Body</p></article></form>", ["Body"]),
    ("<form><nav>Home</nav><main><p>Body</p><p class=ad>Buy</p></main><label>Name</label></form>", ["Body"]),
    ('<div id="social"><article><p>Body</p></article></div>', ["Body"]),
    ('<div id="social"><article><p>Card</p></article></div><article><p>Body</p></article>', ["Body"]),
    ('<form><p>Long text of a page that a framework wraps whole.</p></form><p>Short</p>', ["Long text of a page that a framework wraps whole.", "Short"]),
    ("<form><p>Name</p></form><p>A text that is longer than the form.</p>", ["A text that is longer than the form."]),
    ("<article><p>A</p></article><form><p>A form that is longer than the article</p></form>", ["A"]),
    ('<div class="post-menu-social content">main text</div>', ["main text"]),
    ('<div class="page-header"><h1>Title</h1></div><p>x</p>', ["Title", "x"]),
    ('<article><p class="story-share">A</p><p class="share">B</p></article>', ["A"]),
    ('<div class="site-footer">F</div><div class="cookie-notice big">C</div><div class="ad">A</div><div id=sidebar>S</div><p>x</p>', ["x"]),
    ("<aside><article>Teaser</article></aside><nav><main>Menu</main></nav><p>x</p>", ["x"]),
])
def test_what_is_dropped(html, want):
    assert kept(html) == want


def test_many_equal_lines_align_fast():
    a, b = ["x"] * 40_000 + ["end"], ["start"] + ["x"] * 39_000 + ["y"] + ["x"] * 500 + ["stop"]
    begun = time.process_time()
    assert len(page_diff.common_lines(a, b)) == 39_500
    assert time.process_time() - begun < 10
    assert len(page_diff.common_lines(["x"] * 40_000, ["x"] * 40_000)) == 40_000


def test_deep_nesting_is_read():
    begun = time.process_time()
    assert kept("<div>" * 20_000 + "<p>deep" + "</span></div>" * 20_000) == ["deep"]
    assert kept("<b>" * 20_000 + "<li>x</i>" * 3_000) == ["x"] * 3_000
    assert time.process_time() - begun < 20


def plain_extract(pages):
    """The neighbours of the whole URL order, template lines by a quadratic LCS."""
    key = {p: "\x01".join([u.split("/")[2], "/" + u.split("/", 3)[3], u, str(p)]) for p, u, _ in pages}
    order = sorted(pages, key=lambda r: key[r[0]])
    lines = {p: page_diff.marked_lines(h) for p, _, h in pages}
    out = {}
    for n, (p, _, _) in enumerate(order):
        sides = [order[m][0] for m in (n - 1, n + 1) if 0 <= m < len(order)]
        sides = [x for x in sides if page_diff.nearness(key[p], key[x]) >= 0]
        near = max(sides, key=lambda x: page_diff.nearness(key[p], key[x]), default=None)
        a, b = ([t for t, _ in lines[x]] if x is not None else [] for x in (p, near))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
        shared, i, j = set(), 0, 0
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                shared.add(i)
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
        marks = [m for _, m in lines[p]]
        least = max(page_diff.LOOSE, min(page_diff.IN_MAIN, max(marks, default=0)))
        body = {i for i, m in enumerate(marks) if m >= least}
        shared -= body if body <= shared else {i for i in body if marks[i] == page_diff.IN_ARTICLE}
        out[p] = "\n".join(t for i, (t, m) in enumerate(lines[p]) if m != page_diff.DROPPED and i not in shared)
    return out


def test_extraction_equals_plain_version_and_differencing_decides(spark):
    rnd = random.Random(9)
    pages = []
    for i in range(120):
        host = rnd.choice(["a.com", "a.com", "b.org"])
        top = [f"<div>{host} home</div>", "<div>Sign in</div>", f"<p>Notice of {host}</p>"]
        text = [f"<p>Text {i} {j} {rnd.random()}</p>" for j in range(rnd.randint(1, 5))]
        inner = "".join(text)
        wrap = rnd.choice(["{}", "<main>{}</main>", "<article>{}</article>", "<main><p>All rights reserved</p>{}</main>"])
        pages.append((i, f"http://{host}/{rnd.choice('xyz')}/{i}", "".join(top) + wrap.format(inner) + "<div>Imprint</div>"))
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in page_diff.extract(df).collect()}
    assert got == plain_extract(pages)
    decided = sum(len(page_diff.page_lines(h)) - len(got[p].split("\n")) for p, _, h in pages)
    assert decided > 300  # lines that markup keeps and differencing deletes
