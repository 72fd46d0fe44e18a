import html
import itertools
import random
import re
import time

from tidewatch.llm import html_extract as hx

from .helpers import table


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_articles_of_the_given_pages(spark):
    given = table(spark, "pages")
    rows = {r.page_id: r for r in hx.main_text(given).collect()}
    for r in given.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        text = "\n".join(b for b in blocks if b)
        assert rows[r.page_id].text == text and rows[r.page_id].n_chars == len(text)


def test_structure():
    page = """<html><head><title>T</title></head><body class="has-sidebar"><header>site</header>
      <nav><ul><li>menu</li></ul></nav><div class="ad"><div>buy</div> now</div>
      <div class="layout sidebar-left"><article class="post"><header><h1>Head &amp;amp; line</h1></header>
      <p>one   two<br>three <b>bold</b>ly <!-- no --> end<script>var x = "</p>";</script></p><aside>also read</aside>
      <form>subscribe <input></form><table><tr><td>a</td><td>b</td></tr></table><footer>tags</footer></article></div>
      <section id="comments"><article class="comment"><p>reader</p></article></section><div id="cookie-notice">cookies</div>
      <footer>&copy; us</footer></body></html>"""
    assert hx.page_lines(page) == (["Head &amp; line", "one two", "three boldly end", "a b"], True)


def test_broken_pages_end():
    for page in ("", "<", "text only", "<p>a<b>b<p>c", "<div class='ad'>never closed <p>x", "<script>alert(1)", "<!-- open", "<a href=\"x>y",
                 "<article><p>a</article></article><p>b", "<p>" * 5000, "<p " * 100_000, '<a href="x' * 50_000, "<!--" * 50_000, "<p>" + "<!x" * 50_000, "<a '" * 50_000 + ">", "&#x110000; &bogus; &lt;", "<style>x</style><style>"):
        assert isinstance(hx.page_lines(page)[0], list)
    assert hx.page_lines("<p>a<b>b<p>c")[0] == ["ab", "c"]
    assert hx.page_lines("<article><p>a</article></article><p>b")[0] == ["a"]


def test_long_quoted_values():
    for quote, inner in (('"', "'"), ("'", '"')):
        value = f"{{{inner}a{inner}: <b>x</b>}} > " * 6000
        assert len(value) > 100_000
        page = f"<article><div data-props={quote}{value}{quote}><p>one</p></div><p title={quote}>{quote}>two</p></article>"
        assert hx.page_lines(page) == (["one", "two"], True)
    assert hx.page_lines('<p>a > b <p <p "c')[0] == ['a > b <p <p "c']
    assert hx.page_lines("<p>a > b <p <!-- c")[0] == ["a > b <p"]
    assert hx.page_lines('<a href="x>y</a>')[0] == ["y"]
    began = time.process_time()
    hx.page_lines('<a ">"' * 200_000 + "'")  # each tag leads to the unclosed quote
    hx.page_lines("<a '>\"'>\"" * 100_000 + "'" + '"')
    assert time.process_time() - began < 20


def test_longest_common_subsequence():
    rng = random.Random(2)

    def length(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in "ab")
        at = hx.common_lines(a, b)
        assert len(at) == length(a, b) and at == sorted(at)
        rest = iter(b)
        assert all(a[i] in rest for i in at)


def unmarked(body, top="Top line of the site", end="All rights reserved"):
    return f"<body><div>{top}</div>" + "".join(f"<p>{x}</p>" for x in body) + f"<div>{end}</div></body>"


def test_nearest_page_differencing(spark):
    rows = [(1, "http://a.example/x/1", unmarked(["alpha", "beta", "gamma"])),
            (2, "http://www.a.example/x/2?p=1", unmarked(["delta", "epsilon"])),
            (3, "https://a.example/y/9", unmarked(["zeta", "eta"], top="Another top", end="Another end")),
            (4, "https://a.example/y/91", unmarked(["theta", "iota"], top="Another top", end="Another end")),
            (5, "http://b.example/x/1", unmarked(["alone", "there"])),
            (6, "http://c.example/1", unmarked(["copy", "of", "one", "page"])), (7, "http://c.example/1#top", unmarked(["copy", "of", "one", "page"]))]
    frame = "Top line of the site\n{}\nAll rights reserved"
    expected = {1: "alpha\nbeta\ngamma", 2: "delta\nepsilon", 3: "zeta\neta", 4: "theta\niota", 5: frame.format("alone\nthere"),
                6: frame.format("copy\nof\none\npage"), 7: frame.format("copy\nof\none\npage")}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in ("1", "5"):  # the neighbours may be in other tasks
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            assert {r.page_id: r.text for r in hx.main_text(pages(spark, rows)).collect()} == expected
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)


def test_copies_are_passed_over(spark):
    template = [f"part {i} of the template" for i in range(30)]
    long = [f"sentence {i} of a long article" for i in range(40)]
    near = [f"sentence {i} of an article with a counter" for i in range(30)]
    one, other = ["alpha", "beta"], ["gamma", "delta"]
    rows = [(k, f"http://a.example/n/1{q}", unmarked(one)) for k, q in enumerate(["", "", "?a=1", "?a=2", "#x"])]
    rows += [(10, "http://a.example/n/2", unmarked(other))]
    rows += [(20 + k, f"http://b.example/m/1?v={k}", unmarked([*near, f"{k} readers"])) for k in range(12)]
    rows += [(40, "http://b.example/m/2", unmarked(other))]
    rows += [(50 + k, f"http://c.example/s/{k}", unmarked([*template, f"short article {k}"])) for k in range(4)]
    rows += [(60, "http://c.example/s/9", unmarked([*template, *long]))]
    rows += [(70 + k, f"http://d.example/m/1?v={k}", unmarked([*near, f"{k} readers"])) for k in range(2)]
    expected = {k: one for k in range(5)} | {10: other, 40: other, 60: long}
    expected |= {20 + k: [*near, f"{k} readers"] for k in range(12)} | {50 + k: [f"short article {k}"] for k in range(4)}
    expected |= {70 + k: ["Top line of the site", *near, f"{k} readers", "All rights reserved"] for k in range(2)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in ("1", "3", "23"):  # a run of copies may fill several ranges
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            assert {r.page_id: r.text.split("\n") for r in hx.main_text(pages(spark, rows)).collect()} == expected
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shuffled_join_of_deleted_lines(spark, monkeypatch):
    monkeypatch.setattr(hx, "BROADCAST_ROWS", -1)
    rows = [(1, "http://a.example/x/1", unmarked(["alpha"])), (2, "http://a.example/x/2", unmarked(["beta"]))]
    assert {r.page_id: r.text for r in hx.main_text(pages(spark, rows)).collect()} == {1: "alpha", 2: "beta"}


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "http://a.example/", ""), (None, "x", "<p>a</p>"), (3, "http://a.example/b", "<p>" + "long " * 50_000 + "</p>")]
    rows += [(4, "u", "<p>twice</p>")] * 2
    wide = pages(spark, rows).selectExpr("*", "page_id as gone", "page_id as lines", "page_id as k1", "page_id as host")
    found = hx.main_text(wide).collect()
    assert len(found) == 6
    assert sorted((r.page_id or 0, r.n_chars) for r in found) == [(0, 1), (1, 0), (2, 0), (3, 249_999), (4, 5), (4, 5)]
    assert hx.main_text(pages(spark, [])).collect() == []


def without_marks(page):
    """The page with its article, nav and main elements as mere divs."""
    return re.sub(r"<(/?)(?:article|nav|main)\b[^>]*>", r"<\1div>", page or "")


def brute_difference(rows, share=hx.COPY_SHARE):
    """page_id -> lines left, of [(page_id, url, html)] without marked articles and with one page a path."""
    lines = {k: hx.page_lines(page)[0] for k, _, page in rows}
    groups = {}
    for k, url, _ in rows:
        host, path = hx.split_url(url)
        groups.setdefault((host, tuple(lines[k])), []).append((path, k))
    order = sorted((host, min(g)[0], text) for (host, text), g in groups.items() if text)

    def copies(a, b):
        shared = len(hx.common_lines(a[2], b[2]))
        return shared >= share * (min if a[1] == b[1] else max)(len(a[2]), len(b[2]))
    links = [a[0] == b[0] and copies(b, a) for a, b in itertools.pairwise(order)]
    out = {}
    for i, page in enumerate(order):
        low = high = i
        while low and links[low - 1]:
            low -= 1
        while high < len(links) and links[high]:
            high += 1
        near = [p for p in (order[low - 1] if low else None, order[high + 1] if high < len(links) else None) if p and p[0] == page[0]]
        gone = []
        for other in sorted(near, key=lambda p: -len(hx.commonprefix([p[1], page[1]]))):
            shared = hx.common_lines(page[2], other[2])
            if len(shared) < len(page[2]) and not copies(page, other):
                gone = shared
                break
        for _, k in groups[page[0], page[2]]:
            out[k] = [x for n, x in enumerate(page[2]) if n not in set(gone)]
    return {k: out.get(k, []) for k in lines}


def test_differencing_of_the_given_pages_without_their_marks(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    by_path = {hx.split_url(r.url): (r.page_id, r.url, without_marks(r.html)) for r in given}
    rows = list(by_path.values())
    assert len(rows) > 40 and not any(hx.page_lines(page)[1] for _, _, page in rows)
    found = {r.page_id: r.text for r in hx.main_text(pages(spark, rows)).collect()}
    expected = brute_difference(rows)
    assert found == {k: "\n".join(x) for k, x in expected.items()}
    assert any(len(x) < len(hx.page_lines(page)[0]) for (_, _, page), x in zip(rows, expected.values()))


def test_differencing_of_marked_articles(spark):
    def page(article, menu=("Home", "Send to a friend"), tag="article"):
        return f"<nav>{''.join(f'<a>{x}</a><br>' for x in menu)}</nav><{tag}>{''.join(f'<p>{x}</p>' for x in article)}</{tag}><footer>All rights</footer>"
    rows = [(1, "http://a.example/x/1", page(["alpha", "Send to a friend", "a shared paragraph", "All rights"])),
            (2, "http://a.example/x/2", page(["beta", "Send to a friend", "a shared paragraph", "All rights"])),
            (3, "http://b.example/x/1", page(["gamma", "Home"])),  # only one page has it in its article
            (4, "http://b.example/x/2", page(["delta", "Send to a friend"], menu=["Home"])),  # not outside this article
            (5, "http://c.example/x/1", page(["same text", "Home"])), (6, "http://c.example/x/2", page(["same text", "Home"])),  # copies
            (7, "http://d.example/x/1", page(["epsilon", "Home", "end"], tag="main")), (8, "http://d.example/x/1?q=2", page(["epsilon", "Home", "end"])),
            (9, "http://d.example/x/3", page(["zeta", "Home"])), (10, "http://d.example/x/4", unmarked(["eta"]))]
    assert hx.page_blocks(rows[0][2]) == (["alpha", "Send to a friend", "a shared paragraph", "All rights"], True, [1, 3])
    expected = {1: ["alpha", "a shared paragraph"], 2: ["beta", "a shared paragraph"], 3: ["gamma", "Home"], 4: ["delta", "Send to a friend"],
                5: ["same text", "Home"], 6: ["same text", "Home"], 7: ["epsilon", "end"], 8: ["epsilon", "end"], 9: ["zeta"],
                10: ["Top line of the site", "eta", "All rights reserved"]}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in ("1", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            assert {r.page_id: r.text.split("\n") for r in hx.main_text(pages(spark, rows)).collect()} == expected
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
