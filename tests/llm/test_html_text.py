"""Main text: structure, and the suffix array against a direct search."""

import html
import random
import re

import numpy as np

from rankstream.llm import catalog, html_text as h

PAGES = "page_id long, url string, html string"


def article(page):
    return h.SEPARATOR.join(t for zone, t in h.blocks(page) if zone == "article")


def test_structure():
    page = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>"</p>"</script></head>
    <body class="home nav"><header><h1>no</h1></header><nav><ul><li><a>no</a></ul></nav>
    <div class="cookie-notice">no<div>no</div></div><!-- <p>no</p> -->
    <article class="post header"><h1>Title  of\n it</h1><p>One <b>bold</b>&amp; more<br>line<p>Two&nbsp;&eacute;
    <div class="ad">no</div><form>no<p>no</p></form><p class='x'>Th<i>r</i>ee</p><aside><p>no</p></aside>
    <ul><li>a<li>b</ul><table><tr><td>c</td><td>d</td></tr></table><span class="share">no</span> tail
    <noscript>no</noscript><section id=comments><p>no</p></section><footer>no</footer></article>
    <article class="comment"><p>no</p></article><footer>no</footer></body></html>"""
    assert article(page).split("\n\n") == [
        "Title of it", "One bold& more line", "Two é", "Three", "a", "b", "c d", "tail"
    ]


def test_broken_markup():
    assert article("<article><p>open <b>bold <p>next") == "open bold\n\nnext"
    assert article("<article><p>cut &am") == "cut &am"
    assert article("<article><p>cut <a href='x") == article('<article><p>cut <a href="x>') == "cut"
    assert article("<article><p class=x'>stray quote</p><p title='>'>kept") == "stray quote\n\nkept"
    assert article("<article><p>a</div></p>b</article><p>c") == "a\n\nb"
    assert article("<article>a < b <script>never closed <p>x") == "a < b"
    assert article(None) == article("") == article("<p>x</p>") == ""
    assert article("<main><p>x</p></main>") == "x"
    assert len(article("<article>" + "<div>" * 3000 + "x" + "<p>y" * 3000)) > 3000


def direct_cover(tokens, page, repeat):
    where = {}
    for i in range(len(tokens) - repeat + 1):
        if page[i] == page[i + repeat - 1]:
            where.setdefault(tuple(tokens[i : i + repeat]), []).append(i)
    covered = [False] * len(tokens)
    for starts in where.values():
        if len({page[s] for s in starts}) > 1:
            for s in starts:
                covered[s : s + repeat] = [True] * repeat
    return covered


def test_suffix_array_equals_direct_search():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(0, 80)
        tokens = [rng.randint(0, 2) for _ in range(n)]
        page = sorted(rng.randint(0, 4) for _ in range(n))
        for repeat in (1, 2, 4, 8):
            got = h.repeated_tokens(np.array(tokens, int), np.array(page, int), repeat)
            assert got.tolist() == direct_cover(tokens, page, repeat)


def test_unmarked_pages_lose_what_the_host_repeats(spark):
    menu = "<div>Home news sport weather travel shop help contact</div>"
    end = "<div>Copyright by the owners of this site all rights reserved</div>"
    rows = [(i, f"http://a.net/{i}", f"<p>{menu}<p>w{i} x{i} y{i}, z{i}</p>{end}") for i in range(6)]
    rows += [(10, "http://b.net/", f"{menu}<p>lonely page text</p>"), (11, None, None), (12, "", ""),
             (13, "http://a.net/m", f"{menu}<article><p>marked text</p></article>"),
             (14, "http://c.net/", f"<p>{menu}"), (14, "http://c.net/", f"<p>{menu}")]
    for shard_pages in (2000, 3):
        got = h.extracted(spark.createDataFrame(rows, PAGES), shard_pages=shard_pages).collect()
        text = {r.page_id: r.text for r in got}
        assert len(got) == len(rows)
        if shard_pages == 2000:
            assert all(text[i] == f"w{i} x{i} y{i}, z{i}" for i in range(6))
        assert text[10].endswith("lonely page text") and "Home" in text[10] and "Home" in text[14]
        assert text[11] == text[12] == "" and text[13] == "marked text"
    assert h.extracted(spark.createDataFrame([], PAGES)).collect() == []


def test_shards_do_not_change_the_text(spark):
    """Passages on two pages of a host only, whichever shards the pages are in."""
    rows = []
    for i in range(24):
        words = " ".join(f"p{i // 2}w{k}" for k in range(9))
        rows.append((i, f"http://a.net/{i}", f"<p>own{i} text{i}</p><p>{words}</p><p>end{i}</p>"))
    df = spark.createDataFrame(rows, PAGES)
    for shard_pages in (2000, 2):
        got = {r.page_id: r.text for r in h.extracted(df, shard_pages=shard_pages).collect()}
        assert got == {i: f"own{i} text{i}\n\nend{i}" for i in range(24)}


def test_query(spark, sf_dir):
    got = {r.page_id: r for r in catalog.QUERIES["op6_host_suffix_text"](spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*?)(</article>|\Z)", p.html, re.S).group(1)
        parts = [html.unescape(re.sub(r"<[^>]*(>|\Z)", " ", b)) for b in re.split(r"</?p>|</?h1>|<p\b[^>]*\Z", body)]
        want = "\n\n".join(b for b in (" ".join(x.split()) for x in parts) if b)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)
        assert got[p.page_id].url == p.url


def test_clashing_columns(spark):
    """Columns named like the operator's own change nothing."""
    data = [(1, "http://a.org/x", "<article><p>one"), (2, "http://a.org/y", "<p>two three"), (3, None, None)]
    plain = spark.createDataFrame(data, PAGES)
    names = "text string, host string, s int, blocks string, marked boolean, shard int, run long, n long"
    odd = spark.createDataFrame([(*row, "t", "h", 1, "b", False, 2, 3, 4) for row in data], f"{PAGES}, {names}")
    got = h.extracted(odd)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, h.extracted(plain).collect()), key=repr)


def test_marked_pages_go_through_the_suffix_array(spark, monkeypatch):
    """What marked pages repeat outside of articles is boilerplate of unmarked ones; articles are content."""
    menu = "<div>Home news sport weather travel shop help contact us today</div>"
    story = "This story of ten words is marked on one page"
    rows = [(1, "http://a.net/1", f"{menu}<article><p>{story}</p></article>"),
            (2, "http://a.net/2", f"{menu}<p>{story}</p>"), (3, "http://a.net/3", f"<p>{story}</p>"),
            (4, "http://a.net/4", f"{menu}<article><p>{story}<p>end</article>"),
            (4, "http://a.net/4", f"{menu}<article><p>another</article>"),
            (None, "http://a.net/5", f"{menu}<article><p>five</article>"),
            (2**60 + 1, "http://a.net/6", f"{menu}<p>six</p>")]
    for shard_pages in (2000, 1, 2):
        got = h.extracted(spark.createDataFrame(rows, PAGES), shard_pages=shard_pages).collect()
        assert sorted(map(tuple, got), key=repr) == sorted([
            (1, "http://a.net/1", story), (2, "http://a.net/2", story), (3, "http://a.net/3", story),
            (4, "http://a.net/4", f"{story}\n\nend"), (4, "http://a.net/4", "another"),
            (None, "http://a.net/5", "five"), (2**60 + 1, "http://a.net/6", "six"),
        ], key=repr)
