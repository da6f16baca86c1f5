"""HTML extraction."""

import html as entities
import re

import numpy as np

from skytrace.llm import html


def text(page):
    return " ".join(html.blocks(page))


def test_structure():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>top</header><nav><ul><li>menu</ul></nav><div class="ad banner">buy</div>
    <article><header><h1>Head &amp; line</h1></header><p>One<b>two</b> three<br>four &lt;x&gt;</p><script>var t="</p>";</script><p>Caf&eacute;&nbsp;au  lait</p>
    <aside>side</aside><form><p>mail</p></form><div id="comments"><p>nice</p></div><footer>by me</footer></article><footer>foot</footer></body></html>"""
    assert text(page) == "Head & line Onetwo three four <x> Café au lait"


def test_odd_pages():
    assert html.blocks("") == []
    assert text("just text &am") == "just text &am"
    assert text("<p>a<p>b<!-- c --><p>d <!-- never closed") == "a b d"
    assert text("<body><div class=ad>x <article><p>y</article>") == "y"
    assert text("<main><p>m</p></main><p>out</p>") == "m"
    assert text("<p>a</p><script>if (a<b) {") == "a"
    assert text("<p hidden>a</p><p>b</p><div style='display: none'>c<div>d</div>e</div>f") == "b f"
    assert text("<p>1 < 2 and a<b") in ("1 < 2 and a", "1 < 2 and a<b")


def test_names_mark_as_a_whole():
    page = """<article><p class=it's>one</p><div class="social-history"><p>two</p></div><section id="related-work"><p>three</p></section><div class="ad-slot x">buy</div>
    <div id="comment_list"><p>nice</p></div><div class="cookie-banner">cookies</div><p title="a>b" data-x='c>d'>four</p></article>"""
    assert text(page) == "one two three four"


NOTICE = "subscribe to our weekly letter and never miss any of our stories again"


def made_pages(rng, n, wrap, notice=NOTICE, words=30):
    word = lambda: "w" + str(rng.integers(10**6))
    return [(" ".join(word() for _ in range(words)), notice, " ".join(word() for _ in range(20)), wrap) for _ in range(n)]


def page(parts):
    a, notice, b, wrap = parts
    return wrap.format(f"<p>{a}</p><p>{notice}</p><p>{b}</p>")


def test_the_suffix_array_alone_decides(spark, tmp_path):
    """Through the query: unmarked boilerplate that only repeats over a host's pages tell."""
    from skytrace.llm import queries

    rng = np.random.default_rng(0)
    body, article = "<html><body>{}</body></html>", "<html><body><article>{}</article></body></html>"
    on_all, on_few, on_some, short = made_pages(rng, 20, article), made_pages(rng, 20, article), made_pages(rng, 20, body), made_pages(rng, 6, body, words=9)
    on_few = [p if i < 6 else (p[0], "", *p[2:]) for i, p in enumerate(on_few)]  # a passage that some articles share stays
    on_some = [p if i < 8 else (p[0], "", *p[2:]) for i, p in enumerate(on_some)]
    short = [(a, f"{n} {n} {n} {n}", "", w) for a, n, _, w in short]  # boilerplate is most of the page
    few = made_pages(rng, 3, body)  # under min_pages
    copies = [("exactly the same article stands on each of these many pages of one host", "", "", body)] * 20
    edited = []  # near copies: no unique run of eight tokens
    for i in range(12):
        w = [f"e{k}" for k in range(60)]
        w[5 * i] = f"x{i}"
        edited.append((" ".join(w), "", "", body))
    sites = [on_all, on_few, on_some, short, few, copies, edited]
    joined = lambda parts: " ".join(x for x in parts if x)
    plain = lambda p: joined(p[:3])
    want = [[joined([p[0], p[2]]) for p in on_all], [plain(p) for p in on_few], [joined([p[0], p[2]]) for p in on_some], [p[0] for p in short], *([plain(p) for p in x] for x in (few, copies, edited))]
    rows = [(100 * s + i, f"http://h{s}.x/{i}", page(p)) for s, site in enumerate(sites) for i, p in enumerate(site)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    df.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    expected = {100 * s + i: t for s, x in enumerate(want) for i, t in enumerate(x)}
    assert {r.page_id: r.text for r in queries.op4_html_extraction(spark, str(tmp_path)).collect()} == expected
    for changed in ({"broadcast_rows": 0}, {"shard_pages": 10}, {"shard_pages": 10, "task_pages": 3}):
        assert {r.page_id: r.text for r in html.extract(df, html.HtmlParams(**changed)).collect()} == expected


def test_repeats_by_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        streams = [rng.integers(0, 4, rng.integers(0, 15)).astype(np.uint64) for _ in range(10)]
        where = {}
        for i, s in enumerate(streams):
            for k in range(len(s) - 2):
                where.setdefault(int(html.window_hashes(s, np.array([k]), 3)[0]), set()).add(i)
        found, pages = html.repeats(streams, 3)
        assert dict(zip(found.tolist(), pages.tolist())) == {h: len(p) for h, p in where.items()}


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in html.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        body = re.sub(r"</?(p|h1|br)[^>]*>", "\n", re.sub(r"<!--.*?-->", "", body, flags=re.S))
        want = " ".join(entities.unescape(re.sub(r"</?[a-z][^>]*>", "", body)).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_nulls_and_shards(spark):
    rows = [(1, None, None, "x"), (None, "http://a.b/c", "<p>t</p>", "y"), (2, "nonsense", "", None), (2, "nonsense", "", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in html.extract(df).collect()) == [("1", "", 0), ("2", "", 0), ("2", "", 0), ("None", "t", 1)]
    many = spark.createDataFrame([(i, f"http://h.x/{i}", f"<p>page {i}</p>", None) for i in range(50)], df.schema)
    assert html.extract(many, html.HtmlParams(shard_pages=8)).count() == 50
    assert html.extract(df.limit(0)).count() == 0
