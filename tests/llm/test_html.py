import pyarrow as pa
import pytest

from beaconlake.llm import html_text

SCHEMA = "page_id long, url string, html string, host string, copy long, leaves string"


def texts(page):
    return [leaf["text"] for leaf in html_text.content(page, None, html_text.Matcher())]


@pytest.mark.parametrize(("page", "expected"), [
    ("", []),
    ("<p>a<p>b", ["a", "b"]),
    ("a < b &amp; c&#233;", ["a < b & cé"]),
    ("<div class='ad'>x</div><div>y <b>z</b>\n w</div>", ["y z w"]),
    ("<ul><li>1<li>2</ul>t", ["1", "2", "t"]),
    ("<!-- x --><p>y<!-- z", ["y"]),
    ("<script>var t='</p>';</script><style>p{}</style><p>x", ["x"]),
    ("<article><header><h1>T</h1></header><p>a<br>b</p><aside>q</aside></article><p>out</p>", ["T", "a b"]),
    ("<body><nav><a href=x>m</a></nav><p>text here</p><footer>f</footer><form>g</form></body>", ["text here"]),
    ("<p>one</p><div id='comments'><p>reader</p></div><p hidden>h</p>", ["one"]),
    ("<div><a href='/a'>link</a></div><div>words <a href='/a'>l</a></div>", ["words l"]),
    ("<p>unclosed <b", ["unclosed"]),
    ("<div class='post-social-science'><h1>On society</h1><p>All of its words</p></div><p>x</p>", ["On society", "All of its words", "x"]),
    ("<div class='post-social-science'>links</div><p>All of the words of the article</p>", ["All of the words of the article"]),
    ("<p>first words</p><p><a href='/a'>a paragraph that is one link</a></p>", ["first words", "a paragraph that is one link"]),
    ("<article>Teaser</article><div><p>The longer body of the page stands outside</p></div>", ["Teaser", "The longer body of the page stands outside"]),
    ("<p>one <span class='ad'>Buy <b>now</b></span>two <i style='display: none'>three</i> <b hidden>four</b>five</p>", ["one two five"]),
    ("<p>one <span class='ad'>Buy</p><p>two</p>", ["one", "two"]),
    ("<app-sidebar><p>Elsewhere</p></app-sidebar><p>Words of the article itself</p><my-text>more words</my-text>", ["Words of the article itself", "more words"]),
    ("<p>short</p><div class='comment-list'><p>Readers write much more than the article has words</p></div>", ["short"]),
    ("<ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul><p>words</p>", ["words"]),
])
def test_pages(page, expected):
    assert texts(page) == expected


def test_tree_matching_counts_common_elements():
    matcher = html_text.Matcher()
    a, _ = html_text.parsed("<div><p>1<p>2<ul><li>x</ul></div>")
    b, _ = html_text.parsed("<div><p>1<h2>new</h2><p>2<ul><li>x<li>y</ul></div>")
    assert matcher.size(matcher.shape(a), matcher.shape(b)) == matcher.sizes[matcher.shape(a)]
    out = {}
    matcher.align(a, b, out)
    assert out == {0: 0, 2: 1, 3: 2}


def test_deeply_nested_pages():
    matcher = html_text.Matcher()
    deep = "<div><blockquote>" * 3000 + "words"
    base = "<h2>Our site</h2>" + "<div><blockquote>" * 2990 + "words<p>more"
    found = html_text.content(f"<h2>Our site</h2>{deep}", base, matcher)
    assert [(leaf["text"], leaf["node"]) for leaf in found] == [("Our site", 0), ("words", -1)]
    assert [(leaf["text"], leaf["same"]) for leaf in html_text.content(base + "<p>end", base, matcher)][-2:] == [("more", True), ("end", False)]


def test_wrappers(spark):
    def page(n, host="site.org", body=None):
        return (n, f"http://{host}/{n}", f"<h2>Our site</h2><div>{body or f'Story number {n} has its words'}</div><p>All rights</p>", None, None, None)

    rows = [page(n) for n in range(6)] + [page(n, "copies.org", "same") for n in range(10, 16)] + [page(20, "one.org")]
    rows += [(None, None, None, None, None, None), (31, "bad url", "<p>x</p>", "h", 1, "l"), (32, None, "", "h", 1, "l"), rows[0]]
    found = {}
    for r in html_text.extracted(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect():
        assert r.n_chars == len(r.text)
        found.setdefault(r.page_id, []).append(r.text)
    assert found[3] == ["Story number 3 has its words"]
    assert found[0] == ["Story number 0 has its words"] * 2
    assert found[12] == ["Our site\n\nsame\n\nAll rights"] and found[20][0].startswith("Our site")
    assert found[None] == [""] and found[31] == ["x"] and found[32] == [""]


def test_wrappers_of_pages_unlike_the_first(spark):
    def row(n, host, html):
        return (n, f"http://{host}/{n}", html, None, None, None)

    def story(n):
        return f"<h2>Our site</h2><div>Story number {n} has its words</div><p>All rights</p>"

    # a broken page, a front page and a page without the notice come first
    rows = [row(0, "a.org", "<p"), *(row(n, "a.org", story(n)) for n in range(1, 8))]
    rows += [row(20, "b.org", "<ul><li>Front<li>page</ul>"), *(row(n, "b.org", story(n)) for n in range(21, 28))]
    plain = "<div>Story number 40 has its words</div><h2>Words</h2><p>Other end</p>"
    rows += [row(40, "c.org", plain), *(row(n, "c.org", f"<p>Read this notice</p>{story(n)}") for n in range(41, 61))]
    # the layouts of one host have too few pages each
    rows += [row(n, "d.org", story(n) + "<table><tr><td>cell</table>" * (n % 2) + "<pre>code</pre>" * (n % 3 > 1)) for n in range(70, 76)]
    found = {r.page_id: r.text for r in html_text.extracted(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    for n in (1, 7, 21, 27, 41, 60):
        assert found[n] == f"Story number {n} has its words"
    assert all("Our site" not in found[n] and "All rights" not in found[n] for n in range(70, 76))
    assert all(f"Story number {n} has its words" in found[n] for n in range(70, 76))


def test_no_pages(spark):
    assert html_text.extracted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    found = html_text.extracted(pages).collect()
    assert len(found) == pages.count()
    for r in found:
        assert r.text and "<p>" not in r.text and "track(" not in r.text and "©" not in r.text


def test_leaves_are_held_in_small_runs(monkeypatch):
    """One batch of many pages comes back as several, which hold its rows in order."""
    monkeypatch.setattr(html_text, "RUN", 4000)
    pages = [None, "", *(f"<h2>Our site</h2><p>{n} {'word ' * 200}</p>" for n in range(40)), "<p>end"]
    rows = len(pages)
    batch = pa.RecordBatch.from_pydict({
        "page_id": list(range(rows)), "url": ["u"] * rows, "host": ["h"] * rows, "layout": [1] * rows, "copy": list(range(rows)),
        "html": pa.array(pages, pa.string()), "pivot": pa.array([None, *pages[2:3] * (rows - 1)], pa.string()),
    })
    found = list(html_text._aligned(iter([batch])))
    assert len(found) > 15 and max(b.num_rows for b in found) <= 6
    assert [i for b in found for i in b.column("page_id").to_pylist()] == list(range(rows))
    matcher = html_text.Matcher()
    whole = [html_text.content(p or "", v, matcher) for p, v in zip(pages, batch.column("pivot").to_pylist())]
    assert [leaves for b in found for leaves in b.column("leaves").to_pylist()] == whole


def test_matches_are_forgotten(monkeypatch):
    """What a task remembers of matches is bounded as its shapes are."""
    monkeypatch.setattr(html_text, "MATCHES", 50)
    matcher, most = html_text.Matcher(), 0
    for n in range(60):
        html_text.content("<ul><li>a</ul>" + "<div><p>b</div>" * n + "<div><h2>c</h2></div>", "<div><p>x<p>y</div><ul><li>z<li>w</ul>", matcher)
        most = max(most, len(matcher.matched))
    assert most <= 50 + 20


def test_pages_go_to_python_in_bounded_batches(spark):
    pages = spark.createDataFrame([(1, "http://a.org/1", "<p>a")], "page_id long, url string, html string")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(64 << 20))
    try:
        html_text.extracted(pages)
        assert spark.conf.get(name) == "4m"
    finally:
        spark.conf.set(name, before)
