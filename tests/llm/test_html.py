import pytest

from evenkeel.llm import html

HEAD = "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t='</p><p>x</p>';</script></head><body>"


def page(body, i):
    return (
        f"{HEAD}<nav><ul><li><a href='/'>home {i}</a><li><a href='/x'>more</a></ul></nav><div class='ad'>buy {i}</div>"
        f"{body}<div id='comments'><p>I like it {i}</p></div><footer>&copy; host {i}</footer></body></html>"
    )


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in html.main_text(df).collect()}


def test_article_and_plain_template(spark):
    rows, want = [], {}
    for i in range(20):
        rows.append((i, f"https://a.example/{i}", page(f"<article><h1>Head {i}</h1><p>One &lt;b&gt; {i}\n  two<p><b>Three<br>four</b></article>", i)))
        want[i] = f"Head {i}\nOne <b> {i} two\nThree four"
        plain = f"<div class='content'><h2>Part {i}</h2><p>Words of page {i} go <a href='z'>on</a> &amp; on.</p><form>Name <input></form></div>"
        rows.append((100 + i, f"http://b.example/{i}", page(plain, i)))
        want[100 + i] = f"Part {i}\nWords of page {i} go on & on."
    assert texts(spark, rows) == want


def test_odd_pages(spark):
    rows = [
        (1, "http://c.example/", None), (2, None, ""), (3, "no url", "only text &eacute;&nbsp; here"),
        (4, "http://d.example/", "<article><p>open <!-- never <p>closed"), (5, "http://d.example/2", "<p>a</p></div></p><p>b<script>x"),
        (6, "http://e.example/", "<article><header><h1>In</h1></header><p>a < b and c > d</p></article><header>Out</header>"),
    ]
    assert texts(spark, rows) == {1: "", 2: "", 3: "only text é here", 4: "open", 5: "a\nb", 6: "In\na < b and c > d"}


def test_class_words_do_not_empty_a_page(spark):
    around = (
        "<html class='no-sidebar'><body class='single comments-open' id='header-fixed'><div class='content with-ads'>{}</div>"
        "<div class='related'>see also</div></body></html>"
    )
    text = "<article class='post share-enabled'><h1>Head {0}</h1><p>the words of page {0}</p><div class='share'>tell all</div></article>"
    plain = "<h1>Head {0}</h1><p>the words of page {0}</p><div class='share'>tell all</div>"
    rows = [(10 * k + i, f"http://{k}.example/{i}", around.format(t.format(i))) for k, t in enumerate((text, plain)) for i in range(5)]
    rows.append((99, "http://one.example/", around.format(text.format(0))))
    assert texts(spark, rows) == {r[0]: f"Head {r[0] % 90 % 10}\nthe words of page {r[0] % 90 % 10}" for r in rows if r[0] < 99} | {
        99: "Head 0\nthe words of page 0"}


def test_template_class(spark):
    rows = [(i, f"https://a.example/{i}", page(f"<section><p>{'word ' * (i + 3)}</p>{'<p>x</p>' * i}</section>", i)) for i in range(10)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    wanted = df.selectExpr("page_id AS page", "html", "'a.example' AS host")
    vectors = html.tag_vectors(wanted)
    (found,) = html.templates(vectors).collect()
    assert found.main == html.path_key(">html>body>section")
    spread = html.tag_vectors(wanted.repartition(7))
    assert sorted(vectors.collect()) == sorted(spread.collect())


def test_words_of_the_template_are_no_text(spark):
    rows, want = [], {}
    for i in range(60):
        by = f"<div class='meta'><i>Written by</i> A{i} <i>in town</i> T{i}</div>" if i % 4 else ""
        notes = "".join(f"<dl><dt>Note no. {i}x{k}<dd>says n{i}y{k}</dl>" for k in range(i % 3 + 1))
        text = f"once a{i} " + "the " * (i % 5) + ("rare " if i % 2 else "") + f"b{i}"
        body = f"<div><h2>Story: s{i}</h2>{by}<p>{text}</p>{notes}<p>Read more stories <a href='/'>here</a></p></div>"
        rows.append((i, "http://a.example/", page(body, i)))
        want[i] = f"s{i}\n" + (f"A{i} T{i}\n" if by else "") + text.replace("once ", "")
        want[i] += "".join(f"\n{i}x{k}\nn{i}y{k}" for k in range(i % 3 + 1))
    assert texts(spark, rows) == want
    copies = [(i, "http://b.example/", page("<div><p>All pages say this</p></div>", 0)) for i in range(40)]
    assert set(texts(spark, copies).values()) == {"All pages say this"}


def test_every_page_counts_for_the_words_of_a_host(spark, monkeypatch):
    n = 400
    rows = [(i, "a.example", f"<p>{'often' if i % 3 else 'seldom'} always {'early' if i < 0.6 * n else ''} w{i}</p>") for i in range(n)]
    rows += [(n + i, "b.example", "<p>few pages</p>") for i in range(html.WORD_PAGES - 1)]
    pages = spark.createDataFrame(rows, "page bigint, host string, html string")
    at = html.path_key(">p")
    want = {(at, "always"), (at, "early"), (at, "often")}
    (found,) = html.repeated_words(pages.repartition(64)).collect()
    assert (found.of_host, set(map(tuple, found.words))) == ("a.example", want)
    # words of parts of any size are found, and each is counted on every page
    monkeypatch.setattr(html, "HELD", 50)
    (found,) = html.repeated_words(pages).collect()
    assert want <= set(map(tuple, found.words))
    counts = html.tag_vectors(pages, html.repeated_words(pages)).where("depth = -2").collect()
    on = {r.path: r.pages for r in counts}
    assert [on[html.path_key(f">p {w}")] for w in ("always", "early", "often")] == [n, 240, 266]


def test_words_out_of_order_stay():
    tokens = [(1, -1, -1), (4, 0, 0), (2, -1, -1), (3, 1, 0), (9, 1, 1), (8, 2, 0)]
    outer = {"outer": True, "once": True, "tokens": [1, 2, 3, 4], "words": [3, 4]}
    nested = {"outer": False, "once": True, "tokens": [9, 8], "words": [8, 9]}
    assert html.template_words(tokens, [outer, nested]) == {(1, 0), (1, 1), (2, 0)}
    assert html.template_words([(9, 1, 1), (2, -1, -1), (8, 2, 0)], [outer, nested]) == set()


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = pages.join(html.main_text(pages).drop("url"), "page_id").collect()
    assert len(rows) == pages.count()
    for r in rows:
        assert r.text and "\n\n" not in r.text and "track(" not in r.text and "©" not in r.text


@pytest.mark.parametrize("text", ["<" * 50_000, "<a " + "x='" * 30_000, "<div>" * 20_000 + "deep", "<!--" * 20_000])
def test_long_odd_input_ends(text):
    html.parse(text)


@pytest.mark.parametrize(("body", "blocks"), [
    ("<p>a <a href=foo' >x</a> b</p><p>c</p>", ["a x b", "c"]),
    ('<p>a <b title="5" inch">x</b> y</p>', ["a x y"]),
    ('<p title="a>b" id = \'c>d\'>x</p>', ["x"]),
    ('<p title="open>x</p>', ["x"]),
    ('<a href=x="y>z</a>', ["z"]),
    ('<p class="notice-period">x</p><section id="login-flow">y</section><p data-class="ad">z</p><p>more</p>', ["x", "y", "z", "more"]),
    ('<p>main words of it</p><div class="comment-list">x</div><div id="kommentare">y</div><p class="related-articles">z</p>', ["main words of it"]),
    ('<p>main words of it</p><div id="responses">x</div><div class="cookie-consent-banner">y</div><p class=ad-300x250>z</p>', ["main words of it"]),
])
def test_tags_and_class_words(body, blocks):
    assert [text for node, text, *_ in html.parse(body)[1] if node.text] == blocks
