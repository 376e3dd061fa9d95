import html
import re

from churnkit.llm import style_tree as S

PAGE = "page_id long, url string, html string, host string, noise string"


def pages(spark, rows):
    return spark.createDataFrame([(p, u, h, "x", "y") for p, u, h in rows], PAGE).repartition(3)


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def text(page):
    return S.main_text(page, set())


def test_markup():
    assert text("<p>a <b>b</b>\n c<br>d<p>e&amp;f &eacute;&#33;</p>") == "a b c d\n\ne&f é!"
    assert text("<script>x<p>y</script><style>p{}</style><!-- <p>z --><p>t<textarea><p>u</textarea>") == "t"
    assert text("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>") == "one\n\ntwo\n\na\n\nb\n\nc"
    assert text("<div class='ad'>x</div><nav>y</nav><div role=navigation>z</div><p hidden>h</p><div id='siteFooter'>f</div>ok") == "ok"
    assert text("a<span class=ad>x</span>b") == "a\n\nb"
    assert text("<article><h1>t</h1><p>x</p><section class='comments'><p>c</p></section></article><div>out</div>") == "t\n\nx"
    assert text("<p title='a>b'>x</p><p title=\"unclosed>y</p><p>z") in ("x\n\ny\n\nz", "x\n\nz")
    assert text(None) == text("") == text("<p> \n </p>") == ""
    assert text("5 < 6 & 7 > 2") == "5 < 6 & 7 > 2"
    assert text("<p>a</p></div></p><p>b<") == "a\n\nb<"


def test_names_do_not_take_the_article():
    story = "<p>The story has many words and says what happened on that day</p><p>and it goes on</p>"
    want = "The story has many words and says what happened on that day\n\nand it goes on"
    for name in ("layout has-sidebar", "search-results", "page-header-fixed", "comment-open"):
        assert text(f"<div class='{name}'><article>{story}</article><div class=sidebar>more</div></div>") == want
        assert text(f"<div class='{name}'>{story}<div class=sidebar>more</div></div>") == want
        assert text(f"<article class='{name}'>{story}</article><div>more</div>").startswith(want)
        assert text(f"<div><p>short</p><div class='{name}'><article>{story}</article></div></div>") == want
    assert text(f"<div>{story}</div><article>See also</article>") == f"{want}\n\nSee also"
    assert text("<div class=widget>a</div><div class=widget>b</div><div class=widget>c</div>") == "a\n\nb\n\nc"


def test_long_and_broken():
    assert len(text("<p>" + "word " * 100_000)) == 499_999
    assert text("<div>" * 5000 + "x") == "x"
    assert text("<" * 50_000 + " x").endswith("< x")
    assert S.main_text("<div>" * 5000 + "x", {1}) == "x"
    text("<p a='" * 3000)


def test_site_noise_is_learned(spark):
    """Branches without telling names that look and read alike on a site go; a site with one page keeps them."""
    def page(i, extra=""):
        return (f"<div class=x1><p>Welcome to our site</p><p>Best prices</p></div><div class=body7><h2>Title {i}</h2><p>Story {i} {i * i}</p>"
                f"<p>More {i}</p></div><div class=x9>All rights{extra}</div>")
    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(40)] + [(100, "http://b.example/", page(100))]
    got = texts(S.extract(spark, pages(spark, rows)))
    assert all(got[i] == f"Title {i}\n\nStory {i} {i * i}\n\nMore {i}" for i in range(40))
    assert got[100].startswith("Welcome") and got[100].endswith("All rights")


def test_copies_of_a_page_count_once(spark):
    one = "<article><h1>Title</h1><p>The only story of this site</p></article>"
    rows = [(i, f"http://copies.example/{i}", one) for i in range(12)]
    rows += [(100 + i, f"http://mixed.example/{i}", f"<div><p>Story {i}</p></div>") for i in range(20)]
    rows += [(200 + i, f"http://mixed.example/c{i}", "<div><p>Copied story</p><blockquote>Copied quote</blockquote></div>") for i in range(8)]
    got = texts(S.extract(spark, pages(spark, rows)))
    assert all(got[i] == "Title\n\nThe only story of this site" for i in range(12))
    assert all(got[100 + i] == f"Story {i}" for i in range(20)) and all(got[200 + i] == "Copied story\n\nCopied quote" for i in range(8))


def test_named_roles_and_importance(spark):
    rows = [(i, "http://a.example/x", f"<nav>menu {i}</nav><article><p>text {i}</p></article>") for i in range(10)]
    assert texts(S.extract(spark, pages(spark, rows))) == {i: f"text {i}" for i in range(10)}


def test_table(spark, small):
    def want(page):
        m = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", m[1])] if m else []
        return "\n\n".join(x for x in parts if x)

    got = S.extract(spark, spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()
    import pyarrow.parquet as pq

    rows = {r["page_id"]: r for r in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()}
    assert len(got) == len(rows)
    assert all(r["text"] == want(rows[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) for r in got)


def test_edges(spark):
    rows = [(1, None, None), (2, "not a url", ""), (3, "http://h/", "<p>x"), (3, "http://h/", "<p>x"), (None, "http://u@H:80/", "<p>y")]
    got = S.extract(spark, pages(spark, rows)).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in got) == [("1", "", 0), ("2", "", 0), ("3", "x", 1), ("3", "x", 1), ("None", "y", 1)]
    assert S.extract(spark, pages(spark, [])).count() == 0
    hosts = pages(spark, rows).select(S.host().alias("x")).distinct().collect()
    assert {r["x"] for r in hosts} == {"", "h"}
