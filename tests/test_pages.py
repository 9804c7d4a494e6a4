"""Page columns: native expressions against the tree reader, and selections."""

import os

import pytest
from pyspark.sql import functions as F

from factloom.functions import html as H, html_tree
from factloom.operators import pages as P

LONG = "kata " * 60
MID = "kata " * 30


def read(spark, htmls, kind="news_site", fallback=True):
    rows = spark.createDataFrame([(i, h, kind) for i, h in enumerate(htmls)], "page_id long, html string, content_type string")
    out = P.with_page_text(rows, fallback=fallback).orderBy("page_id").collect()
    return [(r.title, r.text) for r in out]


def tree(spark, htmls, kind):
    rows = spark.createDataFrame([(i, h, kind) for i, h in enumerate(htmls)], "page_id long, html string, content_type string")
    udf = html_tree.tree_fields(
        {"news_site": (H.NEWS_CONTAINERS, 200), "archive": (H.ARCHIVE_CONTAINERS, 100)},
        H.NEWS_CONTAINERS, H.NOISE_TAGS, H.HIDDEN_TAGS)
    out = rows.select("page_id", udf("html", "content_type").alias("t")).orderBy("page_id").collect()
    return [(r.t.title if kind != "social_media" else "", r.t.text) for r in out]


CASES = [
    f"<html><head><title> T &amp; U</title></head><body><p>b</p><article><h1>A <i>x</i></h1>{LONG}</article></body></html>",
    f"<title>T</title><body><header><h1>Kepala</h1></header><article>{LONG}</article>",
    f"<body><article><h1></h1>{LONG}</article><h1>lain</h1></body>",
    f"<body><main><h1>M</h1>{LONG}</main><h1>first</h1></body>",
    f"<body>luar <article>{MID}</article><main>{LONG}utama</main></body>",
    f"<body>luar <article>{MID}</article> dan</body>",
    f"<body><div class='x article-body y'>{LONG}<div>dalam</div>akhir</div>luar</body>",
    f"<body><div class='post-content'>{MID}</div><div id=content>{LONG}<div>a</div>b</div>luar</body>",
    f"<body><div class='content'><h1>K</h1>{LONG}</div><h1>Lain</h1></body>",
    f"<body><article>{LONG}<article>dalam</article>ekor</article>luar</body>",
    f"<body><article>{LONG}tidak ditutup<p>x",
    f"<body><nav>a<nav>b</nav>c</nav><p>isi</p><form>f<button>g</button></form></body>",
    f"<body><aside>a</aside>isi<!-- <p>x</p> --><script>if (a<b) '</p>'</script><figure>f<figcaption>g</figcaption></figure>tengah<iframe>q</iframe></body>",
    "<body>a &eacute; b &#233; &hellip; R&D &lt;p&gt; &amp;lt; AT&T &copy 2 &nbsp;x</body>",
    "<body><p title='a > b'>isi</p> 3 < 4 <b>t</b></body>",
    "<p>tanpa badan</p>", "<title>hanya judul</title>", "", "teks saja", "<body></body>",
    "<body><p>putus <a href='x", "<body>x<!-- terbuka <p>y</p></body>", "<BODY><ARTICLE CLASS=z><H1>Besar</H1>" + LONG + "</ARTICLE></BODY>",
    f"<body><article-card>{LONG}</article-card><p>p</p></body>", "<body><template>t</template><ruby>a<rt>b</rt></ruby></body>",
    f"<div id='CONTENT'>{MID}</div><article>{LONG}</article>", f"<body><div id='CONTENT'>pendek</div><div class='TEXT-BLOCK b'>{MID}<div>z</div></div></body>",
    "<body><article>" + "".join(f"<p> {w} </p>" for w in ["kata"] * 51) + "</article>x</body>",
    "<body><article>" + "".join(f"<p> {w} </p>" for w in ["kata"] * 50) + "</article>x</body>",
]


@pytest.mark.parametrize("kind", ["news_site", "archive", "social_media"])
def test_hybrid_equals_tree_on_edge_pages(spark, kind):
    got, want = read(spark, CASES, kind), tree(spark, CASES, kind)
    for html, a, b in zip(CASES, got, want):
        text = b[1]
        assert a == (b[0], text), html[:120]


def test_selected_values(spark):
    got = read(spark, CASES)
    assert got[0][0] == "A x" and got[0][1].startswith("A x kata kata")
    assert got[1][0] == "Kepala" and got[1][1] == LONG.strip()
    assert got[2][0] == ""
    assert got[3][0] == "M"
    assert got[4][1].endswith("utama") and "luar" not in got[4][1]
    assert got[5][1].startswith("luar") and got[5][1].endswith("dan")
    assert got[6][1].endswith("dalam akhir")
    assert got[12][1] == "isi tengah"
    assert got[13][1] == "a é b é … R&D <p> &lt; AT&T © 2 x"
    assert got[17] == ("", "") and got[18] == ("", "teks saja")
    assert got[-2][1].endswith("kata") and got[-1][1].endswith("x")


@pytest.mark.parametrize("kind", ["news_site", "archive", "social_media"])
def test_native_equals_tree_on_given_pages(spark, kind):
    path = "/root/testdata/sf0.1/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    pages = spark.read.parquet(path).select("page_id", "html", F.lit(kind).alias("content_type"))
    udf = html_tree.tree_fields(
        {"news_site": (H.NEWS_CONTAINERS, 200), "archive": (H.ARCHIVE_CONTAINERS, 100)},
        H.NEWS_CONTAINERS, H.NOISE_TAGS, H.HIDDEN_TAGS)
    walked = pages.select("page_id", udf("html", "content_type").alias("t"))
    for fallback in (False, True):
        both = P.with_page_text(pages, fallback=fallback).join(walked, "page_id")
        same = F.col("text") == F.col("t.text")
        if kind != "social_media":
            same = same & (F.col("title") == F.col("t.title"))
        assert both.where(~same).count() == 0
        assert both.count() == pages.count()


def test_article_parts_native_equals_tree(spark):
    pages = spark.createDataFrame(list(enumerate([
        "<h1>a<i>b</i></h1><h2> c </h2><a href='/x?category=1'> K <b>L</b></a>", "<p>x</p><p>12</p>/05/2024",
        "<h2>[A]</h2>\n<p>Narasi</p>\n<p>isi</p><a class=q href=\"?category=2\"></a><a href='?category=3'>z</a>",
        "<a data-href='?category=9'>no</a><p>a&amp;b</p>", "", "<a HREF=/l?category=x>T</a>",
    ])), "page_id long, html string")
    udf = html_tree.article_parts(H.HIDDEN_TAGS)
    want = [tuple(r.t) for r in pages.select("page_id", udf("html").alias("t")).orderBy("page_id").collect()]
    got = [(r.headings, r.category, r.plain, r.lines)
           for r in P.with_article_parts(pages, fallback=False).orderBy("page_id").collect()]
    assert got == want
    assert want[0] == (["ab", " c "], "K L", "ab c  K L", "a\nb\n c \n K \nL")
    assert want[2][1] == "" and want[5][1] == "T"
    hard = pages.where("page_id = 0").withColumn("html", F.lit("<h1>a &eacute;<h2>b</h2>"))
    assert P.with_article_parts(hard).first().headings == ["a éb", "b"]


def test_selector_profile(spark):
    pages = spark.createDataFrame([
        (1, "<table><tbody><tr><td>x</td></tr><tr></tr></tbody></table><tr></tr><div class='a post-list'></div>"),
        (2, "<ul class=entry-list></ul><ul class='my-entry-list'></ul><article></article><article></article><!-- <table> -->"),
    ], "page_id long, html string")
    got = {r.selector: (r.n_elements, r.n_pages) for r in P.selector_profile(pages).collect()}
    assert got == {"table": (1, 1), "article": (2, 1), ".post-list": (1, 1), ".entry-list": (1, 1), "tbody tr": (2, 1)}


def test_first_site_link(spark):
    rows = spark.createDataFrame([("<a href='/x'>n</a><a class=k href='https://s.example/1'> a <b> b</b></a>",), ("<p>",)], "html string")
    got = rows.select(H.first_site_link(F.col("html"), "s.example").alias("l")).collect()
    assert tuple(got[0].l) == ("https://s.example/1", "ab") and tuple(got[1].l) == (None, None)


NUMERIC = [
    "&#8217;", "&#038;", "&#x2019;", "&#X1F600;", "&#128;x", "&#x81;", "&#0;", "&#13;", "&#1;", "&#11;", "&#127;", "&#xFDD0;", "&#65535;",
    "&#x1FFFE;", "&#xD800;", "&#1114112;", "&#99999999999999999999;", "&#xFFFFFFFFFFFFFFFFFF;", "&#65", "&#65x", "&#x41g", "&#00000000065;",
    "&eacute;", "&eacute x", "&frac12;", "&THORN;", "&sup2 ", "&Uuml;&uuml;", "&amp;#65;", "&amp;eacute;", "&szlig", "&#38;amp;", "&yen;5",
]


def test_numeric_and_latin_entities_are_native(spark):
    pages = [f"<html><head><title>t</title></head><body><p>a{e} b</p></body></html>" for e in NUMERIC]
    assert read(spark, pages, fallback=False) == tree(spark, pages, "news_site")
    rows = spark.createDataFrame([(f"a{e} b",) for e in NUMERIC], "v string")
    assert rows.where(H.has_foreign_entity(F.col("v"))).count() == 0
    foreign = spark.createDataFrame([("&notin;",), ("&copyx",), ("&#x;",), ("&alpha;",)], "v string")
    assert foreign.where(H.has_foreign_entity(F.col("v"))).count() == 4


def test_selectors_and_links_beyond_flat_markup(spark):
    nested = "<table><tbody><tr><td><table><tbody><tr></tr></tbody></table></td></tr><tr></tr></tbody></table><tr></tr>"
    rows = spark.createDataFrame([(nested,), ("<TBODY><tr><TR>",), ("</tbody><tr></tr>",), (None,)], "html string")
    assert [r.n for r in rows.select(H.selector_count(F.col("html"), "tbody tr").alias("n")).collect()] == [3, 2, 0, None]
    links = [
        ("<a href='/x?a=1&amp;b=2'>It&#8217;s&nbsp;</a>", "/x?a=1&b=2", "It\u2019s"), ("<a class=c href=/x/1&copy=2> a<b>&nbsp;b&eacute;</b></a>", "/x/1&copy=2", "ab\xe9"),
        ('<a href="/y">n</a><a href="/x y">z</a>', "/x y", "z"), ("<a href=&#47;x>q</a>", "/x", "q"),
    ]
    rows = spark.createDataFrame([(html,) for html, *_ in links], "html string").select(H.first_site_link(F.col("html"), "/x").alias("l"))
    assert [tuple(r.l) for r in rows.collect()] == [tuple(want) for _, *want in links]


def test_large_page(spark):
    """Many elements and a long text in one page, native and through the tree."""
    body = "".join(f"<p>kata{i} <b>tebal</b></p>" for i in range(20_000))
    nest = "<div>" * 2_000 + "dalam" + "</div>" * 2_000
    plain = f"<html><body><article><h1>J</h1>{body}</article></body></html>"
    nested = f"<html><body><div class='content'>{body}{nest}</div></body></html>"
    (title, text), (_, deep) = read(spark, [plain, nested])
    assert title == "J" and text.startswith("J kata0 tebal kata1") and text.endswith("kata19999 tebal")
    assert deep.endswith("kata19999 tebal dalam")
