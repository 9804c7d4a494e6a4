"""Anchors from the fold over tags against the tree reader."""

import random

import pytest
from pyspark.sql import functions as F

from factloom.functions import html as H, html_tree, sections as S, urls as U
from factloom.operators import links as L
from suite import queries

BASE = "https://a.example"
CASES = [
    '<ul><li><a href="/articles/1-x">a</a> 01/02/2026<li><a href="/articles/2-x">b</a>03/04/2026</ul>',
    '<p>01/01/2020 <a href=/articles/3-x>c</a><div>02/02/2020 <a href="/articles/4-x">d</a></p>x</div><a href="/articles/5-x">e</a>',
    '<a href="/articles/1-a">q</a> 09/09/2009', '<div><a title="x href=/articles/9-z" href="/articles/1-z">a</a>1&#48;/10/2010</div>',
    "<table><tr><td>01/01/2001<td><a href=\"/articles/1-t\">x</a><tr><td><a HREF='/articles/2-t&amp;z'>y</a>02/02/2002</table>03/03/2003",
    '<div>01/02/2003</span><a href="/articles/1-x"></div></b><i>05/05/2005<a href="/articles/2-x">', None, "",
    '<ul><li>1/1<ul><li><a href="/articles/1-x">a</a>01/01/2001</li></ul>02/02/2002<a href="/articles/2-x">b</a></li></ul>',
    '<div><!-- 01/01/2000 --><script>02/02/2000</script><a class="a" data-href="/articles/7-q" href="/articles/8-q">x</a>01/<b>02</b>/2003 <br>11/11/2011</div>',
    '<body><a/href="/articles/1-x">z</a><a href>x</a><a href=>y</a></body>', '<select><option><a href="/articles/1-o">1</a><option>01/01/2001</select>',
    '<div>x > y 3 < 4 <a href="/articles/1-p" title="a > b">z</a> 01/01/2001</div>', '<dl><dt><a href="/articles/1-d">x</a><dd>01/01/2001<dt>02/02/2002</dl>',
    '<template><a href="/articles/1-x">t</a></template><a href="/articles/2-x">u</a>01/01/2001', '<div>01&sol;02&sol;2003 <a href="/articles/1-s">x</a></div>',
    '<textarea><a href="/articles/1-x"></textarea><a href="/articles/2-x">u</a>', '<div><a href="/articles/1-&hearts;">x</a></div>',
    '<div><br><a href="/articles/1-b"><img></a><hr>01/01/2001<p>02/02/2002</p></div>',
    "<div>" * 300 + '<a href="/articles/1-deep">x</a>01/01/2001', '<a href="/articles/1-x"><a href="/articles/2-x">01/01/2001</a></a>',
]


def rows(df):
    return sorted(map(tuple, df.collect()))


def by_tree(df):
    read = html_tree.dated_anchors(H.HIDDEN_TAGS, S.DATE_PATTERN.replace(r"\p{Nd}", r"\d"))(F.col("html"))
    found = df.select("page", F.posexplode_outer(read).alias("pos", "anchor")).where(U.is_article_link(F.col("anchor.href")))
    return found.select("page", "pos", U.absolute_url(F.col("anchor.href"), BASE).alias("url"), "anchor.date")


def random_page(seed):
    rng = random.Random(seed)
    tags = ["div", "p", "ul", "li", "b", "a", "td", "tr", "table", "section", "dt", "dd", "dl", "h2", "span", "br", "option", "select"]
    parts = []
    for _ in range(rng.randrange(60)):
        kind, tag = rng.random(), rng.choice(tags)
        if kind < 0.25:
            parts.append(f'<a class="x" href="/articles/{rng.randrange(50)}-x">')
        elif kind < 0.5:
            parts.append(f"<{tag}>")
        elif kind < 0.8:
            parts.append(f"</{tag}>")
        else:
            parts.append(rng.choice([" 01/02/2003 ", "teks ", "&amp;", "4/5", "17/06/2026", "<!-- c -->"]))
    return "".join(parts)


def test_anchors_equal_the_tree_on_edge_and_random_pages(spark):
    pages = CASES + [random_page(seed) for seed in range(400)]
    df = spark.createDataFrame(list(enumerate(pages)), "page long, html string")
    assert rows(L.page_anchors(df, BASE)) == rows(by_tree(df))
    tags_only = spark.createDataFrame([(i, random_page(i)) for i in range(400)], "page long, html string")
    assert rows(L.page_anchors(tags_only, BASE, fallback=False)) == rows(by_tree(tags_only))


@pytest.mark.parametrize("shape", ["_linked", "_sparse", "_list_pages"])
def test_given_pages_need_no_python(spark, shape):
    df = getattr(queries, shape)(spark, "/root/testdata/sf0.01")
    native = L.page_anchors(df, BASE, fallback=False)
    assert "Python" not in native._jdf.queryExecution().executedPlan().toString()
    found = rows(native)
    assert found and found == rows(by_tree(df)) == rows(L.page_anchors(df, BASE))


