"""Links, sources, fetch status, content rows, joins and reports."""

import itertools
import os

from pyspark.sql import functions as F

from factloom.functions.urls import DomainRules
from factloom.operators import (
    articles as A, content as C, fetch, links as L, pairs, quality as Q, resume as R, routing, skew, sources as O,
)
from factloom.plans import builds
from factloom.schemas import ARTICLE_FIELDS, ATTEMPT_SCHEMA, CONTENT_FIELDS, RULE_SCHEMA
from factloom.sources import tables as IO

BASE = "https://s.example"


def card(n, date="", twice=False):
    link = f'<a href="/articles/{n}-x">j</a>'
    return f"<div>{link}{link if twice else ''} {date}</div>"


def list_pages(spark, pages):
    return spark.createDataFrame(sorted(pages.items()), "page long, html string")


def test_links_are_deduplicated_cut_and_numbered(spark):
    pages = {
        1: card(5, "31/12/2025", True) + card(4) + "<a href='/about'>a</a>",
        2: card(5) + f"<p><a href='{BASE}/articles/3-y'>x</a> pada 01/01/2026</p>" + card(4),
        3: "<p>kosong</p>", 4: card(9),
    }
    got = [tuple(r) for r in L.collect_links(list_pages(spark, pages), BASE, pages_per_block=1)
           .orderBy("article_id").select("article_id", "page", "url", "date", "category").collect()]
    assert got == [
        (0, 1, f"{BASE}/articles/5-x", "31/12/2025", ""), (1, 1, f"{BASE}/articles/4-x", "", ""),
        (2, 2, f"{BASE}/articles/5-x", "", ""), (3, 2, f"{BASE}/articles/3-y", "01/01/2026", ""),
        (4, 2, f"{BASE}/articles/4-x", "", ""),
    ]


def test_numbering_does_not_depend_on_blocks(spark):
    pages = {p: "".join(card(p * 100 + k) for k in range(p % 4 + 1)) for p in range(1, 30)}
    numbered = [
        [tuple(r) for r in L.collect_links(list_pages(spark, pages), BASE, pages_per_block=b).orderBy("article_id").collect()]
        for b in (1, 7, 256)
    ]
    assert numbered[0] == numbered[1] == numbered[2]
    assert [r[-1] for r in numbered[0]] == list(range(len(numbered[0])))


def test_frontier_and_range(spark):
    links = spark.createDataFrame([(1,), (2,), (2,), (5,)], "page long")
    assert L.frontier(links, 1).first().stop == 3
    assert L.frontier(links, 2).first().stop == 3
    assert L.frontier(links, 3).first().stop == 3
    assert L.frontier(links, 5).first().stop == 6
    pages = list_pages(spark, {p: card(p) for p in range(1, 10)})
    ids = L.collect_links(pages, BASE, start_page=3, max_pages=2)
    assert [(r.article_id, r.page) for r in ids.orderBy("article_id").collect()] == [(0, 3), (1, 4)]
    assert L.in_page_range(pages, 1, None).count() == 9


def test_progress(spark):
    pages = {p: "".join(card(p * 100 + k) for k in range(p)) for p in range(1, 9)}
    links = L.first_per_page(L.in_blocks(L.page_anchors(list_pages(spark, pages), BASE), 3))
    got = [tuple(r) for r in L.page_progress(links).orderBy("page").collect()]
    assert got == [(p, p, p * (p + 1) // 2) for p in range(1, 9)]


ARTICLE = """<html><body><h1>Judul</h1><h2>［SALAH］ x</h2><a href="/articles?category=politik">Politik </a>
<span>17/06/2026</span><p><b>Narasi</b></p><p>klaim <i>besar</i></p><p>Penjelasan</p><p>rinci</p><p>Kesimpulan</p>
<p>tidak benar</p><p>Hasil Periksa Fakta</p><p>Salah</p><p>Sumber: https://x.com/1</p><p>Referensi</p>
<p>https://a.example/1</p><p>https://x.com/1</p><p>Artikel terbaru</p></body></html>"""


def test_article_build(spark):
    lists = list_pages(spark, {1: card(1) + card(2, "01/02/2026"), 2: card(1)})
    pages = spark.createDataFrame([
        (7, f"{BASE}/articles/1-x", ARTICLE), (8, f"{BASE}/articles/1-x", "later copy"), (9, f"{BASE}/about", "x"),
    ], "page_id long, url string, html string")
    for min_rows in (1, 1000):
        rows = builds.build_articles(lists, pages, BASE, min_rows=min_rows).orderBy("article_id").collect()
        first = (f"{BASE}/articles/1-x", "SALAH", "Politik", "17/06/2026", "klaim besar", "rinci", "tidak benar", "Salah",
                 "https://x.com/1", "https://a.example/1 | https://x.com/1")
        assert [tuple(r) for r in rows] == [
            (0, *first), (1, f"{BASE}/articles/2-x", None, None, "01/02/2026", *[None] * 6), (2, *first),
        ]
    extras = A.typed_extras(builds.build_articles(lists, pages, BASE)).orderBy("article_id").first()
    assert extras.article_key == 1 and str(extras.pub_date) == "2026-06-17" and len(extras.refs) == 2
    assert A.head(builds.build_articles(lists, pages, BASE), 2).count() == 2


def test_unavailable_pages(spark):
    """What the log never got is unavailable even where the snapshot holds a page."""
    lists = list_pages(spark, {p: card(p) + card(p + 10, "01/02/2026") for p in range(1, 5)})
    pages = spark.createDataFrame([(i, f"{BASE}/articles/{i}-x", ARTICLE) for i in (1, 2, 3, 11, 12, 13)], "page_id long, url string, html string")

    def log(*tries):
        return spark.createDataFrame([(u if u.startswith("http") else f"{BASE}{u}", a, o, c) for u, a, o, c in tries], "url string, attempt int, outcome string, http_status int")

    failed = log(
        ("/articles?page=3", 1, "http", 500), ("/articles?page=3", 2, "timeout", None), ("/articles?page=3", 4, "http", 200),
        ("/articles?page=2", 1, "http", 503), ("/articles?page=2", 2, "http", 200), ("/articles?page=x", 1, "conn", None),
        ("/articles?page=1&x=2", 1, "conn", None), ("http://other.example/articles?page=1", 1, "conn", None),
        ("/articles/1-x", 1, "http", 404), ("/articles/12-x", 1, "other", None), ("/articles/12-x", 2, "http", 200), ("/articles/11-x", 1, "http", 399),
        ("/articles/99-x", 1, "http", 200),
    )
    for min_rows in (1, 1000):
        got = builds.build_articles(lists, pages, BASE, min_rows=min_rows, attempts=failed, max_attempts=3).orderBy("article_id").collect()
        assert [(r.article_id, r.url[-5:], r.classification, r.date, r.category) for r in got] == [
            (0, "s/1-x", None, None, None), (1, "/11-x", "SALAH", "01/02/2026", "Politik"),
            (2, "s/2-x", "SALAH", "17/06/2026", "Politik"), (3, "/12-x", "SALAH", "01/02/2026", "Politik"),
        ]
    # Without a bound on attempts the third list page was got; without a log nothing failed.
    assert builds.build_articles(lists, pages, BASE, attempts=failed).count() == 8
    assert builds.build_articles(lists, pages, BASE, attempts=log().limit(0)).count() == builds.build_articles(lists, pages, BASE).count() == 8
    # The failed start page leaves nothing.
    assert builds.build_articles(lists, pages, BASE, attempts=log(("/articles?page=1", 1, "conn", None))).count() == 0
    states = fetch.page_states(pages.select("url", "page_id"), failed, 3)
    assert {r.url[len(BASE):]: (r.page_id, r.state) for r in states.collect() if "/articles/" in r.url} == {
        "/articles/1-x": (None, "unavailable"), "/articles/2-x": (2, "present"), "/articles/3-x": (3, "present"), "/articles/11-x": (11, "present"),
        "/articles/12-x": (12, "present"), "/articles/13-x": (13, "present"), "/articles/99-x": (None, "absent"),
    }


def test_article_build_reads_little(spark):
    """The final plan reads stored narrow tables; nothing is listed or parsed again."""
    lists = list_pages(spark, {1: card(1)})
    pages = spark.createDataFrame([(1, f"{BASE}/articles/1-x", ARTICLE)], "page_id long, url string, html string")
    plan = builds.build_articles(lists, pages, BASE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") <= 12
    physical = builds.build_articles(lists, pages, BASE)._jdf.queryExecution().executedPlan().toString()
    assert physical.count("SinglePartition") <= 3 and physical.count("FileScan") <= 12


def test_frontier_at_block_edges(spark):
    import random

    rng = random.Random(8)
    for trial in range(12):
        start = rng.choice([0, 1, 3, 4, 7])
        have = {p for p in range(0, 40) if rng.random() < rng.choice([0.5, 0.9, 1.0])} | set(range(start, start + rng.randrange(12)))
        links = spark.createDataFrame([(p,) for p in sorted(have)] * 2, "page int")
        want = next(p for p in range(start, 99) if p not in have)
        assert [r.stop for r in L.frontier(links, start, pages_per_block=4).collect()] == [want], (start, have)
    assert L.frontier(spark.createDataFrame([], "page long"), 5).first().stop == 5
    parsed = L.frontier(L.first_per_page(L.in_blocks(L.page_anchors(list_pages(spark, {1: card(1)}), BASE))), 1)
    assert parsed._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_explode_sources(spark):
    rows = spark.createDataFrame([
        (0, " https://a ", "https://b | | https://c"), (1, None, None), (2, "", " | "), (3, "https://d", ""),
    ], "article_id long, link_source string, referensi string")
    got = sorted(O.explode_sources(rows).collect(), key=lambda r: (r.article_id, r.source_type, r.source_index))
    assert [tuple(r) for r in got] == [
        (0, "false", 0, "https://a"), (0, "true", 0, "https://b"), (0, "true", 1, "https://c"),
        (1, "false", 0, None), (1, "true", 0, None), (2, "false", 0, None), (3, "false", 0, "https://d"), (3, "true", 0, None),
    ]
    back = {r.article_id: r.referensi for r in O.collapse_sources(O.explode_sources(rows)).collect()}
    assert back == {0: "https://b | https://c"}


def replay(outcomes, archive):
    """The retry loop, one attempt after the other."""
    for number, (outcome, code) in enumerate(outcomes, 1):
        if outcome == "http":
            if code in (401, 403):
                return "archive_blocked" if archive else "blocked"
            return "404" if code == 404 else "error" if code >= 400 else "ok"
        if outcome == "redirects":
            return "blocked"
        if number == 3:
            return {"timeout": "timeout", "conn": "archive_blocked" if archive else "error"}.get(outcome, "error")


def test_fetch_status_on_all_triples(spark):
    kinds = [("http", 200), ("http", 403), ("http", 404), ("http", 429), ("redirects", 0), ("timeout", 0), ("conn", 0), ("other", 0)]
    rows, want = [], {}
    for n, (triple, archive) in enumerate(itertools.product(itertools.product(kinds, repeat=3), (False, True))):
        want[f"u{n}"] = replay(triple, archive)
        rows += [(f"u{n}", i, o, c, archive) for i, (o, c) in enumerate(triple, 1)] + [(f"u{n}", 4, "http", 200, archive)]
    got = {r.url: r.fetch_status for r in fetch.fetch_status(spark.createDataFrame(rows, ATTEMPT_SCHEMA), 3).collect()}
    assert len(want) == 1024 and got == want


def test_page_availability(spark):
    rows = [("a", 1, "http", 404, False), ("a", 2, "http", 200, False), ("b", 1, "http", 500, False), ("b", 4, "http", 200, False)]
    got = {r.url: r.available for r in fetch.page_availability(spark.createDataFrame(rows, ATTEMPT_SCHEMA), 3).collect()}
    assert got == {"a": True, "b": False}


# (article, type, index, url, content type, status)
GOLDEN = """
0 false 0 https://www.threads.com/u0 social_media error
0 true 0 https://www.instagram.com/u1 social_media error
0 true 1 https://magma.esdm.go.id/u2 skip skipped
0 true 2 http://geologi.esdm.go.id/u3 skip skipped
0 true 3 https://www.instagram.com/u4 social_media error
0 true 4 https://x.com/u5 social_media ok
0 true 5 https://www.detik.com/u6 news_site ok
0 true 6 https://www.threads.com/u0 social_media error
0 true 7 http://archive.today/u7 archive error
1 false 0 https://www.facebook.com/u8 social_media error
1 true 0 https://www.kompas.tv/u9 news_site ok
1 true 1 https://www.facebook.com/u8 social_media error
1 true 2 https://archive.ph/u10 archive error
2 false 0 https://web.facebook.com/u11 social_media error
2 true 0 https://www.liputan6.com/u12 news_site ok
2 true 1 https://money.kompas.com/u13 news_site ok
2 true 2 https://web.facebook.com/u11 social_media error
2 true 3 https://archive.ph/u14 archive error
3 false 0 https://vt.tiktok.com/u15 social_media error
3 true 0 https://sariroti.com/u16 news_site ok
3 true 1 https://www.linkedin.com/u17 social_media ok
3 true 2 https://vt.tiktok.com/u15 social_media error
3 true 3 http://archive.today/u18 archive error
4 false 0 https://vt.tiktok.com/u19 social_media js_redirect
4 true 0 https://karir.adhi.co.id/u20 news_site timeout
4 true 1 https://www.instagram.com/u21 social_media error
4 true 2 https://www.instagram.com/u22 social_media error
4 true 3 https://x.com/u23 social_media ok
4 true 4 https://youtube.com/u24 social_media ok
4 true 5 https://vt.tiktok.com/u19 social_media js_redirect
4 true 6 http://archive.today/u25 archive error
"""


def golden(spark):
    rows = [(int(a), t, int(i), u, k, s) for a, t, i, u, k, s in map(str.split, GOLDEN.strip().split("\n"))]
    articles, pages, attempts = {}, {}, []
    for a, t, _, url, kind, status in rows:
        source, refs = articles.setdefault(a, [None, []])
        if t == "false":
            articles[a][0] = url
        else:
            refs.append(url)
        if url in pages or kind == "skip":
            continue
        if status == "timeout":
            attempts += [(url, n, "timeout", 0, False) for n in (1, 2, 3)]
        elif kind == "archive":
            attempts.append((url, 1, "http", 429, True))
        else:
            text = {"ok": "<p>Isi halaman</p>", "error": "<script>x</script>", "js_redirect": "Please wait..."}[status]
            pages[url] = f"<html><body>{text}</body></html>"
            attempts.append((url, 1, "http", 200, False))
    articles = spark.createDataFrame(
        [(a, s, " | ".join(r)) for a, (s, r) in articles.items()], "article_id long, link_source string, referensi string")
    pages = spark.createDataFrame([(n, u, h) for n, (u, h) in enumerate(pages.items())], "page_id long, url string, html string")
    return rows, articles, pages, spark.createDataFrame(attempts, ATTEMPT_SCHEMA)


def test_golden_rows(spark):
    rows, articles, pages, attempts = golden(spark)
    for min_rows in (1, 1000):
        content = builds.build_content(articles, pages, attempts, max_rows=5, stamp=F.lit("t"), min_rows=min_rows)
        assert content.columns == CONTENT_FIELDS
        got = sorted((r.article_id, r.source_type, r.source_index, r.url, r.content_type, r.scrape_status) for r in content.collect())
        assert got == sorted(rows)
    counts = {(r.field, r.value): r.n for r in Q.content_counts(content).collect()}
    assert counts[("source_type", "true")] == 26 and counts[("source_type", "false")] == 5
    assert counts[("content_type", "social_media")] == 18 and counts[("scrape_status", "error")] == 17
    assert tuple(Q.content_summary(content).first()) == (31, 5)


def test_content_rows_details(spark):
    sources = spark.createDataFrame([
        (0, "true", i, u) for i, u in enumerate([
            "https://a.example/1", "https://archive.ph/2", "https://x.com/3", None, "https://own.example/4", "https://gone.example/5",
            "https://broken.example/6", "https://lost.example/7",
        ])
    ], "article_id long, source_type string, source_index int, url string")
    html = "<html><body><h1>Judul</h1>Isi</body></html>"
    pages = spark.createDataFrame([
        (i, u, html) for i, u in enumerate(["https://a.example/1", "https://archive.ph/2", "https://x.com/3", "https://own.example/4", "https://broken.example/6"])
    ], "page_id long, url string, html string")
    attempts = spark.createDataFrame([
        ("https://broken.example/6", 1, "http", 403), ("https://lost.example/7", 1, "http", 200),
    ], "url string, attempt int, outcome string, http_status int")
    out = C.content_rows(sources, pages, attempts, DomainRules(own=["own.example"])).orderBy("source_index").collect()
    assert [(r.title, r.text, r.scrape_status) for r in out] == [
        ("Judul", "Judul Isi", "ok"), ("Judul", "Judul Isi", "ok"), (None, "Judul Isi", "ok"), (None, None, "empty_url"),
        (None, None, "skipped"), (None, None, "error"), (None, None, "blocked"), (None, None, "error"),
    ]
    import re
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", r.scraped_date) for r in out)


def test_routing_table_equals_literals(spark):
    rows, *_ = golden(spark)
    urls = spark.createDataFrame([(i, r[3]) for i, r in enumerate(rows)] + [(99, None), (98, "x")], "id int, url string")
    for min_rows in (2, 10_000):
        got = {r.id: r.content_type for r in routing.route_by_rules(urls, routing.default_rules(spark), ["id"], min_rows).collect()}
        assert got == {**{i: r[4] for i, r in enumerate(rows)}, 99: "empty", 98: "empty"}
    overlap = spark.createDataFrame([("a", "archive", 2), ("a", "skip", 0), ("a", "social_media", 1)], RULE_SCHEMA)
    assert [tuple(r) for r in routing.resolve_rules(overlap).collect()] == [("a", "skip")]


def test_hot_keys_are_spread_and_results_whole(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"))
    lookup = spark.createDataFrame([("hot", 1), ("k2", 2), ("none", 3)], "key string, v int")
    hot = skew.hot_keys(rows, "key", min_rows=100)
    assert [r.key for r in hot.collect()] == ["hot"]
    parts = skew.salted(rows, hot, "key", ["id"], 16)
    assert parts.where("key = 'hot'").select("_salt").distinct().count() == 16
    assert parts.where("key IS NULL").select("_salt").distinct().count() == 16
    assert skew.replicated(lookup, hot, "key", 16).count() == 18
    want = sorted(map(tuple, rows.join(lookup, "key", "left").select("id", "key", "v").collect()))
    for min_rows in (1, 100, 10_000):
        got = skew.spread_lookup(rows, lookup, "key", ["id"], min_rows=min_rows).select("id", "key", "v")
        assert sorted(map(tuple, got.collect())) == want
    inner = skew.spread_lookup(rows, lookup, "key", ["id"], "inner", min_rows=100)
    assert inner.count() == 1001


def test_pairs(spark):
    rows, articles, pages, attempts = golden(spark)
    content = builds.build_content(articles, pages, attempts, stamp=F.lit("t"))
    claims = articles.select("article_id", F.lit("SALAH").alias("classification"), F.lit("k").alias("narasi"))
    for min_rows in (1, 1000):
        found = pairs.claim_evidence_pairs(claims, content, min_rows=min_rows)
        assert found.count() == sum(t == "true" and s == "ok" for _, t, *_, s in rows)
    every = pairs.claim_evidence_pairs(claims, content, usable_only=False)
    assert every.count() == 26
    assert pairs.claim_evidence_pairs(claims, content, usable_only=False, drop_leaks=True).count() == 21


def test_resume_and_seeds(spark):
    articles = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "article_id long, url string")
    done = spark.createDataFrame([(1,), (1,), (1,), (None,)], "article_id long")
    assert {r.article_id for r in R.pending(articles, done).collect()} == {2, 3}
    seeds = IO.seeds(spark, [("b", "", ""), ("b", "", ""), ("z", "", "")])
    assert [r.url for r in R.seeded(articles, seeds).collect()] == ["b"]


def test_spot_check(spark):
    pages = spark.createDataFrame([(7, f"{BASE}/articles/1-x", ARTICLE), (8, f"{BASE}/articles/2-x", "<p>x")], "page_id long, url string, html string")
    seeds = IO.seeds(spark, [(f"{BASE}/articles/1-x", "", "")])
    report = {r.field: (r.filled, r.preview) for r in builds.spot_check(seeds, pages).collect()}
    assert len(report) == 9 and report["classification"] == (True, "SALAH") and report["date"] == (True, "17/06/2026")


def test_reports(spark):
    rows = [("u1", "SALAH", None, "31/12/2025", "n" * 200, "p", None, "Salah", None, "a | b"),
            ("u2", "SALAH", "Politik", "01/01/2026", "nan", None, None, None, None, None),
            ("u3", None, "Politik", "99/99/9999", None, None, "k", None, None, "a|b|c")]
    articles = spark.createDataFrame(rows, IO.ARTICLE_SCHEMA)
    assert [tuple(r) for r in Q.ordered_counts(Q.article_counts(articles)).collect()] == [
        ("category", "Politik", 2), ("classification", "SALAH", 2)]
    summary = Q.article_summary(articles).first()
    assert tuple(map(str, summary)) == ("3", "01/01/2026", "99/99/9999", "2025-12-31", "2026-01-01", "1", "2")
    assert tuple(Q.null_counts(articles, ["narasi", "referensi"]).first()) == (1, 1)
    assert tuple(Q.date_range(articles).select("min_text", "max_text").first()) == ("01/01/2026", "99/99/9999")
    stats = Q.reference_stats(articles).first()
    assert (stats.avg_refs, stats.max_refs, stats.share_two_plus) == (5 / 3, 3, 2 / 3)
    full = {r.field: (r.n_filled, r.n_empty) for r in Q.field_completeness(articles).collect()}
    assert full["narasi"] == (1, 2) and full["classification"] == (2, 1)
    preview = {r.field: r.preview for r in Q.field_report(articles).where("url = 'u1'").collect()}
    assert len(preview["narasi"]) == 150 and preview["classification"] == "SALAH"


def test_logged_counts_are_consistent(spark):
    classes = {"SALAH": 613, "PENIPUAN": 267, "PARODI": 7, "SATIRE": 1, "SATIR": 1, "KOMEDI": 1, None: 70}
    rows = [(k,) for k, n in classes.items() for _ in range(n)]
    counts = {r.value: r.n for r in Q.value_counts(spark.createDataFrame(rows, "classification string"), ["classification"]).collect()}
    assert counts == {k: n for k, n in classes.items() if k} and sum(counts.values()) == 890


def test_head_on_stable_keys(spark):
    rows = spark.createDataFrame([(35285, "b"), (35281, "a"), (None, "c")], "article_id long, url string")
    assert [r.article_id for r in A.head(rows, 2).collect()] == [35281, 35285]
    assert A.head(rows, 9).count() == 3 and A.head(rows, None).count() == 3 and A.head(rows, 0).count() == 0


def test_late_attempts_count_and_ties_are_settled(spark):
    rows = [("late", 4, "http", 404, False), ("tie", 1, "http", 200, False), ("tie", 1, "http", 404, False), ("tie2", 1, "conn", 0, False), ("tie2", 1, "timeout", 0, False)]
    for order in (rows, rows[::-1]):
        log = spark.createDataFrame(order, ATTEMPT_SCHEMA).coalesce(1)
        got = {r.url: r.fetch_status for r in fetch.fetch_status(log).collect()}
        assert got["late"] == "404"
        seen = got if order is rows else seen
        assert got == seen
        assert {r.url: r.fetch_status for r in fetch.fetch_status(log, 3).collect()}["late"] == "error"
        assert {r.url: r.available for r in fetch.page_availability(log).collect()} == {"late": False, "tie": True, "tie2": False}


def test_every_hot_key_is_split(spark):
    """More keys above the bound than any fixed limit, each split by its own size."""
    rows = spark.range(20_000).select("id", F.when(F.col("id") < 8000, F.lit(-1)).otherwise(F.pmod("id", F.lit(1500))).alias("key"))
    hot = skew.hot_keys(rows, "key", min_rows=5)
    assert hot.count() == 1501
    assert hot.where("key = -1").first()._salts == 1600
    assert skew.hot_keys(rows, "key").count() == 0  # under the least size worth a split
    spread = skew.salted(rows, hot, "key", ["id"]).where("key = -1").groupBy("_salt").count()
    assert spread.agg(F.max("count")).first()[0] < 40


def test_a_page_of_many_cards(spark):
    card = "<li><a href='/articles/{0}-x'>t {0}</a> text of the card, 01/02/2026</li>"
    html = "<ul>" + "".join(card.format(i) for i in range(20_000)) + "</ul>"
    lists = spark.createDataFrame([(1, html)], "page int, html string")
    got = L.page_anchors(lists, BASE).agg(F.count("*"), F.min("date"), F.max("date")).first()
    assert tuple(got) == (20_000, "01/02/2026", "01/02/2026")
    plan = L.page_anchors(lists, BASE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_only_wanted_pages_are_read(spark):
    """The page scan is cut to the wanted URLs before any HTML is read."""
    rows, articles, pages, attempts = golden(spark)
    read = builds.build_content(articles.limit(1), pages, attempts, stamp=F.lit("t"))
    text = read._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in text
    assert builds.run_counts(articles, articles.limit(1)).first()[0] == articles.count() - 1
