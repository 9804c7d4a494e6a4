"""Registered queries: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from factloom.functions import html as H, sections as S, text as X, urls as U
from factloom.operators import (
    articles as A, content as C, fetch, links as L, pages as P, pairs, quality as Q, resume as R,
    routing, sources as O,
)
from factloom.plans import builds
from factloom.session import scratch_dir, stored
from factloom.sources import tables as IO
from factloom.streaming import attempts, incremental, reports

from . import shapes as Z

RULES = U.DomainRules(own=[Z.OWN_HOST])


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark, sf):
    return table(spark, sf, "documents")


def pages(spark, sf):
    return table(spark, sf, "pages")


# --- text functions ----------------------------------------------------------

def clean_text(spark, sf):
    return documents(spark, sf).select("doc_id", X.clean(F.expr(Z.SPACED)).alias("text"))


def lower_text(spark, sf):
    return documents(spark, sf).select(
        "doc_id", X.lower_text(F.col("n_chars") > 1000).alias("is_long"), X.lower_text(F.col("source")).alias("source")
    )


def previews(spark, sf):
    text = X.clean(F.col("text"))
    return documents(spark, sf).select(
        "doc_id", X.preview(text, 150).alias("preview_150"), X.preview(text, 80).alias("preview_80"),
        F.length(text).alias("n_chars"),
    )


def title_label(spark, sf):
    title = F.expr(Z.BRACKETED)
    return documents(spark, sf).select(
        "doc_id",
        S.bracket_label(title).alias("label"),
        S.first_label(F.array(F.col("source"), title, F.concat(F.lit("["), F.col("lang"), F.lit("]")))).alias("first_label"),
    )


def section_extract(spark, sf):
    shaped = documents(spark, sf).select("doc_id", F.expr(Z.LINES).alias("lines"))
    return A.with_sections(shaped).select("doc_id", *S.SECTION_LABELS)


def verdict_source_split(spark, sf):
    block = X.clean(F.expr(Z.VERDICT))
    return documents(spark, sf).select("doc_id", block.alias("block")).select(
        "doc_id", S.verdict(F.col("block")).alias("hasil_periksa"), S.source_link(F.col("block")).alias("link_source")
    )


def reference_urls(spark, sf):
    refs = documents(spark, sf).select("doc_id", S.reference_urls(F.expr(Z.LINES)).alias("refs"))
    return refs.select("doc_id", F.size("refs").alias("n_refs"), S.join_list(F.col("refs")).alias("referensi"))


def article_dates(spark, sf):
    card = F.expr(f"CASE doc_id % 4 WHEN 0 THEN concat(text, ' 99/99/9999') WHEN 1 THEN '' ELSE concat('x', {Z.day('doc_id')}, '1 ', text) END")
    fallback = F.expr(Z.day("doc_id + 1"))
    found = S.first_date(card)
    date = F.coalesce(X.blank_to_null(found), fallback)
    return documents(spark, sf).select(
        "doc_id", found.alias("card_date"), date.alias("date"), S.typed_date(date).alias("pub_date")
    )


def js_redirect_flag(spark, sf):
    return documents(spark, sf).select("doc_id", X.is_js_redirect(F.expr(Z.WAITING)).alias("redirect"))


def paywall_strip(spark, sf):
    return documents(spark, sf).select("doc_id", X.strip_paywall(X.clean(F.expr(Z.WALLED))).alias("text"))


# --- URLs --------------------------------------------------------------------

def url_domain(spark, sf):
    return pages(spark, sf).select(
        "page_id",
        U.domain(F.col("url")).alias("domain"),
        U.domain(F.expr(Z.ROUTED_URL)).alias("routed_domain"),
    )


def domain_counts(spark, sf):
    hosts = pages(spark, sf).select(U.domain(F.col("url")).alias("domain"))
    return Q.value_counts(hosts, ["domain"]).select(F.col("value").alias("domain"), "n")


def page_urls(spark, sf):
    href = F.regexp_replace("url", "^http://[^/]+", "")
    return pages(spark, sf).select(
        "page_id",
        U.absolute_url(href, Z.BASE).alias("absolute"),
        U.list_page_url(Z.LIST_URL, F.col("page_id")).alias("list_url"),
        U.is_article_link(F.expr(f"replace({Z.ARTICLE_URL}, '2-', '2')")).alias("is_article"),
        U.article_number(F.expr(Z.ARTICLE_URL)).alias("article_key"),
    )


def route_urls(spark, sf):
    url = F.expr(Z.ROUTED_URL)
    routed = F.when(F.col("page_id") % 11 == 0, F.concat(F.lit(" ftp://"), url)).otherwise(url)
    return pages(spark, sf).select("page_id", U.content_type(routed, RULES).alias("content_type")).withColumn(
        "fetched", U.is_fetched(F.col("content_type"))
    )


def _host_rules(hosts: DataFrame) -> DataFrame:
    by_length = hosts.selectExpr(
        "domain", "CASE length(domain) % 4 WHEN 0 THEN 'skip' WHEN 1 THEN 'social_media' WHEN 2 THEN 'archive' END AS content_type",
        "length(domain) % 4 AS priority",
    ).where("content_type IS NOT NULL")
    mobile = hosts.where(F.col("domain").startswith("m.")).selectExpr("domain", "'social_media' AS content_type", "1 AS priority")
    return by_length.unionByName(mobile)


def route_by_rules(spark, sf):
    urls = pages(spark, sf).select("page_id", "url")
    hosts = urls.select(U.domain(F.col("url")).alias("domain")).distinct()
    return routing.route_by_rules(urls, _host_rules(hosts), ["page_id"], min_rows=50).select(
        "page_id", "domain", "content_type"
    )


# --- pages -------------------------------------------------------------------

def page_headings(spark, sf):
    parts = P.with_article_parts(pages(spark, sf).select("page_id", F.expr(Z.ARTICLE_HTML).alias("html")))
    return parts.select(
        "page_id", F.array_join("headings", " || ").alias("headings"), F.size("headings").alias("n_headings"),
        S.first_label(F.col("headings")).alias("classification"),
    )


def page_category(spark, sf):
    parts = P.with_article_parts(pages(spark, sf).select("page_id", F.expr(Z.ARTICLE_HTML).alias("html")))
    return parts.select("page_id", F.coalesce("category", F.lit("listed")).alias("category"))


def page_text(spark, sf):
    parts = P.with_article_parts(pages(spark, sf))
    return parts.select("page_id", "plain", "lines", X.clean(F.col("lines")).alias("spaced"))


def _page_text_as(spark, sf, kind):
    typed = pages(spark, sf).select("page_id", F.lit(kind).alias("content_type"), "html")
    return P.with_page_text(typed).select("page_id", "title", "text")


def page_title(spark, sf):
    return _page_text_as(spark, sf, "news_site").select("page_id", "title")


def page_body(spark, sf):
    return _page_text_as(spark, sf, "news_site").select("page_id", "text")


def archive_body(spark, sf):
    return _page_text_as(spark, sf, "archive").select("page_id", "title", "text")


def social_body(spark, sf):
    return _page_text_as(spark, sf, "social_media").select("page_id", "title", "text")


def named_containers(spark, sf):
    """Bodies picked by each of the containers, with texts around the least lengths."""
    made = pages(spark, sf).select("page_id", F.expr(Z.CONTAINER_KIND).alias("content_type"), F.expr(Z.CONTAINER_HTML).alias("html"))
    return P.with_page_text(made).select("page_id", "content_type", "text")


def selector_profile(spark, sf):
    return P.selector_profile(pages(spark, sf).select("page_id", F.expr(Z.PROFILE_HTML).alias("html")))


def first_site_link(spark, sf):
    found = pages(spark, sf).select("page_id", H.first_site_link(F.col("html"), "/th").alias("link"))
    return found.select("page_id", "link.href", "link.text")


# --- links -------------------------------------------------------------------

def _linked(spark, sf):
    return pages(spark, sf).select((F.col("page_id") + 1).alias("page"), F.expr(Z.LINKED_HTML).alias("html"))


def _sparse(spark, sf):
    return pages(spark, sf).select((F.col("page_id") + 1).alias("page"), F.expr(Z.SPARSE_HTML).alias("html"))


def anchor_links(spark, sf):
    anchors = L.page_anchors(_linked(spark, sf), Z.BASE)
    return L.first_per_page(L.in_blocks(anchors)).select("page", "url", "date")


def list_frontier(spark, sf):
    links = L.first_per_page(L.in_blocks(L.page_anchors(L.in_page_range(_sparse(spark, sf), 2), Z.BASE)))
    return L.frontier(links, 2)


def list_progress(spark, sf):
    links = stored(L.first_per_page(L.in_blocks(L.page_anchors(L.in_page_range(_sparse(spark, sf), 2), Z.BASE), 8)), "links")
    return L.page_progress(L.before_frontier(links, 2))


def article_ids(spark, sf):
    return L.collect_links(_linked(spark, sf), Z.BASE, pages_per_block=16).select("page", "url", "article_id")


def recrawl_ids(spark, sf):
    """A first crawl saw the listing from its eleventh page on; the second sees all of it."""
    old = stored(L.collect_links(_linked(spark, sf), Z.BASE, start_page=11).select("url", "article_id"), "first-crawl")
    links = L.collect_links(_linked(spark, sf), Z.BASE)
    return L.renumbered(links, old, pages_per_block=16).select("page", "url", "article_id")


# --- articles ----------------------------------------------------------------

def _article_pages(spark, sf):
    return pages(spark, sf).select("page_id", F.expr(Z.ARTICLE_URL).alias("url"), F.expr(Z.ARTICLE_HTML).alias("html"))


def _list_pages(spark, sf):
    cards = table(spark, sf, "pages").select(
        "page_id",
        (F.floor(F.col("page_id") / Z.CARDS_PER_PAGE) + 1).alias("page"), F.expr(Z.CARD).alias("card"),
    )
    return cards.groupBy("page").agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("page_id", "card"))), lambda c: c["card"]
        ), "").alias("cards")
    ).select("page", F.concat(F.lit("<html><body>" + Z.PINNED + "<ul>"), "cards", F.lit("</ul></body></html>")).alias("html"))


def article_table(spark, sf):
    return builds.build_articles(_list_pages(spark, sf), _article_pages(spark, sf), Z.BASE, min_rows=20)


def _article_attempts(spark, sf):
    """Three tries of every list page and article page.  By ``kind``, 0 succeeds at once, 1
    at the third try, 2 and 3 never; 4 is about a page that the snapshot has not."""
    rows = table(spark, sf, "pages").select("page_id")
    page = F.expr(f"page_id div {Z.CARDS_PER_PAGE} + 1")
    gap = rows.agg(F.expr(f"max(page_id) div {Z.CARDS_PER_PAGE} * 2 div 3 + 1")).scalar()
    lists = rows.select(U.list_page_url(Z.LIST_URL, page).alias("url"), F.when(page == gap, 2).otherwise(1).alias("kind")).distinct()
    kind = (F.col("page_id") % 5).cast("int")
    single = rows.select(F.concat(F.expr(Z.ARTICLE_URL), F.when(kind == 4, "-lain").otherwise("")).alias("url"), kind.alias("kind"))
    tried = lists.unionByName(single).withColumn("attempt", F.explode(F.sequence(F.lit(1), F.lit(3))))
    outcome = F.when((F.col("kind") == 2) & (F.col("attempt") == 1), "timeout").when(F.col("kind") == 3, "conn").otherwise("http")
    got = F.col("kind").isin(0, 4) | ((F.col("kind") == 1) & (F.col("attempt") == 3))
    return tried.select("url", "attempt", outcome.alias("outcome"), F.when(got, 200).otherwise(503).alias("http_status"))


def article_states(spark, sf):
    """Every address of the snapshot of article pages or of the attempt log."""
    return fetch.page_states(_article_pages(spark, sf).select("url", "page_id"), _article_attempts(spark, sf), 3)


def article_availability(spark, sf):
    """The article build under an attempt log: a failed list page ends the listing."""
    return builds.build_articles(
        _list_pages(spark, sf), _article_pages(spark, sf), Z.BASE, min_rows=20, attempts=_article_attempts(spark, sf),
        max_attempts=3, list_url=Z.LIST_URL)


def article_extras(spark, sf):
    return A.typed_extras(article_table(spark, sf)).select(
        "article_id", "article_key", "pub_date", F.size("refs").alias("n_refs")
    )


def _plain_articles(spark, sf):
    """One article per four pages, with its source and references."""
    members = table(spark, sf, "pages").select(
        F.expr(Z.ARTICLE_OF_PAGE).alias("article_id"), "page_id", F.expr(Z.ROUTED_URL).alias("url")
    )
    grouped = members.groupBy("article_id").agg(
        F.array_sort(F.collect_list(F.struct("page_id", "url"))).alias("members")
    )
    listed = S.join_list(F.transform("members", lambda m: m["url"]))
    return grouped.select(
        "article_id",
        F.expr("CASE WHEN article_id % 6 = 5 THEN cast(null AS string) ELSE members[0].url END").alias("link_source"),
        F.expr("CASE article_id % 8 WHEN 3 THEN cast(null AS string) WHEN 4 THEN ' |  | ' END").alias("special"),
        F.concat(listed, F.lit(" |  | https://missing.example/"), F.col("article_id").cast("string"),
                 F.lit(" | https://shared.example/all")).alias("listed"),
    ).select(
        "article_id", "link_source",
        F.when(F.col("article_id") % 8 == 3, F.lit(None).cast("string"))
        .when(F.col("special").isNotNull(), F.col("special")).otherwise(F.col("listed")).alias("referensi"),
    )


def explode_sources(spark, sf):
    return O.explode_sources(_plain_articles(spark, sf))


def collapse_sources(spark, sf):
    return O.collapse_sources(O.explode_sources(_plain_articles(spark, sf)))


def article_head(spark, sf):
    return A.head(_plain_articles(spark, sf), 5)


# --- content -----------------------------------------------------------------

def _attempts(spark, sf):
    outcome = F.when(F.col("event_type") == "click", F.when(F.col("value") > 60, "redirects").otherwise("timeout")) \
        .when(F.col("event_type") == "error", "conn").when(F.col("event_type") == "signup", "other").otherwise("http")
    code = F.when(F.col("event_type") == "view", 200).otherwise(
        F.element_at(F.array(*map(F.lit, [401, 403, 404, 429, 500])), (F.floor("value") % 5 + 1).cast("int")))
    keyed = table(spark, sf, "events").select(
        F.concat_ws("/", F.lit("https://u.example"), F.col("user_id").cast("string"),
                    F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 14400).cast("string")).alias("url"),
        "ts", "event_id", outcome.alias("outcome"), code.cast("int").alias("http_status"),
        (F.col("user_id") % 3 == 0).alias("is_archive"),
    )
    order = Window.partitionBy("url").orderBy("ts", "event_id")
    return keyed.withColumn("attempt", F.row_number().over(order))


def fetch_status(spark, sf):
    return fetch.fetch_status(_attempts(spark, sf))


def page_availability(spark, sf):
    return fetch.page_availability(_attempts(spark, sf))


def row_status(spark, sf):
    kinds = F.array(*map(F.lit, ["empty", "skip", "social_media", "archive", "news_site"]))
    statuses = F.array(*map(F.lit, ["ok", "ok", "blocked", "404", "ok", "timeout", "ok"]))
    shaped = documents(spark, sf).select(
        "doc_id",
        F.get(kinds, (F.col("doc_id") % 5).cast("int")).alias("content_type"),
        F.get(statuses, (F.col("doc_id") % 7).cast("int")).alias("fetch"),
        F.when(F.col("doc_id") % 11 == 0, "").otherwise(X.clean(F.expr(Z.WAITING))).alias("text"),
    )
    return shaped.select("doc_id", "content_type", C.row_status(
        F.col("content_type"), F.col("fetch"), X.is_js_redirect(F.col("text")), F.col("text")
    ).alias("scrape_status"))


def _snapshot(spark, sf):
    """Pages of every kind, each captured twice; the first capture counts."""
    base = pages(spark, sf).select("page_id", F.expr(Z.ROUTED_URL).alias("url"), F.expr(Z.ROUTED_HTML).alias("html"))
    again = base.select(
        (F.col("page_id") + 1_000_000_000).alias("page_id"), "url", F.lit("<html><body>later copy</body></html>").alias("html"))
    return base.unionByName(again)


def _page_attempts(spark, sf):
    outcomes = F.array(*map(F.lit, ["http", "timeout", "http", "conn", "http", "http", "other", "redirects"]))
    codes = F.array(*map(F.lit, [200, 0, 404, 0, 200, 403, 0, 0]))
    slot = ((F.col("page_id") + F.col("attempt")) % 8).cast("int")
    tried = table(spark, sf, "pages").select(
        "page_id", F.expr(Z.ROUTED_URL).alias("url"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("attempt"))
    return tried.select(
        "url", "attempt", F.get(outcomes, slot).alias("outcome"), F.get(codes, slot).alias("http_status"))


def content_table(spark, sf):
    rows = builds.build_content(
        _plain_articles(spark, sf), _snapshot(spark, sf), _page_attempts(spark, sf), rules=RULES,
        stamp=F.lit("fixed"), min_rows=20)
    return rows.drop("scraped_date")


def entry_counts(spark, sf):
    """Routing, extraction and status of every page, then value counts."""
    typed = pages(spark, sf).select(
        "page_id", F.expr(Z.ROUTED_URL).alias("url"), F.expr(Z.ROUTED_HTML).alias("html")
    ).withColumn("content_type", U.content_type(F.col("url"), RULES))
    kind = F.col("content_type")
    read = P.with_page_text(typed).withColumn("text", F.when(U.is_fetched(kind), F.col("text")))
    return read.select("content_type", C.row_status(
        kind, F.lit("ok"), X.is_js_redirect(F.col("text")), F.col("text")
    ).alias("scrape_status")).groupBy("content_type", "scrape_status").agg(F.count("*").alias("n"))


def resume_pending(spark, sf):
    done = table(spark, sf, "labels").select("doc_id")
    return R.pending(table(spark, sf, "documents").select("doc_id", "source"), done, "doc_id")


def seed_lookup(spark, sf):
    rows = pages(spark, sf).select("page_id", "url")
    seeds = rows.groupBy(U.domain(F.col("url")).alias("domain")).agg(F.min("url").alias("url"))
    return R.seeded(rows, seeds)


def spot_check(spark, sf):
    seeds = table(spark, sf, "pages").join(
        table(spark, sf, "labels").where("quality = 0").select(F.col("doc_id").alias("page_id")), "page_id", "left_semi"
    ).select(F.expr(Z.ARTICLE_URL).alias("url"), F.lit("").alias("date"), F.lit("").alias("category"))
    return builds.spot_check(seeds, _article_pages(spark, sf)).select("url", "field", "filled", "preview")


def _stored_content(spark, sf):
    """The content table as later jobs find it: written once, then read."""
    return stored(builds.build_content(
        _plain_articles(spark, sf), _snapshot(spark, sf), rules=RULES, stamp=F.lit("fixed"), min_rows=20), "content")


def _claims(spark, sf):
    return _plain_articles(spark, sf).select(
        "article_id", F.concat(F.lit("L"), (F.col("article_id") % 3).cast("string")).alias("classification"),
        F.concat(F.lit("klaim "), F.col("article_id").cast("string")).alias("narasi"))


def claim_evidence_pairs(spark, sf):
    return pairs.claim_evidence_pairs(_claims(spark, sf), _stored_content(spark, sf), min_rows=3)


def claim_evidence_no_leaks(spark, sf):
    found = pairs.claim_evidence_pairs(_claims(spark, sf), _stored_content(spark, sf), drop_leaks=True)
    return found.select("article_id", "source_index", "true_url", "false_url")


def claim_evidence_deltas(spark, sf):
    """The pairs that each of two batches of claims and content adds, together."""
    claims, content = _claims(spark, sf), _stored_content(spark, sf)

    def of(df, part):
        keys = [c for c in ("article_id", "source_type", "source_index") if c in df.columns]
        return df.where(F.pmod(F.xxhash64(*keys), F.lit(2)) == part)

    first = pairs.new_pairs(claims.limit(0), of(claims, 0), content.limit(0), of(content, 0))
    return first.unionByName(pairs.new_pairs(of(claims, 0), of(claims, 1), of(content, 0), of(content, 1)))


# --- counts ------------------------------------------------------------------

def label_counts(spark, sf):
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return Q.value_counts(joined, ["lang", "source", "quality", "toxic"])


def ordered_counts(spark, sf):
    return Q.ordered_counts(Q.value_counts(table(spark, sf, "documents"), ["lang", "source"]))


def _document_articles(spark, sf):
    lines = A.with_sections(documents(spark, sf).select(
        F.concat(F.lit("https://d.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.expr(Z.BRACKETED).alias("title"), F.col("lang").alias("category"),
        F.expr(f"CASE doc_id % 9 WHEN 0 THEN '' WHEN 1 THEN '99/99/9999' ELSE {Z.day('doc_id')} END").alias("date"),
        F.expr(Z.LINES).alias("lines"),
    ))
    record = {
        "classification": S.bracket_label(F.col("title")), "hasil_periksa": S.verdict(F.col("hasil")),
        "link_source": S.source_link(F.col("hasil")), "referensi": S.join_list(F.col("refs")),
    }
    return lines.select("url", *[
        X.blank_to_null(record.get(c, F.col(c))).alias(c) for c in Q.REPORT_FIELDS
    ])


def article_summary(spark, sf):
    return Q.article_summary(_document_articles(spark, sf))


def article_counts(spark, sf):
    return Q.article_counts(_document_articles(spark, sf))


def _partials(spark, sf):
    """Figures of three batches of articles, one of which comes twice."""
    path, articles = scratch_dir(spark, "partials"), _document_articles(spark, sf)
    for batch in (0, 1, 2, 1):
        part = articles.where(F.pmod(F.xxhash64("url"), F.lit(3)) == batch)
        reports.write_batch(reports.article_partials(part), path, str(batch))
    return reports.read_partials(spark, path)


def batch_counts(spark, sf):
    return reports.merged_counts(_partials(spark, sf))


def batch_summary(spark, sf):
    return reports.merged_summary(_partials(spark, sf))


def batch_completeness(spark, sf):
    return reports.merged_completeness(_partials(spark, sf))


def batch_rows(spark, sf):
    """Content rows and their articles, from the keys of three batches."""
    path, rows = scratch_dir(spark, "keys"), O.explode_sources(_plain_articles(spark, sf))
    for batch in (0, 1, 2, 1):
        part = rows.where(F.pmod(F.xxhash64("article_id", "source_index"), F.lit(3)) == batch)
        reports.write_batch(reports.content_keys(part), path, str(batch))
    return reports.merged_content_summary(spark, path)


def empty_counts(spark, sf):
    return Q.null_counts(_document_articles(spark, sf), ["narasi", "kesimpulan", "hasil_periksa", "link_source"])


def field_completeness(spark, sf):
    return Q.field_completeness(_document_articles(spark, sf))


def date_range(spark, sf):
    orders = table(spark, sf, "orders").select(F.date_format("o_orderdate", "dd/MM/yyyy").alias("date"))
    return Q.date_range(orders)


def reference_stats(spark, sf):
    return Q.reference_stats(_plain_articles(spark, sf))


def content_summary(spark, sf):
    return Q.content_summary(O.explode_sources(_plain_articles(spark, sf)))


def content_counts(spark, sf):
    return Q.content_counts(_stored_content(spark, sf))


# --- tables and streams ------------------------------------------------------

def csv_articles(spark, sf):
    """Articles written as CSV in page order and read back with their position."""
    path = scratch_dir(spark, "articles-csv")
    shaped = pages(spark, sf).select(
        "page_id",
        F.col("url"), F.expr("concat('a \"q\", ', cast(page_id AS string))").alias("classification"),
        F.lit(None).cast("string").alias("category"), F.expr(Z.day("page_id")).alias("date"),
        F.col("html").alias("narasi"), F.expr("concat(' x\n', url, ' ')").alias("penjelasan"),
        F.lit("").alias("kesimpulan"), F.lit("NA").alias("hasil_periksa"),
        F.lit("back\\slash\\").alias("link_source"), F.col("url").alias("referensi"),
    ).repartitionByRange("page_id").sortWithinPartitions("page_id")
    IO.write_articles(shaped, path, "csv")
    return IO.read_articles_csv(spark, path)


def content_round_trip(spark, sf):
    """Content rows written as CSV and Parquet, both read back and united."""
    rows = O.explode_sources(_plain_articles(spark, sf)).withColumns({
        "source_type": F.upper("source_type"),
        "content_type": U.content_type(F.col("url"), RULES),
        "title": F.lit("a, \"b\"\n"), "text": F.col("url"), "scraped_date": F.lit("d"), "scrape_status": F.lit("ok"),
    })
    csv, parquet = scratch_dir(spark, "content-csv"), scratch_dir(spark, "content-parquet")
    IO.write_content(rows, csv, "csv")
    IO.write_content(rows, parquet, "parquet", partitioned=True)
    missing = IO.read_content(spark, csv + "-missing")
    both = IO.read_content(spark, csv, "csv").unionByName(IO.read_content(spark, parquet, "parquet"))
    return both.unionByName(missing)


def incremental_content(spark, sf):
    """The stream runs over two article files, then again over nothing new."""
    root = scratch_dir(spark, "incremental")
    articles = _plain_articles(spark, sf).selectExpr(
        "article_id", *[c if c in ("link_source", "referensi") else f"cast(null AS string) AS {c}" for c in IO.ARTICLE_FIELDS])
    snapshot = f"{root}/snapshot"
    _snapshot(spark, sf).write.parquet(snapshot)
    for part in (0, 1):
        half = articles.where(F.pmod(F.xxhash64("article_id"), F.lit(2)) == part)
        half.write.mode("append").parquet(f"{root}/articles")
        for _ in range(1 + part):
            incremental.run_incremental(
                spark, f"{root}/articles", spark.read.parquet(snapshot), f"{root}/content", f"{root}/checkpoint",
                rules=RULES, stamp=F.lit("fixed"),
            ).awaitTermination()
    return incremental.read_table(spark, f"{root}/content").select(
        "article_id", "source_type", "source_index", "url", "content_type", "title", "text", "scrape_status")


def run_counts(spark, sf):
    """Articles that a content run still processes when the labelled ones are done."""
    articles = table(spark, sf, "documents").selectExpr("doc_id AS article_id", "source AS url")
    done = table(spark, sf, "labels").selectExpr("doc_id AS article_id")
    return builds.run_counts(articles, done)


def article_stream(spark, sf):
    """Both phases joined: articles written with their key, then streamed twice."""
    root = scratch_dir(spark, "phases")
    IO.write_articles(_plain_articles(spark, sf).select(
        "article_id", *[F.col(c) if c in ("link_source", "referensi") else F.lit(None).cast("string").alias(c) for c in IO.ARTICLE_FIELDS]
    ), f"{root}/articles", keyed=True)
    snapshot = f"{root}/snapshot"
    _snapshot(spark, sf).write.parquet(snapshot)
    for _ in range(2):
        incremental.run_incremental(
            spark, f"{root}/articles", spark.read.parquet(snapshot), f"{root}/content", f"{root}/checkpoint", rules=RULES, stamp=F.lit("fixed"),
        ).awaitTermination()
    return incremental.read_table(spark, f"{root}/content").select(
        "article_id", "source_type", "source_index", "url", "content_type", "title", "text", "scrape_status")


def attempt_stream(spark, sf):
    """The attempt log streamed in parts; a last row of a far later time moves its clock on."""
    root = scratch_dir(spark, "attempt-stream")
    log = _attempts(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    log.write.parquet(f"{root}/log")
    log = spark.read.parquet(f"{root}/log")
    clock = log.agg((F.max("ts") + F.expr("INTERVAL 9 DAYS")).alias("ts")).select(
        *[F.col(c) if c == "ts" else F.lit(None).cast(log.schema[c].dataType).alias(c) for c in log.columns])
    clock.write.mode("append").parquet(f"{root}/log")
    settled = attempts.settled_status(spark.readStream.schema(log.schema).parquet(f"{root}/log"), "ts").where("url IS NOT NULL")
    settled.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    return spark.read.schema(settled.schema).parquet(f"{root}/out")


QUERIES = {f.__name__: f for f in (
    clean_text, lower_text, previews, title_label, section_extract, verdict_source_split, reference_urls,
    article_dates, js_redirect_flag, paywall_strip,
    url_domain, domain_counts, page_urls, route_urls, route_by_rules,
    page_headings, page_category, page_text, page_title, page_body, archive_body, social_body,
    named_containers, selector_profile, first_site_link,
    anchor_links, list_frontier, list_progress, article_ids,
    article_table, article_states, article_availability, article_extras, explode_sources, collapse_sources, article_head,
    fetch_status, page_availability, row_status, content_table, entry_counts,
    resume_pending, seed_lookup, spot_check, claim_evidence_pairs, claim_evidence_no_leaks,
    label_counts, ordered_counts, article_summary, article_counts, empty_counts, field_completeness,
    date_range, reference_stats, content_summary, content_counts,
    csv_articles, content_round_trip, incremental_content, article_stream, attempt_stream, run_counts,
    recrawl_ids, claim_evidence_deltas, batch_counts, batch_summary, batch_completeness, batch_rows,
)}
