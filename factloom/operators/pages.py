"""Page snapshot -> page columns (title, body text, article parts, profile)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import html as H, html_tree, text as X


def with_page_text(
    pages: DataFrame,
    html: str = "html",
    content_type: str = "content_type",
    news_min_length: int = H.NEWS_MIN_LENGTH,
    archive_min_length: int = H.ARCHIVE_MIN_LENGTH,
    fallback: bool = True,
) -> DataFrame:
    """Add ``title`` and ``text``, chosen by content type; drop the HTML.

    Narrow: no shuffle, and the HTML column does not leave the scan stage.
    Titles stay empty for types other than news sites and archives.
    ``fallback=False`` keeps the plan free of Python and returns the native
    value for every page.
    """
    kept = [c for c in pages.columns if c != html]
    kind = F.col(content_type)
    page, markup = F.col("_page"), F.col("_markup")

    def fills(nodes: str) -> Column:
        text = H.decode_entities(F.col(nodes))
        return (
            F.when(kind == "news_site", H.is_longer(text, news_min_length))
            .when(kind == "archive", H.is_longer(text, archive_min_length))
            .otherwise(False)
        )

    def present(tags: str, source: Column, tag: str) -> Column:
        return F.when(F.array_contains(tags, tag), H.first_element(source, tag)).otherwise("")

    # Staged so that each pass over the page runs once, whoever reads its result.
    staged = (
        pages
        .withColumns({"_page": H.visible(F.col(html)), "_markup": H.denoised(F.col(html))})
        .withColumns({"_tags": H.structure(page), "_body_tags": H.structure(markup)})
        .withColumns({
            "_t_article": present("_tags", page, "article"),
            "_t_main": present("_tags", page, "main"),
            "_b_article": present("_body_tags", markup, "article"),
            "_b_main": present("_body_tags", markup, "main"),
        })
        .withColumns({
            "_title": H.nodes(H.title_element(page, F.col("_t_article"), F.col("_t_main"))),
            "_article": H.nodes(F.col("_b_article")),
            "_main": H.nodes(F.col("_b_main")),
        })
        .withColumn(
            "_text",
            F.when(fills("_article"), F.col("_article"))
            .when(fills("_main"), F.col("_main"))
            .otherwise(H.nodes(H.body_element(markup))),
        )
    )
    title = H.glued(H.decode_entities(F.col("_title")))
    text = H.cleaned(H.decode_entities(F.col("_text")))
    if fallback:
        tree = html_tree.tree_fields(
            {
                "news_site": (H.NEWS_CONTAINERS, news_min_length),
                "archive": (H.ARCHIVE_CONTAINERS, archive_min_length),
            },
            H.NEWS_CONTAINERS, H.NOISE_TAGS, H.HIDDEN_TAGS,
        )
        hard = F.col("_hard")
        read = (
            staged.withColumn("_hard", F.coalesce(_needs_tree(kind), F.lit(False)))
            .select(
                *kept, "_hard",
                F.when(hard, F.col(html)).alias("_hard_html"),
                F.when(~hard, title).alias("_title"),
                F.when(~hard, text).alias("_text"),
            )
            .withColumn("_tree", tree(F.col("_hard_html"), kind))
            .select(
                *kept,
                F.when(hard, F.col("_tree.title")).otherwise(F.col("_title")).alias("title"),
                F.when(hard, F.col("_tree.text")).otherwise(F.col("_text")).alias("text"),
            )
        )
    else:
        read = staged.select(*kept, title.alias("title"), text.alias("text"))
    return read.withColumns({
        "title": F.when(kind.isin("news_site", "archive"), F.col("title")).otherwise(""),
        "text": X.strip_paywall(F.col("text")),
    })


def _needs_tree(kind: Column) -> Column:
    """Pages on which the native stages could differ from a real tree."""
    page, markup = F.col("_page"), F.col("_markup")
    tags, body_tags = F.col("_tags"), F.col("_body_tags")
    unclear = F.lit(False)
    for tag in ("article", "main"):
        unclear = unclear | H.is_unclear(tags, tag) | H.is_unclear(body_tags, tag)
    untitled = (F.col("_title") == "") & (F.array_contains(tags, "h1") | F.array_contains(tags, "title"))
    bodiless = ~F.array_contains(body_tags, "body")
    # A first article with a heading and enough text is preferred to anything
    # picked by class or id; archive wrappers come before the article.
    settled = H.has_element(F.col("_t_article"), "h1") & F.col("_text").eqNullSafe(F.col("_article"))
    named = (
        F.when(kind == "news_site", ~settled & H.has_named(page, H.NEWS_CONTAINERS))
        .when(kind == "archive",
              H.has_named(page, H.ARCHIVE_CONTAINERS)
              | (~settled & H.has_named(page, H.NEWS_CONTAINERS)))
    )
    foreign = H.has_foreign_entity(F.col("_title")) | H.has_foreign_entity(F.col("_text"))
    return (
        H.is_torn(page) | H.has_left_over(markup) | unclear | untitled | bodiless | foreign
        | F.coalesce(named, F.lit(False))
    )


def with_article_parts(pages: DataFrame, html: str = "html", fallback: bool = True) -> DataFrame:
    """Add ``headings``, ``category``, ``plain`` and ``lines``; drop the HTML."""
    kept = [c for c in pages.columns if c != html]
    staged = (
        pages
        .withColumn("_page", H.visible(F.col(html)))
        .withColumn("_nodes", H.nodes(F.col("_page")))
    )
    native = {
        "headings": H.headings_of(F.col("_page")),
        "category": H.category_link_of(F.col("_page")),
        "plain": H.joined(F.col("_nodes"), ""),
        "lines": H.joined(F.col("_nodes"), "\n"),
    }
    if not fallback:
        return staged.select(*kept, *[c.alias(name) for name, c in native.items()])
    tree = html_tree.article_parts(H.HIDDEN_TAGS)
    hard = F.col("_hard")
    return (
        staged
        .withColumn("_hard", F.coalesce(
            H.is_torn(F.col("_page")) | H.has_open_heading(F.col("_page"))
            | H.has_foreign_entity(F.col("_nodes")),
            F.lit(False),
        ))
        .select(
            *kept, "_hard",
            F.when(hard, F.col(html)).alias("_hard_html"),
            *[F.when(~hard, c).alias(f"_{name}") for name, c in native.items()],
        )
        .withColumn("_tree", tree(F.col("_hard_html")))
        .select(*kept, *[
            F.when(hard, F.col("_tree")[name]).otherwise(F.col(f"_{name}")).alias(name)
            for name in native
        ])
    )


def selector_profile(
    pages: DataFrame, html: str = "html", selectors: list[str] | None = None
) -> DataFrame:
    """Per selector: matching elements and pages with at least one match."""
    selectors = selectors or H.PROFILE_SELECTORS
    counts = pages.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("selector"), H.selector_count(F.col(html), s).alias("n"))
        for s in selectors
    ])).alias("hit")).select("hit.*")
    return counts.groupBy("selector").agg(
        F.sum("n").alias("n_elements"), F.count_if(F.col("n") > 0).alias("n_pages")
    )
