"""List pages -> article links: discovery, dedup, frontier, numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import html as H, html_outline, html_tree, sections as S, urls as U
from ..session import stored
from .fetch import unavailable
from .skew import block_offsets, spread_lookup

# Consecutive list pages are processed as one block: enough blocks to spread a
# long listing, few enough that one row per block is a small table.
PAGES_PER_BLOCK = 256


def in_page_range(list_pages: DataFrame, start_page: int = 1, max_pages: int | None = None) -> DataFrame:
    kept = list_pages.where(F.col("page") >= start_page)
    return kept.where(F.col("page") < start_page + max_pages) if max_pages else kept


def page_anchors(list_pages: DataFrame, base_url: str, fallback: bool = True) -> DataFrame:
    """(page, pos, url, date) of every article link, duplicates included.

    Anchors and the text of their parents come from the page's tags; only pages that these
    do not settle go to the tree reader.  ``fallback=False`` keeps the plan free of Python.
    """
    page = list_pages.select("page", "html").withColumn("_page", H.visible(F.col("html")))
    page = page.withColumn("_parts", html_outline.tokens(F.col("_page")))
    hard = F.coalesce(html_outline.is_hard(F.col("html"), F.col("_page"), F.col("_parts")), F.lit(False)) if fallback else F.lit(False)
    page = page.withColumn("_hard", hard).withColumn("_found", F.when(~F.col("_hard"), html_outline.outline(F.col("_parts"))))
    page = page.withColumn("_dates", html_outline.parent_dates(F.col("_parts"), F.col("_found"), S.DATE_PATTERN))
    native = html_outline.dated_anchors(F.col("_parts"), F.col("_found"), F.col("_dates"))
    read = page.select("page", F.when(F.col("_hard"), F.col("html")).alias("_html"), "_hard", F.when(~F.col("_hard"), native).alias("_native"))
    if fallback:
        tree = html_tree.dated_anchors(H.HIDDEN_TAGS, S.DATE_PATTERN.replace(r"\p{Nd}", r"\d"))(F.col("_html"))
        read = read.withColumn("_native", F.when(F.col("_hard"), tree).otherwise(F.col("_native")))
    # The outer form keeps the planner from adding a size test, which would read pages twice.
    anchors = read.select("page", F.posexplode_outer("_native").alias("pos", "anchor"))
    return anchors.where(U.is_article_link(F.col("anchor.href"))).select(
        "page", "pos", U.absolute_url(F.col("anchor.href"), base_url).alias("url"), "anchor.date"
    )


def in_blocks(df: DataFrame, pages_per_block: int = PAGES_PER_BLOCK) -> DataFrame:
    """Cluster by block of pages; every window below reuses this one shuffle."""
    return df.withColumn("block", F.floor(F.col("page") / pages_per_block)).repartition("block")


def failed_list_pages(attempts: DataFrame, list_url: str, max_attempts: int | None = None) -> DataFrame:
    """``page`` of every list page that the attempt log never got."""
    number = F.regexp_extract("url", r"\?page=(\d{1,18})\z", 1).try_cast("bigint")
    return unavailable(attempts, max_attempts).withColumn("page", number).where(
        F.col("url") == U.list_page_url(list_url, F.col("page"))
    ).select("page")


def first_per_page(anchors: DataFrame) -> DataFrame:
    """First occurrence of each URL within its list page."""
    copies = Window.partitionBy("block", "page", "url").orderBy("pos")
    return (
        anchors.withColumn("_copy", F.row_number().over(copies))
        .where(F.col("_copy") == 1).drop("_copy")
    )


def frontier(links: DataFrame, start_page: int = 1, pages_per_block: int = PAGES_PER_BLOCK) -> DataFrame:
    """One row ``stop``: the first page, from the start on, without links.

    Pages that are absent count as pages without links.  One pass: the pages of a block
    become one bounded array, whose first hole is found there; a block without holes is
    followed by a hole if the next block is missing.  Only one row per block is ordered.
    """
    size, page = F.lit(pages_per_block), F.col("page").cast("bigint")
    blocks = links.where(page >= start_page).groupBy(F.floor(page / size).alias("part")).agg(F.collect_set(page).alias("pages"))
    first, last = F.greatest(F.col("part") * size, F.lit(start_page)), F.col("part") * size + size - 1
    hole = F.array_min(F.array_except(F.sequence(first, last), "pages"))
    following = F.lead("part").over(Window.orderBy("part"))
    after = F.when(following.isNull() | (following != F.col("part") + 1), last + 1)
    found = blocks.select("part", F.coalesce(hole, after).alias("hole")).agg(F.min("hole").alias("hole"), F.min("part").alias("part"))
    starts = F.col("part") == start_page // pages_per_block
    return found.select(F.when(starts, F.col("hole")).otherwise(F.lit(start_page)).cast("bigint").alias("stop"))


def before_frontier(links: DataFrame, start_page: int = 1) -> DataFrame:
    return links.where(F.col("page") < frontier(links, start_page).scalar())


def page_progress(links: DataFrame) -> DataFrame:
    """Per page: links found and total so far.  Needs ``block``."""
    per_page = links.groupBy("block", "page").agg(F.count("*").alias("n_links"))
    so_far = Window.partitionBy("block").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    return (
        per_page.withColumn("_within", F.sum("n_links").over(so_far))
        .join(block_offsets(per_page, "block", F.sum("n_links")), "block")
        .select("page", "n_links", (F.col("_offset") + F.col("_within")).alias("total_so_far"))
    )


def numbered(links: DataFrame) -> DataFrame:
    """Add ``article_id``, the 0-based position in crawl order.  Needs ``block``.

    Position in the block plus the rows in earlier blocks: no global sort.
    """
    within = Window.partitionBy("block").orderBy("page", "pos")
    return (
        links.withColumn("_within", F.row_number().over(within) - 1)
        .join(block_offsets(links, "block", F.count("*")), "block")
        .withColumn("article_id", (F.col("_offset") + F.col("_within")).cast("bigint"))
        .drop("block", "_within", "_offset")
    )


def renumbered(links: DataFrame, old: DataFrame, pages_per_block: int = PAGES_PER_BLOCK) -> DataFrame:
    """Links of a repeated crawl with ``article_id``: known articles keep the number that
    ``old`` (``url``, ``article_id``) has for them, new ones follow its highest.

    Articles are told apart by the number in their address, else by the address, so a changed
    title is no new article.  A newest-first listing puts new articles above the known ones;
    they are numbered from the overlap upwards, oldest first, so crawls in between would have
    given the same numbers.  An article that is listed more than once counts where it is first.
    """
    key = F.coalesce(U.article_number(F.col("url")).cast("string"), F.col("url"), F.lit("")).alias("_key")
    known = old.select(key, "article_id").groupBy("_key").agg(F.min("article_id").alias("article_id"))
    links = links.drop("article_id").withColumn("_key", key)
    places = links.groupBy("_key").agg(F.min(F.struct("page", "pos")).alias("place")).select("_key", "place.*")
    # Stored: counted and numbered from one reading of the listing.
    new = stored(places.join(known, "_key", "left_anti"), "new-links")
    first = F.coalesce(known.agg(F.max("article_id")).scalar(), F.lit(-1)) + 1
    count = new.agg(F.count("*")).scalar()
    upwards = numbered(in_blocks(new, pages_per_block)).select("_key", (first + count - 1 - F.col("article_id")).cast("bigint").alias("article_id"))
    return spread_lookup(links, known.unionByName(upwards), "_key", ["page", "pos"], "left").drop("_key")


def collect_links(
    list_pages: DataFrame,
    base_url: str,
    start_page: int = 1,
    max_pages: int | None = None,
    pages_per_block: int = PAGES_PER_BLOCK,
    failed: DataFrame | None = None,
) -> DataFrame:
    """Article links in crawl order: (page, pos, url, date, category, article_id).

    A list page named in ``failed`` gives no links, so it ends the frontier like one that
    is absent, whatever the snapshot has for it.
    """
    anchors = page_anchors(in_page_range(list_pages, start_page, max_pages), base_url)
    if failed is not None:
        anchors = anchors.join(failed.distinct(), "page", "left_anti")
    links = first_per_page(in_blocks(anchors, pages_per_block))
    # Cut-off, counts and numbering all read the links; the HTML is parsed once.
    links = stored(links, "links")
    kept = before_frontier(links, start_page)
    return numbered(kept).select(
        "page", "pos", "url", "date", F.lit("").alias("category"), "article_id"
    )
