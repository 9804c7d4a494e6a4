"""Reports, pairs and numbers that grow batch by batch equal those over all rows."""

import random
from datetime import datetime, timezone

from pyspark.sql import functions as F

from factloom.operators import content as C, links as L, pairs as P, quality as Q
from factloom.schemas import ARTICLE_FIELDS, CONTENT_SCHEMA
from factloom.session import scratch_dir
from factloom.streaming import reports as R

ARTICLES = "article_id long, " + ", ".join(f"{c} string" for c in ARTICLE_FIELDS)


def some_articles(spark, seed, ids):
    rng = random.Random(seed)
    pick = {
        "date": ["17/06/2026", "99/99/9999", "", None, "01/02/2025"], "referensi": [None, "", "https://a|https://b", "https://a", " | "],
        "classification": ["SALAH", None, "SATIRE"], "category": ["Politik", "nan", None],
    }
    rows = [(i, *(rng.choice(pick.get(c, ["x", "", None, "nan"])) for c in ARTICLE_FIELDS)) for i in ids]
    return spark.createDataFrame(rows, ARTICLES)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_article_reports_merge(spark):
    path = scratch_dir(spark, "reports")
    empty = R.read_partials(spark, path)
    assert R.merged_summary(empty).first().n_articles == 0 and R.merged_references(empty).first().avg_refs is None
    batches = [some_articles(spark, k, range(40 * k, 40 * k + n)) for k, n in enumerate((40, 0, 1, 25))]
    for k, batch in enumerate(batches):
        for _ in range(1 + (k == 2)):  # one batch comes twice
            R.write_batch(R.article_partials(batch), path, str(k))
        partials = R.read_partials(spark, path)
        whole = batches[0]
        for other in batches[1:k + 1]:
            whole = whole.unionByName(other)
        assert rows_of(R.merged_counts(partials)) == rows_of(Q.article_counts(whole))
        assert rows_of(R.merged_completeness(partials)) == rows_of(Q.field_completeness(whole))
        assert rows_of(R.merged_summary(partials)) == rows_of(Q.article_summary(whole))
        assert rows_of(R.merged_references(partials)) == rows_of(Q.reference_stats(whole))
        assert R.merged_references(partials).schema["max_refs"].dataType == Q.reference_stats(whole).schema["max_refs"].dataType


def test_content_reports_merge(spark):
    path, keys = scratch_dir(spark, "reports"), scratch_dir(spark, "keys")
    whole = None
    for k, rows in enumerate([[(1, "false", 0, "ok"), (1, "true", 0, "404"), (2, "true", 0, None)], [(2, "true", 1, "ok"), (None, "true", 0, "ok")], []]):
        batch = spark.createDataFrame([(a, t, i, "u", "news_site", None, None, "d", s) for a, t, i, s in rows], CONTENT_SCHEMA)
        whole = batch if whole is None else whole.unionByName(batch)
        for _ in range(2):
            R.write_batch(R.content_partials(batch), path, str(k))
            R.write_batch(R.content_keys(batch), keys, str(k))
        assert rows_of(R.merged_counts(R.read_partials(spark, path))) == rows_of(Q.content_counts(whole))
        assert rows_of(R.merged_content_summary(spark, keys)) == rows_of(Q.content_summary(whole))


def content_of(spark, rows):
    return spark.createDataFrame([(a, t, i, u, "news_site", None, "text", "d", s) for a, t, i, u, s in rows], CONTENT_SCHEMA)


def test_new_pairs_add_up(spark):
    """Claims, false sources and evidence that come in any batch, in any order."""
    claims = [(i, "SALAH", f"k{i}") for i in range(4)]
    sources = [(i, "false", 0, f"f{i}", "ok") for i in range(4)] + [(i, "true", j, f"f{i}" if j == 2 else f"t{i}{j}", "404" if j == 1 else "ok") for i in range(4) for j in range(3)]
    schema = "article_id long, classification string, narasi string"
    for seed, options in ((1, {}), (2, {"usable_only": False, "drop_leaks": True})):
        rng = random.Random(seed)
        when = {row: rng.randrange(3) for row in claims + sources}
        old_a, old_c, found = spark.createDataFrame([], schema), content_of(spark, []), []
        for batch in range(3):
            new_a = spark.createDataFrame([r for r in claims if when[r] == batch], schema)
            new_c = content_of(spark, [r for r in sources if when[r] == batch])
            found += rows_of(P.new_pairs(old_a, new_a, old_c, new_c, **options))
            old_a, old_c = old_a.unionByName(new_a), old_c.unionByName(new_c)
        assert sorted(found, key=str) == rows_of(P.claim_evidence_pairs(old_a, old_c, **options))


def test_numbers_of_a_second_crawl(spark):
    """Old articles keep their numbers, new ones follow from the overlap upwards, so crawls
    in between change nothing."""
    schema = "page long, pos int, url string, date string, category string"

    def listing(names, size):
        return spark.createDataFrame([(1 + i // size, i % size, f"https://s/articles/{n}-x", None, "") for i, n in enumerate(names)], schema)

    def numbers(df):
        return {r.url.split("/")[-1]: r.article_id for r in df.collect()}

    first, second, third = [3, 2, 1], [6, 5, 4, 3, 2, 1], [8, 7, 6, 5, 4, 3, 2]
    old = L.numbered(L.in_blocks(listing(first, 2), 1)).select("url", "article_id")
    after = L.renumbered(listing(second, 2), old, pages_per_block=1)
    assert numbers(after) == {"3-x": 0, "2-x": 1, "1-x": 2, "4-x": 3, "5-x": 4, "6-x": 5}
    last = numbers(L.renumbered(listing(third, 3), after.select("url", "article_id"), pages_per_block=2))
    assert last == numbers(L.renumbered(listing(third, 2), old)) == {"3-x": 0, "2-x": 1, "4-x": 3, "5-x": 4, "6-x": 5, "7-x": 6, "8-x": 7}
    # an address that changed its title is the same article; one without a number is known by its address
    moved = spark.createDataFrame([(1, 0, "https://s/articles/3-new", None, ""), (1, 1, "https://s/about", None, ""), (1, 2, "https://s/articles/9-x", None, "")], schema)
    got = numbers(L.renumbered(moved, old))
    assert got == {"3-new": 0, "9-x": 3, "about": 4}
    again = L.renumbered(moved, L.renumbered(moved, old).select("url", "article_id"))
    assert numbers(again) == got
    none = L.renumbered(listing(first, 2), old.limit(0))
    assert numbers(none) == {"1-x": 0, "2-x": 1, "3-x": 2}
    # one article listed on two pages has one number
    twice = listing([4, 3], 1).unionByName(listing([4], 1).withColumn("page", F.lit(3).cast("long")))
    assert sorted(r.article_id for r in L.renumbered(twice, old).collect()) == [0, 3, 3]


def test_batch_stamp_is_utc_and_one_for_all_rows(spark):
    stamps = {r.stamp for r in spark.range(50).repartition(5).select(C.batch_stamp().alias("stamp")).collect()}
    assert len(stamps) == 1
    told = datetime.strptime(stamps.pop(), "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)
    assert abs((datetime.now(timezone.utc) - told).total_seconds()) < 300
