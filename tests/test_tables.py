"""Round trips, the incremental build and plan shapes."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from factloom.operators import articles as A, content as C, links as L, pages as P, quality as Q
from factloom.plans import builds
from factloom.schemas import ARTICLE_FIELDS, ARTICLE_SCHEMA, CONTENT_SCHEMA
from factloom.session import scratch_dir, stored
from factloom.sources import tables as IO
from factloom.streaming import incremental, keys

SF = "/root/testdata/sf0.001"
TRICKY = ['a "b", c', "line\nbreak", " outer ", "back\\slash\\", "é😀", None, "x,y", '"', "'", "a\r\nb"]


def tricky(spark, n=10):
    rows = [tuple(TRICKY[(i + j) % len(TRICKY)] for j in range(len(ARTICLE_FIELDS))) for i in range(n)]
    return rows, spark.createDataFrame(rows, ARTICLE_SCHEMA)


def test_article_csv_round_trip_with_positions(spark):
    rows, df = tricky(spark)
    path = scratch_dir(spark, "t")
    IO.write_articles(df.coalesce(1), path, "csv")
    got = IO.read_articles_csv(spark, path).orderBy("article_id").collect()
    assert [tuple(r)[1:] for r in got] == rows and [r.article_id for r in got] == list(range(10))


def test_positions_run_over_several_files(spark):
    for fmt in ("csv", "parquet"):
        path = scratch_dir(spark, "t")
        ids = spark.range(40).select(*[F.col("id").cast("string").alias(c) for c in ARTICLE_FIELDS])
        IO.write_articles(ids.repartitionByRange(5, F.col("url").cast("int")).sortWithinPartitions(F.col("url").cast("int")), path, fmt)
        read = IO.read_articles_csv(spark, path) if fmt == "csv" else IO.read_articles_parquet(spark, path)
        assert all(str(r.article_id) == r.url for r in read.collect()) and read.count() == 40
        if fmt == "parquet":
            spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
            try:
                assert all(str(r.article_id) == r.url for r in IO.read_articles_parquet(spark, path).collect())
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_with_byte_order_mark_and_missing_cells(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="t-"), "a.csv")
    with open(path, "w", encoding="utf-8-sig", newline="") as out:
        out.write(",".join(ARTICLE_FIELDS) + '\nu,"a ""q""",NA,nan,,"x\ny",None,n/a,NaN,null\n')
    row = IO.read_articles_csv(spark, path).first()
    assert tuple(row) == (0, "u", 'a "q"', None, None, None, "x\ny", None, None, None, None)


def test_content_round_trip(spark):
    rows = [(1, "TRUE", 0, "u", "news_site", 'a "t"\n', None, "d", "404"), (2, "false", 0, None, "empty", None, None, "d", "empty_url")]
    df = spark.createDataFrame(rows, CONTENT_SCHEMA)
    want = sorted((r[0], r[1].lower(), *r[2:]) for r in rows)
    for fmt, partitioned in (("csv", False), ("parquet", False), ("parquet", True)):
        path = scratch_dir(spark, "t")
        IO.write_content(df, path, fmt, partitioned=partitioned)
        assert sorted(tuple(r) for r in IO.read_content(spark, path, fmt).collect()) == want
    missing = IO.read_content(spark, path + "-none")
    assert missing.count() == 0 and missing.schema == CONTENT_SCHEMA


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert stored(spark.range(3), "x").count() == 3


def articles_of(spark, rows):
    blank = {c: F.lit(None).cast("string").alias(c) for c in ARTICLE_FIELDS}
    df = spark.createDataFrame(rows, "article_id long, url string, link_source string, referensi string")
    return df.select("article_id", *[F.col(c) if c in df.columns else blank[c] for c in ARTICLE_FIELDS])


def test_stream_keeps_articles_without_a_key(spark):
    """Null keys are told apart by address; a file without the key column is refused."""
    root = scratch_dir(spark, "inc")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    rows = articles_of(spark, [(None, f"s/{i}", None, None) for i in range(5)])
    IO.write_articles(rows, f"{root}/bare")
    with pytest.raises(ValueError, match="article_id"):
        incremental.run_incremental(spark, f"{root}/bare", pages, f"{root}/out", f"{root}/cp0")
    IO.write_articles(rows, f"{root}/in", keyed=True)
    for checkpoint in ("cp1", "cp1", "cp2"):
        incremental.run_incremental(spark, f"{root}/in", pages, f"{root}/out", f"{root}/{checkpoint}").awaitTermination()
    found = incremental.read_table(spark, f"{root}/out")
    assert found.count() == 10 and found.select("article_id").distinct().count() == 5


def test_incremental_build(spark):
    root = scratch_dir(spark, "inc")
    pages = spark.createDataFrame([(1, "https://a.example", "<body>isi a</body>"), (2, "https://b.example", "<body>isi b</body>")], "page_id long, url string, html string")

    def run(checkpoint="cp"):
        incremental.run_incremental(spark, f"{root}/in", pages, f"{root}/out", f"{root}/{checkpoint}", stamp=F.lit("t")).awaitTermination()
        return sorted((r.article_id, r.source_type, r.source_index, r.url, r.scrape_status) for r in incremental.read_table(spark, f"{root}/out").collect())

    assert incremental.read_table(spark, f"{root}/out").count() == 0
    articles_of(spark, [(1, "s/articles/1-a", "https://a.example", "https://b.example|https://c.example")]).write.parquet(f"{root}/in")
    first = run()
    assert first == [(1, "false", 0, "https://a.example", "ok"), (1, "true", 0, "https://b.example", "ok"), (1, "true", 1, "https://c.example", "error")]
    assert run() == first
    # an article seen before, one new article twice
    new = [(1, "s/articles/1-a", "https://z", None), (2, "s/articles/2-a", None, "https://a.example"), (2, "s/articles/2-a", None, "https://a.example")]
    articles_of(spark, new).write.mode("append").parquet(f"{root}/in")
    second = run()
    assert second == sorted(first + [(2, "false", 0, None, "empty_url"), (2, "true", 0, "https://a.example", "ok")])
    # a new stream over the same input adds nothing: presence in the output decides
    assert run("cp2") == second


def test_incremental_batch_can_be_repeated(spark):
    """A batch that is run again replaces its own partition."""
    root = scratch_dir(spark, "inc")
    pages = spark.createDataFrame([(1, "https://a.example", "<body>isi</body>")], "page_id long, url string, html string")
    spark.createDataFrame([('{"id":"q"}',)], "value string").write.text(f"{root}/cp/metadata")
    write = incremental.content_batch_writer(pages, f"{root}/out", f"{root}/cp", stamp=F.lit("t"))
    batch = articles_of(spark, [(1, "u", "https://a.example", None)])
    for _ in range(2):
        write(batch, 0)
    write(batch, 1)
    got = incremental.read_table(spark, f"{root}/out")
    assert got.count() == 2 and got.select("batch_id").distinct().count() == 1


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_plans(spark):
    if not os.path.exists(SF):
        pytest.skip("no test tables")
    from suite import queries as S

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    typed = pages.select("page_id", "html", F.lit("news_site").alias("content_type"))
    native = plan(P.with_page_text(typed, fallback=False))
    assert "Exchange" not in native and "Python" not in native
    assert "ReadSchema: struct<page_id:bigint,html:string>" in native
    hybrid = plan(P.with_page_text(typed))
    assert "Exchange" not in hybrid and hybrid.count("ArrowEvalPython") <= 4
    for name, query in S.QUERIES.items():
        if name in ("csv_articles", "content_round_trip", "incremental_content", "article_stream"):
            continue
        text = plan(query(spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
    for name in ("url_domain", "clean_text"):
        assert "Exchange" not in plan(S.QUERIES[name](spark, SF)), name
    counts = plan(Q.value_counts(pages, ["url"]))
    assert "ReadSchema: struct<url:string>" in counts
    stats = plan(A.head(spark.read.schema("article_id long, referensi string").parquet(_written(spark)), 5, "article_id"))
    assert "PushedFilters: [IsNotNull(article_id), LessThan(article_id,5)]" in stats


def _written(spark):
    path = scratch_dir(spark, "t")
    spark.range(10).selectExpr("id AS article_id", "'x' AS referensi").write.parquet(path)
    return path


def test_first_seen_by_state(spark):
    """Keys of the output and of earlier batches are done; copies in a batch give the least row."""
    root = scratch_dir(spark, "keys")
    schema = "article_id long, url string, text string"
    keys.ensure_output(spark, f"{root}/out")
    keys.ensure_output(spark, f"{root}/out")

    def run():
        articles = spark.readStream.schema(schema).parquet(f"{root}/in")
        new = keys.first_seen(articles, keys.written_keys(spark, f"{root}/out"))
        new.writeStream.format("parquet").option("path", f"{root}/seen").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start().awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(f"{root}/seen").collect())

    def add(folder, rows, columns=schema):
        spark.createDataFrame(rows, columns).write.mode("append").parquet(f"{root}/{folder}")

    add("in", [(1, "b", None), (1, "a", "x"), (1, "a", None), (2, "c", "c"), (-5, None, None)])
    add("out/stream_id=other/batch_id=0", [(2,), (None,)], "article_id long")
    assert run() == [(-5, None, None), (1, "a", None)]
    add("in", [(1, "a", None), (3, "d", "d"), (4, "e", "e")])
    add("out/stream_id=other/batch_id=1", [(4,)], "article_id long")
    assert run() == [(-5, None, None), (1, "a", None), (3, "d", "d")]
    assert run() == [(-5, None, None), (1, "a", None), (3, "d", "d")]


def test_two_streams_over_a_growing_output(spark):
    """Each stream learns what the other wrote; a batch reads no content from before."""
    root = scratch_dir(spark, "two")
    pages = spark.createDataFrame([(1, "https://a.example", "<body>isi</body>")], "page_id long, url string, html string")

    def run(name):
        query = incremental.run_incremental(spark, f"{root}/in", pages, f"{root}/out", f"{root}/{name}", stamp=F.lit("t"))
        query.awaitTermination()
        read = [source["numInputRows"] for progress in query.recentProgress for source in progress["sources"] if "/out" in source["description"]]
        return sum(read)

    read = []
    for i in range(4):
        rows = [(10 * i + k, f"s/articles/{10 * i + k}-x", "https://a.example", None) for k in range(3)]
        articles_of(spark, rows).write.mode("append").parquet(f"{root}/in")
        read.append(run("one" if i % 2 else "two"))
    table = incremental.read_table(spark, f"{root}/out")
    assert sorted(r.article_id for r in table.collect()) == [10 * i + k for i in range(4) for k in range(3) for _ in range(2)]
    # Six rows a run, two of each article: what was written since the stream's last batch, its own and the other's.
    assert read == [0, 6, 12, 12]
