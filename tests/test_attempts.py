"""The status of a stream of attempts equals that of the whole log, in any order of arrival."""

import itertools
import random
from datetime import datetime, timedelta

import pytest

from factloom.operators import fetch
from factloom.session import scratch_dir
from factloom.streaming import attempts as A

SCHEMA = "url string, attempt int, outcome string, http_status int, is_archive boolean, at timestamp"
START = datetime(2026, 1, 1)
KINDS = [("http", 200), ("http", 403), ("http", 404), ("http", 429), ("redirects", 0), ("timeout", 0), ("conn", 0), ("other", 0)]


def all_triples():
    for n, (triple, archive) in enumerate(itertools.product(itertools.product(KINDS, repeat=3), (False, True))):
        for i, (outcome, code) in enumerate(triple, 1):
            yield (f"u{n}", i, outcome, code, archive)


def run(spark, batches, **options):
    """Rows the stream gives for these batches and a last one that moves the clock on."""
    root = scratch_dir(spark, "attempt-stream")
    clock = [("clock", 1, "other", 0, False, START + timedelta(days=9))]
    for batch in (*batches, clock):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    log = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    query = A.settled_status(log, "at", **options).writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    query.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    got = spark.read.schema("url string, fetch_status string").parquet(f"{root}/out").where("url is null or url <> 'clock'")
    return sorted(map(tuple, got.collect()), key=str)


def whole(spark, rows, max_attempts=None):
    return sorted(map(tuple, fetch.fetch_status(spark.createDataFrame(rows, SCHEMA), max_attempts).collect()), key=str)


@pytest.mark.parametrize("max_attempts", [3, None])
def test_all_triples_in_any_order(spark, max_attempts):
    rng = random.Random(max_attempts or 0)
    rows = [(*row, START + timedelta(seconds=rng.randrange(1800))) for row in all_triples()]
    rng.shuffle(rows)
    assert run(spark, [rows[::2], rows[1::2]], max_attempts=max_attempts) == whole(spark, rows, max_attempts)


def test_shared_numbers_nulls_and_gaps(spark):
    def at(seconds):
        return START + timedelta(seconds=seconds)

    first = [
        ("a", 1, "http", 404, False, at(0)), ("b", 2, "http", 403, True, at(1)), ("c", 1, "timeout", None, None, at(2)),
        (None, 1, "conn", 0, True, at(3)), ("d", None, "http", 200, False, at(4)), ("e", 9, "http", 200, False, at(5)), ("a", 1, "http", 404, False, at(6)),
    ]
    second = [("a", 1, "http", 200, False, at(7)), ("b", 1, "http", 200, True, at(8)), ("c", 70, "http", 200, False, at(9)), (None, 2, "other", 0, True, at(9))]
    got = run(spark, [first, second], max_attempts=80, early=False)
    assert got == whole(spark, first + second, 80)


@pytest.mark.parametrize("first, seen, bound, want", [
    (1 * A.CODES, 0b1, None, True), (2 * A.CODES, 0b10, None, False), (2 * A.CODES, 0b11, None, True),
    (A.NONE, 0b111, 3, True), (A.NONE, 0b101, 3, False), (A.NONE, 0b111, None, False), (70 * A.CODES, -1, None, False),
])
def test_settled(first, seen, bound, want):
    assert A.is_settled(first, seen, bound) is want


def test_urls_share_pages_of_state(spark, monkeypatch):
    """Fifty URLs in four pages: settled early, by the clock beside a page's new rows, and
    by the last clock; a row after that gives nothing."""
    monkeypatch.setattr(A, "PAGES", 4)
    rows = [[], [], [], []]
    for i in range(50):
        rows[0].append((f"a{i}", 1, *(("http", 200) if i % 3 == 0 else ("timeout", 0)), False, START + timedelta(seconds=i)))
        rows[1].append((f"b{i}", 1, "timeout", 0, False, START + timedelta(hours=8)))
        rows[2 + (i % 2)].append((f"b{i}", 2, "http", 404, False, START + timedelta(hours=8, seconds=i)))
        rows[3].append((f"a{i}", 2, "http", 404, False, START + timedelta(hours=8, seconds=i)))
    rows[0].append((None, 1, "conn", 0, True, None))
    want = [(f"a{i}", "ok" if i % 3 == 0 else "timeout") for i in range(50)]
    want += [(f"b{i}", "404") for i in range(50)] + [(None, "archive_blocked")]
    assert run(spark, rows) == sorted(want, key=str)
    calls = spark.range(3000).selectExpr("concat('u', id) AS url", "1 AS attempt", "'timeout' AS outcome", "0 AS http_status", "false AS is_archive", "timestamp '2026-01-01' AS at")
    root = scratch_dir(spark, "attempt-pages")
    calls.write.parquet(f"{root}/in")
    query = A.settled_status(spark.readStream.schema(SCHEMA).parquet(f"{root}/in"), "at").writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    query = query.trigger(availableNow=True).start(f"{root}/out")
    query.awaitTermination()
    assert max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]) <= 4
