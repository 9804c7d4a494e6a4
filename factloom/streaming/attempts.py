"""Attempt log as a stream -> one final status per URL, as soon as it is settled.

State per URL is four numbers: the place of the first final attempt, that of the last
attempt, the attempts seen as a bit set, and the time of the latest.  A URL is settled when a
final attempt and all before it have come, or all of ``max_attempts``; else when the log's own
clock is ``wait`` past its latest attempt.  Each URL gives one row; attempts that come after
it change nothing.  Where several logs share attempt numbers, settle by the clock alone
(``early=False``), as a number may come again.

A call of Python costs more than a URL's few rows, so URLs share keyed state: one of
``PAGES`` pages, by hash, holds the numbers of its URLs as one packed value.  A batch reads
and writes the pages of its own URLs and of those whose wait is over, no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.fetch import CODES, places, status_at

NONE = -1
BITS = 62  # attempts beyond it count, but never settle a URL early
PAGES = 1 << 12  # fixed for the life of a checkpoint
STATE = "page binary"
PAGE = pa.schema([("url", pa.string()), *((n, pa.int64()) for n in ("first_final", "last", "seen", "due"))])


def is_settled(first_final: int, seen: int, max_attempts: int | None) -> bool:
    """No attempt that is still to come can change the status."""
    bound = max_attempts if first_final == NONE else first_final // CODES
    if bound is None or not 0 < bound <= BITS:
        return False
    needed = (1 << bound) - 1
    return seen & needed == needed


def read_page(raw: bytes) -> dict[str | None, list[int]]:
    """First final, last, seen and due of each URL; a URL that is done is never due."""
    return {url: list(numbers) for url, *numbers in zip(*(c.to_pylist() for c in pa.ipc.read_record_batch(raw, PAGE).columns))}


def write_page(urls: dict[str | None, list[int]]) -> bytes:
    columns = [list(urls), *([list(c) for c in zip(*urls.values())] or [[]] * 4)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PAGE)], schema=PAGE).serialize().to_pybytes()


def settled_status(attempts: DataFrame, at: str, wait_seconds: int = 3600, max_attempts: int | None = None, early: bool = True) -> DataFrame:
    """(url, fetch_status) of a stream of attempts with the time column ``at``.

    Equals ``fetch.fetch_status`` over the same rows in whatever order they come, as long as
    none is later than ``wait_seconds`` behind the others.  A URL of which no attempt counts is an error.
    """
    rows = places(attempts.withWatermark(at, f"{wait_seconds} seconds"), max_attempts, at)
    read = rows.select(
        F.pmod(F.xxhash64("url"), F.lit(PAGES)).alias("page"), "url", F.coalesce("place", F.lit(NONE)).alias("place"),
        F.coalesce("final", F.lit(False)).alias("final"), at, F.coalesce(F.unix_millis(at), F.lit(0)).alias("millis"))
    out = T.StructType([T.StructField("url", T.StringType()), T.StructField("place", T.LongType())])
    wait = wait_seconds * 1000

    def work(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        urls = read_page(state.get[0]) if state.exists else {}
        clock, latest, settled = state.getCurrentWatermarkMs(), {}, []
        if not state.hasTimedOut:
            for frame in frames:
                for url, place, final, millis in zip(*(frame[c].tolist() for c in ("url", "place", "final", "millis"))):
                    one = urls.setdefault(url, [NONE, NONE, 0, 0])
                    if one[3] == NONE:
                        continue
                    latest[url] = max(latest.get(url, 0), millis)
                    if place == NONE:
                        continue
                    one[1] = max(one[1], place)
                    if final:
                        one[0] = min(one[0], place) if one[0] != NONE else place
                    attempt = place // CODES
                    if 0 < attempt <= BITS:
                        one[2] |= 1 << (attempt - 1)
        for url, one in urls.items():
            if url in latest:
                over = early and is_settled(one[0], one[2], max_attempts)
                one[3] = max(latest[url], clock) + wait
            else:
                over = one[3] != NONE and one[3] < clock
            if over:
                one[3] = NONE
                settled.append((url, one[1] if one[0] == NONE else one[0]))
        state.update((write_page(urls),))
        due = min((one[3] for one in urls.values() if one[3] != NONE), default=None)
        if due is not None:
            state.setTimeoutTimestamp(due)
        if settled:
            yield pd.DataFrame(settled, columns=out.names)

    settled = read.groupBy("page").applyInPandasWithState(work, out, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    place = F.when(F.col("place") != NONE, F.col("place"))
    return settled.select("url", status_at(place).alias("fetch_status"))
