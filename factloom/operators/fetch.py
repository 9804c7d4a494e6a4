"""Fetch-attempt log -> one final status per URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import SCRAPE_STATUSES

# --- fixed values -----------------------------------------------------------
BLOCKED_CODES = [401, 403]
# --- end of fixed values ----------------------------------------------------

CODES = 1000  # an attempt and its status as one number: attempt * CODES + status


def _code(status: str) -> Column:
    return F.lit(SCRAPE_STATUSES.index(status))


def attempt_status(outcome: Column, http_status: Column, is_archive: Column) -> Column:
    """Status an attempt stands for, as its position in ``SCRAPE_STATUSES``."""
    refused = F.when(is_archive, _code("archive_blocked"))
    http = (
        F.when(http_status.isin(BLOCKED_CODES), refused.otherwise(_code("blocked")))
        .when(http_status == 404, _code("404"))
        .when(http_status >= 400, _code("error"))
        .otherwise(_code("ok"))
    )
    return (
        F.when(outcome == "http", http)
        .when(outcome == "redirects", _code("blocked"))
        .when(outcome == "timeout", _code("timeout"))
        .when(outcome == "conn", refused.otherwise(_code("error")))
        .otherwise(_code("error"))
    )


def is_final(outcome: Column) -> Column:
    """Attempts with an HTTP answer or a redirect loop are not repeated."""
    return outcome.isin("http", "redirects")


def _in_bound(max_attempts: int | None) -> Column:
    return F.lit(True) if max_attempts is None else F.col("attempt") <= max_attempts


def places(attempts: DataFrame, max_attempts: int | None = None, *carry: str) -> DataFrame:
    """(url, place, final): attempt and status as one number, null where the attempt does not count."""
    code = attempt_status(F.col("outcome"), F.col("http_status"), F.col("is_archive"))
    place = F.when(_in_bound(max_attempts), F.col("attempt").cast("bigint") * CODES + code)
    return attempts.select("url", place.alias("place"), is_final(F.col("outcome")).alias("final"), *carry)


def status_at(place: Column) -> Column:
    """Status that a place stands for; none is an error."""
    names = F.array(*[F.lit(s) for s in SCRAPE_STATUSES])
    return F.coalesce(F.get(names, F.pmod(place, F.lit(CODES)).cast("int")), F.lit("error"))


def fetch_status(attempts: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """(url, fetch_status): the first final attempt, else the last one.

    Several logs of one URL may share attempt numbers; equal ones are settled by the
    status alone, so the order of rows never matters.  With ``max_attempts`` later
    attempts do not count, and a URL that has no other is an error.  The aggregation
    buffers are integers, so a URL with many log rows shrinks before the shuffle.
    """
    return places(attempts, max_attempts).groupBy("url").agg(
        F.coalesce(F.min(F.when(F.col("final"), F.col("place"))), F.max("place")).alias("place")
    ).select("url", status_at(F.col("place")).alias("fetch_status"))


def page_availability(attempts: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """(url, available) under the simpler article-page rule: every failure is
    repeated, so one successful attempt is enough."""
    success = (F.col("outcome") == "http") & (F.col("http_status") < 400) & _in_bound(max_attempts)
    return attempts.groupBy("url").agg(F.coalesce(F.bool_or(success), F.lit(False)).alias("available"))


def unavailable(attempts: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """``url`` of every page that the log tried and never got."""
    return page_availability(attempts, max_attempts).where(~F.col("available")).select("url")


def page_states(known: DataFrame, attempts: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """(url, page_id, state) of every URL that the snapshot or the log knows.

    ``known`` is unique on ``url``.  A page that the log never got is ``unavailable``, also
    where the snapshot has one; else it is ``present`` with a snapshot page and ``absent``
    without one.  Only present pages keep their ``page_id``.
    """
    tried = page_availability(attempts, max_attempts)
    state = (
        F.when(~F.coalesce("available", F.lit(True)), "unavailable")
        .when(F.col("page_id").isNotNull(), "present").otherwise("absent")
    )
    joined = known.select("url", "page_id").join(tried, "url", "full").withColumn("state", state)
    return joined.select("url", F.when(F.col("state") == "present", F.col("page_id")).alias("page_id"), "state")
