"""URL building and domain routing."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from .text import blank_to_null, null_to_blank, strip

# --- fixed values -----------------------------------------------------------
SOCIAL_DOMAINS = [
    "web.facebook.com", "facebook.com",
    "tiktok.com", "vt.tiktok.com",
    "instagram.com",
    "x.com", "twitter.com",
    "threads.com", "www.threads.com",
    "youtube.com", "youtu.be",
    "linkedin.com",
]

ARCHIVE_DOMAINS = [
    "archive.ph", "archive.today", "archive.md",
    "archive.org", "web.archive.org",
    "arsip.cekfakta.com", "webarchive.io",
    "ibb.co", "ibb.co.com",
]

# The site whose articles are processed is skipped as well, see DomainRules.
SKIP_DOMAINS = [
    "hivemoderation.com",
    "magma.esdm.go.id",
    "geologi.esdm.go.id",
]

ARTICLE_LINK = r"/articles/\p{Nd}+-[^\n]"
ARTICLE_NUMBER = r"/articles/([0-9]+)-"
# --- end of fixed values ----------------------------------------------------

PRIORITY = ["skip", "social_media", "archive"]
NOT_FETCHED = ["empty", "skip"]


@dataclass(frozen=True)
class DomainRules:
    """Exact host sets.  ``own`` holds the hosts of the processed site itself,
    whose links are never followed."""

    social: list[str] = field(default_factory=lambda: list(SOCIAL_DOMAINS))
    archive: list[str] = field(default_factory=lambda: list(ARCHIVE_DOMAINS))
    skip: list[str] = field(default_factory=lambda: list(SKIP_DOMAINS))
    own: list[str] = field(default_factory=list)

    def by_type(self) -> dict[str, list[str]]:
        return {
            "skip": self.skip + self.own,
            "social_media": self.social,
            "archive": self.archive,
        }

    def rows(self) -> list[tuple[str, str, int]]:
        """The same rules as (domain, content_type, priority) rows."""
        return [
            (domain, content_type, priority)
            for priority, content_type in enumerate(PRIORITY)
            for domain in self.by_type()[content_type]
        ]


def domain(url: Column) -> Column:
    """Host (with any port) after the first http(s)://, without www., lower."""
    return F.lower(F.regexp_extract(url, r"https?://(?:www\.)?([^/]+)", 1))


def is_url(url: Column) -> Column:
    return F.coalesce(strip(url).startswith("http"), F.lit(False))


def content_type(url: Column, rules: DomainRules | None = None) -> Column:
    """Route a URL by its exact host; the sets are literals, so no join runs."""
    host = null_to_blank(domain(url))
    routed = F.when(~is_url(url), "empty")
    for name, hosts in (rules or DomainRules()).by_type().items():
        routed = routed.when(host.isin(hosts), name)
    return routed.otherwise("news_site")


def is_fetched(content_type: Column) -> Column:
    return ~content_type.isin(NOT_FETCHED)


def absolute_url(href: Column, base_url: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base_url), href))


def list_page_url(base_url: str, page: Column) -> Column:
    return F.concat(F.lit(f"{base_url}?page="), page.cast("string"))


def is_article_link(href: Column) -> Column:
    return F.coalesce(href.rlike(ARTICLE_LINK), F.lit(False))


def article_number(url: Column) -> Column:
    """Stable article key: the number in its address, null when it has none."""
    return blank_to_null(F.regexp_extract(url, ARTICLE_NUMBER, 1)).try_cast("bigint")
