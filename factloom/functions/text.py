"""Whitespace, length and boilerplate rules as Column expressions.

``SPACE`` spells out the Unicode white space that ``str.isspace`` accepts; the
JVM's own ``\\s`` and ``trim`` each cover a smaller set.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

SPACE = r" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\p{Z}"
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())  # the same set as characters

# --- fixed values -----------------------------------------------------------
# A short page that shows one of these is a script-driven waiting page.
REDIRECT_MARKERS = [
    "please wait",
    "redirecting",
    "just a moment",
    "enable javascript",
    "checking your browser",
    "loading",
]

# Login-wall and paywall openings.
PAYWALL_PREFIXES = [
    "peringatan! materi khusus dewasa",
    "konten ini merupakan konten dewasa",
    "login gabung kompas.com+",
    "konten yang disimpan",
    "masuk untuk melanjutkan",
    "silakan login",
    "daftar sekarang",
    "langganan untuk membaca",
    "subscribe to read",
    "please log in",
    "please sign in",
]

REDIRECT_MAX_LENGTH = 500
REDIRECT_SAMPLE = 300
PAYWALL_SKIP = 100
# --- end of fixed values ----------------------------------------------------


def strip(c: Column) -> Column:
    """Drop white space at both ends, one linear pass."""
    return F.regexp_replace(c, rf"^[{SPACE}]+|(?<![{SPACE}])[{SPACE}]+\z", "")


def collapse(c: Column, also: str = "") -> Column:
    """Runs of white space (and of ``also``) become one blank, ends trimmed.

    Single blanks already are what they should be and are not matched, which
    leaves ordinary prose untouched.
    """
    run = f"{SPACE}{also}"
    return F.trim(F.regexp_replace(c, rf"[{run}]{{2,}}|[{run}&&[^ ]]", " "))


def clean(c: Column) -> Column:
    """Collapse every run of white space to one blank and trim."""
    return collapse(c)


def lower_text(c: Column) -> Column:
    """Lower-cased string form of any column (booleans become true/false)."""
    return F.lower(c.cast("string"))


def preview(c: Column, chars: int) -> Column:
    return F.substring(c, 1, chars)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def any_of(c: Column, needles: list[str]) -> Column:
    """True where the column contains at least one needle."""
    return c.rlike("|".join(map(re.escape, needles)))


def starts_with_any(c: Column, prefixes: list[str]) -> Column:
    """Case-insensitive prefix test that lower-cases the opening only, once."""
    opening = F.lower(F.substring(c, 1, max(map(len, prefixes))))
    return opening.rlike("^(?:" + "|".join(map(re.escape, prefixes)) + ")")


def is_js_redirect(c: Column, markers: list[str] | None = None) -> Column:
    """Short text whose opening shows a waiting-page phrase."""
    opening = F.substring(strip(F.lower(c)), 1, REDIRECT_SAMPLE)
    return F.coalesce(
        (F.length(c) < REDIRECT_MAX_LENGTH) & any_of(opening, markers or REDIRECT_MARKERS),
        F.lit(False),
    )


def strip_paywall(c: Column, prefixes: list[str] | None = None) -> Column:
    """Cut a login-wall opening, up to the first sentence after 100 characters.

    The sentence is the first capital that follows end punctuation and white
    space; without one the text stays whole.
    """
    walled = starts_with_any(c, prefixes or PAYWALL_PREFIXES)
    sentence = F.regexp_extract(
        F.substr(c, F.lit(PAYWALL_SKIP + 1)),
        rf"(?s)[.!?][{SPACE}]+([A-Z\x{{c0}}-\x{{24f}}].*)", 1,
    )
    return F.when(walled, F.coalesce(blank_to_null(strip(sentence)), c)).otherwise(c)
