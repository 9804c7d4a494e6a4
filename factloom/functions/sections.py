"""Label, section, verdict, reference and date extraction from flat text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .text import SPACE, SPACES, blank_to_null, clean, strip

# --- fixed values -----------------------------------------------------------
# Section -> (labels that open it, labels that close it).
SECTION_LABELS = {
    "narasi": (
        ["Narasi"],
        ["Penjelasan", "Kesimpulan", "Hasil Periksa"],
    ),
    "penjelasan": (
        ["Penjelasan"],
        ["Kesimpulan", "Hasil Periksa"],
    ),
    "kesimpulan": (
        ["Kesimpulan"],
        ["Hasil Periksa fakta", "Hasil Periksa Fakta", "Hasil Periksa", "Referensi"],
    ),
    "hasil": (
        ["Hasil Periksa fakta", "Hasil Periksa Fakta", "Hasil Periksa"],
        ["Referensi", "Artikel terbaru", "Affiliation"],
    ),
}
REFERENCE_LABEL = "Referensi"
REFERENCE_ENDS = ["Artikel terbaru", "Affiliat", "Tautan Cepat"]
SOURCE_LABEL = "sumber"
WIDE_BRACKETS = ("［］【】", "[][]")
LIST_SEPARATOR = " | "
# --- end of fixed values ----------------------------------------------------

DATE_PATTERN = r"\p{Nd}{2}/\p{Nd}{2}/\p{Nd}{4}"
URL_PATTERN = rf"https?://[^{SPACE}]+"


def _any_label(labels: list[str]) -> str:
    """Alternation of labels; the patterns using it ignore case."""
    distinct = {label.lower(): label for label in labels}
    return "(?:" + "|".join(map(re.escape, distinct.values())) + ")"


def bracket_label(title: Column) -> Column:
    """Text inside the first non-empty pair of (normal or wide) brackets."""
    plain = F.translate(title, *WIDE_BRACKETS)
    return strip(F.regexp_extract(plain, r"\[([^\]]+)\]", 1))


def line_list(text: Column) -> Column:
    """Lines of a text without white space around them; blank ones are left out."""
    lines = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)))
    return F.filter(lines, lambda line: line != "")


def _starts(line: Column, labels: list[str]) -> Column:
    """The line starts with a label; only its first characters are looked at."""
    return F.substring(line, 1, max(map(len, labels))).rlike(rf"(?iu)\A{_any_label(labels)}")


def _ends(line: Column, labels: list[str]) -> Column:
    return F.right(line, F.lit(max(map(len, labels)))).rlike(rf"(?iu){_any_label(labels)}\z")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` reads it in a loop."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def label_lines(lines: Column, sections: dict = SECTION_LABELS) -> Column:
    """Places, from 1, of the few lines that can open or close a section."""
    opens = [label for labels, _ in sections.values() for label in labels]
    closes = [label for _, labels in sections.values() for label in labels]
    found = F.transform(lines, lambda line, i: F.when(_starts(line, closes) | _ends(line, opens), i + 1))
    return F.array_compact(found)


def section(lines: Column, places: Column, opens: list[str], closes: list[str]) -> Column:
    """Text between a line that ends in an opening label and the next line that
    starts with a closing label; empty when either is missing.

    ``lines`` is a ``line_list`` and ``places`` its ``label_lines``.  At least one line
    lies between the two labels, so an empty section runs on into the next one.
    """
    def body(lines: Column, places: Column) -> Column:
        def line(at: Column) -> Column:
            return F.get(lines, at - 1)

        return _let(F.filter(places, lambda at: _starts(line(at), closes)), lambda closing: _let(
            F.array_max(closing), lambda last: _let(
                F.array_min(F.filter(places, lambda at: (at + 2 <= last) & _ends(line(at), opens))),
                lambda start: _let(
                    F.array_min(F.filter(closing, lambda at: at >= start + 2)),
                    lambda end: F.array_join(F.slice(lines, start + 1, end - start - 1), " "),
                ),
            ),
        ))

    found = _let(lines, lambda own: _let(places, lambda few: body(own, few)))
    return clean(F.when(places.isNotNull(), F.coalesce(found, F.lit(""))))


def all_sections(lines: Column, places: Column) -> dict[str, Column]:
    return {name: section(lines, places, *labels) for name, labels in SECTION_LABELS.items()}


_SOURCE = rf"{SOURCE_LABEL}[{SPACE}]*[:\-]?[{SPACE}]*(https?://[^{SPACE}]+)"


def source_link(verdict_block: Column) -> Column:
    """URL after the source label of a verdict block, else empty."""
    return F.regexp_extract(verdict_block, rf"(?iu){_SOURCE}", 1)


def verdict(verdict_block: Column) -> Column:
    """The verdict block without its source label and URL."""
    before = F.regexp_extract(verdict_block, rf"(?isu)\A(.*?){_SOURCE}", 1)
    return F.when(source_link(verdict_block) != "", clean(before)).otherwise(verdict_block)


def reference_block(text: Column) -> Column:
    ends = "|".join("\\n" + re.escape(end) for end in REFERENCE_ENDS)
    return F.regexp_extract(
        text, rf"(?isu){REFERENCE_LABEL}(?>[{SPACE}]*\n)(.*?)(?:{ends}|\z)", 1
    )


def reference_urls(text: Column) -> Column:
    """All URLs listed below the reference label, in order, as an array."""
    return F.regexp_extract_all(reference_block(text), F.lit(f"({URL_PATTERN})"), 1)


def join_list(urls: Column) -> Column:
    return F.array_join(urls, LIST_SEPARATOR)


def split_list(joined: Column) -> Column:
    """Parts of a joined list, stripped, blanks dropped."""
    parts = F.transform(F.split(joined, r"\|"), strip)
    return F.filter(parts, lambda part: part != "")


def first_date(text: Column) -> Column:
    """First dd/mm/yyyy shaped run, not validated; empty when absent."""
    return F.regexp_extract(text, DATE_PATTERN, 0)


def typed_date(text: Column) -> Column:
    """The same value as a real date, null where it is none."""
    return F.try_to_date(blank_to_null(text), "dd/MM/yyyy")


def first_label(titles: Column) -> Column:
    """First non-empty bracket label over an array of titles."""
    labels = F.filter(F.transform(titles, bracket_label), lambda label: label != "")
    return F.coalesce(F.get(labels, F.lit(0)), F.lit(""))
