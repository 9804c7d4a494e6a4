"""Scalar functions on edge vectors, against short Python statements."""

import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from factloom.functions import sections as S, text as X, urls as U

SPACES = ["\xa0", " ", " ", "　", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", " ", " ", " ", "\t", "\n", "\r"]
EDGE = [
    "", " ", "a", " a ", "a b", "a  b", "\n\na\t b\r\n", "a\xa0b", "​a​", " a　 b", *(f"x{s}y" for s in SPACES),
    *(f"{s}x{s}{s}y {s}" for s in SPACES), "a\x00b", "😀  😀", "᠎a",
]


def test_clean_matches_python(column):
    assert column(X.clean, EDGE) == [re.sub(r"\s+", " ", v).strip() for v in EDGE]


def test_strip_matches_python(column):
    assert column(X.strip, EDGE) == [v.strip() for v in EDGE]


def test_clean_on_random_text(column):
    alphabet = st.sampled_from("ab. \n" + "".join(SPACES) + "​\x00é")
    samples = []

    @settings(max_examples=300, database=None, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.text(alphabet, max_size=30))
    def gather(value):
        samples.append(value)

    gather()
    assert column(X.clean, samples) == [" ".join(v.split()) for v in samples]
    assert column(X.strip, samples) == [v.strip() for v in samples]


BRACKET_LABEL = [
    ("[SALAH] judul", "SALAH"), ("［SALAH］ x", "SALAH"), ("【 HOAKS 】", "HOAKS"), ("［A】", "A"),
    ("tanpa", ""), ("[] [B]", "B"), ("[ ] [B]", ""), ("[[A]", "[A"), ("x [A\nB] y", "A\nB"), ("[\xa0A\xa0]", "A"),
]


def test_bracket_label(column):
    titles, labels = zip(*BRACKET_LABEL)
    assert column(S.bracket_label, titles) == list(labels)


def test_first_label(spark):
    rows = spark.createDataFrame([(["a", "[ ]", "[B]", "[C]"],), ([],), (None,)], "t array<string>")
    assert [r.l for r in rows.select(S.first_label(F.col("t")).alias("l")).collect()] == ["B", "", ""]


SECTIONS = [
    ("Narasi\nsatu\ndua\nPenjelasan\nx\nKesimpulan\ny\nReferensi\n", "satu dua", "y"),
    ("NARASI \t\n a\n   penjelasan b\n", "a", ""),
    ("Narasi\nsatu\n", "", ""),
    ("Narasi satu\nPenjelasan\n", "", ""),
    ("Narasi\nPenjelasan\nx\nKesimpulan\nz\nHasil Periksa fakta", "Penjelasan x", "z"),
    ("Narasi\n\n\nPenjelasan\nx", "", ""),
    ("ini narasi\n\xa0isi\xa0\n\xa0Hasil Periksa", "isi", ""),
    ("Kesimpulan\r\nisi\r\n\r\n Referensi\r\n", "", "isi"),
    ("x Kesimpulan\na\nb hasil\nHasil  Periksa\nReferensi", "", "a b hasil Hasil Periksa"),
]


def sections_of(text):
    lines = S.line_list(text)
    return S.all_sections(lines, S.label_lines(lines))


def test_sections(column):
    texts, narasi, kesimpulan = zip(*SECTIONS)
    assert column(lambda c: sections_of(c)["narasi"], texts) == list(narasi)
    assert column(lambda c: sections_of(c)["kesimpulan"], texts) == list(kesimpulan)


def test_sections_match_a_search_with_lookahead(column):
    """The pattern with a consumed end label finds what a lookahead finds."""
    parts = st.sampled_from(["Narasi", "narasi", "Penjelasan", "Hasil Periksa", "x", "y z", "\n", "\n\n", " ", "\n ", "\xa0"])
    samples = []

    @settings(max_examples=400, database=None, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(parts, max_size=14))
    def gather(value):
        samples.append("".join(value))

    gather()
    opens, closes = S.SECTION_LABELS["narasi"]
    look = re.compile(rf"(?is)(?:{'|'.join(opens)})\s*\n(.*?)(?=\n\s*(?:{'|'.join(closes)}))")
    expected = [" ".join(m.group(1).split()) if (m := look.search(v)) else "" for v in samples]
    assert column(lambda c: S.section(S.line_list(c), S.label_lines(S.line_list(c)), opens, closes), samples) == expected


VERDICT_AND_SOURCE = [
    ("Salah Sumber: https://a.b/c", "Salah", "https://a.b/c"),
    ("Salah", "Salah", ""),
    ("Benar SUMBER - http://x y", "Benar", "http://x"),
    ("a sumber https://one sumber https://two", "a", "https://one"),
    ("sumber ftp://x", "sumber ftp://x", ""),
    ("Sumber:https://a.).", "", "https://a.)."),
    ("😀 Salah sumberHTTPS://X", "😀 Salah", "HTTPS://X"),
]


def test_verdict_and_source(column):
    blocks, verdicts, links = zip(*VERDICT_AND_SOURCE)
    assert column(S.verdict, blocks) == list(verdicts)
    assert column(S.source_link, blocks) == list(links)


REFERENCES = [
    ("Referensi\nhttps://a/).\nhttp://b c\nArtikel terbaru\nhttps://late", ["https://a/).", "http://b"]),
    ("Referensi https://a", []),
    ("referensi\n\nhttps://a\naffiliation\nhttps://b", ["https://a"]),
    ("Referensi\nhttps://a\n Tautan Cepat\nHTTPS://b https://c", ["https://a", "https://c"]),
    ("Referensi\nx\n", []),
    ("", []),
]


def test_references(column):
    texts, urls = zip(*REFERENCES)
    assert column(S.reference_urls, texts) == list(urls)


DOMAIN = [
    ("https://www.Kompas.com/a", "kompas.com"), ("http://A.B:80/x", "a.b:80"), ("HTTPS://a.b", ""),
    ("https://a.b?q=1", "a.b?q=1"), ("see https://a.b/c", "a.b"), ("https://web.archive.org/web/1/https://x.y", "web.archive.org"),
    ("https://www.www.a/", "www.a"), ("https://www./", "www."), ("", ""), ("https://", ""),
]


def test_domain(column):
    urls, hosts = zip(*DOMAIN)
    assert column(U.domain, urls) == list(hosts)


def test_content_type(column):
    rules = U.DomainRules(own=["own.example"])
    cases = {
        None: "empty", "": "empty", "nan": "empty", "ftp://x": "empty", " https://x.com/a": "social_media",
        "https://www.threads.com/a": "social_media", "https://money.kompas.com/": "news_site",
        "https://archive.ph/1": "archive", "https://own.example/1": "skip", "https://hivemoderation.com": "skip",
        "http://m.facebook.com": "news_site", "httpx": "news_site", "https://x.com:443/": "news_site",
    }
    assert column(lambda c: U.content_type(c, rules), list(cases)) == list(cases.values())


def test_urls(column):
    assert column(lambda c: U.absolute_url(c, "https://s"), ["/a", "http://b", "httpfoo"]) == ["https://s/a", "http://b", "httpfoo"]
    links = ["/articles/12-a", "/articles/12-", "/articles/-a", "/articles/x", "https://s/articles/1-b?c", "/articles/1-\n", None]
    assert column(U.is_article_link, links) == [True, False, False, False, True, False, False]
    assert column(U.article_number, ["/articles/12-a", "x", "/articles/99999999999999999999-a"]) == [12, None, None]


def test_redirect(column):
    def expected(v):
        return len(v) < 500 and any(m in v.lower().strip()[:300] for m in X.REDIRECT_MARKERS)

    cases = [
        "", "Please wait", "x" * 490 + "loading", "loading" + "x" * 492, "loading" + "x" * 493, "x" * 292 + " loading",
        "x" * 293 + " loading", "DOWNLOADING", " " * 100 + "just a moment", "please  wait", "😀" * 490 + "x",
    ]
    assert column(X.is_js_redirect, cases) == [expected(c) for c in cases]


def test_paywall(column):
    wall = "Silakan login " + "x" * 86
    assert len(wall) == 100
    cases = {
        wall + ". Isi berita.": "Isi berita.", wall + "abc! ñlan? Être ici. ": "ñlan? Être ici.", wall + "abc! elan? Être ici. ": "Être ici.",
        wall[:-1] + ". Isi kedua. Isi ketiga": "Isi ketiga", wall + ". isi kecil": wall + ". isi kecil",
        "x " + wall + ". Isi": "x " + wall + ". Isi", "SUBSCRIBE TO READ" + "y" * 90 + "!\n\nBaru\nya": "Baru\nya", "": "",
        wall + ".Isi": wall + ".Isi",
    }
    assert column(X.strip_paywall, list(cases)) == list(cases.values())


def test_dates(column):
    cases = ["terbit 31/12/2025, 01/01/2026", "1/2/2025", "x99/99/9999", "112/01/20261", ""]
    assert column(S.first_date, cases) == ["31/12/2025", "", "99/99/9999", "12/01/2026", ""]
    assert [str(d) for d in column(S.typed_date, ["31/12/2025", "99/99/9999", "", None])] == ["2025-12-31", "None", "None", "None"]


def test_lists(column):
    assert column(S.split_list, ["a | b||  | c ", " | ", "", None]) == [["a", "b", "c"], [], [], None]
    assert column(lambda c: S.join_list(S.split_list(c)), ["a|b"]) == ["a | b"]


def test_long_texts_take_linear_time(column):
    """Repeated labels without an end, long runs and many nodes, whole texts."""
    import time

    texts = [
        "Penjelasan\n" + "Narasi\n" * 200_000,
        "Narasi\n" + "kata " * 400_000 + "\nPenjelasan " + "x" * 1_000_000,
        " " * 500_000 + "x" + "\n" * 500_000,
    ]
    start = time.time()
    got = column(lambda c: sections_of(c)["narasi"], texts)
    assert got == ["", ("kata " * 400_000).strip(), ""]
    assert column(X.strip, texts[2:]) == ["x"] and column(X.clean, texts[2:]) == ["x"]
    assert time.time() - start < 60
