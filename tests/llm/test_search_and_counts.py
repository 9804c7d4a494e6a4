"""Alignment, exact top-k search and collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from factloom.llm import alignment, collocations, top_products

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "Hello  world", "Hello  world", "two  spaces\tand\ttabs\n\nlines", "<|endoftext|> <s> <unk> <0x41>", "naïve café ÀÉ ß 東京 🙂🙂",
    "under▁score", "x" * 3000, "word " * 400, "ﬁ ligature ½", "1234567890 3.14", "\u00a0nbsp\u200bzero", "it's we'll I'd", "\r\n \x00 \x1c",
]


def aligned(texts):
    """Rows by plain loops over byte ranges."""
    a_model, b_model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    byte_of = {chr(b) if b in kept else chr(next(others)): b for b in range(256)}
    rows, links = [], []
    for text in texts:
        a = a_model.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_model.encode(text or "")
        a_bytes = [bytes(byte_of[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_ends, b_ends = (np.cumsum([len(x) for x in t]).tolist() for t in (a_bytes, b_bytes))
        groups, i, j = [], 0, 0
        for end in sorted({*a_ends} & {*b_ends}):
            parts = []
            for ids, ends, k in ((a, a_ends, i), (b, b_ends, j)):
                stop = ends.index(end) + 1
                parts.append((",".join(map(str, ids[k:stop])), stop))
            groups.append("|".join(p[0] for p in parts))
            i, j = parts[0][1], parts[1][1]
        spans = [[(e - len(x), e) for x, e in zip(t, ends)] for t, ends in ((a_bytes, a_ends), (b_bytes, b_ends))]
        links.append([(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e])
        rows.append([len(a), len(b), len(groups), len(links[-1]), ";".join(groups)])
    counts = Counter(pair for one in links for pair in set(one))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (*row[:4], sum(counts[p] == best[p[0]] for p in one), sum(counts[p] for p in one), row[4]) for row, one in zip(rows, links)
    ]


def test_alignment_equals_byte_ranges(spark, monkeypatch):
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choice(TEXTS[4:9] + ["the", "of", "Entwicklung"]) for _ in range(rng.randrange(30))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 AS n_a", "'x' AS groups", "2 AS part", "3 AS place").repartition(3)
    got = alignment.align(rows, A, B).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == aligned(texts)


def test_alignment_of_empty_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert alignment.align(spark.createDataFrame([], schema), A, B).count() == 0
    got = alignment.align(spark.createDataFrame([(None, "same words"), (1, "same words"), (1, "same words")], schema), A, B).collect()
    assert [r.doc_id for r in sorted(got, key=str)] == [1, 1, None] and {r.count_sum for r in got} == {3 * got[0].n_links}


@pytest.mark.parametrize("n, m", [(0, 0), (1, 1), (1, 50), (50, 1), (300, 40), (40, 300), (500, 500)])
def test_gallop_equals_searchsorted(n, m):
    rng = np.random.default_rng(n + m)
    short, long = (np.sort(rng.choice(2000, x, replace=False)) for x in (n, m))
    rank, meets = alignment.gallop(short, long)
    assert (rank == np.searchsorted(long, short)).all() and (meets == np.isin(short, long)).all()


def products(rows, queries, k):
    whole = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows]
    out = []
    for q, x in sorted({(i, tuple(v)) for i, v in whole if i in queries}):
        scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in whole if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("rows_per_shard, block", [(16_384, 512), (37, 5)])
def test_top_products_equal_brute_force(spark, monkeypatch, rows_per_shard, block):
    monkeypatch.setattr(top_products, "ROWS_PER_SHARD", rows_per_shard)
    monkeypatch.setattr(top_products, "QUERIES_PER_BLOCK", block)
    rng = np.random.default_rng(1)
    data = rng.standard_normal((300, 12)) * (rng.random((300, 12)) < 0.4)
    data[100:200] = data[100]  # a third are equal
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(data)] + [(7, [0.5] * 12), (7, [0.5] * 12)]
    odd = [(1000, None), (1050, [float("nan")] + [1.0] * 11), (1100, [None] + [1.0] * 11), (1150, [float("inf")] + [0.0] * 11), (None, [1.0] * 12), (1200, [])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS score", "0 AS rank", "1 AS ids").repartition(3)
    got = top_products.nearest(table, table.where("vec_id % 10 = 0"))
    assert sorted(tuple(r) for r in got.collect()) == products(rows, {i for i in range(0, 300, 10)}, 5)


def test_top_products_of_few_negative_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [-0.5, 3.0])]
    table = spark.createDataFrame(rows, schema)
    assert sorted(tuple(r) for r in top_products.nearest(table, table).collect()) == products(rows, {0, 1, 2}, 5)
    empty = spark.createDataFrame([], schema)
    assert top_products.nearest(empty, empty).count() == 0
    huge = spark.createDataFrame([(0, [3e38]), (1, [1.0])], schema)
    with pytest.raises(ArithmeticError):
        top_products.nearest(huge, huge)


def test_bounds_prune_rows():
    """Fewer rows are probed than there are: the lists left out hold no best row."""
    rng = np.random.default_rng(2)
    values = (rng.standard_normal((4000, 16)) * rng.pareto(1.2, (4000, 16)) * 50).astype(np.int64)
    shard = top_products.Shard(np.arange(4000), values)
    for own in range(20):
        ids, scores = shard.top(own, values[own], 5)
        every = np.array([-(10**18) if i == own else s for i, s in enumerate(values @ values[own])])
        order = np.lexsort((np.arange(4000), -every))[:5]
        assert (ids == order).all() and (scores == every[order]).all()


def phrases(rows, least, share, top):
    """All counts in full, then scores, drops and ranks."""
    n, counts, out = Counter(), defaultdict(Counter), []
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate({i: i + 32 for i in range(65, 91)})):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, 6):
                counts[lang or "und"].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    for lang, count in counts.items():
        scored = []
        able = {p: a for p, a in count.items() if a >= least and len(p) > 1}
        gone = {p[i:i + m] for p, f in able.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * f >= share * count[p[i:i + m]]}
        for p, a in able.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def corpus():
    rng = random.Random(9)
    common = ["the", "of", "and", "a"]
    rare = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        words = []
        while len(words) < 40:
            words += rng.choice([[rng.choice(common)], [rng.choice(rare)], ["New", "york", "City"], ["rerum", "of", "causas"], ["echo"] * rng.randrange(1, 6), ["x,", "y"], ["é\t", "Zz."]])
        rows.append((rng.choice(["en", "en", "fr", None]), " ".join(words)))
    return rows + [("en", None), ("en", ""), ("fr", " \t.,"), ("de", "once only"), ("en", "long " * 300), ("en", "a.b!c\nd e")]


@pytest.mark.parametrize("least, share, top, wave", [(5, 100, 2000, 4000), (5, 100, 15, 3), (4, 80, 40, 1), (12, 100, 3, 2)])
def test_collocations_equal_full_counts(spark, monkeypatch, least, share, top, wave):
    monkeypatch.setattr(collocations, "GROWTH", 2)
    monkeypatch.setattr(collocations, "TEXT_BYTES", 50)
    rows = corpus()
    table = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS f", "'x' AS phrase", "2 AS part").repartition(3)
    got = collocations.collocations(table, least=least, share=share, top=top, wave=wave)
    assert sorted(tuple(r) for r in got.collect()) == phrases(rows, least, share, top)


def test_collocations_count_parts_over_three_words_that_are_not_taken(spark):
    rows = [("en", f"t x y z{end}") for end in [" u"] * 6 + [""] * 6] + [("fr", f"{start}x y z t") for start in ["u "] * 6 + [""] * 6]
    rows += [(lang, "u. " * 10 + "x. y. z. " * 100) for lang in ("en", "fr")]
    want = phrases(rows, 5, 100, 1)
    assert [r[2:6] for r in want] == [("t x y z u", 6, 12, 16), ("u x y z t", 6, 16, 12)]
    table = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    got = collocations.collocations(table, least=5, top=1, wave=2)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_keys_are_numbered_without_a_join(spark):
    rows = [(p, "ab"[i % 2], f"w{i}", 1 + i) for p in range(5) for i in range(p, 12)]
    table = spark.createDataFrame(rows, "part long, lang string, word string, counts long").repartition(4)
    hits = collocations.with_total(table, 20, "lang", "word")
    assert "Join" not in hits._jdf.queryExecution().optimizedPlan().toString()
    totals = Counter()
    for _, lang, word, n in rows:
        totals[lang, word] += n
    want = {k: n for k, n in totals.items() if n >= 20}
    hits = hits.collect()
    assert {(r.lang, r.word): r.f for r in hits} == want and len(hits) == sum((r[1], r[2]) in want for r in rows)
    assert len({r.gid for r in hits}) == len({(r.lang, r.word, r.gid) for r in hits}) == len(want)
    assert sorted((r.lang, r.word) for r in hits if r.row == r.gid) == sorted(want)
