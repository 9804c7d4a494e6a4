"""The corpus pipeline at the smallest scale: each stage against its own brute force."""

import hashlib

import pytest

import corpus_pipeline
from factloom.llm import oracles, queries
from suite.check import compare, connect

SF = "/root/testdata/sf0.001"


def test_every_query_returns_a_row_for_each_of_its_rows(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_simhash", "op2_quality", "op3_decontamination", "op5_substrings", "op7_tokens", "op10_licences"):
        assert queries.QUERIES[name](spark, SF).count() == n, name


def test_pipeline_stages(spark):
    before = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = before.columns, None
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and ids, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns, name
            before, texts = after, {r.doc_id: r.text for r in after.collect()}
        else:
            assert {r.doc_id: r.decoded_sha256 for r in after.collect()} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in texts.items()}


def test_run_has_the_rows_of_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


def test_queries_are_registered():
    import __spark_entry__ as driver

    assert {*queries.QUERIES, "pipeline"} <= set(driver.queries()) and set(oracles.ORACLES) <= set(driver.oracle_sql())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), oracles.ORACLES[name]) == ""


def test_near_dedup_finds_five_word_similarity(spark):
    import random

    rng = random.Random(4)

    def changed(words, n):
        return [w if i % (len(words) // n) != 9 else f"x{i}" for i, w in enumerate(words)]

    def sets(text):
        words = text.split()
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    texts = []
    for group in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(400)]
        texts += [words, changed(words, 8), changed(words, 16)]
    texts = [" ".join(t) for t in texts]
    like = [[len(sets(a) & sets(b)) / len(sets(a) | sets(b)) for b in texts] for a in texts]
    assert all(0.8 <= like[i][i + 1] < 0.9 and like[i][i + 2] < 0.8 for i in range(0, 36, 3))
    parent = list(range(len(texts)))
    for _ in range(4):  # smallest labels travel along the links of a group of three
        parent = [min(parent[j] for j in range(len(texts)) if like[i][j] >= 0.8) for i in range(len(texts))]
    rows = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate([*texts, None, ""])], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, rows, SF).collect()}
    assert kept == {p for i, p in enumerate(parent) if p == i} | {36}


def test_similar_links_connect_a_bucket_beyond_its_smallest_node(spark):
    from factloom.llm import similar

    base = [f"w{i}" for i in range(300)]
    far = [w if i % 20 else f"y{i}" for i, w in enumerate(base)]  # in buckets of base, below 0.8
    texts = [base, far, far[:-3] + ["q", "r", "s"], far[:-2] + ["t", "u"], base[:-1] + ["z"]]
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {(r.a, r.b) for r in similar.similar_links(rows).collect()}
    assert (0, 4) in found and all(a in (0, 4) and b in (0, 4) or a not in (0, 4) and b not in (0, 4) for a, b in found)
    assert {n for pair in found for n in pair} == set(range(5))


def test_similar_links_of_a_template_compare_few_pairs(spark, monkeypatch):
    import random

    from factloom.llm import similar

    rng, base = random.Random(7), [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(150):  # most pairs lie between 0.55 and 0.8
        places = rng.sample(range(150), rng.choice((1, 2, 3, 4, 4, 5, 5, 6)))
        texts.append(" ".join(f"{w}x{rng.randrange(40)}" if i in places else w for i, w in enumerate(base)))
    texts += [texts[9].upper(), texts[9] + " end", " ".join(base[:9]), None]
    rows = [(i // 2 if i < 4 else i, t) for i, t in enumerate(texts)]  # two ids have two texts each
    compared, confirmed = [], similar.confirmed
    monkeypatch.setattr(similar, "confirmed", lambda pairs, texts: (compared.append(pairs.count()), confirmed(pairs, texts))[1])
    links = similar.similar_links(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    label = {i: i for i, _ in rows}

    def join(a, b):
        low, high = sorted((label[a], label[b]))
        label.update((k, low) for k, v in label.items() if v == high)

    for r in links.collect():
        join(r.a, r.b)
    got, label = label, {i: i for i, _ in rows}
    sets = [(i, similar.shingles((t or "").encode())) for i, t in rows]
    near = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if len(x) and similar.jaccard(x, y) >= similar.LIMIT]
    for a, b in near:
        join(a, b)
    assert got == label and 1 < len(set(got.values())) < 150
    assert sum(compared[1:]) < len(texts)
