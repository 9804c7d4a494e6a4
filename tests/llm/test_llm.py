"""Operators of factloom.llm against brute force, on small tables with awkward rows."""

import base64
import collections
import hashlib
import json
import random
import re
import time
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from factloom.llm import chat, components, decontaminate, licences, main_text, neighbours, quality, simhash, substrings, tokens, warc

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
DOCS = "doc_id long, text string, score double, kept string, n_words string"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def docs_of(spark, texts, start=0):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(start + i, t, 0.5, "x", "y") for i, t in enumerate(texts)], DOCS)


def prose(seed, n, size=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    shared = prose(1, 60)
    base = prose(2, 300, 10_000)
    near = [re.sub(r"\bw\d+$", f"x{i}", base) for i in range(12)]
    loop = "a b c d e " * 40
    return [
        None, "", "   \n\t", "one", "One", "two words", "a b c", base, base, *near, f"{prose(3, 50)} {shared} {prose(4, 50)}",
        f"{prose(5, 80)}\n{shared}\t{prose(6, 7)}", shared, loop, prose(7, 34), prose(7, 34), prose(8, 35), prose(8, 35),
        prose(9, 30_000, 50_000), "É" * 5000, "x" * 100_000, "naïve café ÀÉ ß  z",
    ]


def test_simhash_equals_brute_force(spark, texts):
    texts = texts + [prose(100 + i % 40, 30) + f" t{i}" * (i % 3) for i in range(300)]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    codes = []
    for text in texts:
        words = SPACES.findall((text or "").translate(LOWER))
        shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        codes.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= 4 and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{c:016x}", find(i)) for i, c in enumerate(codes)}


def test_gray_index_finds_every_pair_in_long_runs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    codes = np.unique(np.concatenate([base[:, None] ^ (np.uint64(1) << rng.integers(0, 64, (40, 60), dtype=np.uint64))]).ravel())
    rank = simhash.gray_rank(codes)
    codes = codes[np.argsort(rank)]
    index = simhash.GrayIndex(codes, np.array([0, 700]))
    runs = (np.arange(len(codes)) >= 700).astype(np.int64)
    found = set(zip(*(x.tolist() for x in index.near(codes, runs, 4))))
    near = np.bitwise_count(codes[:, None] ^ codes) <= 4
    assert found == {(a, b) for a, b in np.argwhere(near & (runs[:, None] == runs)).tolist()}


def test_runs_longer_than_a_block_keep_their_components(spark):
    rng = random.Random(5)
    codes = {0}
    while len(codes) < 3000:  # a dense ball in the low bits: one run of most tables
        codes.add(sum(1 << b for b in rng.sample(range(20), 3)) if len(codes) < 1100 else rng.getrandbits(20))
    rows = spark.createDataFrame([(c, i) for i, c in enumerate(sorted(codes))], "code long, node long")
    got = {r.node: r.component for r in components.components(simhash.near_links(rows)).collect()}
    assert len(got) == 3000 and set(got.values()) == {0}


def test_simhash_null_ids_and_empty_table(spark):
    rows = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (None, "zz yy")], "doc_id long, text string")
    got = simhash.near_duplicates(rows).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 7), (7, 7), (7, 7)]
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_components_of_chain_star_and_ring(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 130)}, **{i: 200 for i in range(200, 209)}}


def test_substrings_equal_brute_force(spark, texts):
    docs = docs_of(spark, texts).repartition(3)
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.drop_repeats(docs).collect())
    words = [SPACES.findall(t or "") for t in texts]
    count = collections.Counter(tuple(w[i:i + 35]) for w in words for i in range(len(w) - 34))
    want = collections.Counter()
    for key, w in enumerate(words):
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if count[tuple(w[i:i + 35])] > 1:
                gone[i:i + 35] = [True] * 35
        want[key, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)] += 1
    assert got == want
    assert substrings.drop_repeats(docs_of(spark, [])).count() == 0


def test_substrings_carry_columns_with_clashing_names(spark):
    done = substrings.drop_repeats(docs_of(spark, [prose(1, 40), prose(1, 40), "b"]), ("doc_id", "text", "kept"))
    assert [f.name for f in done.schema] == ["doc_id", "text", "kept", "n_words", "n_removed", "kept"]
    assert sorted(r[4] for r in done.collect()) == [0, 40, 40]


def test_decontamination_equals_brute_force(spark, texts, monkeypatch):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    items = [(1, prose(2, 25, 10_000)), (2, "One"), (3, None), (4, "?!"), (5, prose(7, 12)), (10, "two WORDS"), (11, "café ÀÉ"), (5, prose(8, 14))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])].add(item)
    want = {}
    for key, text in enumerate(texts):
        w = word.findall((text or "").translate(LOWER))
        hit, found = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if items_here := windows.get(tuple(w[i:i + n])):
                    hit[i:i + n] = [True] * n
                    found |= items_here
        want[key] = (len(w), sum(hit), sorted(found))
    for limit in (decontaminate.WORDS_PER_BLOCK, 12):  # one block, then several
        monkeypatch.setattr(decontaminate, "WORDS_PER_BLOCK", limit)
        rows = decontaminate.find_passages(docs_of(spark, texts), bench, carry=("text", "n_words")).select("doc_id", "text", F.col("n_hit"), "items", "spans").collect()
        assert {r.doc_id: (r.n_hit, r["items"]) for r in rows} == {k: v[1:] for k, v in want.items()}
        for r in rows:  # spans point into the original text
            hit = [w for s in r.spans for w in word.findall(r.text.encode()[s.start:s.end].decode().translate(LOWER))]
            assert len(hit) == r.n_hit
    assert decontaminate.find_passages(docs_of(spark, ["a b"]), bench.limit(0)).first().n_hit == 0
    assert decontaminate.find_passages(docs_of(spark, []), bench).count() == 0


def test_tokens_equal_tiktoken_and_decode(spark, texts):
    texts = texts + ["don't  stop now 12345 漢字かな 😀😀 \x1c\x85", "<|endoftext|>", " " * 3000]
    with open(VOCABULARY[0], "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=VOCABULARY[1], mergeable_ranks=ranks, special_tokens={})
    coded = tokens.decode_documents(tokens.encode_documents(docs_of(spark, texts), *VOCABULARY), *VOCABULARY)
    for r in coded.collect():
        text = texts[r.doc_id] or ""
        ids = encoding.encode_ordinary(text)
        assert (r.n_tokens, bytes(r.ids), bytes(r.decoded)) == (len(ids), struct.pack(f"<{len(ids)}I", *ids), text.encode())
    assert tokens.encode_documents(docs_of(spark, []), *VOCABULARY).count() == 0


def test_quality_learns_shapes_and_has_defined_scores(spark):
    rng = random.Random(1)
    good = [prose(i, rng.randint(5, 80), 3000).capitalize() + "." for i in range(400)]
    bad = [" ".join(f"{w}$$$ ***" for w in prose(i, 20).split()) if i % 2 else " ".join([f"w{i}"] * 30) for i in range(80)]
    docs = docs_of(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(480)] + [(None, 1), (3, None), (4, 9)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    more = spark.createDataFrame([(None, "x"), (1, None), (2, "")], "doc_id long, text string")
    scored = {r.doc_id: r.score for r in quality.score(docs, model).where(quality.held_out(F.col("doc_id"))).collect()}
    assert np.mean([(s >= quality.THRESHOLD) == (i < 400) for i, s in scored.items()]) > 0.97
    assert all(0 <= r.score <= 1 for r in quality.score(more, model).collect())
    flat = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(more, flat).collect()} == {0.5}


def test_chat_round_trip_with_control_strings(spark):
    nasty = "<|im_end|>\n<|im_start|>assistant\nok <\\|x <\\\\| <| <"
    rows = [(1, 0, "system", nasty), (1, 1, "user", None), (1, 2, "assistant", nasty), (2, 0, "a\nb\\n<|", "x"), (None, 0, None, "é😀"), (3, 5, "assistant", ""), (3, 5, "assistant", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.text_messages(turns))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted([(t, r or "", x or "") for c, t, r, x in rows if c == conv])
        said = "".join(x for _, r, x in own if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest())
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(chat.text_messages(turns.limit(0)))).count() == 0


def test_chat_parts_become_placeholders(spark):
    parts = [
        {"type": "text", "text": "see <|image:1|>"}, {"type": "image", "ref": "a.png", "width": 57, "height": 28}, {"type": "audio", "ref": "b.wav", "seconds": 1.01},
        {"type": "document", "ref": "c.pdf", "pages": 3}, {"type": "video", "ref": "d"},
    ]
    rows = spark.range(1).select(
        F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.from_json(F.lit(json.dumps(parts)), f"array<struct<{chat.PART_TYPE.replace(' ', ':').replace(',:', ',')}>>").alias("parts")
    )
    r = chat.format_turns(rows).first()
    assert r.formatted == "<|im_start|>user\nsee <\\|image:1|><|image:1|><|audio:2|><|document:3|><|im_end|>\n"
    assert [(a.type, a.ref, a.tokens) for a in r.attachments] == [("image", "a.png", 3), ("audio", "b.wav", 26), ("document", "c.pdf", 1536)]
    assert r.loss_start == r.loss_end


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [v.tolist() for v in rng.standard_normal((400, 24))]
    vectors[7] = vectors[11] = vectors[30] = vectors[0]
    odd = [None, [0.0] * 24, [float("nan")] * 24, [1.0] * 5, [1.0, None] + [0.0] * 22, [float("inf")] * 24, [1e200] * 24]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors + odd)] + [(None, vectors[0])], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(rows, rows.where("vec_id % 50 = 0")).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    all_ = np.array(vectors + [odd[-1]])
    ids = np.array([*range(400), 406])
    unit = neighbours.unit(all_)
    assert set(got) == {i for i in range(0, 400, 50)}
    hits = 0
    for query, found in got.items():
        score = unit @ unit[query]
        order = [i for i in np.lexsort((ids, -score.round(12))) if ids[i] != query][:5]
        hits += len({v for _, v, _ in found} & set(ids[order].tolist()))
        assert all(abs(s - score[list(ids).index(v)]) < 1e-12 for _, v, s in found)
    assert hits >= 0.95 * 5 * len(got)
    assert [v for _, v, _ in sorted(got[0])][:3] == [7, 11, 30]
    assert neighbours.nearest(rows.limit(0), rows.limit(0)).count() == 0
    assert neighbours.nearest(rows.where("vec_id < 3"), rows.where("vec_id = 0")).count() == 2


def test_warc_round_trip(spark, tmp_path):
    big, odd = "<p>" + "é" * 600 + "</p>", "x\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a/ü b\n", big), (2, None, big), (9, "http://c", big), (3, "u", odd), (4, "v", odd), (5, "w", None), (6, "%41", ""), (None, "n", big), (7, "z", "y" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    index = warc.write_archives(pages, str(tmp_path))
    got = {r.page_id: r for r in warc.read_records(spark, str(tmp_path), index).collect()}
    for key, url, html in rows:
        body = (html or "").encode()
        revisit = html == big and key != 9
        r = got[key]
        assert (r.url, r.payload_bytes, r.payload_digest) == (url, len(body), hashlib.sha1(body).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 9) if revisit else ("response", None))
        assert r.payload is None if revisit else bytes(r.payload) == body
    some = warc.read_records(spark, str(tmp_path), index.where("page_id IN (4, 7)"))
    assert sorted(r.page_id for r in some.collect()) == [4, 7]
    assert warc.write_archives(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_warc_joins_near_ranges():
    ranges = [(0, 10), (10, 5), (15 + warc.GAP + 1, 7), (22 + warc.GAP + 1, warc.SPAN)]
    assert [len(g) for g in warc.joined_ranges(ranges)] == [2, 1, 1]


PAGE = (
    "<html><head><title>T</title><style>p{margin:0}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
    "<div class='cookie-notice'>We use cookies.</div>{}<aside>Related things to read.</aside><section id=comments><p>I think this is a fine comment, really.</p></section>"
    "<form><label>Mail</label><input></form><footer>&copy; me</footer></body></html>"
)


@pytest.mark.parametrize("markup, text", [
    ("<article><h1>Head</h1><p>One &amp; two&nbsp;<b>th</b>ree<br>four</p><p>Five.<p>Six</article>", "Head One & two three four Five. Six"),
    ("<main><p>A long enough sentence, <a href=x>with a link</a>, ends here.</p><div class='ad'>Buy</div><p>End.</p></main>", "A long enough sentence, with a link, ends here. End."),
    ("<div class='post-content'><p>Short.</p><script>if (a < b) { x = '</p>' }</script><ul><li>i<li>j</ul></div>", "Short. i j"),
    ("<article><p>a < b and 1<2</p><!-- <p>no</p> --><div style='display:none'>no</div><p title='>'>c</p></article>", "a < b and 1<2 c"),
])
def test_main_text_of_regions(markup, text):
    assert main_text.main_text(PAGE.replace("{}", markup, 1), [-2.0, 1.0, -3.0, 1.5, 1.0, -1.0]) == text


@pytest.mark.parametrize("attrs, kept", [
    ("style='overflow:hidden'", True), ('style="color:red; overflow: hidden"', True), ("title='A hidden gem'", True), ("hidden=until-found", True),
    ("data-note='display:none'", True), ("aria-hidden=false", True), ("hidden", False), ("HIDDEN=''", False), ("aria-hidden = 'true'", False),
    ("style='color:red;Display : none !important'", False), ("style=visibility:hidden", False),
])
def test_main_text_hides_by_attribute_name(attrs, kept):
    page = PAGE.replace("{}", f"<article {attrs}><p>Whole text.</p></article>", 1)
    assert main_text.main_text(page, [-2.0, 1.0, -3.0, 1.5, 1.0, -1.0]) == "Whole text." * kept


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>T</title><body><article><p>Whole article text.", "Whole article text."),
    ("<head><meta charset=utf-8><article><p>Whole article text.</article>", "Whole article text."),
    ("<article><p>a</p><svg class=i /><p>rest</p><math/><p>end</article>", "a rest end"),
    ("<article><p>a</p><svg class='i'><title>no</title><path d=x /></svg><p>rest</article>", "a rest"),
    *((f"<div><{tag} class=x></div><article><p>Text.</article>", "Text.") for tag in ("object", "canvas", "noscript", "audio", "video", "template", "select")),
    ("<article><p>a</p><object><object>no</object>no</object><p>b</p><video>no</video><p>c</article>", "a b c"),
    ("<article><p>a</p><script>'<p>no</p>'", "a"),
])
def test_main_text_of_unclosed_elements(page, text):
    assert main_text.main_text(page, [-2.0, 1.0, -3.0, 1.5, 1.0, -1.0]) == text


def test_main_text_without_named_regions_goes_by_shape():
    body = "".join(f"<p>{prose(i, 40)}.</p>" for i in range(3)) + "<p>Short.</p>" + f"<p>{prose(9, 40)}.</p>"
    page = "<div><div><a href=1>Home</a></div><div><a href=2>News</a></div></div><div>" + body + "</div>"
    text = main_text.main_text(page, [-3.0, 1.2, -4.0, 1.0, 1.0, -1.0])
    assert "Short." in text and "Home" not in text  # the short one is kept by its neighbours


@pytest.mark.parametrize("opening, kept", [
    ("<article class='entry no-sidebar'>", True), ("<main class='content has-sidebar'>", True),
    ("<article class='post category-social comments-open'>", True), ("<main id='content-with-header'>", True),
    ("<article class='post with-form'>", True), ("<div class='entry tag-notices without-comments'>", True),
    ("<main><article class='comment-body'>", False), ("<article><article class='reply'>", False),
    ("<div class='comments has-content'>", False), ("<div class='related-posts'>", False), ("<article hidden class='post'>", False),
    ("<div hidden><article class='post'>", False),
])
def test_layout_and_state_classes_name_no_region(opening, kept):
    page = f"<body><nav><a href=1>Home</a></nav>{opening}<p>The whole text of it stands here.</p>"
    assert main_text.main_text(page, [-2.0, 1.0, -3.0, 1.5, 1.0, -1.0]) == "The whole text of it stands here." * kept


def test_the_cut_finds_the_article_of_unnamed_pages():
    """Pages of plain divisions: the shape alone drops short paragraphs, the cut does not."""
    weights, rng, changed = [-3.0, 1.2, -4.0, 1.0, 1.0, -1.0], random.Random(11), 0
    for k in range(40):
        body = [prose(100 * k + i, n) + "." * (n > 2) for i, n in enumerate(rng.choices([2, 30, 45], k=rng.randint(5, 9)))]
        body[0], body[-1] = prose(k, 40) + ".", prose(k + 50, 40) + "."
        menu = "".join(f"<div><a href=/{i}>{prose(i, 2)}</a></div>" for i in range(6))
        page = f"<div>{menu}</div><div>{''.join(f'<p>{b}</p>' for b in body)}</div><div>{menu}</div>"
        blocks = main_text.blocks_of(page)
        alone = [sum(w * x for w, x in zip(weights, main_text.shape(b))) > 0 for b in blocks]
        changed += main_text.content(blocks, weights) != alone
        assert main_text.main_text(page, weights) == " ".join(body)
    assert changed > 10


def test_very_long_pages_are_cut_in_time():
    rng = random.Random(3)
    words = [rng.choice([1, 2, 3, 5, 9, 14, 30]) for _ in range(16_000)]
    page = "<div>" + "".join(f"<p>{'w ' * n}{rng.choice(['', '.'])}</p>" + "</div><div>" * (rng.random() < 0.1) for n in words) + "</div>"
    blocks = main_text.blocks_of(page)
    start = time.process_time()
    kept = main_text.content(blocks, [-3.0, 1.2, -4.0, 1.0, 1.0, -1.0])
    assert time.process_time() - start < 2 and 0 < sum(kept) < len(kept) == 16_000


def test_min_cut_equals_enumeration():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 7)
        odds = [rng.choice([-1, 1]) * rng.uniform(0.1, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        cost = lambda kept: sum(max(0, o) if not k else max(0, -o) for o, k in zip(odds, kept)) + sum(w for a, b, w in edges if kept[a] != kept[b])
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(main_text.min_cut(odds, edges)) == pytest.approx(best)


def test_main_text_over_a_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE.replace("{}", "<article><p>Hello.</p></article>", 1)), (2, None, None), (3, "w", ""), (3, "w", "")], "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = main_text.extract(pages, main_text.train(pages)).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [(1, "Hello.", 6), (2, "", 0), (3, "", 0), (3, "", 0)]
    assert main_text.extract(pages.limit(0), main_text.train(pages.limit(0))).count() == 0


def test_licences(spark):
    want = {
        "This work is licensed under the GNU General Public License, version 3.": ["gpl"], "Some text.\nReleased under the MIT License.\n": ["mit"],
        "x\nLicensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.": ["apache", "cc-by-nc"], "The driver needs a license to work here.": [],
        "die Lizenz mit dem Wort": [], "": [], None: [], "license " * 3000: [],
    }
    docs = docs_of(spark, list(want))
    model = licences.train(docs)
    assert [r.families for r in licences.scan(docs, model).orderBy("doc_id").collect()] == list(want.values())
    plan = licences.scan(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert licences.scan(docs.limit(0), model).count() == 0


WRAPPED = {  # comment marks, blank comment lines and line ends inside the notice
    "lgpl": " * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.",
    "gpl": "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction",
    "apache": "// Licensed under the Apache License, Version 2.0 (the \"License\");\n// you may not use this file except in compliance with the License.",
    "zlib": "x\n\n \n//\nThis is distributed under the zlib License.", "eupl": "Licensed under the EUPL",
}


def test_licences_by_paragraphs(spark):
    plain = ["License: not MIT License, all rights reserved", "This work is released under the Harbour Source License, version 7.", "Er kam mit dem Hund.", "a b\n" * 4000, "-- \n" * 5000 + "wort " * 5000]
    texts = [*WRAPPED.values(), *plain, "\n\n".join(WRAPPED.values()), "x " * 4000 + WRAPPED["lgpl"] + " y" * 4000]
    docs = docs_of(spark, texts).withColumn("families", F.lit(1)).withColumn("findings", F.lit(2)).withColumn("asked", F.lit(3))
    docs = docs.unionByName(docs)  # repeated rows are scanned each
    model = licences.train(docs)
    got = licences.scan(docs, model).orderBy("doc_id").collect()
    assert got[::2] == got[1::2]
    got = got[::2]
    size = len(WRAPPED)
    assert [r.families for r in got] == [[f] for f in WRAPPED] + [[]] * len(plain) + [sorted(WRAPPED), ["lgpl"]]
    negated, other = got[size], got[size + 1]
    assert [(f.family, f.confirmed, f.cover) for f in negated.findings] == [("mit", False, 1.0)]
    assert other.n_unconfirmed == 1 and other.findings[0].family == licences.OTHER
    assert [r.findings for r in got[size + 2:size + 5]] == [[], [], []]
    assert [f.paragraph for f in got[-2].findings] == [0, 1, 2, 3, 4, 6, 7]  # zlib's text has two
    assert licences.scan(docs, model, prune=False).orderBy("doc_id").collect()[::2] == got


def test_documents_of_a_batch_are_packed_together(spark):
    """One record batch per row: pieces that are compressed alone take more room."""
    table = spark.range(0, 1000, 1, 1).selectExpr("id AS c0", "repeat(concat('text ', id), 20) AS _text")
    bodies = substrings.arrow_map(table, substrings.packed, "batch long, n_words long, body binary").collect()
    pieces = [list(pa.ipc.open_stream(bytes(r.body))) for r in bodies]
    assert [len(p) for p in pieces] == [1] * len(bodies)
    assert [i for p in pieces for i in p[0].column("c0").to_pylist()] == list(range(1000))
