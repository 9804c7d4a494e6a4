"""Pairs of texts whose five-word shingle sets have a Jaccard similarity of ``LIMIT`` or more.

Candidates come from MinHash: ``BANDS`` bands of ``ROWS`` minima each, so a pair at 0.8
shares a band with probability 1 - (1 - 0.8 ** 6) ** 32 = 0.9999.  Every candidate is
confirmed by its exact similarity.  First each member of a bucket is compared with the
bucket's smallest node, so a large group of copies costs one comparison a member.  Buckets
that stay in several components mostly hold pairs below the limit, up to the square of a
template's pages.  Their members meet by prefixes instead: with shingles ordered from rare
to common, two sets of the wanted similarity share one early enough in both that what
follows can still make up their overlap.  So no similar pair is left out, while sets whose
own shingles alone put them below the limit never meet.  Of those that share a shingle, the
one with the fewest rarer shingles is compared first, then the pairs not connected yet whose
``MARKS`` bits, the parities of their hashed shingles, differ by no more than similar sets can.

Words are those of ``simhash``; a text of up to five words is one shingle, an empty text
has none and makes no links.  Texts with equal shingle sets are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .components import components
from .shared import arrow_map, arrow_rows, slices, stored, utf8

LIMIT = 0.8
SHINGLE = 5
BANDS, ROWS = 32, 6
MARKS = 1024
SEED = 42
_RNG = np.random.default_rng(SEED)
FACTORS = _RNG.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1)
SHIFTS = _RNG.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)


def shingles(text: bytes) -> np.ndarray:
    """Distinct hashes of the five-word shingles, ascending."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - SHINGLE + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[s:e], SEED) for s, e in zip(starts, (ends[SHINGLE - 1:] - 1).tolist())], np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def bands(found: np.ndarray) -> list[int]:
    """A hash of each band's minima, as signed numbers."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 1024):
        low = np.minimum(low, (short[start:start + 1024] * FACTORS + SHIFTS).min(axis=1))
    raw = low.tobytes()
    width = 4 * ROWS
    return [xxhash.xxh64_intdigest(raw[i * width:(i + 1) * width], i) for i in range(BANDS)]


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``code`` (a hash of the shingle set), ``size`` and ``bands``; no row for an empty text."""
    out = pa.schema([("id", pa.int64()), ("code", pa.int64()), ("size", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, codes, sizes, rows = [], [], [], []
            for id_, value in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                found = shingles(value)
                if len(found):
                    ids.append(id_)
                    codes.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
                    sizes.append(len(found))
                    rows.append(np.array(bands(found), np.uint64).view(np.int64))
            yield arrow_rows(out, id=ids, code=np.array(codes, np.uint64).view(np.int64), size=sizes, bands=rows)

    return arrow_map(docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string")), work, "id long, code long, size long, bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those pairs ``a``, ``b`` whose exact similarity is at the limit or above."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in slices(batches):
            keep = []
            for i, (a, x, y) in enumerate(zip(batch.column(0).to_pylist(), utf8(batch.column(2)), utf8(batch.column(3)))):
                if a != last:
                    last, left = a, shingles(x)
                if jaccard(left, shingles(y)) >= LIMIT:
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    left, right = (texts.select(F.col("node").alias(n), F.col("text").alias(t)) for n, t in (("a", "x"), ("b", "y")))
    return arrow_map(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y"), work, "a long, b long")


def near_in_size(a, b):
    """Sets of sizes further apart than the limit cannot be similar."""
    return F.least(a, b) >= LIMIT * F.greatest(a, b)


def may_be_similar(a, a_after, b, b_after):
    """Sets of ``a`` and ``b`` shingles share at most as many as follow the first common
    one in the order, itself included, in either set."""
    return F.least(a_after, b_after) * (1 + LIMIT) >= LIMIT * (a + b) - 1e-6


def marks(found: np.ndarray) -> np.ndarray:
    """Parity of the shingles of each hash, ``MARKS`` bits: two sets' differ in no more bits
    than the sets have shingles not in common."""
    odd = np.bincount((found % np.uint64(MARKS)).astype(np.int64), minlength=MARKS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def marks_differ(x: str, y: str):
    return sum(F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(MARKS // 64))


def shingle_sets(texts: DataFrame) -> DataFrame:
    """``code``, ``tokens`` and ``marks`` of each distinct shingle set."""
    out = pa.schema([("code", pa.int64()), ("tokens", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(value) for value in utf8(batch.column(0))]
            codes = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in found], np.uint64).view(np.int64)
            yield arrow_rows(out, code=codes, tokens=[x.view(np.int64) for x in found], marks=[marks(x) for x in found])

    return arrow_map(texts.select("text"), work, "code long, tokens array<long>, marks array<long>").dropDuplicates(["code"])


def prefixes(sets: DataFrame) -> DataFrame:
    """``code``, ``token``, ``after``: those shingles of each set, rare ones first, from
    which on (``after`` shingles, itself included) enough are left for a similar set to share.
    Shingles of one set alone count for their place only."""
    rows = sets.select("code", F.size("tokens").alias("all"), F.explode("tokens").alias("token"))
    common = rows.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1")
    after = F.row_number().over(Window.partitionBy("code").orderBy(F.desc("sets"), F.desc("token")))
    return rows.join(common, "token").withColumn("after", after).where(F.col("after") >= LIMIT * F.col("all") - 1e-6).select("code", "token", "after")


def in_components(early: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of prefixes with the ``component`` of their node, and each ``token`` of several
    components: the smallest, ``least``, and the set with the fewest rarer shingles, ``hub``."""
    rows = stored(early.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    hub = F.min(F.struct((F.col("size") - F.col("after")).alias("rarer"), "node", "size", "after", "component"))
    tokens = rows.groupBy("token").agg(hub.alias("hub"), F.min("component").alias("least"), F.max("component").alias("most"))
    return rows, tokens.where("least < most")


def similar_links(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Links ``a``, ``b`` between values of ``key`` that connect what all similar pairs
    connect.  Rows without a key make no links."""
    rows = docs.where(F.col(key).isNotNull())
    signed = stored(signatures(rows, key, text), "signatures")
    nodes = signed.groupBy("code").agg(F.min("id").alias("node"))
    equal = signed.select("id", "code").join(nodes, "code").where("id <> node").select(F.col("node").alias("a"), F.col("id").alias("b"))
    # One row of a node is enough; rows that share an id and not their text are nodes of one name.
    first = signed.join(nodes.select("code", F.col("node").alias("id")), ["code", "id"]).select(F.col("id").alias("node"), "code", "size", "bands")
    members = first.dropDuplicates(["node", "code"]).select("node", "code", "size", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(F.min(F.struct("node", "size")).alias("low"), F.max("node").alias("high")).where("low.node < high").select("band", "low")
    members = stored(members.join(buckets, "band"), "buckets")
    wanted = members.select("node").distinct()
    texts = stored(rows.select(F.col(key).cast("long").alias("node"), F.col(text).cast("string").alias("text")).join(wanted, "node", "left_semi").distinct(), "texts")

    stars = members.where((F.col("low.node") < F.col("node")) & near_in_size(F.col("size"), F.col("low.size")))
    stars = stars.select(F.col("low.node").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(confirmed(stars, texts).distinct(), "links")
    # What is left: pairs of such buckets that lie in different components.
    placed = members.join(components(links), "node", "left").select("band", "node", "code", "size", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select("band")
    placed = stored(placed.join(mixed, "band", "left_semi").select("node", "code", "size").distinct(), "mixed")
    sets = stored(shingle_sets(texts.join(placed.select("node").distinct(), "node", "left_semi")), "sets")
    early = stored(prefixes(sets).join(placed, "code"), "prefixes")

    rows, tokens = in_components(early, links)
    rows = rows.join(tokens.select("token", "hub"), "token").where(
        (F.col("component") != F.col("hub.component")) & may_be_similar(F.col("size"), F.col("after"), F.col("hub.size"), F.col("hub.after"))
    )
    central = stored(rows.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct().join(stars, ["a", "b"], "left_anti"), "central")
    links = stored(links.unionByName(confirmed(central, texts).distinct()), "links")

    rows, tokens = in_components(early, links)
    rows = rows.join(tokens.select("token", "least"), "token").join(sets.select("code", "marks"), "code")
    left, right = rows.where("component > least").alias("x"), rows.alias("y")
    rest = left.join(right, (F.col("x.token") == F.col("y.token")) & (F.col("y.component") < F.col("x.component"))
        & may_be_similar(F.col("x.size"), F.col("x.after"), F.col("y.size"), F.col("y.after"))
        & (marks_differ("x.marks", "y.marks") * (1 + LIMIT) <= (1 - LIMIT) * (F.col("x.size") + F.col("y.size")) + 1e-6)
    ).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    rest = rest.join(stars.unionByName(central), ["a", "b"], "left_anti")
    return links.unionByName(confirmed(rest, texts)).unionByName(equal)
