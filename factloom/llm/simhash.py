"""SimHash near-duplicates with a Gray-order hierarchical index.

A fingerprint bit is set where more than half of a text's shingle hashes have it.  Two
fingerprints link when at most ``DISTANCE`` bits differ.  The 64 bits are cut into six
segments; a linked pair agrees on at least two of them, so fifteen tables, one per pair of
segments, hold every link.  In each table the two segments come first and the fingerprints
are sorted by Gray rank, which puts equal segments next to one another.

Runs of equal segments are the upper nodes of the index.  A node keeps the bits that all
fingerprints below it share, less those its parent has, and a search adds up differing
bits on the way down and prunes a whole group once they exceed the limit.  Runs longer
than ``BLOCK``, or cut by a partition's edge, become blocks; pairs of blocks whose shared
bits are near enough are compared in tasks of their own, so no task grows with a run.

Only distinct fingerprints are searched, and a task returns a spanning set of links, at
most one per fingerprint.  Texts: null is empty, which has fingerprint zero.  Rows with a
null id get a fingerprint and the component of its other rows, but make no links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import components
from .shared import arrow_map, arrow_rows, slices, stored, utf8

DISTANCE = 4
SHINGLE = 4
BLOCK = 512
FANOUT = 8
WIDTHS = (11, 11, 11, 11, 10, 10)
SEED = 42
RUN = pa.schema([
    ("a", pa.int64()), ("b", pa.int64()), ("tab", pa.int32()), ("head", pa.int64()), ("mask", pa.int64()),
    ("pattern", pa.int64()), ("block", pa.int64()), ("codes", pa.list_(pa.int64())), ("nodes", pa.list_(pa.int64())),
])
RUN_TYPE = "a long, b long, tab int, head long, mask long, pattern long, block long, codes array<long>, nodes array<long>"


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for start in range(0, len(values), 1 << 16):
        part = values[start:start + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``code``, the fingerprint as a signed 64-bit integer."""
    out = pa.schema([(key, pa.int64()), ("code", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            codes = np.array([fingerprint(x) for x in utf8(batch.column(1))], np.uint64).view(np.int64)
            yield arrow_rows(out, **{key: batch.column(0)}, code=pa.array(codes))

    return arrow_map(docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string")), work, f"`{key}` long, code long")


def segments_first(codes: np.ndarray, first: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The bits with two segments moved to the front, and those two as a number."""
    order = [*first, *(i for i in range(len(WIDTHS)) if i not in first)]
    at, moved = 64, np.zeros(len(codes), np.uint64)
    for i in order:
        at -= WIDTHS[i]
        bits = codes >> np.uint64(64 - sum(WIDTHS[: i + 1])) & np.uint64((1 << WIDTHS[i]) - 1)
        moved |= bits << np.uint64(at)
    return moved, moved >> np.uint64(64 - sum(WIDTHS[i] for i in first))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of a code in Gray order, as a signed number with the same order."""
    for shift in (1, 2, 4, 8, 16, 32):
        codes = codes ^ codes >> np.uint64(shift)
    return (codes ^ np.uint64(1 << 63)).view(np.int64)


def in_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each code once for every pair of segments."""
    for batch in slices(batches, 4096):
        codes, nodes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for tab, pair in enumerate(combinations(range(len(WIDTHS)), 2)):
            moved, head = segments_first(codes.view(np.uint64), pair)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(codes), tab, np.int32)), pa.array(head.view(np.int64)), pa.array(gray_rank(moved)), pa.array(codes), pa.array(nodes)],
                names=["tab", "head", "rank", "code", "node"],
            )


class GrayIndex:
    """Runs of codes in Gray order: run, groups of ``FANOUT`` codes, codes."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray):
        self.codes, ends = codes, np.append(starts[1:], len(codes))
        sizes = -(-(ends - starts) // FANOUT)
        self.first = np.append(0, np.cumsum(sizes))
        within = np.arange(self.first[-1]) - np.repeat(self.first[:-1], sizes)
        self.starts = np.repeat(starts, sizes) + within * FANOUT
        self.ends = np.minimum(self.starts + FANOUT, np.repeat(ends, sizes))
        self.top = shared_bits(codes, starts)
        mask, pattern = shared_bits(codes, self.starts)
        own = mask & ~np.repeat(self.top[0], sizes)
        self.groups = own, pattern & own
        rest = ~np.repeat(mask, self.ends - self.starts)
        self.leaves = rest, codes & rest

    def near(self, queries: np.ndarray, runs: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, code) within ``limit`` differing bits, each query in its run."""
        mask, pattern = self.top
        diff = np.bitwise_count((queries ^ pattern[runs]) & mask[runs]).astype(np.int64)
        who = np.flatnonzero(diff <= limit)
        who, node, diff = spread(who, diff[who], self.first[runs[who]], self.first[runs[who] + 1])
        who, node, diff = keep(queries, who, node, diff, self.groups, limit)
        who, node, diff = spread(who, diff, self.starts[node], self.ends[node])
        who, node, _ = keep(queries, who, node, diff, self.leaves, limit)
        return who, node


def shared_bits(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    every, any_ = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
    mask = ~(every ^ any_)
    return mask, every & mask


def spread(who, diff, first, last):
    """Each row once for every child from ``first`` to ``last``."""
    sizes = last - first
    begin = np.cumsum(sizes) - sizes
    child = np.arange(sizes.sum()) - np.repeat(begin - first, sizes)
    return np.repeat(who, sizes), child, np.repeat(diff, sizes)


def keep(queries, who, node, diff, level, limit):
    mask, pattern = level
    total = diff + np.bitwise_count((queries[who] & mask[node]) ^ pattern[node])
    near = np.flatnonzero(total <= limit)
    return who[near], node[near], total[near]


def smallest_label(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def spanning(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one link per node that connects what the links (a, b) connect."""
    label = smallest_label(len(nodes), a, b)
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def links_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    empty = [None] * len(a)
    return arrow_rows(RUN, a=a, b=b, tab=empty, head=empty, mask=empty, pattern=empty, block=empty, codes=empty, nodes=empty)


def blocks_of(tab: int, head: int, codes: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
    starts = np.arange(0, len(codes), BLOCK)
    mask, pattern = shared_bits(codes, starts)
    one = [None] * len(starts)
    return arrow_rows(
        RUN, a=one, b=one, tab=[tab] * len(starts), head=[head] * len(starts), mask=mask.view(np.int64), pattern=pattern.view(np.int64),
        block=codes[starts].view(np.int64), codes=[codes[s:s + BLOCK].view(np.int64) for s in starts], nodes=[nodes[s:s + BLOCK] for s in starts],
    )


def search_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside the whole short runs of a sorted partition; other runs as blocks."""
    rest, edge = None, True
    for batch in batches:
        table = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        table = table if rest is None else [np.concatenate(pair) for pair in zip(rest, table)]
        tab, head, codes, nodes = table
        if not len(tab):
            continue
        starts = np.append(0, np.flatnonzero((tab[1:] != tab[:-1]) | (head[1:] != head[:-1])) + 1)
        last = starts[-1]
        rest = [x[last:] for x in table]
        if len(rest[0]) >= 4 * BLOCK:  # a long run leaves in whole blocks and ends as blocks
            cut = len(rest[0]) // BLOCK * BLOCK
            yield blocks_of(int(tab[last]), int(head[last]), rest[2][:cut].view(np.uint64), rest[3][:cut])
            long, rest, edge_next = True, [x[cut:] for x in rest], True
            rest = rest if len(rest[0]) else None
        else:
            long, edge_next = False, False
        if last:
            yield from whole_runs([x[:last] for x in table], starts[:-1], edge)
            edge = False
        edge = edge or (long and edge_next)
    if rest is not None and len(rest[0]):
        yield blocks_of(int(rest[0][0]), int(rest[1][0]), rest[2].view(np.uint64), rest[3])


def whole_runs(table, starts, edge: bool) -> Iterator[pa.RecordBatch]:
    tab, head, codes, nodes = table
    codes, sizes = codes.view(np.uint64), np.diff(np.append(starts, len(codes)))
    apart = sizes > BLOCK
    apart[0] |= edge
    for run in np.flatnonzero(apart):
        s = starts[run]
        yield blocks_of(int(tab[s]), int(head[s]), codes[s:s + sizes[run]], nodes[s:s + sizes[run]])
    inside = np.flatnonzero(~apart & (sizes > 1))
    if len(inside):
        _, rows, _ = spread(inside, inside, starts[inside], starts[inside] + sizes[inside])
        own, begin = sizes[inside], np.cumsum(sizes[inside]) - sizes[inside]
        index = GrayIndex(codes[rows], begin)
        pairs = index.near(codes[rows], np.repeat(np.arange(len(own)), own), DISTANCE)
        yield links_of(*spanning(nodes[rows], *pairs))


def search_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside the blocks of each row: its first block's codes searched in both."""
    for batch in batches:
        rows = [batch.column(i).to_pylist() for i in range(4)]
        for codes, nodes, others, other_nodes in zip(*rows):
            queries = np.array(codes, np.int64).view(np.uint64)
            same = others is None
            codes2 = queries if same else np.array(others, np.int64).view(np.uint64)
            names = np.array(nodes if same else nodes + other_nodes, np.int64)
            who, node = GrayIndex(codes2, np.array([0])).near(queries, np.zeros(len(queries), np.int64), DISTANCE)
            a, b = spanning(names, who, node if same else node + len(queries))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def near_links(codes: DataFrame) -> DataFrame:
    """``codes`` has ``code`` (distinct) and ``node``; returns links ``a``, ``b`` between
    nodes that connect exactly those groups that all links connect."""
    rows = arrow_map(codes.select("code", "node"), in_tables, "tab int, head long, rank long, code long, node long")
    runs = stored(
        arrow_map(rows.repartitionByRange("tab", "rank").sortWithinPartitions("tab", "rank").select("tab", "head", "code", "node"), search_runs, RUN_TYPE), "runs"
    )
    blocks = runs.where("tab IS NOT NULL")
    top = blocks.select("tab", "head", "block", "mask", "pattern")
    left, right = top.alias("x"), top.alias("y")
    pairs = left.join(right, (F.col("x.tab") == F.col("y.tab")) & (F.col("x.head") == F.col("y.head"))).where(
        (F.col("x.block") < F.col("y.block"))
        & (F.bit_count(F.col("x.pattern").bitwiseXOR(F.col("y.pattern")).bitwiseAND(F.col("x.mask")).bitwiseAND(F.col("y.mask"))) <= DISTANCE)
    ).select(F.col("x.tab").alias("tab"), F.col("x.block").alias("block"), F.col("y.block").alias("other"))
    body = blocks.select("tab", "block", "codes", "nodes")
    far = body.select("tab", F.col("block").alias("other"), F.col("codes").alias("codes2"), F.col("nodes").alias("nodes2"))
    compared = pairs.join(body, ["tab", "block"]).join(far, ["tab", "other"]).select("codes", "nodes", "codes2", "nodes2")
    empty = F.lit(None).cast("array<long>")
    alone = blocks.where(F.size("codes") > 1).select("codes", "nodes", empty.alias("codes2"), empty.alias("nodes2"))
    found = arrow_map(compared.unionByName(alone), search_pairs, "a long, b long")
    return runs.where("tab IS NULL").select("a", "b").unionByName(found)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", more: DataFrame | None = None) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest ``key``
    reachable over links of at most four differing bits, and over the links ``a``, ``b``
    between keys that ``more`` adds."""
    codes = stored(fingerprints(docs, key, text), "fingerprints")
    first = stored(codes.where(F.col(key).isNotNull()).groupBy("code").agg(F.min(key).alias("node")), "codes")
    links = near_links(first)
    if more is not None:  # between keys, so each is led to the node of its fingerprint
        node_of = codes.join(first, "code").select(F.col(key).alias("id"), "node")
        links = links.unionByName(more.select("a", "b")).unionByName(node_of.where("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b")))
    groups = components(links)
    labels = first.join(groups, "node", "left").select("code", F.coalesce("component", "node").alias("component_id"))
    return codes.join(labels, "code", "left").select(
        key, F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )
