"""Alignment of two tokenizers over the same texts, and link counts over the corpus.

A byte-level BPE vocabulary (A) and a sentencepiece model (B) cut the same bytes, a space
and the text, into tokens.  The ends of both token lists are ascending offsets; the shorter
list gallops through the longer one: from the place of an earlier end, in steps of double
width, then by halving.  Ends that meet cut the tokens into groups.  The ranks that the
search finds also give the tokens of the other side that each token overlaps: from the
rank of its start to the rank of its end.  Every overlapping pair is a link.

How many documents hold a pair of ids linked is counted over the corpus.  Documents are
read in parts of about ``PART_BYTES``, and a part names each of its pairs once, so what is
shuffled grows with the pairs of a part, not with its links.  A part gets back the counts
of its own pairs only; nothing is broadcast, and no task grows with a frequent pair.

A text that is null, empty or not given back byte for byte by both vocabularies has no
tokens: zeros and no groups.  Strings of special tokens are plain text.  Rows with the same
id, or none, are documents each; other columns are left out.  One text is encoded at a
time at least, so a task's memory follows the longest text.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .shared import arrow_map, slices, stored
from .tokens import byte_characters

PART_BYTES = 4 << 20
SLICE_BYTES = 1 << 19
STRIDE = 16  # ends between two anchors of the search
B_BITS = 16  # a pair of ids is one number, A above B

PART = pa.schema([
    ("part", pa.int64()), ("doc", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
    ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())), ("groups", pa.list_(pa.string())),
    ("sizes", pa.list_(pa.int64())), ("places", pa.binary()), ("times", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())),
])
LONGS = "array<long>"
PART_TYPE = (
    f"part long, doc {LONGS}, n_a {LONGS}, n_b {LONGS}, n_groups {LONGS}, n_links {LONGS}, groups array<string>, "
    f"sizes {LONGS}, places binary, times binary, pairs {LONGS}, docs {LONGS}"
)
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def search_from(low: np.ndarray, values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of ``ends`` below each value, which is ``low`` or more."""
    low, high = low.copy(), np.full(len(low), len(ends))
    open_, step = np.arange(len(low)), 1
    while len(open_):  # steps of double width
        probe = low[open_] + step
        inside = probe <= len(ends)
        open_, probe = open_[inside], probe[inside]
        below = ends[probe - 1] < values[open_]
        high[open_[~below]] = probe[~below] - 1
        open_ = open_[below]
        low[open_] = probe[below]
        step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):  # halving
        middle = (low[open_] + high[open_]) >> 1
        below = ends[middle] < values[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each end of the shorter list, the number of smaller ends in the longer one, and
    whether the longer one has it too.  Both ascend; anchors, every ``STRIDE``-th end of
    those found after them, are placed first, and each end starts from its anchor's place."""
    rank = np.zeros(-(-len(short) // STRIDE**3), np.int64)
    for stride in (STRIDE**2, STRIDE, 1):
        some = short[::stride]
        rank = search_from(np.repeat(rank, STRIDE)[: len(some)], some, long)
    return rank, long[np.minimum(rank, len(long) - 1)] == short if len(long) else np.zeros(len(short), bool)


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places (a, b) of all overlapping tokens, ordered by place, and which tokens of each
    side end where one of the other side ends."""
    turned = len(a_ends) > len(b_ends)
    short, long = (b_ends, a_ends) if turned else (a_ends, b_ends)
    rank, meets = gallop(short, long)
    first = np.append(0, (rank + meets)[:-1])[: len(rank)]
    count = rank - first + 1
    one = np.repeat(np.arange(len(short)), count)
    other = np.arange(len(one)) - np.repeat(np.cumsum(count) - count - first, count)
    met = np.zeros(len(long), bool)
    met[rank[meets]] = True
    return (other, one, met, meets) if turned else (one, other, meets, met)


@functools.lru_cache(maxsize=4)
def digits(size: int) -> np.ndarray:
    """Row i holds a place for a separator and the decimal digits of i; zero bytes pad it."""
    width = len(str(max(0, size - 1)))
    table = np.zeros((size, width + 1), np.uint8)
    table[:, 1:] = np.array([str(i).encode() for i in range(size)], f"S{width}").view(np.uint8).reshape(size, width)
    return table


def group_texts(a: np.ndarray, b: np.ndarray, a_meets: np.ndarray, b_meets: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each document, whose tokens of both sides end at ``bounds``."""
    a_end, b_end = np.flatnonzero(a_meets) + 1, np.flatnonzero(b_meets) + 1
    a_first, b_first = np.append(True, a_meets[:-1]), np.append(True, b_meets[:-1])
    a_at = np.arange(len(a)) + np.append(0, b_end)[np.cumsum(a_first) - 1]
    b_at = np.arange(len(b)) + a_end[np.cumsum(b_first) - 1]
    out = np.empty((len(a) + len(b), table.shape[1]), np.uint8)
    out[a_at], out[b_at] = table[a], table[b]
    out[a_at, 0], out[b_at, 0] = np.where(a_first, 59, 44), np.where(b_first, 124, 44)
    return [out[s:e].tobytes().translate(None, b"\0")[1:] for s, e in zip(np.append(0, bounds[:-1]).tolist(), bounds.tolist())]


class Vocabularies:
    """Both encoders, and the bytes and lengths of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {c: i for i, c in enumerate(byte_characters())}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(map(byte_of.__getitem__, n)) if all(c in byte_of for c in n) else n.encode() for n in names]
        model, size = self.b, self.b.get_piece_size()
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(model.id_to_piece, range(size)))
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.table = digits(max(len(self.a_bytes), size))

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of every text under both, empty where either does not give back its bytes."""
        a = [x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        for i, text in enumerate(texts):
            raw = (" " + text).encode()
            same = text and all(b"".join(map(t.__getitem__, ids)) == raw for t, ids in ((self.a_bytes, a[i]), (self.b_bytes, b[i])))
            if not same:
                a[i], b[i] = [], []
        return a, b


@functools.lru_cache(maxsize=1)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def align_texts(texts: list[str | None], words: Vocabularies, keep: Callable[[bytes], str]) -> dict:
    """Counts, group texts and links of documents that lie end to end: the ends of a
    document's last tokens meet, so no group and no link crosses documents."""
    a_lists, b_lists = words.encode([t or "" for t in texts])
    n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a_lists, b_lists))
    a, b = (np.fromiter(itertools.chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a_lists, n_a), (b_lists, n_b)))
    one, other, a_meets, b_meets = overlaps(np.cumsum(words.a_sizes[a]), np.cumsum(words.b_sizes[b]))
    doc_of = np.repeat(np.arange(len(texts)), n_a)
    pairs = a[one] << B_BITS | b[other]
    key, times = np.unique(doc_of[one] << 40 | pairs, return_counts=True)
    doc, pairs = key >> 40, key & (1 << 40) - 1
    done = group_texts(a, b, a_meets, b_meets, np.cumsum(n_a + n_b), words.table)
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc_of[a_meets], minlength=len(texts)),
        "n_links": np.bincount(doc_of[one], minlength=len(texts)), "groups": [keep(x) for x in done],
        "sizes": np.bincount(doc, minlength=len(texts)), "pairs": pairs, "times": times,
    }


def part_row(number: int, keys: list, found: list[dict]) -> pa.RecordBatch:
    joined = {n: np.concatenate([f[n] for f in found]) for n in (*COUNTS, "sizes", "pairs", "times")}
    pairs, places, docs = np.unique(joined["pairs"], return_inverse=True, return_counts=True)
    small = np.diff(places.ravel(), prepend=0).astype("<i4").tobytes()  # differences pack better
    row = {
        "part": number, "doc": keys, **{n: joined[n] for n in COUNTS}, "groups": [g for f in found for g in f["groups"]],
        "sizes": joined["sizes"], "places": small, "times": joined["times"].astype("<i4").tobytes(), "pairs": pairs, "docs": docs,
    }
    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in PART], schema=PART)


def parts(docs: DataFrame, a_path: str, b_path: str, key: str, text: str, keep: Callable[[bytes], str]) -> DataFrame:
    """One row per part of documents: their counts, groups and links, and the part's pairs.
    Numbers of parts are unique in a table that is written once."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabularies(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        keys, found, size = [], [], 0
        waiting, waiting_size = [], 0

        def finish():
            nonlocal waiting, waiting_size, size
            if waiting:
                found.append(align_texts(waiting, words, keep))
                size += waiting_size
                waiting, waiting_size = [], 0

        for batch in slices(batches):
            for id_, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(id_)
                waiting.append(value)
                waiting_size += len(value or "")
                if waiting_size >= SLICE_BYTES or len(waiting) >= 4096:
                    finish()
                    if size >= PART_BYTES or len(keys) >= 1 << 16:
                        yield part_row(number, keys, found)
                        number, keys, found, size = number + 1, [], [], 0
        finish()
        if keys:
            yield part_row(number, keys, found)

    return arrow_map(docs.select(docs[key].cast("long").alias("doc"), docs[text].cast("string")), work, PART_TYPE)


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair``, ``n`` (documents that hold it linked) and ``best``: no other pair of its A
    id has a higher count.  There are at most as many A ids as the vocabulary has."""
    listed = found.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select("p.pairs", "p.docs")
    counts = listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n"))
    of_a = F.shiftright("pair", B_BITS)
    most = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", of_a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", keep: Callable[[bytes], str] = bytes.decode
) -> DataFrame:
    """Per document: ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links
    whose count is the highest of their A id), ``count_sum`` (over links) and ``groups``:
    ids in order as ``a1,a2|b1;a3|b2,b3``, or what ``keep`` makes of that text."""
    found = stored(parts(docs, a_path, b_path, key, text, keep), "alignment")
    wanted = found.select("part", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "p")).select("part", "place", F.col("p.pairs").alias("pair"))
    told = wanted.join(stored(pair_counts(found), "pair-counts"), "pair").select(F.col("part").alias("of_part"), "place", "n", "best")
    out = pa.schema([(key, pa.int64()), *((n, pa.int64()) for n in (*COUNTS, "n_best", "count_sum")), ("groups", pa.string())])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right.column("place").to_numpy()
        n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        n[at], best[at] = right.column("n").to_numpy(), right.column("best").to_numpy()
        rows = []
        for row in left.to_batches():
            for i in range(row.num_rows):
                one = {f: row.column(f)[i] for f in row.schema.names}
                places = np.cumsum(np.frombuffer(one["places"].as_py(), "<i4"), dtype=np.int64)
                times = np.frombuffer(one["times"].as_py(), "<i4").astype(np.int64)
                ends = np.cumsum(np.array(one["sizes"].as_py(), np.int64))
                sums = [np.diff(np.append(0, np.cumsum(times * x[places]))[ends], prepend=0) for x in (best, n)]
                rows.append(pa.Table.from_arrays(
                    [one["doc"].values, *(one[c].values for c in COUNTS), *map(pa.array, sums), one["groups"].values], schema=out
                ))
        return pa.concat_tables(rows) if rows else out.empty_table()

    left = found.drop("pairs", "docs").groupBy("part")
    fields = ", ".join(f"{n} long" for n in (*COUNTS, "n_best", "count_sum"))
    return left.cogroup(told.groupBy("of_part")).applyInArrow(finish, f"`{key}` long, {fields}, groups string")
