"""Exact removal of repeated word sequences, found through fixed-block anchors.

Every ``ANCHOR`` consecutive words from a document's start are a reference block, without
overlap.  A window of ``2 * ANCHOR - 1`` words always holds a whole block, so a repeated
window has, in each of its places, some rolling word window that equals a block elsewhere.

1. *Batches.* Whole documents are packed into batches of a megabyte, compressed.
2. *Anchors.* Each batch sends its distinct rolling hashes, packed by bucket, with a mark
   where one is a reference block.  A bucket answers which of them meet a block elsewhere.
3. *Extension.* Only windows around an anchor hit are candidates.  Their 96-bit hashes are
   counted the same way; neighbouring repeated windows make up a maximal repeat.
4. *Removal.* Words covered by a repeated window go.

A passage that a third of all documents share costs one entry per batch: batches merge
their own repeats first.  No pairs are made, buckets have a bounded size, and only packed
hashes are shuffled besides the compressed batches.  Null texts have no words; rows with
the same id or the same text are separate places; other columns are carried if named.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .shared import arrow_map, slices, stored, utf8, word_hashes

WINDOW = 35
ANCHOR = 18
BATCH_BYTES = 1 << 20
BUCKET_ENTRIES = 1 << 18
MULTIPLIER = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
# Batches are stored once and shuffled twice, most of what is on disk, so they are packed well.
IPC = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
ENTRIES = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("keys", pa.binary()), ("places", pa.binary())])
ENTRY_TYPE = "bucket long, batch long, keys binary, places binary"


# --- batches -------------------------------------------------------------------

def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in compressed batches; a document longer than a batch is one alone."""
    task, number, held, size, words = TaskContext.get().partitionId(), 0, [], 0, 0

    def row():
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=IPC) as out:
            out.write_table(pa.Table.from_batches(held).combine_chunks())  # a column's pieces pack better together
        return pa.RecordBatch.from_arrays(
            [pa.array([task << 32 | number]), pa.array([words]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["batch", "n_words", "body"]
        )

    for piece in slices(batches, 64):
        lengths = [len(text) for text in utf8(piece.column("_text"))]
        first = 0
        for i, length in enumerate(lengths):
            if (held or i > first) and size + length > BATCH_BYTES:
                held.append(piece.slice(first, i - first))
                yield row()
                number, held, size, words, first = number + 1, [], 0, 0, i
            size += length
            words += length // 6 + 1
        held.append(piece.slice(first))
    if held:
        yield row()


def unpacked(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


class Words:
    """The words of a batch as one array of hashes, with document limits."""

    def __init__(self, table: pa.Table):
        self.texts = [value or b"" for value in table.column("_text").cast(pa.binary()).to_pylist()]
        lists = [text.split() for text in self.texts]
        self.lists = lists
        self.sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.hashes = word_hashes([word for words in lists for word in words])

    def windows(self, size: int) -> np.ndarray:
        """Starts of all windows of ``size`` words that lie in one document."""
        room = np.maximum(self.sizes - size + 1, 0)
        return np.repeat(self.starts - (np.cumsum(room) - room), room) + np.arange(room.sum())

    def rolling(self, size: int, multiplier: int) -> np.ndarray:
        """A mixed 64-bit hash of the ``size`` words from each place, doubling from powers of two."""
        n = len(self.hashes)
        total, done, power, span = np.zeros(n, np.uint64), 0, self.hashes, 1
        factor = lambda k: np.uint64(pow(multiplier, k, 1 << 64))
        while span <= size:
            if size & span:
                shifted = np.zeros(n, np.uint64)
                shifted[: max(0, n - done)] = power[done:]
                total = total + shifted * factor(done)
                done += span
            later = np.zeros(n, np.uint64)
            later[: max(0, n - span)] = power[span:]
            power = power + later * factor(span)
            span *= 2
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        return total ^ total >> np.uint64(32)


# --- entries and answers -------------------------------------------------------

def pack_places(places: np.ndarray, marks: np.ndarray) -> bytes:
    """Ascending places and two bits of marks each, as bytes that compress well."""
    steps = (np.diff(places, prepend=0) << 2 | marks).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(steps >> 2), steps & 3


def entries(batch: int, places: np.ndarray, hashes: np.ndarray, anchors: np.ndarray, check: np.ndarray | None, buckets: int) -> Iterator[pa.RecordBatch]:
    """Distinct hashes of a batch, packed by bucket: mark 1 for an anchor, 2 for repeated here."""
    if not len(places):
        return
    _, first, inverse, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    marks = np.bincount(inverse[anchors], minlength=len(first)).astype(bool) | (counts > 1).astype(np.int64) << 1
    order = np.argsort(first)
    first, marks = first[order], marks[order]
    values = hashes[first]
    home = ((values >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(home, kind="stable")
    home, first, marks, values = home[by], first[by], marks[by], values[by]
    cuts = np.append(np.flatnonzero(np.diff(home, prepend=-1)), len(home))
    rows = list(zip(cuts[:-1], cuts[1:]))
    low = values.astype("<u4")
    if check is not None:
        wide = np.empty(len(first), "V12")
        raw = wide.view(np.uint8).reshape(-1, 12)
        raw[:, :8], raw[:, 8:] = values.view(np.uint8).reshape(-1, 8), check[first].astype("<u4").view(np.uint8).reshape(-1, 4)
        low = wide
    yield pa.RecordBatch.from_arrays([
        pa.array(home[cuts[:-1]]), pa.array([batch] * len(rows)), pa.array([low[a:b].tobytes() for a, b in rows], pa.binary()),
        pa.array([pack_places(places[first[a:b]], marks[a:b]) for a, b in rows], pa.binary()),
    ], schema=ENTRIES)


def answer(width: int, anchored: bool):
    """For one bucket: the places whose hash is met elsewhere, for each batch."""
    def work(group: pa.Table) -> pa.Table:
        kind = np.dtype("<u4") if width == 4 else np.dtype([("a", "<u8"), ("b", "<u4")])
        keys = np.concatenate([np.frombuffer(x, kind) for x in group.column("keys").to_pylist()])
        parts = [unpack_places(x) for x in group.column("places").to_pylist()]
        places, marks = np.concatenate([p for p, _ in parts]), np.concatenate([m for _, m in parts])
        order = np.argsort(keys) if width == 4 else np.lexsort((keys["b"], keys["a"]))
        keys = keys[order]
        begin = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1)
        counts = np.diff(np.append(begin, len(keys)))
        mark = np.bitwise_or.reduceat(marks[order], begin)
        met = (counts > 1) & (mark & 1 > 0) if anchored else counts > 1
        hit = np.empty(len(keys), bool)
        hit[order] = np.repeat(met | (mark & 2 > 0), counts)
        out, at = [], 0
        for batch, (own, _) in zip(group.column("batch").to_pylist(), parts):
            found = own[hit[at:at + len(own)]]
            at += len(own)
            if len(found):
                out.append((batch, found.astype("<u4").tobytes()))
        return pa.table({"batch": pa.array([b for b, _ in out], pa.int64()), "hits": pa.array([h for _, h in out], pa.binary())})

    return work


def met_elsewhere(rows: DataFrame, width: int, anchored: bool) -> DataFrame:
    found = rows.groupBy("bucket").applyInArrow(answer(width, anchored), "batch long, hits binary")
    return found.groupBy("batch").agg(F.collect_list("hits").alias("hits"))  # at most one place per word of the batch


def hit_mask(words: Words, hashes: np.ndarray, places: np.ndarray, hits: list[bytes] | None) -> np.ndarray:
    """Which of ``places`` have the hash of a hit place."""
    told = np.concatenate([np.frombuffer(x, "<u4") for x in hits]) if hits else np.zeros(0, np.int64)
    return np.isin(hashes[places], hashes[told])


# --- the three passes over the batches -----------------------------------------

def anchor_pass(buckets: int, anchor: int, window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = Words(unpacked(body.as_py()))
                long = np.repeat(words.sizes >= window, words.sizes)  # shorter documents have no window
                places = words.windows(anchor)
                places = places[long[places]]
                home = np.repeat(words.starts, words.sizes)[places]
                hashes = words.rolling(anchor, MULTIPLIER[0])[places]
                yield from entries(name, places, hashes, np.flatnonzero((places - home) % anchor == 0), None, buckets)

    return work


def candidates(words: Words, hits: list[bytes] | None, anchor: int, window: int) -> np.ndarray:
    """Starts of the windows that hold a hit anchor."""
    rolling = words.rolling(anchor, MULTIPLIER[0])
    inner = words.windows(anchor)
    met = np.zeros(len(words.hashes) + 1, np.int64)
    met[inner[hit_mask(words, rolling, inner, hits)] + 1] = 1
    met = np.cumsum(met)
    places = words.windows(window)
    return places[met[places + window - anchor + 1] > met[places]]


def extension_pass(buckets: int, anchor: int, window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body, hits in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                words = Words(unpacked(body.as_py()))
                places = candidates(words, hits, anchor, window)
                yield from entries(
                    name, places, words.rolling(window, MULTIPLIER[0])[places], np.zeros(0, np.int64), words.rolling(window, MULTIPLIER[1])[places], buckets
                )

    return work


def removal_pass(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, hits in zip(batch.column(0), batch.column(1).to_pylist()):
                table = unpacked(body.as_py())
                words = Words(table)
                gone = np.zeros(len(words.hashes) + 1, np.int64)
                if hits:
                    places = words.windows(window)
                    starts = places[hit_mask(words, words.rolling(window, MULTIPLIER[0]), places, hits)]
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + window, -1)
                stays = np.cumsum(gone)[:-1] == 0
                kept, removed = [], []
                for own, s, e in zip(words.lists, words.starts, words.ends):
                    mask = stays[s:e]
                    left = int(mask.sum())
                    removed.append(len(own) - left)
                    kept.append(b" ".join(own if left == len(own) else [own[i] for i in np.flatnonzero(mask)]))
                columns = [c for name, c in zip(table.column_names, table.columns) if name != "_text"]
                out = pa.table(
                    [*columns, pa.array(words.sizes), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=[f"c{i}" for i in range(len(columns))] + ["n_words", "n_removed", "kept"],
                )
                yield from out.combine_chunks().to_batches(max_chunksize=512)

    return work


def drop_repeats(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), text: str = "text", window: int = WINDOW) -> DataFrame:
    """The columns of ``carry`` and, for each row, ``n_words``, ``n_removed`` and ``kept``,
    the words outside every repeated window, joined by one space."""
    anchor = (window + 1) // 2
    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    source = docs.select(*columns, F.col(text).cast("string").alias("_text"))
    batches = stored(arrow_map(source, packed, "batch long, n_words long, body binary"), "batches")
    # A guess of the number of words: it only sets how many buckets share the work.
    buckets = max(1, -(-(batches.agg(F.sum("n_words")).first()[0] or 0) // BUCKET_ENTRIES))
    bodies = batches.select("batch", "body")
    rows = arrow_map(bodies, anchor_pass(buckets, anchor, window), ENTRY_TYPE)
    hits = stored(met_elsewhere(rows, 4, True), "anchor-hits")
    rows = arrow_map(bodies.join(hits, "batch"), extension_pass(buckets, anchor, window), ENTRY_TYPE)
    repeated = stored(met_elsewhere(rows, 12, False), "repeats")
    types = [f"c{i} {source.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(carry))]
    done = arrow_map(bodies.join(repeated, "batch", "left").select("body", "hits"), 
        removal_pass(window), ", ".join([*types, "n_words long", "n_removed long", "kept string"])
    )
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "n_words", "n_removed", "kept")
