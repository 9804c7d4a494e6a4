"""Benchmark decontamination with one Aho-Corasick automaton over word windows.

Words are runs of letters, digits and non-ASCII characters, lower-cased in A-Z.  A window
is ``size`` consecutive words of an item; a shorter item is one window.  Each distinct
benchmark word becomes one symbol, windows become strings of symbols, and one pass of the
automaton over a document's symbols finds every occurrence.  Normalising keeps the length
in bytes, so word offsets are offsets in the original UTF-8 text.

The benchmark is cut into blocks of a bounded number of words, each small enough to send
to every executor; documents pass one automaton per block in one narrow pass, without a
shuffle.  Null texts have no words; items without words match nothing; rows with the same
id are judged each; a null item id marks words but is not listed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import arrow_map, slices, utf8

WORDS_PER_BLOCK = 400_000
SURROGATES = range(0xD800, 0xE000)

# Every ASCII byte but letters and digits separates words; A-Z becomes a-z.
NORMAL = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)
NO_WORD = "\x00"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Windows:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[int, bytes]], size: int):
        self.symbols: dict[bytes, str] = {}
        windows: dict[str, list[int]] = {}
        for number, (_, text) in enumerate(items):
            code = "".join(map(self.symbol, words_of(text)))
            for start in range(max(1, len(code) - size + 1) if code else 0):
                found = windows.setdefault(code[start:start + size], [])
                if number not in found[-1:]:
                    found.append(number)
        self.items = [item for item, _ in items]
        self.automaton = ahocorasick.Automaton()
        for window, numbers in windows.items():
            self.automaton.add_word(window, (len(window), numbers))
        if windows:
            self.automaton.make_automaton()

    def symbol(self, word: bytes) -> str:
        if word not in self.symbols:
            code = len(self.symbols) + 1
            self.symbols[word] = chr(code if code < SURROGATES.start else code + len(SURROGATES))
        return self.symbols[word]

    def find(self, words: list[bytes], hit: bytearray) -> set[int]:
        """Marks hit words; the numbers of the items that have an occurring window."""
        found: set[int] = set()
        if len(self.automaton):
            for end, (length, numbers) in self.automaton.iter("".join(map(self.symbols.get, words, repeat(NO_WORD)))):
                hit[end - length + 1:end + 1] = b"\x01" * length
                found.update(numbers)
        return found


def hit_spans(text: bytes, hit: bytearray) -> list[dict]:
    """Runs of hit words as byte ranges of the original text."""
    normal = np.frombuffer(text.translate(NORMAL), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(normal, prepend=False, append=False))
    marks = np.diff(np.frombuffer(hit, np.int8), prepend=0, append=0)
    return [
        {"start": int(edges[2 * first]), "end": int(edges[2 * last - 1])}
        for first, last in zip(np.flatnonzero(marks == 1), np.flatnonzero(marks == -1))
    ]


BUILT: dict[str, Windows] = {}


def find_passages(docs: DataFrame, benchmark: DataFrame, size: int = 10, key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the columns of ``carry``, ``n_words``, ``n_hit``, ``items`` (found item
    ids, ascending) and ``spans`` (byte ranges of hit words in the text)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    n_words = items.agg(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\x80-\\x{10FFFF}]+")))).first()[0] or 0
    blocks = max(1, -(-n_words // WORDS_PER_BLOCK))
    kept = list(dict.fromkeys([key, *carry]))
    work = docs.select(F.col("text").cast("string").alias("_text"), *[F.col(c) for c in kept]).select(
        F.struct(*kept).alias("row"), F.col("_text").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("binary").alias("hit"), F.array().cast("array<long>").alias("items"),
    )
    result = (
        f"row {work.schema['row'].dataType.simpleString()}, n_words long, n_hit long, items array<long>, spans array<struct<start: long, end: long>>"
    )
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        # Bounded: about WORDS_PER_BLOCK words.
        sent = docs.sparkSession.sparkContext.broadcast([(r.item_id, r.text.encode()) for r in part.collect()])
        last = block == blocks - 1
        work = arrow_map(work, block_scan(sent, uuid.uuid4().hex, size, last), result if last else work.schema)
    return work.select("row.*", "n_words", "n_hit", F.array_sort(F.array_distinct("items")).alias("items"), "spans")


def block_scan(sent, name: str, size: int, last: bool):
    """The pass of one block: marks so far go in and out; the last one turns them into spans."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in BUILT:
            if len(BUILT) > 8:
                BUILT.clear()
            BUILT[name] = Windows(sent.value, size)
        windows = BUILT[name]
        for batch in slices(batches):
            counts, hits, found = [], [], []
            texts = utf8(batch.column(1))
            for text, hit, items in zip(texts, batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                words = words_of(text)
                marks = bytearray(hit) if hit else bytearray(len(words))
                more = {windows.items[n] for n in windows.find(words, marks)}
                counts.append(len(words))
                hits.append(bytes(marks) if 1 in marks else None)
                found.append(items + [x for x in more if x is not None])
            counts, found = pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.int64()))
            if last:
                spans = [hit_spans(text, bytearray(hit)) if hit else [] for text, hit in zip(texts, hits)]
                hit_counts = pa.array([hit.count(1) if hit else 0 for hit in hits], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), counts, hit_counts, found, pa.array(spans, pa.list_(span))], names=["row", "n_words", "n_hit", "items", "spans"]
                )
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), counts, pa.array(hits, pa.binary()), found], names=["row", "text", "n_words", "hit", "items"]
                )

    return scan
