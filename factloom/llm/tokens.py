"""Byte-level BPE: encode documents and decode their ids.

A sentencepiece BPE model is serialised straight from a vocabulary of ranks: a piece is
the token's bytes mapped to printable characters, its score the negative rank, and the
normaliser the identity.  Texts are cut into pre-tokens by a pattern, each pre-token is
encoded on its own, and decoding maps pieces back to bytes.

The work is narrow: no shuffle, one Arrow batch of texts in memory.  Null text is empty
text and has no ids; repeated rows are encoded each; other columns are dropped.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from .shared import Memo, arrow_map, arrow_rows, slices

MEMO_ENTRIES = 150_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


def varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol buffer message."""
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def piece_model(tokens: list[bytes]) -> bytes:
    """A serialised model whose piece ids are the ranks; the unknown piece comes last."""
    chars = byte_characters()
    pieces = [
        field(1, field(1, "".join(map(chars.__getitem__, token)).encode()) + field(2, float(-rank)) + field(3, 1))
        for rank, token in enumerate(tokens)
    ]
    unknown = field(1, field(1, b"<unk>") + field(2, 0.0) + field(3, 2))
    trainer = field(2, field(3, 2) + field(4, len(tokens) + 1) + field(40, len(tokens)))
    # No -1 for absent control ids: they are read only if a piece has their type.
    normaliser = field(3, field(1, b"identity") + field(3, 0) + field(4, 0) + field(5, 0))
    return b"".join(pieces) + unknown + trainer + normaliser


class Codec:
    """Encoder and decoder of one vocabulary file (base64 token and rank per line)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = sorted(ranks, key=ranks.__getitem__)
        self.whole = {token.decode(): struct.pack("<I", rank) for token, rank in ranks.items() if valid(token)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=piece_model(self.tokens))
        self.table = dict(enumerate(byte_characters()))
        self.find = regex.compile(pattern).findall
        self.memo = Memo(self.pieces)

    def pieces(self, pre_token: str) -> bytes:
        # A pre-token that is a token is that token, also where merges would miss it.
        if found := self.whole.get(pre_token):
            return found
        ids = self.model.encode(pre_token.encode().decode("latin-1").translate(self.table))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        return b"".join(map(self.memo.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def valid(token: bytes) -> bool:
    try:
        return bool(token.decode())
    except UnicodeDecodeError:
        return False


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers)."""
    out = pa.schema([(key, pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(path, pattern)
        for batch in slices(batches):
            ids = [model.encode(value or "") for value in batch.column(1).to_pylist()]
            yield arrow_rows(out, **{key: batch.column(0)}, n_tokens=[len(x) // 4 for x in ids], ids=ids)

    return arrow_map(docs.select(docs[key].cast("long").alias(key), docs[text]), encode, f"`{key}` long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """The columns of ``encode_documents`` and ``decoded``, the bytes that the ids stand for."""
    out = pa.schema([(key, pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(path, pattern)
        for batch in slices(batches):
            ids = [x or b"" for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([model.decode(x) for x in ids], pa.binary())], schema=out
            )

    return arrow_map(encoded.select(key, "n_tokens", "ids"), decode, f"`{key}` long, n_tokens long, ids binary, decoded binary")
