"""Chat formatting of typed content parts.

A message has a role and parts.  A visitor flattens the parts in order: text is escaped,
an image, an audio clip or a document becomes a placeholder that carries its number in the
conversation; its reference and expanded token count are recorded.  The template is::

    <|im_start|>role\\n ... parts ... <|im_end|>\\n

Control strings start with ``<|``.  Inside texts, ``<``, any backslashes and ``|`` in a row
get one backslash more, so no text holds a control string and reading takes it off again.
Roles are escaped alike, with line breaks written as ``\\n``.

Formatting is one row per turn without a shuffle; conversations are read turn by turn from
sorted partitions, so that memory does not grow with a conversation.  Null texts and roles
are empty; null parts and parts of no known type add nothing; equal turn numbers are
ordered by role and text; a null conversation is one conversation.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import arrow_map, slices

START, END = "<|im_start|>", "<|im_end|>"
PATCH = 28  # pixels a side that one image token stands for
AUDIO_RATE = 25  # tokens a second
PAGE_TOKENS = 512  # tokens a document page
PART_TYPE = "type string, text string, ref string, width int, height int, seconds double, pages int"
ATTACHMENT = "type string, ref string, place long, tokens long"
CONTROL = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")
TURN = re.compile(re.escape(START) + r"(.*?)\n(.*)" + re.escape(END) + r"\n", re.DOTALL)


def escape(text: str) -> str:
    return CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class PartVisitor:
    """Flattens the parts of one message, in order."""

    def __init__(self):
        self.out: list[str] = []
        self.attachments: list[dict] = []
        self.size = 0

    def visit(self, part: dict | None) -> None:
        if part:
            getattr(self, f"visit_{part.get('type')}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.add(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        sides = [math.ceil((part.get(side) or 0) / PATCH) for side in ("width", "height")]
        self.attach("image", part, max(1, sides[0] * sides[1]))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * AUDIO_RATE)))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, max(1, part.get("pages") or 0) * PAGE_TOKENS)

    def visit_other(self, part: dict) -> None:
        pass

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"type": kind, "ref": part.get("ref"), "place": self.size, "tokens": tokens})
        self.add(f"<|{kind}:{len(self.attachments)}|>")

    def add(self, text: str) -> None:
        self.out.append(text)
        self.size += len(text)


def format_turns(messages: DataFrame) -> DataFrame:
    """Messages have ``conv_id``, ``turn``, ``role`` and ``parts`` (structs of PART_TYPE).

    Returns ``conv_id``, ``turn``, ``formatted``, ``loss_start`` and ``loss_end`` (code
    points of the formatted turn that are learned: what an assistant says) and
    ``attachments`` (places are offsets in the body).
    """
    attachment = pa.struct([("type", pa.string()), ("ref", pa.string()), ("place", pa.int64()), ("tokens", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            formatted, starts, ends, attached = [], [], [], []
            for role, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                visitor = PartVisitor()
                for part in parts or []:
                    visitor.visit(part)
                head = f"{START}{escape_role(role or '')}\n"
                formatted.append("".join([head, *visitor.out, END, "\n"]))
                starts.append(len(head))
                ends.append(len(head) + (visitor.size if role == "assistant" else 0))
                attached.append(visitor.attachments)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(formatted), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(attached, pa.list_(attachment))],
                names=["conv_id", "turn", "formatted", "loss_start", "loss_end", "attachments"],
            )

    source = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), "parts"
    )
    return arrow_map(source, work, f"conv_id long, turn long, formatted string, loss_start long, loss_end long, attachments array<struct<{ATTACHMENT.replace(' string', ': string').replace(' long', ': long')}>>")


def text_messages(turns: DataFrame) -> DataFrame:
    """Rows of role and text as messages of one text part."""
    part = F.from_json(F.lit("{}"), PART_TYPE).withField("type", F.lit("text")).withField("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    return turns.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn; placeholders stay in the text."""
    role, body = TURN.fullmatch(formatted).groups()
    return unescape_role(role), unescape(body)


class Digest:
    """What a conversation holds, added up turn by turn."""

    def __init__(self):
        self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, formatted: str, start: int, end: int) -> None:
        role, text = read_turn(formatted)
        learned = unescape(formatted[start:end])
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(learned.encode())
        self.n += 1
        self.loss_chars += len(learned)
        self.chars += len(formatted)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read from formatted turns: ``n_turns``, ``turns_sha256``,
    ``loss_chars``, ``loss_sha256`` and ``formatted_chars``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        done: list[tuple] = []

        def close():
            done.append((now[0], digest.n, digest.turns.hexdigest(), digest.loss_chars, digest.loss.hexdigest(), digest.chars))

        for batch in slices(batches):
            for conv, *turn in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now != (conv,):
                    if digest:
                        close()
                    now, digest = (conv,), Digest()
                digest.add(*turn)
            yield rows(done)
            done.clear()
        if digest:
            close()
            yield rows(done)

    def rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=names)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return arrow_map(ordered.select("conv_id", "formatted", "loss_start", "loss_end"), 
        work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
