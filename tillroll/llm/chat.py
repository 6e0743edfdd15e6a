"""Chats as training text: typed content parts flattened to ordered placeholders, with a loss mask.

A message is a list of typed parts (text, image, audio, document).  A visitor with one method per
type writes each part in order: text is escaped, any other part becomes a numbered placeholder,
its reference and its expanded token count go to the list of attachments.

Control strings that stand in a text are made harmless by a backslash after their first
character; one that already has backslashes there gets one more, so the step can be undone.

A conversation is the concatenation of its turns in order.  The output keeps one row per turn with
its place in the conversation, so a conversation of any length is never gathered into one value:
turns are ordered by a window of running sums, and read back as a sorted stream.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import fresh

# The marks of the template, and further control strings that models know.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
LEARNT_ROLES = ("assistant",)
_OPEN = re.compile(r"([<\[])(\\*)(\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)")
_SHUT = re.compile(r"([<\[])\\(\\*)(\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)")

IMAGE_TILE, IMAGE_TILE_TOKENS, IMAGE_BASE_TOKENS = 512, 170, 85
AUDIO_TOKENS_PER_SECOND, DOCUMENT_TOKENS_PER_PAGE = 25, 800

PART = ("struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>")
ATTACHMENT = "struct<n: int, type: string, ref: string, tokens: bigint>"


def escape(text: str) -> str:
    """A text in which no control string is left; ``unescape`` gives the text again."""
    return _OPEN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"\1\2\3", text)


@dataclass
class Flattener:
    """Visits the parts of one message; attachments are numbered from 1 within it."""

    text: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part["type"] or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.text.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil(max(1, part[side] or 1) / IMAGE_TILE) for side in ("width", "height"))
        self.attach("image", part, IMAGE_BASE_TOKENS + IMAGE_TILE_TOKENS * across * down)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, math.ceil(max(0.0, part["seconds"] or 0.0) * AUDIO_TOKENS_PER_SECOND))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, max(1, part["pages"] or 1) * DOCUMENT_TOKENS_PER_PAGE)

    def visit_unknown(self, part: dict) -> None:
        raise ValueError(f"no rule for a part of type {part['type']!r}")

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"n": len(self.attachments) + 1, "type": kind, "ref": part["ref"], "tokens": tokens})
        self.text.append(f"<|{kind}_{len(self.attachments)}|>")


def formatted_turns(messages: DataFrame) -> DataFrame:
    """conv_id, turn, n (from 0), segment, start, loss_start, loss_end, attachments, expanded_tokens.

    ``messages`` has conv_id, turn, role and ``parts``, an array of ``PART``.  Turns follow ``turn``,
    then role and text; a null turn comes first, a null role or text is empty, null or
    empty parts give an empty message, and rows without a conv_id are one conversation.  A part
    without a type is text; an unknown type is refused.  ``start`` is the code point at which the
    segment begins in its conversation; the loss span counts from there and is null for
    roles that are not learnt.  ``expanded_tokens`` sums the attachments.  Other columns are
    ignored; repeated rows are turns of their own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for role, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                visitor = Flattener()
                for part in parts or []:
                    if part is not None:
                        visitor.visit(part)
                head = f"{TURN}{escape(role or '')}{BODY}"
                body = "".join(visitor.text)
                learnt = (role or "") in LEARNT_ROLES
                made.append((head + body + END, len(head) + len(body) + len(END),
                             len(head) if learnt else None, len(head) + len(body) if learnt else None,
                             visitor.attachments, sum(a["tokens"] for a in visitor.attachments)))
            cols = list(zip(*made, strict=True)) if made else [[]] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(),
                     pa.list_(pa.struct([("n", pa.int32()), ("type", pa.string()), ("ref", pa.string()),
                                         ("tokens", pa.int64())])), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True))],
                names=["conv_id", "turn", "segment", "chars", "loss_start", "loss_end", "attachments", "expanded_tokens"])

    base = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("parts").cast(f"array<{PART}>").alias("parts"))
    rows = base.mapInArrow(
        run, "conv_id long, turn long, segment string, chars long, loss_start long, loss_end long, "
        f"attachments array<{ATTACHMENT}>, expanded_tokens long")
    order = Window.partitionBy("conv_id").orderBy("turn", "segment")
    before = F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return rows.select(
        "conv_id", "turn", (F.row_number().over(order) - 1).cast("long").alias("n"), "segment",
        F.coalesce(before, F.lit(0)).alias("start"), "loss_start", "loss_end", "attachments", "expanded_tokens")


_SEGMENT = re.compile(re.escape(TURN) + "(.*?)" + re.escape(BODY) + "(.*?)" + re.escape(END), re.DOTALL)


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars per conversation.

    Parses the formatted segments: role and text are recovered from the marks, the loss text from
    the loss span.  Rows of a conversation arrive in one task, in order, and are hashed as they come.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        open_: list = []

        def done() -> list:
            conv, n, turns, loss_chars, loss, chars = open_
            return [conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]

        for batch in batches:
            ready = []
            for conv, segment, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not open_ or open_[0] != conv:
                    ready += [done()] if open_ else []
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = map(unescape, _SEGMENT.fullmatch(segment).groups())
                open_[1] += 1
                open_[2].update(f"{role}\n{text}\n".encode())
                if low is not None:
                    learnt = unescape(segment[low:high])
                    open_[3] += len(learnt)
                    open_[4].update(learnt.encode())
                open_[5] += len(segment)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in ready], f.type) for k, f in enumerate(schema)], schema=schema)
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(done(), schema, strict=True)],
                                             schema=schema)

    # the window has dealt and sorted the rows by conversation, so this adds no exchange
    ordered = formatted.select("conv_id", "segment", "loss_start", "loss_end", "n")
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "n").drop("n")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")


def text_parts(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as messages of one text part each."""
    part = F.named_struct(
        F.lit("type"), F.lit("text"), F.lit("text"), F.col("text").cast("string"), F.lit("ref"),
        F.lit(None).cast("string"), F.lit("width"), F.lit(None).cast("int"), F.lit("height"), F.lit(None).cast("int"),
        F.lit("seconds"), F.lit(None).cast("double"), F.lit("pages"), F.lit(None).cast("int"))
    name = fresh(rows, "parts")
    return rows.withColumn(name, F.array(part)).select("conv_id", "turn", "role", F.col(name).alias("parts"))
