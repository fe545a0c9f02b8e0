"""Chat formatting: a state machine over roles and a declarative template.

A conversation is read turn by turn from a stream sorted by conversation, so a task holds one turn
and a few counters however long a conversation is.  ``format_chats`` emits text segments, each with
its loss flag; the concatenated segments of a conversation are its formatted text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The turn marks of the template.
START, END = "<|im_start|>", "<|im_end|>"

_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")


@dataclass(frozen=True)
class Template:
    """What stands around a turn, which turn may follow which, and which texts are learned."""

    before_role: str = START
    after_role: str = "\n"
    after_text: str = END + "\n"
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    learned: tuple[str, ...] = ("assistant",)


CHAT = Template()
SEGMENTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn_no", pa.int64()),
        ("part", pa.string()),
        ("segment", pa.string()),
        ("loss", pa.bool_()),
        ("in_order", pa.bool_()),
    ]
)
DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("valid", pa.bool_()),
    ]
)
SEGMENT_DDL = "conv_id long, turn_no long, part string, segment string, loss boolean, in_order boolean"
DIGEST_DDL = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)


def escape(text: str) -> str:
    """Break up every ``<|`` with one more backslash than the text has there."""
    return _ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def segments_of(turns: Iterator[tuple], template: Template = CHAT) -> Iterator[tuple]:
    """Segments of a stream of (conv_id, role, text) in conversation order.

    ``in_order`` says whether the machine has a move for the turn; once it has none, the
    conversation stays out of order to its end.  Nothing is dropped.
    """
    current: object = segments_of
    state: str | None = ""
    number = 0
    for conv_id, role, text in turns:
        if conv_id != current:
            current, state, number = conv_id, "", 0
        role, text = role or "", text or ""
        state = role if state is not None and role in template.follows.get(state, ()) else None
        ok = state is not None
        yield conv_id, number, "open", template.before_role + escape_role(role) + template.after_role, False, ok
        yield conv_id, number, "text", escape(text), role in template.learned, ok
        yield conv_id, number, "close", template.after_text, False, ok
        number += 1


def format_chats(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per segment of the formatted conversations, in order within each partition.

    A null text or role is empty; a null id is a conversation of its own; rows of the same turn
    (ties, repeated rows) are turns ordered by role and text; extra columns are not read; an empty
    table gives no rows.  Turns that the role machine does not allow are formatted all the same and
    marked ``in_order = false`` from there on.
    """
    turns = (
        conversations.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select(F.col("conv_id").cast("long"), "role", "text")
    )

    def run(batches):
        return _batched(segments_of(_rows(batches), template), SEGMENTS)

    return turns.mapInArrow(run, SEGMENT_DDL)


def digests_of(segments: Iterator[tuple], template: Template = CHAT) -> Iterator[tuple]:
    """Read formatted text back: one digest row per conversation.

    Roles and texts come from parsing the concatenated segments, the learned text from the flags.
    """
    current: object = digests_of
    out: list = []
    buffer = ""
    for conv_id, _, _, segment, loss, ok in segments:
        if conv_id != current:
            if out:
                yield _digest(current, out)
            current, out, buffer = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, True], ""
        out[4] += len(segment)
        out[5] = out[5] and ok
        if loss:
            learned = unescape(segment)
            out[2] += len(learned)
            out[3].update(learned.encode())
        buffer += segment
        if not buffer.endswith(template.after_text):
            continue
        body = buffer.removeprefix(template.before_role).removesuffix(template.after_text)
        role, _, text = body.partition(template.after_role)
        out[0] += 1
        out[1].update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
        buffer = ""
    if out:
        yield _digest(current, out)


def _digest(conv_id, out) -> tuple:
    return conv_id, out[0], out[1].hexdigest(), out[2], out[3].hexdigest(), out[4], out[5]


def chat_digests(segments: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per conversation, read back from the partitions ``format_chats`` made."""

    def run(batches):
        return _batched(digests_of(_rows(batches), template), DIGESTS)

    return segments.mapInArrow(run, DIGEST_DDL)
