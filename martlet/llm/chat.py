r"""Chat formatting of conversations whose turns hold typed content parts.

A visitor flattens the text, image, audio and document parts of a turn into one string: text as
it is, attachments as numbered placeholders. For each attachment it records the reference, the
place in the string and the number of tokens that the placeholder stands for. Turns become

    <|im_start|>role\ncontent<|im_end|>\n

and the loss mask covers the texts of assistant turns, not the placeholders between them. Control strings inside a text are made
harmless by a backslash between ``<`` and ``|``; one more is added where some stand there
already, so the change can be undone exactly.

Turns are formatted row by row. What needs a conversation in order (digests over its turns) is
read back by tasks that stream through sorted rows and keep only running digests and counts, so
a conversation may hold any number of turns.

Defined results: a null text, a null list of parts and an empty one are empty content; a null
role is the empty role. Turns come by ``turn``, a null first; equal turns by their formatted
text. Rows without a ``conv_id`` form one conversation whose id is null. A part of another type
fails with its name. An empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
PARTS = (
    "array<struct<type: string, text: string, ref: string, width: int, height: int, "
    "seconds: double, pages: int>>"
)
_TURN = (
    "segment string, loss array<struct<start: long, stop: long>>, tokens_expanded long, "
    "attachments array<struct<number: int, type: string, ref: string, offset: long, tokens: long>>"
)
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_SEGMENT = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


@dataclass
class PartVisitor:
    """Collects the content of one turn."""

    patch: int = 14
    tokens_per_second: float = 25.0
    tokens_per_page: int = 512
    content: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    texts: list[dict] = field(default_factory=list)
    length: int = 0
    pending: str = ""

    def visit(self, part: dict) -> None:
        method = getattr(self, f"visit_{part['type']}", None)
        if method is None:
            raise ValueError(f"unknown type of content part: {part['type']}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.pending += part["text"] or ""

    def visit_image(self, part: dict) -> None:
        across, down = part["width"] or 0, part["height"] or 0
        self._attach(part, math.ceil(across / self.patch) * math.ceil(down / self.patch))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part["seconds"] or 0) * self.tokens_per_second))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part["pages"] or 0) * self.tokens_per_page)

    def finish(self) -> None:
        """Write the text that waits: texts in a row are one, so no control string forms at a seam."""
        if self.pending:
            start = self.length
            self._write(escape(self.pending))
            self.texts.append({"start": start, "stop": self.length})
            self.pending = ""

    def _attach(self, part: dict, tokens: int) -> None:
        self.finish()
        number = len(self.attachments)
        self.attachments.append(
            {
                "number": number,
                "type": part["type"],
                "ref": part["ref"],
                "offset": self.length,
                "tokens": tokens,
            }
        )
        self._write(f"<|{part['type']}_{number}|>")

    def _write(self, text: str) -> None:
        self.content.append(text)
        self.length += len(text)


def format_turn(role: str | None, parts: list[dict] | None) -> dict:
    """One turn: its text, the loss spans in code points, and its attachments."""
    head = f"{OPEN}{_role_line(role or '')}\n"
    visitor = PartVisitor(length=len(head))
    for part in parts if parts is not None else []:
        visitor.visit(part)
    visitor.finish()
    return {
        "segment": f"{head}{''.join(visitor.content)}{CLOSE}\n",
        "loss": visitor.texts if role == "assistant" else [],
        "tokens_expanded": sum(a["tokens"] for a in visitor.attachments),
        "attachments": visitor.attachments,
    }


def text_part(text: Column) -> Column:
    """A list of parts that holds one text."""
    nothing = [F.lit(None).alias(name) for name in ("ref", "width", "height", "seconds", "pages")]
    one = F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), *nothing)
    return F.array(one).cast(PARTS)


def format_turns(
    messages: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
) -> DataFrame:
    """``conv_id, turn, segment, loss, tokens_expanded, attachments`` by turn.

    The formatted conversation is its segments in order, put together.
    """

    @F.pandas_udf(_TURN)
    def turns(roles: pd.Series, parts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            [format_turn(role, some) for role, some in zip(roles, parts, strict=True)],
            columns=["segment", "loss", "tokens_expanded", "attachments"],
        )

    done = turns.asNondeterministic()(F.col(role_col), F.col(parts_col).cast(PARTS))
    return messages.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), done.alias("_done")
    ).select("conv_id", "turn", "_done.*")


class _Reader:
    """Running digests of one conversation, read from its formatted turns."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, loss: list[dict]) -> None:
        match = _SEGMENT.fullmatch(segment)
        if match is None:
            raise ValueError("a turn that was not written by this template")
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{_role_of(match[1])}\n{unescape(match[2])}\n".encode())
        for span in loss:
            lost = unescape(segment[span["start"] : span["stop"]])
            self.loss_chars += len(lost)
            self.loss.update(lost.encode())

    def row(self) -> tuple:
        digests = self.all.hexdigest(), self.loss.hexdigest()
        return self.conv_id, self.turns, digests[0], self.loss_chars, digests[1], self.chars


def read_conversations(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from formatted turns.

    ``conv_id, n_turns, turns_sha256`` (role, newline, text, newline per turn), ``loss_chars,
    loss_sha256`` (the text under the loss mask) and ``formatted_chars``.
    """
    fields = [turns.schema["conv_id"]]
    for name in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"):
        fields.append(StructField(name, StringType() if "sha256" in name else LongType()))
    names = [f.name for f in fields]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, kind = None, None
        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            for conv_id, *turn in zip(*(column.to_pylist() for column in batch.columns)):
                if reader is None or reader.conv_id != conv_id:
                    done += [reader.row()] if reader else []
                    reader = _Reader(conv_id)
                reader.add(*turn)
            yield _batch(done, names, kind)
        if reader:
            yield _batch([reader.row()], names, kind)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    wanted = ordered.select("conv_id", "segment", "loss")
    return wanted.mapInArrow(read, StructType(fields))


def _batch(rows: list[tuple], names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)
