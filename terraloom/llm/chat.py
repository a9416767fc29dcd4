"""Chat formatting with typed content parts.

A visitor flattens each turn's parts, in order: text is escaped and kept, an image, audio or
document part becomes a placeholder, and its reference, place and expanded token count are
recorded. A turn is written ``<|turn|>role<|body|>body<|end|>`` and a line feed; control
strings inside roles and texts are escaped reversibly: a filler character is put behind the
first character of each, one more than it has already, so no control string is left and the
original comes back by taking one filler away. The loss mask covers the text (not the
placeholders) of the roles in ``trained``.

Null texts, roles and part lists are empty. A part of an unknown kind is an attachment of
one token. Turns are ordered by (turn, role, text), nulls first; equal rows are separate
turns. Rows with a null ``conv_id`` form one conversation.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

FILLER = "​"
#: Strings with a meaning in this template or in common others; none overlaps another.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>\n"

PART = StructType([StructField("kind", StringType()), StructField("text", StringType()), StructField("ref", StringType()), StructField("width", IntegerType()), StructField("height", IntegerType()), StructField("seconds", DoubleType()), StructField("pages", IntegerType())])
ATTACHMENT = StructType([StructField("kind", StringType()), StructField("ref", StringType()), StructField("at", IntegerType()), StructField("tokens", LongType())])
SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
_ARROW_ATTACHMENT = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int32()), ("tokens", pa.int64())])
_ARROW_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


@dataclass(frozen=True)
class ChatParams:
    trained: tuple[str, ...] = ("assistant",)
    patch: int = 14  # pixels a side that make an image token
    audio_rate: float = 25.0  # tokens a second
    page_tokens: int = 512  # of a document's page


def _pattern(fillers: str) -> re.Pattern:
    for a in CONTROL:
        for b in CONTROL:
            if any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))) or (a != b and a in b):
                raise ValueError(f"control strings {a!r} and {b!r} overlap")
    return re.compile("|".join(f"({re.escape(c[0])})({FILLER}{fillers})({re.escape(c[1:])})" for c in CONTROL))


_ANY, _SOME = _pattern("*"), _pattern("+")


def escape(text: str | None) -> str:
    return _ANY.sub(lambda m: m[0][0] + FILLER + m[0][1:], text or "")


def unescape(text: str) -> str:
    return _SOME.sub(lambda m: m[0][0] + m[0][2:], text)


class PartVisitor:
    """Writes one turn; ``out`` is its text, ``spans`` the code points under the loss mask."""

    def __init__(self, role: str | None, p: ChatParams):
        self.p, self.trained = p, (role or "") in p.trained
        self.out, self.size = [], 0
        self.attachments, self.spans = [], []
        self._put(f"{TURN}{escape(role)}{BODY}")

    def _put(self, s: str) -> None:
        self.out.append(s)
        self.size += len(s)

    def visit(self, part: dict | None) -> None:
        kind = (part or {}).get("kind")
        if part is not None:
            getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        start, s = self.size, escape(part.get("text"))
        self._put(s)
        if self.trained and s:
            self.spans.append((start, self.size))

    def _attach(self, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": part.get("kind"), "ref": part.get("ref"), "at": self.size, "tokens": tokens})
        name = part["kind"] if part.get("kind") in ("image", "audio", "document") else "other"
        self._put(f"<|{name}:{len(self.attachments) - 1}|>")

    def visit_image(self, part: dict) -> None:
        self._attach(part, math.ceil((part.get("width") or 0) / self.p.patch) * math.ceil((part.get("height") or 0) / self.p.patch))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part.get("seconds") or 0) * self.p.audio_rate))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part.get("pages") or 0) * self.p.page_tokens)

    def visit_other(self, part: dict) -> None:
        self._attach(part, 1)

    def finish(self) -> str:
        self._put(END)
        return "".join(self.out)


def _joined_text(parts: list[dict]) -> list[dict]:
    """Neighbouring text parts as one, so that no control string can form across them."""
    out: list[dict] = []
    for part in parts:
        if part and part.get("kind") == "text" and out and out[-1].get("kind") == "text":
            out[-1] = {**out[-1], "text": (out[-1].get("text") or "") + (part.get("text") or "")}
        elif part:
            out.append(part)
    return out


def format_turns(messages: DataFrame, p: ChatParams = ChatParams()) -> DataFrame:
    """messages (conv_id, turn, role, parts) as (conv_id, turn, role, formatted, spans, attachments, attachment_tokens)."""
    schema = StructType([*messages.select("conv_id", "turn", "role").schema.fields, StructField("formatted", StringType()), StructField("spans", ArrayType(SPAN)), StructField("attachments", ArrayType(ATTACHMENT)), StructField("attachment_tokens", LongType())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                text, spans, attached = [], [], []
                for role, parts in zip(part.column(2), part.column(3), strict=True):
                    v = PartVisitor(role.as_py(), p)
                    for x in _joined_text(parts.as_py() or []):
                        v.visit(x)
                    text.append(v.finish())
                    spans.append([{"start": a, "end": b} for a, b in v.spans])
                    attached.append(v.attachments)
                tokens = [sum(x["tokens"] for x in a) for a in attached]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(text, pa.string()), pa.array(spans, pa.list_(_ARROW_SPAN)), pa.array(attached, pa.list_(_ARROW_ATTACHMENT)), pa.array(tokens, pa.int64())], names=schema.names)

    return messages.select("conv_id", "turn", "role", "parts").mapInArrow(run, schema)


_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(BODY) + "(.*)" + re.escape(END), re.S)
_PLACEHOLDER = re.compile(r"<\|(?:image|audio|document|other):\d+\|>")


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn, unescaped; placeholders are left out."""
    m = _TURN.fullmatch(formatted)
    return unescape(m[1]), "".join(unescape(x) for x in _PLACEHOLDER.split(m[2]))


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from the formatted turns in order.

    Turns are hashed as they stream by in sorted order, so a conversation of any length
    needs constant memory.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, attachment_tokens long"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        key, state = object(), None

        def row():
            return (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

        for batch in batches:
            done = []
            for conv, formatted, spans, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or conv != key:
                    if state is not None:
                        done.append(row())
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                role, text = read_turn(formatted)
                loss = "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                state[2] += len(loss)
                state[3].update(loss.encode("utf-8", "surrogatepass"))
                state[4] += len(formatted)
                state[5] += tokens
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], names=names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row(), kinds, strict=True)], names=names)

    order = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return order.select(F.col("conv_id").cast("long"), "formatted", "spans", "attachment_tokens").mapInArrow(run, schema)


def from_texts(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) of plain rows (conv_id, turn, role, text): each text is one part."""
    null = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in PART.fields}
    part = F.struct(*[F.lit("text").alias("kind"), F.col("text").alias("text"), *(null[n] for n in ("ref", "width", "height", "seconds", "pages"))])
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))
