"""Chat formatting with any template, and where each turn lies in its output.

A template is a black box from a list of turns to text. Successive prefixes of a conversation are rendered and consecutive
outputs compared: what a turn adds is its span, and an output that does not begin with the one before it shows a template
that rewrites history. Two probe texts in a turn's place tell its header and footer from its content. Conversations stream
through sorted partitions, so one with very many turns is never held whole: beyond ``window`` turns, the prefixes begin
``window`` turns back, and that the template does not look further is verified on the turns that overlap.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

_TURN = re.compile(r"### ((?:[^\\#<:]++|\\.)*+): ((?:[^\\#<]++|\\.)*+)</turn>\n", re.S)


def escape(text: str) -> str:
    """No control string of :func:`plain_template` is left in the result."""
    return re.sub(r"[\\#<]", r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def plain_template(turns: list[Turn]) -> str:
    """``### role: text</turn>`` and a line feed per turn; ``\\``, ``#``, ``<`` (in roles also ``:``) get a ``\\`` before them."""
    return "".join([f"### {escape(role).replace(':', chr(92) + ':')}: {escape(text)}</turn>\n" for role, text in turns])


def parse_plain(text: str) -> Iterator[tuple[int, str, str]]:
    """(end, role, text) of the whole turns at the head of ``text``."""
    at = 0
    while (turn := _TURN.match(text, at)) is not None:
        at = turn.end()
        yield at, unescape(turn[1]), unescape(turn[2])


class HistoryRewritten(ValueError):
    """The template changed what it had rendered of earlier turns."""


def _common(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


class Renderer:
    """The spans of one conversation, turn by turn."""

    def __init__(self, template: Template, window: int):
        self._template, self._window = template, window
        self._turns: list[Turn] = []
        self._pieces: list[str] = []
        self._text = template([])
        self._frames: dict[str, tuple[str, str]] = {}
        self.length = len(self._text)
        self.opening = self._text

    def _grow(self, turn: Turn) -> tuple[str, bool]:
        text = self._template([*self._turns, turn])
        rewrote = not text.startswith(self._text)
        piece = text[_common(text, self._text) if rewrote else len(self._text) :]
        self._turns.append(turn)
        self._pieces.append(piece)
        self._text = text
        return piece, rewrote

    def _slide(self) -> None:
        """Begin anew half a window back; the overlap must render as before, but for an opening before its first turn."""
        turns, pieces = self._turns[-self._window // 2 :], self._pieces[-self._window // 2 :]
        self._turns, self._pieces, self._text = [], [], self._template([])
        for turn, piece in zip(turns, pieces):
            again, _ = self._grow(turn)
            if len(self._turns) > 1 and again != piece:
                raise ValueError(f"the template looks back more than {self._window // 2} turns; use a larger window")

    def _frame(self, role: str, piece: str) -> tuple[int, int]:
        """Lengths of header and footer of the last turn's piece."""
        header, footer = self._frames.get(role, ("", ""))
        known = role in self._frames and len(piece) >= len(header) + len(footer) and piece.startswith(header) and piece.endswith(footer)
        if not known:
            a, b = (self._template([*self._turns[:-1], (role, probe)])[len(self._text) - len(piece) :] for probe in ("x", "y"))
            head = _common(a, b)
            tail = _common(a[head:][::-1], b[head:][::-1])
            header, footer = a[:head], a[len(a) - tail :]
            self._frames[role] = (header, footer)
        return len(header), len(footer)

    def add(self, role: str, text: str) -> dict:
        if len(self._turns) >= self._window:
            self._slide()
        piece, rewrote = self._grow((role, text))
        header, footer = self._frame(role, piece)
        start, self.length = self.length, self.length + len(piece)
        return {"piece": piece, "start": start, "end": self.length, "content_start": start + header, "content_end": self.length - footer, "rewrote": rewrote}


SPAN_FIELDS = [("n", pa.int64()), ("role", pa.string()), ("piece", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
               ("content_start", pa.int64()), ("content_end", pa.int64()), ("train", pa.bool_()), ("rewrote", pa.bool_())]
_SPAN_SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("role", T.StringType()), T.StructField("piece", T.StringType()),
                             *[T.StructField(name, T.LongType()) for name in ("start", "end", "content_start", "content_end")],
                             T.StructField("train", T.BooleanType()), T.StructField("rewrote", T.BooleanType())])
_FLUSH_ROWS, _FLUSH_CHARS = 2000, 4 << 20


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            yield from batch.slice(first, 500).to_pylist()


def format_conversations(
    rows: DataFrame,
    template: Template = plain_template,
    train: tuple[str, ...] = ("assistant",),
    window: int = 512,
    on_rewrite: str = "fail",
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per turn: ``conv_id``, ``n`` (from 0), ``role``, ``piece`` (what the turn adds to the output), its span ``start``-``end``
    and its content's ``content_start``-``content_end`` in code points of the conversation's output, ``train`` (the content is under the
    loss mask), ``rewrote``.

    The output of a conversation is its pieces in order (the first begins with the template's opening). Partitions hold whole
    conversations, sorted. Turns are ordered by ``turn`` (nulls first), ties by role and text; repeated rows are repeated
    turns. Null roles and texts are empty; rows without a conversation id are one conversation. No rows give no rows. Other
    columns are ignored. A rewriting template fails (``on_rewrite="fail"``) or is marked (``"mark"``; spans then hold only
    what each turn changed).
    """
    columns = [F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")]
    ordered = rows.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = ordered.schema["conv_id"].dataType

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        schema = pa.schema([head.schema.field("conv_id"), *SPAN_FIELDS])
        found, chars = [], 0
        for conversation, turns in itertools.groupby(_rows(itertools.chain([head], batches)), key=lambda x: x["conv_id"]):
            renderer = Renderer(template, window)
            for n, x in enumerate(turns):
                span = renderer.add(x["role"], x["text"])
                if span["rewrote"] and on_rewrite == "fail":
                    raise HistoryRewritten(f"turn {n} of conversation {conversation} changed the output before it")
                if n == 0 and renderer.opening:
                    span |= {"piece": renderer.opening + span["piece"], "start": 0}
                found.append(span | {"conv_id": conversation, "n": n, "role": x["role"], "train": x["role"] in train})
                chars += len(span["piece"])
                if len(found) >= _FLUSH_ROWS or chars >= _FLUSH_CHARS:
                    yield pa.RecordBatch.from_pylist(found, schema)
                    found, chars = [], 0
        yield pa.RecordBatch.from_pylist(found, schema)

    return ordered.mapInArrow(of_partition, T.StructType([T.StructField("conv_id", kind), *_SPAN_SCHEMA.fields]))


DIGEST_SCHEMA = [("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType())]


def read_back(spans: DataFrame) -> DataFrame:
    """Parse the output of :func:`plain_template` again: digests of the turns in it and of the unescaped text under the loss mask.

    ``spans`` is what :func:`format_conversations` gave, so partitions hold whole conversations in order. Output that does not parse fails.
    """
    kind = spans.schema["conv_id"].dataType

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        schema = pa.schema([head.schema.field("conv_id"), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        found = []
        for conversation, pieces in itertools.groupby(_rows(itertools.chain([head], batches)), key=lambda x: x["conv_id"]):
            turns, loss, count, loss_chars, chars, pending = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, ""
            for x in pieces:
                if x["start"] != chars:
                    raise ValueError(f"the spans of conversation {conversation} do not follow each other")
                pending += x["piece"]
                chars += len(x["piece"])
                at = 0
                for at, role, text in parse_plain(pending):  # noqa: B007
                    count += 1
                    turns.update(f"{role}\n{text}\n".encode())
                pending = pending[at:]
                if x["train"]:
                    masked = unescape(x["piece"][x["content_start"] - x["start"] : x["content_end"] - x["start"]])
                    loss.update(masked.encode())
                    loss_chars += len(masked)
            if pending:
                raise ValueError(f"the output of conversation {conversation} does not parse at {pending[:80]!r}")
            found.append({"conv_id": conversation, "n_turns": count, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": chars})
            if len(found) >= _FLUSH_ROWS:
                yield pa.RecordBatch.from_pylist(found, schema)
                found = []
        yield pa.RecordBatch.from_pylist(found, schema)

    return spans.mapInArrow(of_partition, T.StructType([T.StructField("conv_id", kind), *[T.StructField(*field) for field in DIGEST_SCHEMA]]))
