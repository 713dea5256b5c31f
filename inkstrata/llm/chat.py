r"""Chat formatting with a grammar that is parsed back.

    conversation = "<s>" turn*
    turn         = "[INST] " text " [/INST]"               of the user
                 | " " text " </s>"                        of the assistant
                 | "[ROLE " role "] " text " [/ROLE]"      of any other role, percent-encoded

Text has no control string in it. Rendering a turn is a round trip: what it gave is
parsed again, and as long as the parser does not return the same turn, a backslash
goes into every control string of the text (``[INST]`` becomes ``[\INST]``, that
becomes ``[\\INST]``); the parser takes one out. Turns are rendered row by row, so a
conversation of any length is spread over all tasks; only its digests are sequential.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.llm.common import schema_with, slices, texts_of

BEGIN = "<s>"
_NAMES = r"(?:/?INST\]|/?ROLE[ \]]|/?s>)"
_CONTROL = re.compile(rf"[\[<]{_NAMES}")
_ESCAPABLE = re.compile(rf"([\[<])(\\*{_NAMES})")
_ESCAPED = re.compile(rf"([\[<])\\(\\*{_NAMES})")
_ROLE = re.compile(r"\[ROLE ([^\] ]*)\] ")


class Malformed(ValueError):
    """Text that the grammar does not have."""


class Incomplete(Malformed):
    """Text that ends before its turn does."""


def escape(text: str) -> str:
    return _ESCAPABLE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def parse_turn(text: str, at: int = 0) -> tuple[str, int, int, int]:
    """``(role, start, end, next)`` of the turn at ``at``; its escaped text is ``text[start:end]``."""
    if text.startswith("[INST] ", at):
        role, start, close = "user", at + 7, "[/INST]"
    elif match := _ROLE.match(text, at):
        role, start, close = unquote(match[1]), match.end(), "[/ROLE]"
        if role in ("user", "assistant"):
            raise Malformed("a role with marks of its own")
    elif text.startswith(" ", at):
        role, start, close = "assistant", at + 1, "</s>"
    else:
        raise Malformed("no turn begins here")
    found = _CONTROL.search(text, start)
    if not found:
        raise Incomplete("the turn does not end")
    if found[0] != close or found.start() == start or text[found.start() - 1] != " ":
        raise Malformed(f"{found[0]} inside a turn of {role}")
    return role, start, found.start() - 1, found.end()


def _marks(role: str) -> tuple[str, str]:
    if role == "user":
        return "[INST] ", " [/INST]"
    if role == "assistant":
        return " ", " </s>"
    return f"[ROLE {quote(role, safe='')}] ", " [/ROLE]"


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn and the place of its escaped text in it."""
    before, after = _marks(role)
    inside = text
    while True:
        made = f"{before}{inside}{after}"
        try:
            found, start, end, stop = parse_turn(made)
            if stop == len(made) and found == role and unescape(made[start:end]) == text:
                return made, start, end
        except Malformed:
            pass
        escaped = escape(inside)
        if escaped == inside:
            raise Malformed(f"no escape of this text of {role} is read back as it was")
        inside = escaped


class Reader:
    """Deterministic parser of a conversation that comes in pieces, cut anywhere between turns."""

    def __init__(self) -> None:
        self.rest, self.begun, self.chars = "", False, 0

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        """``(role, text)`` of the turns that end in what was fed so far."""
        self.chars += len(piece)
        self.rest += piece
        if not self.begun:
            if not self.rest.startswith(BEGIN):
                raise Malformed("a conversation begins otherwise")
            self.begun, self.rest = True, self.rest[len(BEGIN) :]
        at = 0
        while at < len(self.rest):
            role, start, end, at = parse_turn(self.rest, at)
            yield role, unescape(self.rest[start:end])
        self.rest = self.rest[at:]


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("source")]


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        made = [render_turn(role or "", text) for role, text in zip(batch.column(2).to_pylist(), texts_of(batch.column(3)))]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int32()), pa.array([m[2] for m in made], pa.int32())],
            names=["conv_id", "turn", "role", "source", "segment", "text_start", "text_end"],
        )


def format_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, source, segment, text_start, text_end`` for each turn.

    A null text or role is the empty one. Segments of a conversation in the order of
    turn, role and text (null turns first, repeated turns are turns of their own)
    after one ``<s>`` are its formatted text; ``text_start`` to ``text_end`` of a
    segment of the assistant is under the loss mask.
    """
    blank = F.lit("")
    turns = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("source"))
    schema = schema_with(turns, ["conv_id", "turn", "role", "source"], "segment string, text_start int, text_end int")
    return turns.mapInArrow(_render, schema)


def formatted_texts(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted`` as one string each, for conversations that fit in one."""
    piece = F.struct("turn", "role", "source", "segment")
    pieces = F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["segment"])
    return turns.groupBy("conv_id").agg(F.concat(F.lit(BEGIN), F.array_join(pieces, "")).alias("formatted"))


class _Digests:
    def __init__(self) -> None:
        self.reader, self.turns, self.loss = Reader(), hashlib.sha256(), hashlib.sha256()
        self.count = self.loss_chars = 0
        self.feed(BEGIN)

    def feed(self, piece: str) -> None:
        for role, text in self.reader.feed(piece):
            self.count += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                self.loss.update(text.encode())
                self.loss_chars += len(text)

    def row(self) -> tuple:
        return self.count, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.reader.chars


_READ = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by conversation and order; one row leaves for each conversation."""
    kind, current, state = None, None, None
    for batch in slices(batches):
        kind = batch.schema.field(0).type
        rows = []
        for conversation, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if state is None or conversation != current:
                if state is not None:
                    rows.append((current, *state.row()))
                current, state = conversation, _Digests()
            state.feed(piece)
        if rows:
            yield _rows(rows, kind)
    if state is not None:
        yield _rows([(current, *state.row())], kind)


def _rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_back(turns: DataFrame) -> DataFrame:
    """What a parser finds in the formatted conversations: counts and digests of each.

    The segments come sorted and are read as a stream, so a task holds one turn of a
    conversation, however long that is.
    """
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", *_order())
    return ordered.select("conv_id", "segment").mapInArrow(_read, schema_with(turns, ["conv_id"], _READ))


def sql(source: str) -> str:
    """The same in SQL for a table ``source(conv_id, turn, role, text)``."""
    escaped = rf"regexp_replace(text, '([\[<])(\\*{_NAMES})', '\1\\\2', 'g')"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {source}),
r AS (SELECT *, CASE role WHEN 'user' THEN '[INST] ' || {escaped} || ' [/INST]' WHEN 'assistant' THEN ' ' || {escaped} || ' </s>'
  ELSE '[ROLE ' || url_encode(role) || '] ' || {escaped} || ' [/ROLE]' END AS segment FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(length(segment)) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id"""
