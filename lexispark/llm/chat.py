"""Chat formatting: a grammar round trip.

A conversation becomes one string of turns. Each turn has an opener, the
text and a closer, so the grammar is regular and a parser needs no look
ahead beyond a turn:

    [INST] user text [/INST]
    <s> assistant text </s>
    <<SYS>> system text <</SYS>>
    <<ROLE>> any other role <<SEP>> text <</ROLE>>

A turn is rendered as it is, read back with the deterministic parser and
compared with its source; where they differ (its text holds a control
string, or a control string with escapes), the content is escaped and the
check repeated. An escape is a backslash after the first character of a
control string, one more than there were: it is undone exactly.

Turns are rendered one by one, in any task. A closer can't occur inside a
rendered text, so the parse of the joined turns is the joined parse of the
turns. Only the digests of a conversation need its turns in order: they are
sorted (with spill) and folded as a stream, with one open hash per task,
never collected.

Nulls: a null text or role is empty; rows without ``conv_id`` form one
conversation. Rows with the same turn are ordered by role and text (as
UTF-8), and repeated rows all count. An empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = re.compile(r"\[/?INST\]|</?s>|<</?SYS>>|<</?ROLE>>|<<SEP>>")
_TAILS = r"(?=/?INST\]|/?s>|</?SYS>>|</?ROLE>>|<SEP>>)"
_ESCAPE = re.compile(r"([\[<])(\\*)" + _TAILS)
_UNESCAPE = re.compile(r"([\[<])\\(\\*)" + _TAILS)
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]"
    r"|<s> (?P<assistant>.*?) </s>"
    r"|<<SYS>> (?P<system>.*?) <</SYS>>"
    r"|<<ROLE>> (?P<role>.*?) <<SEP>> (?P<other>.*?) <</ROLE>>",
    re.DOTALL,
)
#: opener and closer of the roles that have their own
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a rendered string; ValueError where it
    does not follow the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        m = _TURN.match(rendered, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        role, text = (m["role"], m["other"]) if kind == "other" else (kind, m[kind])
        if CONTROL.search(text) or CONTROL.search(role):
            raise ValueError(f"a control string inside the turn at {at}")
        turns.append((unescape(role), unescape(text)))
        at = m.end()
    return turns


def _compose(role: str, text: str) -> tuple[str, int]:
    if role in MARKS:
        opener, closer = MARKS[role]
    else:
        opener, closer = f"<<ROLE>> {role} <<SEP>> ", " <</ROLE>>"
    return opener + text + closer, len(opener)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's string and the span of its text in it, by round trips:
    escaped only where the plain form is not read back identically."""
    for change in (lambda s: s, escape):
        shown = change(text)
        piece, start = _compose(role if role in MARKS else change(role), shown)
        try:
            if parse(piece) == [(role, text)]:
                return piece, start, start + len(shown)
        except ValueError:
            pass
    raise ValueError(f"turn can't be rendered reversibly: {role!r}")


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, rendered, loss_from, loss_to, text_from,
    text_to) for each row: the conversation's string is the concatenation of
    ``rendered`` by (turn, role, text). Spans are code points in
    ``rendered``; the loss span is an assistant's text, and empty for other
    roles."""
    names = ["conv_id", "turn", "role", "rendered", "loss_from", "loss_to", "text_from", "text_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles = b.column(2).to_pylist()
            made = [render(r, t) for r, t in zip(roles, b.column(3).to_pylist(), strict=True)]
            loss = [(s, e) if r == "assistant" else (0, 0) for r, (_, s, e) in zip(roles, made, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([m[0] for m in made], pa.string()), *[pa.array([x[i] for x in spans], pa.int64()) for spans, i in ((loss, 0), (loss, 1), (made, 1), (made, 2))]],
                names=names,
            )

    src = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return src.mapInArrow(run, "conv_id long, turn long, role string, rendered string, loss_from long, loss_to long, text_from long, text_to long")


class _Fold:
    """The open digests of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.n, self.chars, self.loss = conv_id, 0, 0, 0
        self.turns, self.masked = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, lo: int, hi: int) -> None:
        for role, text in parse(piece):
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.n += 1
        masked = unescape(piece[lo:hi])
        self.masked.update(masked.encode("utf-8", "surrogatepass"))
        self.loss += len(masked)
        self.chars += len(piece)

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss, self.masked.hexdigest(), self.chars


def read_back(turns: DataFrame) -> DataFrame:
    """Parse the rendered turns and digest each conversation:
    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars)."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = None
        for b in batches:
            done = []
            cols = [c.to_pylist() for c in b.columns]
            for conv, piece, lo, hi in zip(*cols, strict=True):
                if fold is None or fold.conv_id != conv:
                    if fold:
                        done.append(fold.row())
                    fold = _Fold(conv)
                fold.add(piece, lo, hi)
            if done:
                yield batch(done)
        if fold:
            yield batch([fold.row()])

    # the text that equal turns are ordered by is read back after the shuffle
    shown = F.substring("rendered", F.col("text_from").cast("int") + 1, (F.col("text_to") - F.col("text_from")).cast("int"))
    text = F.regexp_replace(shown, _UNESCAPE.pattern, "$1$2")
    ordered = turns.repartition("conv_id").withColumn("_text", text).sortWithinPartitions("conv_id", "turn", "role", "_text")
    return ordered.select("conv_id", "rendered", "loss_from", "loss_to").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
