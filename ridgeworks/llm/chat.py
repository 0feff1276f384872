"""Chat formatting with a black-box template: rendering ever longer prefixes locates every turn's span.

A template is any function from a list of turns to a text. Turn k lies where the output for k turns goes
on after the output for k - 1 turns. A template that changes what it wrote before (a closing line, a
count of turns, a moved system prompt) is detected by that comparison.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# control strings of the plain template
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>"
ASSISTANT = "assistant"

_CONTROL = re.compile(r"\\|###|</turn>")
_CONTROL_BACK = re.compile(r"\\(\\|###|</turn>)")
_ROLE = re.compile(r"[\\#:<\n]")
_ROLE_BACK = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """The text with a backslash before every control string and every backslash."""
    return _CONTROL.sub(lambda found: "\\" + found[0], text)


def unescape(text: str) -> str:
    """What ``escape`` was given."""
    return _CONTROL_BACK.sub(r"\1", text)


def plain_template(turns: list[Turn]) -> str:
    """``### role: text</turn>`` and a line feed for every turn; role and text are escaped."""
    return "".join(
        f"{OPEN}{_ROLE.sub(lambda x: chr(92) + x[0], role)}{MIDDLE}{escape(text)}{CLOSE}\n" for role, text in turns
    )


def read_plain_turn(formatted: str) -> tuple[str, int, int] | None:
    """(role, first, end) with the place of the escaped text inside one formatted turn, else None."""
    found = _TURN.fullmatch(formatted)
    return found and (_ROLE_BACK.sub(r"\1", found[1]), found.start(2), found.end(2))


def turn_spans(template: Template, turns: list[Turn]) -> tuple[str, list[tuple[int, int]], int | None]:
    """(output, spans, first rewriting turn) by rendering every prefix of a conversation.

    A span is (first, end) of what the turn adds. Where an output does not begin with the one before it,
    the template has rewritten history: the third value is the place of the first such turn (else None)
    and spans are those of the turns before it.
    """
    before = template([])
    spans: list[tuple[int, int]] = []
    for k in range(1, len(turns) + 1):
        now = template(turns[:k])
        if not now.startswith(before):
            return template(turns), spans, k - 1
        spans.append((len(before), len(now)))
        before = now
    return before, spans, None


def read_back(output: str, spans: list[tuple[int, int]], read=read_plain_turn) -> list[dict]:
    """Role, text and places of every turn, from nothing but the output and the spans in it."""
    turns = []
    for first, end in spans:
        found = read(output[first:end])
        if found is None:
            raise ValueError(f"no turn can be read at {first} to {end}")
        role, low, high = found
        low, high = first + low, first + high
        text = unescape(output[low:high])
        turns.append(dict(role=role, text=text, first=first, end=end, low=low, high=high, loss=role == ASSISTANT))
    return turns


def format_conversations(
    rows: DataFrame,
    template: Template = plain_template,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    read=read_plain_turn,
) -> DataFrame:
    """One row per conversation: its formatted text and the turns read back from it.

    Columns: conv_id, n_turns, formatted, rewriting (place of the first turn whose rendering changed what
    stood before it, null if none did), turns (role, text, first, end, low, high, loss). ``first`` to
    ``end`` is the turn, ``low`` to ``high`` its escaped text, ``loss`` says whether that text is under
    the loss mask: the assistant's texts are and nothing else is. Only turns before a rewriting one have
    places that can be trusted, so only they are listed. Rows go by turn, then role and text; a null turn
    comes first, null role or text counts as empty, repeated rows are turns of their own, rows with a null
    id are one conversation. A conversation is one record, as its formatted text is; a task holds no more.
    """
    parts = F.struct(
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    grouped = rows.select(F.col(conv_id).cast("long").alias("conv_id"), parts.alias("part"))
    grouped = grouped.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for parts in batch.column(1).to_pylist():
                turns = [(x["role"], x["text"]) for x in parts]
                output, spans, rewriting = turn_spans(template, turns)
                made.append((len(turns), output, rewriting, read_back(output, spans, read)))
            columns = [list(x) for x in zip(*made, strict=True)] or [[], [], [], []]
            kinds = [pa.int64(), pa.string(), pa.int32(), TURNS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]],
                ["conv_id", "n_turns", "formatted", "rewriting", "turns"],
            )

    schema = (
        "conv_id long, n_turns long, formatted string, rewriting int, turns array<struct<role: string, "
        "text: string, first: long, end: long, low: long, high: long, loss: boolean>>"
    )
    return grouped.mapInArrow(run, schema)


TURNS = pa.list_(
    pa.struct(
        [("role", pa.string()), ("text", pa.string())]
        + [(x, pa.int64()) for x in ("first", "end", "low", "high")]
        + [("loss", pa.bool_())]
    )
)


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of each conversation."""
    feed = F.lit("\n")
    lines = F.transform("turns", lambda x: F.concat(x["role"], feed, x["text"], feed))
    loss = F.array_join(F.transform(F.filter("turns", lambda x: x["loss"]), lambda x: x["text"]), "")
    return formatted.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
