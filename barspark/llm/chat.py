"""Chat formatting: conversations rendered by a compiled template, with the loss mask, and read back.

The chat template marks turns with control strings; texts are escaped so that no control string can
stand inside one: a backslash doubles, and a control string gets a backslash after its first
character.  Dropping each backslash and keeping what follows gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.llm.template import Template, show

BEGIN, END, ASK, REPLY = "<s>", "</s>", "[INST]", "[/INST]"
CONTROLS = (BEGIN, END, ASK, REPLY)
CHAT = (
    BEGIN
    + "{% for m in messages %}{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    + END
    + "{% else %}"
    + ASK
    + "{{ m.role | escape_line }}\n{{ m.text | escape }}"
    + REPLY
    + "{% endif %}{% endfor %}"
)
#: Characters after which a conversation's output goes on in another row (a turn is never cut).
PART_CHARS = 1 << 18
_OUT_CHARS = 1 << 22


def escape(value: object) -> str:
    """Text without control strings; ``unescape`` gives it back."""
    text = show(value).replace("\\", "\\\\")
    if "<" in text or "[" in text:
        for c in CONTROLS:
            text = text.replace(c, c[0] + "\\" + c[1:])
    return text


def escape_line(value: object) -> str:
    """``escape`` that keeps to one line."""
    return escape(value).replace("\n", "\\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def chat_template(source: str = CHAT) -> Template:
    return Template(source, {"escape": escape, "escape_line": escape_line})


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _format(source: str):
    fields = [("conv", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(pa.int32()))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = chat_template(source)
        held: list[list] = [[], [], [], []]
        size = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(held, fields)], names=[n for n, _ in fields])

        for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
            messages = ({"role": r[1], "text": r[2]} for r in rows)
            part, text, spans, at = 0, [], [], 0
            pieces = template.stream(messages=messages)
            while True:
                turn = next(pieces, None)
                for piece, masked in turn or ():
                    if masked:
                        spans += [at, at + len(piece)]
                    text.append(piece)
                    at += len(piece)
                if turn is None or at >= PART_CHARS:
                    if text or part == 0:
                        for col, v in zip(held, (conv, part, "".join(text), spans)):
                            col.append(v)
                        size += at
                        part += 1
                    text, spans, at = [], [], 0
                    if size >= _OUT_CHARS:
                        yield flush()
                        held, size = [[], [], [], []], 0
                if turn is None:
                    break
        if held[0]:
            yield flush()

    return run


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", template: str = CHAT) -> DataFrame:
    """``conv, part, formatted, spans``: conversations in turn order, rendered; the spans (start, end, ...
    in code points of the part) are under the loss mask.

    A conversation is one stream: its rows are sorted inside a partition and rendered turn by turn, and
    its output goes on in further parts after ``PART_CHARS`` characters, so a conversation of any length
    needs the memory of one part.  Null text and role count as empty; null turns come first;
    rows of equal turn go by role and text; repeated rows are turns of their own; rows with a null conversation id
    are one conversation.  An empty table gives no rows; other columns are ignored.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = rows.select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(turn_col).cast("bigint").alias("turn"),
    )
    sorted_rows = narrow.repartition(parts, "conv").sortWithinPartitions("conv", "turn", "role", "text")
    return sorted_rows.mapInArrow(_format(template), "conv bigint, part bigint, formatted string, spans array<int>")


_ROLE = re.compile(r"((?:[^\\\n]|\\.)*)\n", re.S)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in a part's text, by the marks of ``CHAT``."""
    at = len(BEGIN) if formatted.startswith(BEGIN) else 0
    while at < len(formatted):
        if formatted.startswith(ASK, at):
            end = formatted.index(REPLY, at)
            role = _ROLE.match(formatted, at + len(ASK))
            yield unescape(role[1]), unescape(formatted[role.end() : end])
            at = end + len(REPLY)
        else:
            end = formatted.index(END, at)
            yield "assistant", unescape(formatted[at:end])
            at = end + len(END)


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` read from the rows of
    ``format_conversations`` (whose order inside a partition it relies on: no shuffle lies between)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        held: list[list] = [[] for _ in names]
        for conv, parts in groupby(_rows(batches), key=lambda r: r[0]):
            turns, loss, n, masked, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, _, text, spans in parts:
                for role, said in read_turns(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for a, b in zip(spans[::2], spans[1::2]):
                    said = unescape(text[a:b])
                    loss.update(said.encode())
                    masked += len(said)
                chars += len(text)
            for col, v in zip(held, (conv, n, turns.hexdigest(), masked, loss.hexdigest(), chars)):
                col.append(v)
            if len(held[0]) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds)], names=names)
                held = [[] for _ in names]
        if held[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds)], names=names)

    return formatted.mapInArrow(run, "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
