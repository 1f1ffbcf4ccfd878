"""Conversations to training text by a compiled template, and back.

Rows are dealt by conversation, sorted by turn inside a partition and rendered as they stream by: neither a conversation
nor its output is ever held whole, a turn or two are. The output has a row per turn, ``segment`` and the ``marked`` spans in it
(by code points); a conversation's text is its segments in order, its loss mask the marked spans.

Control strings inside a text are made harmless by one backslash: ``<``, any number of backslashes and ``|`` become the same
with one backslash more, which is undone by taking one away. Roles also have line feeds written as ``\\n``.

Defined results: null role or text is empty; turns of a conversation are ordered by turn, role and text (nulls first), and
repeated rows stay; rows with a null conversation form one conversation; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowbench.llm.template import compile_template

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for m in messages %}" + START + "{{ m.role | guard_role }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | guard }}{% endgeneration %}{% else %}{{ m.text | guard }}{% endif %}"
    + END + "\n{% endfor %}"
)
ROWS = 2_000


def guard(text: str | None) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text or "")


def unguard(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def guard_role(role: str | None) -> str:
    return guard((role or "").replace("\\", "\\\\").replace("\n", "\\n"))


def unguard_role(role: str) -> str:
    return re.sub(r"(?s)\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unguard(role))


FILTERS = {"guard": guard, "guard_role": guard_role, "trim": lambda v: (v or "").strip(), "upper": lambda v: (v or "").upper(), "length": len}
SEGMENTS = "conv_id long, seq long, segment string, marked array<struct<start: long, end: long>>"


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while part := list(itertools.islice(rows, ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def format_conversations(conversations: DataFrame, template: str = TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Segments in order inside each partition, all of a conversation in one: (conv_id, seq, segment, marked spans)."""
    compile_template(template, FILTERS)  # a broken template fails here, not on an executor
    rows = conversations.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                                F.col(f"`{role_col}`").cast("string").alias("role"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("segment", pa.string()),
                        ("marked", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def render(batches):
        write = compile_template(template, FILTERS)

        def segments():
            for conv, turns in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                taken = 0

                def messages():
                    nonlocal taken
                    for _, turn, role, text in turns:
                        taken += 1
                        yield {"role": role or "", "text": text or "", "turn": turn}

                seq, said, spans, length, seen = 0, [], [], 0, 0
                for piece, marked in write({"messages": messages()}):
                    if said and (taken != seen or said[-1].endswith(END + "\n")):
                        yield conv, seq, "".join(said), spans
                        seq, said, spans, length = seq + 1, [], [], 0
                    seen = taken
                    said.append(piece)
                    if marked:
                        spans.append({"start": length, "end": length + len(piece)})
                    length += len(piece)
                if said:
                    yield conv, seq, "".join(said), spans

        return _batched(segments(), schema)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(render, SEGMENTS)


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of what the formatted segments say, one row per conversation. ``segments`` as ``format_conversations`` returns
    them (a conversation in one partition, in order), in the default template's marks."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def digests(batches):
        def convs():
            for conv, parts in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                turns, loss, n, loss_chars, chars, rest = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, ""
                for _, _, segment, marked in parts:
                    chars += len(segment)
                    for s in marked or ():
                        said = unguard(segment[s["start"]:s["end"]])
                        loss_chars += len(said)
                        loss.update(said.encode("utf-8", "surrogatepass"))
                    rest += segment
                    at = 0
                    while m := _TURN.match(rest, at):
                        turns.update(f"{unguard_role(m[1])}\n{unguard(m[2])}\n".encode("utf-8", "surrogatepass"))
                        n, at = n + 1, m.end()
                    rest = rest[at:]
                if rest:
                    raise ValueError(f"conversation {conv}: the formatted text cannot be read back at {rest[:80]!r}")
                yield conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        return _batched(convs(), schema)

    return segments.mapInArrow(digests, DIGESTS)
