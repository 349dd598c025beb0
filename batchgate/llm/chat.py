"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>`` role newline text ``<|im_end|>`` newline; a conversation is
its turns one after another.  Every rendered turn is parsed again by the grammar

    conversation = turn*      turn = START role "\\n" text END "\\n"

in which a text ends at the first ``END`` and holds no ``START``.  If the parser does not give back
exactly the turn that went in, its conflicting content is escaped and it is rendered and parsed
anew, until both are identical.  Each segment starts and ends in the grammar's initial state,
so the concatenation parses to the concatenation and a turn is all that memory must hold.

Escapes are reversible: a control string, with any backslashes after its ``<``, gets one more
backslash there (``<|im_end|>`` becomes ``<\\|im_end|>``) and the parser takes one away.  Roles
also escape newlines and backslashes.

Cases: a null text or role is the empty string; turns of a conversation are taken in the order
(turn, role, text), nulls first, so ties and repeated rows have one result and every row is a
turn; a null conv_id is a conversation of its own; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import quoted, tidy

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")
_ROLE = str.maketrans({"\\": "\\\\", "\n": "\\n", "<": "\\l"})
_ROLE_BACK = {"\\": "\\", "n": "\n", "l": "<"}
TURN = "conv_id {id}, turn {turn}, segment string, escaped boolean, mask_start long, mask_end long"


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|\2|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|\2|>", text)


def escape_role(role: str) -> str:
    return role.translate(_ROLE)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: _ROLE_BACK.get(m[1], m[0]), role)


class GrammarError(ValueError):
    """The text is no sequence of turns."""


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """The turns of rendered text: role, text, and where the escaped text starts and ends."""
    at = 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise GrammarError(f"no turn starts at {at}")
        line = rendered.find("\n", at)
        end = rendered.find(END, max(line, at))
        if line < 0 or end < 0 or not rendered.startswith("\n", end + len(END)):
            raise GrammarError(f"the turn at {at} is not closed")
        role, body = rendered[at + len(START):line], rendered[line + 1:end]
        if START in body or START in role or END in role:
            raise GrammarError(f"a turn starts inside the turn at {at}")
        yield unescape_role(role), unescape(body), line + 1, end
        at = end + len(END) + 1


def render(role: str, text: str) -> tuple[str, int, bool]:
    """One turn's segment, where its text starts, and whether anything had to be escaped."""
    shown_role, shown = role, text
    for attempt in range(2):
        segment = f"{START}{shown_role}\n{shown}{END}\n"
        try:
            turns = list(parse(segment))
        except GrammarError:
            turns = []
        if [(r, t) for r, t, _, _ in turns] == [(role, text)]:
            return segment, turns[0][2], bool(attempt)
        shown_role, shown = escape_role(role), escape(text)
    raise GrammarError("escaping does not make the turn readable")


def format_turns(conversations: DataFrame) -> DataFrame:
    """Every turn's segment, and the span of its text in it that a loss covers.

    Row by row, without a shuffle.  mask_start and mask_end are code points in the segment, the
    span of an assistant's text, else null.
    """
    source = conversations.select(
        quoted("conv_id").alias("conv_id"), quoted("turn").alias("turn"),
        F.coalesce(quoted("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(quoted("text").cast("string"), F.lit("")).alias("text"))
    schema = TURN.format(**{k: source.schema[c].dataType.simpleString()
                            for k, c in (("id", "conv_id"), ("turn", "turn"))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments, escaped, first, last = [], [], [], []
            for role, text in zip(batch.column("role").to_pylist(),
                                  batch.column("text").to_pylist()):
                segment, begin, changed = render(role, text)
                segments.append(segment)
                escaped.append(changed)
                learns = role == "assistant"
                first.append(begin if learns else None)
                last.append(len(segment) - len(END) - 1 if learns else None)
            yield pa.RecordBatch.from_pydict({
                "conv_id": batch.column("conv_id"), "turn": batch.column("turn"),
                "segment": pa.array(segments, pa.string()),
                "escaped": pa.array(escaped, pa.bool_()),
                "mask_start": pa.array(first, pa.int64()),
                "mask_end": pa.array(last, pa.int64())})

    return source.mapInArrow(tidy(run), schema)


def in_order(turns: DataFrame) -> DataFrame:
    """Conversations side by side, each in the order of its turns."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")


def conversations(turns: DataFrame) -> DataFrame:
    """Whole conversations: conv_id, formatted text, and the loss mask as spans in it."""
    part = F.struct("turn", "segment", "mask_start", "mask_end")
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("t"))
    sized = grouped.withColumn("n", F.transform("t", lambda x: F.length(x.segment)))
    ends = F.aggregate(
        "n", F.array(F.lit(0).cast("int")),
        lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    spans = F.transform("t", lambda x, i: F.struct(
        (F.get("b", i) + x.mask_start).alias("start"), (F.get("b", i) + x.mask_end).alias("end")))
    return sized.withColumn("b", ends).select(
        "conv_id", F.array_join("t.segment", "").alias("formatted"),
        F.filter(spans, lambda s: s.start.isNotNull()).alias("loss_spans"))


def read_back(turns: DataFrame) -> DataFrame:
    """What a reader of the output finds in each conversation: counts and digests.

    One stream over sorted segments; digests grow turn by turn, so a conversation of any length
    passes through in bounded memory.
    """
    schema = (f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, n_turns long, "
              "turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

    class Tally:
        def __init__(self, conv):
            self.conv, self.n, self.loss, self.chars = conv, 0, 0, 0
            self.turns, self.learned = hashlib.sha256(), hashlib.sha256()

        def add(self, segment: str, first: int | None, last: int | None) -> None:
            for role, text, _, _ in parse(segment):
                self.n += 1
                self.turns.update(f"{role}\n{text}\n".encode())
            if first is not None:
                text = unescape(segment[first:last])
                self.loss += len(text)
                self.learned.update(text.encode())
            self.chars += len(segment)

        def row(self) -> tuple:
            return (self.conv, self.n, self.turns.hexdigest(), self.loss,
                    self.learned.hexdigest(), self.chars)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, kind = None, pa.int64()

        def out(rows):
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_pydict(
                {n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), kinds)})

        for batch in batches:
            done, kind = [], batch.column("conv_id").type
            for conv, segment, first, last in zip(*(
                    batch.column(c).to_pylist()
                    for c in ("conv_id", "segment", "mask_start", "mask_end"))):
                if tally is None or tally.conv != conv:
                    if tally is not None:
                        done.append(tally.row())
                    tally = Tally(conv)
                tally.add(segment, first, last)
            if done:
                yield out(done)
        if tally is not None:
            yield out([tally.row()])

    return in_order(turns).mapInArrow(tidy(run), schema)


def op3_chat_formatting(conversations_table: DataFrame) -> DataFrame:
    """All conversations formatted, and what their readers get back from the output."""
    return read_back(format_turns(conversations_table))
