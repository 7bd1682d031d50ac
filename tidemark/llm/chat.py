"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are
its context and only its reply is trainable.  ``format_turns`` formats turns,
``example_texts`` expands them into examples, each with its whole context, and
``read_examples`` reads those back.  The contexts of a conversation are
prefixes of one formatted text, so a store may keep that text once, turn by
turn, with examples as spans of it (``examples``): context [0, loss_start),
trainable [loss_start, loss_end), all of it [0, ends_at).

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control strings that occur
inside a role or a text get a backslash behind their first character (one more
if there are some already), so marks never stand inside texts and reading back
gives the very same characters.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
REPLY = "assistant"

#: Control strings of the template and of common chat formats; fixed values.
CONTROL = (
    START, END, "<|im_sep|>", "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
    "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "[SYS]", "[/SYS]",
)

FORMATTED = ["conv_id", "position", "segment", "starts_at", "loss_start", "loss_end", "ends_at"]
EXAMPLES = "conv_id long, example long, text string, loss_start long, loss_end long"
#: Code points and rows of a batch of examples.
EXAMPLE_CHARS, EXAMPLE_ROWS = 4 << 20, 1000
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _rests(control: Iterable[str]) -> str:
    """Alternatives of what follows the first character of the control strings."""
    for mark in control:
        if mark[0] not in "<[" or re.search(r"[<\[\\]", mark[1:]):
            raise ValueError(f"a control string begins with < or [ and holds neither them nor a backslash later: {mark!r}")
    return "|".join(re.sub(r"([^\w<>/ ])", r"\\\1", mark[1:]) for mark in control)


def escaped(column: Column, control: Iterable[str] = CONTROL) -> Column:
    """The text with every control string broken by one backslash; nulls are empty."""
    text = F.coalesce(column, F.lit(""))
    return F.regexp_replace(text, rf"([<\[])(\\*)({_rests(control)})", r"$1\\$2$3")


def unescape(control: Iterable[str] = CONTROL):
    """The function that gives an escaped text back."""
    broken = re.compile(rf"([<\[])\\(\\*)({_rests(control)})")
    return lambda text: broken.sub(r"\1\2\3", text) if "\\" in text else text


def escaped_role(column: Column, control: Iterable[str] = CONTROL) -> Column:
    """A role as one line: backslashes doubled, line ends as \\n, control strings broken."""
    one_line = F.replace(F.replace(F.coalesce(column, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escaped(one_line, control)


def unescape_role(role: str, whole) -> str:
    return re.sub(r"\\(.)", lambda found: "\n" if found[1] == "n" else found[1], whole(role)) if "\\" in role else role


def format_turns(turns: DataFrame, control: Iterable[str] = CONTROL) -> DataFrame:
    """Formatted turns of conversations (conv_id, turn, role, text).

    Columns: conv_id, position (from 0), segment (the formatted turn),
    starts_at and ends_at (its code points in the formatted conversation), and
    for replies loss_start and loss_end (null in other turns).  A null text is
    empty and a null role has no name; a null conv_id is a conversation like
    others; turns are ordered by turn (null first), and those that tie by role
    and text, so repeated rows are turns too; no rows give no rows; columns of
    other names are not looked at.  The turns of a conversation follow each
    other in its order; one task reads them one after another, a conversation
    of any length within its sort's memory.
    """
    names = ["conv_id", "turn", "role", "text"]
    role = escaped_role(F.col("role"), control)
    head = F.concat(F.lit(START), role, F.lit("\n"))
    body = escaped(F.col("text"), control)
    lengths = (
        turns.select(*names)
        .withColumn("head", F.char_length(head))
        .withColumn("body", F.char_length(body))
        .withColumn("segment", F.concat(head, body, F.lit(END + "\n")))
        .withColumn("size", F.char_length("segment").cast("long"))
        .select("conv_id", "turn", F.col("role").eqNullSafe(REPLY).alias("reply"), "head", "body", "segment", "size")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "segment")
    placed = (
        lengths.withColumn("position", F.row_number().over(order) - 1)
        .withColumn("ends_at", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("starts_at", F.col("ends_at") - F.col("size"))
        .withColumn("loss_start", F.when(F.col("reply"), F.col("starts_at") + F.col("head")))
        .withColumn("loss_end", F.col("loss_start") + F.col("body"))
    )
    return placed.select(*FORMATTED)


def examples(formatted: DataFrame) -> DataFrame:
    """One row for each assistant turn: which turns and code points are its context and which it learns.

    Columns: conv_id, example (from 0), context_turns, loss_start, loss_end and
    ends_at, all in the formatted conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("position")
    numbered = formatted.where("loss_start is not null").withColumn("example", F.row_number().over(order) - 1)
    return numbered.select("conv_id", "example", F.col("position").alias("context_turns"), "loss_start", "loss_end", "ends_at")


def in_order(formatted: DataFrame) -> DataFrame:
    """Formatted turns that were stored, again with each conversation's turns after one another."""
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position")


def example_texts(formatted: DataFrame, rests: bool = False) -> DataFrame:
    """Each example written out: conv_id, example, text (context and reply), loss_start and loss_end.

    With ``rests`` turns that no reply follows end one more text of their
    conversation, of which nothing is trainable.  A task holds the text of one
    conversation, and gives examples in batches of bounded size.
    """

    def written_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, so_far, number, rows, size = object(), [], 0, [], 0

        def example(loss_start: int | None, loss_end: int | None) -> int:
            nonlocal so_far, number
            so_far = ["".join(so_far)]
            rows.append((current, number, so_far[0], loss_start, loss_end))
            number += 1
            return len(so_far[0])

        pending = False
        for batch in batches:
            columns = [batch.column(FORMATTED.index(name)).to_pylist() for name in ("conv_id", "segment", "loss_start", "loss_end")]
            for conv_id, segment, loss_start, loss_end in zip(*columns):
                if conv_id != current:
                    if rests and pending:
                        size += example(None, None)
                    current, so_far, number = conv_id, [], 0
                so_far.append(segment)
                pending = loss_start is None
                if not pending:
                    size += example(loss_start, loss_end)
                if size > EXAMPLE_CHARS or len(rows) >= EXAMPLE_ROWS:
                    yield _batch(rows, EXAMPLES)
                    rows, size = [], 0
        if rests and pending:
            example(None, None)
        if rows:
            yield _batch(rows, EXAMPLES)

    return formatted.select(*FORMATTED).mapInArrow(written_out, EXAMPLES)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [part.split() for part in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.record_batch([pa.array(values, kinds[kind]) for values, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


class _Reader:
    """Reads one formatted conversation back, turn by turn."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = self.at = 0
        self.trained = True

    def read(self, segment: str, loss_start: int | None, loss_end: int | None, whole) -> None:
        if not (segment.startswith(START) and segment.endswith(END + "\n")):
            raise ValueError(f"no formatted turn in conversation {self.conv_id}")
        role, text = segment[len(START) : -len(END) - 1].split("\n", 1)
        role, text = unescape_role(role, whole), whole(text)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        start, self.at = self.at, self.at + len(segment)
        self.trained = loss_start is not None
        if self.trained:
            reply = whole(segment[loss_start - start : loss_end - start])
            self.loss.update(reply.encode())
            self.loss_chars += len(reply)
            self.formatted += self.at

    def row(self) -> tuple:
        total = self.formatted if self.trained else self.formatted + self.at
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), total


def read_back(formatted: DataFrame, control: Iterable[str] = CONTROL) -> DataFrame:
    """What formatted conversations hold, read from their text and spans alone.

    Per conversation: conv_id, n_turns, turns_sha256 (role, line end, text,
    line end of each turn), loss_chars and loss_sha256 (all trainable text,
    unescaped) and formatted_chars (code points of all examples, contexts
    included; turns after the last reply count as one more, without a reply).
    Needs the order that ``format_turns`` and ``in_order`` give.  A task holds one turn at
    a time: digests are taken on the way.
    """
    control = tuple(control)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, reader, names = unescape(control), None, [part.split()[0] for part in DIGESTS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(names)
            return pa.record_batch([pa.array(values, kind) for values, kind in zip(columns, types)], names)

        for batch in batches:
            rows = []
            columns = [batch.column(FORMATTED.index(name)).to_pylist() for name in ("conv_id", "segment", "loss_start", "loss_end")]
            for conv_id, segment, loss_start, loss_end in zip(*columns):
                if reader is None or reader.conv_id != conv_id:
                    if reader is not None:
                        rows.append(reader.row())
                    reader = _Reader(conv_id)
                reader.read(segment, loss_start, loss_end, whole)
            yield table(rows)
        if reader is not None:
            yield table([reader.row()])

    return formatted.select(*FORMATTED).mapInArrow(digests, DIGESTS)


class _ExampleReader:
    """Reads the examples of one conversation back; each begins with all of the one before."""

    def __init__(self, conv_id):
        self.conv_id, self.before = conv_id, ""
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = 0

    def read(self, text: str, loss_start: int | None, loss_end: int | None, whole) -> None:
        added = text[len(self.before) :]
        turns = added.split(END + "\n")
        if not text.startswith(self.before) or turns.pop() or not all(turn.startswith(START) for turn in turns):
            raise ValueError(f"no prefixes of formatted turns in conversation {self.conv_id}")
        for turn in turns:
            role, said = turn[len(START) :].split("\n", 1)
            self.turns.update(f"{unescape_role(role, whole)}\n{whole(said)}\n".encode())
        if loss_start is not None:
            reply = whole(text[loss_start:loss_end])
            self.loss.update(reply.encode())
            self.loss_chars += len(reply)
        self.n_turns += len(turns)
        self.formatted += len(text)
        self.before = text

    def row(self) -> tuple:
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted


def read_examples(written: DataFrame, control: Iterable[str] = CONTROL) -> DataFrame:
    """What the texts of ``example_texts`` (with its rests) hold; columns as in ``read_back``.

    Every text is read: its context has to be the text before, its new turns
    and its trainable span are taken in.  Needs the order that
    ``example_texts`` gives; a task holds two texts at a time.
    """
    control = tuple(control)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, reader = unescape(control), None
        for batch in batches:
            rows = []
            for conv_id, text, loss_start, loss_end in zip(*[column.to_pylist() for column in batch.columns]):
                if reader is None or reader.conv_id != conv_id:
                    if reader is not None:
                        rows.append(reader.row())
                    reader = _ExampleReader(conv_id)
                reader.read(text, loss_start, loss_end, whole)
            yield _batch(rows, DIGESTS)
        if reader is not None:
            yield _batch([reader.row()], DIGESTS)

    return written.select("conv_id", "text", "loss_start", "loss_end").mapInArrow(digests, DIGESTS)
