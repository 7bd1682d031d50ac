"""Packing documents into training sequences: first-fit decreasing over a tournament tree of capacities.

Documents are tokenised where they are read, each with an end id.  Whole
sequences are cut off a long document first; what remains is at most one
sequence long.  These pieces are dealt at random into groups of bounded size,
and each group is packed on its own: pieces from the longest to the shortest,
each into the first sequence that has room, which a tournament tree over the
sequences' free places finds in logarithmic time.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Merges
from tidemark.llm.text import as_bytes, give_back, mix64, raw, slices

LENGTH = 2048
END = 1
#: Documents, and bytes of text, that one group holds on average.
GROUP_DOCS = 4096
GROUP_BYTES = 16 << 20
#: Words whose ids a worker remembers at most; beyond that it starts anew.
REMEMBERED = 400_000

#: Bytes of text whose words are looked up together.
TOGETHER = 1 << 22

PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary, part int"
PACKED = "doc_id long, start long, length int, doc_tokens long, ids binary, sequence_id long, offset int"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[list[int], list[int]]:
    """Bin and place in it of each piece, by the longest first (ties in the given order)."""
    order = np.argsort(-lengths, kind="stable").tolist()
    leaves = 1 << max(0, (len(order) - 1).bit_length())
    tree = [capacity] * (2 * leaves)  # the most free places below each node
    bins, places = [0] * len(order), [0] * len(order)
    sizes = lengths.tolist()
    for piece in order:
        size, node = sizes[piece], 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[piece], places[piece] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, places


_LATIN = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
_LETTER = rb"(?:[A-Za-z]|" + _LATIN + rb")"
_MARK = rb"[.,;:!?]"
#: Punctuation between a letter and white space: a piece of its own, so it may stand apart.  (Marks are
#: looked for first, because they are rarer than letters.)
_TAIL = re.compile(
    rb"(" + _MARK + rb"(?:(?<=[A-Za-z]" + _MARK + rb")|(?<=" + _LATIN + _MARK + rb"))" + _MARK + rb"*)(?=[\x20\x09-\x0D]|\Z)"
)
#: Words of ASCII and Latin-1 letters alone.
_LETTERS = re.compile(rb"^" + _LETTER + rb"+$", re.MULTILINE)


class WordIds:
    """Ids of words, little-endian; in this vocabulary no token reaches over ASCII white space.

    Words not known yet are encoded many at a time.  By the vocabulary's
    definition, punctuation behind letters is a piece of its own, case does not
    matter, and the ids of plain letters follow from the merges; other words
    go through the tokenizer, with a special token between them.  A vocabulary
    of another definition sends all words as they are through the tokenizer.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        special = self.tokenizer.get_added_tokens_decoder()
        self.border, self.text = next((at, token.content) for at, token in special.items() if token.special)
        self.merges = Merges.of_file(vocabulary)
        self.known: dict[bytes, bytes] = {b"": b""}

    def words(self, text: bytes) -> list[bytes]:
        if self.merges is None:
            return text.split()
        # a combining mark may join a small letter where it joins no capital
        low = text if b"\xcc" in text or b"\xcd" in text else text.lower()
        return _TAIL.sub(rb" \1", low).split()

    def learn(self, words: set[bytes]) -> None:
        new = words - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {b"": b""}
            new = words
        if self.merges is not None:
            plain = _LETTERS.findall(b"\n".join(new))
            lower = b"\n".join(plain).decode().lower().encode().split(b"\n") if plain else []
            self.known.update(zip(plain, self.merges.encode(lower)))
            new = new.difference(plain)
        others = list(new)
        self.known.update(zip(others, self._whole(others)))

    def _whole(self, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        border = self.text.encode()
        ids = self._encode(border.join(words))
        ends = np.flatnonzero(ids == self.border).tolist()
        if len(ends) != len(words) - 1:  # a word holds the border itself
            return [self._encode(word).tobytes() for word in words]
        blob = ids.tobytes()
        return [blob[4 * start : 4 * end] for start, end in zip([0] + [end + 1 for end in ends], ends + [len(ids)])]

    def _encode(self, text: bytes) -> np.ndarray:
        encoded = self.tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)
        return np.array(encoded[0].ids, "<u4")

    def encode(self, texts: list[bytes], end: int) -> Iterator[bytes]:
        """Ids of each text, with the end id."""
        last = np.array([end], "<u4").tobytes()
        split = [self.words(text) for text in texts]
        self.learn(set().union(*split))
        for words in split:
            yield b"".join(map(self.known.__getitem__, words)) + last


def cut(vocabulary: str, groups: int, length: int, end: int, seed: int):
    """Tasks that turn texts into pieces with a random group."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of short-lived lists, no cycles
        try:
            # the words are forgotten with the task, so a worker that goes on to other work is small again
            yield from piece_batches(batches, WordIds(vocabulary), groups, length, end, seed)
        finally:
            gc.enable()
            give_back()

    return pieces


def piece_batches(
    batches: Iterator[pa.RecordBatch], known: WordIds, groups: int, length: int, end: int, seed: int
) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        offsets, data = raw(batch.column(1))
        doc_ids, blob = batch.column(0).to_pylist(), data.tobytes()
        for first, last in slices(offsets, TOGETHER):
            texts = [blob[offsets[k] : offsets[k + 1]] for k in range(first, last)]
            rows: list[tuple] = []
            for doc_id, ids in zip(doc_ids[first:last], known.encode(texts, end)):
                total = len(ids) // 4
                for start in range(0, total, length):
                    piece = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, len(piece) // 4, total, piece, number))
                    number += 1
            yield piece_batch(rows, groups, seed)


def piece_batch(rows: list[tuple], groups: int, seed: int) -> pa.RecordBatch:
    doc, start, size, total, ids, number = zip(*rows)
    scattered = mix64(np.array(number, np.uint64) ^ mix64(np.array([seed], np.uint64)))
    part = (scattered % np.uint64(groups)).astype(np.int32)
    return pa.record_batch(
        [
            pa.array(doc, pa.int64()),
            pa.array(start, pa.int64()),
            pa.array(size, pa.int32()),
            pa.array(total, pa.int64()),
            pa.array(ids, pa.binary()),
            pa.array(part, pa.int32()),
        ],
        ["doc_id", "start", "length", "doc_tokens", "ids", "part"],
    )


def packed_group(length: int):
    def packed(table: pa.Table) -> pa.Table:
        # the order of arrival may differ in a second attempt
        table = table.sort_by([(name, "ascending") for name in ("length", "doc_id", "start", "ids")])
        bins, places = first_fit_decreasing(table["length"].to_numpy(), length)
        group = table["part"][0].as_py() << 32
        table = table.drop_columns(["part"])
        table = table.append_column("sequence_id", pa.array([group + b for b in bins], pa.int64()))
        return table.append_column("offset", pa.array(places, pa.int32()))

    return packed


def pack(
    docs: DataFrame, vocabulary: str, length: int = LENGTH, end: int = END, seed: int = 7, group_docs: int = GROUP_DOCS
) -> DataFrame:
    """Pieces of all documents (doc_id, text) with their ids and their place in a sequence.

    Columns: doc_id, start (ids of the document before the piece), length, ids
    (little-endian unsigned 32-bit), doc_tokens (all ids, with the end id),
    sequence_id and offset (gapless from 0 in each sequence).  A null or empty
    text gives the end id alone; repeated rows are packed one by one; no rows
    give no sequences.  Sequences hold at most ``length`` ids; what is left
    free is padding.
    """
    size = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    groups = max(1, -(-size["rows"] // group_docs), -(-(size["bytes"] or 0) // GROUP_BYTES))
    pieces = docs.select("doc_id", as_bytes().alias("text")).mapInArrow(cut(vocabulary, groups, length, end, seed), PIECES)
    return pieces.groupBy("part").applyInArrow(packed_group(length), PACKED)


def padding(packed: DataFrame, length: int = LENGTH) -> float:
    """Share of padding: sequences are filled up to ``length`` unless a power of two long."""
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    power = F.expr("bit_count(fill) = 1")
    total = fill.agg(F.sum("fill").alias("ids"), F.sum(F.when(power, F.col("fill")).otherwise(length)).alias("places"))
    row = total.first()
    return 0.0 if not row["places"] else 1 - row["ids"] / row["places"]

