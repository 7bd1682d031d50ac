"""Periodic runs of words: maximal repetitions of a passage right after itself.

Every run contains a Lyndon word of the length of its period, for one of the
two orders of words, as the longest Lyndon word that begins somewhere.  The
suffix tree of the words gives the order of suffixes and so these candidates;
each is extended to the right and, with the tree of the reversed words, to the
left by longest common extensions, and counts if it covers two periods.

A run of at least ``SHORTEST`` words repeats each of its six-word passages
within itself, so the trees are needed only for stretches of words that such
passages cover; passages whose next copy is further than half of the stretch
take no part.  This only leaves out words that no run contains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.suffix_tree import Extensions, SuffixTree
from tidemark.llm.text import as_bytes, hash_words, mix64, ngrams, raw, slices

#: A run has at least so many words, and two periods.
SHORTEST = 12
#: A period repeats at least so many words of a run: 12 - 6 with a period of six, the period itself beyond.
PASSAGE = SHORTEST // 2

FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"


def stretches(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last word of stretches that may hold runs; ``bounds`` are those of the texts."""
    first, last = bounds[:-1], bounds[1:]
    held = -1
    while True:
        long = last - first >= SHORTEST
        first, last = first[long], last[long]
        sizes = last - first
        total = int(sizes.sum())
        if total == held or not total:
            return first, last
        held = total
        # positions at which a passage begins, with the number and the size of their stretch
        counts = sizes - PASSAGE + 1
        owner = np.repeat(np.arange(len(first)), counts)
        at = np.arange(int(counts.sum())) + np.repeat(first - np.cumsum(counts) + counts, counts)
        passage = ngrams(words, PASSAGE)[at] ^ mix64(owner.astype(np.uint64))
        order = np.argsort(passage, kind="stable")
        near = (passage[order[1:]] == passage[order[:-1]]) & (at[order[1:]] - at[order[:-1]] <= sizes[owner[order[1:]]] // 2)
        repeats = np.zeros(len(at), bool)
        repeats[order[1:][near]] = True
        repeats[order[:-1][near]] = True
        # a border after each stretch keeps neighbours apart
        change = np.zeros(int(last[-1]) + len(first) + 1, np.int32)
        np.add.at(change, at[repeats] + owner[repeats], 1)
        np.add.at(change, at[repeats] + owner[repeats] + PASSAGE, -1)
        covered = np.concatenate([[0], (np.cumsum(change) > 0).astype(np.int8), [0]])
        turns = np.diff(covered)
        begin, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        belongs = np.searchsorted(first + np.arange(len(first)), begin, "right") - 1
        first, last = begin - belongs, end - belongs


def next_smaller(ranks: np.ndarray) -> np.ndarray:
    """For each suffix the next one that is smaller, or the place after the last one."""
    rank = [*ranks.tolist(), -1]
    follow = list(range(len(rank)))
    for at in range(len(rank) - 2, -1, -1):
        other = at + 1
        while rank[other] > rank[at]:
            other = follow[other]
        follow[at] = other
    return np.array(follow[:-1], np.int64)


def runs_of(pieces: list[list[bytes]], shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each piece, by start, then period."""
    pieces_in = [k for k, piece in enumerate(pieces) if piece]
    found: list[list[tuple[int, int, int]]] = [[] for _ in pieces]
    if not pieces_in:
        return found
    borders = len(pieces_in)
    text: list[int] = []
    starts = []
    known = borders
    for number, k in enumerate(pieces_in):
        starts.append(len(text))
        symbols = {word: known + n for n, word in enumerate(dict.fromkeys(pieces[k]))}
        known += len(symbols)
        text.extend(map(symbols.__getitem__, pieces[k]))
        text.append(number)  # a border of its own, smaller than all words
    upwards = np.arange(known)
    downwards = np.concatenate([upwards[:borders], upwards[borders:][::-1]])
    tree = SuffixTree(text)
    right = Extensions(tree, upwards)
    after = [next_smaller(right.rank), next_smaller(tree.ranks(downwards))]
    del tree
    left = Extensions(SuffixTree([*text[-2::-1], text[-1]]), upwards)
    size = len(text)
    root = np.flatnonzero(np.array(text) >= borders)
    root, period = np.concatenate([root, root]), np.concatenate([after[0][root] - root, after[1][root] - root])
    forth = right(root, root + period)
    # the tree of the reversed words knows position i as size - 2 - i
    before = root > 0
    back = np.zeros(len(root), np.int64)
    back[before] = left(size - 1 - root[before], size - 1 - root[before] - period[before])
    length = back + period + forth
    is_run = (length >= 2 * period) & (length >= shortest)
    rows = np.unique(np.stack([root - back, period, length], axis=1)[is_run], axis=0)
    owner = np.searchsorted(starts, rows[:, 0], "right") - 1
    for piece, (start, period_, length_) in zip(owner.tolist(), rows.tolist()):
        found[pieces_in[piece]].append((start - starts[piece], length_, period_))
    return found


def document_rows(texts: list[bytes], words: np.ndarray, bounds: np.ndarray) -> tuple[list, list, list]:
    """Number of words, runs and collapsed text of each document of a slice."""
    split = [text.split() for text in texts]
    first, last = stretches(words, bounds)
    owner = np.searchsorted(bounds, first, "right") - 1
    first, last = (first - bounds[owner]).tolist(), (last - bounds[owner]).tolist()
    owner = owner.tolist()
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for doc, begin, found in zip(owner, first, runs_of([split[d][a:b] for d, a, b in zip(owner, first, last)])):
        runs[doc].extend((begin + start, length, period) for start, length, period in found)
    collapsed = []
    for kept, found in zip(split, runs):
        if found:
            change = np.zeros(len(kept) + 1, np.int32)
            start, length, period = np.array(found).T
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            collapsed.append(b" ".join([kept[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]))
        else:
            collapsed.append(b" ".join(kept))
    return [len(kept) for kept in split], runs, collapsed


def found_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        offsets, data = raw(batch.column(1))
        for a, b in slices(offsets):
            here = offsets[a : b + 1] - offsets[a]
            chunk = data[offsets[a] : offsets[b]]
            blob = chunk.tobytes()
            texts = [blob[here[k] : here[k + 1]] for k in range(b - a)]
            counts, runs, collapsed = document_rows(texts, *hash_words(here, chunk))
            columns = [batch.column(0).slice(a, b - a), pa.array(counts, pa.int64()), pa.array(runs, kind)]
            yield pa.record_batch([*columns, pa.array(collapsed, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """All periodic runs of each text of ``docs`` (doc_id, text), and the text without their repeats.

    Columns: doc_id, n_words, runs (start, length and smallest period in words,
    by start, then period) and collapsed (UTF-8 bytes: words that no run
    contains after its first period, joined by one space).  A null or empty
    text has no words and no runs and collapses to nothing; a null doc_id is
    kept; repeated rows are answered one by one; no rows give no rows; other
    columns are not looked at.  A task holds one slice of texts; the trees take
    about 600 bytes a word of the longest text that is periodic throughout.
    """
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), as_bytes().alias("text")).mapInArrow(found_batches, FOUND)
