"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to three bytes deep is counted on
a bounded sample.  A byte that its context has seen costs its share of the
context's count; otherwise an escape is paid and the context one byte shorter
is asked, down to all bytes alike.  With frozen counts the code length of a
byte depends on itself and three bytes before it, so all lengths are tables,
and a text's exact code length in every language is a sum of look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import carries_columns
from tidemark.llm.quality import held_out
from tidemark.llm.text import as_bytes, raw, slices

DEPTH = 3
#: Texts that each language's tree is counted on at most, about.
SAMPLE = 1500
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[c for c in range(128) if not chr(c).isalpha()]] = 32


def letters(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts in lower case with one space for what is no letter, each after ``DEPTH`` spaces; their new offsets."""
    low = _LOWER[data]
    accented = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    low[accented] += 32  # Latin capitals with accents in UTF-8
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
    counts = np.concatenate([[0], np.cumsum(keep)])[offsets]
    at = counts + DEPTH * np.arange(len(offsets))
    out = np.full(at[-1], 32, np.uint8)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(counts))
    out[np.arange(counts[-1]) + DEPTH * (text + 1)] = low[keep]
    return at, out


def grams(at: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed (three bytes of context, byte) at each coded byte, and its text."""
    wide = data.astype(np.uint32)
    packed = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
    sizes = np.diff(at) - DEPTH
    text = np.repeat(np.arange(len(sizes)), sizes)
    return packed[np.arange(len(text)) + DEPTH * text], text


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the packed grams of each language in a task's rows (lang, text)."""
    for batch in batches:
        offsets, data = raw(batch.column(1))
        langs = batch.column(0).to_pylist()
        names = sorted(set(langs))
        code = np.array([names.index(lang) for lang in langs], np.uint64)
        for first, last in slices(offsets):
            low, high = offsets[first], offsets[last]
            gram, text = grams(*letters(offsets[first : last + 1] - low, data[low:high]))
            key, count = np.unique((code[first:last][text] << np.uint64(32)) | gram, return_counts=True)
            yield pa.record_batch(
                [
                    pa.array([names[k] for k in (key >> np.uint64(32)).tolist()], pa.string()),
                    pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                    pa.array(count.astype(np.int64)),
                ],
                ["lang", "gram", "n"],
            )


@dataclass
class Trees:
    """Code lengths in bits.  Level k holds, for the contexts of k bytes that a language has seen, two tables:
    ``costs[k]`` by the id of context and byte, ``escapes[k]`` by the id of the context."""

    languages: list[str]
    grams: list[np.ndarray]  # level k: sorted packed (k bytes of context, byte)
    costs: list[np.ndarray]
    escapes: list[np.ndarray]  # level k: by the place of the context among grams[k - 1]

    def lengths(self, packed: np.ndarray) -> np.ndarray:
        """Bits of each gram (rows) in each language (columns)."""
        out = np.zeros((len(packed), len(self.languages)), np.float32)
        left = np.arange(len(packed))
        for level in range(DEPTH, -1, -1):
            bits = 8 * (level + 1)
            key = packed[left] & np.uint32((1 << bits) - 1)
            place, seen = find(self.grams[level], key)
            out[left[seen]] += self.costs[level][place[seen]]
            left, key = left[~seen], key[~seen]
            if not len(left):
                break
            if level:
                context, known = find(self.grams[level - 1], key >> np.uint32(8))
                out[left[known]] += self.escapes[level][context[known]]
            else:
                out[left] += self.escapes[0][0] + 8
        return out


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return place, table[place] == keys


def grow(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Trees:
    """Trees from each language's grams and counts; an escape weighs as many counts as the context has bytes."""
    languages = sorted(counts)
    levels, costs, escapes = [], [], []
    for level in range(DEPTH + 1):
        mask = np.uint32((1 << 8 * (level + 1)) - 1)
        every = np.unique(np.concatenate([counts[lang][0] & mask for lang in languages]))
        above = levels[level - 1] if level else np.zeros(1, np.uint32)
        cost = np.zeros((len(every), len(languages)), np.float32)
        escape = np.zeros((len(above), len(languages)), np.float32)
        # a context of k bytes is a gram of level k - 1; one that ends no text is followed by something
        context = np.searchsorted(above, every >> np.uint32(8)) if level else np.zeros(len(every), np.int64)
        known = above[np.minimum(context, len(above) - 1)] == (every >> np.uint32(8)) if level else context == 0
        context = np.minimum(context, len(above) - 1)
        for at, lang in enumerate(languages):
            gram, n = counts[lang]
            own = np.zeros(len(every))
            np.add.at(own, np.searchsorted(every, gram & mask), n)
            total = np.bincount(context[known], own[known], len(above))
            kinds = np.bincount(context[known], own[known] > 0, len(above))
            escape[:, at] = np.where(total > 0, np.log2(np.maximum(total + kinds, 1) / np.maximum(kinds, 1)), 0)
            shorter = np.full(len(every), 8.0 + (0 if level else escape[0, at]))
            if level:
                shorter = escape[context, at] * known + costs[level - 1][
                    np.searchsorted(levels[level - 1], every & (mask >> np.uint32(8))), at
                ]
            here = np.log2(np.maximum((total + kinds)[context], 1) / np.maximum(own, 1e-9))
            cost[:, at] = np.where((own > 0) & known, here, shorter)
        levels.append(every)
        costs.append(cost)
        escapes.append(escape)
    return Trees(languages, levels, costs, escapes)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from about ``sample`` texts of each language outside the held-out fold.

    Rows without text, lang or doc_id teach nothing.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    shares = usable.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(sample)) / F.count("*")).alias("share"))
    random = F.pmod(F.xxhash64("doc_id", F.lit(41)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = usable.join(F.broadcast(shares), "lang").where(random < F.col("share"))  # one row a language
    counted = chosen.select("lang", as_bytes().alias("text")).mapInArrow(count_grams, "lang string, gram long, n long")
    rows = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()  # of the bounded sample
    counts = {
        lang: (part["gram"].to_numpy().astype(np.uint32), part["n"].to_numpy().astype(float))
        for lang, part in rows.groupby("lang")
    }
    return grow(counts) if counts else Trees([], [], [], [])


@carries_columns
def identify(docs: DataFrame, trees: Trees, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if not given) beside lang_pred and score, the language's posterior share.

    The language with the shortest code for the whole text, ties to the first
    name; ``und`` with score 0 if the text is null, has no letter, or no
    language was learned.  Columns of the same names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    kept = [c for c in (keep or docs.columns) if c not in ("lang_pred", "score")]
    columns = [F.col(f"`{c}`") for c in kept]
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    wide = docs.select(*columns, as_bytes().alias("_bytes"), letter.alias("_letter"))

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            names, scores = best(trees, *raw(batch.column(len(kept))))
            has_letter = batch.column(len(kept) + 1).to_numpy(zero_copy_only=False)
            names = [name if known else UNKNOWN for name, known in zip(names, has_letter)]
            out = [pa.array(names, pa.string()), pa.array(np.where(has_letter, scores, 0.0))]
            yield pa.RecordBatch.from_arrays(batch.columns[: len(kept)] + out, names=kept + ["lang_pred", "score"])

    schema = docs.select(*columns).schema.add("lang_pred", "string").add("score", "double")
    return wide.mapInArrow(identified, schema)


def code_lengths(trees: Trees, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Bits of each text in each language."""
    bits = np.zeros((len(offsets) - 1, len(trees.languages)))
    for first, last in slices(offsets):
        low, high = offsets[first], offsets[last]
        gram, text = grams(*letters(offsets[first : last + 1] - low, data[low:high]))
        each = trees.lengths(gram)
        for at in range(len(trees.languages)):
            bits[first:last, at] = np.bincount(text, each[:, at], last - first)
    return bits


def best(trees: Trees, offsets: np.ndarray, data: np.ndarray) -> tuple[list[str], np.ndarray]:
    if not trees.languages:
        return [UNKNOWN] * (len(offsets) - 1), np.zeros(len(offsets) - 1)
    bits = code_lengths(trees, offsets, data)
    least = bits.argmin(1)
    share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
    return [trees.languages[k] for k in least], share
