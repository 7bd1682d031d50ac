"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader updates.

A token is a run of letters, digits and bytes beyond ASCII, or a run of
punctuation.  Features are the shares of hashed runs of one and two tokens; two
equal tokens in a row are one feature whatever the token.  The model is fitted
on a bounded sample of labelled rows, shard by shard, and the shards' weights
are averaged; whole texts are scored as sparse dot products where they are
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import carries_columns
from tidemark.llm.text import as_bytes, give_back, hash_spans, mix64, raw, slices, trimmed

BITS = 18
SCALE = 30.0
#: Labelled rows that the model is fitted on at most, about.
SAMPLE = 12_000
SHARDS = 6
EPOCHS = 3
#: Rows of doc_id's checksum that are kept from training: one in so many.
FOLDS = 5
THRESHOLD = 0.3

_KIND = np.full(256, 2, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % FOLDS == 0, F.lit(False))


def token_spans(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last byte of each run of one kind; runs end with their text."""
    kind = _KIND[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    edges = np.flatnonzero(edge)
    starts, ends = edges[:-1], edges[1:]
    full = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    return starts[full], ends[full]


def features(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of a batch and, for each, the text it is in."""
    starts, ends = token_spans(offsets, data)
    words = hash_spans(data, starts, ends, lower=False)
    text = np.searchsorted(offsets, starts, "right") - 1
    together = text[1:] == text[:-1]
    pairs = mix64(words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:])
    pairs[words[1:] == words[:-1]] = 1
    number = np.concatenate([words, pairs[together]]) >> np.uint64(64 - BITS)
    return number.astype(np.int64), np.concatenate([text, text[1:][together]])


def dot_products(offsets: np.ndarray, data: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log-odds of each text; the last weight is the bias."""
    out = np.full(len(offsets) - 1, float(weights[-1]))
    for first, last in slices(offsets):
        low, high = offsets[first], offsets[last]
        if low == high:
            continue
        number, text = features(offsets[first : last + 1] - low, data[low:high])
        total = np.bincount(text, weights[number], last - first)
        count = np.bincount(text, minlength=last - first)
        out[first:last] += SCALE * total / np.maximum(count, 1)
    return out


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int, alpha=0.3, beta=1.0, l1=0.0005, l2=0.0005):
    """Weights after passing over (features, values, label) in order; per-coordinate rates, L1 and L2."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for at, values, label in examples:
            w = weights(at)
            odds = float(np.clip(w @ values, -35, 35))
            gradient = (1 / (1 + np.exp(-odds)) - label) * values
            squares = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(squares) - np.sqrt(n[at])) / alpha * w
            n[at] = squares
    return weights(np.arange(size))


def fit_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """Weights of one shard of (order, text, label)."""
    rows = rows.sort_values("order")
    examples = []
    for text, label in zip(rows["text"], rows["label"]):
        data = np.frombuffer(text or b"", np.uint8)
        number, _ = features(np.array([0, len(data)]), data) if len(data) else (np.zeros(0, np.int64), None)
        at, counts = np.unique(number, return_counts=True)
        values = SCALE * counts / max(1, len(number))
        examples.append((np.append(at, 1 << BITS), np.append(values, 1.0), int(label)))
    weights = ftrl(examples, EPOCHS)
    at = np.flatnonzero(weights)
    # the worker stays and shares the executor with the stages that follow
    del examples
    give_back()
    return pd.DataFrame({"at": at, "weight": weights[at]})


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights learned from at most about ``sample`` labelled rows outside the held-out fold.

    Rows without a label or doc_id teach nothing; if labels disagree the lower
    one counts.  Without any labelled row all weights are 0.
    """
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    total = usable.count()
    share = min(1.0, sample / max(1, total))
    random = F.xxhash64("doc_id", F.lit(29))
    chosen = usable.where(F.pmod(random, F.lit(1 << 30)) < int(share * (1 << 30)))
    chosen = chosen.groupBy("doc_id").agg(F.min("quality").alias("label"))
    picked = docs.select("doc_id", as_bytes().alias("text")).join(F.broadcast(chosen), "doc_id")
    shard = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(SHARDS)).alias("shard")
    rows = picked.select(shard, F.xxhash64("doc_id", "text", F.lit(37)).alias("order"), "text", "label")
    parts = rows.groupBy("shard").applyInPandas(fit_shard, "at long, weight double")
    weights = np.zeros((1 << BITS) + 1)
    for row in parts.groupBy("at").agg((F.sum("weight") / SHARDS).alias("weight")).toLocalIterator():  # at most 2^BITS + 1
        weights[row["at"]] = row["weight"]
    return weights


@carries_columns
def score(
    docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if not given) beside score (0 to 1) and predicted (1 from ``threshold`` on).

    Only the text is read for a score; null and empty texts get that of the
    bias alone.  Columns named score or predicted are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    kept = [c for c in (keep or docs.columns) if c not in ("score", "predicted")]
    columns = [F.col(f"`{c}`") for c in kept]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = dot_products(*raw(batch.column(len(kept))), shared.value)
            out = [pa.array(1 / (1 + np.exp(-np.clip(odds, -35, 35))))]
            yield pa.RecordBatch.from_arrays(batch.columns[: len(kept)] + out, names=kept + ["score"])

    schema = docs.select(*columns).schema.add("score", "double")
    out = docs.select(*columns, as_bytes().alias("_bytes")).mapInArrow(lambda batches: trimmed(scored(batches)), schema)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
