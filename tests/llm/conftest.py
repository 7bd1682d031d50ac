from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    def make(rows):
        """Documents of (doc_id, text) or (doc_id, text, lang, source)."""
        full = [(*row, *[None] * (4 - len(row)))[:4] for row in rows]
        return spark.createDataFrame([(*row, len(row[1]) if row[1] is not None else None) for row in full], DOCUMENTS)

    return make


def near_copies(words: int = 60, copies: int = 12) -> list[str]:
    """A text, copies with one word changed each, and texts that share only a part of it."""
    base = [f"word{k}" for k in range(words)]
    changed = [" ".join(base[:k] + [f"other{k}"] + base[k + 1 :]) for k in range(0, words, words // copies)]
    half = [" ".join(base[: words // 2] + [f"own{j}x{k}" for k in range(words // 2)]) for j in range(5)]
    return [" ".join(base), *changed, *half]


ODD = [
    (1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, "One"), (5, "one two three"), (None, "one two three four five six"),
    (7, "one two three four five six"), (7, "one two three four five six"), (8, "x " * 30_000), (9, "a\nb\na\n\nc"),
]
