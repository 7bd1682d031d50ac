"""A caller's columns that are named like an operator's own."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import html, language, licenses, lines, mixing, neighbours, ngram_join, quality, rules
from tidemark.llm.columns import set_aside

#: Working names of the operators, names that need quotes, and names that are free.
NAMES = ["_bytes", "_letter", "_html", "_words", "_lines", "_present", "_likely", "_hits", "_base0", "_matches", "_removed", "_hash",
         "_parts", "_taken", "_size", "_copies", "_block", "_key", "_doc", "a.b", "c`d", "aside_0", "extra"]
TEXTS = ["one two three four five six", "one two three four five six\nseven", None]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, text, "en", "s", *[f"{name}{k}" for name in NAMES]) for k, text in enumerate(TEXTS)]
    names = ", ".join(f"`{name.replace('`', '``')}` string" for name in NAMES)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {names}")


OPERATORS = {
    "score": lambda docs: quality.score(docs, np.zeros((1 << quality.BITS) + 1)),
    "identify": lambda docs: language.identify(docs, language.fit(docs)),
    "extract": lambda docs: html.extract(docs.withColumnRenamed("text", "html")),
    "dedup": lines.dedup,
    "mixed": lambda docs: mixing.mixed_documents(docs, mixing.mix(docs)),
    "representatives": lambda docs: ngram_join.representatives(docs, ngram_join.join(docs)),
    "quality": rules.quality,
    "scan": licenses.scan,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_columns_are_kept(docs, name):
    out = OPERATORS[name](docs)
    rows = out.collect()
    assert rows and set(NAMES) <= set(out.columns)
    at = {column: k for k, column in enumerate(out.columns)}
    for row in rows:
        assert [row[at[column]] for column in NAMES] == [f"{column}{row[at['doc_id']]}" for column in NAMES]


def test_names_set_aside():
    assert set_aside(["a", "b"]) == {}
    assert set_aside(["_x", "aside_0", "a.b"]) == {"_x": "aside_1", "a.b": "aside_2"}


def test_vectors_of_doubles(spark):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(300, 12)) / 3
    rows = [(k, [float(x) for x in p], "e") for k, p in enumerate(points)]
    df = spark.createDataFrame(rows + [(400, [float("inf")] * 12, "e"), (500, [1.0] * 5, "e")], "vec_id long, embedding array<double>, width string")
    found = neighbours.search(neighbours.build_index(df, shard_rows=100), df.where("vec_id % 100 = 0")).collect()
    assert {row.query_id for row in found} == {0, 100, 200}
    for row in found:
        gap = points[row.vec_id] - points[row.query_id]
        assert row.score == np.sqrt((gap * gap).sum())


def test_ties_go_to_the_smaller_id(spark):
    rows = [(k, [float(k % 2), 1.0]) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = neighbours.search(neighbours.build_index(df, shard_rows=7), df.where("vec_id = 0"), k=5).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(n, 2 * n, 0.0) for n in range(1, 6)]
