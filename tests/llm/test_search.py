"""Nearest neighbours against brute force, and the pipeline."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from tidemark.llm import neighbours


def test_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(1500, 16)).astype(np.float32)
    points[200:700] = points[0]  # a vector that a third of the rows share
    rows = [(k, [float(x) for x in p], k) for k, p in enumerate(points)]
    odd = [(2000, None, 0), (2100, [0.0] * 16, 0), (2200, [float("nan")] * 16, 0), (2300, [None] + [1.0] * 15, 0), (None, rows[1][1], 0), rows[5]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, extra int")
    found = neighbours.search(neighbours.build_index(df, shard_rows=400), df.where("vec_id % 100 = 0")).collect()
    ids = np.arange(1500)
    exact = neighbours.brute_force(points, ids, points[::100], ids[::100])
    got: dict = {}
    for row in found:
        got.setdefault(row.query_id, {})[row["rank"]] = (row.vec_id, row.score)
    assert set(got) == set(exact)
    right = 0
    for query, want in exact.items():
        assert sorted(got[query]) == list(range(1, 11))
        right += len({v for v, _ in want} & {v for v, _ in got[query].values()})
        for vec_id, score in got[query].values():
            gap = points[vec_id].astype(float) - points[query].astype(float)
            assert score == np.sqrt((gap * gap).sum())
    assert right >= 0.9 * 10 * len(exact)


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in neighbours.search(neighbours.build_index(few), few.where("vec_id = 0")).collect()] == [(0, 1, 1, 2**0.5)]
    assert neighbours.search(neighbours.build_index(few.limit(0)), few).count() == 0


def test_pipeline(spark, sf):
    packed = corpus_pipeline.run(spark, sf)
    assert packed.columns[:4] == ["doc_id", "start", "length", "doc_tokens"]
    fill = packed.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0]
    assert 0 < fill <= 2048
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
