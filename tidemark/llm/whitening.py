"""Whitening of embeddings by the covariance of their distinct vectors.

Entries become whole numbers; identical vectors are grouped and counted.  The
fit weighs each distinct vector by one or by its count: sums are exact, the
covariance is a product of matrices of centred vectors, one per Arrow batch,
added up by Spark.  Its eigenvectors are found on the driver (the square of
the number of dimensions, whatever the number of rows); each distinct vector is whitened once
and joined back to the rows that have it.

Rows find their vector by two 64-bit hashes of all its entries.  A vector that
more rows have than a block may hold is written once for each block of its rows, so no
task gets them all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import written

#: Whole numbers of an entry's range of one.
SCALE = 256
#: Rows of one vector that may go to one task, and the part of all rows that may.
BLOCK, SHARE = 128, 16_384

WHITE = "x array<bigint>, copies bigint, deviation decimal(38,0), whitened array<double>"


@dataclass
class Space:
    """The fit of all vectors of one length."""

    n: int
    sums: list[int]
    variances: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float | None]:
        return [float(v / self.trace) if self.trace > 0 else None for v in self.variances]


def whole_numbers(vector: str, scale: int = SCALE) -> Column:
    """The vector's entries times ``scale``, rounded down; null for a vector that is null or has no finite numbers."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint")))


def distinct_vectors(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Each vector of whole numbers once, with its number of rows."""
    return vectors.select(whole_numbers(vector, scale).alias("x")).where("x is not null").groupBy("x").agg(F.count("*").alias("copies"))


def _matrices(batch: pa.RecordBatch, weight: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors of a batch by length, with their weights."""
    lists = batch.column(0)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    sizes = np.diff(ends, prepend=0)
    counts = batch.column(1).to_numpy() if weight == "count" else np.ones(len(lists), np.int64)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield flat[(ends[rows] - size)[:, None] + np.arange(size)], counts[rows]


def _halves(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact weighted sums of columns, each as a high part and a low one of 32 bits or more."""
    if int(counts.sum()) < 1 << 31:
        return ((values >> 32) * counts[:, None]).sum(0), ((values & 0xFFFFFFFF) * counts[:, None]).sum(0)
    total = (values.astype(object) * counts.astype(object)[:, None]).sum(0)
    return total >> 32, total & 0xFFFFFFFF


def _sums(weight: str):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["dims", "place", "weight", "high", "low"]
        for batch in batches:
            for x, counts in _matrices(batch, weight):
                dims = x.shape[1]
                high, low = _halves(x, counts)
                total = int(counts.sum())
                # one more place holds the weight, so vectors without entries are counted too
                yield pa.record_batch(
                    [
                        pa.array([dims] * (dims + 1), pa.int32()),
                        pa.array(range(dims + 1), pa.int32()),
                        pa.array([0] * dims + [total], pa.int64()),
                        pa.array([*high.tolist(), 0], pa.int64()),
                        pa.array([*low.tolist(), 0], pa.int64()),
                    ],
                    names,
                )

    return sums


def _scatter(weight: str, means: dict[int, np.ndarray]):
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added: dict[int, np.ndarray] = {}
        for batch in batches:
            for x, counts in _matrices(batch, weight):
                centred = x - means[x.shape[1]]
                product = (centred * counts[:, None]).T @ centred
                added[x.shape[1]] = added.get(x.shape[1], 0) + product
        for dims, matrix in added.items():
            if dims:
                rows = pa.array(list(matrix), pa.list_(pa.float64()))
                yield pa.record_batch([pa.array([dims] * dims, pa.int32()), pa.array(range(dims), pa.int32()), rows], ["dims", "place", "row"])

    return scatter


def fit(distinct: DataFrame, weight: str = "one", components: int = 4) -> dict[int, Space]:
    """Means and first components of ``distinct`` (x, copies), by length of vector; ``weight`` is "one" or "count".

    Vectors of each length are a space of their own.  Components have falling
    variances; the entry of largest size is positive.  The driver gets, for each length that
    occurs, the square of that length in numbers.
    """
    if weight not in ("one", "count"):
        raise ValueError("weight is 'one' or 'count'")
    parts = distinct.select("x", "copies").mapInArrow(_sums(weight), "dims int, place int, weight long, high long, low long")
    exact = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("weight", "high", "low")]
    totals: dict[int, dict[int, tuple[int, int]]] = {}
    for row in parts.groupBy("dims", "place").agg(*exact).collect():
        totals.setdefault(row.dims, {})[row.place] = (int(row["weight"]), (int(row.high) << 32) + int(row.low))
    counts = {dims: found[dims][0] for dims, found in totals.items()}
    sums = {dims: [found[k][1] for k in range(dims)] for dims, found in totals.items()}
    means = {dims: np.array([s / counts[dims] for s in sums[dims]], np.float64) for dims in totals}
    matrices = {dims: np.zeros((dims, dims)) for dims in totals}
    scattered = distinct.select("x", "copies").mapInArrow(_scatter(weight, means), "dims int, place int, row array<double>")
    cells = scattered.select("dims", "place", F.posexplode("row").alias("other", "value"))
    for row in cells.groupBy("dims", "place", "other").agg(F.sum("value").alias("value")).collect():
        matrices[row.dims][row.place, row.other] = row["value"] / counts[row.dims]
    return {dims: _space(counts[dims], sums[dims], matrices[dims], components) for dims in totals}


def _space(n: int, sums: list[int], covariance: np.ndarray, components: int) -> Space:
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2) if len(sums) else (np.zeros(0), np.zeros((0, 0)))
    values, vectors = values[::-1][:components].clip(0), vectors[:, ::-1][:, :components]
    if vectors.size:
        largest = np.abs(vectors).argmax(0)
        vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
    # what rounding alone may give is no variance
    values = np.where(values > len(sums) * np.finfo(float).eps * values.max(initial=0), values, 0)
    return Space(n, sums, values, vectors, float(np.trace(covariance)))


def _lists(matrix: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as lists; what is no number becomes null."""
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(matrix.shape[1])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel(), from_pandas=True))


def _deviations(x: np.ndarray, space: Space) -> list[int]:
    """Exact sums of (n * x - sums) squared."""
    largest = max(-int(x.min(initial=0)), int(x.max(initial=0)))
    bound = space.n * largest + max(map(abs, space.sums), default=0)
    if bound * bound * max(len(space.sums), 1) < 1 << 62:
        gaps = x * space.n - np.array(space.sums, np.int64)
        return (gaps * gaps).sum(1).tolist()
    return [sum((space.n * v - s) ** 2 for v, s in zip(row, space.sums)) for row in x.tolist()]


def whiten_distinct(distinct: DataFrame, spaces: dict[int, Space]) -> DataFrame:
    """Each vector of ``distinct`` (x, copies) with its exact deviation and its whitened components."""

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, copies in _matrices(batch, "count"):
                space = spaces[x.shape[1]]
                mean = np.array([s / space.n for s in space.sums], np.float64)
                known = space.variances > 0
                scores = np.full((len(x), len(known)), np.nan)
                scores[:, known] = (x - mean) @ space.components[:, known] / np.sqrt(space.variances[known])
                # beyond 38 digits there is no exact number to give
                deviations = [d if d < 10**38 else None for d in _deviations(x, space)]
                yield pa.record_batch(
                    [
                        _lists(x),
                        pa.array(copies),
                        pa.array(deviations, pa.decimal128(38, 0)),
                        _lists(scores),
                    ],
                    ["x", "copies", "deviation", "whitened"],
                )

    return distinct.select("x", "copies").mapInArrow(whitened, WHITE)


def identity_errors(white: DataFrame, spaces: dict[int, Space]) -> dict[int, float | None]:
    """Largest distance of the covariance of whitened vectors (dims, fit_weight, whitened) from the identity, by length."""
    most = max((len(space.variances) for space in spaces.values()), default=0)
    if not most:
        return dict.fromkeys(spaces)
    each = white.select("dims", "fit_weight", *[F.get("whitened", F.lit(k)).alias(f"w{k}") for k in range(most)])

    def mean(values: Column) -> Column:
        # a component without variance is null in all rows
        return F.sum(values * F.col("fit_weight")) / F.sum("fit_weight")

    means = each.groupBy("dims").agg(*[mean(F.col(f"w{k}")).alias(f"m{k}") for k in range(most)]).collect()
    centre = F.lit(None).cast("array<double>")
    for row in means:
        values = F.array(*[F.lit(row[f"m{k}"]).cast("double") for k in range(most)])
        centre = F.when(F.col("dims") == row.dims, values).otherwise(centre)
    centred = each.select("dims", "fit_weight", *[(F.col(f"w{k}") - F.get(centre, F.lit(k))).alias(f"c{k}") for k in range(most)])
    pairs = [(a, b) for a in range(most) for b in range(a, most)]
    products = [mean(F.col(f"c{a}") * F.col(f"c{b}")).alias(f"p{a}_{b}") for a, b in pairs]
    errors: dict[int, float | None] = dict.fromkeys(spaces)
    for row in centred.groupBy("dims").agg(*products).collect():
        gaps = [abs(row[f"p{a}_{b}"] - (a == b)) for a, b in pairs if row[f"p{a}_{b}"] is not None]
        errors[row.dims] = max(gaps, default=None)
    return errors


def _keys() -> list[Column]:
    return [F.xxhash64("x").alias("key"), F.xxhash64(F.lit("other"), "x").alias("check")]


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, weight: str = "one", components: int = 4) -> DataFrame:
    """Whitened components of each row of ``vectors``, one row for each.

    Columns: vec_id, component (from 1, falling variance), n (distinct vectors;
    with weight "count" their rows), deviation (exact, decimal), whitened,
    explained and identity_error.  Rows whose vector is null or holds a null
    or no finite number are dropped; other columns are not looked at.  A null
    vec_id is kept and repeated rows are answered one by one.  Vectors of
    another length are a space of their own; those with fewer entries have fewer
    components, without entries none.  A component without variance (as with one
    vector only, or equal ones) has null in ``whitened``, its share is 0 (null
    if nothing varies) and it does not count in identity_error.  No rows give no rows.
    """
    spark = vectors.sparkSession
    distinct = written(distinct_vectors(vectors, vector, scale), "vectors")
    spaces = fit(distinct, weight, components)
    fit_weight = F.col("copies") if weight == "count" else F.lit(1)
    measured = whiten_distinct(distinct, spaces).select(
        F.size("x").alias("dims"), *_keys(), "copies", fit_weight.cast("long").alias("fit_weight"), "deviation", "whitened"
    )
    white = written(measured, "whitened")
    errors = identity_errors(white, spaces)
    total = white.agg(F.sum("copies")).first()[0] or 0
    unit = max(BLOCK, -(-total // SHARE))
    blocks = F.ceil(F.col("copies") / unit).cast("int").alias("blocks")
    # fewer than SHARE vectors have more rows than a block, so the list of them may be broadcast
    hot = white.where(F.col("copies") > unit).select("key", "check", blocks)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), whole_numbers(vector, scale).alias("x")).where("x is not null")
    dealt = (
        rows.select("vec_id", *_keys())
        .join(F.broadcast(hot), ["key", "check"], "left")
        .withColumn("block", F.coalesce(F.pmod(F.xxhash64("vec_id"), F.col("blocks")), F.lit(0)).cast("int"))
    )
    held = white.select("dims", "key", "check", "deviation", "whitened", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    joined = dealt.drop("blocks").join(held, ["key", "check", "block"])
    schema = "dims int, n long, explained array<double>, identity_error double"
    models = [(dims, space.n, space.explained, errors[dims]) for dims, space in spaces.items()]
    each = joined.join(F.broadcast(spark.createDataFrame(models, schema)), "dims")
    each = each.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get("explained", F.col("at")).alias("explained"),
        "identity_error",
    )
