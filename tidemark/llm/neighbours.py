"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Vectors are dealt by a hash into shards of bounded size.  In each shard, nodes
are inserted in random order; a node of level L is linked, on every level up
to L, to a spread of its nearest earlier nodes, and these link back, pruned by
the same rule.  Candidates for links are found by blocks of exact distances
instead of by searching the unfinished graph, which a bounded shard allows.
Links are flat arrays of node numbers.  A search walks greedily down the upper
levels, keeps the ``ef`` best on the lowest one, and the shards' results are
merged by distance.

Equal vectors of a shard are one node with all their ids, so a vector that a
third of the rows share makes no cluster that links only to itself.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import written

#: Vectors that one shard holds on average.
SHARD_ROWS = 4096
#: Links of a node on the upper levels; twice as many on the lowest.
LINKS = 16
#: Nearest earlier nodes among which links are chosen.
CANDIDATES = 64
#: Nodes that a search keeps on the lowest level.
EF = 160
#: Queries that are searched together.
BLOCK = 512

INDEX = (
    "dims int, shard int, vectors binary, width int, owner binary, ids binary, "
    "levels array<struct<nodes:binary,links:binary>>"
)
HITS = "query_id long, vec_id long, score double"


def spread(vectors: np.ndarray, near: np.ndarray, distance: np.ndarray, most: int) -> np.ndarray:
    """For each node, up to ``most`` of its candidates (nearest first, -1 for none), each nearer to the node than to
    any chosen before it; free places are filled with the nearest left."""
    rows, width = near.shape
    chosen = np.full((rows, most), -1, np.int32)
    for first in range(0, rows, 256):
        part, far = near[first : first + 256], distance[first : first + 256]
        points = vectors[np.maximum(part, 0)]
        norm = (points * points).sum(2)
        between = norm[:, :, None] + norm[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
        keep = np.zeros(part.shape, bool)
        for c in range(width):
            nearer = ((between[:, c, :] < far[:, c, None]) & keep).any(1)
            keep[:, c] = (part[:, c] >= 0) & ~nearer & (keep.sum(1) < most)
        order = np.argsort(np.where(keep, 0, np.where(part >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
        picked = np.take_along_axis(part, order, 1)
        chosen[first : first + 256, : picked.shape[1]] = picked
    return chosen


def nearest_earlier(vectors: np.ndarray, nodes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``nodes`` (in order of insertion) its nearest among those before it, and squared distances."""
    points = vectors[nodes]
    norm = (points * points).sum(1)
    most = min(most, max(1, len(nodes) - 1))
    near = np.full((len(nodes), most), -1, np.int32)
    far = np.full((len(nodes), most), np.inf, np.float32)
    for first in range(0, len(nodes), 512):
        last = min(first + 512, len(nodes))
        d = norm[first:last, None] + norm[None, :last] - 2 * points[first:last] @ points[:last].T
        d[np.arange(last)[None, :] >= np.arange(first, last)[:, None]] = np.inf
        width = min(most, last)
        at = np.argpartition(d, width - 1, axis=1)[:, :width]
        value = np.take_along_axis(d, at, 1)
        order = np.argsort(value, axis=1, kind="stable")
        at, value = np.take_along_axis(at, order, 1), np.take_along_axis(value, order, 1)
        near[first:last, :width] = np.where(np.isfinite(value), nodes[at], -1)
        far[first:last, :width] = value
    return near, far


def link_level(vectors: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
    """Links of one level: forth to a spread of earlier nodes, back to those that chose the node, pruned alike."""
    near, far = nearest_earlier(vectors, nodes, CANDIDATES)
    forth = spread(vectors, near, far, most // 2 if most > LINKS else most)
    place = np.full(len(vectors), -1, np.int64)
    place[nodes] = np.arange(len(nodes))
    a, k = np.nonzero(forth >= 0)
    b = place[forth[a, k]]
    pairs = np.unique(np.concatenate([a * len(nodes) + b, b * len(nodes) + a]))
    one, other = pairs // len(nodes), pairs % len(nodes)
    gap = vectors[nodes[one]] - vectors[nodes[other]]
    d = (gap * gap).sum(1)
    order = np.lexsort((d, one))
    one, other, d = one[order], other[order], d[order]
    rank = np.arange(len(one)) - np.searchsorted(one, one)
    width = max(most, min(4 * most, int(rank.max(initial=0)) + 1))
    near = np.full((len(nodes), width), -1, np.int32)
    far = np.full((len(nodes), width), np.inf, np.float32)
    fits = rank < width
    near[one[fits], rank[fits]] = nodes[other[fits]]
    far[one[fits], rank[fits]] = d[fits]
    return spread(vectors, near, far, most)


def build_graph(vectors: np.ndarray, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the lowest: the nodes in order of insertion and their links."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(vectors)).astype(np.int32)
    height = np.floor(-np.log(1 - rng.random(len(vectors))) / np.log(LINKS)).astype(int)
    levels = []
    for level in range(int(height.max(initial=0)) + 1):
        nodes = order[height[order] >= level]
        levels.append((nodes, link_level(vectors, nodes, LINKS if level else 2 * LINKS)))
    return levels


class Graph:
    """A shard's graph, ready to be searched."""

    def __init__(self, vectors: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors, self.levels = vectors, []
        for nodes, links in levels:
            flat = np.full((len(vectors), links.shape[1]), -1, np.int32)
            flat[nodes] = links
            self.levels.append(flat)
        self.entry = int(levels[-1][0][0])

    def _distances(self, query: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        gap = self.vectors[nodes] - query
        return np.einsum("ij,ij->i", gap, gap)

    def search(self, query: np.ndarray, ef: int) -> list[int]:
        """The ``ef`` nodes found nearest."""
        at = self.entry
        best = float(self._distances(query, np.array([at]))[0])
        for links in self.levels[:0:-1]:
            while True:
                around = links[at]
                around = around[around >= 0]
                if not len(around):
                    break
                d = self._distances(query, around)
                k = int(d.argmin())
                if d[k] >= best:
                    break
                at, best = int(around[k]), float(d[k])
        seen = np.zeros(len(self.vectors), bool)
        seen[at] = True
        ahead, kept = [(best, at)], [(-best, at)]
        ground = self.levels[0]
        while ahead:
            d, node = heapq.heappop(ahead)
            if d > -kept[0][0] and len(kept) >= ef:
                break
            around = ground[node]
            around = around[around >= 0]
            around = around[~seen[around]]
            if not len(around):
                continue
            seen[around] = True
            distances = self._distances(query, around)
            if len(kept) >= ef:
                inside = distances < -kept[0][0]
                around, distances = around[inside], distances[inside]
            for dist, other in zip(distances.tolist(), around.tolist()):
                if len(kept) < ef:
                    heapq.heappush(kept, (-dist, other))
                elif dist < -kept[0][0]:
                    heapq.heapreplace(kept, (-dist, other))
                else:
                    continue
                heapq.heappush(ahead, (dist, other))
        return [node for _, node in kept]


def build_shard(table: pa.Table) -> pa.Table:
    """One row: the shard's distinct vectors, whose rows they are, and the levels of its graph."""
    dims, shard = table["dims"][0].as_py(), table["shard"][0].as_py()
    rows = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    ids = table["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")  # the order of arrival may differ in a second attempt
    rows, ids = np.ascontiguousarray(rows[order]), ids[order]
    vectors, owner = np.unique(rows, axis=0, return_inverse=True)
    with np.errstate(over="ignore"):
        levels = build_graph(vectors.astype(np.float32), int(shard))
    return pa.table(
        {
            "dims": pa.array([dims], pa.int32()),
            "shard": pa.array([shard], pa.int32()),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "width": pa.array([vectors.dtype.itemsize], pa.int32()),
            "owner": pa.array([owner.astype(np.int32).tobytes()], pa.binary()),
            "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
            "levels": pa.array(
                [[{"nodes": n.astype(np.int32).tobytes(), "links": k.tobytes()} for n, k in levels]],
                pa.list_(pa.struct([("nodes", pa.binary()), ("links", pa.binary())])),
            ),
        }
    )


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding) that take part: no null, zero or non-finite vectors, no null ids.

    Vectors of floats stay so, all others are taken in double precision.
    """
    values = F.col("embedding")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(values, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & values.isNotNull() & finite & some)
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "array<float>" if single else "array<double>"
    return rows.select(F.col("vec_id").cast("long"), values.cast(kind).alias("embedding")).distinct()


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard of ``vectors`` (vec_id, embedding): every usable row is in it.  Vectors of different length
    are in different shards and never meet."""
    rows = usable(vectors).withColumn("dims", F.size("embedding"))
    shards = max(1, -(-vectors.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(shards)).cast("int"))
    return written(dealt.groupBy("dims", "shard").applyInArrow(build_shard, INDEX), "graphs")


def search_shards(k: int, ef: int):
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                dims = get["dims"]
                vectors = np.frombuffer(get["vectors"], f"<f{get['width']}").reshape(-1, dims)
                ids = np.frombuffer(get["ids"], np.int64)
                owner = np.frombuffer(get["owner"], np.int32)
                levels = [
                    (np.frombuffer(x["nodes"], np.int32), np.frombuffer(x["links"], np.int32)) for x in get["levels"]
                ]
                with np.errstate(over="ignore"):
                    single = vectors.astype(np.float32, copy=False)
                graph = Graph(single, [(nodes, links.reshape(len(nodes), -1)) for nodes, links in levels])
                members = np.argsort(owner, kind="stable")
                starts = np.searchsorted(owner[members], np.arange(len(vectors) + 1))
                out: list[tuple[int, int, float]] = []
                for query in get["queries"]:
                    out += hits_of(graph, vectors, query, ids, members, starts, k, ef)
                query_id, vec_id, score = zip(*out) if out else ((), (), ())
                yield pa.record_batch(
                    [pa.array(query_id, pa.int64()), pa.array(vec_id, pa.int64()), pa.array(score, pa.float64())],
                    ["query_id", "vec_id", "score"],
                )

    return searched


def hits_of(graph: Graph, vectors, query: dict, ids, members, starts, k: int, ef: int) -> list[tuple[int, int, float]]:
    """The query's ``k`` nearest of one shard, by exact distances of the original vectors in double precision."""
    point = np.array(query["embedding"], np.float64)
    nodes = np.array(graph.search(point.astype(np.float32), ef))
    gap = vectors[nodes].astype(np.float64) - point
    distance = np.sqrt((gap * gap).sum(1))
    best = []
    for at in np.argsort(distance, kind="stable"):
        if len(best) >= k and distance[at] > best[-1][0]:
            break
        own = members[starts[nodes[at]] : starts[nodes[at] + 1]][: k + 1]  # ids ascend
        best += [(distance[at], int(v)) for v in ids[own] if v != query["vec_id"]]
        best = sorted(best)[:k] if len(best) > k else best
    return [(query["vec_id"], vec_id, float(d)) for d, vec_id in sorted(best)[:k]]


def search(index: DataFrame, queries: DataFrame, k: int = 10, ef: int = EF) -> DataFrame:
    """For each usable row of ``queries`` (vec_id, embedding) its ``k`` nearest rows of the index, itself excepted.

    Columns: query_id, rank (from 1), vec_id, score (Euclidean distance), ties
    to the smaller vec_id.  Queries go to every shard in blocks.  Fewer rows
    than ``k`` give all; an empty index or no queries give no rows.
    """
    block = F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(max(1, -(-queries.count() // BLOCK))))
    asked = usable(queries).withColumn("dims", F.size("embedding")).withColumn("block", block)
    blocks = asked.groupBy("dims", "block").agg(F.collect_list(F.struct("vec_id", "embedding")).alias("queries"))
    shards = index.select("dims", "shard")
    sent = shards.join(blocks, "dims")  # each block to each shard: a stated query set against all rows
    both = sent.join(index, ["dims", "shard"]).drop("block", "shard")
    # one shard's search is a task's worth of work
    found = both.repartition(max(1, shards.count())).mapInArrow(search_shards(k, ef), HITS)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def brute_force(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int = 10):
    """Exact neighbours of a small set, for measuring recall."""
    out = {}
    for point, own in zip(queries.astype(np.float64), query_ids):
        gap = vectors.astype(np.float64) - point
        d = np.sqrt((gap * gap).sum(1))
        d[ids == own] = np.inf
        order = np.lexsort((ids, d))[:k]
        out[int(own)] = [(int(ids[at]), float(d[at])) for at in order if np.isfinite(d[at])]
    return out
