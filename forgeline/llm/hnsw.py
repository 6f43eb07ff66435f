"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Vectors of one shard are of about one length (bands of 10 %): largest inner products become smallest distances
when each vector gets one more component that brings it to the length of the longest of its shard, and
that component stays small. Neighbouring bands share a shard only while all of it fits the search's beam.
Equal vectors are one node. A shard has a bounded number of nodes; its layers are drawn by hash, and each layer links a node to
neighbours that are nearer to it than to each other (the selection rule of Malkov and Yashunin),
both ways, with a link added wherever a part of the layer could not be reached. The candidates for links are
the exact nearest nodes of the shard, found by blocked matrix products, which is cheaper than a greedy
search at this size. Graph and vectors are stored as flat arrays in one row per shard.

Queries go to all shards in blocks: each block is one row, repeated per shard and joined to it on the shard's
number. A beam search moves all queries of a block at once, and enters each layer at several nodes, so that
clusters far from each other are all reached; the shards' results are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import packed


@dataclass(frozen=True)
class Graphs:
    """Parameters of graphs and search."""

    shard: int = 16384  #: nodes per shard on average, at most
    band: float = 1.1  #: longest to shortest vector of a band of lengths
    links: int = 16  #: per node; twice as many on the lowest layer
    candidates: int = 64  #: considered for links
    beam: int = 96  #: of the search on the lowest layer
    entries: int = 32  #: of the search on the upper layers, and where it enters the next one
    block: int = 512  #: queries that search together


def _usable(vector: Column) -> Column:
    """Holds a number other than zero, and nothing that is no finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _band(vector: Column, ratio: float) -> Column:
    """The band of a vector's length; length 1 lies in the middle of band 0. Doubles have less than
    16,000 bands of 10 %."""
    plain = F.log(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x)) / 2
    # Squares that a double can't hold are taken relative to the largest number of the vector.
    most = F.array_max(F.transform(vector, F.abs))
    size = F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x / most) * (x / most))
    length = F.when(F.abs(plain) < 300, plain).otherwise(F.log(most) + F.log(size) / 2)
    return F.floor(length / F.lit(float(np.log(ratio))) + 0.5).cast("int")


def _placed(bands: list[tuple[int, int]], how: Graphs) -> list[tuple[int, int, int]]:
    """Bands and their numbers of nodes to (band, first shard, shards)."""
    out, shard, held = [], -1, 0
    for band, n in sorted(bands, reverse=True):
        if shard < 0 or held + n > how.beam:
            shard, held = shard + 1, 0
        parts = -(-n // how.shard)
        out.append((band, shard, parts))
        shard, held = shard + parts - 1, held + n
    return out


def _neighbours(points: np.ndarray, wanted: int) -> np.ndarray:
    """The exact nearest other points, nearest first, ties by place."""
    n = len(points)
    wanted = min(wanted, n - 1)
    out = np.empty((n, wanted), np.int32)
    square = (points**2).sum(1)
    for a in range(0, n, 512):
        d = square[None] - 2 * points[a : a + 512] @ points.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        near = np.argpartition(d, wanted - 1, axis=1)[:, :wanted] if wanted < n - 1 else np.argsort(d, axis=1)[:, :wanted]
        order = np.lexsort((near, np.take_along_axis(d, near, 1)), axis=1)
        out[a : a + 512] = np.take_along_axis(near, order, 1)
    return out


def _select(points: np.ndarray, rows: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of the candidates of each point in ``rows`` (nearest first, -1 for none) those nearer to it than
    to any chosen before, at most ``most``; -1 fills up."""
    n, c = near.shape
    out = np.full((n, most), -1, np.int32)
    for a in range(0, n, 256):
        some = near[a : a + 256]
        there = points[np.maximum(some, 0)]
        own = ((there - points[rows[a : a + 256], None]) ** 2).sum(2)
        gram = there @ there.transpose(0, 2, 1)
        size = np.einsum("ijj->ij", gram)
        between = size[:, :, None] + size[:, None] - 2 * gram
        chosen = np.zeros(some.shape, bool)
        for k in range(c):
            hidden = (chosen & (between[:, k] < own[:, k, None])).any(1)
            chosen[:, k] = ~hidden & (some[:, k] >= 0) & (chosen.sum(1) < most)
        row, at = np.nonzero(chosen)
        out[a + row, (np.cumsum(chosen, 1) - 1)[row, at]] = some[row, at]
    return out


def _layer(points: np.ndarray, how: Graphs, most: int) -> np.ndarray:
    """Neighbour table of one layer's points, -1 filling up."""
    n = len(points)
    if n == 1:
        return np.full((1, 1), -1, np.int32)
    near = _neighbours(points, how.candidates)
    out = _select(points, np.arange(n), near, most)
    a, k = np.nonzero(out >= 0)
    both = np.unique(np.concatenate([np.stack([a, out[a, k]], 1), np.stack([out[a, k], a], 1)]), axis=0)
    # Back links may be many at a hub: it keeps the best by the same rule, among its nearest.
    d = ((points[both[:, 0]] - points[both[:, 1]]) ** 2).sum(1)
    both = both[np.lexsort((both[:, 1], d, both[:, 0]))]
    place = np.arange(len(both)) - np.searchsorted(both[:, 0], both[:, 0])
    wide = np.full((n, max(most, min(int(place.max()) + 1, 2 * how.candidates))), -1, np.int32)
    fits = place < wide.shape[1]
    wide[both[fits, 0], place[fits]] = both[fits, 1]
    full = (wide >= 0).sum(1) > most
    out = wide[:, :most].copy()
    if full.any():
        out[full] = _select(points, np.flatnonzero(full), wide[full], most)
    return _reachable(points, out)


def _reachable(points: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Links with more of them, so that the layer's first point leads to all others."""
    n = len(points)
    seen, edge = np.zeros(n, bool), np.array([0])
    seen[0] = True
    while True:
        while len(edge):
            to = links[edge].ravel()
            to = np.unique(to[to >= 0])
            edge = to[~seen[to]]
            seen[edge] = True
        if seen.all():
            return links
        # The nearest pair of a point that is reached and one that is not.
        out, inside = np.flatnonzero(~seen)[:512], np.flatnonzero(seen)
        d = (points[inside] ** 2).sum(1)[None] - 2 * points[out] @ points[inside].T + (points[out] ** 2).sum(1)[:, None]
        i, j = np.unravel_index(int(d.argmin()), d.shape)
        source, target = inside[j], out[i]
        free = np.flatnonzero(links[source] < 0)
        if not len(free):
            links = np.concatenate([links, np.full((n, 1), -1, np.int32)], 1)
            free = [links.shape[1] - 1]
        links[source, free[0]] = target
        edge = np.array([target])
        seen[target] = True


@dataclass(frozen=True)
class Shard:
    vectors: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray]]  #: from the top: nodes of the layer, their links (as nodes)

    def search(self, queries: np.ndarray, wanted: int, beam: int, entries: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and inner products found for each query, best first; -1 fills up."""
        q = len(queries)
        entry = np.zeros((q, 1), np.int64) + self.layers[0][0][0]
        for k, (nodes, links) in enumerate(self.layers):
            last = k == len(self.layers) - 1
            entry, scores = self._beam(queries, entry, links, nodes, max(beam, wanted) if last else entries)
        return entry[:, :wanted], scores[:, :wanted]

    def _beam(self, queries: np.ndarray, entry: np.ndarray, links: np.ndarray, nodes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n, q = len(self.vectors), len(queries)
        place = np.full(n + 1, -1, np.int64)
        place[nodes] = np.arange(len(nodes))
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True
        beam = np.full((q, width), n, np.int64)
        beam[:, : entry.shape[1]] = np.where(entry < 0, n, entry)[:, :width]
        np.put_along_axis(seen, beam, True, 1)
        vectors = np.concatenate([self.vectors, np.zeros((1, self.vectors.shape[1]), self.vectors.dtype)])
        score = np.einsum("qd,qwd->qw", queries, vectors[beam])
        score[beam == n] = -np.inf
        opened = beam == n
        active = np.arange(q)
        while len(active):
            pick = np.where(opened[active], -np.inf, score[active]).argmax(1)
            opened[active, pick] = True
            around = links[place[beam[active, pick]]].astype(np.int64)
            around = np.where(around < 0, n, around)
            around = np.where(seen[active[:, None], around], n, around)
            seen[active[:, None], around] = True
            found = np.einsum("qd,qkd->qk", queries[active], vectors[around])
            found[around == n] = -np.inf
            all_nodes = np.concatenate([beam[active], around], 1)
            all_scores = np.concatenate([score[active], found], 1)
            all_opened = np.concatenate([opened[active], around == n], 1)
            best = np.argsort(-all_scores, axis=1, kind="stable")[:, :width]
            beam[active] = np.take_along_axis(all_nodes, best, 1)
            score[active] = np.take_along_axis(all_scores, best, 1)
            opened[active] = np.take_along_axis(all_opened, best, 1)
            active = active[~opened[active].all(1)]
        return np.where(beam == n, -1, beam), score


def build(vectors: np.ndarray, levels: np.ndarray, how: Graphs) -> Shard:
    """The graph over a shard's vectors; ``levels`` says on how many upper layers a node is."""
    vectors = vectors / np.abs(vectors).max()  # as single precision holds them; their order by products stays
    points = vectors.astype(np.float32)
    size = (points**2).sum(1)
    points = np.concatenate([points, np.sqrt(np.maximum(size.max() - size, 0))[:, None]], 1)
    layers = []
    for level in range(int(levels.max()), -1, -1):
        nodes = np.flatnonzero(levels >= level)
        links = _layer(points[nodes], how, how.links if level else 2 * how.links)
        layers.append((nodes, np.where(links >= 0, nodes[np.maximum(links, 0)], -1)))
    return Shard(vectors.astype(np.float32), layers)


SHARDS = "shard int, dim int, ids array<bigint>, vectors binary, sizes array<int>, widths array<int>, nodes binary, links binary"


def index(vectors: DataFrame, how: Graphs = Graphs()) -> DataFrame:
    """(node, vector) to one row per shard with the flat arrays of its graph."""
    vectors = vectors.withColumn("band", _band(F.col("vector"), how.band))
    counts = [(r["band"], r["count"]) for r in vectors.groupBy("band").count().collect()]
    places = vectors.sparkSession.createDataFrame(_placed(counts, how), "band int, first int, parts int")
    ratio = np.log(how.links)

    def graph(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        ids = rows["node"].to_numpy()
        points = np.stack(rows["vector"].to_numpy())
        drawn = (rows["h"].to_numpy().view(np.uint64) >> np.uint64(11)).astype(float) / 2.0**53
        made = build(points, (-np.log(np.maximum(drawn, 2.0**-53)) / ratio).astype(int), how)
        return pd.DataFrame(
            {
                "shard": [rows["shard"].iloc[0]],
                "dim": [points.shape[1]],
                "ids": [ids],
                "vectors": [made.vectors.tobytes()],
                "sizes": [[len(n) for n, _ in made.layers]],
                "widths": [[links.shape[1] for _, links in made.layers]],
                "nodes": [np.concatenate([n for n, _ in made.layers]).astype(np.int32).tobytes()],
                "links": [np.concatenate([links.ravel() for _, links in made.layers]).astype(np.int32).tobytes()],
            }
        )

    # One row per band of lengths, which doubles have less than 16,000 of.
    placed = vectors.join(F.broadcast(places), "band").select(
        (F.col("first") + F.pmod(F.xxhash64("node"), F.col("parts"))).cast("int").alias("shard"), "node", "vector", F.xxhash64("node", F.lit("level")).alias("h")
    )
    return placed.groupBy("shard").applyInPandas(graph, SHARDS)


def opened(row: dict) -> Shard:
    """A shard from its stored row."""
    vectors = np.frombuffer(row["vectors"], np.float32).reshape(-1, row["dim"])
    nodes, links = np.frombuffer(row["nodes"], np.int32), np.frombuffer(row["links"], np.int32)
    layers, a, b = [], 0, 0
    for size, width in zip(row["sizes"], row["widths"]):
        layers.append((nodes[a : a + size].astype(np.int64), links[b : b + size * width].reshape(size, width)))
        a, b = a + size, b + size * width
    return Shard(vectors, layers)


def searched(shards: DataFrame, queries: DataFrame, wanted: int, how: Graphs = Graphs()) -> DataFrame:
    """(query, vector) against stored shards: query, node, found once per shard and query."""
    numbers = F.sequence(F.lit(0), F.lit(max(0, int(shards.agg(F.max("shard")).first()[0] or 0))))
    blocks = queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(max(1, -(-queries.count() // how.block)))))
    blocks = blocks.groupBy("block").agg(F.collect_list(F.struct("query", "vector")).alias("asked"))
    sent = blocks.withColumn("shard", F.explode(numbers))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard, ids = None, None, None
        for batch in batches:
            for at in range(batch.num_rows):
                number = batch.column("shard")[at].as_py()
                if held != number:
                    row = batch.slice(at, 1).drop_columns(["asked"]).to_pylist()[0]
                    held, shard, ids = number, opened(row), np.array(row["ids"])
                block = batch.column("asked")[at].as_py()
                names = np.array([a["query"] for a in block])
                asked = np.array([a["vector"] for a in block])
                asked = (asked / np.abs(asked).max(1, keepdims=True)).astype(np.float32)
                nodes, _ = shard.search(asked, wanted, how.beam, how.entries)
                query, k = np.nonzero(nodes >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(names[query]), pa.array(ids[nodes[query, k]])], names=["query", "node"])

    return shards.join(sent, "shard").mapInArrow(search, "query bigint, node bigint")


def nearest(rows: DataFrame, queries: Column, wanted: int, how: Graphs = Graphs(), vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id, score: the ``wanted`` nearest rows found for each row for which
    ``queries`` holds (over ``vec_id``), without the row itself.

    Nearness is the inner product in double precision; ties go to the smaller id. Rows whose vector is null,
    empty, zero, or holds a null or a number that is not finite take no part, nor do rows
    without an id. Vectors of different lengths are searched apart, each among its like; rows that repeat an
    id with another vector are found by each of them. An empty table gives no rows.
    """
    base = packed(rows, vec_id=f"{vec_id}:bigint", vector=f"{vector}:array<double>").drop("row")
    base = base.withColumn("vector", F.col("vector").cast("array<double>"))
    base = materialize(base.where(F.col("vec_id").isNotNull() & _usable(F.col("vector"))), "vectors")
    # Equal vectors are one node; of its rows the smallest ids suffice for any query's answer.
    nodes = base.groupBy("vector").agg(F.min("vec_id").alias("node"))
    nodes = materialize(nodes.withColumn("dim", F.size("vector")), "vector-nodes")
    found = None
    asked = base.where(queries).select(F.col("vec_id").alias("query"), "vector")
    for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect():
        shards = materialize(index(nodes.where(F.col("dim") == r["dim"]).select("node", "vector"), how), "vector-shards")
        some = searched(shards, asked.where(F.size("vector") == r["dim"]), wanted + 1, how)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = base.select(F.col("vec_id").alias("query"), F.col("vec_id").alias("node")).limit(0)
    # Exact scores on the original vectors, then the best distinct nodes of all shards.
    of_query = asked.select(F.col("query"), F.col("vector").alias("q"))
    of_node = nodes.select("node", F.col("vector").alias("v"))
    dot = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    scored = found.distinct().join(of_node, "node").join(of_query, "query").select("query", "node", "v", dot.alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    kept = scored.withColumn("k", F.row_number().over(best)).where(F.col("k") <= wanted + 1).drop("k")
    members = base.select("vec_id", F.col("vector").alias("v"))
    first = Window.partitionBy("v").orderBy("vec_id")
    members = members.withColumn("m", F.row_number().over(first)).where(F.col("m") <= wanted + 1).drop("m")
    rows_found = kept.join(members, "v").where(F.col("vec_id") != F.col("query"))
    rank = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    out = rows_found.distinct().withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= wanted)
    return out.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


def op1(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings, F.col("vec_id") % 20 == 0, 20)
