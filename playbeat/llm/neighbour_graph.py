"""Approximate nearest neighbours by inner product, through robust-pruned directed graphs.

Vectors are dealt over shards by a hash, equal ones being one node, and every shard gets a graph of bounded degree.
Points are put in by batches: a greedy search through the graph so far proposes neighbours, and pruning keeps the nearest
of them and drops those that are nearer to a kept one than, times a relaxation, to the point itself, which leaves edges
in different directions and some long ones. The kept point gets an edge back, and its list is pruned again where it is
too long. A query is searched in every shard with a beam, and the shards' best meet.

The largest inner product is the least distance once every vector has a further component that gives all of them one
length, so graphs are built on those; queries have zero there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playbeat.llm.tables import Scratch

#: Points put in or searched at once.
BATCH = 512
#: Nodes whose neighbours are looked at in one step of a search.
WIDTH = 4
#: Nodes of a shard that searches compare first, and how many of them they start from.
ENTRIES, STARTS = 256, 8
GRAPH = "dim int, shard int, wide boolean, vectors binary, graph binary, entries binary, ids binary, counts binary"


@dataclass(frozen=True)
class Shape:
    degree: int = 40
    build_beam: int = 64
    relaxation: float = 1.2
    beam: int = 128


def search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The `beam` nodes of largest inner product that a greedy search from the best entries meets, best first, -1 where fewer."""
    n, rows = len(queries), np.arange(len(queries))[:, None]
    seen = np.zeros((n, len(x)), bool)
    ids = np.full((n, beam), -1, np.int32)
    like = np.full((n, beam), -np.inf, np.float32)
    start = queries @ x[entries].T
    best = np.argsort(-start, axis=1, kind="stable")[:, : min(beam, STARTS)]
    ids[:, : best.shape[1]], like[:, : best.shape[1]] = entries[best], start[rows, best]
    seen[rows, entries[best]] = True
    done = ids < 0
    while True:
        open_ = np.where(done, -np.inf, like)
        active = np.flatnonzero(open_.max(1) > -np.inf)
        if len(active) == 0:
            return ids, like
        at = rows[: len(active)]
        pick = np.argsort(-open_[active], axis=1, kind="stable")[:, :WIDTH]
        some = np.isfinite(open_[active][at, pick])
        done[active[:, None], pick] = True
        near = np.where(some[:, :, None], graph[ids[active[:, None], pick]], -1).reshape(len(active), -1)
        near = np.sort(near, axis=1)
        new = near >= 0
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        new &= ~seen[active[:, None], near]
        which, column = np.nonzero(new)
        found = near[which, column]
        seen[active[which], found] = True
        value = np.full(near.shape, -np.inf, np.float32)
        value[which, column] = np.einsum("ij,ij->i", x[found], queries[active[which]])
        like_all = np.concatenate([like[active], value], axis=1)
        best = np.argsort(-like_all, axis=1, kind="stable")[:, :beam]
        like[active] = like_all[at, best]
        ids[active] = np.concatenate([ids[active], near], axis=1)[at, best]
        done[active] = np.concatenate([done[active], np.zeros(near.shape, bool)], axis=1)[at, best] | ~np.isfinite(like[active])


def prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, length: float, degree: int, relaxation: float) -> np.ndarray:
    """Kept neighbours of each point out of its row of candidates (-1: none, repeats allowed), nearest first."""
    own = candidates >= 0
    vectors = x[candidates]
    far = np.where(own & (candidates != points[:, None]), 2 * np.maximum(length - np.einsum("ijk,ik->ij", vectors, x[points]), 0), np.inf)
    order = np.argsort(far, axis=1, kind="stable")
    rows = np.arange(len(points))[:, None]
    candidates, far, vectors = candidates[rows, order], far[rows, order], vectors[rows, order]
    between = 2 * np.maximum(length - vectors @ vectors.transpose(0, 2, 1), 0) * np.float32(relaxation**2)
    left = np.isfinite(far)
    left[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    out = np.full((len(points), degree), -1, np.int32)
    rows = rows[:, 0]
    for k in range(degree):
        pick = left.argmax(1)
        some = left[rows, pick]
        if not some.any():
            break
        out[some, k] = candidates[rows, pick][some]
        left &= between[rows, pick] > far
        left[rows, pick] = False
    return out


def _linked_back(x: np.ndarray, graph: np.ndarray, points: np.ndarray, length: float, shape: Shape) -> None:
    """Edges from the points' new neighbours to the points; lists that grow beyond the degree are pruned."""
    there = graph[points]
    source, column = np.nonzero(there >= 0)
    target, back = there[source, column], points[source]
    order = np.argsort(target, kind="stable")
    target, back = target[order], back[order]
    nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
    held = (graph[nodes] >= 0).sum(1)
    by_size = np.argsort(held + counts, kind="stable")
    at, n = 0, len(nodes)
    while at < n:  # lists of like length together, so that few places are empty
        most = int((held + counts)[by_size[at]])
        to = at + 1
        while to < n and to - at < BATCH and (held + counts)[by_size[to]] <= max(most * 5 // 4, shape.degree):
            to += 1
        some = by_size[at:to]
        size = int(counts[some].max())
        more = np.full((len(some), size), -1, np.int32)
        fill = np.arange(size)[None, :] < counts[some][:, None]
        more[fill] = back[(first[some][:, None] + np.arange(size)[None, :])[fill]]
        lists = np.concatenate([graph[nodes[some]], more], axis=1)
        if (held + counts)[some].max() <= shape.degree:
            graph[nodes[some]] = -np.sort(-lists, axis=1)[:, : shape.degree]
        else:
            graph[nodes[some]] = prune(x, nodes[some], lists, length, shape.degree, shape.relaxation)
        at = to


def build(x: np.ndarray, shape: Shape, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour lists of all rows of x, which have one length, and the nodes where searches start."""
    n, length = len(x), float(np.einsum("ij,ij->i", x, x).max(initial=0))
    graph = np.full((n, shape.degree), -1, np.int32)
    order = np.random.default_rng(seed).permutation(n).astype(np.int32)
    at = 1
    while at < n:
        points = order[at : at + min(max(at, 32), BATCH)]
        near, _ = search(x, graph, order[: min(at, ENTRIES)], x[points], shape.build_beam)
        graph[points] = prune(x, points, near, length, shape.degree, shape.relaxation)
        _linked_back(x, graph, points, length, shape)
        at += len(points)
    return graph, order[:ENTRIES]


def _build_shard(shape: Shape, seed: int):
    def run(table: pa.Table) -> pa.Table:
        dim, shard = table["dim"][0].as_py(), table["shard"][0].as_py()
        lists = table["ids"].combine_chunks()
        column = table["vector"].combine_chunks()
        vectors = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        counts, ids = lists.value_lengths().to_numpy().astype(np.int32), lists.flatten().to_numpy(zero_copy_only=False)
        x = vectors.astype(np.float64) / np.abs(vectors).max()
        squares = np.einsum("ij,ij->i", x, x)
        x = np.concatenate([x, np.sqrt(squares.max() - squares)[:, None]], axis=1).astype(np.float32)
        graph, entries = build(x, shape, seed)
        row = [dim, shard, vectors.dtype == np.float64, vectors.tobytes(), graph.tobytes(), entries.tobytes(), ids.astype(np.int64).tobytes(), counts.tobytes()]
        return pa.table({c.split()[0]: [v] for c, v in zip(GRAPH.split(", "), row)}).cast(_SCHEMA)

    return run


_KINDS = {"int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
_SCHEMA = pa.schema([(c, _KINDS[kind]) for c, kind in (p.split() for p in GRAPH.split(", "))])
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search_shard(shape: Shape, k: int):
    def run(shards: pa.Table, queries: pa.Table) -> pa.Table:
        if not shards.num_rows or not queries.num_rows:
            return _FOUND.empty_table()
        s = shards.slice(0, 1).to_pylist()[0]
        vectors = np.frombuffer(s["vectors"], np.float64 if s["wide"] else np.float32).reshape(-1, s["dim"])
        graph = np.frombuffer(s["graph"], np.int32).reshape(len(vectors), -1)
        ids, counts = np.frombuffer(s["ids"], np.int64), np.frombuffer(s["counts"], np.int32)
        first, entries = np.append(0, np.cumsum(counts)), np.frombuffer(s["entries"], np.int32)
        x = (vectors / np.abs(vectors).max()).astype(np.float32)
        asked = queries["query_id"].to_numpy()
        wanted = queries["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, s["dim"]).astype(np.float64)
        parts = []
        for lo in range(0, len(asked), BATCH):
            q = wanted[lo : lo + BATCH]
            near, _ = search(x, graph, entries, (q / np.abs(q).max(1, keepdims=True)).astype(np.float32), max(shape.beam, k + 1))
            which, column = np.nonzero(near >= 0)
            node = near[which, column]
            score = np.einsum("ij,ij->i", vectors[node].astype(np.float64), q[which])
            # a node stands for all ids of one vector, of which a list can hold k beside the query's own
            spread = np.repeat(np.arange(len(node)), counts[node])
            inner = np.arange(len(spread)) - np.repeat(np.cumsum(counts[node]) - counts[node], counts[node])
            found, which, score = ids[first[node[spread]] + inner], which[spread], score[spread]
            other = found != asked[lo + which]
            found, which, score = found[other], which[other], score[other]
            order = np.lexsort((found, -score, which))
            found, which, score = found[order], which[order], score[order]
            place = np.arange(len(which)) - np.searchsorted(which, which)
            best = place < k
            parts.append(pa.table([asked[lo + which[best]], found[best], score[best]], schema=_FOUND))
        return pa.concat_tables(parts)

    return run


def usable(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vector, dim) of the distinct rows that take part."""
    v = F.col(f"`{embedding}`")
    kind = rows.schema[embedding].dataType.elementType
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    taken = rows.where(whole & F.col(f"`{vec_id}`").isNotNull())
    vector = v if isinstance(kind, (T.FloatType, T.DoubleType)) else v.cast("array<double>")
    return taken.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), vector.alias("vector"), F.size(v).alias("dim")).distinct()


def nearest_neighbours(
    rows: DataFrame, queries: DataFrame, *, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding",
    shard_rows: int = 8192, lane_queries: int = 2048, shape: Shape = Shape(), seed: int = 7,
) -> DataFrame:
    """The k nearest rows that are found for each query: (query_id, rank from 1, vec_id, score), nearest first.

    Score is the inner product of the two original vectors in double precision, larger is nearer, ties go to the smaller
    vec_id. A query's own id is no candidate. Rows whose vector is null, empty, zero or holds null or non-finite
    components take no part, neither do rows without an id; vectors of another length than the query's are no
    candidates. Equal rows count once; an id with several vectors counts with the nearest pair. Fewer candidates than k
    give fewer rows, an empty table none. Other columns are ignored.

    A shard has about `shard_rows` different vectors; all queries go to every shard, `lane_queries` at a time, beside a
    copy of its graph. Of ids with one vector the k + 1 smallest are kept, which is all that a list can hold.
    """
    scratch = Scratch(rows.sparkSession, "neighbours")
    own = usable(rows, vec_id, embedding)
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    nodes = own.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = scratch.keep(nodes.withColumn("dim", F.size("vector")), "nodes")
    asked = scratch.keep(usable(queries, vec_id, embedding).withColumnRenamed("vec_id", "query_id"), "asked")
    shards = max(1, math.ceil(nodes.count() / shard_rows))
    lanes = max(1, math.ceil(asked.count() / lane_queries))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int")).groupBy("dim", "shard")
    graphs = scratch.keep(dealt.applyInArrow(_build_shard(shape, seed), GRAPH), "graphs")
    scratch.drop("nodes")

    key = ["dim", "shard", "lane"]
    copies = graphs.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    sent = asked.withColumn("lane", F.pmod(F.xxhash64("query_id"), F.lit(lanes)).cast("int"))
    sent = sent.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = copies.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(_search_shard(shape, k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
