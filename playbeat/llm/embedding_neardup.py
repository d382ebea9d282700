"""Near duplicates among vectors by sorted projection passes.

Each pass concatenates 64 random hashes of a vector (on which side of a random plane it lies) and sorts all vectors by
them; vectors at a small angle share long prefixes and come to stand near one another. Within a pass every vector is
compared with the `reach` vectors on both sides, and verified links are united across passes. Equal vectors are one
entry before that, so copies do not fill the windows. Each pass also measures, for every vector, the bits after which
all that share them stand within its window; from that follows how surely a partner at the threshold has been met.
Vectors not yet sure, as those of a dense cone, go through more passes among themselves, or meet in full, block by
block, once that takes fewer comparisons. Groups of more vectors than a window are not cut short: at last the members
of each component meet in full as well, which also counts every vector's links exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbeat.llm import arrays as A
from playbeat.llm.components import connected_components, kept, roots

#: Vectors of one side of a block comparison within a component.
BLOCK = 2048
BITS = 64
#: Passes of one round over vectors that are not yet sure.
ROUND = 64


def agreement(threshold: float) -> float:
    """Probability that two vectors at the threshold are on one side of a random plane."""
    return 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi


def passes_for(vectors: int, threshold: float, reach: int, recall: float, least: int = 12) -> int:
    """Passes after which a pair at the threshold has been in one window with probability `recall`, if bits halve the table."""
    share = agreement(threshold)
    depth = max(0.0, math.log2(max(vectors, 1) / reach))
    once = min(share**depth, 0.999)
    return max(least, math.ceil(math.log(1 - recall) / math.log(1 - once)))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors as rows, each scaled by a power of two so that no square over- or underflows; this is exact and turns none."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, initial=0.0))[1][:, None])


def _project(passes: int, seed: int):
    """(node, key, dim, embedding) to one row per pass, with the pass's hashes as a long that sorts like the bits."""
    planes: dict[int, np.ndarray] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                if size not in planes:
                    planes[size] = np.random.default_rng([seed, size]).standard_normal((size, passes * BITS))
                for lo in range(0, part.num_rows, 4096):
                    some = part.slice(lo, 4096)
                    bits = (matrix(some.column(3), size) @ planes[size] > 0).reshape(-1, passes, BITS)
                    marks = np.packbits(bits, axis=2).view(">u8").reshape(-1, passes).astype(np.uint64) ^ np.uint64(1 << 63)
                    for p in range(passes):
                        first = [pa.array(np.full(some.num_rows, p, np.int32)), pa.array(marks[:, p].view(np.int64))]
                        yield pa.RecordBatch.from_arrays([*first, *some.columns], names=["pass", "mark", *batch.schema.names])

    return run


def links(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of x and y have a cosine of at least the threshold, in double precision."""
    scale = np.sqrt((x * x).sum(1))[:, None] * np.sqrt((y * y).sum(1))[None, :]
    return (x @ y.T) / scale >= threshold


def spread(linked: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Smallest node that each row reaches within a block."""
    label = np.where(linked, nodes[None, :], nodes[:, None]).min(1)
    while True:
        lower = np.where(linked, label[None, :], label[:, None]).min(1)
        if np.array_equal(lower, label):
            return label
        label = lower


def _shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of two arrays of marks."""
    differ = a.view(np.uint64) ^ b.view(np.uint64)
    high, low = (differ >> np.uint64(32)).astype(np.float64), (differ & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return BITS - np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])


def sureness(marks: np.ndarray, reach: int, share: float, lo: int, hi: int, opens: bool, closes: bool) -> np.ndarray:
    """-log of the probability that this pass misses a partner at the threshold, for the rows lo to hi of sorted marks.

    A partner that shares more bits than the rows `reach` before and after do stands between them. `opens` and `closes`
    tell whether the marks begin and end where the pass does; where they do not, rows beyond are as near as the last seen.
    """
    at, last = np.arange(lo, hi), len(marks) - 1
    before = _shared_bits(marks[at], marks[np.maximum(at - reach, 0)]) + 1
    after = _shared_bits(marks[at], marks[np.minimum(at + reach, last)]) + 1
    if opens:
        before[at < reach] = 0
    if closes:
        after[at + reach > last] = 0
    bits = np.maximum(before, after)
    met = np.where(bits > BITS, 0.0, share ** bits.astype(np.float64))
    return -np.log1p(-np.minimum(met, 1 - 1e-12))


def _windows(reach: int, threshold: float):
    """Rows in order of (dim, pass, mark) to edges (a, b) between near neighbours, and to (node, key, sureness) of each row."""
    names, share = ["a", "b", "sure"], agreement(threshold)

    def edges(node: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        label = spread(links(rows, rows, threshold), node)
        child = label != node
        none = pa.nulls(int(child.sum()), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(node[child]), pa.array(label[child]), none], names=names)

    def sure(side: list[np.ndarray], lo: int, hi: int, opens: bool, closes: bool) -> pa.RecordBatch:
        gain = sureness(side[0], reach, share, lo, hi, opens, closes)
        return pa.RecordBatch.from_arrays([pa.array(side[1][lo:hi]), pa.array(side[2][lo:hi]), pa.array(gain)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held_node, held = None, None, None
        side, told, opens, first = [], 0, False, True  # marks, nodes and keys from `reach` before the first row not told
        for batch in batches:
            group = batch.column(2).to_numpy() * (1 << 20) + batch.column(0).to_numpy()
            starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])).tolist() if len(group) else []
            for lo, hi in zip(starts, [*starts[1:], len(group)]):
                size = int(batch.column(2)[lo].as_py())
                node = batch.column(1).slice(lo, hi - lo).to_numpy()
                more = [batch.column(4).slice(lo, hi - lo).to_numpy(), node, batch.column(5).slice(lo, hi - lo).to_numpy()]
                rows = matrix(batch.column(3).slice(lo, hi - lo), size)
                if at == group[lo]:
                    node, rows = np.concatenate([held_node, node]), np.concatenate([held, rows])
                    side = [np.concatenate(x) for x in zip(side, more)]
                else:
                    if at is not None:
                        yield edges(held_node, held)
                        yield sure(side, told, len(side[0]), opens, True)
                    side, told, opens, first = more, 0, not first, False
                at = group[lo]
                done = 0
                while len(node) - done > 2 * reach:
                    yield edges(node[done : done + 2 * reach], rows[done : done + 2 * reach])
                    done += reach
                held_node, held = node[done:], rows[done:]
                upto = len(side[0]) - reach
                if upto > told:
                    yield sure(side, told, upto, opens, False)
                    cut = max(upto - reach, 0)
                    # a cut leaves `reach` rows before the next one, so the start does not matter any more
                    side, told = [x[cut:] for x in side], upto - cut
        if at is not None:
            yield edges(held_node, held)
            yield sure(side, told, len(side[0]), opens, False)

    return run


def _meet(threshold: float):
    """Sorted (tile, side, node, embedding) to edges between linked vectors of a tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.whole_runs(batches, lambda b: b.column(0).to_numpy(), 1024):
            tile = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.append(True, tile[1:] != tile[:-1])).tolist()
            for lo, hi in zip(starts, [*starts[1:], len(tile)]):
                part = batch.slice(lo, hi - lo)
                side, node = part.column(1).to_numpy(), part.column(2).to_numpy()
                rows = matrix(part.column(3), len(part.column(3)[0]))
                left = side == 0
                right = ~left if (~left).any() else left
                ours, theirs = (node[left], rows[left]), (node[right], rows[right])
                for i in range(0, len(ours[0]), 1024):
                    for j in range(0, len(theirs[0]), 1024):
                        x, y = np.nonzero(links(ours[1][i : i + 1024], theirs[1][j : j + 1024], threshold))
                        if len(x):
                            nodes, root = roots(ours[0][i + x], theirs[0][j + y])
                            child = nodes != root
                            yield pa.RecordBatch.from_arrays([pa.array(nodes[child]), pa.array(root[child])], names=["a", "b"])

    return run


def _all_pairs(open_: DataFrame, threshold: float, parts: int) -> DataFrame:
    """Edges of all linked pairs, each pair of blocks in one tile; small tables get smaller blocks so that all tasks have tiles."""
    sizes = open_.groupBy("dim").agg(F.count("*").alias("m"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.least(F.lit(math.ceil(math.sqrt(2 * parts))), F.ceil(F.col("m") / 32))).cast("long")
    placed = open_.join(sizes.select("dim", blocks.alias("blocks")), "dim").withColumn("own", F.expr("pmod(xxhash64(node, key, 2), blocks)"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = placed.select(
        F.xxhash64("dim", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "node", "embedding",
    )
    dealt = tiles.repartitionByRange(parts, "tile").sortWithinPartitions("tile", "side")
    return dealt.mapInArrow(_meet(threshold), "a long, b long")


def _edges(entries: DataFrame, threshold: float, reach: int, recall: float, seed: int, parts: int) -> DataFrame:
    """Edges that connect every pair at the threshold with probability `recall` at least, as measured on the passes."""
    enough = -math.log(1 - recall)
    open_ = entries.select("node", "key", "dim", "embedding", F.lit(0.0).alias("sure"))
    passes, found = passes_for(entries.count(), threshold, reach, recall), []
    while True:
        vectors = open_.select("node", "key", "dim", "embedding")
        projected = vectors.mapInArrow(_project(passes, seed), "pass int, mark long, node long, key long, dim long, embedding array<double>")
        ordered = projected.repartitionByRange(parts, "dim", "pass", "mark", "node").sortWithinPartitions("dim", "pass", "mark", "node")
        made = kept(ordered.select("pass", "node", "dim", "embedding", "mark", "key").mapInArrow(_windows(reach, threshold), "a long, b long, sure double"))
        found.append(made.where("sure IS NULL").select("a", "b"))
        gains = made.where("sure IS NOT NULL").groupBy(F.col("a").alias("node"), F.col("b").alias("key")).agg(F.sum("sure").alias("gain"))
        open_ = open_.join(gains, ["node", "key"]).withColumn("sure", F.col("sure") + F.col("gain"))
        open_ = kept(open_.where(F.col("sure") < enough))
        more = F.lit(passes) * (F.lit(enough) - F.col("sure")) / F.greatest(F.col("gain"), F.lit(1e-9))
        left, need = open_.agg(F.count("*"), F.percentile_approx(more, 0.9)).first()
        if left == 0:
            break
        open_ = open_.drop("gain")
        if 4 * reach * need >= left:  # comparisons of a vector: 2 * 2 * reach a pass, or half of those left
            found.append(_all_pairs(open_, threshold, parts))
            break
        passes, seed = min(ROUND, math.ceil(need)), seed + 1
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionAll(more)
    return edges


def _count(threshold: float):
    """Sorted (tile, side, node, key, copies, embedding) to how many copies each vector links with across the tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.whole_runs(batches, lambda b: b.column(0).to_numpy(), 1024):
            tile = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.append(True, tile[1:] != tile[:-1])).tolist()
            node, key, counts = [], [], []
            for lo, hi in zip(starts, [*starts[1:], len(tile)]):
                part = batch.slice(lo, hi - lo)
                side, copies = part.column(1).to_numpy(), part.column(4).to_numpy()
                rows = matrix(part.column(5), len(part.column(5)[0]))
                left, right = side == 0, side == 1
                n = np.zeros(hi - lo, np.int64)
                if right.any():
                    linked = links(rows[left], rows[right], threshold)
                    n[left], n[right] = linked @ copies[right], linked.T @ copies[left]
                else:
                    linked = links(rows, rows, threshold)
                    np.fill_diagonal(linked, False)
                    n = linked @ copies
                node.append(part.column(2).to_numpy())
                key.append(part.column(3).to_numpy())
                counts.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (node, key, counts)], names=["node", "key", "n"])

    return run


def embedding_links(vectors: DataFrame, threshold: float = 0.9, reach: int = 256, recall: float = 0.999, seed: int = 7, *, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per input row: (vec_id, n_links, component_id, kept).

    Vectors link at a cosine of `threshold` or more, in double precision. n_links counts the other rows linked directly,
    equal vectors included; component_id is the smallest id reachable by links; kept tells whether it is the row's own.
    A null, empty or zero vector, or one with null or non-finite components, links with nothing, and so do vectors of
    different length; a row without an id links with nothing and has null component_id and kept. Rows that repeat an id
    belong to one component. `recall` is the probability with which a pair exactly at the threshold is compared, by the
    density measured about its vectors; closer pairs are so more surely, and pairs within a component are all compared.
    Passes and comparisons grow with that density, up to all pairs of the vectors in dense groups. An empty table gives no rows. Other
    columns are ignored.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec"), F.col(embedding).cast("array<double>").alias("embedding"))
    finite = "size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(embedding, x -> x <> 0)"
    rows = rows.withColumn("embedding", F.expr(f"if(vec IS NOT NULL AND {finite}, transform(embedding, x -> x + 0D), NULL)"))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = rows.where("embedding IS NOT NULL").groupBy("embedding").agg(F.min("vec").alias("node"), F.count("*").alias("copies"))
    entries = kept(entries.select("node", F.xxhash64("embedding").alias("key"), F.size("embedding").cast("long").alias("dim"), "copies", "embedding"))
    merged = connected_components(_edges(entries, threshold, reach, recall, seed, parts))
    members = kept(entries.join(merged, "node"))
    blocks = members.groupBy("component", "dim").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    placed = members.join(blocks, ["component", "dim"]).withColumn("own", F.expr("pmod(xxhash64(node, key, 1), blocks)"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = placed.select(
        F.xxhash64("component", "dim", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "node", "key", "copies", "embedding",
    )
    counted = tiles.repartition(parts, "tile").sortWithinPartitions("tile", "side").mapInArrow(_count(threshold), "node long, key long, n long")
    counted = counted.groupBy("node", "key").agg(F.sum("n").alias("n"))
    known = entries.join(counted, ["node", "key"], "left").join(merged, "node", "left")
    known = known.select("embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "node").alias("component"))
    found = rows.join(known, "embedding", "left")
    return found.select(
        F.col("vec").alias(vec_id), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec").alias("component_id"),
        (F.col("vec") == F.coalesce("component", "vec")).alias("kept"),
    )
