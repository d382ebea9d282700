"""Near duplicates by 64-bit SimHash and a Gray-order hierarchical index.

Two fingerprints within `distance` bits agree on at least one of `distance + 1` blocks of bits. So there is one
hierarchy per block: its roots are the patterns of that block, and under a root the fingerprints stand in Gray rank
order, where neighbours share most bits. Runs of neighbours are leaves, runs of leaves are upper nodes; each keeps the
bits on which all below agree (mask and pattern). Pairs of nodes whose patterns differ in more than `distance` bits of
both masks are dropped whole; the others go down a level, where the masks are larger and the differences add up.
Equal fingerprints are one entry. The entries are range-partitioned by Gray rank, so a root with very many entries is
cut over tasks; leaves of such a root meet those of other tasks by a join on the root.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbeat.llm import arrays as A
from playbeat.llm.components import connected_components, kept, roots

FAN = 32
PAIRS = 1 << 20
SEED = 42


def bit_votes(hashes: np.ndarray, offsets: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """For each run of hashes, how many have each of the 64 bits set, highest bit first."""
    votes = np.zeros((len(offsets) - 1, 64), np.int64)
    for lo in range(0, len(hashes), block):
        hi = min(lo + block, len(hashes))
        bits = np.unpackbits(hashes[lo:hi].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = int(np.searchsorted(offsets, lo, "right")) - 1
        last = int(np.searchsorted(offsets, hi, "left"))
        rows = np.arange(first, last)
        rows = rows[offsets[rows + 1] > offsets[rows]]
        votes[rows] += np.add.reduceat(bits, np.maximum(offsets[rows] - lo, 0), axis=0, dtype=np.int64)
    return votes


def fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    """SimHash of each text: a bit is set if over half of its shingles' hashes have it."""
    hashes: list[int] = []
    offsets = [0]
    hash64, join = xxhash.xxh64_intdigest, b" ".join
    for text in texts:
        words = text.lower().split()
        if len(words) > shingle:
            hashes += [hash64(join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))]
        elif words:
            hashes.append(hash64(join(words), SEED))
        offsets.append(len(hashes))
    at = np.array(offsets)
    votes = bit_votes(np.array(hashes, np.uint64), at)
    return np.packbits(2 * votes > np.diff(at)[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _fingerprint(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = A.text_buffer(batch.column(1))
            for lo, hi in A.slices(offsets):
                raw, at = buf[offsets[lo] : offsets[hi]].tobytes(), (offsets[lo : hi + 1] - offsets[lo]).tolist()
                fps = fingerprints([raw[s:e] for s, e in zip(at[:-1], at[1:])], shingle)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(fps.view(np.int64))], names=["doc", "fp"])

    return run


def gray_rank(x: Column) -> Column:
    """Position of a bit pattern in Gray code order, as a long whose signed order is that order."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, s))
    return x.bitwiseXOR(F.lit(-(1 << 63)))


def blocks(distance: int) -> list[tuple[int, int]]:
    """First bit and width of the blocks, of which two near fingerprints share one."""
    n = distance + 1
    widths = [64 // n + (i < 64 % n) for i in range(n)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def nodes_above(pattern: np.ndarray, mask: np.ndarray, group: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First child, pattern and mask of nodes over runs of at most `fan` children of one group."""
    new = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    within = np.arange(len(group)) - np.repeat(new, np.diff(np.append(new, len(group))))
    first = np.flatnonzero(within % fan == 0)
    lead = np.repeat(pattern[first], np.diff(np.append(first, len(group))))
    return first, pattern[first], np.bitwise_and.reduceat(mask & ~(pattern ^ lead), first)


def children(pairs: tuple[np.ndarray, np.ndarray], first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of children of the given node pairs, each once, some at a time."""
    a, b = pairs
    total = np.append(0, np.cumsum(size[a] * size[b]))
    for lo, hi in A.slices(total, PAIRS):
        x, y = a[lo:hi], b[lo:hi]
        counts = size[x] * size[y]
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        wide = np.repeat(size[y], counts)
        i, j = np.repeat(first[x], counts) + at // wide, np.repeat(first[y], counts) + at % wide
        once = (i < j) | (np.repeat(x != y, counts))
        yield i[once], j[once]


def near_within(fp: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that connect all near fingerprints of each group; fingerprints stand in Gray order within groups."""
    full = np.full(len(fp), ~np.uint64(0))
    leaf, leaf_pattern, leaf_mask = nodes_above(fp, full, group, FAN)
    leaf_size, leaf_group = np.diff(np.append(leaf, len(fp))), group[leaf]
    top, top_pattern, top_mask = nodes_above(leaf_pattern, leaf_mask, leaf_group, FAN)
    top_size, top_group = np.diff(np.append(top, len(leaf))), leaf_group[top]

    def near(i, j, pattern, mask):
        ok = popcount((pattern[i] ^ pattern[j]) & mask[i] & mask[j]) <= distance
        return i[ok], j[ok]

    found_a, found_b = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(x, y):
        nonlocal found_a, found_b
        found_a, found_b = np.concatenate([found_a, x]), np.concatenate([found_b, y])
        if len(found_a) > PAIRS:
            found_a, found_b = _star(found_a, found_b)

    for apart in range(len(top)):
        i = np.arange(len(top) - apart)
        i = i[top_group[i] == top_group[i + apart]]
        if not len(i):
            break
        for leaves in children(near(i, i + apart, top_pattern, top_mask), top, top_size):
            for members in children(near(*leaves, leaf_pattern, leaf_mask), leaf, leaf_size):
                add(*near(*members, fp, full))
        if apart == 0:
            own = np.arange(len(leaf))[leaf_size > 1]
            for members in children((own, own), leaf, leaf_size):
                add(*near(*members, fp, full))
    return _star(found_a, found_b)


def _star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(a):
        return a, b
    nodes, root = roots(a, b)
    child = nodes != root
    return nodes[child], root[child]


ENTRY = "a long, b long, root long, part int, mask long, pattern long, fps array<long>, nodes array<long>"


def _search(distance: int):
    """Sorted (root, fp, node) to edges, and the leaves of the first and last root, which other tasks may hold too."""

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        n = len(a)
        null = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *null], names=NAMES)

    def leaves(root: int, fp: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        first, pattern, mask = nodes_above(fp, np.full(len(fp), ~np.uint64(0)), np.zeros(len(fp), np.int64), FAN)
        n, offsets = len(first), pa.array(np.append(first, len(fp)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (fp.view(np.int64), node)]
        part = TaskContext.get().partitionId()
        fixed = [pa.array(np.full(n, root)), pa.array(np.full(n, part, np.int32)), pa.array(mask.view(np.int64)), pa.array(pattern.view(np.int64))]
        return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), *fixed, *lists], names=NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[int, pa.RecordBatch] = {}
        opened = False
        for batch in A.whole_runs(batches, lambda b: b.column(0).to_numpy(), 1 << 16):
            root, fp, node = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()
            i, j = near_within(fp, root, distance)
            if len(i):
                yield edges(node[i], node[j])
            if not opened:
                own = root == root[0]
                yield leaves(int(root[0]), fp[own], node[own])
                opened, begun = True, root[0]
            own = root == root[-1]
            ends = {} if root[-1] == begun else {0: leaves(int(root[-1]), fp[own], node[own])}
        yield from ends.values()

    return run


NAMES = [c.split()[0] for c in ENTRY.split(", ")]


def _meet(distance: int):
    """Pairs of leaves to edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for left, left_node, right, right_node in zip(*(batch.column(i) for i in range(4))):
                x, y = (np.asarray(v.values).view(np.uint64) for v in (left, right))
                i, j = np.nonzero(popcount(x[:, None] ^ y[None, :]) <= distance)
                a.append(np.asarray(left_node.values)[i])
                b.append(np.asarray(right_node.values)[j])
            a, b = _star(np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def near_edges(entries: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) that connect all nodes with fingerprints within `distance`; entries: distinct fp, and node, both long."""
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = []
    for t, (start, width) in enumerate(blocks(distance)):
        turned = F.col("fp") if start == 0 else F.shiftleft("fp", start).bitwiseOR(F.shiftrightunsigned("fp", 64 - start))
        root = F.shiftrightunsigned(turned, 64 - width) if width < 64 else F.col("fp")
        rows.append(F.struct(F.lit(t).alias("t"), root.alias("root"), gray_rank(turned).alias("rank"), F.col("fp"), F.col("node")))
    index = entries.select(F.inline(F.array(*rows)))
    name = F.col("root") if distance == 0 else F.col("root") * len(rows) + F.col("t")
    index = index.repartitionByRange(parts, "t", "rank").sortWithinPartitions("t", "rank").select(name.alias("root"), "fp", "node")
    found = kept(index.mapInArrow(A.released(_search(distance)), ENTRY))
    leaves = found.where("root IS NOT NULL")
    other = leaves.select([F.col(c).alias(f"{c}_") for c in leaves.columns])
    differ = F.bit_count(F.col("pattern").bitwiseXOR(F.col("pattern_")).bitwiseAND(F.col("mask")).bitwiseAND(F.col("mask_")))
    met = leaves.join(other, F.col("root") == F.col("root_")).where((F.col("part") < F.col("part_")) & (differ <= distance))
    met = met.select("fps", "nodes", "fps_", "nodes_").mapInArrow(_meet(distance), "a long, b long")
    return found.where("root IS NULL").select("a", "b").unionAll(met)


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = 3, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: (doc_id, fingerprint long, component_id).

    Words are runs of bytes other than ASCII white space after A-Z are lower-cased; a text shorter than a shingle is one
    shingle. Texts without words, null ones included, have fingerprint 0 and link with one another like any others.
    Rows link at `distance` or fewer differing bits; component_id is the smallest id reachable by links, the row's own
    included. A row without an id links with nothing and has a null component_id. Rows that repeat an id share its
    component. An empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    prints = kept(rows.mapInArrow(A.released(_fingerprint(shingle)), "doc long, fp long"))
    entries = kept(prints.where("doc IS NOT NULL").groupBy("fp").agg(F.min("doc").alias("node")))
    merged = connected_components(near_edges(entries, distance))
    ids = entries.join(merged, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    named = prints.join(ids, "fp", "left")
    return named.select(
        F.col("doc").alias(doc_id), F.col("fp").alias("fingerprint"), F.expr("if(doc IS NULL, NULL, component)").alias("component_id")
    )
