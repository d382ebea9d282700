"""Prefix trie of conversations: every distinct start of a conversation with who shares it and what sharing saves.

Conversations are cut into blocks of turns. A block is known by what stands before it, of which a fingerprint of 128
bits is carried (an exclusive or of hashes of turn and place, so that it adds up over any parts of a conversation), and
equal blocks become one row with a count. These rows are sorted by prefix and dealt over shards. A shard numbers its
turns densely, packs its blocks into a double array (BASE and CHECK), and walks all of them through it, which counts
conversations at each node. Upper nodes that several shards share meet globally by depth and fingerprint.

What a node's subtree holds is summed by doubling: sums over descendants up to some distance are handed to the ancestor
at that distance, which is found through the node's smallest conversation, so no frequent key is joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbeat.llm.arrays import released
from playbeat.llm.mixing import word_count
from playbeat.llm.tables import Scratch, lookup, numbered

#: Turns of a block.
BLOCK = 32
#: Blocks of which a stretch of one conversation is summed before stretches are.
STRETCH = 1024
#: Blocks packed into one double array.
SHARD = 4096
#: Ids of one text that is hashed at once.
CHUNK = 4096
NODE = ["depth", "f1", "f2"]


class DoubleArray:
    """A trie of number sequences: the child of state s by symbol c is BASE[s] + c if CHECK there is s. State 0 is the root."""

    def __init__(self, sequences: np.ndarray):
        """Packs the rows of a matrix of symbols from 1; 0 ends a row."""
        self.base, self.check, self.low = np.zeros(1024, np.int64), np.full(1024, -1, np.int64), 1
        self.check[0] = 0
        state = np.zeros(len(sequences), np.int64)
        for column in sequences.T:
            on = np.flatnonzero(column)
            if len(on) == 0:
                break
            edges, where = np.unique(state[on] << 32 | column[on], return_inverse=True)
            state[on] = self._add(edges >> 32, edges & 0xFFFFFFFF)[where]

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base, self.check = np.append(self.base, np.zeros(more, np.int64)), np.append(self.check, np.full(more, -1, np.int64))

    def _free(self, count: int) -> np.ndarray:
        """The first free places."""
        while True:
            found = self.low + np.flatnonzero(self.check[self.low :] < 0)[:count]
            if len(found) == count:
                self.low = int(found[0]) if count else self.low
                return found
            self._room(2 * len(self.check) + count)

    def _add(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """States of new edges, which are sorted by parent and symbol."""
        _, first, counts = np.unique(parents, return_index=True, return_counts=True)
        out = np.empty(len(parents), np.int64)
        for at, n in zip(first[counts > 1].tolist(), counts[counts > 1].tolist()):
            apart = symbols[at : at + n] - symbols[at]
            tried = self._free(64)
            self._room(int(tried[-1] + apart[-1]) + 1)
            fits = (self.check[tried[:, None] + apart[None, :]] < 0).all(1)
            if fits.any():
                start = int(tried[fits.argmax()])
            else:  # behind everything
                start = int(np.flatnonzero(self.check >= 0)[-1]) + 1
                self._room(start + int(apart[-1]) + 1)
            self._put(parents[at : at + 1].repeat(n), symbols[at : at + n], start + apart, out[at : at + n])
        single = first[counts == 1]
        places = self._free(len(single))
        found = np.empty(len(single), np.int64)
        self._put(parents[single], symbols[single], places, found)
        out[single] = found
        return out

    def _put(self, parents: np.ndarray, symbols: np.ndarray, places: np.ndarray, out: np.ndarray) -> None:
        self.base[parents] = places - symbols
        self.check[places] = parents
        out[:] = places

    def walk(self, sequences: np.ndarray) -> np.ndarray:
        """State after each symbol of each row, -1 behind its end and where the trie does not go on."""
        states = np.full(sequences.shape, -1, np.int64)
        state = np.zeros(len(sequences), np.int64)
        for i, column in enumerate(sequences.T):
            on = np.flatnonzero((column > 0) & (state >= 0))
            place = self.base[state[on]] + column[on]
            inside = (place > 0) & (place < len(self.check))
            known = inside & (self.check[np.where(inside, place, 0)] == state[on])
            state[:] = -1
            state[on[known]] = place[known]
            states[:, i] = state
        return states


def dense(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Numbers from 1 for equal keys, by where they stand first in the given order."""
    _, first, number = np.unique(keys[order], return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first, kind="stable")] = np.arange(1, len(first) + 1)
    out = np.empty(len(keys), np.int64)
    out[order] = rank[number]
    return out


_PARTIAL = [("depth", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("q1", pa.int64()), ("q2", pa.int64()), ("n_convs", pa.int64()), ("conv", pa.int64()), ("words", pa.int64())]
PARTIAL = "depth long, f1 long, f2 long, q1 long, q2 long, n_convs long, conv long, words long"


def shard_nodes(table: pa.Table) -> pa.RecordBatch:
    """Nodes of one shard: blocks (block, s1, s2, items of (pos, key, words, f1, f2), n, conv) through a double array."""
    lists = table["items"].combine_chunks()
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    items = lists.flatten()
    field = lambda name: items.field(name).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keys = np.frombuffer(b"".join(items.field("key").to_pylist()), "V16")
    start = np.stack([table[c].to_numpy().astype(np.int64) for c in ("block", "s1", "s2")], axis=1)
    own = np.ascontiguousarray(start).view("V24")[:, 0]
    sequences = np.zeros((len(sizes), int(sizes.max()) + 1), np.int64)
    sequences[:, 0] = dense(own, np.arange(len(own)))
    sequences[row, column + 1] = dense(keys, np.lexsort((row, column))) + sequences[:, 0].max()
    states = DoubleArray(sequences).walk(sequences)[row, column + 1]
    nodes, first, node = np.unique(states, return_index=True, return_inverse=True)
    n, conv = np.zeros(len(nodes), np.int64), np.full(len(nodes), np.iinfo(np.int64).max)
    np.add.at(n, node, table["n"].to_numpy()[row])
    np.minimum.at(conv, node, table["conv"].to_numpy()[row])
    f1, f2 = field("f1"), field("f2")
    before = column[first] > 0
    q = [np.where(before, f[first - 1], s[row[first]]) for f, s in ((f1, start[:, 1]), (f2, start[:, 2]))]
    found = [field("pos")[first], f1[first], f2[first], *q, n, conv, field("words")[first]]
    return pa.record_batch([pa.array(x, pa.int64()) for x in found], names=[c for c, _ in _PARTIAL])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, SHARD):
            part = batch.slice(lo, SHARD)
            if rows and rows + part.num_rows > SHARD:
                yield shard_nodes(pa.Table.from_batches(held))
                held, rows = [], 0
            held, rows = [*held, part], rows + part.num_rows
    if rows:
        yield shard_nodes(pa.Table.from_batches(held))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv) to (node, first conv, ids as text), some ids at a time."""
    for batch in batches:
        d, f1, f2, conv = (batch.column(i).to_numpy() for i in range(4))
        new = (np.diff(d) != 0) | (np.diff(f1) != 0) | (np.diff(f2) != 0)
        cuts = np.unique(np.concatenate([[0], np.flatnonzero(new) + 1, np.arange(0, len(d), CHUNK)])).astype(int)
        texts = [",".join(map(str, part.tolist())) for part in np.split(conv, cuts[1:])] if len(d) else []
        cuts = cuts[: len(texts)]
        yield pa.record_batch([*(pa.array(x[cuts]) for x in (d, f1, f2, conv)), pa.array(texts, pa.string())], names=[*NODE, "conv", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to one digest per node; a node's ids go through the hash and are not held."""
    last, running = None, None
    for batch in batches:
        done = []
        for *node, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if node == last:
                running.update(b"," + ids.encode())
                continue
            if last is not None:
                done.append((*last, running.hexdigest()))
            last, running = node, hashlib.sha256(ids.encode())
        if done:
            yield _digest_rows(done)
    if last is not None:
        yield _digest_rows([(*last, running.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.record_batch([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names=[*NODE, "ends_sha256"])


def _ends_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv). Ids are joined where they lie sorted; only these texts meet in one task."""
    order = [*NODE, "conv"]
    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = dealt.mapInArrow(_chunks, "depth long, f1 long, f2 long, conv long, ids string")
    return chunks.repartition(*NODE).sortWithinPartitions(*order).mapInArrow(_digests, "depth long, f1 long, f2 long, ends_sha256 string")


def turn_rows(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, key, words): key is the MD5 of role and text, null ones empty; rows without a conversation go."""
    own = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    key = F.md5(F.concat(F.octet_length(own(role)).cast("string"), F.lit(":"), own(role), own(text)))
    rows = turns.where(F.col(f"`{conv_id}`").isNotNull())
    return rows.select(F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.unhex(key).alias("key"), word_count(own(text)).alias("words"))


def shared_starts(scratch: Scratch, rows: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, len) and their turns (conv, pos from 1, key, words, len), rebuilt upon another's start.

    Conversation `conv` gets the first `head` (at most `most`) turns of conversation `base`, as many as there are, then
    its own after its first `head`. Both are expressions over `conv`. Turns are ordered by turn (null first) and key.
    """
    rows = scratch.keep(rows.withColumn("tie", F.monotonically_increasing_id()), "read")
    dealt, runs = numbered(scratch, rows, ["conv"], ["turn", "key", "tie"], "turns")
    scratch.drop("read")
    own = runs.groupBy("conv").agg(F.max("size").alias("own")).withColumns({"base": base, "head": head})
    held = own.select(F.col("conv").alias("base"), F.col("own").alias("there"))
    own = own.join(held, "base", "left").withColumn("taken", F.least("head", F.coalesce("there", F.lit(0))))
    own = scratch.keep(own.withColumn("len", F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))), "convs")
    runs = scratch.keep(runs.drop("size").join(own.select("conv", "head", "taken", "len"), "conv"), "placed")
    placed = dealt.join(runs, ["conv", "part"]).withColumn("i", F.col("at") - F.col("first") + F.col("before") + 1)
    after = placed.where("i > head").selectExpr("conv", "i - head + taken AS pos", "key", "words", "len")
    starts = placed.where(F.col("i") <= most).selectExpr("conv AS base", "i AS pos", "key", "words")
    starts = own.select("conv", "base", "taken", "len").join(starts, "base").where("pos <= taken")
    return own.select("conv", "len"), starts.select(*after.columns).unionByName(after)


def _with_prefixes(scratch: Scratch, turns: DataFrame) -> DataFrame:
    """Adds block, s1 and s2 (fingerprint of what stands before the block), f1 and f2 (that of all up to the turn)."""
    rows = turns.withColumn("block", ((F.col("pos") - 1) / F.lit(BLOCK)).cast("long"))
    running = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    marks = {"p1": F.bit_xor(F.xxhash64("pos", "key")).over(running), "p2": F.bit_xor(F.xxhash64("key", "pos")).over(running)}
    rows = scratch.keep(rows.withColumns(marks), "blocks")
    # only conversations of several blocks have anything before a block; stretches of blocks are summed, then stretches
    whole = rows.where(f"len > {BLOCK} AND pos % {BLOCK} = 0").selectExpr("conv", "block", f"block DIV {STRETCH} AS stretch", "p1", "p2")
    inside = Window.partitionBy("conv", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    within = whole.withColumns({c: F.bit_xor(c).over(inside) for c in ("p1", "p2")})
    sums = whole.groupBy("conv", "stretch").agg(F.bit_xor("p1").alias("w1"), F.bit_xor("p2").alias("w2"))
    earlier = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({c: F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)) for c in ("w1", "w2")})
    starts = within.join(sums, ["conv", "stretch"]).selectExpr("conv", "block + 1 AS block", "p1 ^ w1 AS s1", "p2 ^ w2 AS s2")
    rows = rows.join(starts, ["conv", "block"], "left").na.fill(0, ["s1", "s2"])
    rows = scratch.keep(rows.withColumns({"f1": F.expr("p1 ^ s1"), "f2": F.expr("p2 ^ s2")}).drop("p1", "p2"), "prefixes")
    scratch.drop("blocks")
    return rows


def _descendant_sums(scratch: Scratch, nodes: DataFrame, turns: DataFrame, deepest: int) -> DataFrame:
    """(node, n_leaves, saved_tokens): what all proper descendants add. A round per power of two up to the depth."""
    value = ["n_leaves", "saved_tokens"]
    open_, found, reach, k = nodes.where("depth > 0").select(*NODE, "q1", "q2", "conv", *value), [], 1, 0
    while reach <= deepest:
        if reach == 1:
            up = open_.selectExpr("depth - 1 AS depth", "q1 AS f1", "q2 AS f2", *value)
        else:
            there = turns.where(f"len > {reach}").selectExpr("conv", f"pos + {reach} AS depth", "f1 AS a1", "f2 AS a2")
            up = open_.select("conv", "depth", *value).where(f"depth > {reach}").join(there, ["conv", "depth"])
            up = up.selectExpr(f"depth - {reach} AS depth", "a1 AS f1", "a2 AS f2", *value)
            up = up.unionByName(open_.where(f"depth = {reach}").selectExpr("0L AS depth", "0L AS f1", "0L AS f2", *value))
        sums = scratch.keep(up.groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in value]), f"sums{k}")
        found.append(sums)
        reach, k = 2 * reach, k + 1
        if reach <= deepest:
            more = sums.where(f"depth >= {reach}").select(*NODE, *[F.col(c).alias(f"more_{c}") for c in value])
            open_ = open_.where(f"depth >= {reach}").join(more, NODE, "left").na.fill(0, [f"more_{c}" for c in value])
            open_ = scratch.keep(open_.selectExpr(*NODE, "conv", *[f"{c} + more_{c} AS {c}" for c in value]), f"open{k}")
    if not found:
        return nodes.limit(0).select(*NODE, *value)
    return reduce(DataFrame.unionByName, found).groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in value])


def prefix_trie(scratch: Scratch, convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie over the conversations (conv, len) and their turns (conv, pos from 1, key, words, len).

    Columns: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, as the registered query states them. Conversations without turns are members of the
    root. No conversation gives no row, not even a root. No conversation, group of copies or subtree is gathered; but
    the ids that end at one node, as text, are hashed one after another in one task, since a digest cannot be split.
    """
    facts = convs.agg(F.max("len").alias("deepest")).first()
    turns = _with_prefixes(scratch, turns)
    items = F.sort_array(F.collect_list(F.struct("pos", "key", "words", "f1", "f2")))  # at most BLOCK
    blocks = turns.groupBy("conv", "block", "s1", "s2").agg(items.alias("items"))
    last = F.element_at("items", -1)
    blocks = blocks.withColumns({"e1": last["f1"], "e2": last["f2"], "size": F.size("items")})
    blocks = blocks.groupBy("block", "s1", "s2", "e1", "e2", "size").agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("items").alias("items"))
    blocks = scratch.keep(blocks.drop("e1", "e2", "size").withColumn("path", F.col("items.key")), "distinct")
    order = ["block", "s1", "s2", "path"]
    dealt = blocks.repartitionByRange(*order).sortWithinPartitions(*order).drop("path")
    partial = dealt.mapInArrow(released(_shards), PARTIAL)
    least = [F.max(c).alias(c) for c in ("q1", "q2", "words")]
    nodes = partial.groupBy(*NODE).agg(F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"), *least)
    whole = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).where("n_convs > 0")
    root = whole.selectExpr("0L AS depth", "0L AS f1", "0L AS f2", "n_convs", "conv", "0L AS q1", "0L AS q2", "0L AS words")
    nodes = scratch.keep(nodes.unionByName(root), "merged")
    children = nodes.where("depth > 0").selectExpr("depth - 1 AS depth", "q1 AS f1", "q2 AS f2").groupBy(*NODE).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").na.fill(0, ["n_children"])
    nodes = scratch.keep(nodes.selectExpr("*", "if(n_children = 0, 1L, 0L) AS n_leaves", "(n_convs - 1) * words AS saved_tokens"), "nodes")
    scratch.drop("distinct", "merged")

    below = _descendant_sums(scratch, nodes, turns, int(facts.deepest or 0)).withColumnsRenamed({"n_leaves": "more_leaves", "saved_tokens": "more_saved"})
    ends = turns.where("pos = len").selectExpr("len AS depth", "f1", "f2", "conv")
    ends = _ends_digests(ends.unionByName(convs.where("len = 0").selectExpr("0L AS depth", "0L AS f1", "0L AS f2", "conv")))
    full = nodes.join(below, NODE, "left").na.fill(0, ["more_leaves", "more_saved"]).join(ends, NODE, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    full = full.selectExpr(
        "depth", "q1", "q2", "conv AS conv_id", "n_convs", "n_children", "n_leaves + more_leaves AS n_leaves",
        "saved_tokens + more_saved AS saved_tokens", f"coalesce(ends_sha256, '{nothing}') AS ends_sha256",
    )
    full = scratch.keep(full, "full")
    up = ["up", "q1", "q2"]
    parents = nodes.selectExpr("depth AS up", "f1 AS q1", "f2 AS q2", "conv AS parent_conv_id")
    below_root = lookup(scratch, full.where("depth > 0").withColumn("up", F.col("depth") - 1), parents, up, nodes.count(), "frequent")
    rows = below_root.drop(*up).unionByName(full.where("depth = 0").drop("q1", "q2").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return rows.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversation_trie(
    turns: DataFrame, *, base: Column | None = None, head: Column | None = None, most: int = 0,
    conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """The prefix trie of a table of turns, see `prefix_trie`; `base`, `head` and `most` as in `shared_starts`.

    Turns are ordered by turn, null first, equal ones by the MD5 of role and text, so repeated rows are turns of their own.
    Null role and text are empty. Rows without a conv_id are left out. An empty table gives no rows. Other columns are
    ignored. saved_tokens counts runs of bytes other than ASCII white space.
    """
    scratch = Scratch(turns.sparkSession, "trie")
    base = F.col("conv") if base is None else base
    head = F.lit(0).cast("long") if head is None else head.cast("long")
    convs, rows = shared_starts(scratch, turn_rows(turns, conv_id, turn, role, text), base, head, most)
    return prefix_trie(scratch, convs, rows)
