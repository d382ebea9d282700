"""Merkle manifest of a table: a root over all rows, and for every row the proof that it is in the table.

Rows are leaves; the leaves of a group, in their order, are hashed two by two until one node is left, the group's
subroot, and the subroots are hashed likewise to the root. Blocks of neighbouring nodes are hashed in one task, some
levels at once. Proofs come by pointer jumping: every node first holds the segment of its proof towards its parent,
and repeated self-joins double the distance to the ancestor it points to and append that ancestor's segment, until
every leaf points to the root. A node that no pointer of the next round can meet is left out, so the joined tables
shrink to little more than the leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbeat.llm.arrays import released
from playbeat.llm.tables import Scratch, lookup, numbered

#: Levels hashed at once; a block has 2 ** LEVELS nodes.
LEVELS = 10
#: Group number of the tree over the subroots.
TOP = -1
# A step of a proof: one byte that tells where the sibling stands, and its digest if there is one.
ALONE, LEFT, RIGHT = b"\0", b"\1", b"\2"
NODE = ["g", "l", "p"]
NODES = "g long, l long, p long, proof binary, ag long, al long, ap long, digest binary, size long"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def row_digest(columns: list[str | Column]) -> Column:
    """Lowercase hex SHA-256 of the columns' texts, each `-` if null, else its length in bytes, `:` and the text."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _hash_block(level: int, levels: int):
    """Nodes of one group's block, at `level` and above, with their step to the parent; the last row is the block's top."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("p")
        g, size = table["g"][0].as_py(), table["size"][0].as_py()
        first, here, out, at = table["p"][0].as_py(), [d.hex() for d in table["digest"].to_pylist()], [], level
        while at < level + levels and (count := (size + (1 << at) - 1) >> at) > 1:
            last = (count + 1) // 2 == 1
            for i, own in enumerate(here):
                p, other = first + i, i ^ 1
                step = ALONE if other >= len(here) else (LEFT if i & 1 else RIGHT) + bytes.fromhex(here[other])
                up = ((None, None, None) if g == TOP else (TOP, 0, g)) if last else (g, at + 1, p >> 1)
                out.append((g, at, p, step, *up, None, size))
            here = [digest("".join(here[i : i + 2])) for i in range(0, len(here), 2)]
            first, at = first >> 1, at + 1
        out.append((g, at, first, None, None, None, None, bytes.fromhex(here[0]), size))
        return pa.table(dict(zip([c.split()[0] for c in NODES.split(", ")], zip(*out), strict=True)), schema=_SCHEMA)

    return run


_SCHEMA = pa.schema([(c, pa.int64() if kind == "long" else pa.binary()) for c, kind in (x.split() for x in NODES.split(", "))])


def _grown(scratch: Scratch, leaves: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Node tables of the trees over leaves (g, p, digest, size) of at most `most` leaves each, and their tops."""
    nodes, ended, tops, level = [], [], leaves, 0
    while level == 0 or (most - 1) >> level:
        blocks = tops.withColumn("block", F.shiftright("p", LEVELS)).groupBy("g", "block")
        grown = scratch.keep(blocks.applyInArrow(_hash_block(level, LEVELS), NODES), f"{name}{level}")
        nodes.append(grown.where("proof IS NOT NULL").drop("digest", "size"))
        level += LEVELS
        tops = grown.where("digest IS NOT NULL").select("g", "p", "digest", "size")
        ended.append(tops.where(f"size <= shiftleft(1L, {level})"))
        tops = tops.where(f"size > shiftleft(1L, {level})")
    return nodes, reduce(DataFrame.unionByName, ended)


def _jump(scratch: Scratch, nodes: DataFrame, depth: int, leaves: int) -> DataFrame:
    """All nodes of level 0 and of the top tree with their proofs up to the root; `nodes` hold one step each."""
    pointers, reach, k = nodes, 1, 1
    while reach < depth:
        later = f"g = {TOP} OR l % {2 * reach} = 0"
        there = f"g = {TOP} OR l % {2 * reach} = {reach}"
        going = pointers.where(f"ag IS NOT NULL AND ({later})")
        ahead = pointers.where(there).selectExpr("g AS ag", "l AS al", "p AS ap", "proof AS rest", "ag AS bg", "al AS bl", "ap AS bp")
        up = ["ag", "al", "ap"]
        # an ancestor at this distance has at most 2 ** reach leaves
        met = going.join(ahead, up) if reach <= 8 else lookup(scratch, going, ahead, up, leaves, f"often{k}")
        met = met.selectExpr(*NODE, "concat(proof, rest) AS proof", "bg AS ag", "bl AS al", "bp AS ap")
        pointers = scratch.keep(met.unionByName(pointers.where(f"ag IS NULL AND ({later})")), f"jump{k}")
        scratch.drop(f"jump{k - 1}", f"often{k}")
        reach, k = 2 * reach, k + 1
    return pointers.select(*NODE, "proof")


def merkle_proofs(rows: DataFrame, *, leaf: str = "leaf", group: str = "lang", order: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """One row per input row: the `keep` columns (all by default), `leaf`, `subroot`, `root` (hex) and `proof` (binary).

    `leaf` names a column of hex SHA-256 digests. Groups may be null, which is a group of its own and the first one;
    groups follow each other by their UTF-8 bytes, leaves by `order`, null first, equal ones by their digest. Repeated
    rows are leaves of their own; a missing digest counts as that of the empty text. An empty table gives no rows. Columns may have any names but those of the result.

    No group is gathered: leaves are numbered by ranges, and a task hashes blocks of 2 ** LEVELS nodes. The driver
    reads the largest group's size, the number of groups and the root.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "merkle")
    names = [c for c in (rows.columns if keep is None else keep) if c != leaf]
    own = F.struct(*[F.col(f"`{c}`") for c in names] or [F.lit(True).alias("none")]).alias("row")
    taken = rows.select(
        F.col(f"`{group}`").isNotNull().alias("named"), F.coalesce(F.col(f"`{group}`").cast("string"), F.lit("")).alias("name"), F.col(f"`{order}`").alias("rank"),
        F.coalesce(F.unhex(F.col(f"`{leaf}`")), F.unhex(F.sha2(F.lit(""), 256))).alias("digest"), F.monotonically_increasing_id().alias("tie"), own,
    )
    taken = scratch.keep(taken, "rows")
    by = ["named", "name"]
    dealt, runs = numbered(scratch, taken, by, ["rank", "digest", "tie"], "dealt")
    scratch.drop("rows")
    groups, order_of = numbered(scratch, runs.groupBy(*by).agg(F.max("size").alias("size")), [], by, "groups")
    groups = scratch.keep(groups.join(order_of.select("part", "first", "before"), "part").selectExpr(*by, "at - first + before AS g", "size"), "ranked")
    facts = groups.agg(F.count("*").alias("groups"), F.max("size").alias("most"), F.sum("size").alias("rows")).first()
    if not facts.groups:
        return dealt.selectExpr(*(["row.*"] if names else []), "'' AS leaf", "'' AS subroot", "'' AS root", "digest AS proof")
    runs = scratch.keep(runs.drop("size").join(groups, by).select(*by, "part", "first", "before", "g", "size"), "runs")
    leaves = dealt.join(runs, [*by, "part"]).selectExpr("g", "part", "at - first + before AS p", "size", "digest", "row")
    leaves = scratch.keep(leaves, "leaves")
    scratch.drop("dealt", "dealt_runs", "groups", "groups_runs", "ranked")

    nodes, subroots = _grown(scratch, leaves.select("g", "p", "digest", "size"), facts.most, "tree")
    subroots = scratch.keep(subroots.selectExpr("g", "digest AS subroot"), "subroots")
    many = int(facts.groups)
    top = subroots.selectExpr(f"{TOP}L AS g", "g AS p", "subroot AS digest", f"{many}L AS size")
    above, ends = _grown(scratch, top, many, "top")
    root = ends.first().digest.hex()

    steps = reduce(DataFrame.unionByName, [*nodes, *above])
    if many == 1:  # a subroot alone is the root, where the way ends
        for c in ("ag", "al", "ap"):
            steps = steps.withColumn(c, F.when(F.col("ag") != TOP, F.col(c)))
    steps = scratch.keep(steps, "jump0")
    scratch.drop(*[f"{name}{level}" for name in ("tree", "top") for level in range(0, 64, LEVELS)])
    depth = (int(facts.most) - 1).bit_length() + (many - 1).bit_length()
    proofs = _jump(scratch, steps, depth, int(facts.rows))

    # a group's only leaf is its subroot, a node of the top tree
    ends = runs.select("g", "part").join(subroots, "g")
    found = leaves.join(ends, ["g", "part"])
    found = found.selectExpr("row", "digest", "subroot", f"if(size = 1, {TOP}L, g) AS g", "0L AS l", "if(size = 1, g, p) AS p").join(proofs, NODE, "left")
    return found.select(
        *([F.col("row.*")] if names else []), F.lower(F.hex("digest")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"),
        F.lit(root).alias("root"), F.coalesce("proof", F.lit(b"")).alias("proof"),
    )


def fold(leaf: str, proof: bytes) -> tuple[str, list[str]]:
    """The root that a leaf and a proof lead to, and the siblings on the way."""
    at, siblings = 0, []
    while at < len(proof):
        where = proof[at : at + 1]
        at += 1
        if where == ALONE:
            leaf = digest(leaf)
            continue
        other = proof[at : at + 32].hex()
        at += 32
        siblings.append(other)
        leaf = digest(other + leaf if where == LEFT else leaf + other)
    return leaf, siblings


def fold_proofs(rows: DataFrame, *, leaf: str = "leaf", proof: str = "proof", root: str = "root") -> DataFrame:
    """All columns of every row, and what its leaf and proof give: `folded_root`, `proof_sha256` of the siblings, `verified`.

    A null leaf leads nowhere: folded_root is null, verified false. Columns of those names are replaced.
    """
    made = ["folded_root", "proof_sha256", "verified"]
    names = [c for c in rows.columns if c not in made]
    where = [names.index(c) for c in (leaf, proof, root)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, proofs, roots = (batch.column(i).to_pylist() for i in where)
            found = [fold(x or "", y or b"") for x, y in zip(leaves, proofs)]
            folded = [f[0] if x is not None else None for f, x in zip(found, leaves)]
            hashes = pa.array([digest("".join(f[1])) for f in found], pa.string())
            same = pa.array([f is not None and f == r for f, r in zip(folded, roots)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(folded, pa.string()), hashes, same], names=[*names, *made])

    from pyspark.sql import types as T

    kinds = [T.StringType(), T.StringType(), T.BooleanType()]
    schema = T.StructType([*(rows.schema[c] for c in names), *(T.StructField(c, k) for c, k in zip(made, kinds))])
    return rows.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(released(run), schema)
