"""Connected components of a distributed edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keeps the folder the cluster names; only a session without one gets a local folder, which is for tests on one machine."""
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if named is None:
            import tempfile

            named = tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(named)


def kept(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared checkpoint folder and reads them back, which cuts the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and the smallest node that each reaches, by hooking and pointer jumping."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = index[: len(a)], index[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[i], root[j]
        open_ = x != y
        if not open_.any():
            return nodes, nodes[root]
        i, j = i[open_], j[open_]
        low, high = np.minimum(x, y)[open_], np.maximum(x, y)[open_]
        np.minimum.at(root, high, low)
        while not np.array_equal(root, up := root[root]):
            root = up


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a batch as stars, which never are more than its nodes."""
    for batch in batches:
        nodes, root = roots(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        child = nodes != root
        yield pa.RecordBatch.from_arrays([pa.array(nodes[child]), pa.array(root[child])], names=["a", "b"])


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest partner of u, or u itself; a table of its own so that a join with a frequent u can be split."""
    return kept(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))


def _mark(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node in the edges.

    `edges` has two long columns, `a` and `b`, in any order and number; nulls and loops are ignored. The result is one
    row (node, component) per node. Large stars and small stars take turns until nothing changes; a few rounds do, as
    each halves the depth of long chains. Stars are first made inside tasks. No step gathers a component in one place:
    the smallest partner is a combinable aggregate, and it goes back by a join that Spark can split.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    pairs = pairs.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    stars = kept(pairs.mapInArrow(_contract, "a long, b long").distinct())  # a: child, b: root
    mark = _mark(stars)
    if mark[0] == 0:
        return stars.selectExpr("a AS node", "b AS component")
    for _ in range(most_rounds):
        both = stars.selectExpr("a AS u", "b AS v").unionAll(stars.selectExpr("b AS u", "a AS v"))
        large = both.join(_smallest(both), "u").where("v > u").selectExpr("v AS u", "m AS v")
        large = kept(large.where("u <> v").distinct())
        low = _smallest(large)
        small = large.join(low, "u").selectExpr("v AS a", "m AS b").unionAll(low.selectExpr("u AS a", "m AS b"))
        stars = kept(small.where("a <> b").distinct())
        now = _mark(stars)
        if now == mark:
            return stars.selectExpr("a AS node", "b AS component").unionAll(
                stars.selectExpr("b AS node", "b AS component").distinct()
            )
        mark = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
