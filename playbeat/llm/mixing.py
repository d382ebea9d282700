"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations alone.

The rows form a tree by their path columns, say domain, language and source. A node's budget is divided among its
children by weight; a child cannot take more than its tokens times the largest number of epochs, and what it leaves
goes to its siblings by their weights. Only what all siblings together cannot take is missing at the parent, whose own
limit is the sum of theirs, so it goes to the parent's siblings in turn. A leaf takes whole epochs and then the prefix of
one more in an order that a seed, the epoch and the id set.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbeat.llm.components import kept

#: Leaves up to which their table is broadcast.
FEW_LEAVES = 20_000


def word_count(text: Column) -> Column:
    """Runs of bytes other than ASCII white space; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def weight_of(column: Column, weights: dict[str, float] | None, other: float) -> Column:
    """A value's weight: its own if listed, else `other`."""
    out = F.lit(float(other))
    for value, weight in (weights or {}).items():
        out = F.when(column == value, float(weight)).otherwise(out)
    return out


def divide(children: DataFrame, parent: list[str]) -> DataFrame:
    """Adds `budget` to (`room`, `weight`, `above`): the parent's budget by weight, at most `room`, the rest to siblings."""
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    by_need = group.orderBy(F.col("room") / F.col("weight"), "node")
    before = F.coalesce(F.sum("room").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    from_here = F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing))
    level = children.withColumn("level", (F.col("above") - before) / from_here)
    full = F.col("room") <= F.col("level") * F.col("weight")
    common = F.max(F.when(~full, F.col("level"))).over(group)
    return level.withColumn("budget", F.when(full, F.col("room")).otherwise(F.greatest(common * F.col("weight"), F.lit(0.0)))).drop("level")


def leaf_budgets(leaves: DataFrame, path: list[str], weights: list[dict[str, float] | None], total: float, most_epochs: int, other: float = 1.0) -> DataFrame:
    """Budgets of the leaves, together at most `total` tokens; `leaves` has the path columns and `tokens`."""
    rooms = leaves
    for level, (name, own) in enumerate(zip(path, weights)):
        rooms = rooms.withColumn(f"weight_{level}", weight_of(F.col(name), own, other))
    usable = reduce(lambda a, b: a & b, [F.col(f"weight_{i}") > 0 for i in range(len(path))])
    rooms = rooms.withColumn("room_leaf", F.when(usable, F.col("tokens") * most_epochs).otherwise(0).cast("double"))
    found, parent = None, []
    for level in range(len(path)):
        own = path[: level + 1]
        nodes = rooms.groupBy(*own).agg(F.sum("room_leaf").alias("room"), F.max(f"weight_{level}").alias("weight")).where("weight > 0 AND room > 0")
        nodes = nodes.withColumn("node", F.col(path[level]))
        if found is None:
            nodes = nodes.withColumn("above", F.lit(float(total)))
        else:
            nodes = nodes.join(found.select(*parent, F.col("budget").alias("above")), parent)
        found = divide(nodes, parent)
        parent = own
    budget = F.floor(F.coalesce(F.col("budget"), F.lit(0.0))).cast("long")
    out = leaves.join(found.select(*path, "budget"), path, "left").withColumn("budget", budget)
    return out.withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0)).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def epoch_key(row_id: Column, seed: int, epoch: Column) -> Column:
    """Place of a row in an epoch's order: a hex string that anyone can recompute."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), row_id.cast("string")))


def plan_mix(rows: DataFrame, path: list[str], weights: list[dict[str, float] | None], *, share: float, most_epochs: int, seed: int, other: float = 1.0) -> DataFrame:
    """One row per leaf: path, tokens, budget, epochs (whole ones) and `cut`, the last key of the epoch begun (null for none).

    `rows` has the path columns without nulls, `id` and `tokens`. The total is `share` of all tokens.
    """
    total = math.floor((rows.agg(F.sum("tokens")).first()[0] or 0) * share)
    # a leaf's rows are summed by so many hex digits of their order that a leaf has about as many parts as a part has rows
    digits = F.greatest(F.ceil(F.log(16.0, F.sqrt(F.count("*")))), F.lit(1)).cast("int").alias("digits")
    leaves = kept(leaf_budgets(rows.groupBy(*path).agg(F.sum("tokens").alias("tokens"), digits), path, weights, total, most_epochs, other))
    keyed = with_plan(rows.select(*path, "id", F.col("tokens").alias("n")), leaves.where("rest > 0"), path).withColumn("key", epoch_key(F.col("id"), seed, F.col("epochs")))
    keyed = keyed.select(*path, "rest", "n", "key", F.substring(F.col("key"), F.lit(1), F.col("digits")).alias("part"))
    parts = keyed.groupBy(*path, "part", "rest").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*path).orderBy("part"))
    edge = parts.withColumn("upto", upto).where("upto > rest AND upto - n <= rest").select(*path, "part", (F.col("upto") - F.col("n")).alias("before"))
    inside = keyed.join(edge, [*path, "part"])
    taken = F.col("before") + F.sum("n").over(Window.partitionBy(*path).orderBy("key"))
    last = inside.withColumn("taken", taken).where("taken <= rest").groupBy(*path).agg(F.max("key").alias("last"))
    cuts = edge.join(last, path, "left").select(*path, F.coalesce("last", "part").alias("cut"))
    return kept(leaves.join(cuts, path, "left").select(*path, "tokens", "budget", "epochs", "cut"))


def with_plan(rows: DataFrame, plan: DataFrame, path: list[str]) -> DataFrame:
    """Rows with their leaf's plan, by broadcast where the leaves are known to be few."""
    return rows.join(F.broadcast(plan) if plan.count() <= FEW_LEAVES else plan, path)


def mix_sources(docs: DataFrame, path: dict[str, Column], weights: dict[str, dict[str, float]], *, share: float = 0.6, most_epochs: int = 4, seed: int = 17, other: float = 1.0, tokens: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The selected rows: all columns of the input, and `epoch`, from 0 up; a row comes once per epoch that takes it.

    `path` names the levels from the top and how to compute them; `weights` gives the levels' weights by value, `other`
    where a value is not listed. A null level counts as ''. A value of weight 0 takes nothing. The target is `share` of
    all tokens; if the tree cannot take it within `most_epochs`, all is taken as often. Tokens are words unless an
    expression is given. A leaf never exceeds its budget, and falls short of it by less than one row. Rows without
    tokens come with the epochs of their leaf; a leaf without tokens gives nothing. Rows that repeat an id stand and fall
    together in an epoch. An empty table gives no rows. A column of the table named like `epoch` is replaced.
    """
    names = [f"__level_{i}" for i in range(len(path))]
    levels = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(names, path.values())]
    counted = word_count(F.col(text).cast("string")) if tokens is None else tokens
    rows = kept(docs.select(*levels, F.col(doc_id).alias("id"), counted.cast("long").alias("tokens")))
    plan = plan_mix(rows, names, [weights.get(level) for level in path], share=share, most_epochs=most_epochs, seed=seed, other=other)
    own = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != "epoch"), *levels)
    plan = plan.where("budget > 0").select(*names, F.col("epochs").alias("__epochs"), F.col("cut").alias("__cut"))
    begun = F.coalesce(epoch_key(F.col(f"`{doc_id}`"), seed, F.col("__epochs")) <= F.col("__cut"), F.lit(False)).cast("long")
    planned = with_plan(own, plan, names).withColumn("__times", F.col("__epochs") + begun).where("__times > 0")
    return planned.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__times") - 1))).drop(*names, "__epochs", "__cut", "__times")
