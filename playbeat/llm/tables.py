"""Intermediate tables in the shared folder, row numbers without a global sort, and lookups that withstand frequent keys."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playbeat.llm.components import ensure_checkpoint_dir
from playbeat.session import remove_dir


class Scratch:
    """Parquet tables in the folder that all executors share; a table read back has no lineage and outlives executors."""

    def __init__(self, spark: SparkSession, name: str):
        ensure_checkpoint_dir(spark)
        self.spark, self.folder = spark, f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Removes tables that nothing will read again."""
        for name in names:
            remove_dir(self.spark, f"{self.folder}/{name}")


def numbered(scratch: Scratch, rows: DataFrame, by: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with `part` and `at`, and the table of runs (by, part) -> (`n`, `first`, `before`, `size`).

    A row's number within its group, from 0 in the order of `order` (nulls first), is at - first + before, by a join on
    (by, part). Rows are dealt by ranges of (by, order), so a frequent group lies in many parts and is sorted in all of
    them at once; only one row per group and part is ordered in one place. `by` must hold no nulls, and `order` should
    tell rows apart, as equal rows lie in one part.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*by, *order]]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = scratch.keep(dealt.withColumns({"part": F.spark_partition_id(), "at": at}), name)
    runs = dealt.groupBy(*by, "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "size": F.sum("n").over(group)})
    return dealt, scratch.keep(runs, f"{name}_runs")


#: A key is frequent when more than one in so many rows has it, so at most as many keys are.
FREQUENT = 1000


def lookup(scratch: Scratch, left: DataFrame, right: DataFrame, keys: list[str], rows: int, name: str) -> DataFrame:
    """Inner join with a table that has one row per key, however often a key stands on the left.

    At most `FREQUENT` keys stand in more than rows / FREQUENT of the `rows` rows on the left; their rows of `right`
    are broadcast, so that those on the left stay where they are. `left` is read twice.
    """
    often = left.groupBy(*keys).agg(F.count("*").alias("often")).where(F.col("often") > max(256, rows // FREQUENT)).drop("often")
    hot = F.broadcast(scratch.keep(often.join(right, keys), name))
    return left.join(hot, keys).unionByName(left.join(hot.select(*keys), keys, "left_anti").join(right, keys))
