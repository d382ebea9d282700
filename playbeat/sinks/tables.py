"""Writers of session metrics: partitioned tables, JSON lines, flat CSV, and the upsert."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from playbeat.operators.reshape import flatten_metrics, round_flat
from playbeat.session import remove_dir

SESSION_COLUMNS = ["customer_id", "content_id", "client_id"]
METRIC_KEYS = [*SESSION_COLUMNS, "event_date"]


def write_metrics(
    df: DataFrame,
    output_path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = ("event_date",),
    replace_table: bool = False,
) -> None:
    """Replace the partitions present in ``df`` and leave all others, or replace the whole table.

    The rebalance splits a large date over tasks and merges small ones; sorting keeps the viewers of
    one content together within a file.
    """
    order = [c for c in ("content_id", "client_id") if c not in partition_by]
    (
        df.hint("rebalance", *partition_by)
        .sortWithinPartitions(*partition_by, *order)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_table else "dynamic")
        .partitionBy(*partition_by)
        .save(output_path)
    )


def write_json(metrics: DataFrame, output_path: str) -> None:
    """JSON lines with nulls kept and the date as text."""
    rows = metrics.withColumn("event_date", F.col("event_date").cast("string"))
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(output_path)


def write_csv(metrics: DataFrame, output_path: str, labels: list[str] | None = None) -> None:
    """Flat CSV with a header; missing values are empty, missing labels 0."""
    flat = round_flat(flatten_metrics(metrics, labels))
    flat.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(output_path)


def upsert_metrics(current: DataFrame, updates: DataFrame, keys: Sequence[str] = METRIC_KEYS) -> DataFrame:
    """Rows of ``updates`` replace the rows of ``current`` with the same session key and date."""
    kept = current.join(updates.select(*keys), on=list(keys), how="left_anti")
    return kept.unionByName(updates)


def _current(spark: SparkSession, path: str, fmt: str, schema) -> DataFrame | None:
    """A metrics table as it stands, None before the first write."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return None


def _partition(output_path: str, day) -> str:
    return f"{output_path.rstrip('/')}/event_date={day if day is not None else '__HIVE_DEFAULT_PARTITION__'}"


def replace_sessions(
    spark: SparkSession,
    updates: DataFrame,
    touched: DataFrame,
    output_path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = ("event_date",),
    keys: Sequence[str] = SESSION_COLUMNS,
) -> None:
    """``updates`` replace all rows of the ``touched`` keys, also those under other dates.

    The date of a session may move when earlier heartbeats arrive, so its old row is looked for in the whole
    table. Only the dates that lose or gain rows are rewritten, and a date that loses its last row goes.
    Plain files cannot be overwritten while they are read: the merged rows are written beside the table first.
    """
    current = _current(spark, output_path, fmt, updates.schema)
    if current is None:
        write_metrics(updates, output_path, fmt, partition_by, replace_table=True)
        return
    by_day = partition_by[0] == "event_date"
    names = list(keys)
    touched = touched.select(*names).distinct()
    staging = f"{output_path.rstrip('/')}_staging_{uuid.uuid4().hex}"
    updates.write.parquet(f"{staging}/updates")
    updates = spark.read.schema(updates.schema).parquet(f"{staging}/updates")
    days: list = []
    if by_day:
        old = current.join(touched, on=names, how="left_semi").select("event_date")
        # dates, of which a run touches few, come to the driver
        days = [r.event_date for r in old.unionAll(updates.select("event_date")).distinct().toLocalIterator()]
        current = current.filter(F.col("event_date").isin([d for d in days if d is not None]) | F.lit(None in days) & F.col("event_date").isNull())
    kept = current.join(touched, on=names, how="left_anti").select(*updates.columns)
    kept.unionByName(updates).write.parquet(f"{staging}/merged")
    merged = spark.read.schema(updates.schema).parquet(f"{staging}/merged")
    write_metrics(merged, output_path, fmt, partition_by, replace_table=not by_day)
    left = {r.event_date for r in merged.select("event_date").distinct().toLocalIterator()} if by_day else set()
    for day in days:
        if day not in left:
            remove_dir(spark, _partition(output_path, day))
    remove_dir(spark, staging)


def replace_partitions(
    rows: DataFrame, output_path: str, fmt: str, partition_by: Sequence[str], whole: Sequence[tuple]
) -> None:
    """``rows`` are all there is of the partitions ``whole``: those are replaced, and removed where they have no row.

    ``rows`` are read twice, so they should be persisted. At most one entry per partition of ``whole`` comes to the driver.
    """
    spark = rows.sparkSession
    write_metrics(rows, output_path, fmt, partition_by)
    held = {tuple("" if v is None else str(v) for v in r) for r in rows.select(*partition_by).distinct().toLocalIterator()}
    for values in whole:
        if tuple("" if v is None else str(v) for v in values) not in held:
            names = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(partition_by, values)]
            remove_dir(spark, "/".join([output_path.rstrip("/"), *names]))


def replace_date(
    spark: SparkSession,
    updates: DataFrame,
    day: str,
    output_path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = ("event_date",),
) -> None:
    """``updates``, all of one date, replace that date; a date without updates goes."""
    current = _current(spark, output_path, fmt, updates.schema)
    if current is None or partition_by[0] == "event_date":
        if current is not None and updates.isEmpty():
            remove_dir(spark, _partition(output_path, day))
        else:
            write_metrics(updates, output_path, fmt, partition_by)
        return
    keys = [*SESSION_COLUMNS, "event_date"]
    old = current.filter(F.col("event_date") == F.lit(day).cast("date")).select(*keys)
    replace_sessions(spark, updates, old.unionByName(updates.select(*keys)), output_path, fmt, partition_by, keys)


def upsert_table(
    spark: SparkSession,
    updates: DataFrame,
    output_path: str,
    fmt: str = "parquet",
    by_date: bool = False,
) -> None:
    """Upsert into a table partitioned by ``event_date``.

    Sessions that are split at midnight are known by their date, too; the date of others is a result that may
    have changed, so their old row is replaced under whatever date it stands.
    """
    replace_sessions(spark, updates, updates, output_path, fmt, keys=METRIC_KEYS if by_date else SESSION_COLUMNS)
