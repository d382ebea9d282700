"""Which dates a session has heartbeats under, kept beside a job's output.

    <index>/keys/day=D           64-bit hashes of the session keys under date D
    <index>/signatures           per date, the state of its directory when the keys were taken

A date whose directory has changed since, or that is new, is indexed again before a look-up. Two keys with one hash
make a date be read for nothing; no date is missed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from playbeat.operators.sessions import key_columns
from playbeat.schema import KEYS
from playbeat.session import dir_signature, list_dir
from playbeat.sources.heartbeats import PARTITION

SIGNATURE = "day string, signature string"


NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def key_hashes(rows: DataFrame, *columns: str) -> DataFrame:
    """Distinct hashes of the session keys, with further columns."""
    others = [c for c in rows.columns if c not in KEYS]
    keyed = rows.selectExpr(*key_columns(), *others)
    return keyed.selectExpr(*columns, f"xxhash64({', '.join(KEYS)}) as session").distinct()


def table_dates(spark: SparkSession, input_path: str) -> dict[str, str]:
    """Directory value of each date of a table, with its state; only names and sizes are listed."""
    base = input_path.rstrip("/")
    names = [x for x in list_dir(spark, base) if x.startswith(f"{PARTITION}=")]
    return {x.split("=", 1)[1]: dir_signature(spark, f"{base}/{x}") for x in names}


def refresh_index(spark: SparkSession, input_path: str, index_path: str, load: Callable[[list[str]], DataFrame]) -> list[str]:
    """Brings the index up to the table and returns the table's dates; ``load`` reads the heartbeats of some dates."""
    now = table_dates(spark, input_path)
    marks = f"{index_path}/signatures"
    known = {r.day: r.signature for r in spark.read.schema(SIGNATURE).json(marks).toLocalIterator()} if "_SUCCESS" in list_dir(spark, marks) else {}
    stale = sorted(d for d in now if known.get(d) != now[d])
    if stale:
        keys = key_hashes(load(stale), f"coalesce(cast({PARTITION} as string), '{NO_DAY}') as day")
        (
            keys.hint("rebalance", "day")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{index_path}/keys")
        )
    if known != now:
        # written after the keys: a run broken off between the two indexes again
        spark.createDataFrame(sorted(now.items()), SIGNATURE).coalesce(1).write.mode("overwrite").json(marks)
    return sorted(now)


def canonical(directory: str) -> str:
    """The date as Spark writes it: a directory may leave out leading zeros."""
    try:
        return dt.date(*map(int, directory.split("-"))).isoformat()
    except (TypeError, ValueError):
        return directory


def dates_of_sessions(spark: SparkSession, index_path: str, dates: list[str], touched: DataFrame) -> list[str]:
    """The dates, out of the table's, under which some of the touched sessions have heartbeats; they come to the driver."""
    index = spark.read.schema("session long, day string").parquet(f"{index_path}/keys")
    found = index.join(key_hashes(touched), "session", "left_semi").select("day").distinct()
    days = {r.day for r in found.toLocalIterator()}
    return [d for d in dates if canonical(d) in days]
