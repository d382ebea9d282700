"""Heartbeat tables: partitioned file scans and streams, always with an explicit schema."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.types import StructType

from playbeat.schema import HEARTBEAT, HEARTBEAT_NARROW, as_text
from playbeat.sources.quarantine import split_malformed

PARTITION = "eventDate"
TABLE_FORMATS = ("delta",)  # formats that keep their own file list instead of directories


def filter_date(df: DataFrame, date_partition: str | dt.date | None) -> DataFrame:
    """Keep one event date; on a partitioned table this prunes directories before listing files."""
    if date_partition is None:
        return df
    return df.filter(F.col(PARTITION) == F.lit(str(date_partition)).cast("date"))


def read_telemetry(
    spark: SparkSession,
    input_path: str,
    date_partition: str | None = None,
    fmt: str = "parquet",
    schema: StructType = HEARTBEAT,
) -> DataFrame:
    """Scan a heartbeat table, optionally one date of it."""
    reader = spark.read.format(fmt)
    if fmt not in TABLE_FORMATS:
        reader = reader.schema(schema)
    return filter_date(reader.load(input_path), date_partition)


def read_for_metrics(
    spark: SparkSession, input_path: str, date_partition: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The same scan reading only the leaves the session metrics use."""
    return read_telemetry(spark, input_path, date_partition, fmt, HEARTBEAT_NARROW)


def fitted(declared: T.DataType, actual: T.DataType | None) -> T.DataType:
    """The declared type where a scan of the actual one gives it, else the actual type, leaf by leaf."""
    if isinstance(declared, StructType) and isinstance(actual, StructType):
        known = {f.name: f.dataType for f in actual.fields}
        return StructType([T.StructField(f.name, fitted(f.dataType, known.get(f.name))) for f in declared.fields])
    if isinstance(declared, T.MapType) and isinstance(actual, T.MapType):
        return T.MapType(T.StringType(), fitted(declared.valueType, actual.valueType))
    widens = (
        isinstance(declared, T.LongType) and isinstance(actual, (T.ByteType, T.ShortType, T.IntegerType))
        or isinstance(declared, T.DoubleType) and isinstance(actual, T.FloatType)
    )
    return declared if actual is None or widens else actual


def _loses(declared: T.DataType, found: T.DataType) -> bool:
    """Whether a cast could lose or refuse values: then the rows are checked one by one."""
    if isinstance(declared, StructType) and isinstance(found, StructType):
        return any(_loses(d.dataType, f.dataType) for d, f in zip(declared.fields, found.fields))
    if isinstance(declared, T.MapType) and isinstance(found, T.MapType):
        return _loses(declared.valueType, found.valueType)
    whole = isinstance(declared, T.DoubleType) and isinstance(found, T.IntegralType)
    return not (found == declared or whole or isinstance(declared, T.StringType))


def _scan(
    spark: SparkSession, input_path: str, date_partition: str | list[str] | None, fmt: str, schema: StructType | None
) -> DataFrame:
    base = input_path.rstrip("/")
    wanted = date_partition if date_partition is not None else "*"
    paths = [f"{base}/{PARTITION}={d}" for d in (wanted if isinstance(wanted, list) else [wanted])]
    reader = spark.read.format(fmt).option("basePath", base)
    try:
        return (reader if schema is None else reader.schema(schema)).load(paths)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            raise FileNotFoundError(f"no {PARTITION}={wanted} below {base}") from error
        raise


def load_checked(
    spark: SparkSession,
    input_path: str,
    date_partition: str | list[str] | None = None,
    fmt: str = "parquet",
    schema: StructType = HEARTBEAT,
) -> tuple[DataFrame, DataFrame | None]:
    """Scan the ``eventDate=`` directories in the files' own types: (heartbeats, rows set aside or None).

    A list names directories, of which nothing but themselves is listed.

    Counters may be 32 or 64 bits wide, whole or real, or text. Where every value of the files' types fits,
    nothing is checked; else rows with a value that does not fit are set aside with the fields' names. The
    types are those of one file: the files of a run must agree, but for integers that widen. FileNotFoundError
    where the path or the date is missing.
    """
    actual = _scan(spark, input_path, date_partition, fmt, None).schema
    found = fitted(schema, actual)
    rows = _scan(spark, input_path, date_partition, fmt, found)
    rows = rows if isinstance(date_partition, list) else filter_date(rows, date_partition)
    if found == schema:
        return rows, None
    if not _loses(schema, found):
        return rows.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in schema.fields]), None
    text = rows.selectExpr(*[f"cast({f.name} as {as_text(f.dataType).simpleString()}) as {f.name}" for f in schema.fields])
    return split_malformed(text, schema)


def load_snapshots(
    spark: SparkSession,
    input_path: str,
    date_partition: str | None = None,
    fmt: str = "parquet",
    schema: StructType = HEARTBEAT,
) -> DataFrame:
    """The heartbeats of ``load_checked`` alone; with a date only that directory is listed, not the whole table."""
    return load_checked(spark, input_path, date_partition, fmt, schema)[0]


def with_source_file(df: DataFrame) -> DataFrame:
    """Adds the file each row came from."""
    return df.withColumn("source_file", F.input_file_name())


def stream_telemetry(
    spark: SparkSession,
    input_path: str,
    fmt: str = "parquet",
    schema: StructType = HEARTBEAT_NARROW,
    **options: str,
) -> DataFrame:
    """Streaming scan of a growing heartbeat table."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt in TABLE_FORMATS:
        reader = reader.option("ignoreChanges", "true")
    else:
        reader = reader.schema(schema)
    return reader.load(input_path)
