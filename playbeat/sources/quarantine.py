"""Type coercion of loosely typed heartbeats, with a quarantine for rows that do not fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from playbeat.functions import scalars as S
from playbeat.schema import HEARTBEAT


def _coerce_leaf(x: str, kind: T.DataType) -> str:
    if isinstance(kind, T.LongType):
        return S.strict_long(x)
    if isinstance(kind, T.IntegerType):
        return f"try_cast({S.strict_long(x)} as int)"
    return x if isinstance(kind, T.StringType) else f"try_cast({x} as {kind.simpleString()})"


def _coerce(x: str, kind: T.DataType) -> str:
    """The value in its declared type, null where text does not fit; null structs stay null."""
    if isinstance(kind, T.StructType):
        inner = ", ".join(f"{_coerce(f'{x}.{f.name}', f.dataType)} as {f.name}" for f in kind.fields)
        return f"if({x} is null, null, struct({inner}))"
    if isinstance(kind, T.MapType):
        return f"transform_values({x}, (k, v) -> {_coerce('v', kind.valueType)})"
    return _coerce_leaf(x, kind)


def _bad(x: str, kind: T.DataType) -> str:
    """True where some leaf holds text that its type cannot take."""
    if isinstance(kind, T.StructType):
        return "(" + " or ".join(_bad(f"{x}.{f.name}", f.dataType) for f in kind.fields) + ")"
    if isinstance(kind, T.MapType):
        return f"coalesce(exists(map_values({x}), v -> {_bad('v', kind.valueType)}), false)"
    if isinstance(kind, T.StringType):
        return "false"
    return f"({x} is not null and {_coerce_leaf(x, kind)} is null)"


def _leaf_paths(path: str, kind: T.DataType) -> list[tuple[str, T.DataType]]:
    if isinstance(kind, T.StructType):
        return [leaf for f in kind.fields for leaf in _leaf_paths(f"{path}.{f.name}", f.dataType)]
    return [(path, kind)]


def malformed_fields(schema: T.StructType = HEARTBEAT) -> str:
    """Names of the fields of a text-leaf heartbeat that do not fit the heartbeat schema."""
    leaves = [leaf for f in schema.fields for leaf in _leaf_paths(f.name, f.dataType)]
    checks = [
        f"if({_bad(path, kind)}, '{path}', null)" for path, kind in leaves if not isinstance(kind, T.StringType)
    ]
    return f"array_compact(array({', '.join(checks)}))"


def coerce_types(text: DataFrame, schema: T.StructType = HEARTBEAT) -> DataFrame:
    """Heartbeats with text leaves to the typed schema; text that does not fit becomes null."""
    return text.selectExpr(*[f"{_coerce(f.name, f.dataType)} as {f.name}" for f in schema.fields])


def split_malformed(text: DataFrame, schema: T.StructType = HEARTBEAT) -> tuple[DataFrame, DataFrame]:
    """(valid typed heartbeats, quarantined text rows with ``reasons``)."""
    checked = text.selectExpr("*", f"{malformed_fields(schema)} as reasons")
    return coerce_types(checked.filter("size(reasons) = 0"), schema), checked.filter("size(reasons) > 0")


# A clock beyond these years would file the heartbeat under a date it cannot have.
CLOCKS = {
    f"timestampInfo.{clock} out of range": f"not coalesce(timestampInfo.{clock} between 0 and {S.MAX_MS}, true)"
    for clock in ("server", "agent")
}
CLOCKS["no date"] = "eventDate is null and timestampInfo.server is null"


def split_clocks(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(heartbeats with usable clocks, the others with ``reasons``): years 1970 to 9999, and a date or a server time."""
    checks = ", ".join(f"if({broken}, '{name}', null)" for name, broken in CLOCKS.items())
    checked = df.selectExpr("*", f"array_compact(array({checks})) as reasons")
    return checked.filter("size(reasons) = 0").drop("reasons"), checked.filter("size(reasons) > 0")


def as_quarantine(bad: DataFrame) -> DataFrame:
    """Set-aside rows in one form, whatever their types: the row as JSON and the reasons."""
    columns = ", ".join(f"`{c}`" for c in bad.columns if c != "reasons")
    return bad.selectExpr(f"to_json(struct({columns})) as row", "reasons")
