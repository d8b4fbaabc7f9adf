"""Partition transforms: hints, checks, specs, and the columns that rows are laid out by."""

from __future__ import annotations

import datetime as dt
import logging
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ValidationError
from ..functions import clock
from ..functions.murmur3 import murmur3

log = logging.getLogger("lakeweave")
TEMPORAL, SIZED = ("year", "month", "day", "hour"), ("bucket", "truncate")
TRANSFORMS = ("identity", *TEMPORAL, *SIZED)
FIRST_FIELD_ID = 1000
#: Prefix of partition folders, so that they never clash with a table's columns.
FOLDER = "__p_"
_TIMES = (T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Transform:
    column: str
    kind: str
    param: int | None = None
    name: str | None = None

    def hint(self) -> str:
        return f"{self.kind}[{self.param}]" if self.param is not None else self.kind

    @property
    def field(self) -> str:
        return self.name or f"{self.column}_{self.kind}" + (f"_{self.param}" if self.param is not None else "")


@dataclass(frozen=True)
class PartitionField:
    field_id: int
    transform: Transform

    @property
    def folder(self) -> str:
        return FOLDER + self.transform.field


def identity(column: str, name: str | None = None) -> Transform:
    return Transform(column, "identity", None, name)


def year(column: str, name: str | None = None) -> Transform:
    return Transform(column, "year", None, name)


def month(column: str, name: str | None = None) -> Transform:
    return Transform(column, "month", None, name)


def day(column: str, name: str | None = None) -> Transform:
    return Transform(column, "day", None, name)


def hour(column: str, name: str | None = None) -> Transform:
    return Transform(column, "hour", None, name)


def bucket(count: int, column: str, name: str | None = None) -> Transform:
    if count <= 0:
        raise ValueError("a bucket transform needs a positive number of buckets")
    return Transform(column, "bucket", count, name)


def truncate(width: int, column: str, name: str | None = None) -> Transform:
    if width <= 0:
        raise ValueError("a truncate transform needs a positive width")
    return Transform(column, "truncate", width, name)


def parse_hint(hint: str) -> tuple[str, int | None]:
    """``bucket[16]`` -> ("bucket", 16); ``month`` -> ("month", None)."""
    m = re.fullmatch(r"(\w+)\[(\d+)\]", hint)
    return (m[1], int(m[2])) if m else (hint, None)


def check(t: Transform, kind: T.DataType) -> None:
    said = f"{t.kind} on column {t.column} ({kind.simpleString()})"
    if t.kind not in TRANSFORMS:
        raise ValueError(f"unknown partition transform: {t.kind}")
    if t.kind in TEMPORAL and not isinstance(kind, (*_TIMES, T.DateType)):
        raise ValueError(f"{said}: needs a date or timestamp")
    if t.kind == "hour" and isinstance(kind, T.DateType):
        raise ValueError(f"{said}: a date has no hours")
    if t.kind in SIZED and not (t.param and t.param > 0):
        raise ValueError(f"{said}: needs a positive parameter, as in {t.kind}[16]")
    if t.kind == "bucket" and isinstance(kind, (T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
        raise ValueError(f"{said}: such values have no bucket")
    if t.kind == "truncate" and not isinstance(kind, (T.StringType, T.IntegerType, T.LongType, T.DecimalType, T.BinaryType)):
        raise ValueError(f"{said}: can't be truncated")


def default_transform(column: str, kind: T.DataType) -> Transform:
    """What a partition column without a transform gets: months of dates and timestamps, else the value itself."""
    if isinstance(kind, (*_TIMES, T.DateType)):
        return month(column)
    if not isinstance(kind, (T.StringType, T.IntegerType, T.LongType)):
        log.warning("column %s of type %s is partitioned by its values", column, kind.simpleString())
    return identity(column)


def build_spec(columns: Mapping[str, Mapping], schema: T.StructType) -> list[PartitionField]:
    """The spec that column hints ask for: ``partition`` or ``x-partition`` (true, or a transform), a ``partition_transform``
    beside it, and ``partition_name``. Columns that the schema lacks are left out with a warning."""
    fields: list[PartitionField] = []
    for name, hints in columns.items():
        flag = hints.get("partition") or hints.get("x-partition")
        if not flag:
            continue
        if name not in schema.names:
            log.warning("partition column %s isn't in the schema", name)
            continue
        kind = schema[name].dataType
        hint = hints.get("partition_transform") or hints.get("x-partition-transform") or (flag if isinstance(flag, str) else None)
        given = hints.get("partition_name") or hints.get("x-partition-name")
        if hint:
            t = Transform(name, *parse_hint(hint), given)
        else:
            d = default_transform(name, kind)
            t = Transform(name, d.kind, d.param, given)
        check(t, kind)
        fields.append(PartitionField(FIRST_FIELD_ID + len(fields), t))
    names = [f.transform.field for f in fields]
    if len(set(names)) < len(names):
        raise ValidationError(f"partition fields share a name: {', '.join(sorted(n for n in set(names) if names.count(n) > 1))}")
    return fields


def hints_for(partition: str | Transform | Sequence[str | Transform] | None) -> dict[str, dict]:
    """Column hints for what ``with_partitioning`` is given: names and transforms. An identity is said so, which keeps a date
    column from falling back to months."""
    if partition is None:
        return {}
    many = [partition] if isinstance(partition, (str, Transform)) else list(partition)
    out: dict[str, dict] = {}
    for p in many:
        if isinstance(p, str):
            out[p] = {"partition": True}
        elif isinstance(p, Transform):
            out[p.column] = {"partition": True, "partition_transform": p.hint()} | ({"partition_name": p.name} if p.name else {})
        else:
            raise ValueError(f"a partition is a column name or a transform, not {type(p).__name__}")
    return out


def value_of(t: Transform, kind: T.DataType, column: Column | None = None) -> Column:
    """The partition value of a row; null for null. The session's time zone has no say: zoned times are taken in UTC."""
    c = F.col(f"`{t.column}`") if column is None else column
    if t.kind == "identity":
        return F.unix_micros(c) if isinstance(kind, T.TimestampType) else c  # as text it would be local time
    if t.kind == "hour":
        return clock.floor_div(clock.micros(c, kind), clock.HOUR).cast("int")
    if t.kind in TEMPORAL:
        days = clock.floor_div(F.unix_micros(c), clock.DAY).cast("int") if isinstance(kind, T.TimestampType) else F.unix_date(c.cast("date"))
        if t.kind == "day":
            return days
        date = F.date_from_unix_date(days)
        return F.year(date) - 1970 if t.kind == "year" else (F.year(date) - 1970) * 12 + F.month(date) - 1
    if t.kind == "bucket":
        return F.pmod(murmur3(c, kind).bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(t.param)).cast("int")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.substring(c, 1, t.param)
    if isinstance(kind, T.DecimalType):
        width = F.lit(Decimal(t.param).scaleb(-kind.scale)).cast(kind)
        return (c - F.pmod(c, width)).cast(kind)
    return (c - F.pmod(c, F.lit(t.param).cast(kind))).cast(kind)


def value_type(t: Transform, kind: T.DataType) -> T.DataType:
    if t.kind == "identity" and isinstance(kind, T.TimestampType):
        return T.LongType()
    return kind if t.kind in ("identity", "truncate") else T.IntegerType()


def literal(value, kind: T.DataType) -> Column:
    """A Python value (or a constant column) as a column's type. Times without a zone are UTC where the column has a zone, and times
    with a zone their UTC wall clock where it has none."""
    if isinstance(value, Column):
        return value.cast(kind)
    if isinstance(value, dt.datetime) and isinstance(kind, _TIMES):
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value
        wall = F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
        return clock.cast(wall, T.TimestampNTZType(), kind)
    return F.lit(value).cast(kind)


def with_values(df: DataFrame, spec: Iterable[PartitionField]) -> DataFrame:
    return df.withColumns({f.folder: value_of(f.transform, df.schema[f.transform.column].dataType) for f in spec})


def prune(t: Transform, kind: T.DataType, op: str, value) -> Column | None:
    """What a comparison of a column with a literal says about its partition value; None if nothing. Transforms but bucket keep
    order, so bounds carry over, with equality where a partition may straddle them."""
    if value is None:
        return None
    folder, bound = F.col(f"`{FOLDER}{t.field}`"), value_of(t, kind, literal(value, kind))
    exact = t.kind == "identity"
    if op == "=":
        out = folder == bound
    elif t.kind == "bucket":
        return None
    elif op in ("<", "<="):
        out = folder < bound if exact and op == "<" else folder <= bound
    elif op in (">", ">="):
        out = folder > bound if exact and op == ">" else folder >= bound
    else:
        return None
    # an empty text is written to the folder of nulls
    return out | folder.isNull() if isinstance(kind, (T.StringType, T.BinaryType)) and t.kind != "bucket" else out
