"""Checked casts of a batch to a table's schema."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import CastingError
from .functions import clock

log = logging.getLogger("lakeweave")
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_INT, _FLOAT, _TEXT, _TIME = tuple(_BITS), (T.FloatType, T.DoubleType), (T.StringType, T.BinaryType), (T.TimestampType, T.TimestampNTZType)


@dataclass
class CastReport:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    missing_required: list[str] = field(default_factory=list)

    @property
    def safe(self) -> bool:
        return not self.errors and not self.missing_required


def compatible(a: T.DataType, b: T.DataType) -> bool:
    """Whether a cast exists at all; whether it may lose something is checked apart."""
    if a == b:
        return True
    pairs = ((_INT, _INT), (_FLOAT, _FLOAT), (_INT, _FLOAT), (_FLOAT, _INT), (_TIME, _TIME), (_TEXT, _TEXT), (T.DecimalType, T.DecimalType), (T.StringType, (*_INT, *_FLOAT)))
    if any(isinstance(a, x) and isinstance(b, y) for x, y in pairs):
        return True
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return compatible(a.elementType, b.elementType)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return compatible(a.keyType, b.keyType) and compatible(a.valueType, b.valueType)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        have = {f.name: f for f in a}
        return all(compatible(have[f.name].dataType, f.dataType) if f.name in have else f.nullable for f in b)
    return False


def _judge(name: str, a: T.DataType, b: T.DataType, report: CastReport) -> None:
    say = f"{name}: {a.simpleString()} to {b.simpleString()}"
    if a == b:
        return
    if not compatible(a, b):
        report.errors.append(f"{say}: there is no such cast")
    elif isinstance(a, _FLOAT) and isinstance(b, _INT):
        report.errors.append(f"{say}: fractions would be lost")
    elif isinstance(a, _INT) and isinstance(b, _INT) and _BITS[type(b)] < _BITS[type(a)]:
        report.errors.append(f"{say}: values may not fit")
    elif isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType) and (b.precision < a.precision or b.scale < a.scale or b.precision - b.scale < a.precision - a.scale):
        report.errors.append(f"{say}: digits may be lost")
    elif isinstance(a, T.DoubleType) and isinstance(b, T.FloatType):
        report.warnings.append(f"{say}: precision is lost")
    elif isinstance(a, T.TimestampNTZType) and isinstance(b, T.TimestampType):
        report.warnings.append(f"{say}: read as UTC")
    elif isinstance(a, T.TimestampType) and isinstance(b, T.TimestampNTZType):
        report.errors.append(f"{say}: the time zone would be lost")
    elif isinstance(a, T.BinaryType) and isinstance(b, T.StringType):
        report.warnings.append(f"{say}: bytes must be UTF-8")
    elif isinstance(a, T.StringType) and not isinstance(b, _TEXT):
        report.errors.append(f"{say}: values may not parse")


def validate(source: T.StructType, target: T.StructType) -> CastReport:
    report = CastReport()
    have, want = {f.name: f for f in source}, {f.name: f for f in target}
    report.errors += [f"{n}: not in the table" for n in have if n not in want]
    for n, f in want.items():
        if n in have:
            _judge(n, have[n].dataType, f.dataType, report)
        elif f.nullable:
            report.warnings.append(f"{n}: absent, filled with nulls")
        else:
            report.missing_required.append(n)
    return report


def _fail(name: str, what: str) -> Column:
    return F.raise_error(F.lit(f"LAKEWEAVE_CAST:{name}: {what}"))


def checked_cast(value: Column, a: T.DataType, b: T.DataType, name: str) -> Column:
    """A cast that fails, instead of changing a value, where Spark's own would truncate or round."""
    if a == b:
        return value
    out = clock.cast(value, a, b)  # times through UTC, whatever the session's zone
    if isinstance(a, _FLOAT) and isinstance(b, _INT):
        top = F.lit(float(2 ** (_BITS[type(b)] - 1)))
        fits = (value >= -top) & (value < top) & (F.floor(value) == value)
        return F.when(value.isNull() | fits, F.when(fits, value).cast(b)).otherwise(_fail(name, "a fraction or too large").cast(b))
    if isinstance(a, _INT) and isinstance(b, _FLOAT):
        bits = 53 if isinstance(b, T.DoubleType) else 24
        if _BITS[type(a)] > bits:
            return F.when(value.isNull() | ((value <= 2**bits) & (value >= -(2**bits))), out).otherwise(_fail(name, "not exact as a float").cast(b))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType) and b.scale < a.scale:
        return F.when(value.isNull() | (out.cast(a) == value), out).otherwise(_fail(name, "digits would be lost").cast(b))
    if isinstance(a, T.StringType) and isinstance(b, (*_INT, *_FLOAT)):
        return F.when(value.isNull() | value.try_cast(b).isNotNull(), value.try_cast(b)).otherwise(_fail(name, "not a number").cast(b))
    if isinstance(a, T.BinaryType) and isinstance(b, T.StringType):
        return F.when(value.isNull() | F.is_valid_utf8(out), out).otherwise(_fail(name, "not UTF-8"))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return F.transform(value, lambda x: checked_cast(x, a.elementType, b.elementType, name)).cast(b)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        have = {f.name: f for f in a}
        made = F.struct(*[(checked_cast(value[f.name], have[f.name].dataType, f.dataType, f"{name}.{f.name}") if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in b])
        return F.when(value.isNotNull(), made)
    return out


def cast_frame(df: DataFrame, target: T.StructType, strict: bool = True) -> DataFrame:
    """``df`` with the target's columns in its order: absent ones null, source-only ones left out, others cast and checked.

    Required columns that are absent always fail, as do values that a cast would change. ``strict`` also fails for every
    doubtful cast, before a job runs.
    """
    report = validate(df.schema, target)
    if report.missing_required:
        raise CastingError(f"required columns are missing: {', '.join(report.missing_required)}")
    if strict and report.errors:
        raise CastingError("; ".join(report.errors))
    have = {f.name: f.dataType for f in df.schema}
    hopeless = [n for n in target.names if n in have and not compatible(have[n], target[n].dataType)]
    if hopeless:
        raise CastingError("; ".join(f"{n}: {have[n].simpleString()} to {target[n].dataType.simpleString()}: there is no such cast" for n in hopeless))
    for w in report.warnings + report.errors:
        log.warning("%s", w)
    quoted = lambda n: F.col(f"`{n.replace('`', '``')}`")
    return df.select(*[(checked_cast(quoted(f.name), have[f.name], f.dataType, f.name) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in target])


def require(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fails the job where a required column is null; Parquet itself doesn't keep NOT NULL."""
    for f in schema:
        if not f.nullable:
            df = df.withColumn(f.name, F.coalesce(F.col(f"`{f.name}`"), F.raise_error(F.lit(f"LAKEWEAVE_REQUIRED:{f.name}: null in a required column")).cast(f.dataType)))
    return df
