"""Safe changes of a table's schema by an incoming one. Pure functions on StructType."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .errors import SchemaEvolutionError
from .types import comment


@dataclass(frozen=True)
class Changes:
    added: list[T.StructField] = field(default_factory=list)
    promoted: list[tuple[str, T.DataType, T.DataType]] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)
    docs: dict[str, str] = field(default_factory=dict)


def can_promote(old: T.DataType, new: T.DataType) -> bool:
    """Whether all old values fit the new type: equal types, int to long, float to double, decimals with no fewer digits
    before and after the point, and structs that only gain nullable fields."""
    if old == new:
        return True
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        later = {f.name: f for f in new}
        if any(f.name not in later for f in old):
            return False
        known = set(old.names)
        return all(can_promote(f.dataType, later[f.name].dataType) for f in old) and all(f.nullable for f in new if f.name not in known)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return can_promote(old.elementType, new.elementType)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return can_promote(old.keyType, new.keyType) and can_promote(old.valueType, new.valueType)
    wider = {T.IntegerType: T.LongType, T.FloatType: T.DoubleType}
    return isinstance(new, wider.get(type(old), ()))


def compare(old: T.StructType, new: T.StructType) -> Changes:
    have, come = {f.name: f for f in old}, {f.name: f for f in new}
    both = [n for n in come if n in have]
    return Changes(
        added=[f for f in new if f.name not in have],
        promoted=[(n, have[n].dataType, come[n].dataType) for n in both if _plain(have[n].dataType) != _plain(come[n].dataType)],
        dropped=[n for n in have if n not in come],
        docs={n: comment(come[n]) for n in both if comment(come[n]) and comment(come[n]) != comment(have[n])},
    )


def _plain(kind: T.DataType) -> str:
    return kind.simpleString()


def narrowed(old: T.DataType, new: T.DataType) -> bool:
    return can_promote(new, old)


def check(changes: Changes, old: T.StructType, allow_drops: bool = False, allow_upcast: bool = False, empty: bool = False) -> None:
    """Raises SchemaEvolutionError with everything that is unsafe. Missing required columns come first; missing ones that
    may be null are filled with nulls and never dropped, unless ``allow_drops``."""
    required = {f.name for f in old if not f.nullable}
    missing = [n for n in changes.dropped if n in required]
    if missing and not allow_drops:
        raise SchemaEvolutionError(f"required columns are missing: {', '.join(missing)}")
    wrong = [f"{n}: {a.simpleString()} to {b.simpleString()}" for n, a, b in changes.promoted if not can_promote(a, b) and not (allow_upcast and narrowed(a, b))]
    wrong += [f"{f.name}: a new column can't be required in a table with rows" for f in changes.added if not f.nullable and not empty]
    if wrong:
        raise SchemaEvolutionError("unsafe schema changes: " + "; ".join(wrong))


def _merged(old: T.DataType, new: T.DataType) -> T.DataType:
    """The wider of two types that can be promoted to one another."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        later = {f.name: f for f in new}
        return T.StructType([T.StructField(f.name, _merged(f.dataType, later[f.name].dataType), f.nullable, f.metadata) for f in old] + [f for f in new if f.name not in set(old.names)])
    return new if can_promote(old, new) else old


def apply(old: T.StructType, changes: Changes, allow_drops: bool = False) -> T.StructType:
    to = {n: b for n, _, b in changes.promoted}
    gone = set(changes.dropped) if allow_drops else set()
    fields = []
    for f in old:
        if f.name not in gone:
            meta = dict(f.metadata or {}) | ({"comment": changes.docs[f.name]} if f.name in changes.docs else {})
            fields.append(T.StructField(f.name, _merged(f.dataType, to[f.name]) if f.name in to else f.dataType, f.nullable, meta))
    return T.StructType(fields + list(changes.added))


def evolve(old: T.StructType, new: T.StructType, allow_drops: bool = False, allow_upcast: bool = False, empty: bool = False) -> tuple[T.StructType, bool]:
    """(the table's new schema, whether it changed)."""
    changes = compare(old, new)
    check(changes, old, allow_drops, allow_upcast, empty)
    out = apply(old, changes, allow_drops)
    return out, out != old or any(comment(a) != comment(b) for a, b in zip(out, old, strict=False))
