"""Which partition folders a query needs, read off its optimised plan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock

Terms = list[tuple[str, str, Column]]
_OPS = {"EqualTo": "=", "LessThan": "<", "LessThanOrEqual": "<=", "GreaterThan": ">", "GreaterThanOrEqual": ">="}
_FLIPPED = {"=": "=", "<": ">", "<=": ">=", ">": "<", ">=": "<="}


def _seq(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _constant(literal) -> Column | None:
    """A plan's literal as a column; None for null and for types that don't partition."""
    value, kind = literal.value(), literal.dataType().typeName()
    if value is None:
        return None
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(int(value)))
    if kind == "timestamp_ntz":
        return clock.wall_clock(F.lit(int(value)))
    if kind == "date":
        return F.date_from_unix_date(F.lit(int(value)))
    if kind in ("integer", "long", "short", "byte"):
        return F.lit(int(value))
    if kind in ("float", "double"):
        return F.lit(float(value))
    if kind == "string":
        return F.lit(value.toString())
    if kind.startswith("decimal"):
        return F.lit(value.toString()).cast(kind)
    return None


def _terms(condition, own: set[int]) -> Terms:
    """Comparisons of the relation's columns with constants that all must hold."""
    kind = _kind(condition)
    if kind == "And":
        return _terms(condition.left(), own) + _terms(condition.right(), own)
    if kind not in _OPS:
        return []
    left, right, op = condition.left(), condition.right(), _OPS[kind]
    if _kind(left) == "Literal":
        left, right, op = right, left, _FLIPPED[op]
    if _kind(left) != "AttributeReference" or _kind(right) != "Literal" or left.exprId().id() not in own:
        return []
    value = _constant(right)
    return [] if value is None else [(left.name(), op, value)]


def pushed_terms(df: DataFrame, roots: Mapping[str, str]) -> dict[str, list[Terms]]:
    """For each table (folder of its data -> name) a list of terms for each place in the plan that reads it.

    Only filters that stand over a scan, with nothing but projections between, count; a scan without any has an empty list.
    """
    out: dict[str, list[Terms]] = {}

    def walk(node, conditions: list) -> None:
        kind = _kind(node)
        if kind == "LogicalRelation" and _kind(node.relation()) == "HadoopFsRelation":
            paths = [p.toString() for p in _seq(node.relation().location().rootPaths())]
            own = {a.exprId().id() for a in _seq(node.output())}
            for root, name in roots.items():
                if any(p.startswith(root + "/") for p in paths):
                    out.setdefault(name, []).append([t for c in conditions for t in _terms(c, own)])
        passed = [*conditions, node.condition()] if kind == "Filter" else conditions if kind == "Project" else []
        for child in _seq(node.children()):
            walk(child, passed)
        for plan in _seq(node.subqueries()):
            walk(plan, [])

    walk(df._jdf.queryExecution().optimizedPlan(), [])
    return out
