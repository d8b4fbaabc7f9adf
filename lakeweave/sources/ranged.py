"""Sources that are asked for one span of dates at a time, such as web services with a limit of rows for each answer."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Span = tuple[dt.date, dt.date]


class TooMuch(Exception):
    """Raised by a fetcher for a span that the service won't answer as a whole."""


def months(start: dt.date, end: dt.date) -> list[Span]:
    """Spans [a, b) that cut [start, end) at the firsts of months."""
    out, a = [], start
    while a < end:
        b = min(end, (a.replace(day=1) + dt.timedelta(days=32)).replace(day=1))
        out.append((a, b))
        a = b
    return out


def fetch_span(fetch: Callable[[dt.date, dt.date], Sequence[dict[str, Any]]], span: Span, attempts: int = 3, pause: float = 1.0, days: int = 7) -> Iterator[dict[str, Any]]:
    """The rows of a span; failures are tried again, and a span that is too much is cut into pieces of ``days``, then of a day."""
    a, b = span
    for attempt in range(1, attempts + 1):
        try:
            yield from list(fetch(a, b))
            return
        except TooMuch:
            step = days if (b - a).days > days else 1
            if (b - a).days <= 1:
                raise
            for i in range(0, (b - a).days, step):
                at = a + dt.timedelta(days=i)
                yield from fetch_span(fetch, (at, min(b, at + dt.timedelta(days=step))), attempts, pause, days)
            return
        except (ConnectionError, TimeoutError):
            if attempt == attempts:
                raise
            time.sleep(pause * 2 ** (attempt - 1))


def read_spans(spark: SparkSession, spans: Sequence[Span], fetch: Callable[[dt.date, dt.date], Sequence[dict[str, Any]]], schema: T.StructType, **how: Any) -> DataFrame:
    """One task for each span; ``fetch`` runs on the executors and gives rows as dicts, whose missing fields are null."""
    names = schema.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in zip(batch["a"], batch["b"], strict=True):
                rows = [[r.get(n) for n in names] for r in fetch_span(fetch, (a, b), **how)]
                yield pd.DataFrame(rows, columns=names, dtype=object)

    asked = spark.createDataFrame(list(spans), "a date, b date").repartition(max(1, len(spans)))
    return asked.mapInPandas(run, schema)
