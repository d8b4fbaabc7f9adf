import datetime as dt

import pytest
from pyspark.sql import types as T

from lakeweave.sources.ranged import TooMuch, fetch_span, months, read_spans


def test_months():
    assert months(dt.date(2024, 1, 15), dt.date(2024, 3, 2)) == [(dt.date(2024, 1, 15), dt.date(2024, 2, 1)), (dt.date(2024, 2, 1), dt.date(2024, 3, 1)), (dt.date(2024, 3, 1), dt.date(2024, 3, 2))]


def days(a, b):
    return [{"day": a + dt.timedelta(days=i), "n": i} for i in range((b - a).days)]


def test_retries_and_splits():
    asked = []

    def fetch(a, b):
        asked.append((b - a).days)
        if len(asked) == 1:
            raise ConnectionError
        if (b - a).days > 7:
            raise TooMuch
        return days(a, b)

    got = list(fetch_span(fetch, (dt.date(2024, 1, 1), dt.date(2024, 2, 1)), pause=0))
    assert [r["day"].day for r in got] == list(range(1, 32)) and asked[:3] == [31, 31, 7]
    with pytest.raises(ConnectionError):
        list(fetch_span(lambda a, b: (_ for _ in ()).throw(ConnectionError()), (dt.date(2024, 1, 1), dt.date(2024, 1, 2)), pause=0))


def test_tasks_fetch(spark):
    def fetch(a, b):
        return [{"day": a, "n": (b - a).days}]

    schema = T.StructType.fromDDL("day date, n long, missing string")
    got = read_spans(spark, months(dt.date(2024, 1, 1), dt.date(2024, 4, 1)), fetch, schema).orderBy("day").collect()
    assert [(r.day.month, r.n, r.missing) for r in got] == [(1, 31, None), (2, 29, None), (3, 31, None)]
