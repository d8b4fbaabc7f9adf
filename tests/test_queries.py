"""Every query of the catalogue against DuckDB on the smallest tables."""

import datetime as dt
import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from lakeweave import catalogue
from lakeweave.operators import relational

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def cell(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    order = sorted(df.columns)
    got = sorted((tuple(cell(r[c]) for c in order) for r in df.collect()), key=key)
    want = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == order
    place = [names.index(c) for c in order]
    assert got == sorted((tuple(cell(r[i]) for i in place) for r in want.fetchall()), key=key)


def test_csv_source_loads_all_orders(spark, duck):
    loaded = spark.read.parquet(*catalogue.queries()["csv_source"](spark, SF).inputFiles())
    assert sorted(map(tuple, loaded.select("o_orderkey", "o_custkey").collect())) == sorted(duck.execute("SELECT o_orderkey, o_custkey FROM orders").fetchall())


def test_frames_equal_the_sql_on_awkward_rows(spark):
    """Nulls, ties, times a day apart to the microsecond, pieces of time with fewer rows than the frame, and none between."""
    t = dt.datetime(2024, 1, 1)
    at = [t + dt.timedelta(hours=5 * i, microseconds=i % 3) for i in range(40)] + [t + dt.timedelta(days=i) for i in (0, 1, 1, 2, 9)] + [t + dt.timedelta(days=2, microseconds=1)]
    at += [t + dt.timedelta(minutes=i // 2) for i in range(90)] + [None] * 6
    rows = [(i, x, [None, "a", "b"][i % 3], None if i % 7 == 0 else i / 4) for i, x in enumerate(at)] + [(None, t, "a", 1.0), (5000, t, "alone", 2.0), (5001, None, "alone", None)]
    e = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double").repartition(5)
    c = duckdb.connect()
    c.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, event_type VARCHAR, value DOUBLE)")
    c.executemany("INSERT INTO events VALUES (?, ?, ?, ?)", rows)
    got = relational.last_rows(relational.count_within(e, ["event_type"], "ts", "INTERVAL '1' DAY", "n"), ["event_type"], "ts", "event_id", 3, F.sum("value"), "s")
    want = c.execute(catalogue.oracle_sql()["dataset_window_frame"]).fetchall()
    assert sorted(map(tuple, got.select("event_id", F.round("s", 6), "n").collect()), key=key) == sorted(want, key=key)
    assert relational.last_rows(relational.count_within(e.limit(0), ["event_type"], "ts", "INTERVAL '1' DAY", "n"), ["event_type"], "ts", "event_id", 3, F.sum("value"), "s").collect() == []


def test_window_frame_does_not_make_tasks_of_whole_partitions(spark):
    spark.read.parquet(f"{SF}/events.parquet").createOrReplaceTempView("events")
    one, other = (df._jdf.queryExecution().optimizedPlan().toString() for df in (spark.sql(catalogue.oracle_sql()["dataset_window_frame"]), catalogue.queries()["dataset_window_frame"](spark, SF)))
    spark.catalog.dropTempView("events")
    assert "windowspecdefinition(event_type" in one and "RangeFrame" in one
    assert "windowspecdefinition(event_type" not in other and "RangeFrame" not in other
