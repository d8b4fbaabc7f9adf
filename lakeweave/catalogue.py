"""Queries of the engine and their SQL twins (DuckDB's dialect, on the same Parquet tables).

Those that load go through a warehouse in a scratch folder and return what a scan of the loaded table gives.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import casting
from .functions import clock
from .operators.relational import asof_join, count_within, groups_frame, last_rows, qualify
from .plans import partitioning as p
from .spec import Config, TableSpec, with_partitioning
from .streaming.sink import load_batch, write_stream
from .warehouse import LoadPackage, Warehouse

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        name = f.__name__.rstrip("_")
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return keep


def plain(name: str, spark_sql: str, duck_sql: str | None = None) -> None:
    """A query over loaded tables, through the read path; the same text for both engines unless two are given."""
    tables = [t for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events") if t in spark_sql]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return loaded(spark, sf, tables).dataset().query(spark_sql).frame

    _QUERIES[name], _SQL[name] = run, duck_sql or spark_sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share; a temporary one in a local session without ``spark.checkpoint.dir``."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lakeweave-")
    return f"{root.rstrip('/')}/warehouse-{uuid.uuid4().hex}"


_LOADED: dict[tuple[str, str], Warehouse] = {}


def loaded(spark: SparkSession, sf: str, tables: list[str]) -> Warehouse:
    """A warehouse for each application and folder, into which a table is loaded when it is first asked for."""
    key = (spark.sparkContext.applicationId, sf)
    w = _LOADED[key] = _LOADED.get(key) or warehouse(spark)
    for t in tables:
        if not w.table(t).exists():
            w.load_files(TableSpec(t), f"{sf}/{t}.parquet", "first")
    return w


def warehouse(spark: SparkSession, **options) -> Warehouse:
    w = Warehouse(spark, Config(scratch(spark), **options))
    w.initialize_storage()
    return w


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark)
    for t in ("customer", "orders"):
        w.load_files(TableSpec(t), f"{sf_dir}/{t}.parquet", "first")
    return w.dataset().query("SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment").frame


query("SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment")(flagship)

# loads


@query("SELECT * FROM orders")
def append_two_batches(spark, sf):
    w, o = warehouse(spark), read(spark, sf, "orders")
    for i in (0, 1):
        w.load(TableSpec("orders"), o.where(F.col("o_orderkey") % 2 == i), f"load{i}")
    return w.table("orders").scan()


@query("SELECT CAST(1 AS BIGINT) AS snapshots, count(*) AS n FROM lineitem")
def multi_file_one_snapshot(spark, sf):
    w, o = warehouse(spark), read(spark, sf, "lineitem")
    w.load(TableSpec("lineitem"), [o.where(F.col("l_orderkey") % 4 == i) for i in range(4)], "load")
    t = w.table("lineitem")
    return t.scan().agg(F.lit(len(t.meta().snapshots)).cast("long").alias("snapshots"), F.count("*").alias("n"))


@query("SELECT CAST(4 AS BIGINT) AS snapshots, 4 * count(*) AS n FROM nation")
def per_file_commits(spark, sf):
    w = warehouse(spark)
    w.load_files(TableSpec("nation"), [f"{sf}/nation.parquet"] * 4, "load", commit_mode="per_file")
    t = w.table("nation")
    return t.scan().agg(F.lit(len(t.meta().snapshots)).cast("long").alias("snapshots"), F.count("*").alias("n"))


@query("SELECT * FROM orders WHERE o_orderkey % 2 = 0")
def replace_full(spark, sf):
    w, o = warehouse(spark), read(spark, sf, "orders")
    w.load(TableSpec("orders"), o, "first")
    w.load(TableSpec("orders", "replace"), o.where("o_orderkey % 2 = 0"), "second")
    return w.table("orders").scan()


def _merge_customers(spark, sf, disposition):
    w, c = warehouse(spark), read(spark, sf, "customer")
    spec = TableSpec("customer", disposition, primary_key="c_custkey")
    w.load(spec, c.where("c_custkey % 3 <> 0"), "first")
    w.load(spec, c.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1), "second")
    return w.table("customer").scan()


_MERGED = """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 <> 0"""


@query(_MERGED)
def merge_upsert_single_key(spark, sf):
    return _merge_customers(spark, sf, {"disposition": "merge", "strategy": "upsert"})


@query(_MERGED)
def merge_string_default_upsert(spark, sf):
    return _merge_customers(spark, sf, "merge")


@query("SELECT event_id, user_id, event_type, CASE WHEN event_id % 5 = 0 THEN -value ELSE value END AS value FROM events")
def merge_delete_insert_composite(spark, sf):
    w, e = warehouse(spark), read(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    spec = TableSpec("events", {"disposition": "merge", "strategy": "delete-insert"}, primary_key=["user_id", "event_id"])
    w.load(spec, e, "first")
    w.load(spec, e.where("event_id % 5 = 0").withColumn("value", -F.col("value")), "second")
    return w.table("events").scan()


@query("SELECT * FROM nation UNION ALL SELECT * FROM nation")
def merge_no_key_appends(spark, sf):
    w, n = warehouse(spark), read(spark, sf, "nation")
    for i in (1, 2):
        w.load(TableSpec("nation", "merge"), n, f"load{i}")
    return w.table("nation").scan()


def _hard(spark, sf, condition, **options):
    w, c = warehouse(spark, **options), read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    spec = TableSpec("customer", "merge", columns={"c_custkey": {"primary_key": True}})
    none = F.lit(None).cast("timestamp_ntz")
    w.load(spec, c.withColumn("_deleted_at", none), "first")
    gone = F.when(F.expr(condition), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    w.load(spec, c.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") * 2).withColumn("_deleted_at", gone), "second")
    return w.table("customer").scan()


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal, CAST(NULL AS TIMESTAMP) AS _deleted_at FROM customer WHERE c_custkey % 4 <> 0")
def hard_delete_mixed(spark, sf):
    return _hard(spark, sf, "c_custkey % 4 = 0")


@query("SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS TIMESTAMP) AS _deleted_at FROM customer WHERE c_custkey % 2 <> 0")
def hard_delete_all(spark, sf):
    return _hard(spark, sf, "true")


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS _deleted_at FROM customer")
def hard_delete_disabled(spark, sf):
    return _hard(spark, sf, "c_custkey % 4 = 0", hard_delete_column=None)


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey >= 5 UNION ALL SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 5 UNION ALL SELECT n_nationkey, 'again' FROM nation WHERE n_nationkey < 5")
def merge_dup_keys_in_batch(spark, sf):
    w, n = warehouse(spark), read(spark, sf, "nation").select("n_nationkey", "n_name")
    spec = TableSpec("nation", "merge", primary_key="n_nationkey")
    w.load(spec, n, "first")
    few = n.where("n_nationkey < 5")
    w.load(spec, few.union(few.withColumn("n_name", F.lit("again"))), "second")
    return w.table("nation").scan()


@query("SELECT CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey END AS k, n_name FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT NULL, 'new'")
def merge_null_keys(spark, sf):
    w, n = warehouse(spark), read(spark, sf, "nation")
    spec = TableSpec("nation", "merge", primary_key="k")
    w.load(spec, n.select(F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey")).alias("k"), "n_name"), "first")
    w.load(spec, spark.range(1).select(F.lit(None).cast("int").alias("k"), F.lit("new").alias("n_name")), "second")
    return w.table("nation").scan()


@query("SELECT r_regionkey, r_name FROM region")
def merge_sequence_isolation(spark, sf):
    w, r = warehouse(spark), read(spark, sf, "region")
    spec = TableSpec("region", "merge", primary_key="r_regionkey")
    gone = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    w.load(spec, r.withColumn("_deleted_at", F.lit(None).cast("timestamp_ntz")), "first")
    w.load(spec, r.withColumn("_deleted_at", gone), "second")  # all go
    w.load(TableSpec("region"), r.withColumn("_deleted_at", F.lit(None).cast("timestamp_ntz")), "third")  # and come again
    return w.table("region").scan(columns=["r_regionkey", "r_name"])


@query(_MERGED)
def compact_then_scan(spark, sf):
    w, c = warehouse(spark), read(spark, sf, "customer")
    spec = TableSpec("customer", "merge", primary_key="c_custkey")
    w.load(spec, c.where("c_custkey % 3 <> 0"), "first")
    w.load(spec, c.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1), "second")
    w.table("customer").compact()
    return w.table("customer").scan()


@query("SELECT * FROM orders WHERE o_orderkey % 2 = 0")
def time_travel(spark, sf):
    w, o = warehouse(spark), read(spark, sf, "orders")
    for i in (0, 1):
        w.load(TableSpec("orders"), o.where(F.col("o_orderkey") % 2 == i), f"load{i}")
    return w.table("orders").scan(version=1)


@query("SELECT * FROM orders WHERE NOT coalesce(o_orderstatus = 'F' AND o_totalprice > 1000, false)")
def predicate_delete(spark, sf):
    w = warehouse(spark)
    w.load(TableSpec("orders"), read(spark, sf, "orders"), "first")
    w.table("orders").delete_where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 1000))
    return w.table("orders").scan()


@query("SELECT CAST(0 AS BIGINT) AS n, CAST(2 AS BIGINT) AS snapshots")
def truncate_keeps_history(spark, sf):
    w = warehouse(spark)
    w.load(TableSpec("region"), read(spark, sf, "region"), "first")
    w.initialize_storage(truncate=["region"])
    t = w.table("region")
    return t.scan().agg(F.count("*").alias("n"), F.lit(len(t.meta().snapshots)).cast("long").alias("snapshots"))


@query("SELECT 'load1' AS load_id, CAST(0 AS BIGINT) AS status, CAST((SELECT count(*) FROM region) AS BIGINT) AS n")
def ledger_idempotent(spark, sf):
    w = warehouse(spark)
    for _ in range(2):
        package = LoadPackage("load1")
        package.add(TableSpec("region"), read(spark, sf, "region"))
        w.complete(package)
    return w.loads().select("load_id", "status", F.lit(w.table("region").scan().count()).cast("long").alias("n"))


@query("SELECT 'region' AS \"table\", CAST(5 AS BIGINT) AS n UNION ALL SELECT 'nation', CAST(25 AS BIGINT)")
def package_many_tables(spark, sf):
    w, package = warehouse(spark), LoadPackage("load1")
    for t in ("region", "nation"):
        package.add(TableSpec(t), read(spark, sf, t))
    w.complete(package)
    counts = [w.table(t).scan().agg(F.lit(t).alias("table"), F.count("*").alias("n")) for t in ("region", "nation")]
    return counts[0].union(counts[1])


@query("SELECT 'h3' AS version_hash, CAST(3 AS BIGINT) AS version")
def newest_version_argmax(spark, sf):
    w = warehouse(spark)
    for i in (1, 3, 2):
        w.store_schema("s", i, f"h{i}", {"tables": i})
    w.store_schema("s", 3, "h3", {"tables": 3})
    found = w.stored_schema("s")
    return spark.createDataFrame([(found["version_hash"], found["version"])], "version_hash string, version long")


@query("SELECT 'b' AS state")
def newest_state_argmax(spark, sf):
    import datetime as dt

    w = warehouse(spark)
    w.store_state("p", "b", 2, created_at=dt.datetime(2024, 2, 1))
    w.store_state("p", "a", 1, created_at=dt.datetime(2024, 1, 1))
    w.store_state("q", "c", 3, created_at=dt.datetime(2024, 3, 1))
    return spark.createDataFrame([(w.stored_state("p")["state"],)], "state string")


@query("SELECT 'nation' AS \"table\", CAST(3 AS BIGINT) AS columns UNION ALL SELECT 'region', CAST(2 AS BIGINT)")
def derived_schema(spark, sf):
    import json

    w = warehouse(spark)
    for t in ("region", "nation"):
        w.load(TableSpec(t), read(spark, sf, t), "first")
    tables = json.loads(w.stored_schema("s")["schema"])["tables"]
    return spark.createDataFrame([(n, len(t["columns"])) for n, t in tables.items()], "table string, columns long")


@query("SELECT * FROM events")
def foreach_batch_events(spark, sf):
    w, root = warehouse(spark), scratch(spark)
    e = read(spark, sf, "events")
    e.repartition(4).write.parquet(f"{root}/in")
    stream = lambda: spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    for checkpoint in ("one", "two"):  # the second query replays the first one's batch ids, which changes nothing
        write_stream(stream(), w, TableSpec("events"), "events", f"{root}/{checkpoint}").awaitTermination()
    return w.table("events").scan()


# evolution and casts


@query("SELECT event_id, event_type, CASE WHEN event_id % 2 = 0 THEN 'new' END AS new_field FROM events")
def evolve_add_column(spark, sf):
    w, e = warehouse(spark), read(spark, sf, "events").select("event_id", "event_type")
    w.load(TableSpec("events"), e.where("event_id % 2 <> 0"), "first")
    w.load(TableSpec("events"), e.where("event_id % 2 = 0").withColumn("new_field", F.lit("new")), "second")
    return w.table("events").scan()


def _evolve(spark, sf, first, second):
    w, o = warehouse(spark), read(spark, sf, "part")
    w.load(TableSpec("t"), o.where("p_partkey % 2 = 0").selectExpr("p_partkey", f"{first} AS x"), "first")
    w.load(TableSpec("t"), o.where("p_partkey % 2 <> 0").selectExpr("p_partkey", f"{second} AS x"), "second")
    return w.table("t").scan()


@query("SELECT p_partkey, CAST(p_size AS BIGINT) AS x FROM part")
def evolve_int_to_long(spark, sf):
    return _evolve(spark, sf, "p_size", "cast(p_size AS bigint)")


@query("SELECT p_partkey, CAST(p_size AS DOUBLE) / 4 AS x FROM part")
def evolve_float_to_double(spark, sf):
    return _evolve(spark, sf, "cast(p_size / 4 AS float)", "cast(p_size AS double) / 4")


@query("SELECT p_partkey, CAST(CAST(p_size AS DECIMAL(12,4)) AS DOUBLE) AS x FROM part")
def evolve_decimal_widen(spark, sf):
    return _evolve(spark, sf, "cast(p_size AS decimal(6,2))", "cast(p_size AS decimal(12,4))").withColumn("x", F.col("x").cast("double"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS event_type, value FROM events")
def sparse_batch_null_fill(spark, sf):
    w, e = warehouse(spark), read(spark, sf, "events").select("event_id", "event_type", "value")
    w.load(TableSpec("events"), e.where("event_id % 2 = 0"), "first")
    w.load(TableSpec("events"), e.where("event_id % 2 <> 0").drop("event_type"), "second")
    return w.table("events").scan()


@query("SELECT * FROM nation")
def column_reorder(spark, sf):
    w, n = warehouse(spark), read(spark, sf, "nation")
    w.load(TableSpec("nation"), n.where("n_nationkey < 9"), "first")
    w.load(TableSpec("nation"), n.where("n_nationkey >= 9").select("n_regionkey", "n_name", "n_nationkey"), "second")
    return w.table("nation").scan()


@query("SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey FROM orders")
def cast_nonstrict_int_narrow(spark, sf):
    return casting.cast_frame(read(spark, sf, "orders").select("o_orderkey"), T.StructType([T.StructField("o_orderkey", T.IntegerType())]), strict=False)


@query("SELECT event_id, epoch_us(ts) AS us FROM events")
def cast_ntz_to_tz(spark, sf):
    target = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType())])
    return casting.cast_frame(read(spark, sf, "events").select("event_id", "ts"), target).select("event_id", F.unix_micros("ts").alias("us"))


@query("SELECT event_id, ts FROM events")
def cast_tz_to_ntz(spark, sf):
    target = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    zoned = clock.cast(F.col("ts"), T.TimestampNTZType(), T.TimestampType()).alias("ts")
    return casting.cast_frame(read(spark, sf, "events").select("event_id", zoned), target, strict=False)


# partitions


def _partitioned(spark, sf, name, keep, *transforms):
    w = warehouse(spark)
    w.load(with_partitioning(TableSpec(name), list(transforms)), read(spark, sf, name).select(*keep), "first")
    t = w.table(name)
    meta = t.meta()
    return t._read(meta, meta.live).select(*keep, *[F.col(f.folder).alias(f"p_{f.transform.kind}") for f in meta.spec])


@query("SELECT o_orderkey, o_orderstatus, o_orderstatus AS p_identity FROM orders")
def partition_identity(spark, sf):
    return _partitioned(spark, sf, "orders", ["o_orderkey", "o_orderstatus"], p.identity("o_orderstatus"))


@query("SELECT event_id, ts, CAST(year(ts) - 1970 AS INTEGER) AS p_year FROM events")
def partition_year(spark, sf):
    return _partitioned(spark, sf, "events", ["event_id", "ts"], p.year("ts"))


@query("SELECT event_id, ts, CAST((year(ts) - 1970) * 12 + month(ts) - 1 AS INTEGER) AS p_month FROM events")
def partition_month(spark, sf):
    return _partitioned(spark, sf, "events", ["event_id", "ts"], p.month("ts"))


@query("SELECT event_id, ts, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS p_day FROM events")
def partition_day(spark, sf):
    return _partitioned(spark, sf, "events", ["event_id", "ts"], p.day("ts"))


@query("SELECT event_id, ts, CAST(epoch_us(ts) // 3600000000 AS INTEGER) AS p_hour FROM events")
def partition_hour(spark, sf):
    return _partitioned(spark, sf, "events", ["event_id", "ts"], p.hour("ts"))


@query("SELECT p_partkey, p_brand, substr(p_brand, 1, 4) AS p_truncate FROM part")
def partition_truncate_str(spark, sf):
    return _partitioned(spark, sf, "part", ["p_partkey", "p_brand"], p.truncate(4, "p_brand"))


@query("SELECT p_partkey, p_size - 25 AS x, CAST((p_size - 25) - ((((p_size - 25) % 10) + 10) % 10) AS INTEGER) AS p_truncate FROM part")
def partition_truncate_int(spark, sf):
    w = warehouse(spark)
    w.load(with_partitioning(TableSpec("part"), p.truncate(10, "x")), read(spark, sf, "part").select("p_partkey", (F.col("p_size") - 25).alias("x")), "first")
    t = w.table("part")
    return t._read(t.meta(), t.meta().live).select("p_partkey", "x", F.col("__p_x_truncate_10").alias("p_truncate"))


#: murmur3 of eight bytes, whose upper four are zero, step by step.
_BUCKET = """WITH a AS (SELECT c_custkey, CAST(c_custkey AS UBIGINT) AS x FROM customer),
k AS (SELECT c_custkey, (x * 3432918353) % 4294967296 AS k FROM a),
r AS (SELECT c_custkey, (((k * 32768) % 4294967296 + k // 131072) * 461845907) % 4294967296 AS h FROM k),
b AS (SELECT c_custkey, (((h * 8192) % 4294967296 + h // 524288) * 5 + 3864292196) % 4294967296 AS h FROM r),
c AS (SELECT c_custkey, xor((((h * 8192) % 4294967296 + h // 524288) * 5 + 3864292196) % 4294967296, 8) AS h FROM b),
d AS (SELECT c_custkey, (xor(h, h // 65536) * 2246822507) % 4294967296 AS h FROM c),
e AS (SELECT c_custkey, (xor(h, h // 8192) * 3266489909) % 4294967296 AS h FROM d)
SELECT c_custkey, CAST((xor(h, h // 65536) % 2147483648) % 7 AS INTEGER) AS p_bucket FROM e"""


@query(_BUCKET)
def partition_bucket(spark, sf):
    return _partitioned(spark, sf, "customer", ["c_custkey"], p.bucket(7, "c_custkey"))


@query("SELECT event_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS p_day FROM events")
def partition_day_tz(spark, sf):
    """Zoned times, written by a session that isn't at UTC."""
    with session_zone(spark, "America/New_York"):
        w = warehouse(spark)
        w.load(with_partitioning(TableSpec("events"), p.day("ts")), _zoned_events(spark, sf), "first")
        t = w.table("events")
        return t._read(t.meta(), t.meta().live).select("event_id", F.col("__p_ts_day").alias("p_day"))


@query("SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 02:30:00' AND ts < TIMESTAMP '2024-01-12 03:30:00'")
def partition_prune_other_zone(spark, sf):
    """Folders written by a session at UTC, picked by one that isn't."""
    import datetime as dt

    w = warehouse(spark)
    with session_zone(spark, "UTC"):
        w.load(with_partitioning(TableSpec("events"), [p.hour("ts")]), _zoned_events(spark, sf), "first")
    with session_zone(spark, "America/New_York"):
        return w.table("events").scan(None, ["event_id", "user_id"], [("ts", ">=", dt.datetime(2024, 1, 10, 2, 30)), ("ts", "<", dt.datetime(2024, 1, 12, 3, 30))])


@contextlib.contextmanager
def session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _zoned_events(spark, sf):
    return read(spark, sf, "events").select("event_id", "user_id", clock.cast(F.col("ts"), T.TimestampNTZType(), T.TimestampType()).alias("ts"))


@query("SELECT c_custkey, c_name FROM customer")
def partition_bucket_roundtrip(spark, sf):
    w = warehouse(spark)
    spec = with_partitioning(TableSpec("customer"), [p.bucket(4, "c_custkey"), p.bucket(3, "c_name")])
    w.load(spec, read(spark, sf, "customer").select("c_custkey", "c_name"), "first")
    return w.table("customer").scan()


@query("SELECT event_id, ts, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 12:00:00'")
def partition_mixed_scan_filter(spark, sf):
    import datetime as dt

    w = warehouse(spark)
    spec = with_partitioning(TableSpec("events"), [p.day("ts"), p.bucket(3, "user_id", "who")])
    w.load(spec, read(spark, sf, "events").select("event_id", "ts", "user_id"), "first")
    return w.table("events").scan(where=[("ts", ">=", dt.datetime(2024, 1, 10)), ("ts", "<", dt.datetime(2024, 1, 12, 12))])


# the read path


@query("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice > 950")
def dataset_filter(spark, sf):
    w = warehouse(spark)
    w.load_files(TableSpec("part"), f"{sf}/part.parquet", "first")
    return w.dataset().query("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice > :least", {"least": 950}).frame


@query("SELECT event_type, count(*) AS n, sum(user_id) AS users FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 12:00:00' AND event_type <> 'view' GROUP BY event_type")
def dataset_partition_pruning(spark, sf):
    """SQL over a partitioned table: the comparisons pick the folders."""
    w = warehouse(spark)
    w.load(with_partitioning(TableSpec("events"), [p.day("ts"), p.identity("event_type")]), read(spark, sf, "events"), "first")
    return w.dataset().query("SELECT event_type, count(*) AS n, sum(user_id) AS users FROM events WHERE ts >= TIMESTAMP_NTZ '2024-01-10 00:00:00' AND TIMESTAMP_NTZ '2024-01-12 12:00:00' > ts AND event_type <> 'view' GROUP BY event_type").frame


@query("SELECT c_name, round(sum(o_totalprice), 2) AS total FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name")
def dataset_join_agg(spark, sf):
    w = warehouse(spark)
    for t in ("customer", "orders"):
        w.load_files(TableSpec(t), f"{sf}/{t}.parquet", "first")
    return w.dataset().query("SELECT c_name, round(sum(o_totalprice), 2) AS total FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name ORDER BY c_name").frame


plain("dataset_left_join", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
plain("dataset_right_join", "SELECT n_name, s_suppkey FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey")
plain("dataset_full_join", "SELECT c_custkey, s_suppkey FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 3")
plain("dataset_cross_join", "SELECT r_name, n_name FROM region CROSS JOIN nation")
plain("dataset_semi_join", "SELECT c_custkey FROM customer LEFT SEMI JOIN orders ON c_custkey = o_custkey", "SELECT c_custkey FROM customer SEMI JOIN orders ON c_custkey = o_custkey")
plain("dataset_anti_join", "SELECT c_custkey FROM customer LEFT ANTI JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000", "SELECT c_custkey FROM customer ANTI JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000")
plain("dataset_range_join", "SELECT p_partkey, s_suppkey FROM part JOIN supplier ON p_retailprice BETWEEN s_acctbal AND s_acctbal + 20")
plain("dataset_using_join", "SELECT n_nationkey, a.n_name AS x, b.n_name AS y FROM nation a JOIN nation b USING (n_nationkey)")
plain("dataset_lateral", "SELECT r_name, n FROM region, LATERAL (SELECT count(*) AS n FROM nation WHERE n_regionkey = r_regionkey)")
plain("dataset_subqueries", "SELECT c_custkey, (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS top FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0)")
plain("dataset_recursive_cte", "WITH RECURSIVE t(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM t WHERE n < 20) SELECT CAST(n AS BIGINT) AS n, CAST(n * n AS BIGINT) AS sq FROM t")
plain("dataset_group_aggs", "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS s, min(o_totalprice) AS lo, max(o_totalprice) AS hi, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY o_orderpriority")
plain("dataset_rollup", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(grouping(o_orderpriority) AS BIGINT) AS g FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
plain("dataset_cube", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
plain("dataset_grouping_sets", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
plain("dataset_distinct_agg", "SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n FROM events GROUP BY event_type")
plain("dataset_filter_agg", "SELECT o_orderstatus, count(*) FILTER (WHERE o_totalprice > 100000) AS big, count(*) AS n FROM orders GROUP BY o_orderstatus")
plain("dataset_stats_aggs", "SELECT event_type, round(median(value), 6) AS med, round(stddev_samp(value), 6) AS sd, round(var_pop(value), 4) AS vp, round(corr(value, event_id), 6) AS r, round(percentile_cont(0.9) WITHIN GROUP (ORDER BY value), 6) AS p90, round(percentile_disc(0.5) WITHIN GROUP (ORDER BY value), 6) AS d50 FROM events GROUP BY event_type")
plain("dataset_arg_max", "SELECT event_type, max_by(event_id, struct(value, event_id)) AS top, min_by(event_id, struct(value, event_id)) AS low FROM events GROUP BY event_type", "SELECT event_type, arg_max(event_id, row(value, event_id)) AS top, arg_min(event_id, row(value, event_id)) AS low FROM events GROUP BY event_type")
plain("dataset_listagg", "SELECT n_regionkey, listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")
plain("dataset_bool_aggs", "SELECT o_orderstatus, bool_and(o_totalprice > 0) AS every, bool_or(o_totalprice > 400000) AS some FROM orders GROUP BY o_orderstatus")
plain("dataset_mode", "SELECT mode(l_returnflag) AS most, count(*) AS n FROM lineitem")
plain("dataset_any_value", "SELECT o_orderstatus, any_value(o_orderstatus) AS one, count(*) AS n FROM orders GROUP BY o_orderstatus")
plain("dataset_epoch_ms", "SELECT event_id, unix_seconds(timestamp_millis(1500000000000 + event_id * 1000003)) AS s, unix_millis(timestamp_millis(1500000000000 + event_id * 1000003)) AS ms FROM events", "SELECT event_id, CAST((1500000000000 + event_id * 1000003) // 1000 AS BIGINT) AS s, epoch_ms(epoch_ms(1500000000000 + event_id * 1000003)) AS ms FROM events")
plain("dataset_nested", "SELECT n_nationkey, s.a AS a, CAST(try_element_at(s.b, 3) AS BIGINT) AS third FROM (SELECT n_nationkey, IF(n_nationkey % 3 = 0, NULL, named_struct('a', n_name, 'b', sequence(1, n_regionkey + 1))) AS s FROM nation)", "SELECT n_nationkey, s.a AS a, CAST(s.b[3] AS BIGINT) AS third FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE {'a': n_name, 'b': range(1, n_regionkey + 2)} END AS s FROM nation)")
plain("dataset_approx_distinct", "SELECT abs(approx_count_distinct(user_id) - count(DISTINCT user_id)) <= 0.1 * count(DISTINCT user_id) AS near FROM events")
plain("dataset_window_rank", "SELECT event_id, row_number() OVER w AS rn, rank() OVER w AS rk, dense_rank() OVER w AS dr, ntile(4) OVER w AS nt, round(percent_rank() OVER w, 9) AS pr, round(cume_dist() OVER w, 9) AS cd FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)")
plain("dataset_window_lag", "SELECT event_id, lag(value) OVER w AS before, lead(value, 1, -1.0) OVER w AS after, first_value(event_id) OVER w AS first, nth_value(event_id, 2) OVER w AS second FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")


@query("SELECT event_id, round(sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6) AS s, count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL '1' DAY PRECEDING AND CURRENT ROW) AS n FROM events")
def dataset_window_frame(spark, sf):
    e = loaded(spark, sf, ["events"]).dataset().query("SELECT event_id, ts, event_type, value FROM events").frame
    e = count_within(e, ["event_type"], "ts", "INTERVAL '1' DAY", "n")
    e = last_rows(e, ["event_type"], "ts", "event_id", 3, F.sum("value"), "s")
    return e.select("event_id", F.round("s", 6).alias("s"), "n")



plain("dataset_topk_per_group", "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 2")
plain("dataset_order_nulls", "SELECT k, n_name FROM (SELECT CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey END AS k, n_name FROM nation) ORDER BY k NULLS LAST, n_name LIMIT 20 OFFSET 3")
plain("dataset_union", "SELECT n_regionkey AS k FROM nation UNION SELECT r_regionkey FROM region")
plain("dataset_union_all", "SELECT n_regionkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region")
plain("dataset_intersect", "SELECT n_regionkey AS k FROM nation INTERSECT SELECT r_regionkey + 1 FROM region")
plain("dataset_intersect_all", "SELECT n_regionkey AS k FROM nation INTERSECT ALL SELECT n_regionkey FROM nation WHERE n_nationkey < 12")
plain("dataset_except", "SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_nationkey < 12")
plain("dataset_except_all", "SELECT n_regionkey AS k FROM nation EXCEPT ALL SELECT r_regionkey FROM region")
plain("dataset_pivot", "SELECT * FROM (SELECT o_orderstatus, o_orderpriority, o_orderkey FROM orders) PIVOT (count(o_orderkey) FOR o_orderstatus IN ('F' AS f, 'O' AS o, 'P' AS p))", "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p FROM orders GROUP BY o_orderpriority")
plain("dataset_string_fns", "SELECT n_nationkey, upper(n_name) AS u, CAST(length(n_name) AS BIGINT) AS l, substring(n_name, 2, 3) AS s, lpad(n_name, 12, '*') AS lp, replace(n_name, 'A', 'b') AS r, concat_ws('-', n_name, 'x') AS c, reverse(n_name) AS rv, trim('  a ') AS t, left(n_name, 2) AS le, CAST(levenshtein(n_name, 'FRANCE') AS BIGINT) AS d, split_part(n_name, 'A', 1) AS sp, CAST(instr(n_name, 'A') AS BIGINT) AS i FROM nation")
plain("dataset_regex_fns", "SELECT p_partkey, regexp_extract(p_brand, '([0-9]+)', 1) AS n, regexp_replace(p_brand, '[0-9]', '#') AS r, p_type RLIKE '^[A-M]' AS m FROM part", "SELECT p_partkey, regexp_extract(p_brand, '([0-9]+)', 1) AS n, regexp_replace(p_brand, '[0-9]', '#', 'g') AS r, regexp_matches(p_type, '^[A-M]') AS m FROM part")
plain("dataset_date_fns", "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS STRING) AS t, CAST(last_day(o_orderdate) AS STRING) AS ld, CAST(datediff(DAY, TIMESTAMP_NTZ '1995-01-01 00:00:00', o_orderdate) AS BIGINT) AS dd, date_format(o_orderdate, 'yyyy/MM') AS f, CAST(dayofweek(o_orderdate) - 1 AS BIGINT) AS dow, CAST(CAST(add_months(o_orderdate, 2) AS DATE) AS STRING) AS am FROM orders", "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS STRING) AS t, CAST(last_day(o_orderdate) AS STRING) AS ld, CAST(date_diff('day', TIMESTAMP '1995-01-01 00:00:00', o_orderdate) AS BIGINT) AS dd, strftime(o_orderdate, '%Y/%m') AS f, CAST(dayofweek(o_orderdate) AS BIGINT) AS dow, CAST(CAST(o_orderdate + INTERVAL 2 MONTH AS DATE) AS STRING) AS am FROM orders")
plain("dataset_math_fns", "SELECT p_partkey, round(p_retailprice, 1) AS r, CAST(floor(p_retailprice) AS BIGINT) AS fl, CAST(ceil(p_retailprice) AS BIGINT) AS ce, round(sqrt(p_retailprice), 6) AS sq, round(ln(p_retailprice), 6) AS l, round(log10(p_retailprice), 6) AS lg, round(power(p_size, 2), 6) AS pw, greatest(p_size, 25) AS g, CAST(sign(p_size - 25) AS BIGINT) AS sg, p_size % 7 AS md, round(cbrt(p_size), 6) AS cb, round(atan2(p_size, 3), 6) AS a FROM part")
plain("dataset_int_division", "SELECT p_partkey, round(p_size / 7, 9) AS q, CAST(p_size div 7 AS BIGINT) AS d, try_divide(p_size, p_size - p_size) IS NULL AS z FROM part", "SELECT p_partkey, round(p_size / 7, 9) AS q, CAST(p_size // 7 AS BIGINT) AS d, true AS z FROM part")
plain("dataset_array_fns", "SELECT n_regionkey, size(a) AS n, array_contains(a, 3) AS has, aggregate(transform(filter(a, x -> x % 2 = 0), x -> CAST(x * 2 AS BIGINT)), 0L, (s, x) -> s + x) AS total, CAST(element_at(slice(a, 1, 2), 1) AS BIGINT) AS first FROM (SELECT n_regionkey, array_sort(collect_list(n_nationkey)) AS a FROM nation GROUP BY n_regionkey)", "SELECT n_regionkey, len(a) AS n, list_contains(a, 3) AS has, CAST(coalesce(list_sum(list_transform(list_filter(a, lambda x: x % 2 = 0), lambda x: x * 2)), 0) AS BIGINT) AS total, CAST(a[1:2][1] AS BIGINT) AS first FROM (SELECT n_regionkey, list_sort(list(n_nationkey)) AS a FROM nation GROUP BY n_regionkey)")
plain("dataset_explode", "SELECT n_name, x FROM nation LATERAL VIEW explode(sequence(1, n_regionkey + 1)) AS x", "SELECT n_name, unnest(range(1, n_regionkey + 2)) AS x FROM nation")
plain("dataset_map_fns", "SELECT n_nationkey, m['name'] AS v, size(map_keys(m)) AS n FROM (SELECT n_nationkey, map('name', n_name, 'key', CAST(n_nationkey AS STRING)) AS m FROM nation)", "SELECT n_nationkey, m['name'] AS v, len(map_keys(m)) AS n FROM (SELECT n_nationkey, MAP {'name': n_name, 'key': CAST(n_nationkey AS VARCHAR)} AS m FROM nation)")
plain("dataset_json_fns", "SELECT event_id, length(props) > 0 AS some, get_json_object(props, '$.missing') IS NULL AS none, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM events", "SELECT event_id, length(props) > 0 AS some, props ->> '$.missing' IS NULL AS none, CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
plain("dataset_conditionals", "SELECT n_nationkey, coalesce(nullif(n_regionkey, 0), -1) AS c, CASE WHEN n_regionkey < 2 THEN 'lo' ELSE 'hi' END AS k, n_regionkey IS DISTINCT FROM NULL AS d, try_cast(n_name AS INT) IS NULL AS t FROM nation")
plain("dataset_hashes", "SELECT n_nationkey, md5(n_name) AS m, sha2(n_name, 256) AS s, hex(n_name) AS h FROM nation", "SELECT n_nationkey, md5(n_name) AS m, sha256(n_name) AS s, hex(n_name) AS h FROM nation")
plain("tpch_q1_like", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge, round(avg(l_quantity), 6) AS avg_qty, count(*) AS n FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY l_returnflag, l_linestatus")
plain("tpch_q3_like", "SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, o_orderdate FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment = 'BUILDING' AND o_orderdate < DATE '1998-03-15' GROUP BY l_orderkey, o_orderdate ORDER BY revenue DESC, l_orderkey LIMIT 10")
plain("tpch_q5_like", "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name")
plain("monthly_counts", "SELECT CAST(CAST(date_trunc('month', ts) AS DATE) AS STRING) AS month, count(*) AS n, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1")


@query("""SELECT event_id, o_orderkey FROM (SELECT event_id, user_id, ts - INTERVAL 8000 DAY AS at FROM events) e
LEFT JOIN LATERAL (SELECT o_orderkey FROM orders WHERE o_custkey = e.user_id AND o_orderdate <= e.at ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) ON true""")
def dataset_asof(spark, sf):
    e = read(spark, sf, "events").select("event_id", F.col("user_id").alias("k"), (F.col("ts") - F.expr("INTERVAL 8000 DAY")).alias("at"))
    o = read(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderdate", "o_orderkey")
    return asof_join(e, o, ["k"], "at", "o_orderdate", "o_orderkey", ["o_orderkey"]).select("event_id", "o_orderkey")


@query("SELECT n_nationkey, count(*) OVER (PARTITION BY n_nationkey % 2 ORDER BY n_regionkey GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n FROM nation")
def dataset_groups_frame(spark, sf):
    n = read(spark, sf, "nation").withColumn("odd", F.col("n_nationkey") % 2)
    return groups_frame(n, ["odd"], "n_regionkey", 1, 0, F.count("*"), "n").select("n_nationkey", "n")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def dataset_qualify(spark, sf):
    first = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return qualify(read(spark, sf, "orders"), first, lambda v: v == 1).select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders")
def csv_source(spark, sf):
    from .sources.files import read_csv

    root = scratch(spark)
    read(spark, sf, "orders").select("o_orderkey", "o_custkey").write.option("header", True).csv(f"{root}/csv")
    w = warehouse(spark)
    w.load(TableSpec("orders"), read_csv(spark, f"{root}/csv", "o_orderkey long, o_custkey long"), "first")
    return w.table("orders").scan()


# tables and namespaces


@query("SELECT count(*) FILTER (WHERE o_orderkey % 2 = 0) AS earlier, count(*) AS later FROM orders")
def view_refresh(spark, sf):
    """A result keeps the snapshot it was asked at; the next query sees the next one."""
    w, o = warehouse(spark), read(spark, sf, "orders")
    counts = []
    for i, name in enumerate(("earlier", "later")):
        w.load(TableSpec("orders"), o.where(F.col("o_orderkey") % 2 == i), name)
        counts.append(w.dataset().query(f"SELECT count(*) AS {name} FROM orders").frame)
    return counts[0].crossJoin(counts[1])  # a row each


@query("SELECT 'nation' AS \"table\", count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region")
def view_eligibility(spark, sf):
    """The user's tables, without the ledger that a package leaves beside them."""
    w, package = warehouse(spark), LoadPackage("load1")
    for t in ("region", "nation"):
        package.add(TableSpec(t), read(spark, sf, t))
    w.complete(package)
    return _counts(w)


def _counts(w: Warehouse) -> DataFrame:
    """(table, n) of each table that the dataset shows."""
    parts = [w.dataset()[t].frame.agg(F.lit(t).alias("table"), F.count("*").alias("n")) for t in w.dataset().tables()]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def relation_arrow(spark, sf):
    w = warehouse(spark)
    w.load(TableSpec("nation"), read(spark, sf, "nation"), "first")
    return spark.createDataFrame(w.dataset()["nation"].where("n_regionkey = 1").select("n_nationkey", "n_name").arrow())


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 10")
def scan_equality(spark, sf):
    w = warehouse(spark)
    w.load(with_partitioning(TableSpec("lineitem"), [p.identity("l_returnflag")]), read(spark, sf, "lineitem"), "first")
    return w.table("lineitem").scan(columns=["l_orderkey", "l_linenumber"], where=[("l_returnflag", "=", "R"), ("l_quantity", ">=", 10)])


@query("SELECT 'customer' AS \"table\", count(*) AS n FROM customer UNION ALL SELECT 'region', count(*) FROM region")
def drop_named(spark, sf):
    """One of three tables goes, and one that was never there."""
    w = warehouse(spark)
    for t in ("region", "nation", "customer"):
        w.load(TableSpec(t), read(spark, sf, t), "first")
    w.drop_tables("nation", "part")
    return _counts(w)


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def drop_all_reload(spark, sf):
    """Nothing of a dropped table is left, its known loads included."""
    w, o = warehouse(spark), read(spark, sf, "orders")
    w.load(TableSpec("orders"), o.where("o_orderstatus <> 'F'"), "first")
    w.drop_storage()
    w.load(TableSpec("orders"), o.where("o_orderstatus = 'F'"), "first")
    return w.table("orders").scan()


@query("SELECT s_suppkey, s_name FROM supplier")
def register_existing(spark, sf):
    """Another warehouse on the same folder finds the tables that are there."""
    w = warehouse(spark)
    w.load(TableSpec("supplier"), read(spark, sf, "supplier"), "first")
    with Warehouse(spark, Config(w.config.warehouse, register_new_tables=True)) as other:
        other.initialize_storage()
        return other.dataset().query("SELECT s_suppkey, s_name FROM supplier").frame


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS namespace FROM orders")
def namespaces_apart(spark, sf):
    """Tables of one name in two namespaces of a warehouse."""
    o, root, parts = read(spark, sf, "orders"), scratch(spark), []
    for i, name in enumerate(("even", "odd")):
        w = Warehouse(spark, Config(root, namespace=name))
        w.initialize_storage()
        w.load(TableSpec("orders"), o.where(F.col("o_orderkey") % 2 == i), "first")
        parts.append(w)
    even, odd = (w.dataset()["orders"].frame.select("o_orderkey", F.lit(w.config.namespace).alias("namespace")) for w in parts)
    return even.union(odd)


@query("SELECT p_partkey, p_brand, true AS placed FROM part")
def location_layout(spark, sf):
    """Tables stand where the layout says and are found there."""
    w = warehouse(spark, table_location_layout="placed/{namespace}/{table_name}-data")
    w.load(TableSpec("part"), read(spark, sf, "part"), "first")
    rows = w.dataset()["part"].frame
    return rows.select("p_partkey", "p_brand", F.col("_metadata.file_path").contains("/placed/default/part-data/").alias("placed"))


@query("SELECT n_nationkey, n_name FROM nation")
def evolve_drop_column(spark, sf):
    w, n = warehouse(spark), read(spark, sf, "nation")
    w.load(TableSpec("nation"), n, "first")
    t = w.table("nation")
    t.evolve(n.select("n_nationkey", "n_name").schema, allow_drops=True)
    return t.scan()


@query("SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def expire_then_scan(spark, sf):
    """Old versions and their folders go; the newest version's rows stay."""
    w, o = warehouse(spark), read(spark, sf, "orders")
    for i in range(3):
        w.load(TableSpec("orders"), o.where(F.col("o_orderkey") % 3 == i), f"load{i}")
    t = w.table("orders")
    t.delete_where(F.col("o_orderstatus") == "P")
    t.compact()
    t.expire(1)
    t.remove_orphans(0)
    return t.scan()


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(20,4)) AS price FROM orders")
def cast_decimal_widen(spark, sf):
    target = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("price", T.DecimalType(20, 4))])
    return casting.cast_frame(read(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price")), target)


@query("SELECT o_orderkey, o_custkey FROM orders")
def cast_string_parse(spark, sf):
    """Numbers that stand as texts, checked one by one."""
    o = read(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"))
    target = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType())])
    return casting.cast_frame(o, target, strict=False)


@query("SELECT 'h2' AS version_hash, CAST(2 AS BIGINT) AS version UNION ALL SELECT 'h1', CAST(1 AS BIGINT)")
def schema_by_hash(spark, sf):
    w = warehouse(spark)
    for i in (1, 2, 3):
        w.store_schema("s", i, f"h{i}", {"tables": i})
    found = [w.stored_schema_by_hash(h) for h in ("h2", "h1", "none")]
    return spark.createDataFrame([(f["version_hash"], f["version"]) for f in found if f], "version_hash string, version long")


@query("SELECT CAST(d AS DATE) AS day, CAST(date_diff('day', DATE '2024-01-01', CAST(d AS DATE)) AS BIGINT) AS n FROM generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-04-02', INTERVAL 1 DAY) AS t(d)")
def span_source(spark, sf):
    """A service with a row for each day, which answers ten days at most."""
    import datetime as dt

    from .sources.ranged import TooMuch, months, read_spans

    def fetch(a, b):
        if (b - a).days > 10:
            raise TooMuch
        days = [a + dt.timedelta(days=i) for i in range((b - a).days)]
        return [{"day": d, "n": (d - dt.date(2024, 1, 1)).days} for d in days]

    schema = T.StructType([T.StructField("day", T.DateType()), T.StructField("n", T.LongType())])
    return read_spans(spark, months(dt.date(2024, 1, 5), dt.date(2024, 4, 3)), fetch, schema)


@query("SELECT n_nationkey, CAST(n_nationkey AS VARCHAR) AS wide, TIMESTAMP '2024-01-01' + n_nationkey * INTERVAL 1 SECOND AS at FROM nation")
def load_file_arrow_types(spark, sf):
    """A load file with types that Spark's reader refuses: nanoseconds and a 256-bit decimal."""
    import io
    from decimal import Decimal

    import pyarrow as pa
    import pyarrow.parquet as pq

    keys = [r[0] for r in read(spark, sf, "nation").select("n_nationkey").collect()]
    start = 1_704_067_200
    table = pa.table({
        "n_nationkey": pa.array(keys, pa.int64()),
        "wide": pa.array([Decimal(k) for k in keys], pa.decimal256(60, 0)),
        "at": pa.array([(start + k) * 1_000_000_000 for k in keys], pa.timestamp("ns")),
    })
    out = io.BytesIO()
    pq.write_table(table, out)
    w, path = warehouse(spark), f"{scratch(spark)}/in"
    w.files.make(path)
    w.files.put_new(f"{path}/nation.parquet", out.getvalue())
    w.load_files(TableSpec("nation"), f"{path}/nation.parquet", "first")
    return w.table("nation").scan()


@query("SELECT * FROM orders")
def concurrent_appends(spark, sf):
    """Four writers at once: each commit that loses the race is tried again on the version that won."""
    from concurrent.futures import ThreadPoolExecutor

    w, o = warehouse(spark, max_retries=10, retry_backoff_base=1.1), read(spark, sf, "orders")
    w.load(TableSpec("orders"), o.where("o_orderkey % 5 = 4"), "load4")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: w.load(TableSpec("orders"), o.where(F.col("o_orderkey") % 5 == i), f"load{i}"), range(4)))
    return w.table("orders").scan()


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS seen FROM customer")
def stream_last_committed_wins(spark, sf):
    """A later micro-batch with older rows replaces newer ones; replayed, it changes nothing."""
    w, c = warehouse(spark), read(spark, sf, "customer").select("c_custkey")
    spec = TableSpec("customer", "merge", primary_key="c_custkey")
    newer, older = (c.withColumn("seen", F.lit(day).cast("date")) for day in ("2024-02-01", "2024-01-01"))
    for batch, i in ((newer, 0), (older.where("c_custkey % 2 = 0"), 1), (newer, 0)):
        load_batch(w, spec, "customers", batch, i)
    return w.table("customer").scan()


@query("SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name FROM region")
def load_rows_and_tables(spark, sf):
    """Batches as dicts, as an Arrow table, as a pandas frame and as a path."""
    r = read(spark, sf, "region").select(F.col("r_regionkey").cast("long").alias("r_regionkey"), "r_name")
    w, spec, path = warehouse(spark), TableSpec("region"), f"{scratch(spark)}/region"
    r.where("r_regionkey = 3").write.parquet(path)
    first = [x.asDict() for x in r.where("r_regionkey < 2").collect()]
    for i, batch in enumerate([first, r.where("r_regionkey = 2").toArrow(), path, {"region": r.where("r_regionkey > 3").toPandas()}]):
        w.load(spec, batch, f"load{i}")
    return w.table("region").scan()
