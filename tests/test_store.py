import threading

import pytest
from pyspark.sql import functions as F

from lakeweave import CastingError, Config, LoadPackage, SchemaEvolutionError, TableSpec, UndefinedTableError, ValidationError, Warehouse, partition, with_partitioning
from lakeweave.errors import CommitConflictError, ConfigError, ErrorCategory, category_of, friendly_message, is_retryable


@pytest.fixture
def w(spark, tmp_path):
    found = Warehouse(spark, Config(f"file://{tmp_path}/lake"))
    found.initialize_storage()
    return found


def rows(w, name, **how):
    return sorted(tuple(r) for r in w.table(name).scan(**how).collect())


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


USERS = "user_id long, name string, score long"


def test_append_and_snapshots(spark, w):
    for i in range(2):
        w.load(TableSpec("e"), frame(spark, [(i, "x")], "id long, t string"), f"l{i}")
    meta = w.table("e").meta()
    assert rows(w, "e") == [(0, "x"), (1, "x")] and [s["seq"] for s in meta.snapshots] == [1, 2] and meta.snapshots[1]["parent"] == meta.snapshots[0]["id"]


def test_a_load_id_counts_once(spark, w):
    for _ in range(3):
        last = w.load(TableSpec("e"), frame(spark, [(1,)], "id long"), "same")
    assert last.repeated and rows(w, "e") == [(1,)]


def test_merge(spark, w):
    spec = TableSpec("u", {"disposition": "merge", "strategy": "delete-insert"}, primary_key="user_id")
    w.load(spec, frame(spark, [(1, "a", 100), (2, "b", 200), (3, "c", 300)], USERS), "1")
    w.load(spec, frame(spark, [(2, "B", 250), (4, "d", 400)], USERS), "2")
    assert rows(w, "u") == [(1, "a", 100), (2, "B", 250), (3, "c", 300), (4, "d", 400)]
    assert len(w.table("u").meta().snapshots) == 2
    assert rows(w, "u", version=1) == [(1, "a", 100), (2, "b", 200), (3, "c", 300)]
    w.table("u").compact()
    assert rows(w, "u") == [(1, "a", 100), (2, "B", 250), (3, "c", 300), (4, "d", 400)] and len(w.table("u").meta().live) == 1


def test_large_composite_merge(spark, w):
    spec = TableSpec("big", "merge", primary_key=["account_id", "item_id"])
    make = lambda a, b, sign: spark.range(a, b).selectExpr("id div 10 AS account_id", "id % 10 AS item_id", f"{sign} * id AS value")
    w.load(spec, make(0, 20_000, 1), "1")
    w.load(spec, make(10_000, 25_000, -1), "2")
    got = w.table("big").scan().agg(F.count("*"), F.count_if(F.col("value") > 0), F.count_if(F.col("value") < 0)).first()
    assert tuple(got) == (25_000, 9_999, 15_000)


def test_hard_deletes(spark, w):
    s = "user_id long, name string, _deleted_at timestamp_ntz"
    import datetime as dt

    now, spec = dt.datetime(2024, 1, 1), TableSpec("u", "merge", columns={"user_id": {"primary_key": True}})
    w.load(spec, frame(spark, [(1, "a", None), (2, "b", None), (3, "c", None)], s), "1")
    w.load(spec, frame(spark, [(1, "A", None), (2, "b", now), (4, "d", None)], s), "2")
    assert sorted(r[:2] for r in rows_any(w, "u")) == [(1, "A"), (3, "c"), (4, "d")]
    w.load(spec, frame(spark, [(1, None, now), (3, None, now), (4, None, now)], s), "3")
    assert rows_any(w, "u") == []
    assert w.load(spec, frame(spark, [], s), "4").snapshot is None  # nothing came, nothing is committed


def rows_any(w, name):
    return [tuple(r) for r in w.table(name).scan().collect()]


def test_evolution_through_loads(spark, w):
    w.load(TableSpec("t"), frame(spark, [(1, 1.5)], "id int, x float"), "1")
    w.load(TableSpec("t"), frame(spark, [(2, 2.5, "n")], "id long, x double, y string"), "2")
    assert rows(w, "t")[0] == (1, 1.5, None) and rows(w, "t")[1] == (2, 2.5, "n")
    with pytest.raises(SchemaEvolutionError):
        w.load(TableSpec("t"), frame(spark, [("a",)], "id string"), "3")
    assert len(w.table("t").meta().snapshots) == 2 and w.table("t").meta().ids == {"id": 1, "x": 2, "y": 3}


def test_later_files_bring_columns(spark, w):
    w.load(TableSpec("t"), [frame(spark, [(1,)], "id long"), frame(spark, [(2, "z")], "id long, z string")], "1")
    assert sorted(r.z or "" for r in w.table("t").scan().collect()) == ["", "z"]


def test_failed_loads_leave_nothing(spark, w):
    spec = TableSpec("t", columns={"id": {"nullable": False}})
    with pytest.raises(CastingError):
        w.load(spec, frame(spark, [(1,), (None,)], "id long"), "1")
    assert not w.table("t").exists()
    w.load(spec, frame(spark, [(1,)], "id long"), "1")
    with pytest.raises(SchemaEvolutionError, match="required"):
        w.load(spec, frame(spark, [("x",)], "other string"), "2")


def test_concurrent_writers_all_get_in(spark, tmp_path):
    w = Warehouse(spark, Config(f"file://{tmp_path}/c", max_retries=10))
    w.load(TableSpec("t"), spark.range(1), "0")
    errors = []

    def run(i):
        try:
            w.load(TableSpec("t"), spark.range(1), f"l{i}")
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    meta = w.table("t").meta()
    assert not errors and meta.version == 5 and w.table("t").scan().count() == 5


def test_conflicts_are_retried_without_writing_again(spark, w, monkeypatch):
    t, calls = w.table("t"), []
    put = type(t)._put

    def flaky(self, meta):
        calls.append(meta.version)
        if len(calls) < 3:
            raise CommitConflictError("taken")
        put(self, meta)

    monkeypatch.setattr(type(t), "_put", flaky)
    t.load(spark.range(3), TableSpec("t"), "1")
    assert len(calls) == 3 and t.scan().count() == 3 and t.orphans() == []


def test_partition_pruning_reaches_the_scan(spark, w):
    import datetime as dt

    spec = with_partitioning(TableSpec("e"), [partition.day("ts"), partition.bucket(3, "k")])
    df = spark.range(100).selectExpr("id", "id % 7 AS k", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS ts")
    w.load(spec, df, "1")
    got = w.table("e").scan(where=[("ts", ">=", dt.datetime(2024, 1, 3, 5)), ("k", "=", 4)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "__p_ts_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r.id for r in got.collect()) == [i for i in range(100) if i >= 53 and i % 7 == 4]
    with pytest.raises(ValidationError, match="part of the merge key"):
        w.load(with_partitioning(TableSpec("m", "merge", primary_key="id"), "k"), df, "1")


def test_rewrites(spark, w):
    w.load(TableSpec("t"), frame(spark, [(1, "it's"), (2, None), (3, "b")], "id long, s string"), "1")
    w.table("t").delete_where(F.col("s") == "it's")
    assert rows_any(w, "t") and {r.id for r in w.table("t").scan().collect()} == {2, 3}
    w.table("t").truncate()
    assert rows_any(w, "t") == [] and len(w.table("t").meta().snapshots) == 3
    assert w.table("t").evolve(w.table("t").meta().schema.add("n", "integer")) and w.table("t").scan().columns == ["id", "s", "n"]


def test_ledger_state_and_schemas(spark, w):
    assert w.stored_schema("s") is None and w.stored_state("p") is None
    p = LoadPackage("L")
    p.add(TableSpec("a"), spark.range(2))
    p.add(TableSpec("b"), spark.range(3))
    assert {n: r.inserted for n, r in w.complete(p).items()} == {"a": 2, "b": 3}
    assert not w.record_load("L", "default") and w.loads().count() == 1
    assert w.stored_schema("s")["version_hash"] == "derived"
    for v in (1, 3, 2):
        w.store_schema("it's", v, f"h{v}", {})
    assert w.stored_schema("it's")["version_hash"] == "h3" and w.stored_schema_by_hash("h1")["version"] == 1 and w.stored_schema_by_hash("no") is None
    w.drop_tables("a", "missing", schema_name="it's")
    assert not w.table("a").exists() and w.stored_schema_by_hash("h1") is None
    w.drop_storage()
    assert w.discover() == [] and w.is_storage_initialized()


def test_a_package_goes_on_after_a_failure(spark, w):
    p = LoadPackage("L")
    p.add(TableSpec("a"), spark.range(2))
    p.add(TableSpec("b", columns={"id": {"nullable": False}}), frame(spark, [(None,)], "id long"))
    with pytest.raises(CastingError):
        w.complete(p)
    assert w.table("a").scan().count() == 2 and not w.table("_lw_loads").exists()
    p.batches["b"] = (TableSpec("b"), [spark.range(1)])
    w.complete(p)
    assert w.table("a").scan().count() == 2 and w.table("b").scan().count() == 1 and w.loads().count() == 1


def test_dataset(spark, w):
    w.load(TableSpec("products"), frame(spark, [(1, "Widget", 9.99), (2, "Gadget", 19.99), (3, "Gizmo", 29.99)], "product_id long, name string, price double"), "1")
    d = w.dataset()
    assert len(d["products"].df()) == 3 and d["products"].arrow().num_rows == 3
    assert sorted(r[0] for r in d.query("SELECT name FROM products WHERE price > 15").fetchall()) == ["Gadget", "Gizmo"]
    w.load(TableSpec("products"), frame(spark, [(4, "New", 99.0)], "product_id long, name string, price double"), "2")
    assert d.query("SELECT count(*) FROM products").fetchall() == [(4,)]
    with pytest.raises(UndefinedTableError):
        d["nothing"]


def test_layout_and_names(spark, tmp_path):
    c = Config(f"file://{tmp_path}/w", table_location_layout="{namespace}/x/{table_name}/data", internal_table_prefix="own_")
    assert c.location("t") == f"file://{tmp_path}/w/default/x/t/data" and c.physical_name("_lw_loads") == "own_loads" and c.is_internal("own_loads")
    w = Warehouse(spark, c)
    w.initialize_storage()
    w.load(TableSpec("t"), spark.range(2), "1")
    assert w.discover() == ["t"] and w.dataset().query("SELECT count(*) FROM t").fetchall() == [(2,)]
    for bad in ({"max_retries": 0}, {"internal_table_prefix": "_"}):
        with pytest.raises(ConfigError):
            Config("/w", **bad)
    with pytest.raises(ValidationError):
        TableSpec("t", "upsert")


def test_error_categories():
    assert is_retryable(ConnectionResetError()) and not is_retryable(ValueError()) and not is_retryable(CastingError("x")) and not is_retryable(Exception())
    assert category_of(PermissionError()) is ErrorCategory.AUTH and category_of(Exception()) is None
    assert "version" in friendly_message(CommitConflictError("x"), "commit")


def test_external_catalogue_settings():
    from lakeweave.sources.catalogs import catalog_conf, storage_conf

    c = Config("s3://b/w", catalog_uri="https://c", credential="a:b", oauth2_server_uri="https://o", token="t", s3_endpoint="http://m:9000", s3_access_key_id="k")
    got = catalog_conf(c)
    assert got["spark.sql.catalog.lake.credential"] == "a:b" and "spark.sql.catalog.lake.token" not in got
    assert storage_conf(c)["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert catalog_conf(Config("/w", catalog_uri="sqlite:////tmp/x.db"))["spark.sql.catalog.lake.type"] == "jdbc"


def test_arrow_types(spark, tmp_path):
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    from lakeweave.sources.files import normalise_arrow, read_load_files

    t = pa.table({"t": pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("ns")), "d": pa.array([1], pa.decimal256(50, 0)), "k": pa.array(["a"]).dictionary_encode(), "l": pa.array([["x"]], pa.large_list(pa.string()))})
    pq.write_table(normalise_arrow(t), f"{tmp_path}/a.parquet")
    assert [f.dataType.simpleString() for f in read_load_files(spark, f"file://{tmp_path}/a.parquet").schema] == ["timestamp_ntz", "string", "string", "array<string>"]
    with pytest.raises(FileNotFoundError):
        read_load_files(spark, f"file://{tmp_path}/none.parquet")


# pruning through SQL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sql_picks_folders(spark, w):
    import datetime as dt

    days = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * i), "abc"[i % 3]) for i in range(80)]
    w.load(with_partitioning(TableSpec("e"), [partition.day("ts"), partition.identity("k")]), frame(spark, days, "i int, ts timestamp_ntz, k string"), "1")
    d = w.dataset()
    got = d.query("SELECT i FROM e WHERE ts >= TIMESTAMP_NTZ '2024-01-05 06:00:00' AND ts < TIMESTAMP_NTZ '2024-01-06 00:00:00' AND k = 'a'")
    assert {r[0] for r in got.fetchall()} == {i for i, t, k in days if dt.datetime(2024, 1, 5, 6) <= t < dt.datetime(2024, 1, 6) and k == "a"}
    assert "PartitionFilters: [isnotnull(__p_ts_day" in plan_of(got.frame)
    # a table that is read twice needs the folders of both
    got = d.query("SELECT a.i, b.i FROM (SELECT i FROM e WHERE ts < TIMESTAMP_NTZ '2024-01-02 00:00:00') a JOIN (SELECT i FROM e WHERE :late < ts) b ON a.i + 76 = b.i", {"late": dt.datetime(2024, 1, 19, 20)})
    assert got.frame.count() == 4
    # nothing to prune by: an aggregate over all, an OR, a subquery
    assert d.query("SELECT count(*) FROM e").fetchall() == [(80,)]
    assert d.query("SELECT count(*) FROM e WHERE ts < TIMESTAMP_NTZ '2024-01-02 00:00:00' OR k = 'b'").fetchall() == [(sum(t < dt.datetime(2024, 1, 2) or k == "b" for _, t, k in days),)]
    got = d.query("SELECT (SELECT count(*) FROM e) AS n, i FROM e WHERE ts < TIMESTAMP_NTZ '2024-01-01 12:00:00'")
    assert sorted(got.fetchall()) == [(80, 0), (80, 1)]
    got = d.query("WITH x AS (SELECT * FROM e WHERE k = 'c') SELECT count(*) FROM x UNION ALL SELECT count(*) FROM e WHERE k > 'a'")
    assert sorted(got.fetchall()) == sorted([(sum(k == "c" for *_, k in days),), (sum(k > "a" for *_, k in days),)])
    assert spark.table("e").count() == 80  # the view itself stays whole


def test_sql_sees_new_commits_and_merges(spark, w):
    spec = with_partitioning(TableSpec("m", "merge", primary_key=["k", "i"]), partition.identity("k"))
    w.load(spec, frame(spark, [("a", 1, 1), ("b", 2, 2), ("b", 3, 3)], "k string, i int, v int"), "1")
    d = w.dataset()
    assert sorted(d.query("SELECT v FROM m WHERE k = 'b'").fetchall()) == [(2,), (3,)]
    w.load(spec, frame(spark, [("b", 2, 20), ("c", 4, 4)], "k string, i int, v int"), "2")
    assert sorted(d.query("SELECT v FROM m WHERE k = 'b'").fetchall()) == [(3,), (20,)]


# many commits


def test_metadata_stays_small_over_thousands_of_commits(spark, w):
    import time

    t = w.table("many")
    t.evolve(frame(spark, [(1,)], "id long").schema)
    took = []
    for i in range(2000):
        began = time.perf_counter()
        assert t._commit(lambda m, i=i: t._next(m, m, f"c{i}", "append", [{"kind": "data", "keys": [], "hides": None}], load_id=f"l{i}"), f"l{i}")
        took.append(time.perf_counter() - began)
    middle = lambda x: sorted(x)[len(x) // 2]
    assert middle(took[-200:]) < 4 * middle(took[100:300])
    import os

    path = t._file(t.newest()).removeprefix("file://")
    assert os.path.getsize(path) < 300_000
    meta = t.meta()
    assert len(meta.snapshots) == 2001 and len(meta.live) == 2000 and meta.loaded("l7") and t._commit(lambda m: 1 / 0, "l1999") is None
    assert len(t.meta(700).snapshots) == 700
    from lakeweave import store

    store._CHUNKS.clear()
    store._NEWEST.clear()
    assert t.meta().snapshots == meta.snapshots  # as another process would read it


def test_a_merge_takes_its_keys_from_what_it_wrote(spark, w):
    spec = TableSpec("r", "merge", primary_key="k")
    w.load(spec, spark.range(200).selectExpr("id AS k", "'old' AS v"), "1")
    w.load(spec, spark.range(100).selectExpr("cast(floor(rand() * 200) AS bigint) AS k", "'new' AS v"), "2")
    got = w.table("r").scan().groupBy("k").agg(F.count_distinct("v").alias("n")).collect()
    assert all(r.n == 1 for r in got) and len(got) == 200


def test_deletes_rewrite_only_commits_that_match(spark, w):
    for i in range(3):
        w.load(TableSpec("d"), spark.range(10 * i, 10 * i + 10), f"{i}")
    before = {p.commit for p in w.table("d").meta().live}
    assert w.table("d").delete_where(F.col("id").between(12, 14)).inserted == 7
    after = {p.commit for p in w.table("d").meta().live}
    assert len(before & after) == 2 and rows(w, "d") == [(i,) for i in range(30) if not 12 <= i <= 14]
    assert w.table("d").delete_where(F.col("id") > 1000).snapshot is None
    w.table("d").delete_where(F.col("id") >= 10)
    assert rows(w, "d") == [(i,) for i in range(10)] and rows(w, "d", version=3) == [(i,) for i in range(30)]


def test_interleaved_merges_and_appends(spark, w):
    merge, append = TableSpec("x", "merge", primary_key="k"), TableSpec("x")
    want = {}
    for i in range(7):
        batch = [(k, i) for k in range(i, i + 4)]
        w.load(merge if i % 2 else append, frame(spark, batch, "k int, v int"), f"{i}")
        for k, v in batch:
            want[k] = [v] if i % 2 else [*want.get(k, []), v]
    assert rows(w, "x") == sorted((k, v) for k, many in want.items() for v in many)


def test_expiry_and_orphans(spark, w):
    import os

    for i in range(4):
        w.load(TableSpec("o", "replace"), spark.range(i + 1), f"{i}")
    t = w.table("o")
    os.makedirs(f"{t.path.removeprefix('file://')}/data/commit=lost")
    assert [p.rsplit("/", 1)[1] for p in t.orphans()] == ["commit=lost"] and t.remove_orphans() == []
    assert len(t.remove_orphans(older_than=0)) == 1 and t.orphans() == []
    assert t.expire(2) == 2 and t.versions() == [3, 4] and len(t.files.names(f"{t.path}/data")) == 2
    assert rows(w, "o") == [(i,) for i in range(4)] and rows(w, "o", version=3) == [(i,) for i in range(3)]
    with pytest.raises(UndefinedTableError):
        t.scan(version=1)
    assert w.load(TableSpec("o"), spark.range(1), "0").repeated


def test_gzip_metadata_and_unknown_formats(spark, tmp_path):
    from lakeweave import store

    path = f"{tmp_path}/z"
    packed = Warehouse(spark, Config(f"file://{path}", metadata_gzip=True))
    packed.load(TableSpec("t"), spark.range(3), "1")
    file = f"{path}/default/t/metadata/v0000000001.json"
    assert open(file, "rb").read(2) == b"\x1f\x8b"
    plain = Warehouse(spark, Config(f"file://{path}"))
    plain.load(TableSpec("t"), spark.range(2), "2")
    assert packed.table("t").scan().count() == 5
    text = open(f"{path}/default/t/metadata/v0000000002.json").read()
    open(f"{path}/default/t/metadata/v0000000003.json", "w").write(text.replace(f'"format": {store.FORMAT}', '"format": 99'))
    with pytest.raises(ValidationError, match="99"):
        plain.load_table("t").scan()


# errors of file systems


class Thrown:
    """What py4j hands over of a JVM exception."""

    def __init__(self, *names, message="said", cause=None):
        self.names, self.message, self.cause = names, message, cause

    def getClass(self):
        return self

    def getName(self):
        return self.names[0]

    def getSuperclass(self):
        return Thrown(*self.names[1:]) if len(self.names) > 1 else None

    def getMessage(self):
        return self.message

    def getCause(self):
        return self.cause


@pytest.mark.parametrize("thrown, category, again", [
    (Thrown("java.net.ConnectException", "java.net.SocketException"), ErrorCategory.SERVER, True),
    (Thrown("own.Weird", "java.io.IOException"), ErrorCategory.SERVER, True),
    (Thrown("java.lang.RuntimeException", cause=Thrown("java.net.SocketTimeoutException")), ErrorCategory.SERVER, True),
    (Thrown("org.apache.hadoop.security.AccessControlException"), ErrorCategory.AUTH, False),
    (Thrown("java.io.IOException", message="Status Code: 403, AccessDenied"), ErrorCategory.AUTH, False),
    (Thrown("java.io.IOException", message="ExpiredToken: the token has expired"), ErrorCategory.AUTH, True),
    (Thrown("org.apache.hadoop.security.token.SecretManager$InvalidToken"), ErrorCategory.AUTH, True),
    (Thrown("java.io.FileNotFoundException"), ErrorCategory.CLIENT, False),
])
def test_jvm_errors_are_known(thrown, category, again):
    from lakeweave.errors import translate

    error = Exception("from the JVM")
    error.java_exception = thrown
    found = translate(error)
    assert category_of(found) == category and is_retryable(found) == again
    assert translate(Exception("other")).args == ("other",)


def test_files_raise_known_errors(spark):
    from lakeweave.sources.files import Files

    with pytest.raises(FileNotFoundError):
        Files(spark).read("file:///nowhere/at/all")


def test_unreachable_storage_is_tried_again(spark, w, monkeypatch):
    from lakeweave.errors import StorageUnavailableError

    t, failed = w.table("s"), []
    real = t.files.put_new

    def put(path, data):
        if len(failed) < 2:
            failed.append(path)
            raise StorageUnavailableError("no answer")
        real(path, data)

    monkeypatch.setattr(t.files, "put_new", put)
    monkeypatch.setattr("time.sleep", lambda s: None)
    from lakeweave.spec import TableSpec as Spec

    assert t.load(spark.range(3), Spec("s"), "1").version == 1 and len(failed) == 2 and rows(w, "s") == [(0,), (1,), (2,)]


def test_a_commit_of_unknown_outcome_is_looked_for(spark, w, monkeypatch):
    from lakeweave.errors import CommitStateUnknownError

    w.load(TableSpec("u"), spark.range(1), "0")
    t = w.table("u")
    real, calls = t.files.put_new, []

    def put(path, data):
        calls.append(path)
        real(path, data)
        if len(calls) == 1:
            raise CommitStateUnknownError("the answer was lost")

    monkeypatch.setattr(t.files, "put_new", put)
    monkeypatch.setattr("time.sleep", lambda s: None)
    assert t.load(spark.range(2), TableSpec("u")).version == 2
    assert len(calls) == 1 and w.table("u").scan().count() == 3 and len(w.table("u").meta().snapshots) == 2


# load files through Arrow


def test_load_files_that_the_reader_refuses(spark, w, tmp_path):
    import datetime as dt
    from decimal import Decimal

    import pyarrow as pa
    import pyarrow.parquet as pq

    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    table = pa.table({
        "big": pa.array([Decimal("1" * 50), None], pa.decimal256(60, 0)),
        "t": pa.array([dt.time(1, 2, 3), None], pa.time32("ms")),
        "ns": pa.array([at, None], pa.timestamp("ns")),
        "word": pa.array(["x", None]).dictionary_encode(),
        "list": pa.array([[1, 2], None], pa.list_(pa.int32())),
    })
    for i in range(2):
        pq.write_table(table, f"{tmp_path}/f{i}.parquet")
    w.load_files(TableSpec("a"), [f"file://{tmp_path}/f{i}.parquet" for i in range(2)], "1")
    got = w.table("a").scan().where("word = 'x'").collect()
    assert len(got) == 2 and got[0].t.startswith("01:02:03") and got[0].big == "1" * 50 and got[0].ns == at and list(got[0].list) == [1, 2]
    assert w.table("a").scan().where("word IS NULL AND big IS NULL AND t IS NULL AND ns IS NULL AND list IS NULL").count() == 2


def test_batches_in_other_forms(spark, w, tmp_path):
    import pandas as pd
    import pyarrow as pa

    spec = TableSpec("e")
    frame(spark, [(4, "path")], "id long, t string").write.parquet(f"{tmp_path}/in")
    forms = [[{"id": 1, "t": "dict"}, {"id": 2}], pa.table({"id": [3], "t": ["arrow"]}), f"{tmp_path}/in", {"e": pd.DataFrame({"id": [5], "t": ["pandas"]})}]
    for i, form in enumerate(forms):
        w.load(spec, form, f"l{i}")
    w.load(spec, (frame(spark, [(n, "many")], "id long, t string") for n in (6, 7)), "l9")
    assert rows(w, "e") == [(1, "dict"), (2, None), (3, "arrow"), (4, "path"), (5, "pandas"), (6, "many"), (7, "many")]
    assert len(w.table("e").meta().snapshots) == 5


@pytest.mark.parametrize("batches", [{"a": [{"id": 1}], "b": [{"id": 2}]}, {}, []])
def test_batches_of_no_or_several_tables(w, batches):
    with pytest.raises(ValueError):
        w.load(TableSpec("e"), batches)
