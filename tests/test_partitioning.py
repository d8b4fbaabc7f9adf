import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.functions.murmur3 import hash_bytes, murmur3
from lakeweave.plans import partitioning as p
from lakeweave.spec import TableSpec, with_partitioning

pytestmark = pytest.mark.usefixtures("spark")


def test_hints_and_names():
    assert p.parse_hint("bucket[16]") == ("bucket", 16) and p.parse_hint("month") == ("month", None)
    assert [t.field for t in (p.bucket(10, "user_id"), p.truncate(4, "email"), p.month("ts", "when"))] == ["user_id_bucket_10", "email_truncate_4", "when"]
    for bad in (lambda: p.bucket(0, "x"), lambda: p.truncate(-1, "x")):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize("t, kind, ok", [(p.day("x"), "date", True), (p.hour("x"), "date", False), (p.hour("x"), "timestamp", True), (p.year("x"), "string", False), (p.bucket(4, "x"), "double", True), (p.bucket(4, "x"), "binary", False), (p.truncate(4, "x"), "string", True), (p.truncate(4, "x"), "double", False), (p.Transform("x", "bucket"), "int", False), (p.Transform("x", "nope"), "int", False)])
def test_checks(t, kind, ok):
    k = T.StructType.fromDDL(f"x {kind}")["x"].dataType
    if ok:
        p.check(t, k)
    else:
        with pytest.raises(ValueError):
            p.check(t, k)


def test_specs():
    schema = T.StructType.fromDDL("id bigint, ts timestamp_ntz, region string, price double")
    fields = p.build_spec({"ts": {"partition": True}, "region": {"partition": True}, "id": {"x-partition": "bucket[5]"}, "gone": {"partition": True}}, schema)
    assert [(f.field_id, f.transform.field) for f in fields] == [(1000, "ts_month"), (1001, "region_identity"), (1002, "id_bucket_5")]
    spec = with_partitioning(TableSpec("t"), [p.identity("ts"), "region", p.bucket(3, "id", "b")])
    assert [f.transform.hint() for f in p.build_spec(spec.columns, schema)] == ["identity", "identity", "bucket[3]"]
    assert with_partitioning(TableSpec("t"), None) == TableSpec("t")
    with pytest.raises(ValueError):
        with_partitioning(TableSpec("t"), [3])


def test_hash_vectors(spark):
    # published vectors of murmur3 with seed 0
    assert hash_bytes(b"hello") == 613153351 and hash_bytes(b"hello, world") == 345750399 and hash_bytes(bytes([0, 1, 2, 3])) == -188683207
    row = spark.sql("SELECT 34 AS i, 34L AS l, DATE '2017-11-16' AS d, TIMESTAMP '2017-11-16 22:31:08 UTC' AS t, 'hello' AS s, CAST(14.20 AS DECIMAL(9,2)) AS n, CAST(NULL AS INT) AS z")
    got = row.select(*[murmur3(F.col(c), row.schema[c].dataType).alias(c) for c in row.columns]).first()
    assert tuple(got) == (2017239379, 2017239379, -653330422, -2047944441, 613153351, -500754589, None)


def test_values(spark):
    df = spark.createDataFrame([(-1, Decimal("10.65"), "glacier", dt.datetime(1969, 12, 31, 23), dt.date(1969, 12, 31)), (None, None, None, None, None)], "i int, d decimal(9,2), s string, t timestamp_ntz, day date")
    ts = [p.truncate(10, "i"), p.truncate(50, "d"), p.truncate(3, "s"), p.hour("t"), p.day("day"), p.month("t"), p.year("t")]
    rows = df.select(*[p.value_of(t, df.schema[t.column].dataType).alias(f"v{i}") for i, t in enumerate(ts)]).collect()
    assert tuple(rows[0]) == (-10, Decimal("10.50"), "gla", -1, -1, -1, -1)
    assert tuple(rows[1]) == (None,) * 7


ZONES = ("UTC", "America/New_York", "Asia/Kolkata")
TIMES = ["2024-03-10 02:30:00.5", "2024-03-09 23:59:59.999999", "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2024-11-03 01:30:00", "0001-01-01 00:00:00", "9999-12-31 23:59:59.999999"]


def test_values_do_not_depend_on_the_session(spark):
    from lakeweave.functions import clock

    got = []
    for zone in ZONES:
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.createDataFrame([(t,) for t in TIMES], "v string").select(F.col("v").cast("timestamp_ntz").alias("n"))
            df = df.withColumn("z", clock.cast(F.col("n"), T.TimestampNTZType(), T.TimestampType()))
            ts = [f(c) for c in "nz" for f in (p.year, p.month, p.day, p.hour, lambda c: p.bucket(1000, c))]
            back = clock.cast(F.col("z"), T.TimestampType(), T.TimestampNTZType()).cast("string").alias("back")
            got.append([tuple(r) for r in df.select(*[p.value_of(t, df.schema[t.column].dataType).alias(f"v{i}") for i, t in enumerate(ts)], back).collect()])
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == got[1] == got[2]
    for text, row in zip(TIMES, got[0], strict=True):
        at = dt.datetime.fromisoformat(text)
        micros = (at - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        want = (at.year - 1970, (at.year - 1970) * 12 + at.month - 1, micros // 86_400_000_000, micros // 3_600_000_000)
        assert row[:4] == row[5:9] == want and row[4] == row[9] and dt.datetime.fromisoformat(row[10]) == at


@pytest.mark.parametrize("made", [p.identity, p.year, p.month, p.day, p.hour])
def test_folders_of_one_zone_are_found_from_another(spark, tmp_path, made):
    from lakeweave import Warehouse
    from lakeweave.functions import clock

    base = dt.datetime(2024, 1, 1)
    times = [base + dt.timedelta(hours=7 * i, microseconds=i) for i in range(40)]
    for kind in ("timestamp", "timestamp_ntz"):
        w = Warehouse(spark, f"file://{tmp_path}/{kind}{made.__name__}")
        try:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            df = spark.createDataFrame([(i, str(t)) for i, t in enumerate(times)], "i int, s string").withColumn("n", F.col("s").cast("timestamp_ntz"))
            df = df.select("i", (clock.cast(F.col("n"), T.TimestampNTZType(), T.TimestampType()) if kind == "timestamp" else F.col("n")).alias("ts"))
            w.load(with_partitioning(TableSpec("e"), made("ts")), df.where("i < 20"), "1")
            spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
            w.load(TableSpec("e"), df.where("i >= 20"), "2")
            for zone in ZONES:
                spark.conf.set("spark.sql.session.timeZone", zone)
                for op, cut in (("<", times[9]), ("<=", times[25]), (">", times[30]), (">=", times[3]), ("=", times[21])):
                    got = {r.i for r in w.table("e").scan(where=[("ts", op, cut)]).collect()}
                    assert got == {i for i, t in enumerate(times) if {"<": t < cut, "<=": t <= cut, ">": t > cut, ">=": t >= cut, "=": t == cut}[op]}, (zone, kind, op)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_texts_and_nulls_are_found(spark, tmp_path):
    from lakeweave import Warehouse

    w = Warehouse(spark, f"file://{tmp_path}/w")
    df = spark.createDataFrame([("",), (None,), ("abc",), ("abd",), ("b",)], "s string")
    for name, t in (("i", p.identity("s")), ("t", p.truncate(2, "s"))):
        w.load(with_partitioning(TableSpec(name), t), df, "1")
        for op, value, want in (("=", "", {""}), ("<", "abd", {"", "abc"}), (">=", "abd", {"abd", "b"}), ("<=", "abc", {"", "abc"})):
            assert {r.s for r in w.table(name).scan(where=[("s", op, value)]).collect()} == want


def plain_murmur(data):
    """Murmur3 x86 32, seed 0, a byte block at a time."""
    h, m = 0, 0xFFFFFFFF
    rot = lambda x, r: (x << r | x >> (32 - r)) & m
    for i in range(0, len(data) & ~3, 4):
        h = (rot(h ^ rot(int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & m, 15) * 0x1B873593 & m, 13) * 5 + 0xE6546B64) & m
    k = int.from_bytes(data[len(data) & ~3 :], "little")
    h ^= rot(k * 0xCC9E2D51 & m, 15) * 0x1B873593 & m
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_hashes_of_texts_and_wide_decimals(spark):
    texts = [None, "", "a", "ab", "abc", "abcd", "é" * 7, "x" * 1001, "漢字"]
    decimals = [None, *(Decimal(x) for x in ("0", "-1", "1.27", "-1.28", "1.28", "12345678901234567890123456789012.345", "-99999999999999999999999999999999.999", "0.255", "0.256"))]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").coalesce(1).select(murmur3(F.col("s"), T.StringType())).collect()]
    assert got == [None if t is None else plain_murmur(t.encode()) for t in texts]
    kind = T.DecimalType(38, 3)
    got = [r[0] for r in spark.createDataFrame([(d,) for d in decimals], T.StructType([T.StructField("d", kind)])).coalesce(1).select(murmur3(F.col("d"), kind)).collect()]

    def fewest(d):
        n = int(f"{d:.3f}".replace(".", ""))
        size = next(k for k in range(1, 17) if -(1 << (8 * k - 1)) <= n < 1 << (8 * k - 1))
        return n.to_bytes(size, "big", signed=True)

    assert got == [None if d is None else plain_murmur(fewest(d)) for d in decimals]
