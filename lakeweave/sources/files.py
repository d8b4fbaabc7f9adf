"""Files on any file system that Spark's Hadoop layer knows, and the load files that tables are filled from."""

from __future__ import annotations

import functools
import logging
import os
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import CommitConflictError, CommitStateUnknownError, ValidationError, translate

log = logging.getLogger("lakeweave")


def translated(call):
    """A call to the JVM's file systems whose failures are raised as this engine's errors, where they are known."""

    @functools.wraps(call)
    def tried(*args, **how):
        try:
            return call(*args, **how)
        except Exception as e:
            found = translate(e)
            if found is e:
                raise
            raise found from e

    return tried


class Files:
    """Small metadata files; only the driver uses this."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._gateway, self._conf = spark.sparkContext._jvm, spark.sparkContext._gateway, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    @translated
    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if it isn't there. They come over as one text, not one by one."""
        fs, p = self._at(folder)
        if not fs.exists(p):
            return []
        paths = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p))
        plain = self._gateway.new_array(self._jvm.java.lang.Object, len(paths))
        self._jvm.java.lang.System.arraycopy(paths, 0, plain, 0, len(paths))
        start = f"{fs.makeQualified(p).toString().rstrip('/')}/"
        return sorted(n.removesuffix(", ") for n in self._jvm.java.util.Arrays.toString(plain)[1:-1].split(start)[1:])

    @translated
    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p))

    @translated
    def qualified(self, path: str) -> str:
        fs, p = self._at(path)
        return fs.makeQualified(p).toString()

    @translated
    def age(self, path: str) -> float:
        """Seconds since the last change."""
        fs, p = self._at(path)
        return time.time() - fs.getFileStatus(p).getModificationTime() / 1000

    @translated
    def make(self, folder: str) -> None:
        fs, p = self._at(folder)
        fs.mkdirs(p)

    @translated
    def remove(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p) and fs.delete(p, True))

    @translated
    def read(self, path: str) -> bytes:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    @translated
    def put_new(self, path: str, data: bytes | str) -> None:
        """Writes a file that must not exist yet, whole or not at all; of several writers one wins, the others get CommitConflictError.

        A local file system links a finished file to its name, which fails if the name is taken. Others create the file without
        overwriting, which their servers decide; if writing then fails, what is there is compared, and a part of it removed
        (CommitStateUnknownError: the caller looks again before it repeats).
        """
        data = data.encode() if isinstance(data, str) else data
        fs, p = self._at(path)
        uri = fs.makeQualified(p).toUri()
        if uri.getScheme() == "file":
            final = uri.getPath()
            draft = f"{os.path.dirname(final)}/.{uuid.uuid4().hex}"
            with open(draft, "wb") as f:
                f.write(data)
                f.flush()
                os.fsync(f.fileno())
            try:
                os.link(draft, final)
            except FileExistsError as e:
                raise CommitConflictError(f"{path} exists") from e
            finally:
                os.unlink(draft)
            return
        if fs.exists(p):
            raise CommitConflictError(f"{path} exists")
        try:
            stream = fs.create(p, False)
        except Exception as e:
            if fs.exists(p):
                raise CommitConflictError(f"{path} exists") from e
            raise
        self._fill(stream, path, data)

    def _fill(self, stream, path: str, data: bytes) -> None:
        try:
            try:
                stream.write(bytearray(data))
            finally:
                stream.close()
        except Exception as e:
            try:
                if self.exists(path) and self.read(path) != data:
                    self.remove(path)  # ours, as it was created here
            except Exception:  # the state stays unknown
                log.warning("%s could not be looked at after a failed write", path)
            raise CommitStateUnknownError(f"{path}: {e}") from e


def read_load_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet load files as one batch: the union of their columns, by name, with types widened where they differ safely.

    Files with types that Spark's reader refuses (nanoseconds, times, 256-bit decimals) are read through Arrow, see ``read_arrow``.
    """
    many = [paths] if isinstance(paths, str) else list(paths)
    files = Files(spark)
    missing = [p for p in many if not files.exists(p)]
    if missing:
        raise FileNotFoundError(f"load files are missing: {', '.join(missing)}")
    frames, plain = [], True
    for p in many:
        try:
            frames.append(spark.read.parquet(p))
        except Exception as e:
            if not any(x in str(e) for x in ("DECIMAL_PRECISION_EXCEEDS_MAX_PRECISION", "PARQUET_TYPE_ILLEGAL", "PARQUET_TYPE_NOT_SUPPORTED", "PARQUET_TYPE_NOT_RECOGNIZED", "Illegal Parquet type", "Parquet type not")):
                raise
            frames.append(read_arrow(spark, p))
            plain = False
    if plain and len({f.schema.json() for f in frames}) == 1:
        return spark.read.parquet(*many)  # one scan
    return union_batches(frames)


def read_arrow(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder through Arrow, on the executors, in the types of ``normalise_arrow``.

    A task holds the bytes of one file, which must be under 2 GB, and goes through it row group by row group. Files of a folder must
    have the same columns once their types are normalised.
    """
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("content")

    def schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                found = normalise_arrow(pq.ParquetFile(pa.BufferReader(raw.as_buffer())).schema_arrow.empty_table()).schema
                yield pa.RecordBatch.from_arrays([pa.array([found.remove_metadata().serialize().to_pybytes()], pa.binary())], names=["schema"])

    found = [pa.ipc.read_schema(pa.BufferReader(r[0])) for r in content.mapInArrow(schemas, "schema binary").distinct().collect()]
    if not found:
        raise FileNotFoundError(f"no Parquet files in {path}")
    if len(found) > 1:
        raise ValidationError(f"the files in {path} have different columns")
    want = found[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                for part in pq.ParquetFile(pa.BufferReader(raw.as_buffer())).iter_batches(10_000):
                    yield from normalise_arrow(pa.Table.from_batches([part])).cast(want).to_batches()

    return content.mapInArrow(read, from_arrow_schema(want, prefer_timestamp_ntz=True))


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """A bag union by name; columns that a batch lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def as_frame(spark: SparkSession, data: Any) -> DataFrame:
    """One table's rows as a DataFrame: a DataFrame itself, the path of Parquet files, an Arrow table, a pandas frame, or rows as dicts (a
    missing field is null). A mapping counts as its only entry; with several it is several tables, which is an error.
    """
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, Mapping):
        if len(data) != 1:
            raise ValidationError(f"one table's rows are needed, not those of {len(data)}: {', '.join(map(str, data))}")
        return as_frame(spark, next(iter(data.values())))
    if isinstance(data, (str, os.PathLike)):
        return read_load_files(spark, os.fspath(data))
    import pandas as pd
    import pyarrow as pa

    if isinstance(data, pa.Table):
        return spark.createDataFrame(normalise_arrow(data))
    if isinstance(data, pd.DataFrame):
        return spark.createDataFrame(data)
    if not data:
        raise ValidationError("rows without a single one have no columns; give a DataFrame with a schema")
    return spark.createDataFrame(data)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)


def normalise_arrow(table):
    """An Arrow table in types that Spark's Parquet reader takes: times of day and 256-bit decimals as text, dictionaries
    as their values, nanoseconds as microseconds if nothing is lost; inside lists, maps and structs too."""
    import pyarrow as pa

    def kind(t: pa.DataType) -> pa.DataType:
        if pa.types.is_time(t):
            return pa.string()
        if pa.types.is_decimal256(t):
            return pa.string()
        if pa.types.is_dictionary(t):
            return kind(t.value_type)
        if pa.types.is_timestamp(t) and t.unit in ("ns", "s"):
            return pa.timestamp("us", t.tz)
        if pa.types.is_large_list(t) or pa.types.is_list(t):
            return pa.list_(t.value_field.with_type(kind(t.value_type)))
        if pa.types.is_map(t):
            return pa.map_(kind(t.key_type), t.item_field.with_type(kind(t.item_type)))
        if pa.types.is_struct(t):
            return pa.struct([f.with_type(kind(f.type)) for f in t])
        return t

    def plain(column: pa.ChunkedArray) -> pa.ChunkedArray:
        """Arrow has no cast of its own from 256-bit decimals to text."""
        if pa.types.is_decimal256(column.type):
            return pa.chunked_array([pa.array([None if x is None else str(x) for x in c.to_pylist()], pa.string()) for c in column.chunks], pa.string())
        return column

    table = pa.table([plain(c) for c in table.columns], names=table.schema.names)
    return table.cast(pa.schema([pa.field(f.name, kind(f.type)) for f in table.schema]))
