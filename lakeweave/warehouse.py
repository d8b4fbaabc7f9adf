"""The warehouse: load packages, the load ledger, stored schemas and pipeline state, and tables as SQL views."""

from __future__ import annotations

import datetime as dt
import json
import logging
import re
import threading
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import LakeError, UndefinedTableError
from .functions import clock
from .plans.pruning import pushed_terms
from .sources.files import Files, as_frame, read_load_files, union_batches
from .spec import INTERNAL, Config, TableSpec
from .store import Result, Table
from .types import comment, to_logical

log = logging.getLogger("lakeweave")
LOADS, VERSIONS, STATE = f"{INTERNAL}loads", f"{INTERNAL}version", f"{INTERNAL}pipeline_state"
ENGINE_VERSION = 1
_LOADS = "load_id string not null, schema_name string not null, status bigint not null, inserted_at timestamp_ntz, schema_version_hash string"
_VERSIONS = "version_hash string not null, schema_name string not null, version bigint not null, engine_version bigint not null, inserted_at timestamp_ntz not null, schema string not null"
_STATE = "version bigint not null, engine_version bigint not null, pipeline_name string not null, state string not null, created_at timestamp_ntz not null, version_hash string, load_id string"


@dataclass
class LoadPackage:
    """Batches that wait to be committed, by table. It is kept until all its tables are committed; completing it again goes on
    where it stopped, as tables that have the load's id are skipped."""

    load_id: str
    batches: dict[str, tuple[TableSpec, list[DataFrame]]] = field(default_factory=dict)
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def add(self, spec: TableSpec, batch: DataFrame) -> None:
        with self._lock:
            self.batches.setdefault(spec.name, (spec, []))[1].append(batch)


def _required(schema: str) -> dict[str, dict[str, Any]]:
    return {part.split()[0]: {"nullable": "not null" not in part} for part in schema.split(", ")}


class Warehouse:
    def __init__(self, spark: SparkSession, config: Config | str) -> None:
        self.spark = spark
        self.config = Config(config) if isinstance(config, str) else config
        self.files = Files(spark)

    def __enter__(self) -> Warehouse:
        return self

    def __exit__(self, *_: object) -> None:
        return None

    # storage

    @property
    def root(self) -> str:
        return f"{self.config.warehouse.rstrip('/')}/{self.config.namespace}"

    def initialize_storage(self, truncate: Sequence[str] = ()) -> None:
        self.files.make(self.root)
        if self.config.register_new_tables:
            log.info("found tables: %s", ", ".join(self.discover()))
        for name in truncate:
            t = self.table(name)
            if t.exists():
                t.truncate()

    def is_storage_initialized(self) -> bool:
        return self.files.exists(self.root)

    def table(self, name: str) -> Table:
        return Table(self.spark, self.config.location(name), self.config)

    def load_table(self, name: str) -> Table:
        t = self.table(name)
        if not t.exists():
            raise UndefinedTableError(f"table {name} isn't defined in {self.config.namespace}")
        return t

    def names(self) -> list[str]:
        """Folders (or notes of folders) that may hold a table, in one listing."""
        return self.files.names(f"{self.root}/.tables") if self.config.table_location_layout else [n for n in self.files.names(self.root) if not n.startswith(".")]

    def discover(self) -> list[str]:
        """Physical names of the namespace's tables: every folder with a metadata version in it."""
        return [n for n in self.names() if self._physical(n).exists()]

    def _remember(self, name: str) -> None:
        """With a layout of its own a table can't be found by listing, so its place is noted."""
        if self.config.table_location_layout:
            note = f"{self.root}/.tables/{self.config.physical_name(name)}"
            if not self.files.exists(note):
                self.files.make(f"{self.root}/.tables")
                self.files.put_new(note, self.config.location(name))

    def _physical(self, physical: str) -> Table:
        path = self.files.read(f"{self.root}/.tables/{physical}").decode() if self.config.table_location_layout else f"{self.root}/{physical}"
        return Table(self.spark, path, self.config)

    def drop_storage(self) -> None:
        """Drops all tables; the namespace stays."""
        for n in self.discover():
            self._physical(n).drop()

    def drop_tables(self, *names: str, delete_schema: bool = True, schema_name: str | None = None) -> None:
        """Drops tables, missing ones included; with ``delete_schema`` the stored versions of ``schema_name`` go too."""
        for n in names:
            self.table(n).drop()
        versions = self.table(VERSIONS)
        if delete_schema and schema_name and versions.exists():
            versions.delete_where(F.col("schema_name") == F.lit(schema_name))

    # loads

    def load(self, spec: TableSpec, batches: Any, load_id: str | None = None) -> Result:
        """All batches of a table as one snapshot: a sequence of DataFrames, or one batch in any form that ``as_frame`` takes."""
        batches = list(batches) if isinstance(batches, Iterator) else batches
        several = isinstance(batches, Sequence) and len(batches) and all(isinstance(b, DataFrame) for b in batches)
        many = list(batches) if several else [as_frame(self.spark, batches)]
        self._remember(spec.name)
        return self.table(spec.name).load(union_batches(many), spec, load_id)

    def load_files(self, spec: TableSpec, paths: str | Sequence[str], load_id: str | None = None, commit_mode: str = "per_table") -> list[Result]:
        """Parquet load files as one snapshot, or (``per_file``) as a snapshot for each file."""
        many = [paths] if isinstance(paths, str) else list(paths)
        if commit_mode == "per_file":
            return [self.load(spec, read_load_files(self.spark, p), f"{load_id}:{i}" if load_id else None) for i, p in enumerate(many)]
        return [self.load(spec, read_load_files(self.spark, many), load_id)]

    def complete(self, package: LoadPackage, schema_name: str = "default", schema_hash: str | None = None) -> dict[str, Result]:
        """Commits a package, each table as one snapshot, then its ledger row. Tables are atomic one by one; after a failure the
        package can be completed again."""
        done = {name: self.load(spec, batches, package.load_id) for name, (spec, batches) in package.batches.items()}
        self.record_load(package.load_id, schema_name, schema_hash)
        package.batches.clear()
        return done

    def record_load(self, load_id: str, schema_name: str, schema_hash: str | None = None) -> bool:
        """Adds the ledger row of a load, once."""
        row = self.spark.createDataFrame([(load_id, schema_name, 0, _now(), schema_hash)], _LOADS)
        return self._append(LOADS, row, _LOADS, f"ledger:{load_id}")

    def loads(self) -> DataFrame:
        return self.load_table(LOADS).scan()

    def _append(self, name: str, rows: DataFrame, schema: str, load_id: str) -> bool:
        """A small append that a known load_id doesn't repeat. Timestamps take the existing column's type, else none with zone."""
        t = self.table(name)
        if t.exists():
            want = t.meta().schema
            times = (T.TimestampType, T.TimestampNTZType)
            rows = rows.select(*[clock.cast(F.col(f.name), f.dataType, want[f.name].dataType).alias(f.name) if f.name in want.names and isinstance(want[f.name].dataType, times) else F.col(f.name) for f in rows.schema])
        spec = TableSpec(name, "append", columns=_required(schema))
        self._remember(name)
        return not t.load(rows, spec, load_id).repeated

    # schemas and state

    def store_schema(self, schema_name: str, version: int, version_hash: str, schema: Mapping[str, Any]) -> bool:
        row = self.spark.createDataFrame([(version_hash, schema_name, version, ENGINE_VERSION, _now(), json.dumps(schema, sort_keys=True))], _VERSIONS)
        return self._append(VERSIONS, row, _VERSIONS, f"schema:{version_hash}")

    def _newest(self, name: str, by: str, condition) -> dict[str, Any] | None:
        t = self.table(name)
        if not t.exists():
            return None
        rows = t.scan().where(condition)
        tie = [F.desc(c) for c in (by, "version_hash") if c in rows.columns]
        found = rows.orderBy(*tie).limit(1).collect()
        return found[0].asDict() if found else None

    def stored_schema(self, schema_name: str | None = None) -> dict[str, Any] | None:
        """The newest stored schema, else one derived from the tables, else None."""
        found = self._newest(VERSIONS, "version", F.lit(True) if schema_name is None else F.col("schema_name") == F.lit(schema_name))
        return found or self.derived_schema(schema_name or "default")

    def stored_schema_by_hash(self, version_hash: str) -> dict[str, Any] | None:
        return self._newest(VERSIONS, "version", F.col("version_hash") == F.lit(version_hash))

    def derived_schema(self, schema_name: str) -> dict[str, Any] | None:
        """A schema read off the tables' metadata; no job runs."""
        tables = {}
        for physical in self.discover():
            if self.config.is_internal(physical):
                continue
            try:
                meta = self._physical(physical).meta()
            except (LakeError, ValueError) as e:
                log.warning("no schema from %s: %s", physical, e)
                continue
            columns = {f.name: {"name": f.name, "data_type": to_logical(f.dataType), "nullable": f.nullable} | ({"description": comment(f)} if comment(f) else {}) for f in meta.schema}
            tables[physical] = {"name": physical, "columns": columns}
        if not tables:
            return None
        return {"version_hash": "derived", "schema_name": schema_name, "version": 1, "engine_version": ENGINE_VERSION, "inserted_at": _now(), "schema": json.dumps({"name": schema_name, "version": 1, "tables": tables}, sort_keys=True)}

    def store_state(self, pipeline: str, state: str, version: int = 1, version_hash: str | None = None, load_id: str | None = None, created_at: dt.datetime | None = None) -> bool:
        row = self.spark.createDataFrame([(version, ENGINE_VERSION, pipeline, state, created_at or _now(), version_hash, load_id)], _STATE)
        return self._append(STATE, row, _STATE, f"state:{pipeline}:{version}:{version_hash}:{load_id}")

    def stored_state(self, pipeline: str) -> dict[str, Any] | None:
        return self._newest(STATE, "created_at", F.col("pipeline_name") == F.lit(pipeline))

    # SQL

    def dataset(self) -> Dataset:
        return Dataset(self)


#: What each view of a session shows: a table's folder and version.
_VIEWS: dict[tuple[str, str], tuple[str, int]] = {}


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Dataset:
    """The tables as DataFrames and as Spark SQL views at their current snapshots."""

    def __init__(self, warehouse: Warehouse) -> None:
        self.warehouse, self.spark = warehouse, warehouse.spark
        self._session = self.spark._jsparkSession.sessionUUID()

    def __getitem__(self, name: str) -> Relation:
        return Relation(self.warehouse.load_table(name).scan())

    def tables(self) -> list[str]:
        return [n for n in self.warehouse.discover() if not self.warehouse.config.is_internal(n)]

    def refresh(self, sql: str | None = None) -> dict[str, Table]:
        """Registers views for tables (those that ``sql`` names) that are new or have changed; returns them."""
        words = None if sql is None else {w.lower() for w in re.findall(r"\w+", sql)}
        found = {}
        for name in self.warehouse.names():
            if words is not None and not {w.lower() for w in re.findall(r"\w+", name)} <= words:
                continue
            t = self.warehouse._physical(name)
            version = t.newest()
            if version is None:
                continue
            found[name] = t
            if _VIEWS.get((self._session, name)) != (t.path, version):
                t.scan().createOrReplaceTempView(name)
                _VIEWS[self._session, name] = (t.path, version)
        return found

    def query(self, sql: str, args: Mapping[str, Any] | None = None) -> Relation:
        """Spark SQL over the tables' names; ``args`` fills :name parameters.

        Comparisons of a partitioned table's columns with constants pick its folders: they are read off the optimised plan, so it
        doesn't matter how the query is written, and the query is planned again over views of those folders.
        """
        run = lambda: self.spark.sql(sql, args=dict(args)) if args else self.spark.sql(sql)
        tables = self.refresh(sql)
        out = run()
        split = {name: t for name, t in tables.items() if t.meta().spec}
        terms = pushed_terms(out, {self.warehouse.files.qualified(f"{t.path}/data"): name for name, t in split.items()}) if split else {}
        chosen = {name: lists for name, lists in terms.items() if lists and all(lists)}
        if not chosen:
            return Relation(out)
        for name, lists in chosen.items():
            split[name].scan(folders=lists).createOrReplaceTempView(name)
            _VIEWS.pop((self._session, name), None)
        try:
            out = run()
        finally:
            self.refresh(sql)
        return Relation(out)


class Relation:
    """A lazy result: ``frame`` is the DataFrame."""

    def __init__(self, frame: DataFrame) -> None:
        self.frame = frame

    def df(self):
        return self.frame.toPandas()

    def arrow(self):
        return self.frame.toArrow()

    def fetchall(self) -> list[tuple]:
        return [tuple(r) for r in self.frame.collect()]

    def select(self, *columns: str) -> Relation:
        return Relation(self.frame.select(*columns))

    def where(self, condition) -> Relation:
        return Relation(self.frame.where(condition))
