"""Snapshot tables over Parquet: one versioned metadata file for each commit, made by compare-and-set.

    <table>/metadata/v0000000001.json      schema, partition spec, the newest snapshots, names of older snapshots' files
    <table>/metadata/snapshots-<id>.json   CHUNK snapshots that don't change any more
    <table>/data/commit=<id>/[__p_<field>=<value>/]part-*.parquet
    <table>/deletes/commit=<id>/part-*.parquet     keys of rows that earlier commits lose

A commit writes its rows in one Spark job to a folder of its own, then adds the next version. Only that last step is
repeated when another writer was faster, so a failed or repeated load never shows in part or twice.

A snapshot says what it adds to and takes from the live folders, so a version file holds at most CHUNK of them, however many commits
there were. Files of snapshots are read once in a process, and the newest version is looked for from the last one known.
"""

from __future__ import annotations

import gzip
import json
import logging
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import casting, evolution
from .errors import CommitConflictError, CommitStateUnknownError, SchemaEvolutionError, UndefinedTableError, ValidationError, is_retryable, log_error, translate
from .operators.merge import apply_deletes
from .plans import partitioning
from .plans.partitioning import PartitionField, Transform
from .sources.files import Files
from .spec import Config, TableSpec
from .types import table_schema

log = logging.getLogger("lakeweave")


FORMAT = 2
#: Snapshots in a file of their own.
CHUNK = 256
#: What this process has read: snapshots by file, newest version by table.
_CHUNKS: dict[str, list[dict[str, Any]]] = {}
_NEWEST: dict[str, int] = {}


@dataclass(frozen=True)
class Part:
    """A folder of one commit that belongs to the current rows: data, or deletes by ``keys``. Rows of data that aren't null in the
    column ``hides`` only delete."""

    commit: str
    seq: int
    kind: str = "data"
    keys: tuple[str, ...] = ()
    hides: str | None = None


@dataclass(frozen=True)
class Meta:
    version: int
    schema: T.StructType
    ids: dict[str, int]
    spec: list[PartitionField] = field(default_factory=list)
    snapshots: list[dict[str, Any]] = field(default_factory=list)
    chunks: tuple[str, ...] = ()
    properties: dict[str, str] = field(default_factory=dict)

    @property
    def seq(self) -> int:
        return self.snapshots[-1]["seq"] if self.snapshots else 0

    @cached_property
    def live(self) -> list[Part]:
        out: list[Part] = []
        for s in self.snapshots:
            if s["reset"]:
                out = []
            if s["drops"]:
                out = [p for p in out if p.kind != "data" or p.commit not in s["drops"]]
            out += [Part(s["id"], s["seq"], a["kind"], tuple(a["keys"]), a["hides"]) for a in s["adds"]]
        least = min((p.seq for p in out if p.kind == "data"), default=None)
        return [p for p in out if p.kind == "data" or least is not None and p.seq > least]  # a delete without earlier data is done

    def loaded(self, load_id: str | None) -> bool:
        return load_id is not None and any(s.get("load_id") == load_id for s in self.snapshots)

    def to_json(self) -> str:
        """Without the snapshots that ``chunks`` hold."""
        spec = [{"field_id": f.field_id, "source_id": self.ids[f.transform.column], "column": f.transform.column, "transform": f.transform.kind, "param": f.transform.param, "name": f.transform.name} for f in self.spec]
        return json.dumps({"format": FORMAT, "version": self.version, "schema": self.schema.jsonValue(), "ids": self.ids, "spec": spec, "chunks": self.chunks, "snapshots": self.snapshots[len(self.chunks) * CHUNK :], "properties": self.properties}, indent=1)

    @staticmethod
    def of(text: str, chunk: Callable[[str], list[dict[str, Any]]]) -> Meta:
        d = json.loads(text)
        if d.get("format") != FORMAT:
            raise ValidationError(f"the table's metadata has format {d.get('format')}; only {FORMAT} is known")
        spec = [PartitionField(f["field_id"], Transform(f["column"], f["transform"], f["param"], f["name"])) for f in d["spec"]]
        snapshots = [s for name in d["chunks"] for s in chunk(name)] + d["snapshots"]
        return Meta(d["version"], T.StructType.fromJson(d["schema"]), d["ids"], spec, snapshots, tuple(d["chunks"]), d["properties"])


def _numbered(schema: T.StructType, ids: dict[str, int]) -> dict[str, int]:
    """Field ids: known names keep theirs, new ones follow the largest ever used."""
    out, last = dict(ids), max(ids.values(), default=0)
    for n in schema.names:
        if n not in out:
            last += 1
            out[n] = last
    return out


@dataclass(frozen=True)
class Result:
    """What a commit did. ``snapshot`` is None if there was nothing to commit or the load had been committed before."""

    version: int
    snapshot: str | None
    inserted: int = 0
    repeated: bool = False


class Table:
    """One table in its folder."""

    def __init__(self, spark: SparkSession, path: str, config: Config) -> None:
        self.spark, self.path, self.config, self.files = spark, path.rstrip("/"), config, Files(spark)

    # metadata

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self.files.names(f"{self.path}/metadata") if n.startswith("v") and n.endswith(".json"))

    def _file(self, version: int) -> str:
        return f"{self.path}/metadata/v{version:010d}.json"

    def newest(self) -> int | None:
        """The newest version: from the last one that this process knows on, else by listing. Versions have no gaps but at the start."""
        at = _NEWEST.get(self.path)
        if at is None or not self.files.exists(self._file(at)):
            at = max(self.versions(), default=None)
            if at is None:
                _NEWEST.pop(self.path, None)
                return None
        while self.files.exists(self._file(at + 1)):
            at += 1
        _NEWEST[self.path] = at
        return at

    def exists(self) -> bool:
        return self.newest() is not None

    def _text(self, path: str) -> str:
        raw = self.files.read(path)
        return (gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode()

    def _packed(self, text: str) -> bytes:
        return gzip.compress(text.encode(), mtime=0) if self.config.metadata_gzip else text.encode()

    def _chunk(self, name: str) -> list[dict[str, Any]]:
        path = f"{self.path}/metadata/{name}"
        if path not in _CHUNKS:
            _CHUNKS[path] = json.loads(self._text(path))
        return _CHUNKS[path]

    def meta(self, version: int | None = None) -> Meta:
        version = version or self.newest()
        if version is None:
            raise UndefinedTableError(f"no table at {self.path}")
        if not self.files.exists(self._file(version)):
            raise UndefinedTableError(f"{self.path} has no version {version}" if self.exists() else f"no table at {self.path}")
        for attempt in range(5):
            try:
                return Meta.of(self._text(self._file(version)), self._chunk)
            except (json.JSONDecodeError, EOFError):  # on stores without atomic creation, a file being written
                if attempt == 4:
                    raise
                time.sleep(0.1 * 2**attempt)
        raise AssertionError

    def _put(self, meta: Meta) -> None:
        self.files.make(f"{self.path}/metadata")
        while len(meta.snapshots) - len(meta.chunks) * CHUNK >= CHUNK:
            name, start = f"snapshots-{uuid.uuid4().hex}.json", len(meta.chunks) * CHUNK
            self.files.put_new(f"{self.path}/metadata/{name}", self._packed(json.dumps(meta.snapshots[start : start + CHUNK])))
            meta = replace(meta, chunks=(*meta.chunks, name))
        self.files.put_new(self._file(meta.version), self._packed(meta.to_json()))
        _NEWEST[self.path] = meta.version

    def _commit(self, change: Callable[[Meta | None], Meta | None], load_id: str | None = None) -> Meta | None:
        """Compare-and-set with backoff: ``change`` makes the next version of the newest one, or None for nothing to do. Where
        it is unknown whether a version was written, it is looked for before the next attempt."""
        unsure: Meta | None = None
        for attempt in range(1, self.config.max_retries + 1):
            try:
                now = self.meta() if self.exists() else None
                if unsure and now and any(s["id"] == unsure.snapshots[-1]["id"] for s in now.snapshots):
                    return unsure
                if now and now.loaded(load_id):
                    return None
                new = change(now)
                if new is not None:
                    try:
                        self._put(new)
                    except CommitStateUnknownError:
                        unsure = new
                        raise
                return new
            except Exception as e:
                log_error(e, "commit", self.path, attempt, self.config.max_retries, load_id=load_id)
                if not is_retryable(e) or attempt == self.config.max_retries:
                    raise
                time.sleep(min(self.config.retry_backoff_base ** (attempt - 1), 30) * (0.05 if isinstance(e, CommitConflictError) else 1))
        raise AssertionError

    # reading

    def _read(self, meta: Meta, parts: Sequence[Part]) -> DataFrame:
        """Rows of data parts with their ``commit`` and partition folders' values, under the current schema."""
        folders = [T.StructField("commit", T.StringType())]
        folders += [T.StructField(f.folder, partitioning.value_type(f.transform, meta.schema[f.transform.column].dataType)) for f in meta.spec]
        columns = [T.StructField(f.name, f.dataType, True, f.metadata) for f in meta.schema]
        if not parts:
            return self.spark.createDataFrame([], T.StructType(columns + folders))
        out = None
        for hides in dict.fromkeys(p.hides for p in parts):
            marker = [] if hides is None or hides in meta.schema.names else [T.StructField(hides, T.TimestampNTZType())]
            schema = T.StructType(columns + marker + folders)
            df = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/commit={p.commit}" for p in parts if p.hides == hides])
            if hides is not None:
                df = df.where(F.col(f"`{hides}`").isNull())
            df = df.drop(hides) if marker else df
            out = df if out is None else out.unionByName(df)
        return out

    def scan(self, version: int | None = None, columns: Sequence[str] | None = None, where: Sequence[tuple[str, str, Any]] = (), folders: Sequence[Sequence[tuple[str, str, Any]]] = ()) -> DataFrame:
        """The rows of the current snapshot, or of an older version.

        ``where``: (column, =|<|<=|>|>=, value) terms, all of which must hold; they also pick the partition folders to be read. A time
        without a zone is UTC. ``folders``: lists of such terms that only pick folders: those in which all terms of any list may hold.
        """
        meta = self.meta(version)
        prune = self._pruner(meta, where)
        either = [self._pruner(meta, terms) for terms in folders]
        if either and all(x is not None for x in either):
            any_of = either[0]
            for x in either[1:]:
                any_of = any_of | x
            prune = any_of if prune is None else prune & any_of
        df = apply_deletes(self, meta, prune)
        for c, op, value in where:
            if c not in meta.schema.names or op not in ("=", "<", "<=", ">", ">="):
                raise ValidationError(f"can't filter by {c} {op}")
            v = partitioning.literal(value, meta.schema[c].dataType)
            x = F.col(f"`{c}`")
            df = df.where({"=": x == v, "<": x < v, "<=": x <= v, ">": x > v, ">=": x >= v}[op])
        names = list(columns) if columns is not None else meta.schema.names
        return df.select(*[F.col(f"`{n}`") for n in names])

    def _pruner(self, meta: Meta, where: Sequence[tuple[str, str, Any]]) -> Column | None:
        out = None
        for c, op, value in where:
            for f in meta.spec:
                if f.transform.column == c and (term := partitioning.prune(f.transform, meta.schema[c].dataType, op, value)) is not None:
                    out = term if out is None else out & term
        return out

    # writing

    def _write(self, df: DataFrame, meta_schema: T.StructType, spec: Sequence[PartitionField], commit: str, hides: str | None = None) -> tuple[int, int]:
        """Writes rows in one job; returns how many there are, and how many aren't hidden. Partitioned rows are dealt by partition,
        large ones to several tasks."""
        rows = casting.require(df, meta_schema)
        seen = Observation()
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col(f"`{hides}`").isNull() if hides else F.lit(True)).alias("shown"))
        if spec:
            rows = partitioning.with_values(rows, spec)
            rows = rows.hint("rebalance", *[F.col(f"`{f.folder}`") for f in spec])
        writer = rows.write.mode("errorifexists")
        if spec:
            writer = writer.partitionBy(*[f.folder for f in spec])
        try:
            writer.parquet(f"{self.path}/data/commit={commit}")
        except Exception as e:
            found = translate(e)
            if found is e:
                raise
            raise found from e
        return int(seen.get["n"]), int(seen.get["shown"])

    def _write_keys(self, schema: T.StructType, keys: Sequence[str], commit: str) -> None:
        """The keys of a commit's rows, read back from what was written: so they are those rows' own."""
        kinds = T.StructType([T.StructField(k, schema[k].dataType) for k in keys])
        written = self.spark.read.schema(kinds).parquet(f"{self.path}/data/commit={commit}")
        written.distinct().write.mode("errorifexists").parquet(f"{self.path}/deletes/commit={commit}")

    def load(self, df: DataFrame, spec: TableSpec, load_id: str | None = None) -> Result:
        """Loads one batch as one snapshot: evolve, cast, write, commit. Repeating a load_id changes nothing."""
        now = self.meta() if self.exists() else None
        if now and now.loaded(load_id):
            return Result(now.version, None, repeated=True)
        incoming = table_schema(df.schema, spec.columns)
        schema = self._evolved(now, incoming)
        fields = now.spec if now else partitioning.build_spec(spec.columns, schema)
        keys = spec.merge_keys() if spec.kind == "merge" else []
        if spec.kind == "merge" and not keys:
            log.warning("merge into %s without a key: rows are appended", spec.name)
        if missing := [k for k in keys if k not in schema.names]:
            raise ValidationError(f"merge keys that aren't columns: {', '.join(missing)}")
        if keys and (outside := [f.transform.column for f in fields if f.transform.column not in keys]):
            raise ValidationError(f"partition columns must be part of the merge key: {', '.join(outside)}")
        rows = casting.cast_frame(df, schema, strict=self.config.strict_casting)
        marker = self.config.hard_delete_column
        hides = marker if keys and marker in rows.columns else None
        commit = uuid.uuid4().hex
        count, shown = self._write(rows, schema, fields, commit, hides)
        if keys and not count:
            self.files.remove(f"{self.path}/data/commit={commit}")
            return Result(now.version if now else 0, None)
        if keys:
            self._write_keys(schema, keys, commit)

        def change(newest: Meta | None) -> Meta:
            if (newest.schema if newest else None) != (now.schema if now else None) and self._evolved(newest, incoming) != schema:
                raise SchemaEvolutionError("the table's schema changed while the batch was written")
            base = newest or Meta(0, schema, {})
            wider = self._evolved(newest, incoming)
            adds = [_data(hides if shown < count else None)] * bool(shown) + [{"kind": "delete", "keys": list(keys), "hides": None}] * bool(keys)
            operation = "overwrite" if spec.kind == "replace" else ("merge" if keys else "append")
            return self._next(base, replace(base, schema=wider, spec=newest.spec if newest else fields), commit, operation, adds, (), spec.kind == "replace", load_id, {"inserted": shown})

        done = self._commit(change, load_id)
        if done is None:
            return Result(self.meta().version, None, repeated=True)
        return Result(done.version, commit, shown)

    def _evolved(self, now: Meta | None, incoming: T.StructType) -> T.StructType:
        if now is None:
            return incoming
        return evolution.evolve(now.schema, incoming, allow_upcast=self.config.allow_upcast, empty=not now.live)[0]

    def _next(self, base: Meta, new: Meta, commit: str, operation: str, adds: Sequence[dict] = (), drops: Sequence[str] = (), reset: bool = False, load_id: str | None = None, summary: dict | None = None) -> Meta:
        """The next version: ``adds`` to the live folders, after ``drops`` of commits' data, or of everything (``reset``)."""
        snap = {"id": commit, "parent": base.snapshots[-1]["id"] if base.snapshots else None, "seq": base.seq + 1, "operation": operation, "load_id": load_id, "at_ms": int(time.time() * 1000), "summary": summary or {}}
        snap |= {"adds": list(adds), "drops": list(drops), "reset": reset}
        return replace(new, version=base.version + 1, ids=_numbered(new.schema, base.ids), snapshots=[*base.snapshots, snap], chunks=base.chunks)

    def _rewrite(self, base: Meta, rows: DataFrame, operation: str, drops: Sequence[str] | None = None) -> Result:
        """Puts ``rows`` in the place of the data of ``drops``, or of all; fails if another commit came in between."""
        commit = uuid.uuid4().hex
        n, _ = self._write(rows.select(*[F.col(f"`{c}`") for c in base.schema.names]), base.schema, base.spec, commit)

        def change(newest: Meta | None) -> Meta:
            if newest is None or newest.version != base.version:
                raise ValidationError(f"{operation}: the table changed meanwhile")
            return self._next(base, base, commit, operation, [_data()] * bool(n), drops or (), drops is None, None, {"rows": n})

        return Result(self._commit(change).version, commit, n)

    def compact(self) -> Result:
        """One commit with the same rows, deletes applied."""
        base = self.meta()
        return self._rewrite(base, apply_deletes(self, base, None), "compact")

    def delete_where(self, condition: Column) -> Result:
        """Removes rows for which the condition is true; null isn't. Only commits that have such rows are written anew."""
        base = self.meta()
        hit = apply_deletes(self, base, None).where(condition).select("commit").distinct().collect()  # at most a name for each commit
        if not hit:
            return Result(base.version, None)
        only = {r["commit"] for r in hit}
        rows = apply_deletes(self, base, None, only).where(~F.coalesce(condition, F.lit(False)))
        return self._rewrite(base, rows, "delete", sorted(only))

    def truncate(self) -> Result:
        """An empty snapshot; schema, spec and history stay."""
        commit = uuid.uuid4().hex
        return Result(self._commit(lambda m: self._next(m, m, commit, "truncate", reset=True)).version, commit)

    def evolve(self, schema: T.StructType, allow_drops: bool = False) -> bool:
        """Changes the schema alone; True if it changed. Columns are dropped only on demand."""
        changed = False

        def change(m: Meta | None) -> Meta | None:
            nonlocal changed
            if m is None:
                return self._next(Meta(0, schema, {}), Meta(0, schema, {}), uuid.uuid4().hex, "create")
            new, changed = evolution.evolve(m.schema, table_schema(schema), allow_drops, self.config.allow_upcast, not m.live)
            return self._next(m, replace(m, schema=new), uuid.uuid4().hex, "schema") if changed else None

        self._commit(change)
        return changed

    def drop(self) -> bool:
        _NEWEST.pop(self.path, None)
        return self.files.remove(self.path)

    def expire(self, keep: int = 1) -> int:
        """Forgets all versions but the newest ``keep``, and removes the folders of commits that none of these reads; returns how
        many versions went. The list of snapshots stays, so known loads are still not repeated."""
        known = self.versions()
        kept = [self.meta(v) for v in known[-max(keep, 1) :]]
        needed = {p.commit for m in kept for p in m.live}
        for v in known[: -max(keep, 1)]:
            self.files.remove(self._file(v))
        for kind in ("data", "deletes"):
            there = set(self.files.names(f"{self.path}/{kind}"))
            for s in kept[-1].snapshots:
                if s["id"] not in needed and f"commit={s['id']}" in there:
                    self.files.remove(f"{self.path}/{kind}/commit={s['id']}")
        return max(0, len(known) - max(keep, 1))

    def orphans(self) -> list[str]:
        """Commit folders of no snapshot: what failed commits left, and commits that are still being written."""
        known = {s["id"] for s in self.meta().snapshots}
        return [f"{self.path}/{d}/{n}" for d in ("data", "deletes") for n in self.files.names(f"{self.path}/{d}") if n.startswith("commit=") and n[7:] not in known]

    def remove_orphans(self, older_than: float = 86_400.0) -> list[str]:
        """Removes orphans that haven't changed for so many seconds."""
        old = [p for p in self.orphans() if self.files.age(p) >= older_than]
        for p in old:
            self.files.remove(p)
        return old


def _data(hides: str | None = None) -> dict[str, Any]:
    return {"kind": "data", "keys": [], "hides": hides}
