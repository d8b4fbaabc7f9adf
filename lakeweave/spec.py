"""How a table is to be loaded, and the warehouse's options."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from .errors import ConfigError, ValidationError
from .plans import partitioning

DISPOSITIONS = ("append", "replace", "merge")
STRATEGIES = ("upsert", "delete-insert")
#: Tables with this prefix are the engine's own.
INTERNAL = "_lw_"


@dataclass(frozen=True)
class TableSpec:
    """A table's declaration. ``columns``: hints by column (nullable, description, primary_key, partition, ...)."""

    name: str
    disposition: str | Mapping[str, str] = "append"
    primary_key: str | Sequence[str] | None = None
    merge_key: str | Sequence[str] | None = None
    columns: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in DISPOSITIONS:
            raise ValidationError(f"unknown write disposition: {self.kind}")
        if self.kind == "merge" and self.strategy not in STRATEGIES:
            raise ValidationError(f"unknown merge strategy: {self.strategy}")

    @property
    def kind(self) -> str:
        return self.disposition if isinstance(self.disposition, str) else self.disposition.get("disposition", "merge")

    @property
    def strategy(self) -> str:
        """Both strategies do the same: rows of earlier commits with a key of the batch go, the batch's rows come."""
        return "upsert" if isinstance(self.disposition, str) else self.disposition.get("strategy", "delete-insert")

    def merge_keys(self) -> list[str]:
        """The primary key, else the merge key, else the columns flagged as key; empty means append."""
        for keys in (self.primary_key, self.merge_key):
            if keys:
                return [keys] if isinstance(keys, str) else list(keys)
        return [n for n, h in self.columns.items() if h.get("primary_key") or h.get("x-primary-key")]


def with_partitioning(spec: TableSpec, partition: Any) -> TableSpec:
    """The spec with partition hints: a column name, a transform of ``plans.partitioning``, or several."""
    hints = partitioning.hints_for(partition)
    if not hints:
        return spec
    columns = {n: dict(h) for n, h in spec.columns.items()}
    for n, h in hints.items():
        columns[n] = columns.get(n, {}) | h
    return replace(spec, columns=columns)


@dataclass(frozen=True)
class Config:
    """Options of a warehouse. Connection options other than S3's are for an external catalogue (see ``sources.catalogs``)."""

    warehouse: str
    namespace: str = "default"
    max_retries: int = 5
    retry_backoff_base: float = 2.0
    strict_casting: bool = False
    allow_upcast: bool = False
    merge_batch_size: int | None = None  # accepted, without effect: merges are never cut by rows
    table_location_layout: str | None = None
    register_new_tables: bool = False
    hard_delete_column: str | None = "_deleted_at"
    internal_table_prefix: str = INTERNAL
    metadata_gzip: bool = False
    catalog_uri: str | None = None
    credential: str | None = None
    oauth2_server_uri: str | None = None
    scope: str = "PRINCIPAL_ROLE:ALL"
    token: str | None = None
    sigv4_enabled: bool = False
    signing_region: str | None = None
    signing_name: str = "execute-api"
    s3_endpoint: str | None = None
    s3_access_key_id: str | None = None
    s3_secret_access_key: str | None = None
    s3_region: str | None = None
    io_impl: str | None = None

    def __post_init__(self) -> None:
        if not self.warehouse:
            raise ConfigError("a warehouse folder is needed")
        if self.max_retries < 1:
            raise ConfigError("max_retries must be 1 or more")
        if not self.internal_table_prefix.rstrip("_"):
            raise ConfigError("internal_table_prefix must not be empty")

    def physical_name(self, table: str) -> str:
        """Internal tables carry the configured prefix; others keep their name."""
        return f"{self.internal_table_prefix.rstrip('_')}_{table[len(INTERNAL):]}" if table.startswith(INTERNAL) else table

    def is_internal(self, physical: str) -> bool:
        return physical.startswith(self.internal_table_prefix.rstrip("_") + "_")

    def location(self, table: str, namespace: str | None = None) -> str:
        """The table's folder. A layout may use {namespace}, {dataset_name} and {table_name}; relative ones stand in the warehouse."""
        names = {"namespace": namespace or self.namespace, "dataset_name": namespace or self.namespace, "table_name": self.physical_name(table)}
        if not self.table_location_layout:
            return f"{self.warehouse.rstrip('/')}/{names['namespace']}/{names['table_name']}"
        try:
            path = self.table_location_layout.format(**names)
        except (KeyError, IndexError) as e:
            raise ConfigError(f"table_location_layout has an unknown field: {e}") from e
        absolute = re.match(r"[a-z][a-z0-9+.-]*://|/", path)
        return path if absolute else f"{self.warehouse.rstrip('/')}/{path}"
