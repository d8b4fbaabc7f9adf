"""Snapshot tables over Parquet for Spark, loaded in atomic batches and read as DataFrames or SQL."""

from .errors import CastingError, LakeError, SchemaEvolutionError, UndefinedTableError, ValidationError
from .plans import partitioning as partition
from .plans.partitioning import Transform
from .spec import Config, TableSpec, with_partitioning
from .store import Table
from .streaming.sink import write_stream
from .warehouse import Dataset, LoadPackage, Warehouse

__all__ = ["CastingError", "Config", "Dataset", "LakeError", "LoadPackage", "SchemaEvolutionError", "Table", "TableSpec", "Transform", "UndefinedTableError", "ValidationError", "Warehouse", "partition", "with_partitioning", "write_stream"]
