"""Structured Streaming into tables: each micro-batch is one load, whose id repeats when the batch is replayed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..spec import TableSpec
from ..warehouse import Warehouse


def load_batch(warehouse: Warehouse, spec: TableSpec, name: str, batch: DataFrame, batch_id: int) -> None:
    """The body of foreachBatch; a replayed batch id changes nothing. Later commits win over earlier ones, whatever their rows'
    own times."""
    warehouse.load(spec, batch, f"{name}:{batch_id}")
    warehouse.record_load(f"{name}:{batch_id}", name)


def write_stream(stream: DataFrame, warehouse: Warehouse, spec: TableSpec, name: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Starts a query that loads each micro-batch exactly once. By default it reads what is there and ends."""
    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).foreachBatch(lambda batch, i: load_batch(warehouse, spec, name, batch, i)).start()
