"""Load growing files as a stream, straight from where they grow."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from appendlake.config import LakeConfig
from appendlake.operators import ledger
from appendlake.plans.loading import load_rows
from appendlake.sinks import Sink
from appendlake.sources import growing


def stream_growth(
    spark: SparkSession,
    config: LakeConfig,
    entity: str,
    schema: T.StructType,
    sink: Sink,
    checkpoint: str,
    mode: str = ledger.APPEND,
    interval: str | None = None,
    batch_bytes: int | None = None,
    seen: Callable[[int], object] | None = None,
    **options,
) -> StreamingQuery:
    """Start loading what the entity's source files gain; each batch is one load in the log.

    No range files are made and the log of copies is not used: the state of the source
    lies with the checkpoint. A batch that is run again after a failure is known by its
    id in the log of loads and adds no row twice. Without ``interval`` one batch is loaded,
    of at most ``batch_bytes``; ``load_growth`` goes on until nothing is new. ``seen`` is
    called with the number of each batch that is through.
    """
    if mode == ledger.FULL:
        raise ValueError("a stream appends or upserts; a full load is a batch job")
    ledger.check_mode(mode)
    ledger.ensure_logs(spark, config)
    state = f"{checkpoint.rstrip('/')}/growing"
    limits = {"file_bytes": config.chunk_bytes} | ({"batch_bytes": batch_bytes} if batch_bytes else {})
    rows = growing.read_growing(spark, f"{config.source_root}/{entity}", schema, state, keep_corrupt=True, **limits)
    stream_id, done = _stream_id(state), []

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session, load_id = batch.sparkSession, f"{stream_id}-{batch_id}"
        # Only the first batch of a start can have been run before.
        if done or ledger.log(session, config.loads).where(ledger.is_load(load_id)).isEmpty():
            load_rows(session, config, batch, entity, sink, mode, load_id=load_id, **options)
        done[:] = [batch_id]
        if seen:
            seen(batch_id)

    writer = rows.writeStream.queryName(f"growth_{entity}").option("checkpointLocation", checkpoint).foreachBatch(load_batch)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def load_growth(*args, **options) -> int:
    """Load with ``stream_growth`` until no file has new bytes; the number of batches it took.

    One start runs all batches, each of bounded size, one after another. A source of this
    kind is asked once per start with ``availableNow``, which costs a start per batch.
    """
    loaded: list[int] = []
    query = stream_growth(*args, **options, interval="0 seconds", seen=loaded.append)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return len(loaded)


def _stream_id(state: str) -> str:
    """An id of the checkpoint, so that batch numbers of another one are not taken for its own."""
    found = growing.get(f"{state}/id")
    if found is None:
        growing.put(f"{state}/id", uuid.uuid4().hex.encode())
        found = growing.get(f"{state}/id")
    return found.decode()
