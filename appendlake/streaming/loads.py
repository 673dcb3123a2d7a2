"""Load range files as a stream over the log of copies.

Every copy run appends its ranges to the log, so the log is a source of new files
with offsets that end at record ends. The stream's checkpoint remembers which log
rows were handled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from appendlake.config import LakeConfig
from appendlake.operators import ledger
from appendlake.operators.sets import absent_from
from appendlake.plans.loading import load_files, log_finished
from appendlake.sinks import Sink


def range_stream(spark: SparkSession, config: LakeConfig, entity: str) -> DataFrame:
    """Streaming relation of the entity's copied range files, each once."""
    ledger.ensure_logs(spark, config)
    return (
        spark.readStream.table(config.copies)
        .where((F.col("entity") == entity) & (F.col("outcome") == ledger.DONE))
        .select("target", (F.col("stop") - F.col("start")).alias("bytes"))
    )


def stream_load(
    spark: SparkSession,
    config: LakeConfig,
    entity: str,
    schema: T.StructType,
    sink: Sink,
    checkpoint: str,
    mode: str = ledger.APPEND,
    interval: str | None = None,
    **options,
) -> StreamingQuery:
    """Start loading new range files; stops when all are loaded unless ``interval`` is given.

    A batch that is run again after a failure skips the files the load log
    already names, so it adds no row twice.
    """
    if mode == ledger.FULL:
        raise ValueError("a stream appends or upserts; a full load is a batch job")
    ledger.check_mode(mode)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        log_finished(session, config, entity, sink)
        new = batch.groupBy("target").agg(F.max("bytes").alias("bytes"))
        files = absent_from(new, ledger.loaded(session, config, entity), ["target"])
        load_files(session, config, files, entity, schema, sink, mode, **options)

    writer = (
        range_stream(spark, config, entity)
        .writeStream.queryName(f"load_{entity}")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(load_batch)
    )
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()
