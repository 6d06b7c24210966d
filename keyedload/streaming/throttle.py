"""Loads at a capped rate: a streamed file source, one load per micro-batch."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from keyedload.operators.load import Mapper, bulk_load
from keyedload.sources.store import KeyedStore
from keyedload.spec import LoadConf


def throttled_files(
    spark: SparkSession, path: str, schema: T.StructType, conf: LoadConf, format: str = "parquet", **options
) -> DataFrame:
    """Files as a stream of at most ``conf.bytes_per_trigger`` bytes per micro-batch.

    The limit is soft: a file that is larger is still taken whole.
    """
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if conf.throttled:
        reader = reader.option("maxBytesPerTrigger", conf.bytes_per_trigger)
    return reader.load(path)


def stream_load(
    store: KeyedStore,
    stream: DataFrame,
    keyspace: str,
    table: str,
    checkpoint: str,
    columns: Sequence | None = None,
    conf: LoadConf | None = None,
    *,
    mapper: Mapper | None = None,
    positional: bool = False,
    load_epoch: int | None = None,
    stream_id: str | None = None,
) -> StreamingQuery:
    """Start a query that loads every micro-batch of ``stream``, one batch per trigger interval.

    The load id is the stream's id and the batch number. A batch replayed after a failure overwrites
    its own unpublished files, or is passed over when it had been published already.
    """
    conf = LoadConf.from_spark(store.spark) if conf is None else conf
    stream_id = hashlib.md5(checkpoint.encode()).hexdigest() if stream_id is None else stream_id
    store.spec(keyspace, table)  # fails at once where there is no such table
    uncapped = replace(conf, bytes_per_trigger=None)

    def load_batch(batch: DataFrame, number: int) -> None:
        bulk_load(
            store,
            batch,
            keyspace,
            table,
            columns,
            uncapped,
            mapper=mapper,
            positional=positional,
            load_id=f"{stream_id}-{number}",
            load_epoch=load_epoch,
            if_published="skip",
        )

    return (
        stream.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{conf.trigger_seconds} seconds")
        .start()
    )
