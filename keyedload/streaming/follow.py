"""Progress of real loads, from the files they write.

A load's files appear in its directory, at once or, under a cap, slice by slice. A file stream sees each of them once; a stateful
operator adds them up per load and bucket, so progress can be followed while the load runs, by another application too. The
same files give the events that ``operators/progress.py`` measures.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from keyedload.sources.store import KeyedStore
from keyedload.spec import ATTEMPT, BUCKET, LOAD_ID

PROGRESS = "load_id string, attempt string, peer string, files bigint, bytes bigint, started timestamp, latest timestamp, bytes_per_second double"
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_STATE = "files bigint, bytes bigint, started timestamp, latest timestamp"


def _of_path(name: str) -> Column:
    return F.regexp_extract("path", rf"{name}=([^/]+)", 1)


def _described(files: DataFrame) -> DataFrame:
    """``load_id, attempt, peer, ts, file, bytes`` of the data files; a peer is a bucket."""
    bucket = _of_path(BUCKET)
    # The files of Spark's buckets have the bucket in their names.
    named = F.regexp_extract("path", r"_(\d+)\.c\d+", 1).cast("int").cast("string")
    return files.select(
        _of_path(LOAD_ID).alias(LOAD_ID),
        _of_path(ATTEMPT).alias("attempt"),
        F.when(bucket != "", bucket).otherwise(named).alias("peer"),
        F.col("modificationTime").alias("ts"),
        F.col("path").alias("file"),
        F.col("length").alias("bytes"),
    )


def written_files(store: KeyedStore, keyspace: str, table: str, partitioner: str | None = None, **options) -> DataFrame:
    """A stream of the files that loads of a table write, each once and without their content. The table has a load already, or
    its directory is there."""
    path = store.data_path(store.spec(keyspace, table), partitioner=partitioner)
    reader = store.spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", True).options(**options)
    return _described(reader.option("pathGlobFilter", "*.parquet").load(path))


def followed(files: DataFrame) -> DataFrame:
    """Files and bytes so far of every load, attempt and bucket, and their mean rate: a row whenever files have come.

    What is kept of a bucket is four numbers, however many files it has.
    """

    def add(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        count, size, started, latest = state.get if state.exists else (0, 0, None, None)
        for p in parts:
            count, size = count + len(p), size + int(p["bytes"].sum())
            started = p["ts"].min() if started is None else min(started, p["ts"].min())
            latest = p["ts"].max() if latest is None else max(latest, p["ts"].max())
        state.update((count, size, started, latest))
        seconds = max((latest - started).total_seconds(), 0.001)
        values = [*key, count, size, started, latest, size / seconds]
        yield pd.DataFrame([values], columns=["load_id", "attempt", "peer", "files", "bytes", "started", "latest", "bytes_per_second"])

    by = files.select(LOAD_ID, "attempt", "peer", "ts", "bytes").groupBy(LOAD_ID, "attempt", "peer")
    return by.applyInPandasWithState(add, PROGRESS, _STATE, "update", GroupStateTimeout.NoTimeout)


def load_events(store: KeyedStore, keyspace: str, table: str) -> DataFrame:
    """The events of all published loads: each bucket of a load announces its files and bytes, sends them one by one, and is
    complete with the last. No file is opened."""
    spec = store.spec(keyspace, table)
    loads = [r for r in store.published(spec) if r.rows or r.rejected]
    paths = [store.data_path(spec, r.load_id, r.attempt, r.partitioner) for r in loads]
    if not paths:
        paths = [f"{store.table_path(keyspace, table)}/spec"]  # no data files there
    reader = store.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files = _described(reader.load(paths))

    def events(df: DataFrame, kind: str, success: Column, file: Column, current: Column, total: Column, number: Column) -> DataFrame:
        return df.select(
            LOAD_ID,
            "ts",
            F.lit(kind).alias("kind"),
            "peer",
            F.lit(0).alias("session"),
            success.cast("boolean").alias("success"),
            file.cast("string").alias("file"),
            current.cast("bigint").alias("current_bytes"),
            total.cast("bigint").alias("total_bytes"),
            number.cast("bigint").alias("total_files"),
        )

    none = F.lit(None)
    sums = files.groupBy(LOAD_ID, "peer").agg(
        F.min("ts").alias("ts"), F.max("ts").alias("_end"), F.sum("bytes").alias("_bytes"), F.count("*").alias("_files")
    )
    prepared = events(sums, "prepared", none, none, none, F.col("_bytes"), F.col("_files"))
    sent = events(files, "progress", none, F.col("file"), F.col("bytes"), F.col("bytes"), none)
    complete = events(sums.withColumn("ts", F.col("_end")), "complete", F.lit(True), none, none, none, none)
    return prepared.unionByName(sent).unionByName(complete)
