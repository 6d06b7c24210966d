"""What the operators share: row identity, splits by checksum, folders all executors see, whole-text iteration."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.sources.store import scratch_root

# Texts of one Arrow batch; long documents make batches large, so few of them travel together.
BATCH_ROWS = 512
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession, what: str) -> str:
    """A fresh folder that the driver and all executors see (``spark.checkpoint.dir``)."""
    return f"{scratch_root(spark)}/{what}"


def staged(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and it outlives executors."""
    path = shared_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> None:
    """Lets Python workers of this machine import the package from where the driver has it, and keeps Arrow batches of
    texts small in the JVM too, unless the session asks for a size of its own."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_remainder(doc_id: str, modulus: int) -> Column:
    """CRC32 of the id's text modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)).cast("int")


def text_of(name: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, rows: int = BATCH_ROWS
) -> DataFrame:
    """``mapInArrow`` that hands ``work`` slices of at most ``rows`` rows, whatever the session's batch size is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return work(b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows))

    prepare(df.sparkSession)
    return df.mapInArrow(run, schema)


def batch(columns: dict[str, pa.Array | list], types: dict[str, pa.DataType] | None = None) -> pa.RecordBatch:
    """A record batch from columns by name; ``types`` where a list needs one."""
    types = types or {}
    arrays = [v if isinstance(v, pa.Array) else pa.array(v, types.get(k)) for k, v in columns.items()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))
