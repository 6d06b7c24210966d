"""Write options: time to live and write timestamp, static or per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyedload.functions.convert import convert
from keyedload.spec import EXPIRES, WRITTEN, WTS, LoadConf


def per_row_options(df: DataFrame, conf: LoadConf, micros: int) -> dict[str, Column]:
    """Columns that must travel with the row: ``_wts`` and ``_expires_at`` from input columns.

    A null timestamp means the load's own; a null or zero ttl means no expiry; a negative one raises.
    """
    out = {}
    if isinstance(conf.timestamp, str):
        given = convert(conf.timestamp, df.schema[conf.timestamp].dataType, T.LongType())
        out[WTS] = F.coalesce(given, F.lit(micros).cast("bigint")).alias(WTS)
    if isinstance(conf.ttl, str):
        ttl = convert(conf.ttl, df.schema[conf.ttl].dataType, T.IntegerType())
        problem = F.raise_error(F.concat(F.lit("negative ttl: "), ttl.cast("string"))).cast("bigint")
        expires = F.when(ttl > 0, F.lit(micros // 1_000_000).cast("bigint") + ttl).when(ttl < 0, problem)
        out[EXPIRES] = expires.alias(EXPIRES)
    return out


def with_static_options(df: DataFrame, conf: LoadConf, micros: int, written: list[str] | None) -> DataFrame:
    """Add what is equal in all rows. Done after the shuffle, so the constants do not travel."""
    if not isinstance(conf.timestamp, str):
        wts = micros if conf.timestamp is None else conf.timestamp
        df = df.withColumn(WTS, F.lit(wts).cast("bigint"))
    if isinstance(conf.ttl, int) and conf.ttl > 0:
        df = df.withColumn(EXPIRES, F.lit(micros // 1_000_000 + conf.ttl).cast("bigint"))
    if written is not None:
        df = df.withColumn(WRITTEN, F.array(*[F.lit(c) for c in written]))
    return df


def has_ttl(conf: LoadConf) -> bool:
    return isinstance(conf.ttl, str) or bool(conf.ttl)
