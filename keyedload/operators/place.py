"""Placement and order: token, owning bucket, writer slice, clustering of the rows.

One shuffle. It is a REBALANCE on the writer slice, so adaptive execution cuts a slice that is too
big for one task (a hot partition key, even a single hot primary key) into several and joins small
ones; every task then sorts its own rows by bucket, token and key.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyedload.functions.names import col
from keyedload.functions.tokens import even_range, ring_range, split_range, token
from keyedload.spec import BUCKET, REJECTED, TOKEN, LoadConf, LoadError, TableSpec

SLICE = "_slice"
# Bucket of rows that a load sets aside.
ASIDE = -1


def with_placement(df: DataFrame, spec: TableSpec, conf: LoadConf) -> DataFrame:
    """Add ``_token`` (not for ordered keys), ``_bucket`` and ``_slice``."""
    k = conf.writers_per_bucket or 1
    if conf.partitioner == "ordered":
        types = [spec.type_of(c) for c in spec.partition_key]
        bucket = split_range([col(c) for c in spec.partition_key], conf.split_points, types)
        return df.withColumn(BUCKET, bucket).withColumn(SLICE, _key_slice(spec, k))
    instants = [c for c in spec.partition_key if isinstance(spec.type_of(c), T.TimestampType)]
    kinds = {c: spec.type_of(c) for c in spec.partition_key}
    floats = {c: t.simpleString() for c, t in kinds.items() if isinstance(t, (T.FloatType, T.DoubleType))}
    df = df.withColumn(TOKEN, token(conf.partitioner, spec.partition_key, instants, floats))
    if conf.partitioner == "bucketed":
        if floats:
            raise LoadError(f"{spec.full_name}: a key of type float or double has no Spark buckets")
        bucket = F.pmod(F.col(TOKEN), F.lit(conf.buckets)).cast("int")
        return df.withColumn(BUCKET, bucket).withColumn(SLICE, _key_slice(spec, k))
    if conf.ring is not None:
        return df.withColumn(BUCKET, ring_range(F.col(TOKEN), conf.ring)).withColumn(SLICE, _key_slice(spec, k))
    # Slices of an even bucket are token ranges too, so files of one bucket overlap less. Adaptive execution joins small ones.
    if conf.writers_per_bucket is None:
        k = -(-int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // conf.buckets)
    df = df.withColumn(SLICE, even_range(conf.partitioner, F.col(TOKEN), conf.buckets * k))
    return df.withColumn(BUCKET, F.expr(f"cast({SLICE} div {k} as int)"))


def _key_slice(spec: TableSpec, k: int) -> Column:
    """Slice of a bucket by the whole primary key."""
    if k == 1:
        return F.col(BUCKET)
    salt = F.pmod(F.xxhash64(*[col(c) for c in spec.key]), F.lit(k))
    return (F.col(BUCKET) * F.lit(k) + salt).cast("int")


def sort_order(spec: TableSpec, conf: LoadConf) -> list[Column]:
    """Order of rows inside a file: bucket, token, partition key, clustering columns."""
    order = [F.col(BUCKET).asc()]
    if conf.partitioner != "ordered":
        order.append(F.col(TOKEN).asc())
    order += [col(c).asc() for c in spec.partition_key]
    order += [col(c).asc() if d == "asc" or conf.partitioner == "bucketed" else col(c).desc() for c, d in spec.clustering]
    return order


def clustered(df: DataFrame, spec: TableSpec, conf: LoadConf) -> DataFrame:
    """Move every row to a writer of its bucket and sort it there."""
    placed = with_placement(df, spec, conf)
    if REJECTED in df.columns:
        # Rows set aside have no place of their own; they are dealt over as many slices as others are, before them all.
        names = [f.name for f in df.schema[REJECTED].dataType.fields if "map<" not in f.dataType.simpleString()]
        spread = F.pmod(F.xxhash64(*[F.col(REJECTED).getField(n) for n in names]), F.lit(bucket_count(conf))).cast("int")
        aside = F.col(REJECTED).isNotNull()
        placed = placed.withColumn(SLICE, F.when(aside, -1 - spread).otherwise(F.col(SLICE)))
        placed = placed.withColumn(BUCKET, F.when(aside, F.lit(ASIDE)).otherwise(F.col(BUCKET)))
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        warnings.warn("adaptive execution is off: one task writes each slice, however large a key makes it", stacklevel=3)
    dealt = placed.hint("rebalance", F.col(SLICE))
    # A write of Spark's buckets sorts by itself.
    return (dealt if conf.partitioner == "bucketed" else dealt.sortWithinPartitions(*sort_order(spec, conf))).drop(SLICE)


def bucket_count(conf: LoadConf) -> int:
    if conf.partitioner == "ordered":
        return len(conf.split_points) + 1
    return len(conf.ring) if conf.ring is not None else conf.buckets
