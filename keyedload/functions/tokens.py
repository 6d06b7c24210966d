"""Placement: token of a key, the range that owns a token, the replicas of a range.

All of it is plain column arithmetic, evaluated in the scan stage; no lookup table is joined.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from keyedload.functions.names import col

SEPARATOR = "\u0001"


def hash_token(partition_key: Sequence[str]) -> Column:
    """Signed 64-bit hash of the partition key."""
    return F.xxhash64(*[col(c) for c in partition_key])


def md5_token(partition_key: Sequence[str], instants: Collection[str] = (), floats: Mapping[str, str] = {}) -> Column:
    """Top 60 bits of the MD5 digest of the partition key, a number in [0, 2**60).

    ``instants`` are the key columns of type timestamp: their text would depend on the session's
    zone, so their microseconds are taken. ``floats`` are those of a float type, by name: zeros of either sign are equal
    and must lie together.
    """

    def shown(c: str) -> Column:
        if c in instants:
            return F.unix_micros(col(c))
        return col(c) + F.lit(0.0).cast(floats[c]) if c in floats else col(c)

    values = [shown(c) for c in partition_key]
    text = F.concat_ws(SEPARATOR, *[v.cast("string") for v in values])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def token(
    partitioner: str, partition_key: Sequence[str], instants: Collection[str] = (), floats: Mapping[str, str] = {}
) -> Column | None:
    """Token column of a partitioner; None where the key itself is the token."""
    if partitioner == "hash":
        return hash_token(partition_key)
    if partitioner == "bucketed":
        # What Spark's buckets are made of.
        return F.hash(*[col(c) for c in partition_key]).cast("bigint")
    if partitioner == "md5":
        return md5_token(partition_key, instants, floats)
    return None


def even_range(partitioner: str, token_col: Column, ranges: int) -> Column:
    """Index of the token among ``ranges`` equal parts of the partitioner's token space.

    Works on the top 32 bits of the token, so the product stays in 64 bits.
    """
    if partitioner == "hash":
        top = F.shiftright(token_col, 32) + F.lit(2**31)
    else:
        top = F.shiftright(token_col, 28)
    return F.shiftright(top * F.lit(ranges).cast("bigint"), 32).cast("int")


def ring_range(token_col: Column, bounds: Sequence[int]) -> Column:
    """Index of the range [bound, next bound) that holds the token.

    The ring is closed: a token below the first bound belongs to the last range.
    """
    starts = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    return F.pmod(not_above(starts, len(bounds), token_col) - F.lit(1), F.lit(len(bounds))).cast("int")


def not_above(ascending: Column, size: int, value: Column) -> Column:
    """How many of a constant array's ascending entries are at most ``value``, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(size.bit_length()))])

    def step(found: Column, width: Column) -> Column:
        reached = found + width
        return F.when((reached <= size) & (F.get(ascending, reached - F.lit(1)) <= value), reached).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)


def split_range(key_cols: Sequence[Column], split_points: Sequence, types: Sequence) -> Column:
    """Index of the key range cut at the split points: 0 lies below the first point."""
    if not split_points:
        return F.lit(0)
    points = [p if isinstance(p, tuple) else (p,) for p in split_points]
    width = len(points[0])
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(key_cols[:width])])
    starts = F.array(
        *[F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(p, types))]) for p in points]
    )
    return not_above(starts, len(points), key).cast("int")


def ring_replicas(range_col: Column, ranges: int, copies: int) -> Column:
    """Owners of a range: its own node and the next nodes on the ring."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(min(copies, ranges) - 1)),
        lambda i: F.pmod(range_col + i, F.lit(ranges)).cast("int"),
    )
