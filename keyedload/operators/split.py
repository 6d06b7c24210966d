"""Split points of ordered keys from the data: a quantile summary, merged over tasks.

Every task sorts its keys batch by batch and keeps about as many steps of each as the wanted precision needs, with the rows that
a step stands for. Such summaries are rows again: they are dealt to fewer tasks and summed up the same way, level by level,
until one task's worth is left. A batch adds at most the rows of one step to the error, however many batches there are. No key is
sampled, and a key with a third of all rows is one step with their number.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyedload.functions.convert import bad_columns, convert_columns
from keyedload.functions.names import col
from keyedload.sources.store import scratch_root
from keyedload.spec import LoadError, TableSpec

# Steps of a batch for each range, at an error of one.
STEPS_PER_RANGE = 12
# Rows of a batch for each of its steps; one of this many bytes ends sooner.
ROWS_PER_STEP = 64
BATCH_BYTES = 64 << 20
WEIGHT = "_only_rows"


def ordered_split_points(df: DataFrame, spec: TableSpec, ranges: int, error: float = 0.1) -> tuple:
    """Points that cut the partition keys of ``df`` into at most ``ranges`` ranges, for ``LoadConf("ordered", split_points=...)``.

    The largest range of several keys is as small as cuts allow, give or take ``error`` of an even one (up to some 10^13 rows); so
    without frequent keys none has over ``(1 + error) / ranges`` of the rows. A key with more rows than that begins a range, with
    at most ``error`` of an even one besides. Rows that a load refuses or sets aside for their key do not count. Without rows
    there are no points.
    """
    if ranges < 1 or not 0 < error <= 1:
        raise ValueError("ranges must be at least 1, and error between 0 and 1")
    kinds = {c: spec.type_of(c) for c in spec.partition_key}
    odd = [c for c, t in kinds.items() if isinstance(t, (T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
    if odd:
        raise LoadError(f"{spec.full_name}: keys of type {kinds[odd[0]].simpleString()} cannot be split points")
    names = [f"k{i}" for i in range(len(kinds))]
    bad = bad_columns(df, spec, list(kinds))
    good = F.lit(True) if bad is None else F.size(bad) == 0
    for c in kinds:
        good = good & col(c).isNotNull()
    keys = df.select(*[F.when(good, v).alias(n) for n, v in zip(names, convert_columns(df, spec, list(kinds)).values())])
    for n in names:
        keys = keys.where(F.col(n).isNotNull())
    keys = keys.withColumn(WEIGHT, F.lit(1).cast("bigint"))
    # Half of the error for the levels below, half for the last choice.
    steps = math.ceil(2 * STEPS_PER_RANGE * ranges / error)
    scratch, level = scratch_root(df.sparkSession), 0
    while True:
        path = f"{scratch}/level-{level}"
        keys.mapInArrow(_summaries(names, steps), keys.schema).write.parquet(path)
        keys = df.sparkSession.read.schema(keys.schema).parquet(path)
        left = keys.count()
        if left <= 2 * steps:
            break
        level += 1
        keys = keys.repartition(-(-left // (steps * ROWS_PER_STEP)))
    # At most 2 * steps rows, a number that ``ranges`` and ``error`` set.
    found = _summed(keys.toArrow(), names)
    values = list(zip(*[found.column(n).to_pylist() for n in names]))
    points = _cuts(found.column(WEIGHT).to_pylist(), ranges)
    out = [tuple(_point(v) for v in values[i]) for i in points]
    out = [p for p in out if not any(isinstance(v, float) and not math.isfinite(v) for v in p)]
    return tuple(p[0] if len(p) == 1 else p for p in out)


def _summed(rows: pa.Table, names: list[str]) -> pa.Table:
    """Distinct keys in order, with their rows."""
    sums = rows.group_by(names).aggregate([(WEIGHT, "sum")]).rename_columns([*names, WEIGHT])
    return sums.sort_by([(n, "ascending") for n in names])


def _steps(rows: pa.Table, names: list[str], steps: int) -> pa.Table:
    """Of the distinct keys in order those at which another step is full, and the last; each with the rows since the one before."""
    found = _summed(rows, names)
    if found.num_rows <= steps:
        return found
    upto = pc.cumulative_sum(found.column(WEIGHT)).to_numpy()
    full = upto // -(-upto[-1] // steps)
    ends = np.union1d(np.flatnonzero(np.diff(full, prepend=0)), len(full) - 1)
    kept = found.take(pa.array(ends))
    sums = np.diff(upto[ends], prepend=0)
    return kept.set_column(kept.schema.get_field_index(WEIGHT), WEIGHT, pa.array(sums, pa.int64()))


def _summaries(names: list[str], steps: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for b in batches:
            held.append(b)
            rows, size = rows + b.num_rows, size + b.nbytes
            if rows >= steps * ROWS_PER_STEP or (rows >= 4 * steps and size >= BATCH_BYTES):
                yield from _steps(pa.Table.from_batches(held), names, steps).to_batches()
                held, rows, size = [], 0, 0
        if rows:
            yield from _steps(pa.Table.from_batches(held), names, steps).to_batches()

    return work


def _cuts(weights: list[int], ranges: int) -> list[int]:
    """Where ranges begin, but the first: at most ``ranges`` of them, the largest of several keys as small as can be."""

    def begun(most: int) -> list[int]:
        out, held = [], 0
        for i, w in enumerate(weights):
            if held and held + w > most:
                out.append(i)
                held = 0
            held += w
        return out

    low, high = 1, sum(weights)
    while low < high:
        middle = (low + high) // 2
        if len(begun(middle)) < ranges:
            high = middle
        else:
            low = middle + 1
    return begun(low)


def _point(value) -> int | float | str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return str(value) if isinstance(value, decimal.Decimal) else value
