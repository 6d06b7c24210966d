"""Read a table: merge the mutation rows of all published loads into current rows.

Rules, per cell: the highest write timestamp wins; at equal timestamps a delete (null) wins, then the
larger value. A cell whose newest value has expired reads as null and does not uncover an older one.
A row exists while its marker, or any of its cells, is alive.

The load log decides how much of that a read needs:

``direct``  one load without duplicate keys. A plain scan: no shuffle, all filters reach Parquet.
``overlay`` a base load without duplicate keys, and smaller other loads. Base rows whose key no other load
            has are taken as they are, by an anti join; where the other keys are counted and few it is
            a broadcast one, so the base is scanned but not shuffled. Only the rest is merged.
``latest``  loads without duplicate keys, of the same columns, with disjoint write timestamps. No
            ties, so the newest whole row wins: ``row_number() = 1``, at most one row per load and key.
``tied``    one write timestamp in all, all columns, no ttl: per cell null if any is null, else max.
``newest``  loads of the same columns, and few versions of every key. Only rows of a key's newest timestamp matter, found
            by ``rank() = 1``, which Spark also limits before the shuffle; their ties are then merged where they lie.
``cells``   the general case: ``max(struct(...))`` per cell.

Merging combines on the map side before its one shuffle, so a key with very many versions does not
overload a task. Where the log proves that keys have few versions, combining would gain nothing: then the
plain rows are shuffled, which are several times smaller than partly merged cells.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyedload.functions.names import col
from keyedload.operators.files import candidates, needed
from keyedload.operators.prune import only_partition, places_of
from keyedload.sources.store import KeyedStore, LogRow
from keyedload.spec import BUCKET, EXPIRES, LOAD_ID, NEVER, WRITTEN, WTS, LoadError, TableSpec

STRATEGIES = ("auto", "direct", "overlay", "latest", "tied", "newest", "cells")

# Rows are shuffled before they are merged when no key has more versions than this, and the average is low.
FEW_VERSIONS = 1000
FEW_ON_AVERAGE = 4

# A base load is read apart when it has at least so many times the rows of the other loads.
BASE_FACTOR = 4

# So many keys of fixed width get a broadcast hint: about 100 bytes each in the hash table, 100 MB in all. For more,
# Spark picks the join itself.
MAX_BROADCAST_KEYS = 1_000_000
MAX_BROADCAST_KEY_COLUMNS = 4
_FIXED_WIDTH = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


@dataclass(frozen=True)
class Facts:
    """What the log says about the mutation rows of a read."""

    loads: int
    distinct: bool
    same_columns: bool
    disjoint_times: bool
    one_time: bool
    has_ttl: bool
    few_versions: bool
    always: frozenset[str]  # columns every load has written
    ever: frozenset[str]  # columns some load has written
    base: str | None = None  # largest load without duplicate keys
    base_rows: int = 0
    others: tuple[LogRow, ...] = ()  # the loads but the base
    other_rows: int = 0
    others_hide_base: bool = False  # newer throughout, and of the same columns
    few_other_keys: bool = False  # proven to fit into memory
    together: bool = False  # rows of a partition key are read by one task


def facts_of(spec: TableSpec, loads: list[LogRow]) -> Facts:
    sets = [frozenset(r.columns) for r in loads]
    # Rows of a compacted load may lack some of its columns.
    whole = [s if r.whole else frozenset(spec.key) for r, s in zip(loads, sets)]
    times = sorted((r.min_wts, r.max_wts) for r in loads)
    candidates = [r for r in loads if r.distinct_keys] if len(loads) > 1 else []
    base = max(candidates, key=lambda r: r.rows, default=None)
    others = [r for r in loads if r is not base] if base else []
    other_rows = sum(r.rows for r in others)
    return Facts(
        loads=len(loads),
        distinct=all(r.distinct_keys for r in loads),
        same_columns=len(set(sets)) == 1 and whole == sets,
        disjoint_times=all(a[1] < b[0] for a, b in zip(times, times[1:])),
        one_time=bool(times) and times[0][0] == max(t[1] for t in times),
        has_ttl=any(r.has_ttl for r in loads),
        few_versions=_few_versions(loads),
        always=frozenset.intersection(*whole) if sets else frozenset(),
        ever=frozenset.union(*sets) if sets else frozenset(),
        base=base.load_id if base else None,
        base_rows=base.rows if base else 0,
        others=tuple(others),
        other_rows=other_rows,
        others_hide_base=bool(base) and len(set(sets)) == 1 and whole == sets and base.max_wts < min(r.min_wts for r in others),
        few_other_keys=_bounded(spec, other_rows),
    )


def _bounded(spec: TableSpec, rows: int) -> bool:
    """True when so many keys take little memory for sure; else Spark decides by what it measures."""
    fixed = all(isinstance(spec.type_of(c), _FIXED_WIDTH) for c in spec.key)
    return fixed and len(spec.key) <= MAX_BROADCAST_KEY_COLUMNS and rows <= MAX_BROADCAST_KEYS


def _few_versions(loads: list[LogRow]) -> bool:
    """True when the log bounds the versions of every key, and they are few."""
    if not loads or any(r.most_versions is None or r.keys is None for r in loads):
        return False
    average = sum(r.rows for r in loads) / max(r.keys for r in loads)
    return sum(r.most_versions for r in loads) <= FEW_VERSIONS and average <= FEW_ON_AVERAGE


def allowed_strategies(facts: Facts) -> list[str]:
    """Strategies that give the right rows for these loads, fastest first."""
    out = []
    if facts.distinct and facts.loads == 1:
        out.append("direct")
    # Base rows that need a merge are found by a second join; that pays when both are broadcast.
    may_overlay = facts.base is not None
    pays = facts.others_hide_base or facts.few_other_keys
    first = may_overlay and pays and facts.base_rows >= BASE_FACTOR * facts.other_rows
    if first:
        out.append("overlay")
    if facts.distinct and facts.same_columns and facts.disjoint_times:
        out.append("latest")
    if facts.one_time and facts.same_columns and not facts.has_ttl:
        out.append("tied")
    if facts.same_columns and facts.few_versions:
        out.append("newest")
    out.append("cells")
    if may_overlay and not first:
        out.append("overlay")
    return out


def read_table(
    store: KeyedStore, keyspace: str, table: str, as_of: int | None = None, strategy: str = "auto"
) -> DataFrame:
    """Current rows of a table at ``as_of`` (epoch seconds, default now).

    Loads that have expired by then are not opened, unless they hide what is alive, or a strategy is asked for.
    """
    spec = store.spec(keyspace, table)
    as_of = int(time.time()) if as_of is None else as_of
    loads = [r for r in store.published(spec) if r.rows]
    if strategy == "auto":
        loads = needed(loads, as_of)
    rows, facts = _rows_of(store, spec, loads)
    chosen = allowed_strategies(facts)[0] if strategy == "auto" else strategy
    if chosen in ("direct", "overlay") or not merged_by_bucket(loads):
        return resolve(rows, spec, facts, as_of, strategy)
    # Equally placed loads are merged bucket by bucket. Hot buckets are too much for one task each; their rows are shuffled.
    hot = sorted({b for r in loads for b in r.hot})
    even = store.bucketed(spec, loads)
    if not hot:
        return resolve(even, spec, replace(facts, together=True), as_of, strategy)
    is_hot = F.col(BUCKET).isin(hot)
    out = resolve(even.where(~is_hot), spec, replace(facts, together=True), as_of, strategy)
    return out.unionByName(resolve(rows.where(is_hot), spec, facts, as_of, strategy))


def merged_by_bucket(loads: list[LogRow]) -> bool:
    """Whether all loads lie in equally many Spark buckets, of which the hot ones are known."""
    placed = {(r.partitioner, r.buckets, r.hot is None) for r in loads}
    return len(placed) == 1 and placed <= {("bucketed", r.buckets, False) for r in loads}


def published_rows(store: KeyedStore, spec: TableSpec) -> tuple[DataFrame, Facts]:
    """Mutation rows of the published loads, and what the log says about them."""
    return _rows_of(store, spec, store.published(spec))


def _rows_of(store: KeyedStore, spec: TableSpec, loads: list[LogRow]) -> tuple[DataFrame, Facts]:
    loads = [r for r in loads if r.rows]
    return store.loads(spec, loads), facts_of(spec, loads)


def resolve(
    rows: DataFrame, spec: TableSpec, facts: Facts, as_of: int | None = None, strategy: str = "auto"
) -> DataFrame:
    """Merge mutation rows by the strategy asked for, or the fastest right one."""
    as_of = int(time.time()) if as_of is None else as_of
    allowed = allowed_strategies(facts)
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {', '.join(STRATEGIES)}")
    if strategy == "auto":
        strategy = allowed[0]
    elif strategy not in allowed:
        raise LoadError(f"{spec.full_name}: {strategy} would not give the right rows, possible are {allowed}")
    if strategy == "direct":
        return _whole_rows(rows, spec, facts, as_of)
    if strategy == "overlay":
        return _overlay(rows, spec, facts, as_of)
    if strategy == "latest":
        newest = Window.partitionBy(*[col(c) for c in spec.key]).orderBy(F.col(WTS).desc())
        ranked = rows.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1)
        return _whole_rows(ranked, spec, facts, as_of)
    if strategy == "tied":
        return _tied(rows, spec, facts)
    if strategy == "newest":
        newest = Window.partitionBy(*[col(c) for c in spec.key]).orderBy(F.col(WTS).desc())
        rows = rows.withColumn("_rank", F.rank().over(newest)).where(F.col("_rank") == 1)
        # Rows of a key are together already.
        facts = replace(facts, few_versions=False)
        return _cells(rows, spec, facts, as_of) if facts.has_ttl else _tied(rows, spec, facts)
    return _cells(rows, spec, facts, as_of)


def _whole_rows(rows: DataFrame, spec: TableSpec, facts: Facts, as_of: int) -> DataFrame:
    if facts.has_ttl:
        rows = rows.where(F.col(EXPIRES).isNull() | (F.col(EXPIRES) > F.lit(as_of)))
    return rows.select(*[col(c) for c in spec.columns])


def _overlay(rows: DataFrame, spec: TableSpec, facts: Facts, as_of: int) -> DataFrame:
    base = rows.where(F.col(LOAD_ID) == F.lit(facts.base))
    others = rows.where(F.col(LOAD_ID) != F.lit(facts.base))
    keys = others.select(*[col(c) for c in spec.key])
    if facts.few_other_keys:
        keys = F.broadcast(keys)
    untouched = _whole_rows(base.join(keys, spec.key, "left_anti"), spec, facts, as_of)
    if facts.others_hide_base:
        # Even an expired newer row hides the base row. The others may have a base of their own.
        merged = resolve(others, spec, facts_of(spec, list(facts.others)), as_of)
    else:
        merged = _cells(base.join(keys, spec.key, "left_semi").unionByName(others), spec, facts, as_of)
    return untouched.unionByName(merged)


def by_key(rows: DataFrame, spec: TableSpec, facts: Facts) -> GroupedData:
    key = [col(c) for c in spec.key]
    if facts.few_versions and not facts.together:
        rows = rows.repartition(*key)
    return rows.groupBy(*key)


def _tied(rows: DataFrame, spec: TableSpec, facts: Facts) -> DataFrame:
    written = [c for c in spec.regular if c in facts.ever]
    if not written:
        merged = rows.select(*[col(c) for c in spec.key]).distinct()
    else:
        aggs = []
        for i, c in enumerate(written):
            value = F.max(comparable(col(c), spec.type_of(c)))
            aggs.append(F.when(F.count(col(c)) == F.count(F.lit(1)), value).alias(f"_v{i}"))
        merged = by_key(rows, spec, facts).agg(*aggs)
    values = {c: F.col(f"_v{i}") for i, c in enumerate(written)}
    return merged.select(*_output(spec, values))


def cell(name: str, spec: TableSpec, facts: Facts) -> Column:
    """What decides a cell, in order: write timestamp, deletion, value, expiry; null where the row has not written it."""
    parts = [F.col(WTS).alias("t"), col(name).isNull().alias("dead"), comparable(col(name), spec.type_of(name)).alias("v")]
    if facts.has_ttl:
        parts.append(F.coalesce(F.col(EXPIRES), F.lit(NEVER)).alias("e"))
    out = F.struct(*parts)
    if name in facts.always:
        return out
    # Loads of all columns carry no set.
    return F.when(F.col(WRITTEN).isNull() | F.array_contains(F.col(WRITTEN), name), out)


def _cells(rows: DataFrame, spec: TableSpec, facts: Facts, as_of: int) -> DataFrame:
    written = [c for c in spec.regular if c in facts.ever]
    expires = F.coalesce(F.col(EXPIRES), F.lit(NEVER)).alias("e")
    aggs = []
    if facts.has_ttl:
        aggs.append(F.max(F.struct(F.col(WTS).alias("t"), expires)).alias("_marker"))
    aggs += [F.max(cell(c, spec, facts)).alias(f"_c{i}") for i, c in enumerate(written)]
    key = [col(c) for c in spec.key]
    merged = by_key(rows, spec, facts).agg(*aggs) if aggs else rows.select(*key).distinct()
    values = {}
    for i, c in enumerate(written):
        value = F.col(f"_c{i}.v")
        values[c] = F.when(F.col(f"_c{i}.e") > F.lit(as_of), value) if facts.has_ttl else value
    if facts.has_ttl:
        alive = F.col("_marker.e") > F.lit(as_of)
        for value in values.values():
            alive = alive | value.isNotNull()
        merged = merged.where(alive)
    return merged.select(*_output(spec, values))


def _holds_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _holds_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_holds_map(f.dataType) for f in data_type.fields)
    return isinstance(data_type, T.MapType)


def comparable(value: Column, data_type: T.DataType) -> Column:
    """Maps have no order; compare them as their sorted entries, at any depth."""
    if not _holds_map(data_type):
        return value
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: comparable(x, data_type.elementType))
    if isinstance(data_type, T.StructType):
        return _rebuilt(value, data_type, comparable)
    entry = F.transform(
        F.map_entries(value),
        lambda e: F.struct(e["key"].alias("key"), comparable(e["value"], data_type.valueType).alias("value")),
    )
    return F.array_sort(entry)


def from_comparable(value: Column, data_type: T.DataType) -> Column:
    if not _holds_map(data_type):
        return value
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: from_comparable(x, data_type.elementType))
    if isinstance(data_type, T.StructType):
        return _rebuilt(value, data_type, from_comparable)
    return F.map_from_entries(
        F.transform(
            value, lambda e: F.struct(e["key"].alias("key"), from_comparable(e["value"], data_type.valueType).alias("value"))
        )
    )


def _rebuilt(value: Column, data_type: T.StructType, change) -> Column:
    fields = [change(value.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def _output(spec: TableSpec, values: dict[str, Column]) -> list[Column]:
    """The table's columns in order; a column no load has written is null."""
    out = []
    for c in spec.columns:
        data_type = spec.type_of(c)
        if c in spec.key:
            value = col(c)
        elif c not in values:
            value = F.lit(None).cast(data_type)
        else:
            value = from_comparable(values[c], data_type)
        out.append(value.alias(c))
    return out


def lookup(
    store: KeyedStore, keyspace: str, table: str, partition_key: Sequence, as_of: int | None = None
) -> DataFrame:
    """Current rows of one partition key.

    Every load is narrowed to the bucket and token of the key, so partition pruning and the
    row-group statistics of the sorted files leave little to read. Of indexed loads only the files that may hold the key are
    opened.
    """
    spec = store.spec(keyspace, table)
    as_of = int(time.time()) if as_of is None else as_of
    loads = needed([r for r in store.published(spec) if r.rows], as_of)
    wanted, places = places_of(store.spark, spec, loads, partition_key)
    indexed = [r for r in loads if r.index_blocks]
    files = candidates(store, spec, indexed, places, as_of if len(indexed) == len(loads) else None) if indexed else {}
    loads = [r for r in loads if not r.index_blocks or r.load_id in files]
    rows, facts = store.loads(spec, loads, files), facts_of(spec, loads)
    # Little is left to read, so a base is not worth its joins.
    strategy = next(s for s in allowed_strategies(facts) if s != "overlay")
    return resolve(only_partition(rows, wanted, places, loads), spec, facts, as_of, strategy)
