"""Bulk load: check, convert, place, sort, write, publish.

One Spark write job with one shuffle. Nothing is visible before the load's entry is in the log. Every attempt of a load writes
to a directory of its own: Spark's commit protocol owns the files of a task, the log decides which attempt counts, and an
attempt that fails or comes too late removes what it has written. What a lost driver leaves, ``clean_up`` removes.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from keyedload.functions.convert import bad_columns, convert_columns
from keyedload.functions.names import col
from keyedload.operators.contract import bind_by_position, check_input, selected_columns
from keyedload.operators.options import has_ttl, per_row_options, with_static_options
from keyedload.operators.capped import capped_write
from keyedload.operators.files import write_index
from keyedload.operators.place import ASIDE, bucket_count, clustered
from keyedload.sources.store import KeyedStore, LogRow, catalog_name, check_load_id, new_load_id
from keyedload.spec import BUCKET, EXPIRES, NEVER, REJECTED, TOKEN, WTS, AlreadyPublished, LoadConf, LoadError, TableSpec

# A bucket is hot from so many times the rows of an even one; at most one in so many is.
HOT_FACTOR = 4

Mapper = Callable[[DataFrame], DataFrame]


def bulk_load(
    store: KeyedStore,
    df: DataFrame,
    keyspace: str,
    table: str,
    columns: Sequence | None = None,
    conf: LoadConf | None = None,
    *,
    mapper: Mapper | None = None,
    positional: bool = False,
    load_id: str | None = None,
    load_epoch: int | None = None,
    publish: bool = True,
    if_published: str = "fail",
) -> LogRow | None:
    """Load ``df`` into a table and return the load's log row.

    ``columns`` names the table columns to write; other input columns are then discarded and the
    table columns not named keep their values. Without it the input must have exactly the table's
    columns. ``mapper`` reshapes the input first. ``positional`` binds input columns by order.
    ``load_epoch`` is the clock of the load in seconds: the default write timestamp, and the start
    of every ttl; left out, it is the time of the call, for the timestamp to the microsecond. With
    ``publish=False`` the files are written but stay invisible until ``publish_load``. A ``load_id`` that is published
    already fails the call, or with ``if_published="skip"`` is passed over with None; so does one that another attempt
    publishes meanwhile. With a cap in ``conf`` the rows are written in slices at that pace, and published once.
    """
    spec = store.spec(keyspace, table)
    conf = LoadConf.from_spark(store.spark) if conf is None else conf
    micros = time.time_ns() // 1000 if load_epoch is None else load_epoch * 1_000_000
    load_epoch = micros // 1_000_000
    if load_id is None:
        load_id = new_load_id()
    elif store.is_published(spec, check_load_id(load_id)):
        if if_published == "skip":
            return None
        raise LoadError(f"load {load_id} of {spec.full_name} is published already")

    names = selected_columns(spec, columns, conf)
    if mapper is not None:
        df = df.transform(mapper)
    if positional:
        df = bind_by_position(df, names + conf.option_columns)
    check_input(df, spec, names, conf, strict=columns is None)

    started = time.monotonic()
    attempt = uuid.uuid4().hex
    try:
        rows = mutation_rows(df, spec, names, conf, micros)
        seen = write_attempt(store, spec, rows, load_id, attempt, conf)
        entry = LogRow(
            load_id=load_id,
            load_epoch=load_epoch,
            rows=seen["rows"],
            keys=None,
            most_versions=None,
            rejected=seen["rejected"],
            min_wts=seen["min_wts"],
            max_wts=seen["max_wts"],
            has_ttl=has_ttl(conf),
            columns=tuple(names),
            partitioner=conf.partitioner,
            buckets=bucket_count(conf),
            ring=conf.ring,
            split_points=json.dumps(conf.split_points),
            seconds=0.0,
            attempt=attempt,
            expires=seen["expires"],
        )
        if conf.index_files and entry.rows:
            entry = replace(entry, index_blocks=write_index(store, spec, entry))
        if conf.count_keys and entry.rows:
            keys, most_versions = count_keys(store, spec, entry)
            entry = replace(entry, keys=keys, most_versions=most_versions)
            if conf.partitioner == "bucketed":
                entry = replace(entry, hot=hot_buckets(store, spec, entry))
        entry = replace(entry, seconds=time.monotonic() - started)
        if publish:
            store.publish(spec, entry)
    except BaseException as e:
        store.drop_attempt(spec, load_id, attempt)
        if isinstance(e, AlreadyPublished) and if_published == "skip":
            return None
        raise
    return entry


def publish_load(store: KeyedStore, keyspace: str, table: str, entry: LogRow) -> None:
    """Publish a load written with ``publish=False``."""
    spec = store.spec(keyspace, table)
    if store.is_published(spec, entry.load_id):
        raise LoadError(f"load {entry.load_id} of {spec.full_name} is published already")
    store.publish(spec, entry)


def mutation_rows(df: DataFrame, spec: TableSpec, names: list[str], conf: LoadConf, micros: int) -> DataFrame:
    """The rows a load of the clock ``micros`` writes: converted, placed, sorted, with system columns."""
    return with_constants(clustered(converted_rows(df, spec, names, conf, micros), spec, conf), spec, names, conf, micros)


def converted_rows(df: DataFrame, spec: TableSpec, names: list[str], conf: LoadConf, micros: int) -> DataFrame:
    """Converted data and options by row; a row to set aside has only ``_rejected``, itself with the names of its bad columns.

    Good and bad rows come of one evaluation of the input.
    """
    bad = bad_columns(df, spec, names) if conf.on_bad_value == "reject" else None
    if bad is None:
        return df.select(*convert_columns(df, spec, names).values(), *per_row_options(df, conf, micros).values())
    asked = [col(c) for c in df.columns if c != "_bad_columns"]
    marked = df.select("*", bad.alias(REJECTED))
    good = F.size(REJECTED) == 0
    values = convert_columns(marked, spec, names) | per_row_options(marked, conf, micros)
    aside = F.when(~good, F.struct(*asked, F.col(REJECTED).alias("_bad_columns"))).alias(REJECTED)
    return marked.select(*[F.when(good, v).alias(c) for c, v in values.items()], aside)


def with_constants(rows: DataFrame, spec: TableSpec, names: list[str], conf: LoadConf, micros: int) -> DataFrame:
    return with_static_options(rows, conf, micros, None if set(names) == set(spec.columns) else names)


def totals(rows: DataFrame) -> dict[str, Column]:
    """What the log keeps of the rows of a load."""
    kept = F.col(BUCKET) != ASIDE
    return {
        "rows": F.count(F.when(kept, 1)),
        "rejected": F.count(F.when(~kept, 1)),
        "min_wts": F.min(F.when(kept, F.col(WTS))),
        "max_wts": F.max(F.when(kept, F.col(WTS))),
        "expires": F.max(F.when(kept, F.coalesce(F.col(EXPIRES), F.lit(NEVER)) if EXPIRES in rows.columns else F.lit(NEVER))),
    }


def write_attempt(
    store: KeyedStore, spec: TableSpec, rows: DataFrame, load_id: str, attempt: str, conf: LoadConf, more: dict[str, Column] | None = None
) -> dict:
    """Writes the rows of an attempt, and returns their totals."""
    wanted = totals(rows) | (more or {})
    path = store.data_path(spec, load_id, attempt, conf.partitioner)
    with catalog_name(store.spark) as name:

        def write(df: DataFrame) -> None:
            writer = df.drop(*[c for c in df.columns if c.startswith("_only_")]).write.mode("append")
            if conf.partitioner == "bucketed":
                order = [TOKEN, *spec.key]
                writer = writer.format("parquet").bucketBy(conf.buckets, *spec.partition_key).sortBy(*order)
                writer.option("path", path).saveAsTable(name)
            else:
                writer.partitionBy(BUCKET).parquet(path)

        if conf.throttled:
            seen = capped_write(rows, spec, write, conf, wanted)
        else:
            metrics = Observation()
            write(rows.observe(metrics, *[c.alias(n) for n, c in wanted.items()]))
            seen = dict(metrics.get)
    return seen | {"expires": None if seen["expires"] == NEVER else seen["expires"]}


def count_keys(store: KeyedStore, spec: TableSpec, entry: LogRow) -> tuple[int, int]:
    """Distinct primary keys of a written load, and the rows of the most frequent one.

    Scans and shuffles key columns only, one row per key and map task.
    """
    keys = store.loads(spec, [entry]).groupBy(*[col(c) for c in spec.key]).agg(F.count(F.lit(1)).alias("_n"))
    found = keys.agg(F.count(F.lit(1)), F.max("_n")).first()
    return found[0], found[1]


def hot_buckets(store: KeyedStore, spec: TableSpec, entry: LogRow) -> tuple[int, ...]:
    """Buckets of a load with many times the rows of an even one; one column is read."""
    counts = store.loads(spec, [entry]).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"))
    even = -(-entry.rows // entry.buckets)
    found = counts.where(F.col("n") > HOT_FACTOR * even).select(BUCKET).collect()
    return tuple(sorted(r[BUCKET] for r in found))


def read_rejects(store: KeyedStore, keyspace: str, table: str, load_id: str) -> DataFrame:
    """Rows a published load has set aside, as they came in, with the names of their bad columns; also after a compaction."""
    spec = store.spec(keyspace, table)
    entry = store.entries(spec)[0].where(F.col("load_id") == load_id).select("attempt", "partitioner").first()
    if entry is None:
        raise LoadError(f"load {load_id} of {spec.full_name} is not published")
    base = store.data_path(spec, partitioner=entry.partitioner)
    rows = store.spark.read.option("basePath", base).parquet(store.data_path(spec, load_id, entry.attempt, entry.partitioner))
    if REJECTED not in rows.columns:
        raise LoadError(f"load {load_id} of {spec.full_name} could set no rows aside")
    return rows.where(F.col(BUCKET) == ASIDE).select(f"{REJECTED}.*")
