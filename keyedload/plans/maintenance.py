"""Queries for compaction, clean-up, capped loads and rows set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedload.operators.compact import clean_up, compact_loads
from keyedload.operators.load import read_rejects
from keyedload.operators.report import load_log
from keyedload.operators.progress import load_progress, session_pairs
from keyedload.plans.merge import EVENTS_SQL, stamped_events
from keyedload.plans.registry import EPOCH, KEYSPACE, Table, events_table, lineitem_table, query, source
from keyedload.spec import LoadConf
from keyedload.streaming.follow import load_events

_EVENT_COLUMNS = ("event_id", "ts", "value", "props")
_LINEITEM_COLUMNS = (
    "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()


def _stamped_thirds(spark: SparkSession, sf_dir: str) -> Table:
    """Events in three loads, each with their own time as write timestamp; the third without ``props``."""
    events = stamped_events(spark, sf_dir)
    table = events_table(spark, events.drop("w"))
    for i in range(3):
        columns = [c for c in events.columns if c not in ("w", "props")] if i == 2 else None
        table.load(events.where(F.col("event_id") % 3 == i), columns, LoadConf(timestamp="w"))
    return table


_THIRDS_SQL = f"""
WITH e AS ({EVENTS_SQL}), m AS (SELECT user_id, event_type, max_by(event_id, w) AS event_id, max_by(ts, w) AS ts, max_by(value, w) AS value
      FROM e GROUP BY user_id, event_type),
p AS (SELECT user_id, event_type, max_by(props, w) AS props FROM e WHERE event_id % 3 <> 2 GROUP BY user_id, event_type)
SELECT m.event_id, m.ts, user_id, event_type, m.value, p.props FROM m LEFT JOIN p USING (user_id, event_type)
"""


@query("compacted_read", _THIRDS_SQL)
def compacted_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with timestamps of their own, rewritten as one load and cleaned up."""
    table = _stamped_thirds(spark, sf_dir)
    compact_loads(table.store, KEYSPACE, table.spec.name)
    clean_up(table.store, KEYSPACE, table.spec.name, grace_seconds=0)
    return table.read()


@query("compacted_then_loaded", _THIRDS_SQL)
def compacted_then_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads compacted, then a third whose timestamps are older and newer than theirs."""
    events = stamped_events(spark, sf_dir)
    table = events_table(spark, events.drop("w"))
    for i in (0, 1):
        table.load(events.where(F.col("event_id") % 3 == i), None, LoadConf(timestamp="w"))
    compact_loads(table.store, KEYSPACE, table.spec.name)
    columns = [c for c in events.columns if c not in ("w", "props")]
    table.load(events.where(F.col("event_id") % 3 == 2), columns, LoadConf(timestamp="w"))
    return table.read()


@query(
    "compacted_log",
    """SELECT 1 AS loads, count(DISTINCT (user_id, event_type)) AS keys, min(epoch_us(w)) >= min(epoch_us(ts)) AS later
       FROM (SELECT *, max(ts) OVER (PARTITION BY user_id, event_type) AS w FROM events)""",
)
def compacted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says after a compaction: one load, its keys counted while it was written."""
    events = source(spark, sf_dir, "events")
    table = _stamped_thirds(spark, sf_dir)
    compact_loads(table.store, KEYSPACE, table.spec.name)
    first = events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("first"))
    log = load_log(table.store, KEYSPACE, table.spec.name).crossJoin(first)
    return log.groupBy().agg(
        F.count("*").cast("int").alias("loads"), F.sum("keys").alias("keys"), F.min(F.col("min_wts") >= F.col("first")).alias("later")
    )


@query("compacted_expiry", "SELECT * FROM customer WHERE c_custkey % 5 <> 0")
def compacted_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that expire at a time of their own keep it."""
    customer = source(spark, sf_dir, "customer")
    table = Table(spark, "customer", customer.schema, ("c_custkey",))
    life = F.when(F.col("c_custkey") % 5 == 0, F.lit(100)).otherwise(F.lit(1000))
    table.load(customer.withColumn("c_name", F.lit("old")), conf=LoadConf(ttl=2000), load_epoch=EPOCH - 1)
    table.load(customer.withColumn("life", life), conf=LoadConf(ttl="life"))
    compact_loads(table.store, KEYSPACE, table.spec.name)
    return table.read(EPOCH + 500)


@query(
    "capped_load_rows",
    f"""SELECT l_orderkey, l_linenumber, {", ".join(f"max({c}) AS {c}" for c in _LINEITEM_COLUMNS)}
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def capped_load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in one load, written in slices of at most half of them a second."""
    lineitem = source(spark, sf_dir, "lineitem")
    table = lineitem_table(spark, lineitem)
    # A row has about 78 bytes.
    conf = LoadConf(timestamp=EPOCH * 1_000_000, bytes_per_trigger=max(1, lineitem.count() * 78 // 2))
    table.load(lineitem, conf=conf)
    return table.read()


@query("rejects_of_one_pass", "SELECT count(*) AS all_rows, count(*) AS loaded_or_rejected FROM orders")
def rejects_of_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that are bad by chance: every row is loaded or set aside, and none is both."""
    orders = source(spark, sf_dir, "orders")
    table = Table(spark, "prices", "o_orderkey bigint, o_totalprice double", ("o_orderkey",))
    price = F.when(F.rand() < 0.5, F.lit("none")).otherwise(F.col("o_totalprice").cast("string"))
    entry = table.load(orders.select("o_orderkey", price.alias("o_totalprice")), conf=LoadConf(on_bad_value="reject"))
    aside = read_rejects(table.store, KEYSPACE, table.spec.name, entry.load_id)
    both = table.read().select("o_orderkey").unionByName(aside.select("o_orderkey"))
    return orders.agg(F.count("*").alias("all_rows")).crossJoin(both.agg(F.countDistinct("o_orderkey").alias("loaded_or_rejected")))


@query("bucketed_merge", _THIRDS_SQL)
def bucketed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads in equally many Spark buckets, one of them partial: merged bucket by bucket, without a shuffle."""
    events = stamped_events(spark, sf_dir)
    table = events_table(spark, events.drop("w"))
    for i in range(3):
        columns = [c for c in events.columns if c not in ("w", "props")] if i == 2 else None
        table.load(events.where(F.col("event_id") % 3 == i), columns, LoadConf("bucketed", timestamp="w"))
    return table.read()


@query(
    "bucketed_hot_key",
    f"""SELECT 7 AS l_orderkey, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS line, max(l_quantity) + 1 AS l_quantity
        FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY 2
        UNION ALL
        SELECT l_orderkey, CAST(l_orderkey * 10 + l_linenumber AS BIGINT), max(l_quantity) + 1
        FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1, 2""",
)
def bucketed_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partition key with a third of all rows: its bucket is merged apart, by a shuffle, the others without one."""
    lineitem = source(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey")).cast("bigint")
    rows = lineitem.select(key.alias("l_orderkey"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), "l_quantity")
    table = Table(spark, "lines", rows.schema, ("l_orderkey",), ("line",))
    for i in (0, 1):
        table.load(rows.withColumn("l_quantity", F.col("l_quantity") + i), conf=LoadConf("bucketed"), load_epoch=EPOCH + i)
    return table.read(EPOCH + 9)


@query("real_load_progress", "SELECT count(DISTINCT o_custkey % 5) AS buckets, 100 AS percent, FALSE AS missing FROM orders")
def real_load_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load has sent, by the files it has written: every bucket with rows, all bytes."""
    orders = source(spark, sf_dir, "orders")
    rows = orders.select((F.col("o_custkey") % 5).alias("part"), "o_orderkey", "o_totalprice")
    table = Table(spark, "parts", rows.schema, ("part",), ("o_orderkey",))
    table.load(rows, conf=LoadConf("ordered", split_points=(1, 2, 3, 4)))
    events = load_events(table.store, KEYSPACE, table.spec.name)
    buckets = session_pairs(events).agg(F.count("*").alias("buckets"))
    done = load_progress(events).select("percent", (F.col("files_done") < F.col("files")).alias("missing"))
    return buckets.crossJoin(done.withColumn("percent", F.col("percent").cast("int")))
