"""Queries for upserts, partial loads, deletes by null, expiry and write timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedload.operators.load import publish_load
from keyedload.operators.resolve import lookup
from keyedload.plans.registry import (
    DAY,
    EPOCH,
    KEYSPACE,
    Table,
    events_table,
    lineitem_table,
    orders_table,
    query,
    source,
)
from keyedload.spec import LoadConf

HOUR_MICROS = 3_600_000_000


def micros(column: str) -> Column:
    """Microseconds of a zone-free timestamp."""
    return F.unix_micros(F.from_utc_timestamp(F.col(column).cast("timestamp"), F.current_timezone()))


def stamped_events(spark: SparkSession, sf_dir: str, shift_hours: int = 0) -> DataFrame:
    """Events with their own time, shifted, as write timestamp in ``w``."""
    return source(spark, sf_dir, "events").withColumn("w", micros("ts") + F.lit(shift_hours * HOUR_MICROS))


# In SQL: events as the tables hold them, with the same write timestamp.
EVENTS_SQL = """SELECT event_id, date_trunc('millisecond', ts) AS ts, user_id, event_type, value, props,
                       epoch_us(ts) AS w FROM events"""


@query(
    "keyed_load",
    """WITH m AS (SELECT *, max(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber) AS newest FROM lineitem)
       SELECT l_orderkey, max(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey, l_linenumber,
              max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice, max(l_discount) AS l_discount,
              max(l_tax) AS l_tax, max(l_returnflag) AS l_returnflag, max(l_linestatus) AS l_linestatus,
              max(l_shipdate) AS l_shipdate
       FROM m WHERE l_shipdate = newest GROUP BY l_orderkey, l_linenumber""",
)
def keyed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, written with their ship date as timestamp: the last shipped one stays."""
    lineitem = source(spark, sf_dir, "lineitem")
    table = lineitem_table(spark, lineitem)
    table.load(lineitem.withColumn("w", micros("l_shipdate")), conf=LoadConf("md5", timestamp="w"))
    return table.read()


@query(
    "upsert_last_write_wins",
    f"""SELECT event_id, ts, user_id, event_type, value, props
        FROM ({EVENTS_SQL}) QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY w DESC) = 1""",
)
def upsert_last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = source(spark, sf_dir, "events")
    table = events_table(spark, events)
    table.load(stamped_events(spark, sf_dir), conf=LoadConf(timestamp="w"))
    return table.read()


@query(
    "timestamp_per_row",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def timestamp_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest order of a customer, whatever the order of the two loads."""
    orders = source(spark, sf_dir, "orders")
    stamped = orders.withColumn("w", micros("o_orderdate") + F.col("o_orderkey"))
    table = Table(spark, "newest_order", orders.schema, ("o_custkey",))
    conf = LoadConf(timestamp="w")
    table.load(stamped, conf=conf)
    # A later load of the same orders, a day older each and at double price, changes nothing.
    older = stamped.withColumn("w", F.col("w") - F.lit(DAY * 1_000_000))
    table.load(older.withColumn("o_totalprice", F.col("o_totalprice") * 2), conf=conf, load_epoch=EPOCH + 1)
    return table.read()


@query(
    "timestamp_static_tie",
    """SELECT l_orderkey, max(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey, l_linenumber,
              max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice, max(l_discount) AS l_discount,
              max(l_tax) AS l_tax, max(l_returnflag) AS l_returnflag, max(l_linestatus) AS l_linestatus,
              max(l_shipdate) AS l_shipdate
       FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def timestamp_static_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One timestamp for all rows: duplicates tie, and every cell takes the largest value."""
    lineitem = source(spark, sf_dir, "lineitem")
    table = lineitem_table(spark, lineitem)
    table.load(lineitem, conf=LoadConf(timestamp=EPOCH * 1_000_000))
    return table.read()


@query("reload_idempotent", "SELECT * FROM orders")
def reload_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows loaded three times."""
    orders = source(spark, sf_dir, "orders")
    table = orders_table(spark, orders)
    for i in range(3):
        table.load(orders, load_epoch=EPOCH + i)
    return table.read()


@query(
    "later_load_wins",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer
       WHERE c_acctbal > 0 UNION ALL SELECT * FROM customer WHERE c_acctbal <= 0""",
)
def later_load_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without timestamps, the load that started later replaces rows of the earlier one."""
    customer = source(spark, sf_dir, "customer")
    table = Table(spark, "customer", customer.schema, ("c_custkey",))
    table.load(customer)
    rich = customer.where(F.col("c_acctbal") > 0).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    table.load(rich, load_epoch=EPOCH + 1)
    return table.read()


@query(
    "small_update_over_base",
    """SELECT o_orderkey, o_custkey, o_orderstatus,
              CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END
              AS o_totalprice, o_orderdate, o_orderpriority FROM orders""",
)
def small_update_over_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large load and a much smaller newer one: the base is read without a shuffle."""
    orders = source(spark, sf_dir, "orders")
    table = orders_table(spark, orders)
    table.load(orders)
    urgent = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    table.load(urgent.withColumn("o_totalprice", F.col("o_totalprice") * 2), load_epoch=EPOCH + 1)
    return table.read()


@query(
    "partial_column_merge",
    f"""WITH e AS ({EVENTS_SQL}),
        full_rows AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY w DESC) = 1),
        later AS (SELECT user_id, event_type, value + 1000 AS value, w + 12 * 3600000000 AS w
                  FROM e WHERE event_type IN ('purchase', 'click')
                  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY w DESC) = 1)
        SELECT f.event_id, f.ts, f.user_id, f.event_type, coalesce(l.value, f.value) AS value, f.props
        FROM full_rows f LEFT JOIN later l USING (user_id, event_type)""",
)
def partial_column_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load writes one column of some rows; the other columns keep their values."""
    events = source(spark, sf_dir, "events")
    table = events_table(spark, events)
    table.load(stamped_events(spark, sf_dir), conf=LoadConf(timestamp="w"))
    later = stamped_events(spark, sf_dir, shift_hours=12).where(F.col("event_type").isin("purchase", "click"))
    table.load(
        later.withColumn("value", F.col("value") + 1000),
        columns=["user_id", "event_type", "value"],
        conf=LoadConf(timestamp="w"),
    )
    return table.read()


@query(
    "null_overwrites",
    f"""SELECT event_id, ts, user_id, event_type,
               CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE value END AS value,
               CASE WHEN event_type = 'error' THEN NULL ELSE props END AS props
        FROM ({EVENTS_SQL}) QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY w DESC) = 1""",
)
def null_overwrites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null deletes the cell: with a later timestamp, and with an equal one."""
    events = source(spark, sf_dir, "events")
    table = events_table(spark, events)
    conf = LoadConf(timestamp="w")
    table.load(stamped_events(spark, sf_dir), conf=conf)
    errors = stamped_events(spark, sf_dir, shift_hours=1).where(F.col("event_type") == "error")
    nothing = [F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("props")]
    table.load(
        errors.select("user_id", "event_type", *nothing, "w"),
        columns=["user_id", "event_type", "value", "props"],
        conf=conf,
    )
    clicks = stamped_events(spark, sf_dir).where(F.col("event_type") == "click")
    table.load(
        clicks.select("user_id", "event_type", nothing[0], "w"), columns=["user_id", "event_type", "value"], conf=conf
    )
    return table.read()


@query(
    "row_marker_survives",
    """SELECT CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS TIMESTAMP) AS ts, user_id, event_type,
              CAST(NULL AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS props
       FROM events WHERE event_type IN ('signup', 'view') GROUP BY user_id, event_type""",
)
def row_marker_survives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with nothing but nulls stay while their marker lives.

    All events expire; sign-ups and views were also loaded with their key columns alone, for good.
    """
    events = source(spark, sf_dir, "events")
    table = events_table(spark, events)
    table.load(events, conf=LoadConf(ttl=DAY))
    bare = events.where(F.col("event_type").isin("signup", "view")).select("user_id", "event_type")
    table.load(bare, columns=["user_id", "event_type"], load_epoch=EPOCH + 10)
    return table.read(as_of=EPOCH + 2 * DAY)


@query(
    "ttl_static",
    "SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'",
)
def ttl_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load with a ttl replaces a segment's rows; when it has run out they are gone.

    The older values do not come back.
    """
    customer = source(spark, sf_dir, "customer")
    table = Table(spark, "customer", customer.schema, ("c_custkey",))
    table.load(customer)
    table.load(customer.where(F.col("c_mktsegment") == "BUILDING"), conf=LoadConf(ttl=DAY), load_epoch=EPOCH + 1)
    return table.read(as_of=EPOCH + 1 + DAY)


@query(
    "ttl_per_row",
    f"""WITH e AS (SELECT *, 86400 * (1 + user_id % 10) AS ttl FROM ({EVENTS_SQL})),
        newest AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY w DESC) = 1)
        SELECT event_id, ts, user_id, event_type, value, props FROM newest WHERE {EPOCH} + ttl > {EPOCH + 5 * DAY}""",
)
def ttl_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row lives as long as its own column says."""
    events = source(spark, sf_dir, "events")
    table = events_table(spark, events)
    ttl = (F.lit(DAY) * (F.lit(1) + F.col("user_id") % 10)).cast("int")
    table.load(stamped_events(spark, sf_dir).withColumn("ttl", ttl), conf=LoadConf(ttl="ttl", timestamp="w"))
    return table.read(as_of=EPOCH + 5 * DAY)


@query(
    "ttl_and_timestamp",
    f"""WITH e AS ({EVENTS_SQL}),
        m AS (SELECT event_id, ts, user_id, event_type, value, props, w, TRUE AS all_columns,
                     {EPOCH} + 86400 * (1 + user_id % 10) AS expires FROM e
              UNION ALL
              SELECT NULL, NULL, user_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END, NULL,
                     w + 6 * 3600000000, FALSE, {EPOCH + DAY} + 86400 * (1 + user_id % 7) FROM e),
        cells AS (SELECT user_id, event_type,
            event_id, ts, value, props, expires,
            row_number() OVER (PARTITION BY user_id, event_type ORDER BY all_columns DESC, w DESC) AS n_full,
            row_number() OVER (PARTITION BY user_id, event_type ORDER BY w DESC, (value IS NULL) DESC, value DESC, expires DESC) AS n_value,
            row_number() OVER (PARTITION BY user_id, event_type ORDER BY w DESC, expires DESC) AS n_marker
            FROM m),
        merged AS (SELECT user_id, event_type,
            max(CASE WHEN n_full = 1 AND expires > {EPOCH + 5 * DAY} THEN event_id END) AS event_id,
            max(CASE WHEN n_full = 1 AND expires > {EPOCH + 5 * DAY} THEN ts END) AS ts,
            max(CASE WHEN n_value = 1 AND expires > {EPOCH + 5 * DAY} THEN value END) AS value,
            max(CASE WHEN n_full = 1 AND expires > {EPOCH + 5 * DAY} THEN props END) AS props,
            max(CASE WHEN n_marker = 1 THEN expires END) AS marker
            FROM cells GROUP BY user_id, event_type)
        SELECT event_id, ts, user_id, event_type, value, props FROM merged
        WHERE marker > {EPOCH + 5 * DAY} OR event_id IS NOT NULL OR ts IS NOT NULL OR value IS NOT NULL
              OR props IS NOT NULL""",
)
def ttl_and_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-row timestamps and ttls on a full and a partial load; a third load is never published."""
    events = source(spark, sf_dir, "events")
    table = events_table(spark, events)
    conf = LoadConf(ttl="ttl", timestamp="w")
    first = (F.lit(DAY) * (F.lit(1) + F.col("user_id") % 10)).cast("int")
    table.load(stamped_events(spark, sf_dir).withColumn("ttl", first), conf=conf)
    second = (F.lit(DAY) * (F.lit(1) + F.col("user_id") % 7)).cast("int")
    later = stamped_events(spark, sf_dir, shift_hours=6).withColumn("ttl", second)
    later = later.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    table.load(later, columns=["user_id", "event_type", "value"], conf=conf, load_epoch=EPOCH + DAY)
    hidden = stamped_events(spark, sf_dir, shift_hours=24)
    table.load(hidden, conf=LoadConf(timestamp="w"), publish=False)
    return table.read(as_of=EPOCH + 5 * DAY)


@query("unpublished_load_hidden", "SELECT * FROM customer")
def unpublished_load_hidden(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = source(spark, sf_dir, "customer")
    table = Table(spark, "customer", customer.schema, ("c_custkey",))
    table.load(customer)
    changed = customer.withColumn("c_name", F.lit("changed"))
    table.load(changed, load_epoch=EPOCH + 1, publish=False)
    return table.read()


@query("published_afterwards", "SELECT c_custkey, 'changed' AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def published_afterwards(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = source(spark, sf_dir, "customer")
    table = Table(spark, "customer", customer.schema, ("c_custkey",))
    table.load(customer)
    changed = customer.withColumn("c_name", F.lit("changed"))
    entry = table.load(changed, load_epoch=EPOCH + 1, publish=False)
    publish_load(table.store, KEYSPACE, table.spec.name, entry)
    return table.read()


@query(
    "collection_cells",
    """SELECT vec_id, len(embedding) + 1 AS dims, CAST(label AS FLOAT) AS first, embedding[1] AS second,
              embedding[len(embedding)] AS last
       FROM embeddings""",
)
def collection_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection cell is replaced as a whole by a later load."""
    vectors = source(spark, sf_dir, "embeddings")
    table = Table(spark, "vectors", "vec_id bigint, embedding array<float>, label int", ("vec_id",))
    table.load(vectors)
    longer = F.concat(F.array(F.col("label").cast("float")), F.col("embedding"))
    table.load(vectors.select("vec_id", longer.alias("embedding")), columns=["vec_id", "embedding"], load_epoch=EPOCH + 1)
    cell = F.col("embedding")
    return table.read().select(
        "vec_id",
        F.size(cell).cast("bigint").alias("dims"),
        F.element_at(cell, 1).alias("first"),
        F.element_at(cell, 2).alias("second"),
        F.element_at(cell, -1).alias("last"),
    )


@query(
    "lookup_partition",
    """SELECT * FROM orders WHERE o_custkey =
       (SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1)""",
)
def lookup_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the customer who has the most."""
    orders = source(spark, sf_dir, "orders")
    table = orders_table(spark, orders)
    table.load(orders)
    table.load(orders, conf=LoadConf("md5"), load_epoch=EPOCH + 1)
    counts = orders.groupBy("o_custkey").count()
    busiest = counts.agg(F.max_by("o_custkey", F.struct("count", -F.col("o_custkey"))).alias("c")).first().c
    return lookup(table.store, KEYSPACE, table.spec.name, (busiest,), as_of=EPOCH)
