"""Queries for tokens, buckets, replicas, file order, and rate-limited loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedload.functions.tokens import even_range
from keyedload.operators.report import bucket_report, load_log, misordered_rows, replica_report
from keyedload.operators.resolve import published_rows
from keyedload.plans.registry import EPOCH, KEYSPACE, Table, lineitem_table, orders_table, query, source
from keyedload.sources.store import scratch_root
from keyedload.spec import BUCKET, TOKEN, LoadConf
from keyedload.streaming.throttle import stream_load, throttled_files

# Token of the md5 partitioner for one bigint key column, and its bucket among 16.
TOKEN_SQL = "('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 15))::BIGINT"
BUCKET_SQL = f"CAST(((({TOKEN_SQL}) >> 28) * 16) >> 32 AS INTEGER)"

# An uneven ring of five nodes over the 60-bit token space, in tenths of the space.
RING = tuple(2**60 // 10 * tenths for tenths in (1, 2, 4, 7, 9))


def _loaded(spark: SparkSession, sf_dir: str, conf: LoadConf) -> Table:
    lineitem = source(spark, sf_dir, "lineitem")
    table = lineitem_table(spark, lineitem)
    # Nothing is merged here, so nobody needs to know whether keys are distinct.
    table.load(lineitem, conf=conf)
    return table


def _counting(**settings) -> LoadConf:
    return LoadConf(count_keys=False, **settings)


@query("md5_token", f"SELECT l_orderkey, l_linenumber, {TOKEN_SQL} AS token FROM lineitem")
def md5_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _loaded(spark, sf_dir, _counting(partitioner="md5"))
    rows, _ = published_rows(table.store, table.spec)
    return rows.select("l_orderkey", "l_linenumber", F.col(TOKEN).alias("token"))


@query(
    "md5_token_composite",
    """SELECT o_orderkey, ('0x' || substr(md5(CAST(o_custkey AS VARCHAR) || chr(1) || o_orderpriority), 1, 15))::BIGINT
              AS token FROM orders""",
)
def md5_token_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partition key of two columns."""
    orders = source(spark, sf_dir, "orders")
    table = Table(spark, "by_priority", orders.schema, ("o_custkey", "o_orderpriority"), ("o_orderkey",))
    table.load(orders, conf=_counting(partitioner="md5"))
    rows, _ = published_rows(table.store, table.spec)
    return rows.select("o_orderkey", F.col(TOKEN).alias("token"))


@query(
    "bucket_row_counts",
    f"SELECT {BUCKET_SQL} AS bucket, count(*) AS rows FROM lineitem GROUP BY 1",
)
def bucket_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _loaded(spark, sf_dir, _counting(partitioner="md5"))
    return bucket_report(table.store, KEYSPACE, table.spec.name).select("bucket", "rows")


@query(
    "salted_buckets",
    f"SELECT {BUCKET_SQL} AS bucket, count(*) AS rows FROM lineitem GROUP BY 1",
)
def salted_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four writers per bucket: more parallel writers, the same buckets."""
    table = _loaded(spark, sf_dir, _counting(partitioner="md5", writers_per_bucket=4))
    return bucket_report(table.store, KEYSPACE, table.spec.name).select("bucket", "rows")


@query("hash_bucket_rows", "SELECT count(*) AS rows, CAST(16 AS BIGINT) AS buckets, TRUE AS even FROM lineitem")
def hash_bucket_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash has no SQL twin; it must use all buckets, and none with half or twice its share."""
    table = _loaded(spark, sf_dir, _counting())
    per_bucket = bucket_report(table.store, KEYSPACE, table.spec.name)
    even = (F.max("rows") < 2 * F.avg("rows")) & (F.min("rows") > F.avg("rows") / 2)
    return per_bucket.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("buckets"), even.alias("even"))


@query("hash_placement", "SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS keys, CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS split_keys FROM lineitem")
def hash_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash has no SQL twin, its properties have: a key lies in one bucket, that of its token."""
    table = _loaded(spark, sf_dir, _counting())
    rows, _ = published_rows(table.store, table.spec)
    right = even_range("hash", F.xxhash64("l_orderkey"), 16) == F.col(BUCKET)
    per_key = rows.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~right).alias("wrong"),
        (F.min(BUCKET) != F.max(BUCKET)).alias("split"),
    )
    return per_key.agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.sum("wrong").alias("misplaced"),
        F.count_if("split").alias("split_keys"),
    )


_BELOW = f"list_filter([{', '.join(f'{b}::BIGINT' for b in RING)}], lambda b: b <= {TOKEN_SQL})"
RANGE_SQL = f"((len({_BELOW}) - 1 + {len(RING)}) % {len(RING)})"


@query("ring_range_rows", f"SELECT CAST({RANGE_SQL} AS INTEGER) AS bucket, count(*) AS rows FROM lineitem GROUP BY 1")
def ring_range_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per range of an uneven ring; tokens below the first bound belong to the last range."""
    table = _loaded(spark, sf_dir, _counting(partitioner="md5", ring=RING, writers_per_bucket=2))
    return bucket_report(table.store, KEYSPACE, table.spec.name).select("bucket", "rows")


@query(
    "ring_replica_rows",
    f"""WITH r AS (SELECT {RANGE_SQL} AS part, count(*) AS n FROM lineitem GROUP BY 1)
        SELECT CAST((part + i) % {len(RING)} AS INTEGER) AS node, CAST(sum(n) AS BIGINT) AS rows
        FROM r, (VALUES (0), (1), (2)) AS copies(i) GROUP BY 1""",
)
def ring_replica_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per node when every range lives on three nodes."""
    table = _loaded(spark, sf_dir, _counting(partitioner="md5", ring=RING))
    return replica_report(table.store, KEYSPACE, table.spec.name, ranges=len(RING), copies=3)


def _thirds(lineitem: DataFrame) -> tuple[int, int]:
    """Two keys that cut the key span in three."""
    low, high = lineitem.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    span = high - low
    return low + span // 3, low + span * 2 // 3


_THIRDS_SQL = """WITH span AS (SELECT min(l_orderkey) AS low, max(l_orderkey) - min(l_orderkey) AS width FROM lineitem),
        cuts AS (SELECT low + width // 3 AS a, low + width * 2 // 3 AS b FROM span)
        SELECT CASE WHEN l_orderkey >= b THEN 2 WHEN l_orderkey >= a THEN 1 ELSE 0 END AS bucket,"""


@query(
    "byte_ordered_ranges",
    f"""{_THIRDS_SQL} count(*) AS rows, min(l_orderkey) AS first_key, max(l_orderkey) AS last_key
        FROM lineitem, cuts GROUP BY 1""",
)
def byte_ordered_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placement in key order, cut at explicit points."""
    lineitem = source(spark, sf_dir, "lineitem")
    table = lineitem_table(spark, lineitem)
    table.load(lineitem, conf=_counting(partitioner="ordered", split_points=_thirds(lineitem)))
    rows, _ = published_rows(table.store, table.spec)
    return rows.groupBy(F.col(BUCKET).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("l_orderkey").alias("first_key"),
        F.max("l_orderkey").alias("last_key"),
    )


@query("clustered_write_sorted", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS violations FROM lineitem")
def clustered_write_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = source(spark, sf_dir, "lineitem")
    table = lineitem_table(spark, lineitem)
    conf = _counting(partitioner="md5", writers_per_bucket=2)
    entry = table.load(lineitem, conf=conf)
    bad = misordered_rows(table.store, table.spec, entry.load_id, conf)
    return bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(entry.rows).cast("bigint").alias("rows"), "violations")


@query("clustering_descending", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS violations FROM orders")
def clustering_descending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders lie newest first inside a customer, in key order over customers."""
    orders = source(spark, sf_dir, "orders")
    table = orders_table(spark, orders)
    conf = _counting(partitioner="ordered", split_points=(orders.agg(F.max("o_custkey")).first()[0] // 2,))
    entry = table.load(orders, conf=conf)
    bad = misordered_rows(table.store, table.spec, entry.load_id, conf)
    return bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(entry.rows).cast("bigint").alias("rows"), "violations")


@query(
    "load_report",
    f"""SELECT {BUCKET_SQL} AS bucket, count(*) AS rows, min({TOKEN_SQL}) AS min_token, max({TOKEN_SQL}) AS max_token
        FROM lineitem GROUP BY 1""",
)
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _loaded(spark, sf_dir, _counting(partitioner="md5"))
    return bucket_report(table.store, KEYSPACE, table.spec.name)


@query(
    "load_log_rows",
    """SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS keys,
              min(epoch_us(l_shipdate)) AS min_wts, max(epoch_us(l_shipdate)) AS max_wts, FALSE AS has_ttl
       FROM lineitem""",
)
def load_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says of a load: counted rows and keys, span of the write timestamps."""
    from keyedload.plans.merge import micros

    lineitem = source(spark, sf_dir, "lineitem")
    table = lineitem_table(spark, lineitem)
    table.load(lineitem.withColumn("w", micros("l_shipdate")), conf=LoadConf(timestamp="w"))
    return load_log(table.store, KEYSPACE, table.spec.name).select("rows", "keys", "min_wts", "max_wts", "has_ttl")


_LINEITEM_COLUMNS = (
    "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()


@query(
    "throttled_load_rows",
    f"""SELECT l_orderkey, l_linenumber, {", ".join(f"max({c}) AS {c}" for c in _LINEITEM_COLUMNS)}
       FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def throttled_load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items streamed in at a capped rate, then merged over all micro-batches."""
    lineitem = source(spark, sf_dir, "lineitem")
    table = lineitem_table(spark, lineitem)
    base = scratch_root(spark)
    # Files of a quarter of the rows at most, and about half of the bytes in a batch.
    lineitem.write.option("maxRecordsPerFile", -(-lineitem.count() // 4)).parquet(f"{base}/in")
    size = spark.read.format("binaryFile").load(f"{base}/in/*.parquet").agg(F.sum("length")).first()[0]
    conf = LoadConf(timestamp=EPOCH * 1_000_000, bytes_per_trigger=max(1, size // 2))
    stream = throttled_files(spark, f"{base}/in", lineitem.schema, conf)
    running = stream_load(table.store, stream, KEYSPACE, table.spec.name, f"{base}/checkpoint", conf=conf)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return table.read()
