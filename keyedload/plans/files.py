"""Queries for the index of files, loads that have expired, and split points from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedload.operators.files import index_rows
from keyedload.operators.report import bucket_report
from keyedload.operators.resolve import lookup
from keyedload.operators.split import ordered_split_points
from keyedload.plans.placement import BUCKET_SQL, TOKEN_SQL
from keyedload.plans.registry import DAY, EPOCH, KEYSPACE, Table, lineitem_table, orders_table, query, source
from keyedload.spec import BUCKET, LoadConf


@query(
    "file_index",
    f"SELECT {BUCKET_SQL} AS bucket, count(*) AS rows, min({TOKEN_SQL}) AS first, max({TOKEN_SQL}) AS last FROM lineitem GROUP BY 1",
)
def file_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the index of a load knows of its buckets, without a look at the data."""
    lineitem = source(spark, sf_dir, "lineitem")
    table = lineitem_table(spark, lineitem)
    entry = table.load(lineitem, conf=LoadConf("md5", count_keys=False, index_files=True))
    index = index_rows(table.store, table.spec, [entry])
    spans = F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last")
    return index.groupBy(F.col(BUCKET).alias("bucket")).agg(*spans)


@query(
    "indexed_lookup",
    """SELECT * FROM orders WHERE o_custkey =
       (SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1)""",
)
def indexed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the customer who has the most, from loads by year of which each has an index."""
    orders = source(spark, sf_dir, "orders")
    table = orders_table(spark, orders)
    year = F.year("o_orderdate")
    for i, y in enumerate(sorted(r[0] for r in orders.select(year).distinct().collect())):
        table.load(orders.where(year == y), conf=LoadConf(index_files=True), load_epoch=EPOCH + i)
    counts = orders.groupBy("o_custkey").count()
    busiest = counts.agg(F.max_by("o_custkey", F.struct("count", -F.col("o_custkey"))).alias("c")).first().c
    return lookup(table.store, KEYSPACE, table.spec.name, (busiest,), as_of=EPOCH)


@query("expired_loads_unread", "SELECT * FROM orders WHERE o_orderkey % 3 = 2")
def expired_loads_unread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads that live for a day, a day and three; on the second day only the files of the third are opened."""
    orders = source(spark, sf_dir, "orders")
    table = orders_table(spark, orders)
    for i, days in enumerate((1, 1, 3)):
        table.load(orders.where(F.col("o_orderkey") % 3 == i), conf=LoadConf(ttl=days * DAY), load_epoch=EPOCH + i)
    return table.read(EPOCH + 2 * DAY)


@query(
    "ordered_split_rows",
    "SELECT count(*) AS rows, TRUE AS even, max(CASE WHEN l_orderkey % 3 = 0 THEN 1 END) IS NOT NULL AS hot_alone FROM lineitem",
)
def ordered_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges cut by the data, where one key has a third of all rows: it has a range of its own, and others are even."""
    lineitem = source(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey")).cast("bigint")
    rows = lineitem.select(key.alias("l_orderkey"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), "l_quantity")
    table = Table(spark, "lines", rows.schema, ("l_orderkey",), ("line",))
    points = ordered_split_points(rows, table.spec, 16)
    table.load(rows, conf=LoadConf("ordered", split_points=points, count_keys=False))
    hot = sum(p <= 7 for p in points)
    report = bucket_report(table.store, KEYSPACE, table.spec.name)
    even = F.sum("rows") * 1.1 / 16 >= F.max(F.when(F.col("bucket") != hot, F.col("rows")))
    alone = F.max(F.when(F.col("bucket") == hot, F.col("rows"))) * 3 <= F.sum("rows") * 1.2
    return report.agg(F.sum("rows").cast("bigint").alias("rows"), even.alias("even"), alone.alias("hot_alone"))
