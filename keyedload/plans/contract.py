"""Queries for inputs, column contract and value conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedload.operators.load import read_rejects
from keyedload.plans.registry import KEYSPACE, Table, orders_table, query, source
from keyedload.sources.inputs import read_csv
from keyedload.sources.store import scratch_root
from keyedload.spec import LoadConf


@query("roundtrip_count", "SELECT count(*) AS n FROM orders")
def roundtrip_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders")
    table = orders_table(spark, orders)
    table.load(orders)
    return table.read().agg(F.count(F.lit(1)).alias("n"))


@query("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders")
    path = f"{scratch_root(spark)}/csv"
    orders.write.option("header", True).csv(path)
    table = orders_table(spark, orders)
    table.load(read_csv(spark, path, columns=orders.columns))
    return table.read()


@query("project_all_columns", "SELECT * FROM customer")
def project_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = source(spark, sf_dir, "customer")
    table = Table(spark, "customer", customer.schema, ("c_custkey",))
    table.load(customer)
    return table.read()


@query(
    "project_some_columns",
    """SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus, o_totalprice, o_orderdate,
              CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders""",
)
def project_some_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A subset, with a name given twice; the other input columns are discarded."""
    orders = source(spark, sf_dir, "orders")
    table = orders_table(spark, orders)
    table.load(orders, columns=["o_totalprice", "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"])
    return table.read()


@query("load_by_name_reordered", "SELECT * FROM orders")
def load_by_name_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders")
    table = orders_table(spark, orders)
    table.load(orders.select(*reversed(orders.columns)))
    return table.read()


@query("load_positional", "SELECT * FROM customer")
def load_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = source(spark, sf_dir, "customer")
    table = Table(spark, "customer", customer.schema, ("c_custkey",))
    table.load(customer.toDF(*[f"_{i + 1}" for i in range(len(customer.columns))]), positional=True)
    return table.read()


@query(
    "load_with_mapper",
    """SELECT p_partkey AS part, p_brand || ' ' || p_type AS label, CAST(p_retailprice AS FLOAT) AS price
       FROM part""",
)
def load_with_mapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapper shapes the input rows into the table's columns."""

    def shape(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("p_partkey").alias("part"),
            F.concat_ws(" ", "p_brand", "p_type").alias("label"),
            F.col("p_retailprice").alias("price"),
        )

    table = Table(spark, "prices", "part bigint, label string, price float", ("part",))
    table.load(source(spark, sf_dir, "part"), mapper=shape)
    return table.read()


def _converted(spark: SparkSession, sf_dir: str, column: str, target: str) -> DataFrame:
    """Load one column of orders as text into a table where it has the type ``target``."""
    text = source(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col(column).cast("string").alias("value")
    )
    table = Table(spark, "converted", f"o_orderkey string, value {target}", ("o_orderkey",))
    table.load(text)
    return table.read()


@query(
    "convert_int",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS INTEGER) AS value FROM orders",
)
def convert_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(spark, sf_dir, "o_custkey", "int")


@query(
    "convert_float",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(CAST(o_totalprice AS VARCHAR) AS FLOAT) AS value FROM orders",
)
def convert_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(spark, sf_dir, "o_totalprice", "float")


@query(
    "convert_date",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_orderdate AS DATE) AS value FROM orders",
)
def convert_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(spark, sf_dir, "o_orderdate", "date")


@query(
    "convert_timestamp",
    "SELECT event_id, date_trunc('millisecond', ts) AS local_ts, epoch_us(ts) // 1000 AS ts_millis FROM events",
)
def convert_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with and without a zone; both timestamp types keep milliseconds."""
    text = source(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+0000'").alias("ts"),
        F.col("ts").cast("string").alias("local_ts"),
    )
    table = Table(spark, "times", "event_id bigint, ts timestamp, local_ts timestamp_ntz", ("event_id",))
    table.load(text)
    return table.read().select("event_id", "local_ts", F.unix_millis("ts").alias("ts_millis"))


@query(
    "convert_all",
    """SELECT event_id, CAST(user_id AS INTEGER) AS user_id, CAST(ts AS DATE) AS day,
              date_trunc('millisecond', ts) AS ts, CAST(value AS DECIMAL(12,2)) AS amount,
              value AS exact, CAST(CAST(value AS VARCHAR) AS FLOAT) AS rough, event_type = 'error' AS failed,
              CAST(user_id % 100 AS SMALLINT) AS shard, event_type, props
       FROM events""",
)
def convert_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = source(spark, sf_dir, "events").select(
        *[
            e.cast("string").alias(name)
            for name, e in {
                "event_id": F.col("event_id"),
                "user_id": F.col("user_id"),
                "day": F.to_date("ts"),
                "ts": F.col("ts"),
                "amount": F.col("value"),
                "exact": F.col("value"),
                "rough": F.col("value"),
                "failed": F.col("event_type") == "error",
                "shard": F.col("user_id") % 100,
                "event_type": F.col("event_type"),
                "props": F.col("props"),
            }.items()
        ]
    )
    schema = (
        "event_id bigint, user_id int, day date, ts timestamp_ntz, amount decimal(12,2), exact double, rough float, "
        "failed boolean, shard smallint, event_type string, props string"
    )
    table = Table(spark, "typed_events", schema, ("event_id",))
    table.load(text)
    return table.read()


def _spoiled_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with quantities as text; those of returned items are not numbers."""
    text = F.col("l_quantity").cast("int").cast("string")
    spoiled = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("x"), text)).otherwise(text)
    return source(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", spoiled.alias("l_quantity"), "l_shipdate")


_SPOILED_SCHEMA = "l_orderkey bigint, l_linenumber int, l_quantity int, l_shipdate date"


def _load_spoiled(spark: SparkSession, sf_dir: str) -> tuple[Table, str]:
    table = Table(spark, "quantities", _SPOILED_SCHEMA, ("l_orderkey",), ("l_linenumber",))
    entry = table.load(_spoiled_lineitem(spark, sf_dir), conf=LoadConf(on_bad_value="reject"))
    return table, entry.load_id


@query(
    "reject_bad_values",
    """SELECT l_orderkey, l_linenumber, max(CAST(l_quantity AS INTEGER)) AS l_quantity,
              max(CAST(l_shipdate AS DATE)) AS l_shipdate
       FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey, l_linenumber""",
)
def reject_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _load_spoiled(spark, sf_dir)
    return table.read()


@query(
    "rejected_rows",
    """SELECT l_orderkey, l_linenumber, 'x' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS l_quantity,
              'l_quantity' AS bad_columns
       FROM lineitem WHERE l_returnflag = 'R'""",
)
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, load_id = _load_spoiled(spark, sf_dir)
    rejects = read_rejects(table.store, KEYSPACE, table.spec.name, load_id)
    return rejects.select("l_orderkey", "l_linenumber", "l_quantity", F.array_join("_bad_columns", ",").alias("bad_columns"))


@query("lineitem_by_full_key", "SELECT DISTINCT * FROM lineitem")
def lineitem_by_full_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose columns are all in the key: a load is a set of rows."""
    lineitem = source(spark, sf_dir, "lineitem")
    rest = [c for c in lineitem.columns if c != "l_orderkey"]
    table = Table(spark, "lineitem_set", lineitem.schema, ("l_orderkey",), rest)
    table.load(lineitem)
    return table.read()


