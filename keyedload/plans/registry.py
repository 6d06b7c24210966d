"""Registry of named queries, and the small helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keyedload.operators.load import bulk_load
from keyedload.operators.resolve import read_table
from keyedload.sources.store import KeyedStore, LogRow, scratch_root
from keyedload.spec import LoadConf, TableSpec

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

KEYSPACE = "bench"

# Clock of the loads: a fixed second, so that results do not depend on when a query runs.
EPOCH = 1_700_000_000
DAY = 86_400


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Table:
    """One table in a store of its own, for one query."""

    def __init__(self, spark: SparkSession, name: str, schema, partition_key, clustering=()):
        self.store = KeyedStore(spark, scratch_root(spark))
        self.spec = self.store.create_table(TableSpec(KEYSPACE, name, schema, partition_key, clustering))

    def load(self, df: DataFrame, columns=None, conf: LoadConf | None = None, **options) -> LogRow:
        options.setdefault("load_epoch", EPOCH)
        conf = LoadConf() if conf is None else conf
        return bulk_load(self.store, df, KEYSPACE, self.spec.name, columns, conf, **options)

    def read(self, as_of: int | None = None, strategy: str = "auto") -> DataFrame:
        return read_table(self.store, KEYSPACE, self.spec.name, EPOCH if as_of is None else as_of, strategy)


def orders_table(spark: SparkSession, orders: DataFrame) -> Table:
    """Orders of a customer, newest first."""
    return Table(spark, "orders", orders.schema, ("o_custkey",), (("o_orderdate", "desc"), "o_orderkey"))


def lineitem_table(spark: SparkSession, lineitem: DataFrame) -> Table:
    return Table(spark, "lineitem", lineitem.schema, ("l_orderkey",), ("l_linenumber",))


def events_table(spark: SparkSession, events: DataFrame) -> Table:
    """The newest event of every type of a user."""
    return Table(spark, "events", events.schema, ("user_id",), ("event_type",))
