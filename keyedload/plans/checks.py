"""Queries for what a load refuses and for settings: each on a given table, with what is visible afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedload.operators.report import load_log
from keyedload.plans.registry import EPOCH, KEYSPACE, Table, lineitem_table, orders_table, query, source
from keyedload.spec import CONF_PREFIX, ContractError, LoadConf, TableNotFound

# Rules by name: the error, a word that its message must have, and what breaks the rule; a load of orders is the input.
_RULES = {
    "unknown column": (ContractError, "o_colour", lambda t, df: t.load(df, columns=["o_custkey", "o_orderdate", "o_orderkey", "o_colour"])),
    "key column missing": (ContractError, "o_orderdate", lambda t, df: t.load(df, columns=["o_custkey", "o_totalprice"])),
    "collection behaviour": (ContractError, "append", lambda t, df: t.load(df, columns=[*t.spec.columns[:-1], ("o_orderpriority", "append")])),
    # Behaviours are looked at after names and keys.
    "unknown column first": (ContractError, "o_colour", lambda t, df: t.load(df, columns=[("o_colour", "append")])),
    "input column missing": (ContractError, "o_totalprice", lambda t, df: t.load(df.drop("o_totalprice"))),
    "input column too many": (ContractError, "o_colour", lambda t, df: t.load(df.withColumn("o_colour", F.lit("x")))),
    "unknown partitioner": (ValueError, "random", lambda t, df: t.load(df, conf=LoadConf(partitioner="random"))),
    "missing table": (TableNotFound, "no_such_table", lambda t, df: t.store.spec(KEYSPACE, "no_such_table")),
}


@query(
    "contract_checks",
    f"""SELECT rule, refused_as, names, (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderdate, o_orderkey FROM orders)) AS rows_after
        FROM (VALUES {", ".join(f"('{r}', '{e.__name__}', '{word}')" for r, (e, word, _) in _RULES.items())}) AS rules(rule, refused_as, names)""",
)
def contract_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of orders that break a rule are refused, and leave what was loaded before as it was."""
    orders = source(spark, sf_dir, "orders")
    table = orders_table(spark, orders)
    table.load(orders)
    refused = []
    for rule, (_, word, attempt) in _RULES.items():
        try:
            attempt(table, orders)
            refused.append((rule, None, None))
        except (ContractError, TableNotFound, ValueError) as e:
            refused.append((rule, type(e).__name__, word if word in str(e) else None))
    after = table.read().agg(F.count(F.lit(1)).alias("rows_after"))
    return spark.createDataFrame(refused, "rule string, refused_as string, names string").crossJoin(F.broadcast(after))


@query(
    "session_ttl",
    """SELECT w.read_at, CASE WHEN w.read_at < 100 THEN n ELSE 0 END AS rows
       FROM (VALUES (50), (99), (100), (200)) AS w(read_at), (SELECT count(*) AS n FROM customer)""",
)
def session_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ttl of a load may come from the session: a hundred seconds, seen at four moments."""
    customer = source(spark, sf_dir, "customer")
    table = Table(spark, "customer", customer.schema, ("c_custkey",))
    key = f"{CONF_PREFIX}ttl"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "100")
    try:
        table.load(customer, conf=LoadConf.from_spark(spark))
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    parts = [table.read(EPOCH + s).agg(F.lit(s).alias("read_at"), F.count(F.lit(1)).alias("rows")) for s in (50, 99, 100, 200)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("load_seconds", "SELECT count(*) AS rows, TRUE AS timed, TRUE AS rate_fits FROM lineitem")
def load_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log has the seconds of a load and its rate."""
    lineitem = source(spark, sf_dir, "lineitem")
    table = lineitem_table(spark, lineitem)
    table.load(lineitem)
    fits = F.abs(F.col("rows_per_second") * F.col("seconds") - F.col("rows")) < 1
    return load_log(table.store, KEYSPACE, table.spec.name).select("rows", (F.col("seconds") > 0).alias("timed"), fits.alias("rate_fits"))


# Numbers as text in arrays, and what they are as numbers; every seventh order has one that is none.
_PARTS_SQL = """SELECT o_orderkey, [CAST(o_custkey AS VARCHAR), CASE WHEN o_orderkey % 7 = 0 THEN 'none' ELSE '12' END] AS parts FROM orders"""


def _parts(spark: SparkSession, sf_dir: str) -> tuple[Table, DataFrame]:
    orders = source(spark, sf_dir, "orders")
    second = F.when(F.col("o_orderkey") % 7 == 0, "none").otherwise("12")
    given = orders.select("o_orderkey", F.array(F.col("o_custkey").cast("string"), second).alias("parts"))
    return Table(spark, "parts", "o_orderkey bigint, parts array<bigint>", ("o_orderkey",)), given


@query(
    "convert_collections",
    f"""SELECT o_orderkey, CAST(len(parts) AS INTEGER) AS n, CAST(parts[1] AS BIGINT) AS first, CAST(parts[2] AS BIGINT) AS second
        FROM ({_PARTS_SQL}) WHERE o_orderkey % 7 <> 0""",
)
def convert_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements are converted like values of columns."""
    table, given = _parts(spark, sf_dir)
    table.load(given, conf=LoadConf(on_bad_value="reject"))
    parts = F.col("parts")
    return table.read().select("o_orderkey", F.size(parts).alias("n"), parts[0].alias("first"), parts[1].alias("second"))


@query("reject_bad_elements", "SELECT count(*) FILTER (o_orderkey % 7 <> 0) AS loaded, count(*) FILTER (o_orderkey % 7 = 0) AS rejected FROM orders")
def reject_bad_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row with a bad element is set aside as a whole."""
    table, given = _parts(spark, sf_dir)
    table.load(given, conf=LoadConf(on_bad_value="reject"))
    return load_log(table.store, KEYSPACE, table.spec.name).select(F.col("rows").alias("loaded"), "rejected")


@query(
    "lookup_by_time",
    """SELECT max(event_id) AS event_id FROM events
       WHERE date_trunc('milliseconds', ts) = (SELECT date_trunc('milliseconds', min(ts)) FROM events)""",
)
def lookup_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time is looked up as it came in, with the microseconds that storage cuts off."""
    from keyedload.operators.resolve import lookup

    events = source(spark, sf_dir, "events")
    table = Table(spark, "moments", "ts timestamp_ntz, event_id bigint", ("ts",))
    table.load(events.select("ts", "event_id"))
    first = events.agg(F.min("ts")).first()[0]
    return lookup(table.store, KEYSPACE, table.spec.name, (first,), EPOCH).select("event_id")
