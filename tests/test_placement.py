"""Tokens, buckets, file order, and what happens to hot keys."""

import hashlib

import pytest
from pyspark.sql import functions as F

from keyedload import LoadConf, TableSpec, bulk_load, lookup, read_table
from keyedload.functions.tokens import even_range, md5_token, ring_range, ring_replicas, split_range
from keyedload.operators.report import bucket_report, load_log, misordered_rows, replica_report
from keyedload.spec import BUCKET, TOKEN


def md5_60(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_md5_token(spark):
    df = spark.createDataFrame([("abc", 5), ("", -1)], "a string, b int")
    got = df.select(md5_token(["a"]).alias("x"), md5_token(["a", "b"]).alias("y")).collect()
    assert [(r.x, r.y) for r in got] == [(md5_60("abc"), md5_60("abc\u00015")), (md5_60(""), md5_60("\u0001-1"))]
    assert got[0].x == 648541476951500027


@pytest.mark.parametrize("partitioner", ["hash", "md5", "ordered"])
def test_placement_by_time_does_not_depend_on_the_session_zone(spark, store, partitioner):
    schema = "at timestamp, v int"
    store.create_table(TableSpec("test", "times", schema, ("at",)))
    df = spark.range(50).select(F.timestamp_seconds(F.col("id") * 86_400).alias("at"), F.col("id").cast("int").alias("v"))
    points = ("1970-01-20 00:00:00Z",) if partitioner == "ordered" else ()
    bulk_load(store, df, "test", "times", conf=LoadConf(partitioner, split_points=points))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        # Day 30 since 1970, in local time of the session.
        assert [r.v for r in lookup(store, "test", "times", ("1970-01-31 09:00:00",)).collect()] == [30]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("partitioner, low, high", [("hash", -(2**63), 2**63 - 1), ("md5", 0, 2**60 - 1)])
@pytest.mark.parametrize("n", [1, 2, 16, 1000, 100_000])
def test_even_ranges_cover_the_token_space(spark, partitioner, low, high, n):
    tokens = [low, low + 1, (low + high) // 2, high - 1, high]
    df = spark.createDataFrame([(t,) for t in tokens], "t bigint")
    got = [r[0] for r in df.select(even_range(partitioner, F.col("t"), n)).collect()]
    assert got == [(t - low) * n // (high - low + 1) for t in tokens]
    assert got[0] == 0 and got[-1] == n - 1 and got == sorted(got)


def test_ring_is_closed(spark):
    df = spark.createDataFrame([(0,), (10,), (19,), (20,), (30,), (99,)], "t bigint")
    got = [r[0] for r in df.select(ring_range(F.col("t"), (10, 20, 30))).collect()]
    assert got == [2, 0, 0, 1, 2, 2]
    reps = df.select(ring_replicas(ring_range(F.col("t"), (10, 20, 30)), 3, 2)).collect()
    assert [r[0] for r in reps] == [[2, 0], [0, 1], [0, 1], [1, 2], [2, 0], [2, 0]]
    assert spark.range(1).select(ring_replicas(F.lit(1), 2, 5)).first()[0] == [1, 0]


def test_split_points(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 5), ("c", 0)], "p string, q int")
    one = [r[0] for r in df.select(split_range([F.col("p"), F.col("q")], ("b", "c"), ("string", "int"))).collect()]
    assert one == [0, 1, 1, 2]
    two = [r[0] for r in df.select(split_range([F.col("p"), F.col("q")], (("b", 2), ("c", 1)), ("string", "int"))).collect()]
    assert two == [0, 0, 1, 1]


@pytest.fixture
def wide(store):
    return store.create_table(TableSpec("test", "wide", "p bigint, c int, v string", ("p",), (("c", "desc"),)))


def frame(spark, n=5000, hot=0):
    key = F.when(F.col("id") < hot, F.lit(-1)).otherwise(F.col("id") % 97)
    return spark.range(n).select(key.cast("bigint").alias("p"), F.col("id").cast("int").alias("c"), F.md5(F.col("id").cast("string")).alias("v"))


CONFS = [
    LoadConf(),
    LoadConf("hash", buckets=3, writers_per_bucket=4),
    LoadConf("md5", buckets=5),
    LoadConf("md5", ring=(1, 2**58, 2**59), writers_per_bucket=3),
    LoadConf("ordered", split_points=(10, 50)),
    LoadConf("ordered", split_points=(10, 50), writers_per_bucket=2),
    LoadConf("ordered"),
]


@pytest.mark.parametrize("conf", CONFS, ids=lambda c: f"{c.partitioner}-{c.buckets}-{c.writers_per_bucket}")
def test_every_row_lands_sorted_in_the_bucket_of_its_key(spark, store, wide, conf):
    df = frame(spark)
    entry = bulk_load(store, df, "test", "wide", conf=conf)
    assert entry.rows == 5000 and entry.keys == 5000
    rows = store.loads(wide, [entry.load_id])
    assert rows.groupBy("p").agg(F.countDistinct(BUCKET).alias("n")).where("n > 1").count() == 0
    assert misordered_rows(store, wide, entry.load_id, conf).count() == 0
    assert sorted(read_table(store, "test", "wide").collect()) == sorted(df.collect())
    if conf.partitioner != "ordered":
        spans = sorted(tuple(r) for r in bucket_report(store, "test", "wide").collect())
        assert sum(r[1] for r in spans) == 5000
        if conf.ring is None:
            # Buckets are token ranges: they do not overlap.
            assert all(a[3] < b[2] for a, b in zip(spans, spans[1:]))
    else:
        assert rows.where(F.col(TOKEN).isNotNull()).count() == 0


def test_misordered_rows_are_found(spark, store, wide):
    conf = LoadConf("ordered")
    entry = bulk_load(store, frame(spark, 100), "test", "wide", conf=conf)
    ascending = TableSpec("test", "wide", wide.schema, ("p",), ("c",))
    # 97 partition keys, three of them with two rows in descending order.
    assert misordered_rows(store, ascending, entry.load_id, conf).count() == 3


def test_hot_partition_key_is_written_by_several_tasks(spark, store, wide):
    """One key holds a third of the rows; its bucket is cut into several sorted files."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        df = frame(spark, 60_000, hot=20_000).repartition(16)
        entry = bulk_load(store, df, "test", "wide", conf=LoadConf(buckets=4))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = store.loads(wide, [entry.load_id]).select(F.col("_metadata.file_name").alias("f"), "p")
    per_file = {r.f: r.n for r in files.where("p = -1").groupBy("f").agg(F.count("p").alias("n")).collect()}
    assert len(per_file) > 3 and max(per_file.values()) < 10_000
    assert misordered_rows(store, wide, entry.load_id, LoadConf(buckets=4)).count() == 0
    assert read_table(store, "test", "wide").count() == 60_000


def test_hot_primary_key_is_split_and_merged(spark, store, wide):
    """A third of the rows are versions of a single primary key."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        df = frame(spark, 60_000).withColumn("w", F.col("c").cast("bigint"))
        hot = F.col("c") < 20_000
        df = df.withColumn("p", F.when(hot, F.lit(-1)).otherwise(F.col("p"))).withColumn("c", F.when(hot, F.lit(0)).otherwise(F.col("c")))
        entry = bulk_load(store, df.repartition(16), "test", "wide", conf=LoadConf(buckets=4, timestamp="w"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert (entry.rows, entry.keys, entry.most_versions) == (60_000, 40_001, 20_000)
    files = store.loads(wide, [entry.load_id]).where("p = -1").select(F.col("_metadata.file_name").alias("f"))
    assert files.distinct().count() > 3
    got = read_table(store, "test", "wide").where("p = -1").collect()
    assert [tuple(r) for r in got] == [(-1, 0, hashlib.md5(b"19999").hexdigest())]
    assert read_table(store, "test", "wide").count() == 40_001


def test_partial_aggregate_runs_before_the_shuffle(spark, store, wide):
    """Unless the log proves that no key is hot; then plain rows are shuffled once."""
    df = frame(spark, 100)
    bulk_load(store, df, "test", "wide", load_epoch=1)
    bulk_load(store, df, "test", "wide", load_epoch=1)
    plan = read_table(store, "test", "wide")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") < plan.index("Exchange") and plan.count("Exchange") == 1
    bulk_load(store, df, "test", "wide", conf=LoadConf(count_keys=False), load_epoch=1)
    plan = read_table(store, "test", "wide")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_max") and plan.count("Exchange") == 1
    assert sorted(read_table(store, "test", "wide").collect()) == sorted(df.collect())


def test_hot_keys_are_combined_before_the_shuffle(spark, store, wide):
    hot = spark.range(3000).select(F.lit(1).cast("bigint").alias("p"), F.lit(1).alias("c"), F.col("id").cast("string").alias("v"))
    entry = bulk_load(store, hot.union(frame(spark, 3000)), "test", "wide", load_epoch=1)
    assert (entry.keys, entry.most_versions) == (3000, 3001)
    plan = read_table(store, "test", "wide")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_max")


def test_newest_rows_are_limited_before_the_shuffle(spark, store, wide):
    df = frame(spark, 100)
    bulk_load(store, df, "test", "wide", load_epoch=1)
    bulk_load(store, df, "test", "wide", load_epoch=2)
    plan = read_table(store, "test", "wide")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_one_shuffle_per_load(spark, store, wide):
    from keyedload.operators.load import mutation_rows

    rows = mutation_rows(frame(spark), wide, wide.columns, LoadConf(ttl=5), 1)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    # Constants are added behind the shuffle.
    assert plan.index("_expires_at") < plan.index("Exchange")


def test_reports(spark, store, wide):
    conf = LoadConf("md5", ring=(0, 2**59))
    bulk_load(store, frame(spark, 1000), "test", "wide", conf=conf)
    bulk_load(store, frame(spark, 500), "test", "wide", conf=conf)
    per_node = {r.node: r.rows for r in replica_report(store, "test", "wide", 2, 2).collect()}
    assert per_node == {0: 1500, 1: 1500}
    log = load_log(store, "test", "wide").orderBy("rows").collect()
    assert [(r.rows, r.partitioner, r.buckets, r.ring) for r in log] == [(500, "md5", 2, [0, 2**59]), (1000, "md5", 2, [0, 2**59])]
    assert all(r.seconds > 0 and r.rows_per_second > 0 for r in log)
