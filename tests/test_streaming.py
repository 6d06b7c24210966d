import time

import pytest
from pyspark.sql import functions as F

from keyedload import LoadConf, LoadError, TableSpec, bulk_load, read_table
from keyedload.streaming import stream_load, throttled_files


@pytest.fixture
def numbers(spark, store, tmp_path):
    spec = store.create_table(TableSpec("test", "numbers", "k bigint, v bigint", ("k",)))
    path = str(tmp_path / "in")
    spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).repartition(4).write.parquet(path)
    return spec, path


def run(store, stream, checkpoint, conf, **options):
    query = stream_load(store, stream, "test", "numbers", checkpoint, conf=conf, **options)
    try:
        query.processAllAvailable()
        return [p for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()


def test_bytes_per_trigger_bounds_the_batches(spark, store, numbers, tmp_path):
    spec, path = numbers
    conf = LoadConf(bytes_per_trigger=1)
    batches = run(store, throttled_files(spark, path, spec.schema, conf), str(tmp_path / "cp"), conf)
    # A file is larger than the cap and taken whole: four files, four loads.
    assert len(batches) == 4 and store.log(spec).count() == 4
    assert sorted(tuple(r) for r in read_table(store, "test", "numbers").collect()) == [(i, 2 * i) for i in range(400)]


def test_without_a_cap_there_is_one_load(spark, store, numbers, tmp_path):
    spec, path = numbers
    run(store, throttled_files(spark, path, spec.schema, LoadConf()), str(tmp_path / "cp"), LoadConf())
    assert store.log(spec).count() == 1 and read_table(store, "test", "numbers").count() == 400


def test_restart_loads_only_what_is_new(spark, store, numbers, tmp_path):
    spec, path = numbers
    conf = LoadConf()
    for i in range(2):
        run(store, throttled_files(spark, path, spec.schema, conf), str(tmp_path / "cp"), conf)
        spark.range(5).select((F.col("id") + 1000).alias("k"), F.lit(1).cast("bigint").alias("v")).coalesce(1).write.mode("append").parquet(path)
    assert store.log(spec).agg(F.sum("rows")).first()[0] == 405


def test_replayed_batch_is_loaded_once(spark, store, numbers, tmp_path):
    """The same batch numbers under the same stream id, as after a lost commit."""
    spec, path = numbers
    conf = LoadConf(timestamp=1)
    for attempt in ("cp1", "cp2"):
        run(store, throttled_files(spark, path, spec.schema, conf), str(tmp_path / attempt), conf, stream_id="s")
    assert [r.load_id for r in store.published(spec)] == ["s-0"]
    assert read_table(store, "test", "numbers").count() == 400


def test_a_cap_of_the_session_holds_for_a_single_load(spark, store, numbers):
    spec, path = numbers
    df = spark.read.parquet(path)
    started = time.monotonic()
    spark.conf.set("spark.keyedload.bytesPerTrigger", str(400 * 16 // 2))
    spark.conf.set("spark.keyedload.triggerSeconds", "3")
    try:
        assert bulk_load(store, df, "test", "numbers").rows == 400
    finally:
        spark.conf.unset("spark.keyedload.bytesPerTrigger")
        spark.conf.unset("spark.keyedload.triggerSeconds")
    assert time.monotonic() - started > 3
    assert store.log(spec).count() == 1 and read_table(store, "test", "numbers").count() == 400


def test_a_published_load_is_passed_over_on_demand(spark, store, numbers):
    spec, path = numbers
    df = spark.read.parquet(path)
    assert bulk_load(store, df, "test", "numbers", load_id="one").rows == 400
    assert bulk_load(store, df, "test", "numbers", load_id="one", if_published="skip") is None
    with pytest.raises(LoadError):
        bulk_load(store, df, "test", "numbers", load_id="one")
