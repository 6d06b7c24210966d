import datetime as dt

import pytest
from pyspark.sql import types as T

from keyedload import KeyedStore, LoadConf, LoadError, TableNotFound, TableSpec, bulk_load, read_table, scratch_root
from keyedload.spec import UNSET_INT


def test_spec_survives_json(spark):
    spec = TableSpec("ks", "t", "a string, b int, c map<string,int>, d timestamp_ntz", ("a",), (("b", "desc"),))
    assert TableSpec.from_json(spec.to_json()) == spec
    assert spec.key == ["a", "b"]
    assert spec.regular == ["c", "d"]
    assert spec.clustering == (("b", "desc"),)


@pytest.mark.parametrize(
    "schema, partition_key, clustering",
    [
        ("a int, b int", (), ()),
        ("a int, b int", ("x",), ()),
        ("a int, b int", ("a",), ("a",)),
        ("a int, b int", ("a",), (("b", "sideways"),)),
        ("a int, _wts int", ("a",), ()),
        ("a int, Load_Id int", ("a",), ()),
        ("a array<int>, b int", ("a",), ()),
    ],
)
def test_bad_specs(spark, schema, partition_key, clustering):
    with pytest.raises(ValueError):
        TableSpec("ks", "t", schema, partition_key, clustering)


def test_names_are_case_sensitive(spark):
    schema = T.StructType([T.StructField("A", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(ValueError):
        TableSpec("ks", "t", schema, ("a",))


def test_unknown_partitioner_lists_the_known_ones():
    with pytest.raises(ValueError, match="hash, md5, ordered"):
        LoadConf(partitioner="murmur")


@pytest.mark.parametrize(
    "settings",
    [
        {"ttl": -1},
        {"buckets": 0},
        {"writers_per_bucket": 0},
        {"on_bad_value": "ignore"},
        {"ring": (5, 3)},
        {"ring": ()},
        {"ring": (1,), "partitioner": "ordered"},
        {"split_points": (1,)},
        {"split_points": (dt.date(2024, 1, 1),), "partitioner": "ordered"},
        {"bytes_per_trigger": 0},
        {"trigger_seconds": 0},
        {"ttl": "x", "timestamp": "x"},
    ],
)
def test_bad_settings(settings):
    with pytest.raises(ValueError):
        LoadConf(**settings)


def test_settings_from_the_session(spark):
    assert LoadConf.from_spark(spark) == LoadConf()
    keys = {"ttl": "60", "partitioner": "md5", "buckets": "4", "writersPerBucket": "2", "bytesPerTrigger": "1000"}
    try:
        for k, v in keys.items():
            spark.conf.set(f"spark.keyedload.{k}", v)
        conf = LoadConf.from_spark(spark)
        assert conf == LoadConf("md5", 4, writers_per_bucket=2, ttl=60, bytes_per_trigger=1000)
        assert conf.throttled
        spark.conf.set("spark.keyedload.ttl", str(UNSET_INT))
        spark.conf.set("spark.keyedload.bytesPerTrigger", str(UNSET_INT))
        conf = LoadConf.from_spark(spark)
        assert conf.ttl is None and not conf.throttled
        spark.conf.set("spark.keyedload.partitioner", "other")
        with pytest.raises(ValueError):
            LoadConf.from_spark(spark)
    finally:
        for k in keys:
            spark.conf.unset(f"spark.keyedload.{k}")


def test_session_ttl_is_used_by_a_load(spark, store, notes):
    df = spark.createDataFrame([("1", "x", 1, "b", 2.0)], notes.schema)
    spark.conf.set("spark.keyedload.ttl", "100")
    try:
        bulk_load(store, df, "test", "notes", load_epoch=1000)
    finally:
        spark.conf.unset("spark.keyedload.ttl")
    assert read_table(store, "test", "notes", as_of=1099).count() == 1
    assert read_table(store, "test", "notes", as_of=1100).count() == 0


def test_missing_table(spark, store):
    df = spark.range(1)
    with pytest.raises(TableNotFound, match="no.such"):
        bulk_load(store, df, "no", "such")
    with pytest.raises(TableNotFound):
        read_table(store, "no", "such")


def test_table_cannot_be_created_twice(store, notes):
    with pytest.raises(LoadError, match="exists"):
        store.create_table(notes)
    assert store.spec("test", "notes") == notes


def test_names_that_would_leave_the_root(spark, store):
    with pytest.raises(ValueError):
        store.spec("..", "t")
    with pytest.raises(ValueError):
        KeyedStore(spark, "/x").table_path("a", "b/c")


def test_empty_table_reads_as_no_rows(store, notes):
    df = read_table(store, "test", "notes")
    assert df.columns == notes.columns
    assert df.count() == 0


@pytest.mark.parametrize("point", [float("inf"), float("-inf"), float("nan")])
def test_split_points_are_finite(point):
    with pytest.raises(ValueError, match="finite"):
        LoadConf("ordered", split_points=(point,))


def test_names_that_differ_only_in_case_are_refused():
    with pytest.raises(ValueError, match="case"):
        TableSpec("k", "t", "id int, Id int", ("id",))
    with pytest.raises(ValueError):
        TableSpec("k", "t", "s struct<m:map<int,int>>, v int", ("s",))


class _Session:
    """What a scratch folder asks of a session."""

    def __init__(self, master, conf=None, checkpoint=None):
        self.sparkContext = self
        self.master, self.applicationId, self.set, self.checkpoint = master, f"app-{master}", conf or {}, checkpoint
        self.conf = self

    def get(self, key, default=None):
        return self.set.get(key, default)

    def getCheckpointDir(self):
        return self.checkpoint


def test_scratch_folders():
    with pytest.raises(LoadError, match="spark.checkpoint.dir"):
        scratch_root(_Session("spark://host:7077"))
    shared = scratch_root(_Session("yarn", {"spark.checkpoint.dir": "hdfs:///c/"}))
    assert shared.startswith("hdfs:///c/keyedload-app-yarn/")
    assert scratch_root(_Session("yarn", checkpoint="hdfs:///d")).startswith("hdfs:///d/keyedload-app-yarn/")
    a, b = (scratch_root(_Session("local[2]")) for _ in range(2))
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
