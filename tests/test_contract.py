import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from keyedload import ContractError, LoadConf, LoadError, TableSpec, bulk_load, from_rdd, read_rejects, read_table

ROW = ("1", "d1", 1, "x", 1.5)


@pytest.fixture
def one(spark, notes):
    return spark.createDataFrame([ROW], notes.schema)


def rows(store, as_of=None):
    return sorted(tuple(r) for r in read_table(store, "test", "notes", as_of).collect())


def test_unknown_column(store, one):
    with pytest.raises(ContractError, match="nope"):
        bulk_load(store, one, "test", "notes", columns=["id", "date", "nope"])


def test_key_must_be_selected(store, one):
    with pytest.raises(ContractError, match="date"):
        bulk_load(store, one, "test", "notes", columns=["id", "a"])


def test_unknown_column_is_reported_before_missing_key(store, one):
    with pytest.raises(ContractError, match="nope"):
        bulk_load(store, one, "test", "notes", columns=["nope", "a"])


def test_collection_behaviours_are_refused(store, one):
    bulk_load(store, one, "test", "notes", columns=["id", "date", ("a", "replace")])
    for behaviour in ("add", "remove", "append", "prepend"):
        with pytest.raises(ContractError, match=behaviour):
            bulk_load(store, one, "test", "notes", columns=["id", "date", ("a", behaviour)])


def test_strict_input_must_have_exactly_the_columns(store, one):
    with pytest.raises(ContractError, match="extra"):
        bulk_load(store, one.withColumn("extra", F.lit(1)), "test", "notes")
    with pytest.raises(ContractError, match="lacks"):
        bulk_load(store, one.drop("c"), "test", "notes")


def test_names_compare_with_case(store, one):
    with pytest.raises(ContractError):
        bulk_load(store, one.withColumnRenamed("a", "A"), "test", "notes")


def test_named_columns_discard_the_others(store, one):
    bulk_load(store, one.withColumn("extra", F.lit(1)), "test", "notes", columns=["id", "date", "b", "b"])
    assert rows(store) == [("1", "d1", None, "x", None)]


def test_by_name_in_any_order(store, one):
    bulk_load(store, one.select("c", "b", "date", "a", "id"), "test", "notes")
    assert rows(store) == [ROW]


def test_by_position(store, one):
    bulk_load(store, one.toDF("p", "q", "r", "s", "t"), "test", "notes", positional=True)
    assert rows(store) == [ROW]
    with pytest.raises(ContractError):
        bulk_load(store, one.select("id", "date"), "test", "notes", positional=True)


def test_by_position_with_option_column_last(store, one):
    df = one.withColumn("t", F.lit(7)).toDF("p", "q", "r", "s", "t", "u")
    bulk_load(store, df, "test", "notes", conf=LoadConf(timestamp="w"), positional=True)
    assert rows(store) == [ROW]


def test_rdds(spark, store, notes):
    tuples = spark.sparkContext.parallelize([ROW])
    bulk_load(store, from_rdd(spark, tuples, notes.schema), "test", "notes")
    named = spark.sparkContext.parallelize([Row(date="d2", id="1", c=2.5, b="y", a=2)])
    bulk_load(store, from_rdd(spark, named, "date string, id string, c double, b string, a int"), "test", "notes")
    empty = spark.sparkContext.parallelize([], 1)
    bulk_load(store, from_rdd(spark, empty, notes.schema), "test", "notes")
    assert rows(store) == [ROW, ("1", "d2", 2, "y", 2.5)]


def test_mapper(store, one):
    bulk_load(store, one.drop("a"), "test", "notes", mapper=lambda df: df.withColumn("a", F.length("b")))
    assert rows(store) == [ROW]


def test_option_columns_are_not_data(store, one):
    df = one.withColumn("ttl", F.lit(10)).withColumn("w", F.lit(5))
    bulk_load(store, df, "test", "notes", conf=LoadConf(ttl="ttl", timestamp="w"), load_epoch=100)
    assert rows(store, as_of=109) == [ROW]
    assert rows(store, as_of=110) == []
    with pytest.raises(ContractError, match="lacks"):
        bulk_load(store, one, "test", "notes", conf=LoadConf(ttl="ttl"))
    with pytest.raises(ContractError, match="key"):
        bulk_load(store, one, "test", "notes", conf=LoadConf(ttl="date"))


def test_empty_input_is_a_load_of_no_rows(store, one):
    entry = bulk_load(store, one.where("id = 'none'"), "test", "notes")
    assert entry.rows == 0
    assert rows(store) == []


def test_bad_value_fails_the_load_and_leaves_nothing(spark, store, notes):
    df = spark.createDataFrame([("1", "d1", "1", "x", "1.5"), ("1", "d2", "oops", "x", "1.5")], "id string, date string, a string, b string, c string")
    with pytest.raises(Exception, match="column a: cannot convert to int: oops"):
        bulk_load(store, df, "test", "notes")
    assert rows(store) == []


def test_bad_value_fails_without_ansi_mode_too(spark, store, notes):
    df = spark.createDataFrame([("1", "d1", "99999999999", "x", "1.5")], "id string, date string, a string, b string, c string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="cannot convert"):
            bulk_load(store, df, "test", "notes")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_rejects(spark, store, notes):
    data = [("1", "d1", "1", "x", "1.5"), ("1", "d2", "oops", "x", "bad"), ("1", "d3", None, "y", None)]
    df = spark.createDataFrame(data, "id string, date string, a string, b string, c string")
    entry = bulk_load(store, df, "test", "notes", conf=LoadConf(on_bad_value="reject"))
    assert (entry.rows, entry.rejected) == (2, 1)
    assert rows(store) == [ROW, ("1", "d3", None, "y", None)]
    kept = read_rejects(store, "test", "notes", entry.load_id).collect()
    assert [(r.date, r.a, r._bad_columns) for r in kept] == [("d2", "oops", ["a", "c"])]


@pytest.mark.parametrize("mode", ["fail", "reject"])
def test_null_keys_fail(spark, store, notes, mode):
    df = spark.createDataFrame([("1", None, 1, "x", 1.5)], notes.schema)
    with pytest.raises(Exception, match="null in key column date"):
        bulk_load(store, df, "test", "notes", conf=LoadConf(on_bad_value=mode))


def test_negative_ttl_in_a_row_fails(store, one):
    with pytest.raises(Exception, match="negative ttl: -5"):
        bulk_load(store, one.withColumn("t", F.lit(-5)), "test", "notes", conf=LoadConf(ttl="t"))


def test_load_ids(store, one):
    bulk_load(store, one, "test", "notes", load_id="day-1")
    with pytest.raises(LoadError, match="published already"):
        bulk_load(store, one, "test", "notes", load_id="day-1")
    with pytest.raises(ValueError):
        bulk_load(store, one, "test", "notes", load_id="../x")
    bulk_load(store, one, "test", "notes", load_id="20240101")
    assert rows(store) == [ROW]


def test_unusual_column_names(spark, store):
    schema = "`a.b` int, `x y` string, `q``t` double"
    store.create_table(TableSpec("test", "odd", schema, ("a.b",), ("x y",)))
    df = spark.createDataFrame([(1, "z", 2.0), (1, "z", 3.0)], schema)
    bulk_load(store, df, "test", "odd", conf=LoadConf(ttl=10), load_epoch=0)
    bulk_load(store, df, "test", "odd", columns=["a.b", "x y"], load_epoch=1)
    assert [tuple(r) for r in read_table(store, "test", "odd", as_of=5).collect()] == [(1, "z", 3.0)]
    store.create_table(TableSpec("test", "odd2", schema, ("a.b",), ("x y",)))
    bulk_load(store, df.limit(1), "test", "odd2", load_epoch=0)
    bulk_load(store, df, "test", "odd2", load_epoch=1)
    for s in ("overlay", "cells"):
        assert [tuple(r) for r in read_table(store, "test", "odd2", strategy=s).collect()] == [(1, "z", 3.0)]
