"""The loader's basic cases, with every value checked: text, numbers, dates."""

import datetime as dt

import pytest

from keyedload import LoadConf, TableSpec, bulk_load, from_rdd, read_csv, read_table

# The inputs these cases are checked with.
SIMPLE = [
    ("1", "20190801", "aaa"),
    ("1", "20190802", "bbb"),
    ("1", "20190804", "ccc"),
    ("2", "20190803", "ddd"),
    ("3", "20190802", "eee"),
    ("3", "20190803", "fff"),
    ("3", "20190805", "ggg"),
    ("4", "20190810", "hhh"),
    ("4", "20190811", "iii"),
    ("4", "20190812", "jjj"),
    ("4", "20190813", "kkk"),
    ("5", "20190802", "lll"),
]
NUMERIC = [
    ("1", "20190801", "4", "1.34"),
    ("1", "20190802", "-7", "4.23"),
    ("1", "20190804", "123", "0.003"),
    ("2", "20190803", "-92", "0.3245"),
    ("3", "20190802", "3252", "-0.45566"),
    ("3", "20190803", "-95213", "-314123.9832"),
    ("3", "20190805", "0", "0"),
    ("4", "20190810", "-41", "0"),
    ("4", "20190811", "31", "0"),
]
DATES = [("1", "2019-08-02", "2019-08-04 17:54:22.242"), ("2", "2019-08-01", "2019-08-01T04:12:31.153+0000")]


def csv(spark, tmp_path, header, rows):
    path = tmp_path / "in.csv"
    path.write_text("\n".join(",".join(r) for r in [header, *rows]) + "\n")
    return read_csv(spark, str(path))


def contents(store, table):
    return sorted(tuple(r) for r in read_table(store, "test", table).collect())


@pytest.mark.parametrize("partitioner", ["hash", "md5", "ordered"])
def test_text_table(spark, store, tmp_path, partitioner):
    store.create_table(TableSpec("test", "string_only", "id string, date string, value string", ("id",), ("date",)))
    df = csv(spark, tmp_path, ("id", "date", "value"), SIMPLE)
    points = ("2", "4") if partitioner == "ordered" else ()
    bulk_load(store, df, "test", "string_only", conf=LoadConf(partitioner, split_points=points))
    assert contents(store, "string_only") == SIMPLE


def test_rows_names_order_and_repeats(spark, store, tmp_path):
    store.create_table(TableSpec("test", "rdd_row", "id string, date string, value string", ("id",), ("date",)))
    df = csv(spark, tmp_path, ("id", "date", "value"), SIMPLE)
    bulk_load(store, from_rdd(spark, df.rdd, df.schema), "test", "rdd_row")
    assert contents(store, "rdd_row") == SIMPLE
    bulk_load(store, df.toDF("id", "date", "value"), "test", "rdd_row")
    assert contents(store, "rdd_row") == SIMPLE
    other = csv(spark, tmp_path, ("id", "value", "date"), [(i, v, d) for i, d, v in SIMPLE])
    bulk_load(store, other, "test", "rdd_row")
    assert contents(store, "rdd_row") == SIMPLE


def test_tuples(spark, store, tmp_path):
    spec = store.create_table(TableSpec("test", "rdd_not_row", "id string, date string, value string", ("id",), ("date",)))
    tuples = csv(spark, tmp_path, ("id", "date", "value"), SIMPLE).rdd.map(lambda r: (r[0], r[1], r[2]))
    bulk_load(store, from_rdd(spark, tuples, spec.schema), "test", "rdd_not_row")
    assert contents(store, "rdd_not_row") == SIMPLE


def test_numeric_table(spark, store, tmp_path):
    store.create_table(TableSpec("test", "numeric", "id string, date string, value1 int, value2 float", ("id",), ("date",)))
    bulk_load(store, csv(spark, tmp_path, ("id", "date", "value1", "value2"), NUMERIC), "test", "numeric")
    got = contents(store, "numeric")
    assert [r[:3] for r in got] == [(i, d, int(a)) for i, d, a, _ in NUMERIC]
    for row, (_, _, _, b) in zip(got, NUMERIC):
        assert row[3] == pytest.approx(float(b), rel=1e-6)


def test_date_table(spark, store, tmp_path):
    store.create_table(TableSpec("test", "date_type", "id string, value1 date, value2 timestamp", ("id",)))
    bulk_load(store, csv(spark, tmp_path, ("id", "value1", "value2"), DATES), "test", "date_type")
    got = read_table(store, "test", "date_type").selectExpr("id", "value1", "unix_millis(value2) ms").collect()
    utc = dt.timezone.utc
    expected = {
        "1": (dt.date(2019, 8, 2), dt.datetime(2019, 8, 4, 17, 54, 22, 242000, utc)),
        "2": (dt.date(2019, 8, 1), dt.datetime(2019, 8, 1, 4, 12, 31, 153000, utc)),
    }
    assert {r.id: (r.value1, r.ms) for r in got} == {
        k: (d, int(t.timestamp() * 1000 + 0.5)) for k, (d, t) in expected.items()
    }


def test_dates_without_dashes_do_not_load(spark, store):
    store.create_table(TableSpec("test", "days", "id string, day date", ("id",)))
    with pytest.raises(Exception, match="20190801"):
        bulk_load(store, spark.createDataFrame([("1", "20190801x")], "id string, day string"), "test", "days")


def test_csv_with_fixed_names(spark, tmp_path):
    csv(spark, tmp_path, ("id", "date", "value"), SIMPLE)
    df = read_csv(spark, str(tmp_path / "in.csv"), columns=["id", "date", "value"])
    assert sorted(tuple(r) for r in df.collect()) == SIMPLE
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "in.csv"), columns=["id", "value", "date"]).collect()
