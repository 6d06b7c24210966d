"""Split points from the data, against counts of the ranges they make."""

import datetime as dt
from bisect import bisect_right
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keyedload import LoadConf, LoadError, TableSpec, bulk_load, ordered_split_points
from keyedload.operators import split
from keyedload.operators.report import bucket_report


def best_cut(keys, ranges):
    """The smallest bound under which ranges of whole keys are enough, keys above it alone: by trying every bound."""
    counts = [n for _, n in sorted(Counter(keys).items())]
    for most in range(1, len(keys) + 1):
        used, held = 1, 0
        for n in counts:
            if held and held + n > most:
                used, held = used + 1, 0
            held += n
        if used <= ranges:
            return most
    return 0


def frame(spark, keys, kind="bigint"):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], f"k {kind}, c int").repartition(7)


@pytest.fixture(scope="module")
def plain(spark):
    return TableSpec("test", "s", "k bigint, c int", ("k",), ("c",))


DATA = {
    "distinct": [(i * 7919) % 100_003 for i in range(6000)],
    "hot third": [i * 5 if i % 3 else 9000 for i in range(6000)],
    "two hot": [(0, 29_999, i)[i % 3] for i in range(6000)],
    "all equal": [4] * 3000,
    "few keys": [i % 5 for i in range(3000)],
}


@pytest.mark.parametrize("name", DATA)
@pytest.mark.parametrize("ranges, error", [(4, 0.1), (16, 0.5)])
def test_ranges_are_as_even_as_keys_allow(spark, plain, name, ranges, error, monkeypatch):
    # Small batches, so that several levels are needed.
    monkeypatch.setattr(split, "ROWS_PER_STEP", 2)
    keys = DATA[name]
    points = list(ordered_split_points(frame(spark, keys), plain, ranges, error))
    assert points == sorted(set(points)) and len(points) < ranges
    made = {}
    for k in keys:
        made.setdefault(bisect_right(points, k), []).append(k)
    give = error * len(keys) / ranges
    most = best_cut(keys, ranges) + give
    for held in made.values():
        # A key that is too frequent for a range begins one, with little besides.
        first = held.count(min(held))
        assert len(held) <= most or (first > most - give and len(held) - first <= give)


def test_every_batch_adds_at_most_a_step(spark):
    rows = split.pa.table({"k": [i // 2 for i in range(1000)] + [77] * 500, split.WEIGHT: [1] * 1500})
    found = split._steps(rows, ["k"], 10)
    assert found.num_rows <= 11 and sum(found.column(split.WEIGHT).to_pylist()) == 1500
    upto = 0
    exact = Counter(rows.column("k").to_pylist())
    for k, n in zip(found.column("k").to_pylist(), found.column(split.WEIGHT).to_pylist()):
        upto += n
        assert upto == sum(m for x, m in exact.items() if x <= k)
        assert n <= 150 + exact[k]


@pytest.mark.parametrize(
    "kind, make",
    [
        ("string", lambda i: f"é{i % 300:04d}" if i % 2 else f"z{i:05d}"),
        ("date", lambda i: dt.date(2000, 1, 1) + dt.timedelta(days=i)),
        ("timestamp", lambda i: dt.datetime(2000, 1, 1) + dt.timedelta(seconds=i * 1801)),
        ("decimal(12,2)", lambda i: split.decimal.Decimal(i * 3) / 4),
        ("double", lambda i: float("nan") if i % 9 == 0 else i / 3 - 500),
    ],
)
def test_points_of_other_types_are_what_a_load_takes(spark, store, kind, make):
    spec = store.create_table(TableSpec("test", "s", f"k {kind}, c int", ("k",), ("c",)))
    df = frame(spark, [make(i) for i in range(2000)], kind)
    points = ordered_split_points(df, spec, 8)
    bulk_load(store, df, "test", "s", conf=LoadConf("ordered", split_points=points))
    sizes = [r["rows"] for r in bucket_report(store, "test", "s").collect()]
    assert sum(sizes) == 2000 and len(sizes) == 8 and max(sizes) <= 1.1 * 250 + 1


def test_compound_keys_and_text_that_is_converted(spark, store):
    spec = store.create_table(TableSpec("test", "s", "a int, b string, c int", ("a", "b"), ("c",)))
    rows = [(str(i % 3), f"b{i:04d}", i) for i in range(1200)] + [(None, "x", 1), ("1", None, 1), ("one", "x", 1)] * 500
    df = spark.createDataFrame(rows, "a string, b string, c int")
    points = ordered_split_points(df, spec, 6)
    assert all(isinstance(p, tuple) and isinstance(p[0], int) for p in points)
    conf = LoadConf("ordered", split_points=points, on_bad_value="reject")
    assert bulk_load(store, df.na.drop(), "test", "s", conf=conf).rejected == 500
    sizes = [r["rows"] for r in bucket_report(store, "test", "s").collect()]
    assert len(sizes) == 6 and max(sizes) <= 220


def test_edges(spark, plain):
    assert ordered_split_points(frame(spark, []), plain, 4) == ()
    assert ordered_split_points(frame(spark, [1, 2, 3]), plain, 1) == ()
    assert ordered_split_points(frame(spark, [5]), plain, 4) == ()
    with pytest.raises(ValueError, match="ranges"):
        ordered_split_points(frame(spark, [5]), plain, 0)
    with pytest.raises(LoadError, match="split points"):
        ordered_split_points(spark.createDataFrame([(b"a",)], "k binary"), TableSpec("test", "s", "k binary", ("k",)), 2)
    # A column that is not of the key may have any name.
    named = frame(spark, range(100)).withColumn(split.WEIGHT, F.lit("x")).withColumn("k0", F.lit(None))
    assert len(ordered_split_points(named, plain, 4)) == 3
