"""Merged reads against a row-by-row model, under every strategy that may be used."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import types as T

from keyedload import LoadConf, LoadError, TableSpec, bulk_load, lookup, publish_load, read_table
from keyedload.operators import resolve
from keyedload.operators.resolve import NEVER, allowed_strategies, facts_of

SCHEMA = "k int, c int, x int, y string, z double"
COLUMNS = ["k", "c", "x", "y", "z"]


@pytest.fixture
def table(store):
    return store.create_table(TableSpec("test", "m", SCHEMA, ("k",), ("c",)))


def model(loads, as_of):
    """Current rows by the rules, one cell at a time."""
    cells, markers = {}, {}
    for rows, columns in loads:
        for row, wts, expires in rows:
            key = (row["k"], row["c"])
            expires = NEVER if expires is None else expires
            markers.setdefault(key, []).append((wts, expires))
            for col in ("x", "y", "z"):
                if col in columns:
                    v = row[col]
                    # Nulls last among values never matters: a null is decided by the dead flag.
                    cells.setdefault((key, col), []).append((wts, v is None, (v is not None, v), expires))
    out = []
    for key, marks in markers.items():
        values = []
        for col in ("x", "y", "z"):
            versions = cells.get((key, col))
            if not versions:
                values.append(None)
                continue
            # Of equal timestamps: deletes first, then the larger value, then the longer life.
            top = max(v[:2] for v in versions)
            same = [v for v in versions if v[:2] == top]
            _, _, (_, value), expires = same[0] if top[1] else max(same, key=lambda v: (v[2][1], v[3]))
            values.append(value if expires > as_of else None)
        if max(marks)[1] > as_of or any(v is not None for v in values):
            out.append((*key, *values))
    return sorted(out, key=repr)


def random_loads(seed, ttl, partial, per_row_time):
    rnd = random.Random(seed)
    loads = []
    for n in range(rnd.randint(1, 4)):
        columns = COLUMNS
        if partial and n:
            columns = ["k", "c"] + [c for c in ("x", "y", "z") if rnd.random() < 0.5]
        rows = []
        for _ in range(rnd.randint(0, 60)):
            row = {
                "k": rnd.randint(0, 3),
                "c": rnd.randint(0, 4),
                "x": rnd.choice([None, -5, 0, 7]),
                "y": rnd.choice([None, "", "a", "b"]),
                "z": rnd.choice([None, -1.5, 2.5]),
            }
            wts = rnd.randint(0, 4) if per_row_time else n * 1_000_000
            life = rnd.choice([None, 0, 10, 20, 30]) if ttl else None
            rows.append((row, wts, life, n + life if life else None))
        loads.append((rows, columns))
    return loads


@pytest.mark.parametrize("ttl", [False, True])
@pytest.mark.parametrize("partial", [False, True])
@pytest.mark.parametrize("per_row_time", [False, True])
def test_random_loads(spark, store, table, ttl, partial, per_row_time):
    seed = 100 * ttl + 10 * partial + per_row_time
    loads = random_loads(seed, ttl, partial, per_row_time)
    for n, (rows, columns) in enumerate(loads):
        data = [(*[r[c] for c in COLUMNS], wts, life) for r, wts, life, _ in rows]
        df = spark.createDataFrame(data, SCHEMA + ", w bigint, life int")
        if not ttl:
            df = df.drop("life")
        if not per_row_time:
            df = df.drop("w")
        conf = LoadConf(timestamp="w" if per_row_time else None, ttl="life" if ttl else None)
        bulk_load(store, df, "test", "m", columns=columns, conf=conf, load_epoch=n)
    simple = [([(r, w, e) for r, w, _, e in rows], columns) for rows, columns in loads]
    for as_of in (15, 40) if ttl else (15,):
        expected = model(simple, as_of)
        for strategy in allowed_strategies(facts_of(table, [r for r in store.published(table) if r.rows])):
            got = read_table(store, "test", "m", as_of, strategy).collect()
            assert sorted((tuple(r) for r in got), key=repr) == expected, strategy


def strategies(store, table):
    return allowed_strategies(facts_of(table, [r for r in store.published(table) if r.rows]))


def test_strategy_choice(spark, store, table):
    unique = spark.createDataFrame([(1, 1, 1, "a", 1.0), (1, 2, 2, "b", None)], SCHEMA)
    bulk_load(store, unique, "test", "m", load_epoch=1)
    assert strategies(store, table) == ["direct", "latest", "tied", "newest", "cells"]
    bulk_load(store, unique.limit(0), "test", "m", load_epoch=1)
    assert strategies(store, table) == ["direct", "latest", "tied", "newest", "cells"]
    bulk_load(store, unique, "test", "m", load_epoch=2)
    assert strategies(store, table) == ["latest", "newest", "cells", "overlay"]
    # The same write timestamp again: ties are possible, but not with the first load.
    bulk_load(store, unique, "test", "m", load_epoch=2)
    assert strategies(store, table) == ["newest", "cells", "overlay"]
    # Without counted keys there is neither a base nor a bound.
    bulk_load(store, unique, "test", "m", conf=LoadConf(count_keys=False), load_epoch=1)
    facts = facts_of(table, [replace(r, keys=None) for r in store.published(table) if r.rows])
    assert allowed_strategies(facts) == ["cells"]
    with pytest.raises(LoadError):
        read_table(store, "test", "m", strategy="direct")
    with pytest.raises(ValueError):
        read_table(store, "test", "m", strategy="guess")


def test_small_newer_loads_overlay_a_base(spark, store, table):
    base = spark.createDataFrame([(i, 1, i, "a", 1.0) for i in range(100)], SCHEMA)
    bulk_load(store, base, "test", "m", load_epoch=1)
    changes = spark.createDataFrame([(5, 1, -5, None, 2.0), (5, 1, -6, "z", 2.0), (500, 1, 500, "new", 0.0)], SCHEMA)
    bulk_load(store, changes, "test", "m", load_epoch=2)
    expiring = spark.createDataFrame([(7, 1, -7, "soon gone", 2.0)], SCHEMA)
    bulk_load(store, expiring, "test", "m", conf=LoadConf(ttl=10), load_epoch=3)
    assert strategies(store, table) == ["overlay", "newest", "cells"]
    for as_of, n in ((12, 101), (13, 100)):
        got = {s: sorted(tuple(r) for r in read_table(store, "test", "m", as_of, s).collect()) for s in ("overlay", "cells")}
        assert got["overlay"] == got["cells"] and len(got["cells"]) == n
        assert (5, 1, -5, None, 2.0) in got["cells"]
    plan = read_table(store, "test", "m", 12)._jdf.queryExecution().executedPlan().toString()
    head = plan[: plan.index("BroadcastExchange")]
    assert "LeftAnti" in head and "hashpartitioning" not in head


def test_small_partial_loads_overlay_a_base(spark, store, table):
    """Some columns, deletes, older timestamps, ties: only the base rows concerned are merged."""
    base = spark.createDataFrame([(i, 1, i, "a", 1.0) for i in range(100)], SCHEMA)
    bulk_load(store, base, "test", "m", load_epoch=5)
    bulk_load(store, spark.createDataFrame([(1, 1, -1, "old", 9.0), (200, 1, 2, "b", 3.0)], SCHEMA), "test", "m", load_epoch=4)
    bulk_load(store, spark.createDataFrame([(2, 1, 99), (3, 1, None)], "k int, c int, x int"), "test", "m", columns=["k", "c", "x"], load_epoch=5)
    bulk_load(store, spark.createDataFrame([(4, 1, "new")], "k int, c int, y string"), "test", "m", columns=["k", "c", "y"], conf=LoadConf(ttl=10), load_epoch=6)
    assert strategies(store, table) == ["overlay", "cells"]
    for as_of, y in ((15, "new"), (16, None)):
        got = {s: sorted((tuple(r) for r in read_table(store, "test", "m", as_of, s).collect()), key=repr) for s in ("overlay", "cells")}
        assert got["overlay"] == got["cells"] and len(got["cells"]) == 101
        for row in [(1, 1, 1, "a", 1.0), (200, 1, 2, "b", 3.0), (2, 1, 99, "a", 1.0), (3, 1, None, "a", 1.0), (4, 1, 4, y, 1.0)]:
            assert row in got["cells"]
    plan = read_table(store, "test", "m", 15)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "LeftSemi" in plan and "SortMergeJoin" not in plan


def test_many_loads_of_growing_size(spark, store, table):
    """A base of a base: each read strips off the largest load, merging only what is left."""
    expected = {}
    for n, size in enumerate((200, 40, 8, 1)):
        df = spark.createDataFrame([(i, 1, n, "a", 1.0) for i in range(size)], SCHEMA)
        bulk_load(store, df, "test", "m", load_epoch=n)
        expected.update({i: n for i in range(size)})
    got = read_table(store, "test", "m")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") == 3
    assert {r.k: r.x for r in got.collect()} == expected


def test_overlay_without_a_proven_bound_leaves_the_join_to_spark(spark, store, table, monkeypatch):
    base = spark.createDataFrame([(i, 1, i, "a", 1.0) for i in range(100)], SCHEMA)
    bulk_load(store, base, "test", "m", load_epoch=1)
    bulk_load(store, base.where("k < 10").withColumn("x", base.k * 2), "test", "m", load_epoch=2)
    monkeypatch.setattr(resolve, "MAX_BROADCAST_KEYS", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert strategies(store, table)[0] == "overlay"
        read = read_table(store, "test", "m", strategy="overlay")
        assert "SortMergeJoin" in read._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r) for r in read.collect()) == [(i, 1, i * 2 if i < 10 else i, "a", 1.0) for i in range(100)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_later_load_wins_within_the_same_second(spark, store, table):
    for x in (9, 5, 7):
        bulk_load(store, spark.createDataFrame([(1, 1, x, "a", 1.0)], SCHEMA), "test", "m")
    assert [r.x for r in read_table(store, "test", "m").collect()] == [7]
    times = [r.min_wts for r in store.published(table)]
    assert len(set(times)) == 3


def test_duplicates_are_never_read_directly(spark, store, table):
    twice = spark.createDataFrame([(1, 1, 1, "b", 1.0), (1, 1, 2, "a", None)], SCHEMA)
    bulk_load(store, twice, "test", "m", load_epoch=1)
    assert strategies(store, table) == ["tied", "newest", "cells"]
    for s in ("tied", "newest", "cells"):
        assert [tuple(r) for r in read_table(store, "test", "m", strategy=s).collect()] == [(1, 1, 2, "b", None)]


def test_uncounted_keys_are_merged(spark, store, table):
    df = spark.createDataFrame([(1, 1, 1, "a", 1.0)], SCHEMA)
    bulk_load(store, df, "test", "m", conf=LoadConf(count_keys=False), load_epoch=1)
    assert strategies(store, table) == ["tied", "cells"]


def test_partial_load_is_not_read_as_whole_rows(spark, store, table):
    df = spark.createDataFrame([(1, 1, 1, "a", 1.0)], SCHEMA)
    bulk_load(store, df, "test", "m", load_epoch=1)
    bulk_load(store, df, "test", "m", columns=["k", "c", "x"], load_epoch=2)
    assert strategies(store, table) == ["cells", "overlay"]


def test_direct_read_has_no_shuffle_and_pushes_filters(spark, store, table):
    df = spark.createDataFrame([(i, 1, i, "a", 1.0) for i in range(50)], SCHEMA)
    bulk_load(store, df, "test", "m", load_epoch=1)
    read = read_table(store, "test", "m").where("x > 40").select("k")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "GreaterThan(x,40)" in plan
    assert read.count() == 9


def test_unneeded_columns_are_not_read(spark, store, table):
    df = spark.createDataFrame([(1, 1, 1, "a", 1.0), (1, 1, 2, "a", 1.0)], SCHEMA)
    bulk_load(store, df, "test", "m", load_epoch=1)
    bulk_load(store, df, "test", "m", load_epoch=2)
    plan = read_table(store, "test", "m").select("k", "x")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:int,c:int,x:int,_wts:bigint>" in plan


def test_very_many_loads_are_read_as_few_are(spark, store, table):
    """1,200 published loads, a row each: the same strategy, filters and rows, and no unpublished directory is read."""
    entry = bulk_load(store, spark.createDataFrame([(0, 1, -1, "a", 1.0)], SCHEMA), "test", "m", load_epoch=0)
    few = strategies(store, table)
    rows = store.loads(table, [entry.load_id]).drop("load_id")
    more = rows.drop("_wts", "x").crossJoin(spark.range(1, 1200).selectExpr("concat('n', id) AS load_id", "id AS _wts", "cast(id AS int) AS x"))
    more.write.mode("append").partitionBy("load_id", "_bucket").parquet(store.data_path(table))
    log = store.log(table).drop("load_id", "min_wts", "max_wts")
    log = log.crossJoin(spark.range(1, 1200).selectExpr("concat('n', id) AS load_id", "id AS min_wts", "id AS max_wts"))
    log.write.mode("append").parquet(f"{store.table_path('test', 'm')}/log")
    bulk_load(store, spark.createDataFrame([(0, 1, 7, "b", 1.0)], SCHEMA), "test", "m", load_epoch=9, publish=False)
    assert few[0] == "direct" and strategies(store, table)[0] == "latest"
    assert len(store.published(table)) == 1200
    expected = [(0, 1, 1199, "a", 1.0)]
    assert [tuple(r) for r in read_table(store, "test", "m", 10).collect()] == expected
    found = lookup(store, "test", "m", (0,), 10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan[plan.index("PartitionFilters") :] and "EqualTo(_token" in plan
    assert [tuple(r) for r in found.collect()] == expected


def test_overlay_is_right_at_any_size(spark, store, table, monkeypatch):
    bulk_load(store, spark.createDataFrame([(i, 1, i, "a", 1.0) for i in range(40)], SCHEMA), "test", "m", load_epoch=1)
    some = spark.createDataFrame([(i, 1, -i) for i in range(9)], "k int, c int, x int")
    bulk_load(store, some, "test", "m", columns=["k", "c", "x"], load_epoch=2)
    expected = sorted(tuple(r) for r in read_table(store, "test", "m", 10, strategy="cells").collect())
    monkeypatch.setattr(resolve, "MAX_BROADCAST_KEYS", 5)
    assert sorted(tuple(r) for r in read_table(store, "test", "m", 10, strategy="overlay").collect()) == expected


def test_maps_inside_collections_are_merged(spark, store):
    schema = "k int, a array<map<string,int>>, s struct<m:map<string,int>,n:int>"
    store.create_table(TableSpec("test", "nested", schema, ("k",)))
    first = [(1, [{"b": 2, "a": 1}], ({"x": 1}, 1)), (2, None, None), (3, [None], (None, 2))]
    bulk_load(store, spark.createDataFrame(first, schema), "test", "nested", load_epoch=1)
    bulk_load(store, spark.createDataFrame([(1, [{"c": 3}, {"d": 4}])], "k int, a array<map<string,int>>"), "test", "nested", columns=["k", "a"], load_epoch=2)
    got = {r.k: r for r in read_table(store, "test", "nested").collect()}
    assert got[1].a == [{"c": 3}, {"d": 4}] and got[1].s.m == {"x": 1} and got[1].s.n == 1
    assert got[2].a is None and got[2].s is None and got[3].a == [None] and got[3].s.m is None and got[3].s.n == 2


def test_lookup_by_values_as_they_were_loaded(spark, store):
    import datetime as dt
    import math

    at = dt.datetime(2024, 5, 1, 12, 0, 0, 123456)
    for partitioner in ("hash", "md5"):
        name = f"t_{partitioner}"
        store.create_table(TableSpec("test", name, "d double, t timestamp_ntz, v int", ("d", "t")))
        df = spark.createDataFrame([(-0.0, at, 1), (math.nan, at, 2), (0.5, at, 3)], "d double, t timestamp_ntz, v int")
        bulk_load(store, df, "test", name, conf=LoadConf(partitioner))
        for d, v in ((0.0, 1), (-0.0, 1), (math.nan, 2), (0.5, 3)):
            assert [r.v for r in lookup(store, "test", name, (d, at)).collect()] == [v], (partitioner, d)


def test_unpublished_loads(spark, store, table):
    df = spark.createDataFrame([(1, 1, 1, "a", 1.0)], SCHEMA)
    entry = bulk_load(store, df, "test", "m", publish=False)
    assert read_table(store, "test", "m").count() == 0
    publish_load(store, "test", "m", entry)
    assert read_table(store, "test", "m").count() == 1
    with pytest.raises(LoadError):
        publish_load(store, "test", "m", entry)


def test_log_counts_a_replayed_publication_once(spark, store, table):
    df = spark.createDataFrame([(1, 1, 1, "a", 1.0)], SCHEMA)
    entry = bulk_load(store, df, "test", "m")
    store.publish(table, entry)
    assert store.log(table).count() == 1
    assert store.published(table) == [entry]
    assert strategies(store, table)[0] == "direct"


def test_map_and_struct_cells(spark, store):
    schema = "k int, m map<string,int>, a array<int>, s struct<p:int,q:string>"
    store.create_table(TableSpec("test", "cells", schema, ("k",)))
    first = [(1, {"b": 2, "a": 1}, [1, 2], (1, "x")), (1, {"a": 1, "b": 1}, [1], (1, "y")), (2, None, None, None)]
    bulk_load(store, spark.createDataFrame(first, schema), "test", "cells", load_epoch=1)
    for s in ("tied", "cells"):
        got = {r.k: r for r in read_table(store, "test", "cells", strategy=s).collect()}
        assert got[1].m == {"a": 1, "b": 2} and got[1].a == [1, 2] and tuple(got[1].s) == (1, "y")
        assert got[2].m is None and got[2].a is None and got[2].s is None
    bulk_load(store, spark.createDataFrame([(1, {"z": 0})], "k int, m map<string,int>"), "test", "cells", columns=["k", "m"], load_epoch=2)
    got = {r.k: r for r in read_table(store, "test", "cells").collect()}
    assert got[1].m == {"z": 0} and got[1].a == [1, 2]


@pytest.mark.parametrize("strategy", ["tied", "cells"])
def test_key_only_tables(spark, store, strategy):
    store.create_table(TableSpec("test", "keys", "k int, c string", ("k",), ("c",)))
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, c string")
    bulk_load(store, df, "test", "keys", load_epoch=1)
    assert sorted(tuple(r) for r in read_table(store, "test", "keys", strategy=strategy).collect()) == [(1, "a"), (2, "b")]


def test_ttl_zero_and_null_do_not_expire(spark, store, table):
    df = spark.createDataFrame([(1, 1, 1, "a", 1.0, 0), (2, 1, 1, "a", 1.0, None), (3, 1, 1, "a", 1.0, 5)], SCHEMA + ", t int")
    bulk_load(store, df, "test", "m", conf=LoadConf(ttl="t"), load_epoch=100)
    assert sorted(r.k for r in read_table(store, "test", "m", 104).collect()) == [1, 2, 3]
    assert sorted(r.k for r in read_table(store, "test", "m", 105).collect()) == [1, 2]
    bulk_load(store, df.drop("t"), "test", "m", conf=LoadConf(ttl=0), load_epoch=101)
    assert sorted(r.k for r in read_table(store, "test", "m", 10**9).collect()) == [1, 2, 3]


@pytest.mark.parametrize("conf", [LoadConf(), LoadConf("md5", 7, writers_per_bucket=3), LoadConf("md5", ring=(5, 2**59)), LoadConf("ordered", split_points=("k2", "k5"))])
def test_lookup(spark, store, conf):
    store.create_table(TableSpec("test", "l", "p string, q int, c int, v int", ("p",) if conf.partitioner == "ordered" else ("p", "q"), ("c",) if conf.partitioner != "ordered" else ("q", "c")))
    df = spark.createDataFrame([(f"k{i % 8}", i % 3, i, i * 10) for i in range(100)], "p string, q int, c int, v int")
    bulk_load(store, df, "test", "l", conf=conf, load_epoch=1)
    bulk_load(store, df.selectExpr("p", "q", "c", "v + 1 as v"), "test", "l", conf=LoadConf(), load_epoch=2)
    key = ("k5",) if conf.partitioner == "ordered" else ("k5", 2)
    expected = sorted(
        (f"k{i % 8}", i % 3, i, i * 10 + 1) for i in range(100) if i % 8 == 5 and (len(key) == 1 or i % 3 == 2)
    )
    found = lookup(store, "test", "l", key)
    assert sorted(tuple(r) for r in found.collect()) == expected
    with pytest.raises(ValueError):
        lookup(store, "test", "l", (*key, 1))


def test_lookup_prunes_buckets(spark, store, table):
    df = spark.createDataFrame([(i, 1, i, "a", 1.0) for i in range(200)], SCHEMA)
    bulk_load(store, df, "test", "m", load_epoch=1)
    plan = lookup(store, "test", "m", (77,))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "EqualTo(_token," in plan


def test_types_of_a_read_are_the_tables(spark, store, table):
    df = spark.createDataFrame([(1, 1, 1, "a", 1.0)], SCHEMA)
    for epoch in (1, 2, 2):
        bulk_load(store, df, "test", "m", load_epoch=epoch)
        assert read_table(store, "test", "m").schema == T.StructType.fromDDL(SCHEMA)
