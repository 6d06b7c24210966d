"""Atomic publication, compaction, clean-up, capped loads, rows set aside in one pass."""

import os
import threading
from collections import defaultdict
from dataclasses import replace
from glob import glob

import pytest
from pyspark.sql import functions as F
from test_merge import COLUMNS, SCHEMA, model, random_loads

from keyedload import (
    AlreadyPublished,
    LoadConf,
    LoadError,
    TableSpec,
    bulk_load,
    clean_up,
    compact_loads,
    publish_load,
    read_rejects,
    read_table,
)
from keyedload.operators import capped, compact
from keyedload.operators.resolve import allowed_strategies, facts_of


@pytest.fixture
def table(store):
    return store.create_table(TableSpec("test", "m", SCHEMA, ("k",), ("c",)))


def one(spark, x, k=1):
    return spark.createDataFrame([(k, 1, x, "a", 1.0)], SCHEMA)


def current(store, as_of=None, strategy="auto"):
    return sorted((tuple(r) for r in read_table(store, "test", "m", as_of, strategy).collect()), key=repr)


def files(store, spec):
    found = glob(f"{store.data_path(spec)}/**/*.parquet", recursive=True)
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in found}


# -- publication ---------------------------------------------------------------------------------


def test_of_two_attempts_of_a_load_one_is_published(spark, store, table):
    first = bulk_load(store, one(spark, 1), "test", "m", load_id="day", publish=False)
    second = bulk_load(store, one(spark, 2), "test", "m", load_id="day", publish=False)
    publish_load(store, "test", "m", second)
    before = files(store, table)
    with pytest.raises(AlreadyPublished):
        store.publish(table, first)
    store.publish(table, second)  # again, as after a lost answer
    assert files(store, table) == before and [r[2] for r in current(store)] == [2]
    assert [r.attempt for r in store.published(table)] == [second.attempt]


def test_racing_loads_of_one_id(spark, store, table, monkeypatch):
    """Both have looked at the log before either has published."""
    meet = threading.Barrier(2)
    publish = type(store).publish
    monkeypatch.setattr(type(store), "publish", lambda *a: (meet.wait(60), publish(*a))[1])
    done = []

    def load(x):
        try:
            bulk_load(store, one(spark, x), "test", "m", load_id="day")
            done.append(x)
        except AlreadyPublished:
            pass

    racers = [threading.Thread(target=load, args=(x,)) for x in (1, 2)]
    for r in racers:
        r.start()
    for r in racers:
        r.join()
    assert len(done) == 1 and [r[2] for r in current(store)] == done
    # The loser has left nothing.
    assert len(glob(f"{store.data_path(table)}/load_id=day/*")) == 1


def test_many_publications_at_once_all_get_a_number(spark, store, table):
    entry = bulk_load(store, one(spark, 1), "test", "m", publish=False)
    racers = [threading.Thread(target=store.publish, args=(table, replace(entry, load_id=f"l{i}"))) for i in range(6)]
    for r in racers:
        r.start()
    for r in racers:
        r.join()
    assert sorted(r.load_id for r in store.published(table)) == [f"l{i}" for i in range(6)]
    names = store.commits(table).folder.list().names
    assert sorted(n for n in names if n.endswith(".json")) == [f"{i:020d}.json" for i in range(6)]


def test_a_failed_load_leaves_no_files(spark, store, table):
    bad = spark.createDataFrame([(1, 1, "x", "a", 1.0)], "k int, c int, x string, y string, z double")
    with pytest.raises(Exception, match="cannot convert"):
        bulk_load(store, bad, "test", "m", load_id="bad")
    assert glob(f"{store.data_path(table)}/load_id=bad/*") == []
    bulk_load(store, one(spark, 3), "test", "m", load_id="bad")
    assert [r[2] for r in current(store)] == [3]


def test_an_entry_is_never_replaced(spark, store, table):
    folder = store.commits(table).folder
    assert folder.put_if_absent("x", "one") and not folder.put_if_absent("x", "two")
    with open(f"{folder.path}/x") as f:
        assert f.read() == "one"
    assert [n for n in folder.list().names if not n.endswith(".crc")] == ["x"]


# -- compaction ----------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_compaction_changes_no_read(spark, store, table, seed):
    ttl, partial, per_row_time = seed % 2 == 0, seed % 3 > 0, seed > 2
    loads = [x for s in (seed, seed + 50) for x in random_loads(s, ttl, partial, per_row_time)]
    for n, (rows, columns) in enumerate(loads):
        if n == len(loads) - 1:
            compact_loads(store, "test", "m")
        data = [(*[r[c] for c in COLUMNS], wts, life) for r, wts, life, _ in rows]
        df = spark.createDataFrame(data, SCHEMA + ", w bigint, life int")
        df = df if ttl else df.drop("life")
        df = df if per_row_time else df.drop("w")
        conf = LoadConf(timestamp="w" if per_row_time else None, ttl="life" if ttl else None)
        bulk_load(store, df, "test", "m", columns=columns, conf=conf, load_epoch=0)
    simple = [([(r, w if per_row_time else 0, life if life else None) for r, w, life, _ in rows], c) for rows, c in loads]
    for _ in range(2):
        for as_of in (15, 25, 40):
            expected = model(simple, as_of)
            for strategy in allowed_strategies(facts_of(table, [r for r in store.published(table) if r.rows])):
                assert current(store, as_of, strategy) == expected, strategy
        compact_loads(store, "test", "m")
    assert len(store.published(table)) == 1


def test_whole_rows_become_a_base_that_is_read_directly(spark, store, table):
    rows = [(i, 1, i, "a", 1.0) for i in range(100)]
    for n in range(3):
        bulk_load(store, spark.createDataFrame(rows, SCHEMA).withColumn("x", F.col("x") + n), "test", "m", load_epoch=n + 1)
    expected = current(store)
    entry = compact_loads(store, "test", "m")
    assert (entry.rows, entry.keys, entry.most_versions, entry.whole, entry.has_ttl) == (100, 100, 1, True, False)
    assert len(entry.replaces) == 3 and store.log(table).count() == 1
    assert current(store) == expected
    plan = read_table(store, "test", "m")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert compact_loads(store, "test", "m") is None


def test_only_small_or_named_loads(spark, store, table):
    bulk_load(store, spark.createDataFrame([(i, 1, i, "a", 1.0) for i in range(50)], SCHEMA), "test", "m", load_id="base", load_epoch=1)
    for n in range(4):
        bulk_load(store, one(spark, -n, n), "test", "m", load_id=f"s{n}", load_epoch=2 + n)
    expected = current(store)
    assert set(compact_loads(store, "test", "m", max_rows=10).replaces) == {"s0", "s1", "s2", "s3"}
    assert len(store.published(table)) == 2 and current(store) == expected
    with pytest.raises(LoadError, match="no published load"):
        compact_loads(store, "test", "m", loads=["s0", "base"])
    # A replaced load was published all the same.
    assert bulk_load(store, one(spark, 9), "test", "m", load_id="s1", if_published="skip") is None


def test_purged_cells_are_gone(spark, store, table):
    bulk_load(store, one(spark, 1, 1), "test", "m", conf=LoadConf(ttl=10), load_epoch=0)
    bulk_load(store, one(spark, 2, 2), "test", "m", conf=LoadConf(ttl=100), load_epoch=0)
    entry = compact_loads(store, "test", "m", purge_before=50)
    assert entry.rows == 1 and [r[0] for r in current(store, 60)] == [2]


def test_racing_compactions(spark, store, table, monkeypatch):
    for n in range(3):
        bulk_load(store, one(spark, n), "test", "m", load_epoch=n)
    publish, calls = type(store).publish, []

    def late(self, spec, row):
        if not calls:
            calls.append(1)
            compact_loads(store, "test", "m")
        publish(self, spec, row)

    monkeypatch.setattr(type(store), "publish", late)
    with pytest.raises(LoadError, match="replaced meanwhile"):
        compact_loads(store, "test", "m")
    assert [r[2] for r in current(store)] == [2] and len(store.published(table)) == 1


def test_maps_and_empty_loads(spark, store):
    schema = "k int, a map<string,int>, s struct<m:map<string,int>>"
    store.create_table(TableSpec("test", "maps", schema, ("k",)))
    for n in range(2):
        bulk_load(store, spark.createDataFrame([(n, {"x": n}, ({"y": n},)), (5, {"z": n}, None)], schema), "test", "maps", load_epoch=n)
    bulk_load(store, spark.createDataFrame([], schema), "test", "maps", load_epoch=9)
    before = sorted(map(str, read_table(store, "test", "maps").collect()))
    assert len(compact_loads(store, "test", "maps").replaces) == 3
    assert sorted(map(str, read_table(store, "test", "maps").collect())) == before


# -- clean-up ------------------------------------------------------------------------------------


def test_clean_up_removes_what_no_reader_needs(spark, store, table):
    for n in range(3):
        bulk_load(store, one(spark, n, n), "test", "m", load_id=f"l{n}", load_epoch=n)
    orphan = bulk_load(store, one(spark, 9, 9), "test", "m", load_id="orphan", publish=False)
    expected = current(store)
    old = read_table(store, "test", "m")  # a reader of the loads as they are now
    compact_loads(store, "test", "m")
    assert clean_up(store, "test", "m") == []  # nothing is old enough
    assert sorted(map(tuple, old.collect())) == expected
    removed = clean_up(store, "test", "m", grace_seconds=0)
    assert sorted(r.split("/")[1] for r in removed) == ["load_id=l0", "load_id=l1", "load_id=l2", "load_id=orphan"]
    assert current(store) == expected and clean_up(store, "test", "m", grace_seconds=0) == []
    # What was given up cannot be published any more.
    with pytest.raises(LoadError, match="cleaned up"):
        store.publish(table, orphan)


def test_the_log_is_summed_up(spark, store, table):
    entry = bulk_load(store, one(spark, 0), "test", "m", load_id="n0", load_epoch=0)
    for n in range(1, compact.CHECKPOINT_ENTRIES + 2):
        store.publish(table, replace(entry, load_id=f"n{n}", rows=0))
    compact_loads(store, "test", "m", loads=[f"n{n}" for n in range(1, 12)])
    commits = store.commits(table)
    assert commits.entries_behind() == 0
    known = store.published(table)
    before = current(store)
    clean_up(store, "test", "m", grace_seconds=0)
    assert [n for n in commits.folder.list().names if n.endswith(".json")] == []
    assert store.published(table) == [replace(r, replaces=()) for r in known] and current(store) == before
    assert store.is_published(table, "n5") and store.is_published(table, "n15")
    bulk_load(store, one(spark, 5), "test", "m", load_id="later", load_epoch=99)
    assert [r[2] for r in current(store)] == [5] and store.log(table).count() == len(known) + 1


def test_rejects_outlive_a_compaction(spark, store, table):
    given = spark.createDataFrame([(1, 1, "1", "a", 1.0), (2, 1, "x", "b", 1.0)], "k int, c int, x string, y string, z double")
    for n in range(2):
        bulk_load(store, given, "test", "m", conf=LoadConf(on_bad_value="reject"), load_id=f"r{n}", load_epoch=n)
    compact_loads(store, "test", "m")
    clean_up(store, "test", "m", grace_seconds=0)
    assert [tuple(r) for r in read_rejects(store, "test", "m", "r0").collect()] == [(2, 1, "x", "b", 1.0, ["x"])]
    assert [r[0] for r in current(store)] == [1]


# -- rows set aside ------------------------------------------------------------------------------


def test_good_and_bad_rows_come_of_one_evaluation(spark, store, table):
    rows = spark.range(2000).select(
        F.col("id").cast("int").alias("k"),
        F.lit(1).alias("c"),
        F.when(F.rand() < 0.4, F.lit("bad")).otherwise(F.lit("7")).alias("x"),
        F.lit("a").alias("y"),
        F.lit(1.0).alias("z"),
    )
    entry = bulk_load(store, rows, "test", "m", conf=LoadConf(on_bad_value="reject"), load_id="r")
    aside = {r.k for r in read_rejects(store, "test", "m", "r").collect()}
    loaded = {r[0] for r in current(store)}
    assert (entry.rows, entry.rejected) == (len(loaded), len(aside)) and aside and loaded
    assert aside | loaded == set(range(2000)) and not aside & loaded
    assert read_table(store, "test", "m").where("x <> 7").count() == 0


# -- capped loads --------------------------------------------------------------------------------


def slices_of(monkeypatch):
    """The planned slices, and when each was written."""
    plans = []
    planned = capped.planned
    monkeypatch.setattr(capped, "planned", lambda pieces, cap: plans.append(planned(pieces, cap)) or plans[-1])
    return plans


@pytest.mark.parametrize("partitioner", ["hash", "md5", "ordered"])
def test_no_slice_is_above_the_cap(spark, store, table, monkeypatch, partitioner):
    plans = slices_of(monkeypatch)
    monkeypatch.setattr(capped, "sleep", lambda s: None)
    # A third of the rows are versions of one key.
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("int").alias("k"),
        F.lit(1).alias("c"),
        F.col("id").cast("int").alias("x"),
        F.lit("abc").alias("y"),
        F.lit(1.0).alias("z"),
    )
    cap = 20_000
    entry = bulk_load(store, rows, "test", "m", conf=LoadConf(partitioner, bytes_per_trigger=cap), load_id="c")
    sums = [sum(p.bytes for p in s) for s in plans[0]]
    assert max(sums) <= cap and len(sums) < 3 * sum(sums) / cap
    assert (entry.rows, entry.keys, entry.most_versions) == (3000, 2001, 1000)
    got = store.loads(table, ["c"]).select(*COLUMNS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def test_a_row_above_the_cap_is_a_slice(spark, store, table, monkeypatch):
    plans = slices_of(monkeypatch)
    rows = spark.createDataFrame([(i, 1, i, "y" * 500, 1.0) for i in range(3)], SCHEMA)
    assert bulk_load(store, rows, "test", "m", conf=LoadConf(bytes_per_trigger=1)).rows == 3
    assert [len(s) for s in plans[0]] == [1, 1, 1] and len(current(store)) == 3


def test_slices_are_written_at_the_pace(spark, store, table, monkeypatch):
    waited = []
    now = [0.0]
    monkeypatch.setattr(capped, "sleep", lambda s: (waited.append(s), now.append(now[-1] + s)))
    monkeypatch.setattr(capped, "monotonic", lambda: now[-1])
    rows = spark.createDataFrame([(i, 1, i, "y", 1.0) for i in range(4)], SCHEMA)
    bulk_load(store, rows, "test", "m", conf=LoadConf(bytes_per_trigger=1, trigger_seconds=7))
    # The clock stands nearly still, and a write is due seven seconds after the one before.
    assert waited[0] == 0 and [round(w) for w in waited[1:]] == [7, 7, 7]


def test_capped_loads_of_no_rows_with_rejects_and_options(spark, store, table, monkeypatch):
    monkeypatch.setattr(capped, "sleep", lambda s: None)
    assert bulk_load(store, one(spark, 1).limit(0), "test", "m", conf=LoadConf(bytes_per_trigger=5)).rows == 0
    given = [(i, 1, "x" if i % 2 else "1", "a", 1.0, 50) for i in range(40)]
    df = spark.createDataFrame(given, "k int, c int, x string, y string, z double, life int")
    conf = LoadConf(bytes_per_trigger=200, on_bad_value="reject", ttl="life")
    entry = bulk_load(store, df, "test", "m", conf=conf, load_id="r", load_epoch=0)
    assert (entry.rows, entry.rejected) == (20, 20)
    assert read_rejects(store, "test", "m", "r").count() == 20
    assert len(current(store, 10)) == 20 and current(store, 60) == []


def test_a_failed_capped_load_is_invisible(spark, store, table, monkeypatch):
    calls = defaultdict(int)

    def sleep(_):
        calls["n"] += 1
        if calls["n"] == 2:
            raise RuntimeError("stopped")

    monkeypatch.setattr(capped, "sleep", sleep)
    rows = spark.createDataFrame([(i, 1, i, "y", 1.0) for i in range(9)], SCHEMA)
    with pytest.raises(RuntimeError, match="stopped"):
        bulk_load(store, rows, "test", "m", conf=LoadConf(bytes_per_trigger=40), load_id="c")
    assert current(store) == [] and glob(f"{store.data_path(table)}/load_id=c/*") == []
