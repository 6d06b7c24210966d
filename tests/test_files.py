"""Index of files: lookups open only files that may hold the key, and what has expired is not opened."""

import pytest
from pyspark.sql import functions as F
from test_merge import COLUMNS, SCHEMA, model, random_loads

from keyedload import LoadConf, TableSpec, bulk_load, clean_up, compact_loads, lookup, read_table
from keyedload.operators.files import BITMAPS, BITS, bit_of, index_rows, is_set
from keyedload.streaming.follow import load_events

PLACEMENTS = {
    "hash": LoadConf("hash", buckets=4, index_files=True),
    "md5": LoadConf("md5", buckets=4, writers_per_bucket=3, index_files=True),
    "ring": LoadConf("hash", ring=(-(2**62), 0, 2**62), index_files=True),
    "ordered": LoadConf("ordered", split_points=(100, 500), writers_per_bucket=2, index_files=True),
    "bucketed": LoadConf("bucketed", buckets=4, index_files=True),
}


@pytest.fixture
def table(store):
    return store.create_table(TableSpec("test", "f", "k bigint, c int, v bigint", ("k",), ("c",)))


def rows(spark, keys, v=0):
    return spark.createDataFrame([(k, c, v + k) for k in keys for c in (0, 1)], "k bigint, c int, v bigint")


def opened(df):
    return sorted(f.rsplit("/", 1)[1] for f in df.inputFiles())


def plain(df):
    return sorted(map(tuple, df.collect()))


def test_bits_are_found_again(spark):
    tokens = spark.range(200).select((F.col("id") * 7919).alias("t"))
    maps = tokens.agg(*[F.bitmap_construct_agg(bit_of(F.col("t"), i)).alias(f"b{i}") for i in range(BITMAPS)])
    asked = spark.range(4000).select((F.col("id") * 7919).alias("t")).crossJoin(maps)
    every = F.lit(True)
    for i in range(BITMAPS):
        every = every & is_set(F.col(f"b{i}"), bit_of(F.col("t"), i))
    found = {r.t for r in asked.where(every).collect()}
    assert {7919 * i for i in range(200)} <= found and len(found) < 205
    assert asked.agg(F.max(bit_of(F.col("t"), 0))).first()[0] < BITS


@pytest.mark.parametrize("placement", PLACEMENTS)
def test_a_lookup_opens_only_files_that_may_hold_the_key(spark, store, table, placement):
    conf = PLACEMENTS[placement]
    for n in range(5):
        # Key 3 is in two of the loads, others in one each; spans of tokens overlap throughout.
        keys = [k for k in range(1000) if k % 5 == n] + ([3] if n == 4 else [])
        entry = bulk_load(store, rows(spark, keys, n * 10_000), "test", "f", conf=conf, load_epoch=n + 1)
        assert entry.index_blocks == 1
    everything = opened(store.loads(table, store.published(table)))
    assert len(everything) >= 15
    for k in (0, 3, 512, 999):
        found = lookup(store, "test", "f", (k,))
        expected = (4 if k == 3 else k % 5) * 10_000 + k
        assert plain(found) == [(k, 0, expected), (k, 1, expected)]
        # One file of each load that has it, and with luck against it another.
        assert (2 if k == 3 else 1) <= len(opened(found)) <= 3
    assert plain(lookup(store, "test", "f", (-1,))) == []
    assert len(opened(lookup(store, "test", "f", (-1,)))) <= 1
    # The index is no data: whatever reads the directory passes it by.
    assert read_table(store, "test", "f").count() == 2000
    events = [r.file for r in load_events(store, "test", "f").select("file").distinct().collect() if r.file]
    assert len(events) == len(everything) and not any("/_files/" in f for f in events)


def test_loads_with_and_without_an_index(spark, store, table):
    bulk_load(store, rows(spark, range(50)), "test", "f", load_epoch=1)
    bulk_load(store, rows(spark, range(20, 70), 100), "test", "f", conf=PLACEMENTS["hash"], load_epoch=2)
    bulk_load(store, rows(spark, [], 100), "test", "f", conf=PLACEMENTS["hash"], load_epoch=3)
    assert plain(lookup(store, "test", "f", (10,))) == [(10, 0, 10), (10, 1, 10)]
    assert plain(lookup(store, "test", "f", (30,))) == [(30, 0, 130), (30, 1, 130)]
    assert plain(lookup(store, "test", "f", (60,))) == [(60, 0, 160), (60, 1, 160)]
    compact_loads(store, "test", "f", conf=PLACEMENTS["hash"])
    assert [r.index_blocks for r in store.published(table)] == [1]
    assert plain(lookup(store, "test", "f", (30,))) == [(30, 0, 130), (30, 1, 130)]
    assert len(clean_up(store, "test", "f", grace_seconds=-5)) == 3


def test_keys_of_a_large_file_are_cut_into_blocks(spark, store, table, monkeypatch):
    monkeypatch.setattr("keyedload.operators.files.BLOCK_ROWS", 50)
    # A third of all rows have one key.
    data = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").cast("int").alias("c"), F.col("id").alias("v"))
    entry = bulk_load(store, data, "test", "f", conf=LoadConf(buckets=2, index_files=True), load_epoch=1)
    assert entry.index_blocks > 1
    index = index_rows(store, table, [entry])
    assert index.agg(F.sum("rows")).first()[0] == 3000 and index.groupBy("file", "block").count().where("count > 1").count() == 0
    assert lookup(store, "test", "f", (-1,)).count() == 1000
    for k in (1, 1000, 2999):
        assert plain(lookup(store, "test", "f", (k,))) == [(k, k, k)]
    assert lookup(store, "test", "f", (3,)).count() == 0


def test_expired_loads_are_not_opened(spark, store, table):
    for n in range(3):
        bulk_load(store, rows(spark, range(n, n + 10), 100 * n), "test", "f", conf=LoadConf(ttl=10 * (n + 1)), load_epoch=1)
    last = bulk_load(store, rows(spark, [1, 50], 900), "test", "f", conf=LoadConf(ttl=100), load_epoch=2)
    assert last.expires == 102

    def ids(as_of):
        return sorted({f.split("load_id=")[1].split("/")[0] for f in read_table(store, "test", "f", as_of).inputFiles()})

    assert len(ids(5)) == 4
    # All rows that live are newer than what has expired, also in loads that are left out.
    assert ids(31) == [last.load_id] and opened(read_table(store, "test", "f", 200)) == []
    assert plain(read_table(store, "test", "f", 31)) == [(1, 0, 901), (1, 1, 901), (50, 0, 950), (50, 1, 950)]
    assert plain(read_table(store, "test", "f", 200)) == []
    for as_of in (5, 11, 15, 21, 31, 102, 200):
        assert plain(read_table(store, "test", "f", as_of)) == plain(read_table(store, "test", "f", as_of, "cells"))


def test_an_expired_load_still_hides_older_rows(spark, store, table):
    bulk_load(store, rows(spark, range(5)), "test", "f", load_epoch=1)
    hiding = bulk_load(store, rows(spark, range(3), 100), "test", "f", conf=LoadConf(ttl=10, index_files=True), load_epoch=2)
    assert hiding.expires == 12
    assert [r[0] for r in plain(read_table(store, "test", "f", 20))] == [3, 3, 4, 4]
    assert plain(lookup(store, "test", "f", (1,), 20)) == []


def test_files_with_rows_that_expire_apart(spark, store, table):
    conf = LoadConf(ttl="life", buckets=2, index_files=True)
    data = rows(spark, range(40)).withColumn("life", F.when(F.col("k") < 20, 5).otherwise(50).cast("int"))
    entry = bulk_load(store, data, "test", "f", conf=conf, load_epoch=1)
    assert entry.expires == 51
    assert plain(lookup(store, "test", "f", (1,), 6)) == [] and len(plain(lookup(store, "test", "f", (30,), 6))) == 2
    forever = bulk_load(store, data.withColumn("life", F.lit(None).cast("int")), "test", "f", conf=conf, load_epoch=0)
    assert forever.expires is None
    # Older rows without expiry stay hidden by newer ones that have expired.
    assert plain(lookup(store, "test", "f", (1,), 60)) == []


@pytest.mark.parametrize("seed, partial", [(201, False), (202, True)])
def test_random_loads_at_all_times(spark, store, seed, partial):
    """Reads and indexed lookups as of any second give what a plain model gives, whatever has expired by then."""
    store.create_table(TableSpec("test", "m", SCHEMA, ("k",), ("c",)))
    loads = random_loads(seed, True, partial, True)
    for n, (data, columns) in enumerate(loads):
        df = spark.createDataFrame([(*[r[c] for c in COLUMNS], w, life) for r, w, life, _ in data], SCHEMA + ", w bigint, life int")
        conf = LoadConf(buckets=2, timestamp="w", ttl="life", index_files=n % 3 > 0)
        bulk_load(store, df, "test", "m", columns, conf, load_epoch=n)
    simple = [([(r, w, e) for r, w, _, e in data], columns) for data, columns in loads]
    for as_of in (0, 5, 12, 30, 100_000):
        expected = model(simple, as_of)
        assert sorted((tuple(r) for r in read_table(store, "test", "m", as_of).collect()), key=repr) == expected
        k = loads[0][0][0][0]["k"]
        found = sorted((tuple(r) for r in lookup(store, "test", "m", (k,), as_of).collect()), key=repr)
        assert found == [r for r in expected if r[0] == k]
