"""Progress of real loads: events of the files that loads have written, as a table and as a stream."""

import os
from glob import glob

import pytest
from pyspark.sql import functions as F

from keyedload import LoadConf, TableSpec, bulk_load
from keyedload.operators import capped
from keyedload.operators.progress import load_progress, rates, session_outcomes
from keyedload.streaming.follow import followed, load_events, written_files


@pytest.fixture
def table(store):
    return store.create_table(TableSpec("test", "p", "k int, v string", ("k",)))


def rows(spark, n):
    return spark.range(n).select(F.col("id").cast("int").alias("k"), F.lit("value").alias("v"))


def sizes(store, table, load_id, root="data"):
    pattern = f"{store.table_path('test', 'p')}/{root}/load_id={load_id}/**/*.parquet"
    return [os.path.getsize(f) for f in glob(pattern, recursive=True)]


def run(files, path, checkpoint):
    """Everything there is now; the newest row of each bucket."""
    query = (
        followed(files)
        .writeStream.foreachBatch(lambda df, n: df.withColumn("n", F.lit(n)).write.mode("append").parquet(path))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest(spark, path):
    found = spark.read.parquet(path)
    newest = found.groupBy("load_id", "peer").agg(F.max_by(F.struct("files", "bytes", "bytes_per_second"), "n").alias("r"))
    return newest.select("load_id", "peer", "r.*")


def test_a_capped_load_is_followed_while_it_runs(spark, store, table, tmp_path, monkeypatch):
    """Each slice that has been written is seen before the next."""
    seen = []
    os.makedirs(store.data_path(table))
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def look(_):
        if sizes(store, table, "c"):
            run(written_files(store, "test", "p"), path, checkpoint)
            seen.append(latest(spark, path).agg(F.sum("files"), F.sum("bytes")).first())

    monkeypatch.setattr(capped, "sleep", look)
    bulk_load(store, rows(spark, 60), "test", "p", conf=LoadConf(buckets=4, bytes_per_trigger=230), load_id="c")
    run(written_files(store, "test", "p"), path, checkpoint)
    got = latest(spark, path).agg(F.sum("files"), F.sum("bytes")).first()
    assert len(seen) >= 2 and all(a[0] < b[0] and a[1] < b[1] for a, b in zip(seen, [*seen[1:], got]))
    # In the end the totals are the files'.
    assert tuple(got) == (len(sizes(store, table, "c")), sum(sizes(store, table, "c")))
    assert latest(spark, path).where("bytes_per_second <= 0").count() == 0


def test_loads_and_buckets_are_told_apart(spark, store, table, tmp_path):
    bulk_load(store, rows(spark, 50), "test", "p", conf=LoadConf(buckets=3), load_id="a")
    bulk_load(store, rows(spark, 20), "test", "p", conf=LoadConf(buckets=2), load_id="b")
    path = str(tmp_path / "out")
    run(written_files(store, "test", "p", maxFilesPerTrigger=2), path, str(tmp_path / "cp"))
    got = {(r.load_id, r.peer): r.bytes for r in latest(spark, path).collect()}
    for load, buckets in (("a", 3), ("b", 2)):
        assert sorted(p for i, p in got if i == load) == [str(i) for i in range(buckets)]
        assert sum(n for (i, _), n in got.items() if i == load) == sum(sizes(store, table, load))


@pytest.mark.parametrize("partitioner", ["hash", "bucketed"])
def test_events_of_real_loads_are_measured(spark, store, table, partitioner):
    assert load_events(store, "test", "p").count() == 0
    bulk_load(store, rows(spark, 50), "test", "p", conf=LoadConf(partitioner, buckets=3), load_id="a")
    bulk_load(store, rows(spark, 50), "test", "p", conf=LoadConf(partitioner, buckets=3), load_id="hidden", publish=False)
    events = load_events(store, "test", "p")
    own = sizes(store, table, "a", "buckets" if partitioner == "bucketed" else "data")
    sums = events.groupBy("kind").agg(F.count("*").alias("n"), F.sum("current_bytes").alias("b"), F.sum("total_bytes").alias("t"))
    got = {r.kind: (r.n, r.b, r.t) for r in sums.collect()}
    assert got == {"prepared": (3, None, sum(own)), "progress": (len(own), sum(own), sum(own)), "complete": (3, None, None)}
    assert sorted(r.peer for r in events.where("kind = 'prepared'").collect()) == ["0", "1", "2"]
    assert {r.load_id for r in events.select("load_id").distinct().collect()} == {"a"}
    # The measures of transfers hold for them.
    (r,) = load_progress(events).collect()
    assert (r.load_id, r.files_done, r.files, r.bytes_done, r.bytes, r.percent) == ("a", len(own), len(own), sum(own), sum(own), 100)
    assert [(x.completed, x.failed) for x in session_outcomes(events).collect()] == [(1, 0)] * 3
    assert rates(events).count() >= 1
