"""Packing: whole texts, no conflict, and the bins of a plain best fit."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyedload.llm import packing


def plain_best_fit(sizes, marks, capacity):
    """Tightest bin without a common mark, the first made on ties."""
    left, held, out = [], [], []
    for size, own in zip(sizes, marks):
        fits = [(left[b], b) for b in range(len(left)) if left[b] >= size and (left[b] > 0 or size == 0) and not held[b] & own]
        fits = [f for f in fits if f[0] > 0]
        if fits:
            b = min(fits)[1]
        else:
            b = len(left)
            left.append(capacity)
            held.append(set())
        out.append((b, capacity - left[b]))
        left[b] -= size
        held[b] = held[b] | own
    return out


@pytest.mark.parametrize("seed", range(6))
def test_bins_are_those_of_a_plain_search(seed):
    rng = random.Random(seed)
    n = 200
    sizes = np.array(sorted((rng.randint(1, 99) for _ in range(n)), reverse=True))
    sources = [rng.choice([0, 0, 0, *range(1, 3 + 30 * seed)]) for _ in range(n)]
    clusters = [rng.choice([-1, rng.randrange(40)]) for _ in range(n)]
    bits = packing._bits([np.array(sources), np.array(clusters)])
    marks = [{("s", s)} | ({("c", c)} if c >= 0 else set()) for s, c in zip(sources, clusters)]
    bins, starts = packing.best_fit(sizes, bits, 100)
    assert list(zip(bins.tolist(), starts.tolist())) == plain_best_fit(sizes.tolist(), marks, 100)


def test_every_character_is_placed_once_and_nothing_conflicts(spark):
    rng = random.Random(3)
    texts = ["x" * rng.randint(0, 250) + str(i) for i in range(150)] + ["copy of a text"] * 40 + ["y" * 300, "é" * 205, "z" * 100]
    rows = [(i, t, rng.choice(["a", "a", "b", "c", None]), "k") for i, t in enumerate(texts)]
    rows += [(None, "no id", "a", "k"), (None, "no id", "a", "k"), (900, None, "a", "k"), (901, "", None, "k"), (7, "other", "b", "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, shard string")
    got = packing.pack(docs, capacity=100, shard_pieces=60).collect()
    placed = {}
    for r in got:
        placed.setdefault(r.bin_id, []).append(r)
    sizes = {}
    for t in rows:
        sizes.setdefault(t[0], []).append(len(t[1] or ""))
    for i, lengths in sizes.items():
        assert sum(r.n_chars for r in got if r.doc_id == i) == sum(lengths)
    # Pieces follow each other in the bin without gaps, and none holds a source or a text twice.
    by_id = {r[0]: r for r in rows}
    for pieces in placed.values():
        at = 0
        for r in sorted(pieces, key=lambda r: (r.bin_start, r.n_chars)):
            assert r.bin_start == at
            at += r.n_chars
        assert at <= 100
        known = [by_id[r.doc_id] for r in pieces if r.doc_id not in (None, 7)]
        sources = [k[2] for k in known if k[2]]
        assert len(sources) == len(set(sources))
        copies = [k[1] for k in known if k[1]]
        assert len(copies) == len(set(copies))
    # The text comes back from its pieces.
    whole = sorted((r.start, r.n_chars) for r in got if r.doc_id == len(texts) - 2)
    assert whole == [(0, 100), (100, 100), (200, 5)]


def test_repeated_rows_spread_over_shards(spark):
    docs = spark.range(4000).select(F.lit(1).alias("doc_id"), F.lit("same text").alias("text"), F.lit("s").alias("source"))
    got = packing.pack(docs, shard_pieces=100)
    assert got.count() == 4000 and got.select("bin_id").distinct().count() == 4000
    per_shard = got.groupBy(F.split("bin_id", "-")[0].alias("shard")).count().agg(F.max("count")).first()[0]
    assert per_shard < 300


def test_copies_of_one_row_are_numbered_by_many_tasks(spark):
    """A million equal rows: each is placed once, and no task writes out more than its share."""
    n = 1_000_000
    docs = spark.range(n).select(F.lit(1).alias("doc_id"), F.lit("same text").alias("text"), F.lit("s").alias("source"))
    cut = packing.pieces(docs, "doc_id", "text", "source", None, 100)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_task = cut.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.count_distinct("copy").alias("copies"))
    found = per_task.collect()
    assert sum(r.n for r in found) == n and sum(r.copies for r in found) == n
    assert cut.agg(F.min("copy"), F.max("copy")).first() == (1, n)
    assert tasks == 1 or max(r.n for r in found) < 2 * n / tasks


def test_larger_shards_fill_bins_better(spark):
    rng = random.Random(11)
    rows = [(i, "x" * rng.randint(1, 90), rng.choice("abcdefgh")) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    bins = [packing.pack(docs, capacity=100, shard_pieces=n).select("bin_id").distinct().count() for n in (50, 400, 3000)]
    assert bins[0] > bins[1] >= bins[2]


def test_no_documents(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string, source string")).count() == 0
