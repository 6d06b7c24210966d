"""Fingerprints, links and components against plain code."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from keyedload.llm import simhash

M64 = 2**64 - 1


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashed = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def plain_components(values, distance):
    """Root (smallest) of each value."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def signed(v):
    return v - 2**64 if v >> 63 else v


def groups(pairs):
    out = {}
    for v, r in pairs:
        out.setdefault(r, set()).add(v)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("text", [None, "", " \t", "one", "A b", "a B\x0bc d", "é À ü " * 7, "w " * 70_000, "  x y"])
def test_fingerprint(text, monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 50_000)
    assert simhash.fingerprint(text or "", 3) == plain_fingerprint(text)


@pytest.mark.parametrize("segment_bits, cell_rows, distance", [(2, 4096, 2), (2, 20, 2), (1, 4096, 2), (4, 4096, 2), (2, 20, 1), (2, 4096, 1)])
def test_every_link_is_kept(spark, segment_bits, cell_rows, distance):
    rng = random.Random(segment_bits)
    values = {0, M64, 1 << 63}
    for _ in range(40):
        v = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 6])):
            values.add(v)
            v ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    centre = rng.getrandbits(64)
    values |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)}
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp bigint")
    edges = simhash.links(fps, distance, segment_bits, cell_rows)
    assert edges.count() < 3 * len(values) * (1 if cell_rows > 20 else 30)
    found = {r.node & M64: r.root & M64 for r in simhash.components(edges).collect()}
    got = groups((v, found.get(v, v)) for v in values)
    assert got == groups(plain_components(values, distance).items())


def counts_of(v, bits):
    return [(v >> at & ((1 << bits) - 1)).bit_count() for at in range(0, 64, bits)]


@pytest.mark.parametrize("segment_bits", [1, 2, 4])
def test_cells_are_those_one_count_away(spark, segment_bits):
    rng = random.Random(5)
    values = [0, M64, 1 << 63, (1 << 63) - 1, *(rng.getrandbits(64) for _ in range(20))]
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp bigint")
    got = {}
    for r in simhash.grid_rows(fps, segment_bits).collect():
        cell = r.cell & M64
        got.setdefault(r.fp & M64, []).append([cell >> at & ((1 << segment_bits) - 1) for at in range(0, 64, segment_bits)])
    for v in values:
        own = counts_of(v, segment_bits)
        near = [own[:i] + [c + d] + own[i + 1 :] for i, c in enumerate(own) for d in (-1, 1) if 0 <= c + d <= segment_bits]
        assert sorted(got[v]) == sorted([own, *near])


def test_comparisons_in_vain_stay_few(spark):
    """Unrelated fingerprints hardly meet, and ten times as many do not meet ten times as often each."""
    for n in (2_000, 20_000):
        fps = spark.range(n).select(F.xxhash64("id").alias("fp"))
        met = simhash.grid_rows(fps, 2).groupBy("cell").count()
        pairs = met.agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
        assert pairs <= n / 1000


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select((F.col("id") * 7919 % 1009).alias("u"), ((F.col("id") + 1) * 7919 % 1009).alias("v"))
    found = simhash.components(edges).collect()
    assert len(found) == 200 and len({r.root for r in found}) == 1
    assert simhash.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


BASE = " ".join(f"word{i % 50}x{i // 3}" for i in range(300))


def documents(spark):
    rows = [(i, BASE if i % 3 == 0 else f"{BASE} tail{i}" if i % 3 == 1 else f"other text number {i} of its own {i * i}", "s") for i in range(30)]
    rows += [(100, None, "s"), (101, "", None), (102, " ", "s"), (None, BASE, "s"), (3, BASE, "again"), (5, "another text with id five", "s")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, _kept string").withColumn("fp", F.create_map(F.lit("a"), F.lit(1)))


def test_near_copies(spark):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").collect()
    prints = {r.text: plain_fingerprint(r.text) for r in rows}
    roots = plain_components(set(prints.values()), 2)
    least = {}
    for r in rows:
        root = roots[prints[r.text]]
        if r.doc_id is not None:
            least[root] = min(least.get(root, r.doc_id), r.doc_id)
    got = simhash.near_copies(docs).collect()
    expected = sorted((str(r.doc_id), signed(prints[r.text]), least[roots[prints[r.text]]]) for r in rows)
    assert sorted((str(r.doc_id), r.fp, r.component_id) for r in got) == expected


@pytest.mark.parametrize("hot_share", [0.001, 0.2, 1.0])
def test_every_group_keeps_one_row(spark, hot_share):
    other = [" ".join(f"g{k}w{i * (k + 3)}" for i in range(200)) for k in range(4)]
    rows = [(3, BASE), (5, BASE), (5, "zz " + other[0])]  # 5 is a copy of 3, and alone in another group
    rows += [(7, other[1]), (7, other[2]), (8, other[1]), (8, other[2])]  # the smallest of two groups
    rows += [(None, BASE)] * 9 + [(None, other[3])] * 9  # copies of a row with an id, and of each other
    rows += [(None, None), (None, " ")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id bigint, text string, _kept string").repartition(3)
    kept = simhash.one_of_each_group(docs, hot_share=hot_share)
    assert kept.columns == docs.columns
    expected = [(3, BASE), (5, "zz " + other[0]), (7, other[1]), (7, other[2]), (None, other[3]), (None, None), (None, " ")]
    assert sorted(repr((r.doc_id, r.text)) for r in kept.collect()) == sorted(map(repr, expected))


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_copies(docs).count() == 0 and simhash.one_of_each_group(docs).count() == 0
