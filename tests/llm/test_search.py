"""Ranked search against sums term by term, over one and several blocks and parts."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from keyedload.llm import search


def terms_of(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in found]


def plain(docs, items, k):
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    out = []
    for item, text in items:
        scored = []
        for (doc, c), size in zip(counted, sizes):
            score = 0
            for t in terms_of(text):
                if c[t]:
                    df = sum(x[t] > 0 for _, x in counted)
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                    score += weight * (10**9 * c[t] // (1000 * c[t] + 8 * (100 - 75 + 75 * size * n // total)))
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def example():
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "Über", "THE", "the", "_x", "９"]

    def text(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", ",", ".\n"]) for _ in range(n))

    docs = [(i, text(rng.randrange(1, 40))) for i in range(60)]
    docs += [(100 + i, docs[7][1]) for i in range(20)]  # equal scores
    docs += [(3, docs[7][1]), (3, docs[7][1]), (None, docs[7][1]), (None, text(5)), (400, None), (401, ""), (402, "... !"), (403, "w1 " * 5000)]
    items = [(i, text(rng.randrange(1, 15))) for i in range(10)]
    items += [(5, "w1 w2"), (5, "w1 w2"), (None, "w3 w4 w3"), (60, None), (61, "--"), (62, "unknown words"), (63, docs[7][1]), (64, "w1 " * 300)]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id bigint, text string, score int").repartition(5)
    return d, spark.createDataFrame([(*x, "r") for x in items], "item_id bigint, text string, rank string")


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_terms", [500_000, 60])
def test_ranks_are_those_of_plain_sums(spark, block_terms):
    docs, items = example()
    for k in (10, 3):
        assert result(search.search(*frames(spark, docs, items), k=k, block_terms=block_terms)) == plain(docs, items, k)


def test_parts_that_keep_sums_exact_and_small_tiles(spark, monkeypatch):
    docs, items = example()
    monkeypatch.setattr(search, "EXACT", 5_000 * search.IMPACT)
    monkeypatch.setattr(search, "TILE_ITEMS", 4)
    assert result(search.search(*frames(spark, docs, items))) == plain(docs, items, 10)


def test_parts_stay_below_the_bound():
    items = [(0, [b"a"] * 1_000_000 + [b"b"] * 1_000_000 + [b"c"]), (1, [b"c"])]
    corpus = search.Corpus(10**9, 10**12, {b"a": 1, b"b": 1, b"c": 5})
    (tile,) = search.tiles(items, {b"a": 0, b"b": 1, b"c": 2}, corpus)
    assert len(tile.parts) > 3
    assert all(p.weights.sum(axis=0).max() * search.IMPACT < search.EXACT for p in tile.parts)
    for place, n in ((0, 1_000_000), (1, 1_000_000), (2, 1)):
        weights = [p.weights[p.place[place], 0] for p in tile.parts if p.place[place] >= 0]
        assert sum(weights) == n * corpus.weight([b"a", b"b", b"c"][place])


def test_best_of_many_tiles_breaks_ties_by_id(spark):
    import pyarrow as pa

    tile = search.Tile(np.array([0]), [])
    best = search.Best(tile, 3, pa.string())
    for ids in (["b", None, "zz"], ["a", "c", None], ["aa", "d", "e"]):
        best.add(np.array([[5], [5], [5]]), pa.array(ids))
    assert best.ids.to_pylist() == ["a", "aa", "b"]


def test_text_ids_and_empty_tables(spark):
    d = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y")], "doc_id string, text string")
    i = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert [r.doc_id for r in search.search(d, i).orderBy("rank").collect()] == ["a", "b", None]
    assert search.search(d.limit(0), i).count() == 0
    assert search.search(d, i.limit(0)).count() == 0
    assert search.search(d, i.where("false")).columns == ["item_id", "rank", "doc_id", "score"]
