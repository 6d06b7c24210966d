"""Ranked lexical search: every item of a query set against all documents, by dense blocked matrix products.

A tile of documents becomes a matrix of term impacts, a tile of items a matrix of term weights over the items' own compact
vocabulary; their product is the scores. All numbers are integers, held in float64. The terms of a tile are cut into parts so
that no sum within a part can reach 2**53, and parts are added as 64-bit integers: scores are exact in whatever order the
product is summed. Of a tile's scores only those that can still be among an item's best are looked at, equal scores in the
order of the documents' ids, so no tie is lost or decided twice.

The items are a stated query set. They are dealt into blocks of a bounded number of terms; a block is sent to all tasks, and
all documents are read for it, once for the counts and once for the scores. A task sends at most ``k`` rows per item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.llm.common import batch, map_batches, staged, text_of
from keyedload.llm.decontam import words_of

# Terms of the items in a block, with repeats: about 100 bytes each where it is sent to.
BLOCK_TERMS = 500_000
# Items, terms and documents of a tile: matrices of at most 16 MB.
TILE_ITEMS = 64
TILE_TERMS = 4096
TILE_DOCUMENTS = 512
# Rows of an item are first ranked in so many parts.
PARTS = 64

#: The impact of a term in a document is below this.
IMPACT = 1_000_000
EXACT = 2**53


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, all their terms, and in how many documents each term of a block is."""

    documents: int
    terms: int
    holding: dict[bytes, int]

    def weight(self, term: bytes) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * self.holding.get(term, 0) + 1)))

    def length(self, n: int) -> int:
        """What a document's length of ``n`` terms adds below the fraction: 100 for one of mean length."""
        return 25 + (75 * n * self.documents) // self.terms


@dataclass(frozen=True)
class Part:
    """Some of the vocabulary of a tile of items: where each term of the block stands in it (-1: not), and weights by term and
    item."""

    place: np.ndarray
    weights: np.ndarray


@dataclass(frozen=True)
class Tile:
    items: np.ndarray
    parts: list[Part]


def tiles(items: list[tuple[int, list[bytes]]], vocabulary: dict[bytes, int], corpus: Corpus) -> list[Tile]:
    """Tiles of items; the parts of a tile keep every item's sums below 2**53."""
    out = []
    weight = {t: corpus.weight(t) for t in vocabulary}
    for at in range(0, len(items), TILE_ITEMS):
        some = items[at : at + TILE_ITEMS]
        counts = [Counter(terms) for _, terms in some]
        parts, columns, sums = [], [], np.zeros(len(some))

        def cut() -> None:
            place = np.full(len(vocabulary), -1, np.int32)
            place[[vocabulary[t] for t, _ in columns]] = np.arange(len(columns))
            parts.append(Part(place, np.array([row for _, row in columns])))

        for term in dict.fromkeys(t for _, terms in some for t in terms):
            left = np.array([float(c[term] * weight[term]) for c in counts])
            while True:
                # A term that occurs very often in an item goes to several parts.
                row = np.minimum(left, (EXACT - 1) // IMPACT)
                if columns and (len(columns) == TILE_TERMS or (sums + row).max() * IMPACT >= EXACT):
                    cut()
                    columns, sums = [], np.zeros(len(some))
                columns.append((term, row))
                sums += row
                left = left - row
                if not left.any():
                    break
                cut()
                columns, sums = [], np.zeros(len(some))
        cut()
        out.append(Tile(np.array([number for number, _ in some]), parts))
    return out


def impacts(texts: list[str], vocabulary: dict[bytes, int], corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, terms and impacts of the terms of ``vocabulary`` that the texts hold."""
    documents, terms, often, below = [], [], [], []
    for i, text in enumerate(texts):
        words = words_of(text)
        if words:
            counts = Counter(words)
            found = counts.keys() & vocabulary.keys()
            documents += [i] * len(found)
            below += [corpus.length(len(words))] * len(found)
            terms += [vocabulary[t] for t in found]
            often += [counts[t] for t in found]
    often = np.array(often, np.int64)
    impact = (1_000_000_000 * often) // (1000 * often + 8 * np.array(below, np.int64))
    return np.array(documents, np.int64), np.array(terms, np.int64), impact


def scores(tile: Tile, size: int, documents: np.ndarray, terms: np.ndarray, impact: np.ndarray) -> np.ndarray:
    """Scores of ``size`` documents and the items of a tile."""
    out = np.zeros((size, len(tile.items)), np.int64)
    for part in tile.parts:
        place = part.place[terms]
        here = place >= 0
        dense = np.zeros((size, len(part.weights)))
        dense[documents[here], place[here]] = impact[here]
        out += (dense @ part.weights).astype(np.int64)
    return out


class Best:
    """The ``k`` best documents of every item of a tile, equal scores by ascending id, nulls last."""

    def __init__(self, tile: Tile, k: int, kind: pa.DataType):
        self.tile, self.k = tile, k
        self.least = np.ones(len(tile.items), np.int64)
        self.items, self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], kind)

    def add(self, found: np.ndarray, ids: pa.Array) -> None:
        rows, items = np.nonzero(found >= self.least)
        if not len(rows):
            return
        items = np.concatenate([self.items, items])
        values = np.concatenate([self.scores, found[rows, items[len(self.items) :]]])
        ids = pa.concat_arrays([self.ids, ids.take(pa.array(rows))])
        # Ranks of ids, so that ids of any type can be sorted with the scores.
        ranks = pc.rank(ids, "ascending", null_placement="at_end", tiebreaker="first").to_numpy()
        order = np.lexsort((ranks, -values, items))
        sorted_items = items[order]
        firsts = np.flatnonzero(np.diff(sorted_items, prepend=-1))
        nth = np.arange(len(order)) - np.repeat(firsts, np.diff(firsts, append=len(order)))
        keep = order[nth < self.k]
        self.items, self.scores, self.ids = items[keep], values[keep], ids.take(pa.array(keep))
        last = order[nth == self.k - 1]
        self.least[items[last]] = values[last]


def _numbered(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item, no, n, t``: the items that have terms, with a number of their own and how many terms they have."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [len(words_of(t)) for t in b.column(2).to_pylist()]
            yield batch({"item": b.column(0), "no": b.column(1), "n": pa.array(n, pa.int64()), "t": b.column(2)})

    kind = items.schema[item_id].dataType.simpleString()
    rows = items.select(col(item_id).alias("item"), F.monotonically_increasing_id().alias("no"), text_of(text).alias("t"))
    return staged(map_batches(rows, work, f"item {kind}, no bigint, n bigint, t string").where("n > 0"), "items")


def corpus_of(texts: DataFrame, vocabulary: frozenset[bytes]) -> Corpus:
    """Counts over all rows of ``texts`` (column ``t``): summed in the tasks, then by Spark."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, holding, documents, terms = shared.value, Counter(), 0, 0
        for b in batches:
            for t in b.column(0).to_pylist():
                words = words_of(t)
                documents += bool(words)
                terms += len(words)
                holding.update(known.intersection(words))
        yield batch(
            {"t": [None, None, *holding], "kind": [0, 1, *[2] * len(holding)], "n": [documents, terms, *holding.values()]},
            {"t": pa.binary(), "kind": pa.int32(), "n": pa.int64()},
        )

    sums = map_batches(texts, work, "t binary, kind int, n bigint").groupBy("kind", "t").agg(F.sum("n").alias("n")).collect()
    totals = {r.kind: r.n for r in sums if r.kind < 2}
    return Corpus(totals.get(0, 0), totals.get(1, 0), {bytes(r.t): r.n for r in sums if r.kind == 2})


def _block_scores(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    """``no, doc, score``: every task's best documents of a block's items."""
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for _, terms in items for t in terms))}
    corpus = corpus_of(docs.select("t"), frozenset(vocabulary))
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, corpus, tiles(items, vocabulary, corpus)))
    kind = docs.schema["doc"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, all_tiles = shared.value
        best: list[Best] = []
        for b in batches:
            ids = b.column(0)
            best = best or [Best(tile, k, ids.type) for tile in all_tiles]
            found = impacts(b.column(1).to_pylist(), known, counts)
            for of in best:
                of.add(scores(of.tile, b.num_rows, *found), ids)
        for of in best:
            yield batch({"no": pa.array(of.tile.items[of.items]), "doc": of.ids, "score": pa.array(of.scores)})

    return map_batches(docs, work, f"no bigint, doc {kind}, score bigint", TILE_DOCUMENTS)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 for each row of ``items``.

    Ranks count from 1; equal scores rank by ascending ``doc_id``, null ids last. Null and empty texts have no terms: such
    documents are in no count, such items in no row of the result. Every row is a document or an item of its own, so repeated
    rows rank one after another, and items that share an id are each ranked. Texts of any length are read whole. Without
    documents or items the result is empty. Other columns are not read.
    """
    if k < 1:
        raise ValueError("k is at least one")
    asked = _numbered(items, item_id, item_text)
    total = asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_terms))
    rows = docs.select(col(doc_id).alias("doc"), text_of(text).alias("t"))
    found = []
    for i in range(blocks if total else 0):
        # Bounded: the hash deals the items evenly over the blocks.
        part = asked.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == i).orderBy("no").select("no", "t")
        block = [(r.no, words_of(r.t)) for r in part.collect()]
        if block:
            found.append(_block_scores(rows, block, k))
    if not found:
        found = [rows.select(F.lit(0).cast("bigint").alias("no"), "doc", F.lit(0).cast("bigint").alias("score")).where("false")]
    every = reduce(DataFrame.unionAll, found).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))

    def ranked(df: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    best = ranked(ranked(every, "no", "part"), "no")
    named = best.join(asked.select("no", "item"), "no")
    return named.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")
