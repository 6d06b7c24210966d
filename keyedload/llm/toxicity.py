"""Toxicity: a factorization machine over hashed terms.

Terms are words and their beginnings, as 64-bit hashes. A bounded sample of labelled rows gives the terms that tell the
labels apart and fits the machine: a bias, a weight for each term, and a vector for each term whose products with the
vectors of other terms are the weights of pairs. All documents are then scored in their tasks with that small table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.llm.common import batch, crc_remainder, map_batches, prepare, staged, text_of

# Labelled rows that terms and weights are learned from, at most (a sample by hash of the id; about so many).
TRAIN_ROWS = 20_000
# Terms that the machine knows, and the length of their vectors.
TERMS = 1024
RANK = 8
# Least log-likelihood ratio of a term: by chance one term in ten thousand has more.
LEAST_G2 = 15.1
CACHED_WORDS = 300_000

_WORD = re.compile(r"[^\W\d_]+")
_PREFIXES = (4, 5, 6)


def term_hashes(word: str) -> list[int]:
    """The word, and its beginnings where they are shorter."""
    h = xxhash.xxh64_intdigest
    return [h("=" + word)] + [h("^" + word[:k]) for k in _PREFIXES if len(word) > k]


def words_in(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass(frozen=True)
class Machine:
    """Known terms with their weights; ``table`` maps a term's hash to its row."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    table: dict[int, int]

    def score(self, rows: list[int]) -> float:
        v = self.vectors[rows]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        z = self.bias + float(self.weights[rows].sum()) + pairs
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0))))


def labelled(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, modulus: int, held: int, train_rows: int
) -> DataFrame:
    """``toxic, t`` of a sample of the labelled documents outside the held-out part, written to the shared folder.

    A row for each id: repeated labels count as toxic if one is, repeated documents are represented by their smallest text.
    """
    known = labels.where(col(doc_id).isNotNull() & col(label).isNotNull())
    known = known.where(crc_remainder(doc_id, modulus) != held)
    known = known.groupBy(col(doc_id).alias("k")).agg(F.max((col(label) > 0).cast("int")).alias("toxic"))
    n = known.count()
    if n > train_rows:
        known = known.where(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < int((1 << 20) * train_rows / n))
    texts = docs.select(col(doc_id).alias("id"), text_of(text).alias("t"))
    # About train_rows labels of two numbers each: their size is bounded, so they are sent to the documents.
    joined = texts.join(F.broadcast(known), texts.id == known.k).groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("t").alias("t"))
    return staged(joined.select("toxic", "t"), "labelled")


def term_counts(sample: DataFrame) -> DataFrame:
    """``term, n, toxic``: labelled documents with the term, and toxic ones among them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = {0: [], 1: []}
            for toxic, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found[toxic].extend({x for w in words_in(t) for x in term_hashes(w)})
            for toxic, terms in found.items():
                values, n = np.unique(np.array(terms, np.uint64), return_counts=True)
                yield batch({"term": pa.array(values.view(np.int64)), "n": pa.array(n), "toxic": pa.array(n * toxic)})

    counted = map_batches(sample.select("toxic", "t"), work, "term bigint, n bigint, toxic bigint")
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def telling_terms(counts: DataFrame, rows: int, toxic: int, terms: int) -> list[int]:
    """The terms with the highest log-likelihood ratio between toxic and other documents."""

    def part(k: Column, n: int) -> Column:
        share = (k + 0.5) / (n + 1.0)
        pooled = (F.col("n") + 0.5) / (rows + 1.0)
        return k * F.log(share / pooled) + (n - k) * F.log((1 - share) / (1 - pooled))

    g2 = 2 * (part(F.col("toxic"), toxic) + part(F.col("n") - F.col("toxic"), rows - toxic))
    best = counts.where("n > 1").select("term", g2.alias("g2")).where(F.col("g2") > LEAST_G2)
    return [r.term for r in best.orderBy(F.desc("g2"), "term").limit(terms).collect()]


def fit_machine(lists: list[np.ndarray], toxic: np.ndarray, terms: int, rank: int, rounds: int = 120) -> tuple:
    """Bias, weights and vectors by full-batch Adam on the logistic loss with a small L2 penalty."""
    rng = np.random.default_rng(7)
    at = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    share = float((toxic.sum() + 1) / (len(toxic) + 2))
    p = [np.array([np.log(share / (1 - share))]), np.zeros(terms), rng.normal(0, 0.01, (terms, rank))]
    mean, var = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    n = max(1, len(lists))

    def by_row(values: np.ndarray) -> np.ndarray:
        return np.bincount(row, values, len(lists))

    def by_term(values: np.ndarray) -> np.ndarray:
        return np.bincount(at, values, terms)

    for step in range(1, rounds + 1):
        v = p[2][at]
        sums = np.stack([by_row(v[:, f]) for f in range(rank)], axis=1)
        squares = by_row((v**2).sum(axis=1))
        z = p[0][0] + by_row(p[1][at]) + 0.5 * ((sums**2).sum(axis=1) - squares)
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - toxic) / n
        pull = g[row]
        along = pull[:, None] * (sums[row] - v)
        grads = [
            np.array([g.sum()]),
            by_term(pull) + 1e-5 * p[1],
            np.stack([by_term(along[:, f]) for f in range(rank)], axis=1) + 1e-4 * p[2],
        ]
        for i, grad in enumerate(grads):
            mean[i] = 0.9 * mean[i] + 0.1 * grad
            var[i] = 0.99 * var[i] + 0.01 * grad**2
            p[i] = p[i] - 0.1 * (mean[i] / (1 - 0.9**step)) / (np.sqrt(var[i] / (1 - 0.99**step)) + 1e-8)
    return float(p[0][0]), p[1], p[2]


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    modulus: int = 5,
    held: int = 0,
    train_rows: int = TRAIN_ROWS,
    terms: int = TERMS,
    rank: int = RANK,
) -> Machine:
    """A machine fitted on labelled rows whose crc32(id) mod ``modulus`` is not ``held``; at most about ``train_rows``.

    Without labelled rows it scores every text one half less a little; without telling terms, the share of toxic rows.
    """
    sample = labelled(docs, labels, doc_id, text, label, modulus, held, train_rows)
    seen = sample.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    if not seen.n:
        return Machine(-0.1, np.zeros(0), np.zeros((0, rank)), {})
    chosen = telling_terms(term_counts(sample), seen.n, seen.toxic, terms)
    table = {t & (2**64 - 1): i for i, t in enumerate(chosen)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = [sorted(rows_of(words_in(t), table, {})) for t in b.column(1).to_pylist()]
            yield batch({"toxic": b.column(0), "terms": known}, {"terms": pa.list_(pa.int32())})

    # At most train_rows lists of at most ``terms`` numbers; in a fixed order, since sums depend on it.
    rows = map_batches(sample.select("toxic", "t"), work, "toxic int, terms array<int>").toPandas()
    known = sorted((toxic, tuple(map(int, x))) for toxic, x in zip(rows["toxic"], rows["terms"]))
    lists = [np.array(x, np.int64) for _, x in known]
    bias, weights, vectors = fit_machine(lists, np.array([x for x, _ in known], np.float64), len(table), rank)
    return Machine(bias, weights, vectors, table)


def rows_of(words: set[str], table: dict[int, int], cache: dict[str, tuple[int, ...]]) -> set[int]:
    """Rows of the known terms of the words; the cache keeps what words have led to."""
    out: set[int] = set()
    for w in words:
        rows = cache.get(w)
        if rows is None:
            rows = tuple(table[h] for h in term_hashes(w) if h in table)
            if len(cache) >= CACHED_WORDS:
                cache.clear()
            cache[w] = rows
        if rows:
            out.update(rows)
    return out


def score(machine: Machine, text: Column, docs: DataFrame) -> Column:
    """Column with the probability that a text is toxic; null and empty texts are scored as texts without terms."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @partial(F.pandas_udf, returnType="double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, cache = shared.value, {}
        for texts in parts:
            yield pd.Series([known.score(sorted(rows_of(words_in(t or ""), known.table, cache))) for t in texts], dtype="float64")

    return scored(text)


def toxicity(docs: DataFrame, machine: Machine, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every row, repeated rows and null ids included; other columns are not read."""
    return docs.select(col(doc_id).alias("id"), score(machine, col(text), docs).alias("score")).withColumnRenamed("id", doc_id)


def without_toxic(docs: DataFrame, machine: Machine, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    return docs.where(score(machine, col(text), docs) < threshold)
