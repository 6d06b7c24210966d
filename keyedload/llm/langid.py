"""Language of a text by error-correcting output codes.

Each language has a codeword of bits. For each bit a binary classifier tells languages with a 1 from those with a 0 by the
byte n-grams of the text's letters (smoothed log-odds of n-gram counts over all training texts). Decoding adds up, for each
codeword, the losses of its bits, each weighted by how well its classifier did on the training counts, and takes the
codeword with the least loss; a text whose two best codewords are close is flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.llm.common import batch, map_batches, text_of

BUCKETS = 1 << 16
UNKNOWN = "und"
# A text is ambiguous if its second language has more than this share of the score.
AMBIGUOUS = 0.25
GRAMS_AT_ONCE = 1 << 16

# Letters, with the marks that some scripts write on them.
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def letters(text: str) -> bytes:
    """Lower-case words between single spaces; empty if the text has no letters."""
    words = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {words} ".encode("utf-8", "surrogatepass") if _LETTER.search(words) else b""


def grams(data: bytes) -> Iterator[np.ndarray]:
    """Buckets of the byte 2-grams, 3-grams and 4-grams, a piece of the text at a time; no n-gram is lost between pieces."""
    for at in range(0, len(data), GRAMS_AT_ONCE):
        x = np.frombuffer(data[at : at + GRAMS_AT_ONCE + 3], np.uint8).astype(np.uint32)
        here = min(GRAMS_AT_ONCE, len(data) - at)
        parts, key = [], x
        for n in (2, 3, 4):
            if len(x) < n:
                break
            key = key[: len(x) - n + 1] * np.uint32(257) + x[n - 1 :]
            mixed = (key + np.uint32(n)) * np.uint32(2654435761)
            parts.append((mixed >> np.uint32(16))[:here])
        if parts:
            yield np.concatenate(parts)


def codewords(languages: int) -> np.ndarray:
    """One row of +1 and -1 per language; every two differ in about half the bits.

    Up to six languages have the exhaustive code: every way to split them. More have as many bits as ten times the
    logarithm of their number, drawn by a fixed seed, with no constant bit.
    """
    if languages <= 1:
        return np.ones((languages, 1), np.float64)
    if languages <= 6:
        splits = [set(c) for k in range(languages - 1) for c in combinations(range(1, languages), k)]
        return np.array([[1.0 if i == 0 or i in s else -1.0 for s in splits] for i in range(languages)])
    rng = np.random.default_rng(11)
    bits = int(np.ceil(10 * np.log2(languages)))
    best, distance = None, -1
    for _ in range(20):
        code = rng.choice([-1.0, 1.0], (languages, bits))
        code[0, np.abs(code.sum(axis=0)) == languages] *= -1
        apart = min(int((code[i] != code[j]).sum()) for i, j in combinations(range(min(languages, 60)), 2))
        if apart > distance:
            best, distance = code, apart
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # language x bit
    odds: np.ndarray  # bucket x bit: log-odds of the bit's 1
    weights: np.ndarray  # of the bits

    def scores(self, text: str) -> np.ndarray | None:
        """A probability for each language, or None for a text without letters."""
        margins, n = np.zeros(self.code.shape[1]), 0
        for g in grams(letters(text)):
            margins += self.odds[g].sum(axis=0, dtype=np.float64)
            n += len(g)
        if not n or not self.languages:
            return None
        # The mean log-odds of an n-gram, times a length that makes the losses of short texts softer.
        margins *= min(n, 400.0) / n / 10
        losses = np.logaddexp(0, -margins * self.code) @ self.weights
        shares = np.exp(losses.min() - losses)
        return shares / shares.sum()


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, bucket, n`` over all rows with a language. Tasks add up before anything is shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for language, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for g in grams(letters(t)):
                    if language not in sums:
                        sums[language] = np.zeros(BUCKETS, np.int64)
                    sums[language] += np.bincount(g, minlength=BUCKETS)
        for language, counts in sums.items():
            at = np.flatnonzero(counts)
            yield batch({"lang": [language] * len(at), "bucket": pa.array(at.astype(np.int32)), "n": pa.array(counts[at])})

    rows = docs.where(col(lang).isNotNull()).select(col(lang).cast("string").alias("lang"), text_of(text).alias("t"))
    counts = map_batches(rows, work, "lang string, bucket int, n bigint")
    return counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model from all rows of ``docs`` with a language and letters.

    What comes to the driver is at most one count for each language and bucket.
    """
    rows = gram_counts(docs, text, lang).toPandas()
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS))
    at = np.searchsorted(languages, rows["lang"].to_numpy()) if len(rows) else np.zeros(0, int)
    counts[at, rows["bucket"].to_numpy(int)] = rows["n"].to_numpy()
    code = codewords(len(languages))
    # A language counts the same however many texts it has.
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    smooth = 1e-6
    odds = np.zeros((BUCKETS, code.shape[1]))
    weights = np.ones(code.shape[1])
    for b in range(code.shape[1]):
        one, zero = code[:, b] > 0, code[:, b] < 0
        if one.any() and zero.any():
            odds[:, b] = np.log((shares[one].mean(axis=0) + smooth) / (shares[zero].mean(axis=0) + smooth))
            # How far apart the classifier keeps the two sides on the training counts.
            gap = shares @ odds[:, b] * code[:, b]
            weights[b] = max(float(gap.min()), 1e-3)
    return Model([str(x) for x in languages], code, odds.astype(np.float32), weights / weights.mean())


def languages(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every row.

    A null text, one without letters, and any text where no language was learned give ``und`` with score 0. Languages with
    equal scores are told apart by name. Repeated rows and null ids are kept; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            names, scores, unclear = [], [], []
            for t in b.column(1).to_pylist():
                s = known.scores(t)
                if s is None:
                    names.append(UNKNOWN), scores.append(0.0), unclear.append(False)
                    continue
                best = int(s.argmax())
                names.append(known.languages[best]), scores.append(float(s[best]))
                unclear.append(bool(np.delete(s, best).max(initial=0.0) > AMBIGUOUS))
            yield batch(
                {"id": b.column(0), "lang_pred": names, "score": scores, "ambiguous": unclear},
                {"lang_pred": pa.string(), "score": pa.float64(), "ambiguous": pa.bool_()},
            )

    rows = docs.select(col(doc_id).alias("id"), text_of(text).alias("t"))
    schema = f"id {kind}, lang_pred string, score double, ambiguous boolean"
    return map_batches(rows, work, schema).withColumnRenamed("id", doc_id)
