"""Token counts of whole texts, by a two-tier lookup of pre-token lengths inside the tasks.

A text's tokens are those of its pre-tokens (words, digits, runs of signs), and most pre-tokens of a corpus are frequent.
The first tier is a table of the frequent ones, from a bounded sample of documents, sent to every task. What it misses
is encoded once by the tokenizer and kept in the worker's cache. No pre-token is ever shuffled.

The normalisation and the splitting that come before the vocabulary are repeated here only for texts of characters on
which they are plain: ASCII, and letters of the Latin-1 supplement and Latin Extended-A. Any other text, and one in which
a special token's string may occur, is encoded whole by the tokenizer.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.llm.common import batch, map_batches, text_of

# Documents that the table of frequent pre-tokens is made from (about so many, by hash of the text), and its entries.
SAMPLE_DOCUMENTS = 2_000
FREQUENT = 50_000
# Longest pre-token in a table or cache, and entries of a worker's cache.
LONGEST = 64
CACHED = 250_000
ENCODED_AT_ONCE = 4096

# Letters whose lower case is one letter of the same ranges and which no normalisation changes. Left out are the signs
# among them, the dotted capital I, and the n with apostrophe.
_LETTERS = "ªµºÀ-ÖØ-öø-įı-ňŊ-ſ"
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e{_LETTERS}]*+")
# The pre-tokens of the vocabulary's pattern, on plain lower-case texts.
_PRE_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^\sa-z0-9{_LETTERS}]+")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pre_tokens(text: str, specials: tuple[str, ...]) -> list[str] | None:
    """Pre-tokens of a text, or None where only the tokenizer itself can tell."""
    if not _PLAIN.fullmatch(text) or any(s in text for s in specials):
        return None
    return _PRE_TOKEN.findall(text.lower())


class Counts:
    """A worker's tokenizer, the frequent lengths, and a bounded cache of the others."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.tokenizer = load_tokenizer(path)
        self.specials = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.frequent, self.cache = frequent, {}

    def lengths(self, texts: list[str]) -> list[int]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [len(e.ids) for e in found]

    def of(self, texts: list[str]) -> list[int]:
        """Tokens of each text; the misses of all texts are encoded together."""
        totals, missing, wanted = [0] * len(texts), {}, []
        for i, text in enumerate(texts):
            parts = pre_tokens(text, self.specials)
            if parts is None:
                totals[i] = self.lengths([text])[0]
                continue
            for part, n in Counter(parts).items():
                length = self.frequent.get(part) or self.cache.get(part)
                if length is not None:
                    totals[i] += n * length
                else:
                    missing[part] = 0
                    wanted.append((i, part, n))
        new = list(missing)
        for at in range(0, len(new), ENCODED_AT_ONCE):
            chunk = new[at : at + ENCODED_AT_ONCE]
            missing.update(zip(chunk, self.lengths(chunk)))
        for i, part, n in wanted:
            totals[i] += n * missing[part]
        if len(self.cache) + len(missing) > CACHED:
            self.cache.clear()
        self.cache.update((p, n) for p, n in missing.items() if len(p) <= LONGEST)
        return totals


def frequent_lengths(
    docs: DataFrame, path: str, text: str = "text", sample_documents: int = SAMPLE_DOCUMENTS, entries: int = FREQUENT
) -> dict[str, int]:
    """The most frequent pre-tokens of a sample of documents, at most ``entries``, with their token counts.

    The sample takes rows by a hash of their text, so that about ``sample_documents`` of different texts are in it. It only
    decides what is quick; a text is counted alike with any table.
    """
    total = docs.count()
    if not total:
        return {}
    share = max(1, min(1 << 20, int((1 << 20) * sample_documents / total)))
    sample = docs.select(text_of(text).alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(1 << 20)) < share).distinct()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: Counter[str] = Counter()
            for t in b.column(0).to_pylist():
                counts.update(p for p in pre_tokens(t, ()) or () if len(p) <= LONGEST)
            yield batch({"part": list(counts), "n": list(counts.values())}, {"part": pa.string(), "n": pa.int64()})

    counts = map_batches(sample, work, "part string, n bigint").groupBy("part").agg(F.sum("n").alias("n"))
    parts = [r.part for r in counts.orderBy(F.desc("n"), "part").limit(entries).collect()]
    return dict(zip(parts, Counts(path, {}).lengths(parts))) if parts else {}


def token_counts(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_documents: int = SAMPLE_DOCUMENTS,
    entries: int = FREQUENT,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row, as the tokenizer file at ``path`` encodes the whole text.

    No begin, end or other special tokens are added; a special token's string inside a text counts as the tokenizer has
    it by default. A null text is an empty one and has no tokens. Texts of any length are taken whole. Repeated rows and
    null ids are kept; other columns are not read. ``path`` must be readable on every worker.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text, sample_documents, entries))
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for b in batches:
            counts = counts or Counts(path, frequent.value)
            n = pa.array(counts.of(b.column(2).to_pylist()), pa.int64())
            yield batch({"id": b.column(0), "n_bytes": b.column(1), "n_tokens": n})

    rows = docs.select(
        col(doc_id).alias("id"), F.octet_length(text_of(text)).cast("bigint").alias("n_bytes"), text_of(text).alias("t")
    )
    return map_batches(rows, work, f"id {kind}, n_bytes bigint, n_tokens bigint").withColumnRenamed("id", doc_id)
