"""Benchmark decontamination: which words of a document lie in a window of a benchmark item.

A set join with prefix filtering. Containment of a whole window is asked for, so the necessary prefix of a window's
words, ordered by rarity in the documents, is its one rarest word: a document without it cannot hold the window. Documents
meet windows on that word only; its place in the window bounds where the window begins and ends in the document, and
the words in between are then compared exactly.

The items are a stated query set. Its windows are dealt into blocks of a bounded number, each block is sent to all
tasks, and all documents are read for it; hits are carried from block to block. Nothing is shuffled but word counts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyedload.llm.common import batch, map_batches, text_of
from keyedload.functions.names import col

# Windows in a block; a block of ten-word windows takes about 20 MB.
BLOCK_WINDOWS = 100_000

# Words are ASCII letters and digits and everything beyond ASCII, A-Z lower-cased; the rest is a gap.
_GAPS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)

_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def words_of(text: str | None) -> list[bytes]:
    return [] if not text else text.encode("utf-8", "surrogatepass").translate(_GAPS).split()


def windows(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """``item, window`` for every window of ``size`` words; a shorter item is one window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(t)
                if not words:
                    continue
                found = list(dict.fromkeys(b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))))
                for at in range(0, len(found), 10_000):
                    part = found[at : at + 10_000]
                    yield batch({"item": [item] * len(part), "window": part}, {"item": pa.string(), "window": pa.binary()})

    rows = items.select(col(item_id).cast("string").alias("i"), text_of(text).alias("t"))
    return map_batches(rows, work, "item string, window binary").distinct()


def word_counts(texts: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How often the words of a block's vocabulary occur in all texts. Counted in the tasks, summed by Spark."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value, defaultdict(int)
        for b in batches:
            for t in b.column(0).to_pylist():
                for w in filter(known.__contains__, words_of(t)):
                    counts[w] += 1
        yield batch({"w": list(counts), "n": list(counts.values())}, {"w": pa.binary(), "n": pa.int64()})

    sums = map_batches(texts, work, "w binary, n bigint").groupBy("w").agg(F.sum("n").alias("n"))
    return {bytes(r.w): r.n for r in sums.collect()}


def prefix_table(block: list[tuple[str | None, bytes]], counts: dict[bytes, int]) -> dict[bytes, dict]:
    """Windows by their rarest word, then by its place and the window's length, then by their text."""
    table: dict[bytes, dict] = {}
    for item, window in block:
        words = window.split(b" ")
        at = min(range(len(words)), key=lambda i: (counts.get(words[i], 0), words[i], i))
        # The windows of an item without an id count too; it is only not in the list of items.
        known = table.setdefault(words[at], {}).setdefault((at, len(words)), {}).setdefault(window, set())
        if item is not None:
            known.add(item)
    return table


def hits_in(words: list[bytes], table: dict[bytes, dict]) -> tuple[list[tuple[int, int]], set[str]]:
    """Word spans of the windows that occur, and their items."""
    spans, items, n = [], set(), len(words)
    for i, w in enumerate(words):
        if w in table:
            for (at, length), known in table[w].items():
                start = i - at
                if start >= 0 and start + length <= n:
                    found = known.get(b" ".join(words[start : start + length]))
                    if found is not None:
                        spans.append((start, start + length))
                        items |= found
    return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _with_hits(df: DataFrame, text: str, table: dict[bytes, dict], keep: list[str]) -> DataFrame:
    """Adds a block's hits to ``spans`` and ``items``; returns the columns to keep."""
    shared = df.sparkSession.sparkContext.broadcast(table)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            n_words, spans, items = [], [], []
            for t, old_spans, old_items in zip(*(b.column(c).to_pylist() for c in (text, "spans", "items"))):
                words = words_of(t)
                new_spans, new_items = hits_in(words, known)
                n_words.append(len(words))
                together = merged([(x["start"], x["end"]) for x in old_spans] + new_spans)
                spans.append([{"start": s, "end": e} for s, e in together])
                items.append(sorted(new_items.union(old_items)))
            made = {
                "n_words": pa.array(n_words, pa.int64()),
                "spans": pa.array(spans, _SPANS),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            yield batch({c: made[c] if c in made else b.column(c) for c in keep})

    return map_batches(df, work, schema)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str | None = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    block_windows: int = BLOCK_WINDOWS,
    carry: list[str] | None = None,
) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every row: word spans in occurring windows, and the items they are of.

    Spans are merged and in word positions, end exclusive; items are distinct ids as text, sorted as strings. ``carry``
    names columns of ``docs`` to return unchanged (with ``doc_id=None``, only those). A null or empty text has no words.
    Items without words are no items, and those without an id are in no list, but their windows count; rows that repeat an item's
    id are parts of one item. Repeated documents are judged each, no items mean no hits, and other columns are not read.
    """
    if window < 1:
        raise ValueError("a window has at least one word")
    asked = windows(items, item_id, item_text, window).persist()
    total = asked.count()
    blocks = max(1, -(-total // block_windows))
    kept = ([doc_id] if doc_id else []) + (carry or [])
    held = f"c{kept.index(text)}" if text in kept else "t"
    out = docs.select(
        *[col(c).alias(f"c{i}") for i, c in enumerate(kept)],
        *([] if text in kept else [col(text).alias("t")]),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for k in range(blocks):
        # Bounded: the hash deals the windows evenly over the blocks.
        part = asked.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == k) if blocks > 1 else asked
        block = [(r.item, bytes(r.window)) for r in part.collect()]
        vocabulary = frozenset(w for _, x in block for w in x.split(b" "))
        counts = word_counts(docs.select(text_of(text).alias("t")), vocabulary) if vocabulary else {}
        keep = [c for c in out.columns if c != "t" or k < blocks - 1]
        out = _with_hits(out, held, prefix_table(block, counts), keep)
    asked.unpersist()
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "n_words", "spans", "items")


def without_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all their columns."""
    judged = contamination(docs, items, None, text, carry=docs.columns, **options)
    names = [f"c{i}" for i in range(len(docs.columns))]
    clean = judged.toDF(*names, "n_words", "spans", "items").where(F.size("spans") == 0)
    return clean.select(*names).toDF(*docs.columns)
