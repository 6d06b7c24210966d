"""Best-fit packing of documents into sequences of a fixed length, under conflicts.

No sequence holds two documents of one source, or two of one cluster of copies. Each open bin carries a bitmap of the
sources and of the clusters in it. Bins are ordered by what is left of them; the search begins at the first bin that is
large enough and goes on to its successors until it meets the first, and so tightest, whose bitmap is free.

A document longer than a sequence fills whole sequences by itself; only its last piece is packed. Pieces are dealt into
shards by a hash of their whole row and copy number, so no source, cluster or repeated row can fill a shard; a shard is
packed in one task, largest piece first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.llm.common import text_of

# Characters of a sequence: about 2048 tokens of four characters.
CAPACITY = 8192
# Pieces in a shard on average; bounds the task's memory and the length of a search.
SHARD_PIECES = 4096
# Copies of one row that are numbered together.
COPIES_AT_ONCE = 1000

PLACED = "id {id}, copy bigint, piece int, start int, n_chars int, bin_id string, bin_start int"


def _bits(groups: list[np.ndarray]) -> np.ndarray:
    """One bitmap per row. Each group has codes, -1 for none; every code of every group is a bit."""
    width = sum(int(g.max(initial=-1)) + 1 for g in groups)
    out = np.zeros((len(groups[0]), max(1, -(-width // 64))), np.uint64)
    base = 0
    for g in groups:
        has = np.flatnonzero(g >= 0)
        at = base + g[has]
        out[has, at // 64] |= np.uint64(1) << (at % 64).astype(np.uint64)
        base += int(g.max(initial=-1)) + 1
    return out


def _codes(values: pa.ChunkedArray) -> np.ndarray:
    """Codes of values that occur twice or more, -1 for the others: they cannot conflict."""
    codes = values.combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    often = np.bincount(codes[codes >= 0], minlength=1) > 1
    numbers = np.where(often, np.cumsum(often) - 1, -1)
    return np.where(codes >= 0, numbers[np.maximum(codes, 0)], -1)


def best_fit(sizes: np.ndarray, bits: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it of each piece, taken in the order given."""
    n = len(sizes)
    bins, starts = np.empty(n, np.int64), np.empty(n, np.int64)
    # Open bins by what is left of them, then by number.
    order, open_bits, used = np.empty(n + 1, np.int64), np.zeros((n + 1, bits.shape[1]), np.uint64), 0
    shift, made = n + 1, 0
    for i in range(n):
        size, own = int(sizes[i]), bits[i]
        at, step, hit = int(np.searchsorted(order[:used], size * shift)), 32, -1
        while at < used:
            end = min(used, at + step)
            free = ~(open_bits[at:end] & own).any(axis=1)
            if free.any():
                hit = at + int(free.argmax())
                break
            at, step = end, step * 4
        if hit < 0:
            number, left, held = made, capacity, own
            made += 1
        else:
            left, number = divmod(int(order[hit]), shift)
            held = open_bits[hit] | own
            order[hit : used - 1] = order[hit + 1 : used]
            open_bits[hit : used - 1] = open_bits[hit + 1 : used].copy()
            used -= 1
        bins[i], starts[i] = number, capacity - left
        left -= size
        if left > 0 or size == 0:
            key = left * shift + number
            at = int(np.searchsorted(order[:used], key))
            order[at + 1 : used + 1] = order[at:used].copy()
            open_bits[at + 1 : used + 1] = open_bits[at:used].copy()
            order[at], open_bits[at] = key, held
            used += 1
    return bins, starts


def pieces(
    docs: DataFrame, doc_id: str, text: str, source: str | None, cluster: Column | None, capacity: int
) -> DataFrame:
    """One row per repeated document and piece of at most ``capacity`` characters."""
    size = F.length(text_of(text))
    rows = docs.select(
        col(doc_id).alias("id"),
        (F.lit(None) if source is None else col(source)).cast("string").alias("source"),
        (F.when(size > 0, F.xxhash64(text_of(text))) if cluster is None else cluster.cast("bigint")).alias("cluster"),
        size.alias("size"),
    )
    # Rows that are the same are numbered, so they spread over the shards. Blocks of numbers are dealt to tasks before they
    # are written out; a fixed number of tasks, as adaptive execution would see only how few blocks there are.
    key = ["id", "source", "cluster", "size"]
    rows = rows.groupBy(*key).agg(F.count("*").alias("n"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), "n", F.lit(COPIES_AT_ONCE).cast("bigint"))).alias("first"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, *key, "first")
    copies = F.sequence("first", F.least("n", F.col("first") + (COPIES_AT_ONCE - 1)))
    rows = rows.select(*key, F.explode(copies).alias("copy"))
    last = F.greatest(F.ceil(F.col("size") / capacity), F.lit(1)).cast("int") - 1
    cut = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece") * capacity
    return cut.select(
        "id",
        "copy",
        "piece",
        start.alias("start"),
        F.least(F.col("size") - start, F.lit(capacity)).alias("n_chars"),
        "source",
        "cluster",
        F.xxhash64("id", "source", "cluster", "size", "copy", "piece").alias("key"),
    )


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str | None = "source",
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """``doc_id, copy, piece, start, n_chars, bin_id, bin_start``: every character of every row, placed once.

    ``start`` is the piece's place in the text, ``bin_start`` its place in the bin, both in characters. ``copy`` numbers
    rows that are equal in id, source, cluster and length. Without ``cluster`` texts that are equal make a cluster. A null
    source or cluster conflicts with nothing; a null or empty text is one piece without characters, which is placed like
    any other and shares no cluster. Equal sizes are taken in the order of the rows' hash. No rows give no bins.
    """
    if capacity < 1 or shard_pieces < 1:
        raise ValueError("capacity and shard_pieces must be at least 1")
    kind = docs.schema[doc_id].dataType.simpleString()
    cut = pieces(docs, doc_id, text, source, cluster, capacity)
    whole = F.col("n_chars") == capacity
    number = F.lower(F.hex("key"))
    full = cut.where(whole).select(
        "id", "copy", "piece", "start", "n_chars", F.concat(F.lit("full-"), number).alias("bin_id"), F.lit(0).alias("bin_start")
    )
    rest = cut.where(~whole)
    shards = max(1, -(-docs.count() // shard_pieces))
    rest = rest.withColumn("shard", F.pmod(F.col("key"), F.lit(shards)))

    def work(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("n_chars", "descending"), ("key", "ascending")])
        bits = _bits([_codes(shard["source"]), _codes(shard["cluster"])])
        bins, starts = best_fit(shard["n_chars"].to_numpy(), bits, capacity)
        prefix = shard["shard"][0].as_py()
        out = shard.select(["id", "copy", "piece", "start", "n_chars"])
        out = out.append_column("bin_id", pa.array([f"{prefix}-{b}" for b in bins], pa.string()))
        return out.append_column("bin_start", pa.array(starts.astype(np.int32)))

    packed = rest.groupBy("shard").applyInArrow(work, PLACED.format(id=kind))
    return full.unionByName(packed).withColumnRenamed("id", doc_id)
