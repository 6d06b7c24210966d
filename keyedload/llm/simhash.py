"""SimHash near copies: fingerprints, and the components that small bit distances link.

A fingerprint is embedded as the bit counts of its segments. Flipping one bit changes one count by one, so the
Manhattan distance of two embeddings is a lower bound of the bit distance. Pairs are found by a range join on the
grid of embeddings and then verified on the bits.

The cells are those of the whole embedding, and the join needs no row for every cell within the distance: of two embeddings
two apart, some cell is one from each. Each fingerprint is therefore entered in its own cell and in those that differ from
it by one in one count, and whatever shares a cell is compared. That is about 49 rows of 16 bytes per distinct fingerprint,
at any size. Cells of the whole embedding are narrow: two unrelated fingerprints share one once in some 45 billion times, so
few comparisons are in vain.

A cell with many rows (a large group of near copies) is not compared pair by pair. Its fingerprints are entered at
every value that one flipped bit makes of them: two fingerprints at most two bits apart meet at such a value, and no
value has more than 65 of them. So no cell is capped and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyedload.llm.common import batch, map_batches, staged, text_of
from keyedload.functions.names import col

SEED = 42
SHINGLES_AT_ONCE = 1 << 16
# Rows of a grid cell that one task compares; the others go by flipped bits.
CELL_ROWS = 4096
# Rows a task holds while it compares cells.
ROWS_AT_ONCE = 1 << 20


def fingerprint(text: str, shingle: int) -> int:
    """64 bits: a bit is 1 if it is set in over half of the hashes of the text's word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    h = xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = words[at : at + SHINGLES_AT_ONCE + shingle - 1]
        if len(part) < shingle:
            shingles = [b" ".join(part)]
        else:
            shingles = map(b" ".join, zip(*(part[i : len(part) - shingle + 1 + i] for i in range(shingle))))
        hashes = np.array([h(s, SEED) for s in shingles], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, hashed: bool = False) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed bigint) of every row.

    A-Z are lower-cased, words end at ASCII white space; a text with fewer words than a shingle is one shingle, a text
    without words (null, empty, blank) has fingerprint 0. With ``hashed`` there is also ``h``, a hash of the text.
    """
    if shingle < 1:
        raise ValueError("a shingle has at least one word")
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield batch({"id": b.column(0), "fp": pa.array(values.view(np.int64))} | ({"h": b.column(2)} if hashed else {}))

    rows = docs.select(col(doc_id).alias("id"), text_of(text).alias("t"), *([F.xxhash64(text_of(text)).alias("h")] if hashed else []))
    return map_batches(rows, work, f"id {kind}, fp bigint" + ", h bigint" * hashed).withColumnRenamed("id", doc_id)


def _signed(value: int) -> int:
    value &= 2**64 - 1
    return value - 2**64 if value >= 2**63 else value


def segment_counts(half: Column, segment_bits: int) -> Column:
    """Bit counts of the segments of 1, 2 or 4 bits of 32 bits, each count in the place of its segment."""
    if segment_bits not in (1, 2, 4):
        raise ValueError("segments have 1, 2 or 4 bits")
    if segment_bits == 1:
        return half
    pairs = half - F.shiftrightunsigned(half, 1).bitwiseAND(F.lit(0x55555555))
    if segment_bits == 2:
        return pairs
    low = F.lit(0x33333333)
    return pairs.bitwiseAND(low) + F.shiftrightunsigned(pairs, 2).bitwiseAND(low)


def grid_rows(fps: DataFrame, segment_bits: int, max_distance: int = 2) -> DataFrame:
    """Rows ``cell, fp`` of distinct fingerprints: their own cell and those with one count less, or one more.

    At distance 1 the larger of two embeddings meets the smaller in its cell, so counts of one more are left out.
    """
    full = (1 << segment_bits) - 1
    half = {0: F.col("half0"), 1: F.col("half1")}

    def cell(halves: dict[int, Column]) -> Column:
        return F.shiftleft(halves[1], 32).bitwiseOR(halves[0])

    cells = [cell(half)]
    for i in half:
        for at in range(0, 32, segment_bits):
            count = F.shiftrightunsigned(half[i], at).bitwiseAND(F.lit(full))
            cells.append(F.when(count > 0, cell(half | {i: half[i] - F.lit(1 << at)})))
            if max_distance == 2:
                cells.append(F.when(count < segment_bits, cell(half | {i: half[i] + F.lit(1 << at)})))
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    embedded = fps.select(
        "fp", segment_counts(low, segment_bits).alias("half0"), segment_counts(high, segment_bits).alias("half1")
    )
    return embedded.select(F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("cell"), "fp")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links to the smallest value of each component of the links ``a``-``b``: one per linked value."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _links_in_cells(cell: np.ndarray, fp: np.ndarray, max_distance: int):
    """Verified links between rows of a cell. Rows come sorted by cell."""
    found_a, found_b = [], []
    at, step = np.arange(len(cell)), 0
    while True:
        step += 1
        at = at[at + step < len(cell)]
        at = at[cell[at] == cell[at + step]]
        if not len(at):
            break
        ok = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= max_distance]
        found_a.append(fp[ok])
        found_b.append(fp[ok + step])
    if not found_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return _forest(np.concatenate(found_a), np.concatenate(found_b))


def links(fps: DataFrame, max_distance: int = 2, segment_bits: int = 2, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links ``u, v`` that connect what bit distances connect.

    ``fps`` has distinct ``fp``. Each cell gives a spanning forest of its verified links, so a group of near copies
    gives a few rows per fingerprint, not all of its pairs. Of N unrelated fingerprints about N * N / (4 * 10**10) pairs
    are compared in vain at two bits a segment: fewer than one per fingerprint where there are ten billions.
    """
    if max_distance not in (0, 1, 2):
        raise ValueError("the largest bit distance is 0, 1 or 2")
    if max_distance == 0:
        return fps.sparkSession.createDataFrame([], "u bigint, v bigint")
    rows = grid_rows(fps, segment_bits, max_distance)
    crowded = rows.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows).select("cell")
    crowded = staged(crowded, "cells")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def links_of(cell, fp):
            a, b = _links_in_cells(cell, fp, max_distance)
            return batch({"u": pa.array(a.view(np.int64)), "v": pa.array(b.view(np.int64))})

        for b in batches:
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)))
            if sum(len(x[0]) for x in held) >= ROWS_AT_ONCE:
                cell, fp = (np.concatenate(x) for x in zip(*held))
                cut = np.searchsorted(cell, cell[-1], "left")  # the last cell may go on
                yield links_of(cell[:cut], fp[:cut])
                held = [(cell[cut:], fp[cut:])]
        if held:
            yield links_of(*(np.concatenate(x) for x in zip(*held)))

    compared = rows.join(crowded, "cell", "left_anti").repartition("cell").sortWithinPartitions("cell")
    by_cell = compared.select("cell", "fp").mapInArrow(work, "u bigint, v bigint")

    # What meets in a crowded cell meets at a flipped bit.
    dense = rows.join(crowded, "cell", "left_semi").select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    met = dense.select("fp", F.explode(flips).alias("at"))
    # At distance 1 the fingerprint itself is linked with its neighbours, but not they with each other.
    first = F.min("fp") if max_distance == 2 else F.min(F.when(F.col("fp") == F.col("at"), F.col("fp")))
    met = met.withColumn("first", first.over(Window.partitionBy("at")))
    by_flip = met.where("first != fp").select(F.col("fp").alias("u"), F.col("first").alias("v"))
    return by_cell.unionByName(by_flip).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (bigint ``u, v``) that is not the root of its component.

    Alternating large-star and small-star steps; each is written to the shared folder, so an iteration never reaches
    back behind the one before. Only a count and a checksum of the edges come to the driver.
    """

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        now = staged(small, "edges")
        last, seen = seen, mark(now)
        if last == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _rooted(known: DataFrame, max_distance: int = 2, segment_bits: int = 2, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``known``, of distinct ``fp``, with ``root``, the smallest fingerprint that links reach."""
    member = components(links(known.select("fp"), max_distance, segment_bits, cell_rows))
    return known.join(member, known.fp == member.node, "left").select(*known.columns, F.coalesce("root", "fp").alias("root"))


def near_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_distance: int = 2,
    segment_bits: int = 2,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``doc_id, fp, component_id`` of every row; the component is the smallest id that links reach.

    Exact copies share a fingerprint and are never paired: links run between distinct fingerprints. Rows with a null or
    empty text have fingerprint 0 and are linked like any other. Repeated rows are kept. A null id is no component's
    smallest unless all its ids are null; then the component is null. No rows give no rows, and other columns of
    ``docs``, whatever their names, are not read.
    """
    rows = staged(fingerprints(docs, doc_id, text, shingle).select(col(doc_id).alias("id"), "fp"), "fingerprints")
    known = rows.groupBy("fp").agg(F.min("id").alias("id"))
    rooted = staged(_rooted(known, max_distance, segment_bits, cell_rows), "roots")
    smallest = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    out = rows.join(named, "fp")
    return out.select(F.col("id").alias(doc_id), "fp", "component_id")


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def one_of_each_group(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, hot_share: float = 0.001, **options
) -> DataFrame:
    """``docs`` with exactly one row of each group of near copies: that with the smallest id, then fingerprint, then text hash.

    Rows with different texts are different documents even where they share an id, and rows without an id come after all
    others of their group. Of rows equal in id and text any one stays. Rows with neither an id nor words are copies of
    nothing and all stay. An id and text that more than ``hot_share`` of all rows have is summed up before it is dealt out.
    """
    wordless = col(doc_id).isNull() & ~text_of(text).rlike("[^ \\t\\n\\r\\x0B\\x0C]")
    judged = docs.where(~wordless)
    rows = fingerprints(judged, doc_id, text, shingle, hashed=True).select(col(doc_id).alias("id"), "fp", "h")
    rows = staged(rows, "fingerprints")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "fp", "h")
    rooted = _rooted(rows.groupBy("fp").agg(F.min(place).alias("first")), **options)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.id").alias("_id"), F.col("first.h").alias("_h"))
    often = rows.groupBy("id", "h").agg(F.count("*").alias("_n")).where("_n > 1")
    kept = kept.join(often, kept["_id"].eqNullSafe(often["id"]) & (kept["_h"] == often["h"]), "left").select("_id", "_h", "_n")
    kept = staged(kept, "kept")
    # All with so many rows are hot, kept or not: fewer than 1 / hot_share, so they can be sent to all tasks.
    most = max(1.0, hot_share * rows.count())
    hot = staged(often.where(F.col("_n") > most).select(F.col("id").alias("_id"), F.col("h").alias("_h")), "hot")
    hash_of = F.xxhash64(text_of(text))

    def meets(ids: DataFrame) -> Column:
        return judged[doc_id].eqNullSafe(ids["_id"]) & (hash_of == ids["_h"])

    none = hot.isEmpty()
    even = judged if none else judged.join(ids := F.broadcast(hot), meets(ids), "left_anti")

    def those(which: str) -> DataFrame:
        # The ids of a partition are a small hash table; the texts meet them without a sort, in one plan at every size.
        ids = kept.where(which).hint("shuffle_hash")
        return even.join(ids, meets(ids), "left_semi")

    def one_by_one(repeated: DataFrame) -> DataFrame:
        whole = repeated.select(F.struct(*[col(c) for c in docs.columns]).alias("_row"), col(doc_id).alias("_id"), hash_of.alias("_h"))
        first = whole.groupBy("_id", "_h").agg(F.first("_row").alias("_row"))
        return first.select(*[F.col("_row")[c].alias(c) for c in docs.columns])

    # An exchange of its own: a union under the join may claim a partitioning by id that its parts do not share.
    parts = [those("_n is null"), one_by_one(those("_n is not null").repartition(hash_of, col(doc_id))), docs.where(wordless)]
    if not none:
        held = kept.join(hot, kept["_id"].eqNullSafe(hot["_id"]) & (kept["_h"] == hot["_h"]), "left_semi").select("_id", "_h")
        parts.append(one_by_one(judged.join(ids := F.broadcast(held), meets(ids), "left_semi")))
    return reduce(DataFrame.unionByName, [p.select(*[col(c) for c in docs.columns]) for p in parts])
