"""Index of a load's files: which of them may hold a partition key, and until when.

A load made with ``index_files`` has beside its files a small table with, for each file and block of keys, the span of their
tokens and write timestamps, the newest expiry, and a Bloom filter of the tokens: three bitmaps, each with one bit set for a
token. The keys of a file are cut into blocks by a hash, into as many as keep the bitmaps sparse, so a filter grows with the file
it stands for. It is built by one aggregation of the token column with Spark's bitmap functions. A lookup reads the block its
key is in, and opens only files whose bits are set.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.sources.store import KeyedStore, LogRow
from keyedload.spec import ATTEMPT, BUCKET, EXPIRES, LOAD_ID, NEVER, TOKEN, WTS, TableSpec

# Folder of the index in the directory of an attempt; Spark does not see it as data.
FOLDER = "_files"
# Bits that Spark's bitmap functions hold in one value.
BITS = 8 * 4096
BITMAPS = 3
# Rows of a block: with so many distinct tokens a file is opened in vain for one key in a hundred.
BLOCK_ROWS = 8_000

INDEX = (
    f"{LOAD_ID} string, file string, {BUCKET} int, block int, first bigint, last bigint, rows bigint, min_wts bigint, max_wts bigint, "
    "expires bigint, " + ", ".join(f"bits{i} binary" for i in range(BITMAPS))
)


def file_token(spec: TableSpec, partitioner: str) -> Column:
    """What the index knows a partition key by; ordered keys have no token."""
    return F.xxhash64(*[col(c) for c in spec.partition_key]) if partitioner == "ordered" else F.col(TOKEN)


def block_of(token: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(token, F.lit(-1)), F.lit(blocks)).cast("int")


def bit_of(token: Column, i: int) -> Column:
    return F.pmod(F.xxhash64(token, F.lit(i)), F.lit(BITS))


def is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


def write_index(store: KeyedStore, spec: TableSpec, entry: LogRow) -> int:
    """Writes the index of a written load, and returns the blocks that each of its files is cut into."""
    rows = store.loads(spec, [entry])
    blocks = max(1, -(-entry.rows // (BLOCK_ROWS * max(1, len(rows.inputFiles())))))
    name = F.regexp_extract("_metadata.file_path", f"/{ATTEMPT}={entry.attempt}/(.*)$", 1)
    keys = rows.select(name.alias("file"), BUCKET, file_token(spec, entry.partitioner).alias("t"), WTS, EXPIRES)
    bitmaps = [F.bitmap_construct_agg(bit_of(F.col("t"), i)).alias(f"bits{i}") for i in range(BITMAPS)]
    found = keys.groupBy("file", BUCKET, block_of(F.col("t"), blocks).alias("block")).agg(
        F.min("t").alias("first"),
        F.max("t").alias("last"),
        F.count(F.lit(1)).alias("rows"),
        F.min(WTS).alias("min_wts"),
        F.max(WTS).alias("max_wts"),
        F.max(F.coalesce(F.col(EXPIRES), F.lit(NEVER))).alias("expires"),
        *bitmaps,
    )
    # In this order a lookup is led to few pages by their statistics.
    found = found.withColumn(LOAD_ID, F.lit(entry.load_id)).sortWithinPartitions(BUCKET, "block", "first")
    found.write.parquet(index_path(store, spec, entry))
    return blocks


def index_path(store: KeyedStore, spec: TableSpec, entry: LogRow) -> str:
    return f"{store.data_path(spec, entry.load_id, entry.attempt, entry.partitioner)}/{FOLDER}"


@dataclass(frozen=True)
class Place:
    """Where a key lies under one placement."""

    bucket: int
    token: int | None  # what rows are filtered by; ordered keys have none
    known_by: int  # its token in an index


def index_rows(store: KeyedStore, spec: TableSpec, loads: Sequence[LogRow]) -> DataFrame:
    """The index of loads that have one."""
    return store.spark.read.schema(INDEX).parquet(*[index_path(store, spec, r) for r in loads])


def candidates(
    store: KeyedStore, spec: TableSpec, loads: Sequence[LogRow], places: dict[str, Place], as_of: int | None
) -> dict[str, list[str]]:
    """The files of indexed loads that may hold a key, by load. ``places`` has the key's place under each load.

    With ``as_of`` these loads are all that a read has, and files whose rows of the key's block have expired by then are left out
    where no other file could show what they hide. What comes to the driver is the names of the files of one key.
    """
    alike: dict[tuple[Place, int], list[str]] = {}
    for r in loads:
        alike.setdefault((places[r.load_id], r.index_blocks), []).append(r.load_id)
    wanted = F.lit(False)
    for (place, blocks), ids in alike.items():
        t = F.lit(place.known_by).cast("bigint")
        here = (F.col(BUCKET) == place.bucket) & (F.col("block") == block_of(t, blocks)) & (F.col("first") <= t) & (F.col("last") >= t)
        for i in range(BITMAPS):
            here = here & is_set(F.col(f"bits{i}"), bit_of(t, i))
        wanted = wanted | (F.col(LOAD_ID).isin(ids) & here)
    found = index_rows(store, spec, loads).where(wanted).select(LOAD_ID, "file", "min_wts", "max_wts", "expires").collect()
    alive = [as_of is None or r["expires"] > as_of for r in found]
    oldest = min((r["min_wts"] for r, lives in zip(found, alive) if lives), default=NEVER)
    out: dict[str, list[str]] = {}
    for r, lives in zip(found, alive):
        if lives or oldest <= r["max_wts"]:
            out.setdefault(r[LOAD_ID], []).append(r["file"])
    return out


def needed(loads: Sequence[LogRow], as_of: int) -> list[LogRow]:
    """The loads that a read at ``as_of`` has to open: not those whose rows have all expired, where what is alive is newer than
    all they hold, so that nothing they hide could show."""
    oldest = min((r.min_wts for r in loads if r.alive(as_of)), default=NEVER)
    return [r for r in loads if r.alive(as_of) or oldest <= r.max_wts]
