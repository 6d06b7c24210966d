"""A load at a capped rate: its rows are cut into slices of key ranges, which are written one after another at that pace.

The rows are converted and placed once, into the scratch folder. Their bytes are added up per range of the token, the ranges
joined into slices below the cap, and a range that alone is above it (a hot key) is cut further by a hash of its rows, with
more parts until each is below. So a slice is above the cap only if it is a single row. Each is written from its own staged
files, without another shuffle; the target gets no more than a slice in one interval.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from time import monotonic, sleep

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyedload.functions.names import col
from keyedload.operators.place import sort_order
from keyedload.sources.store import scratch_root
from keyedload.spec import BUCKET, TOKEN, LoadConf, TableSpec

# Ranges of the token that a slice has at least, if no key is hot.
RANGES_PER_SLICE = 16
MOST_RANGES = 1 << 16

_WIDTHS = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}
ID, BYTES, RANGE, PART = "_only_id", "_only_bytes", "_only_range", "_only_part"


def row_bytes(schema: T.StructType) -> Column:
    """About the bytes of a row before compression."""
    total = F.lit(0)
    for f in schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.coalesce(F.octet_length(col(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.coalesce(F.octet_length(F.to_json(col(f.name))), F.lit(0))
        else:
            size = F.lit(_WIDTHS.get(type(f.dataType), 8))
        total = total + size
    return total.cast("bigint")


@dataclass(frozen=True)
class Piece:
    """A range of the token, or one part of it."""

    range: int
    part: int
    parts: int
    bytes: int


def planned(pieces: list[Piece], cap: int) -> list[list[Piece]]:
    """Slices of consecutive pieces, none above the cap that could be cut."""
    out: list[list[Piece]] = []
    held = 0
    for p in sorted(pieces, key=lambda p: (p.range, p.part)):
        if not out or held + p.bytes > cap:
            out.append([])
            held = 0
        out[-1].append(p)
        held += p.bytes
    return out


def _part(parts: Column) -> Column:
    return F.pmod(F.xxhash64(ID), parts).cast("int")


def _pieces(staged: DataFrame, cap: int) -> list[Piece]:
    """Ranges and their parts with their bytes: a few numbers for every slice there will be."""
    sums = staged.groupBy(RANGE).agg(F.sum(BYTES).alias("b"), F.count("*").alias("n")).collect()
    done = [Piece(r[RANGE], 0, 1, r.b) for r in sums if r.b <= cap or r.n == 1]
    open_ = {r[RANGE]: 2 * -(-r.b // cap) for r in sums if r.b > cap and r.n > 1}
    spark = staged.sparkSession
    while open_:
        parts = spark.createDataFrame(list(open_.items()), f"{RANGE} int, parts bigint")
        cut = staged.join(parts, RANGE).groupBy(RANGE, "parts", _part(F.col("parts")).alias("part"))
        found: dict[int, list] = {}
        for r in cut.agg(F.sum(BYTES).alias("b"), F.count("*").alias("n")).collect():
            found.setdefault(r[RANGE], []).append(r)
        open_ = {}
        for k, rows in found.items():
            if all(r.b <= cap or r.n == 1 for r in rows):
                done += [Piece(k, r.part, r.parts, r.b) for r in rows]
            else:
                open_[k] = rows[0].parts * 2
    return done


def capped_write(rows: DataFrame, spec: TableSpec, write: Callable[[DataFrame], None], conf: LoadConf, wanted: dict[str, Column]) -> dict:
    """Has ``rows``, which are placed, written in slices of at most ``conf.bytes_per_trigger`` bytes, one in every
    ``conf.trigger_seconds``. Returns the totals asked for."""
    spark = rows.sparkSession
    cap, scratch = conf.bytes_per_trigger, scratch_root(spark)
    data = T.StructType([f for f in rows.schema.fields if not f.name.startswith("_only_")])
    metrics = Observation()
    sized = rows.withColumns({ID: F.monotonically_increasing_id(), BYTES: row_bytes(data)})
    wanted = wanted | {BYTES: F.coalesce(F.sum(BYTES), F.lit(0))}
    sized.observe(metrics, *[c.alias(name) for name, c in wanted.items()]).write.parquet(f"{scratch}/rows")
    seen = dict(metrics.get)
    ranges = min(MOST_RANGES, RANGES_PER_SLICE * (seen.pop(BYTES) // cap + 1))
    token = F.col(TOKEN) if TOKEN in rows.columns else F.xxhash64(*[col(c) for c in spec.key])
    # Ranges of the token, in each bucket apart; rows set aside have no token.
    at = F.pmod(F.coalesce(F.shiftright(token, 40), F.lit(0)), F.lit(2**20)) * F.lit(ranges)
    staged = spark.read.schema(sized.schema).parquet(f"{scratch}/rows")
    staged = staged.withColumn(RANGE, (F.col(BUCKET) * ranges + F.shiftright(at, 20)).cast("int"))
    slices = planned(_pieces(staged, cap), cap)
    if not slices:
        write(staged)
        return seen
    plan = [(p.range, p.part, p.parts, i) for i, s in enumerate(slices) for p in s]
    parts = spark.createDataFrame([(r, n) for r, n in {(r, n) for r, _, n, _ in plan}], f"{RANGE} int, parts int")
    numbered = spark.createDataFrame([(r, k, i) for r, k, _, i in plan], f"{RANGE} int, {PART} int, _only_slice int")
    dealt = staged.join(parts, RANGE).withColumn(PART, _part(F.col("parts"))).join(numbered, [RANGE, PART])
    order = ["_only_slice", *sort_order(spec, conf)]
    placed = dealt.drop("parts", RANGE, PART, ID, BYTES).hint("rebalance", F.col("_only_slice")).sortWithinPartitions(*order)
    placed.write.partitionBy("_only_slice").parquet(f"{scratch}/slices")
    due = monotonic()
    for i in range(len(slices)):
        sleep(max(0.0, due - monotonic()))
        due = max(due, monotonic()) + conf.trigger_seconds
        part = spark.read.schema(data).parquet(f"{scratch}/slices/_only_slice={i}")
        write(part.sortWithinPartitions(*sort_order(spec, conf)))
    return seen
