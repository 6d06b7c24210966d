"""Reports over loads: the log, rows per bucket, rows per replica, order of the files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.functions.tokens import ring_replicas
from keyedload.operators.resolve import published_rows
from keyedload.sources.store import KeyedStore
from keyedload.spec import BUCKET, TOKEN, LoadConf, TableSpec

# Positions of a file that are looked at together.
BLOCK_ROWS = 100_000


def load_log(store: KeyedStore, keyspace: str, table: str) -> DataFrame:
    """Published loads with their row counts and rates."""
    log = store.log(store.spec(keyspace, table))
    return log.withColumn("rows_per_second", F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds")))


def bucket_report(store: KeyedStore, keyspace: str, table: str) -> DataFrame:
    """Mutation rows and token span of every bucket, over all published loads."""
    rows, _ = published_rows(store, store.spec(keyspace, table))
    return rows.groupBy(F.col(BUCKET).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(TOKEN).alias("min_token"), F.max(TOKEN).alias("max_token")
    )


def replica_report(store: KeyedStore, keyspace: str, table: str, ranges: int, copies: int) -> DataFrame:
    """Rows each node of a ring of ``ranges`` nodes holds, every range living on ``copies`` nodes.

    Rows are counted per range first; only the counts are copied to the replicas.
    """
    rows, _ = published_rows(store, store.spec(keyspace, table))
    per_range = rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"))
    owners = F.explode(ring_replicas(F.col(BUCKET), ranges, copies)).alias("node")
    return per_range.select(owners, "rows").groupBy("node").agg(F.sum("rows").alias("rows"))


def misordered_rows(store: KeyedStore, spec: TableSpec, load_id: str, conf: LoadConf) -> DataFrame:
    """Rows of a load's files that must not follow their predecessor in the file.

    Rows are looked at in blocks of positions, so a large file spreads over many tasks: one shuffle of numbers and order
    columns. Only the edges of blocks meet in a join.
    """
    key = list(spec.partition_key)
    order: list[tuple[str, bool]] = [] if conf.partitioner == "ordered" else [(TOKEN, True)]
    order += [(c, True) for c in key] + [(c, d == "asc") for c, d in spec.clustering]
    at = F.col("_metadata.row_index")
    rows = store.loads(spec, [load_id]).select(
        F.xxhash64("_metadata.file_path").alias("_file"),
        at.alias("_row"),
        F.struct(*[col(c).alias(f"o{i}") for i, (c, _) in enumerate(order)]).alias("_here"),
    )
    in_block = Window.partitionBy("_file", F.expr(f"_row div {BLOCK_ROWS}")).orderBy("_row")
    inside = rows.withColumn("_before", F.lag("_here").over(in_block)).where("_before is not null")
    ends = rows.where(F.col("_row") % BLOCK_ROWS == BLOCK_ROWS - 1)
    ends = ends.select("_file", (F.col("_row") + 1).alias("_row"), F.col("_here").alias("_before"))
    across = rows.where(F.col("_row") % BLOCK_ROWS == 0).join(ends, ["_file", "_row"])
    wrong: Column = F.lit(False)
    equal: Column = F.lit(True)
    for i, (_, ascending) in enumerate(order):
        here, prev = F.col("_here")[f"o{i}"], F.col("_before")[f"o{i}"]
        wrong = wrong | (equal & ((here < prev) if ascending else (here > prev)))
        equal = equal & (here == prev)
    return inside.unionByName(across).where(wrong)
