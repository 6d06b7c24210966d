"""Load progress over a table of progress events.

    load_id string, ts timestamp, kind string, peer string, session int, success boolean,
    file string, current_bytes bigint, total_bytes bigint, total_files bigint

``kind`` is one of PREPARED, COMPLETE, PROGRESS; events of other kinds are ignored. A prepared session
announces its ``total_files`` and ``total_bytes``; they are what its progress is measured by, whether or not
all of its files have reported yet. Files of sessions that were never prepared do not count. A later event of
a file, or a later announcement of a session, replaces the earlier one.

Nothing here windows over raw events: rates first reduce them to one row per file and time bin, and a
window only runs over bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREPARED = "prepared"
COMPLETE = "complete"
PROGRESS = "progress"

SESSION = ["load_id", "peer", "session"]
FILE = SESSION + ["file"]
BYTES_PER_MB = 1024 * 1024


def of_kind(events: DataFrame, kind: str) -> DataFrame:
    return events.where(F.col("kind") == kind)


def session_pairs(events: DataFrame) -> DataFrame:
    """The sessions of every peer, one row each."""
    return of_kind(events, PREPARED).select(*SESSION).distinct()


def sessions_per_peer(events: DataFrame) -> DataFrame:
    return session_pairs(events).groupBy("load_id", "peer").agg(F.count(F.lit(1)).alias("sessions"))


def session_outcomes(events: DataFrame) -> DataFrame:
    """Completed and failed sessions per peer."""
    return (
        of_kind(events, COMPLETE)
        .groupBy("load_id", "peer")
        .agg(F.count_if(F.col("success")).alias("completed"), F.count_if(~F.col("success")).alias("failed"))
    )


def latest_per_file(events: DataFrame, *also_by: Column) -> DataFrame:
    """Newest state of every file; of equally old states, the one further on."""
    state = F.struct("ts", "current_bytes", "total_bytes")
    return (
        of_kind(events, PROGRESS)
        .groupBy(*FILE, *also_by)
        .agg(F.max(state).alias("state"))
        .select(*FILE, *also_by, "state.current_bytes", "state.total_bytes")
    )


def prepared_sessions(events: DataFrame) -> DataFrame:
    """Sessions with the files and bytes they announced last; what is not announced counts as none."""
    announced = F.max(F.struct("ts", "total_files", "total_bytes")).alias("a")
    sessions = of_kind(events, PREPARED).groupBy(*SESSION).agg(announced)
    none = F.lit(0).cast("bigint")
    return sessions.select(
        *SESSION, F.coalesce("a.total_files", none).alias("files"), F.coalesce("a.total_bytes", none).alias("bytes")
    )


def session_progress(events: DataFrame) -> DataFrame:
    """Files done and in all, bytes done and in all, percent: per prepared session, idle ones included."""
    sent = (
        latest_per_file(events)
        .groupBy(*SESSION)
        .agg(
            F.count_if(F.col("current_bytes") == F.col("total_bytes")).alias("files_done"),
            F.sum("current_bytes").alias("bytes_done"),
        )
    )
    joined = prepared_sessions(events).join(sent, SESSION, "left").na.fill(0, ["files_done", "bytes_done"])
    return _with_percent(joined.select(*SESSION, "files_done", "files", "bytes_done", "bytes"))


def load_progress(events: DataFrame) -> DataFrame:
    """The same totals for a whole load."""
    sums = [F.sum(c).alias(c) for c in ("files_done", "files", "bytes_done", "bytes")]
    return _with_percent(session_progress(events).groupBy("load_id").agg(*sums))


def _with_percent(sums: DataFrame) -> DataFrame:
    return sums.withColumn("percent", percent(F.col("bytes_done"), F.col("bytes")))


def percent(done: Column, size: Column) -> Column:
    """Whole percent, rounded down; an empty size is complete."""
    # Decimal, so that 100 times a byte count cannot overflow; div, so that nothing is rounded up.
    share = F.call_function("div", done.cast("decimal(20,0)") * F.lit(100), size.cast("decimal(20,0)"))
    return F.when(size == 0, F.lit(100)).otherwise(share).cast("bigint")


def mb_per_second(size: Column, seconds: Column) -> Column:
    """Whole MB/s, cut off toward zero."""
    return (size.cast("double") / seconds.cast("double") / F.lit(float(BYTES_PER_MB))).cast("bigint")


def rates(events: DataFrame, bin_seconds: int = 3600) -> DataFrame:
    """Transfer rate per time bin: of the bin, average since the start, peak of the average so far.

    A file's bytes in a bin are its newest count there less its newest count before. Only prepared sessions count.
    The windows run over the bins of a load in one task each: as many rows as the load's time has bins.
    """
    bin_no = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / F.lit(bin_seconds)).alias("bin")
    per_file = latest_per_file(events.withColumn("bin", bin_no), F.col("bin"))
    per_file = per_file.join(session_pairs(events), SESSION, "left_semi")
    earlier = F.lag("current_bytes", 1, 0).over(Window.partitionBy(*FILE).orderBy("bin"))
    per_bin = (
        per_file.withColumn("delta", F.col("current_bytes") - earlier)
        .groupBy("load_id", "bin")
        .agg(F.sum("delta").alias("delta_bytes"))
    )
    so_far = Window.partitionBy("load_id").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    running = per_bin.select(
        "load_id",
        "bin",
        "delta_bytes",
        F.sum("delta_bytes").over(so_far).alias("total_bytes"),
        ((F.col("bin") - F.min("bin").over(so_far) + F.lit(1)) * F.lit(bin_seconds)).alias("elapsed"),
    )
    rated = running.withColumn("rate_mb", mb_per_second(F.col("delta_bytes"), F.lit(bin_seconds))).withColumn(
        "average_mb", mb_per_second(F.col("total_bytes"), F.col("elapsed"))
    )
    # The peak starts at zero, as a running maximum of rates does.
    return rated.withColumn("peak_mb", F.greatest(F.max("average_mb").over(so_far), F.lit(0)).cast("bigint"))
