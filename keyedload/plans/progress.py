"""Queries for load progress. The events table stands in for a stream of progress events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedload.operators import progress
from keyedload.plans.registry import DAY, query, source

# A file of a session is 1 to 30 days long at one byte per microsecond; an event reports how far it
# has come by then. The derivation is row by row:
#   view -> prepared, signup -> complete, error -> failed, click -> progress, purchase -> unknown.
# A prepared session announces its five files and their bytes together; every fiftieth peer announces nothing to send.
START_SECONDS = 1_704_067_200  # 2024-01-01T00:00:00Z, the first day of the events

EVENTS_SQL = f"""SELECT 'L' AS load_id, ts, event_type, CAST(user_id AS VARCHAR) AS peer,
        CAST(event_id % 3 AS INTEGER) AS session, 'f' || CAST(event_id // 3 % 5 AS VARCHAR) AS file,
        least(epoch_us(ts) - {START_SECONDS * 1_000_000},
              (1 + (user_id * 5 + event_id % 15) % 30) * {DAY * 1_000_000}) AS current_bytes,
        (1 + (user_id * 5 + event_id % 15) % 30) * {DAY * 1_000_000} AS total_bytes,
        CASE WHEN user_id % 50 = 0 THEN 0 ELSE 5 END AS session_files,
        CASE WHEN user_id % 50 = 0 THEN 0 ELSE ({" + ".join(f"1 + (user_id * 5 + event_id % 3 + {3 * f}) % 30" for f in range(5))})
             * {DAY * 1_000_000} END AS session_bytes FROM events"""

LATEST_SQL = f"""SELECT load_id, peer, session, file, arg_max(current_bytes, ts) AS current_bytes,
        arg_max(total_bytes, ts) AS total_bytes FROM ({EVENTS_SQL}) WHERE event_type = 'click'
        GROUP BY load_id, peer, session, file"""

# Prepared sessions, each with what it announced and what its files have sent.
SESSIONS_SQL = f"""SELECT p.load_id, p.peer, p.session, files, bytes, coalesce(files_done, 0) AS files_done,
        coalesce(bytes_done, 0) AS bytes_done
        FROM (SELECT load_id, peer, session, any_value(session_files) AS files, any_value(session_bytes) AS bytes
              FROM ({EVENTS_SQL}) WHERE event_type = 'view' GROUP BY load_id, peer, session) p
        LEFT JOIN (SELECT load_id, peer, session, count(*) FILTER (current_bytes = total_bytes) AS files_done,
                          sum(current_bytes) AS bytes_done
                   FROM ({LATEST_SQL}) GROUP BY load_id, peer, session) f USING (load_id, peer, session)"""


def progress_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind: Column = F.lit("other")
    for event_type, name in {
        "view": progress.PREPARED,
        "signup": progress.COMPLETE,
        "error": progress.COMPLETE,
        "click": progress.PROGRESS,
    }.items():
        kind = F.when(F.col("event_type") == event_type, name).otherwise(kind)
    at = F.unix_micros(F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))

    def size(number: Column) -> Column:
        return (F.lit(1) + (F.col("user_id") * 5 + number) % 30) * F.lit(DAY * 1_000_000)

    total = size(F.col("event_id") % 15)
    session_total = sum((size(F.col("event_id") % 3 + 3 * f) for f in range(5)), F.lit(0))
    silent = F.col("user_id") % 50 == 0
    prepared = F.col("event_type") == "view"
    return source(spark, sf_dir, "events").select(
        F.lit("L").alias("load_id"),
        F.col("ts"),
        kind.alias("kind"),
        F.col("user_id").cast("string").alias("peer"),
        (F.col("event_id") % 3).cast("int").alias("session"),
        (F.col("event_type") == "signup").alias("success"),
        F.concat(F.lit("f"), F.expr("event_id div 3 % 5").cast("string")).alias("file"),
        F.least(at - F.lit(START_SECONDS * 1_000_000), total).alias("current_bytes"),
        F.when(~prepared, total).when(silent, 0).otherwise(session_total).cast("bigint").alias("total_bytes"),
        F.when(prepared, F.when(silent, 0).otherwise(5)).cast("bigint").alias("total_files"),
    )


@query(
    "session_pairs",
    f"SELECT DISTINCT load_id, peer, session FROM ({EVENTS_SQL}) WHERE event_type = 'view'",
)
def session_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.session_pairs(progress_events(spark, sf_dir))


@query(
    "sessions_per_peer",
    f"""SELECT load_id, peer, count(DISTINCT session) AS sessions FROM ({EVENTS_SQL}) WHERE event_type = 'view'
        GROUP BY load_id, peer""",
)
def sessions_per_peer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.sessions_per_peer(progress_events(spark, sf_dir))


@query(
    "session_outcomes",
    f"""SELECT load_id, peer, count(*) FILTER (event_type = 'signup') AS completed,
               count(*) FILTER (event_type = 'error') AS failed
        FROM ({EVENTS_SQL}) WHERE event_type IN ('signup', 'error') GROUP BY load_id, peer""",
)
def session_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.session_outcomes(progress_events(spark, sf_dir))


@query("progress_latest", LATEST_SQL)
def progress_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.latest_per_file(progress_events(spark, sf_dir))


@query("progress_files", f"SELECT load_id, peer, session, files_done, CAST(files AS BIGINT) AS files FROM ({SESSIONS_SQL})")
def progress_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.session_progress(progress_events(spark, sf_dir)).select(*progress.SESSION, "files_done", "files")


_PERCENT_SQL = """CAST(sum(bytes_done) AS BIGINT) AS bytes_done, CAST(sum(bytes) AS BIGINT) AS bytes,
    CAST(CASE WHEN sum(bytes) = 0 THEN 100 ELSE sum(bytes_done) * 100 // sum(bytes) END AS BIGINT) AS percent"""


@query(
    "progress_percent",
    f"SELECT load_id, peer, session, {_PERCENT_SQL} FROM ({SESSIONS_SQL}) GROUP BY load_id, peer, session",
)
def progress_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = progress.session_progress(progress_events(spark, sf_dir))
    return done.select(*progress.SESSION, "bytes_done", "bytes", "percent")


@query(
    "progress_total",
    f"""SELECT load_id, CAST(sum(files_done) AS BIGINT) AS files_done, CAST(sum(files) AS BIGINT) AS files, {_PERCENT_SQL}
        FROM ({SESSIONS_SQL}) GROUP BY load_id""",
)
def progress_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.load_progress(progress_events(spark, sf_dir))


# Per hour: what all files have sent by its end, less what they had sent before.
RATES_SQL = f"""per_file AS (SELECT peer, session, file, epoch_us(ts) // 3600000000 AS bin,
        arg_max(current_bytes, ts) AS sent FROM ({EVENTS_SQL}) WHERE event_type = 'click'
        AND (peer, session) IN (SELECT (peer, session) FROM ({EVENTS_SQL}) WHERE event_type = 'view') GROUP BY ALL),
    steps AS (SELECT bin, sent - coalesce(lag(sent) OVER (PARTITION BY peer, session, file ORDER BY bin), 0) AS step
        FROM per_file),
    bins AS (SELECT bin, CAST(sum(step) AS BIGINT) AS delta_bytes FROM steps GROUP BY bin),
    running AS (SELECT bin, delta_bytes, CAST(sum(delta_bytes) OVER (ORDER BY bin) AS BIGINT) AS total_bytes,
        (bin - min(bin) OVER () + 1) * 3600 AS elapsed FROM bins),
    rated AS (SELECT *, CAST(trunc(delta_bytes / 3600.0::DOUBLE / 1048576.0::DOUBLE) AS BIGINT) AS rate_mb,
        CAST(trunc(total_bytes::DOUBLE / elapsed::DOUBLE / 1048576.0::DOUBLE) AS BIGINT) AS average_mb FROM running)"""


@query("progress_rate", f"WITH {RATES_SQL} SELECT 'L' AS load_id, bin, delta_bytes, rate_mb FROM rated")
def progress_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.rates(progress_events(spark, sf_dir)).select("load_id", "bin", "delta_bytes", "rate_mb")


@query("progress_avg_rate", f"WITH {RATES_SQL} SELECT 'L' AS load_id, bin, total_bytes, elapsed, average_mb FROM rated")
def progress_avg_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.rates(progress_events(spark, sf_dir)).select("load_id", "bin", "total_bytes", "elapsed", "average_mb")


@query(
    "progress_peak_rate",
    f"WITH {RATES_SQL} SELECT 'L' AS load_id, bin, greatest(max(average_mb) OVER (ORDER BY bin), 0) AS peak_mb FROM rated",
)
def progress_peak_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.rates(progress_events(spark, sf_dir)).select("load_id", "bin", "peak_mb")
