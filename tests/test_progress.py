import datetime as dt

import pytest

from keyedload.operators import progress

T0 = dt.datetime(2024, 1, 1)
MB = progress.BYTES_PER_MB


def ev(minute, kind, peer="p1", session=0, success=None, file=None, done=None, size=None, files=None):
    return ("L", T0 + dt.timedelta(minutes=minute), kind, peer, session, success, file, done, size, files)


SCHEMA = "load_id string, ts timestamp_ntz, kind string, peer string, session int, success boolean, file string, current_bytes bigint, total_bytes bigint, total_files bigint"


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [
            ev(0, "prepared", size=7200 * MB, files=10),
            ev(0, "prepared", session=1, size=1, files=1),
            ev(1, "prepared", session=1, size=14400 * MB, files=1),
            ev(1, "prepared", peer="p2", size=0, files=1),
            # Never reports, and never prepared.
            ev(1, "prepared", peer="idle", size=3600 * MB, files=4),
            ev(7, "progress", peer="stranger", file="a", done=50 * MB, size=50 * MB),
            ev(2, "progress", file="a", done=100 * MB, size=3600 * MB),
            ev(3, "progress", file="a", done=1800 * MB, size=3600 * MB),
            ev(61, "progress", file="a", done=3600 * MB, size=3600 * MB),
            ev(5, "progress", peer="p2", file="a", done=0, size=0),
            ev(200, "progress", session=1, file="b", done=7200 * MB, size=14400 * MB),
            ev(6, "other", file="a", done=9 * MB, size=9 * MB),
            ev(300, "complete", success=True),
            ev(300, "complete", session=1, success=False),
            ev(300, "complete", peer="p2", success=False),
        ],
        SCHEMA,
    )


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_sessions(events):
    assert rows(progress.session_pairs(events), "peer", "session") == [("idle", 0), ("p1", 0), ("p1", 1), ("p2", 0)]
    assert rows(progress.sessions_per_peer(events), "peer", "sessions") == [("idle", 1), ("p1", 2), ("p2", 1)]
    assert rows(progress.session_outcomes(events), "peer", "completed", "failed") == [("p1", 1, 1), ("p2", 0, 1)]


def test_newest_state_and_totals(events):
    assert rows(progress.latest_per_file(events), "peer", "session", "file", "current_bytes") == [
        ("p1", 0, "a", 3600 * MB),
        ("p1", 1, "b", 7200 * MB),
        ("p2", 0, "a", 0),
        ("stranger", 0, "a", 50 * MB),
    ]
    got = rows(progress.session_progress(events), "peer", "session", "files_done", "files", "percent")
    assert got == [("idle", 0, 0, 4, 0), ("p1", 0, 1, 10, 50), ("p1", 1, 0, 1, 50), ("p2", 0, 1, 1, 100)]
    assert rows(progress.load_progress(events), "files_done", "files", "percent") == [(2, 16, 42)]


def test_percent_is_cut_not_rounded(spark):
    df = spark.createDataFrame([(10**17 - 1, 10**17), (0, 5), (5, 0), (2, 3)], "d bigint, s bigint")
    assert [r[0] for r in df.select(progress.percent(df.d, df.s)).collect()] == [99, 0, 100, 66]


def test_rates(events):
    got = progress.rates(events).orderBy("bin").collect()
    first = got[0].bin
    assert [(r.bin - first, r.delta_bytes // MB, r.rate_mb, r.total_bytes // MB, r.elapsed, r.average_mb, r.peak_mb) for r in got] == [
        (0, 1800, 0, 1800, 3600, 0, 0),
        (1, 1800, 0, 3600, 7200, 0, 0),
        (3, 7200, 2, 10800, 14400, 0, 0),
    ]
    by_minute = progress.rates(events, 60).orderBy("bin").collect()
    assert [(r.delta_bytes // MB, r.rate_mb, r.average_mb, r.peak_mb) for r in by_minute] == [
        (100, 1, 1, 1),
        (1700, 28, 15, 15),
        (0, 0, 7, 15),
        (1800, 30, 1, 15),
        (7200, 120, 0, 15),
    ]


def test_rates_shrink_events_before_any_window(events):
    plan = progress.rates(events)._jdf.queryExecution().executedPlan().toString()
    # The aggregate lies below (printed after) the lowest window.
    assert plan.rindex("Window [") < plan.rindex("partial_max")
