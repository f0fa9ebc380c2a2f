from datetime import datetime, timedelta
import random

import pytest

from helpers import plan
from ringlake.operators.trailing import attach_counts, trailing_counts

START = datetime(2024, 1, 1)


def _brute_force(rows, seconds):
    span = timedelta(seconds=seconds)
    counts = {}
    for key, at in rows:
        if at is None:
            counts[key, at] = sum(1 for k, t in rows if k == key and t is None)
        else:
            counts[key, at] = sum(1 for k, t in rows if k == key and t is not None and at - span <= t <= at)
    return counts


def _count(spark, rows, seconds, kind="timestamp"):
    df = spark.createDataFrame(rows, "k string, at timestamp").selectExpr("k", f"cast(at as {kind}) at")
    counts = trailing_counts(df, ["k"], "at", seconds, "n")
    return df, counts


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("seconds", [1, 90, 3600, 86400])
def test_matches_brute_force(spark, kind, seconds):
    draw = random.Random(seconds)
    # One key holds most rows and a third of all rows share one instant.
    rows = [("hot", START + timedelta(microseconds=draw.choice([0, 1, 10**6]) + 10**6 * draw.randrange(9000))) for _ in range(200)]
    rows += [("hot", START + timedelta(hours=1))] * 150
    rows += [(draw.choice(["a", None]), START + timedelta(seconds=draw.randrange(200000))) for _ in range(60)]
    rows += [("a", None)] * 3 + [(None, None)]
    df, counts = _count(spark, rows, seconds, kind)
    found = {(r.k, r.at): r.n for r in counts.collect()}
    assert found == _brute_force(rows, seconds)
    attached = attach_counts(df, counts, ["k"], "at", "n").collect()
    assert len(attached) == len(rows)
    assert all(r.n == found[r.k, r.at] for r in attached)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("day", [datetime(2024, 3, 10), datetime(2024, 11, 3)])
def test_clock_changes_of_the_session_zone(spark, kind, day):
    """Expected counts come from seconds that know no zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        seconds = range(0, 6 * 3600, 17)
        start = f"timestamp_ntz'{day:%Y-%m-%d} 00:00:00'" if kind == "timestamp_ntz" else f"timestamp'{day:%Y-%m-%d} 00:00:00'"
        df = spark.createDataFrame([(s,) for s in seconds], "s long").selectExpr(
            "'a' AS k", "s", f"{start} + make_dt_interval(0, 0, 0, s) AS at"
        )
        counts = trailing_counts(df, ["k"], "at", 3600, "n")
        got = {r.s: r.n for r in attach_counts(df, counts, ["k"], "at", "n").select("s", "n").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {s: sum(1 for t in seconds if s - 3600 <= t <= s) for s in seconds}


def test_edges_are_exact(spark):
    first = START + timedelta(minutes=59, seconds=59, microseconds=999999)
    rows = [("a", first), ("a", first + timedelta(hours=1)), ("b", first), ("b", first + timedelta(hours=1, microseconds=1))]
    _, counts = _count(spark, rows, 3600)
    assert sorted((r.k, r.n) for r in counts.collect()) == [("a", 1), ("a", 2), ("b", 1), ("b", 1)]


def test_no_window_over_a_whole_key_of_rows(spark):
    """Row-level windows are partitioned by slice; the per-key window reads slice totals."""
    _, counts = _count(spark, [("a", START)], 3600)
    windows = [line for line in plan(counts).splitlines() if "Window [" in line]
    assert len(windows) == 2
    assert sum("slice" in line.split("], [")[1] for line in windows) >= 1
    assert "SinglePartition" not in plan(counts)
