"""Session windows: boundaries, batch against stream, late and malformed events, statistics."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import session_stats, session_stats_by_host, sessionize
from tallyframe.sources import decode_events
from tallyframe.streaming import sessions_to_files
from tallyframe.streaming.sessions import STREAM_SETTINGS

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ip string, host string, ts timestamp"


def at(**delta):
    return T0 + dt.timedelta(**delta)


def sessions_of(spark, times, kind="timestamp_ntz"):
    df = spark.createDataFrame([("i", "h", t) for t in times], f"ip string, host string, ts {kind}")
    out = sessionize(df, "ts", ["ip", "host"])
    return sorted((r.session_start, r.session_end, r.event_count) for r in out.collect())


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_an_event_one_gap_later_belongs_to_the_session(spark, kind):
    gap, more = at(minutes=5), at(minutes=10, microseconds=1)
    assert sessions_of(spark, [T0, gap, more, None], kind) == [
        (T0, at(minutes=10), 2), (more, at(minutes=15, microseconds=1), 1)
    ]


def test_batch_equals_plain_session_windows(spark):
    """Counting per slot first changes nothing, at boundaries and with microseconds."""
    rng = random.Random(3)
    times = [at(microseconds=rng.randrange(10**11)) for _ in range(600)]
    times += [at(seconds=300 * rng.randrange(300)) for _ in range(200)]
    data = [(rng.choice("ab"), rng.choice("xyz"), t) for t in times]
    df = spark.createDataFrame(data, "ip string, host string, ts timestamp_ntz")
    plain = (
        df.groupBy(F.session_window("ts", "5 minutes").alias("w"), "ip", "host")
        .count().select("w.start", "w.end", "ip", "host", "count")
    )
    got = sessionize(df, "ts", ["ip", "host"])
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in plain.collect())


def test_daylight_saving_does_not_join_wall_clock_times(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist there on this day, but an NTZ column holds wall-clock times.
        times = [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 3, 30)]
        assert [n for _, _, n in sessions_of(spark, times)] == [1, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def write_batch(spark, folder, rows):
    """One JSON file per batch, in the order of their names."""
    os.makedirs(folder, exist_ok=True)
    name = os.path.join(folder, f"{len(os.listdir(folder)):03}.json")
    with open(name, "w") as out:
        for ip, host, ts in rows:
            stamp = ts if isinstance(ts, str) else ts.strftime("%Y-%m-%dT%H:%M:%S.000Z")
            out.write(json.dumps({"ip": ip, "host": host, "event_time": stamp}) + "\n")


def stream(spark, folder):
    lines = (
        spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(folder)
    )
    return decode_events(lines)


def run(spark, tmp_path, batches):
    folder = str(tmp_path / "in")
    for i, batch in enumerate(batches):
        write_batch(spark, folder, batch)
        os.utime(f"{folder}/{i:03}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    job = sessions_to_files(
        stream(spark, folder), "window_timestamp", ["ip", "host"],
        str(tmp_path / "out"), str(tmp_path / "check"),
    )
    job.awaitTermination()
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in job.recentProgress for op in p["stateOperators"]
    )
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    return sorted((r.session_start, r.ip, r.event_count) for r in rows), dropped


def test_stream_emits_closed_sessions_once(spark, tmp_path):
    batches = [
        [("i", "h", T0), ("i", "h", at(minutes=4))],
        [("i", "h", at(minutes=8)), ("j", "h", at(minutes=8))],
        [("i", "h", at(hours=1))],
    ]
    rows, dropped = run(spark, tmp_path, batches)
    assert rows == [(T0, "i", 3), (at(minutes=8), "j", 1)]
    assert dropped == 0


def test_stream_settings_do_not_stay_in_the_session(spark, tmp_path):
    before = {name: spark.conf.get(name, None) for name in STREAM_SETTINGS}
    rows, _ = run(spark, tmp_path, [[("i", "h", T0)], [("i", "h", at(hours=1))]])
    assert rows == [(T0, "i", 1)]
    assert {name: spark.conf.get(name, None) for name in STREAM_SETTINGS} == before
    state = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "check" / "state") for f in fs]
    assert any(name.endswith(".zip") or name.endswith(".changelog") for name in state)


def test_stream_drops_late_and_malformed_events(spark, tmp_path):
    batches = [
        [("i", "h", T0), ("i", "h", "yesterday"), ("i", "h", "2024-01-01 00:01:00")],
        [("i", "h", at(hours=1))],
        [("i", "h", at(hours=1, minutes=1))],
        [("i", "h", at(minutes=2))],
        [("i", "h", at(hours=3))],
        [("i", "h", at(hours=5))],
    ]
    rows, dropped = run(spark, tmp_path, batches)
    assert rows == [(T0, "i", 1), (at(hours=1), "i", 2), (at(hours=3), "i", 1)]
    assert dropped >= 1


def test_complete_stream_equals_batch(spark, tmp_path):
    rng = random.Random(5)
    rows = [
        (rng.choice("ab"), rng.choice("xy"), at(seconds=rng.randrange(40_000)))
        for _ in range(300)
    ]
    folder = str(tmp_path / "in")
    write_batch(spark, folder, rows)
    query = (
        sessionize(stream(spark, folder), "window_timestamp", ["ip", "host"])
        .writeStream.format("memory").queryName("all_sessions").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = sessionize(spark.createDataFrame(rows, SCHEMA), "ts", ["ip", "host"])
    got = sorted(tuple(r) for r in spark.table("all_sessions").collect())
    assert got == sorted(tuple(r) for r in batch.collect())


def test_stats(spark):
    sessions = spark.createDataFrame(
        [("a.example.org", 1), ("a.example.org", 2), ("b.example.org", 5), ("c.net", 9)],
        "host string, event_count long",
    )
    average = session_stats(sessions, "host", "%.example.org").first()[0]
    assert str(average) == "2.67"
    by_host = session_stats_by_host(sessions, "host", ["c.net", "a.example.org", "none"])
    assert [(r[0], str(r[1]), r[2]) for r in by_host.collect()] == [
        ("a.example.org", "1.50", 2), ("c.net", "9.00", 1)
    ]
