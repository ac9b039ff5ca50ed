import datetime as dt

import pytest

from stratamart.streaming import event_state, incremental

SCHEMA = "id string, at timestamp_ntz, came timestamp_ntz, n int, _known_key string"
START = dt.datetime(2024, 1, 1)


def day(n):
    return None if n is None else START + dt.timedelta(days=n)


@pytest.fixture
def feed(spark, tmp_path):
    """Deliver rows ``(id, event day, arrival day, number)`` and process them."""
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def run(*rows, horizon="2 days", arrived="came"):
        data = [(i, day(at), day(came), n, "x") for i, at, came, n in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.read_growing(spark, source, spark.read.parquet(source).schema)
        return event_state.first_deliveries(stream, target, checkpoint, "id", "at", arrived, horizon)

    run.target, run.checkpoint, run.source = target, checkpoint, tmp_path
    return run


def test_repeats_late_and_early_events_are_kept_once(spark, feed, rows):
    feed(("a", 0, 1, 1), ("a", 0, 1, 1), ("b", 1, 1, 1), ("soon", 5, 1, 1), (None, 1, 1, 1), ("t", None, 1, 1))
    report = feed(("a", 0, 1.5, 2), ("c", 1.2, 1.5, 2), ("old", -9, 1.5, 2), ("old", -9, 1.5, 2), (None, 1, 1.5, 2),
                  ("t", None, 1.5, 2), ("soon", 5, 1.5, 2))
    assert report.repeats == 1
    # Sent again far beyond the horizon, on the day it names, with another time, and with an older arrival.
    feed(("a", 0, 9, 3), ("old", -9, 9, 3), ("b", 1, 9, 3), ("d", 8.5, 9, 3), ("soon", 5, 6, 3), ("b", 8.8, 9, 3))
    feed(("soon", 5, 5.5, 4), ("e", 8, 8.5, 4), ("d", 8.5, 9, 4))
    stored = event_state.read_events(spark, feed.target)
    assert rows(stored, "id", "at", "n") == sorted(
        [("a", day(0), 1), ("b", day(1), 1), ("b", day(8.8), 3), ("c", day(1.2), 2), ("d", day(8.5), 3), ("e", day(8), 4),
         ("old", day(-9), 2), ("soon", day(5), 1), ("t", None, 1)], key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows(event_state.read_unkeyed(spark, feed.target), "n") == [(1,), (2,)]
    assert set(stored.columns) == {"id", "at", "came", "n", "_known_key", event_state.ARRIVED}


def test_state_is_bounded(feed, spark):
    sizes = [feed(*((f"e{d}-{i}", d, d, d) for i in range(20))).state_rows for d in range(7)]
    # Two horizons of two days, 20 events a day; the table grows to 140.
    assert max(sizes) <= 100 and sizes[-1] <= sizes[-2]
    assert event_state.read_events(spark, feed.target).count() == 140


def test_replayed_runs_add_nothing(feed, spark):
    first = [("a", 0, 1, 1), ("b", 1, 1, 1), ("old", -9, 1, 1), ("soon", 3, 1, 1)]
    feed(*first)
    for folder in ("ck", "ck-state"):
        for name in ("0", ".0.crc"):
            (feed.source / folder / "commits" / name).unlink()
    feed(*((i, at, 2, 2) for i, at, _, _ in first))
    stored = event_state.read_events(spark, feed.target).collect()
    assert sorted((r["id"], r["n"]) for r in stored) == [("a", 1), ("b", 1), ("old", 1), ("soon", 1)]


def test_clock_of_the_batch_and_a_hot_event(feed, spark):
    feed(*(("hot", 0, 1, 1) for _ in range(300)), *((f"x{i}", i, 1, 1) for i in range(100)), arrived=None)
    feed(*(("hot", 0, 1, 2) for _ in range(300)), arrived=None)
    stored = event_state.read_events(spark, feed.target)
    assert stored.count() == 101 and stored.where("n = 2").count() == 0


def test_empty_delivery(feed, spark):
    assert feed().state_rows == 0
    feed(("a", 0, 1, 1))
    assert event_state.read_events(spark, feed.target).count() == 1
