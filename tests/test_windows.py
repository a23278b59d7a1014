"""Streams whose state ends: windows, late rows, joins, silent keys."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import encode_envelope
from millrace.streaming import (
    Windows,
    all_windows,
    closed_windows,
    join_within,
    late_rows,
    latest_until_idle,
    open_windows,
    window_available,
    windows,
)

SCHEMA = T.StructType().add("id", T.IntegerType()).add("k", T.StringType()).add("at", T.TimestampNTZType())
START = datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


class Arrivals:
    def __init__(self, spark, tmp_path, spec):
        self.spark, self.spec = spark, spec
        self.source, self.root = str(tmp_path / "source"), str(tmp_path / "root")

    def arrive(self, *data):
        df = self.spark.createDataFrame([(i, k, at(m)) for i, k, m in data], SCHEMA)
        encode_envelope(df).coalesce(1).write.mode("append").text(self.source)

    def run(self):
        return window_available(self.spark, self.source, SCHEMA, self.root, self.spec)

    def found(self, function):
        rows = function(self.spark, self.root, SCHEMA, self.spec).collect()
        minutes = lambda t: t and round((t - START).total_seconds() / 60)
        return sorted(
            (tuple(minutes(v) if isinstance(v, datetime) else v for v in r) for r in rows), key=repr)


def tens(**more):
    given = dict(time="at", delay="5 minutes", length="10 minutes", keys=["k"], aggregates={"n": F.count(F.lit(1))})
    return Windows(**(given | more))


def test_windows_close_and_late_rows_are_kept_apart(spark, tmp_path):
    a = Arrivals(spark, tmp_path, tens())
    a.arrive((1, "x", 1), (2, "x", 8), (3, "y", 16))
    assert int(a.run()) == 1
    # Closed up to minute 11: a row of the first window is late, one of the second is not.
    assert a.found(closed_windows) == [(0, 10, "x", 2)]
    a.arrive((4, "x", 9), (5, "y", 12), (6, "y", 40), (7, "x", None))
    assert int(a.run()) == 2
    assert a.found(closed_windows) == [(0, 10, "x", 2), (10, 20, "y", 2)]
    assert a.found(open_windows) == [(40, 50, "y", 1)]
    late = late_rows(spark, a.root, SCHEMA, a.spec).collect()
    assert sorted((r["id"], r["window_start"] and r["window_start"].minute, int(r["_run"])) for r in late) == [
        (4, 0, 2), (7, None, 2)]
    assert a.run() is None
    assert a.found(all_windows) == [(0, 10, "x", 2, True), (10, 20, "y", 2, True), (40, 50, "y", 1, False)]


def test_overlapping_windows_report_every_window_missed(spark, tmp_path):
    a = Arrivals(spark, tmp_path, tens(slide="5 minutes"))
    a.arrive((1, "x", 26))
    a.run()
    # Closed up to minute 21: minute 13 misses (5, 15) and (10, 20).
    a.arrive((2, "x", 13), (3, "x", 14), (4, "x", 17))
    a.run()
    late = [r for r in a.found(late_rows) if r[0] == 2]
    assert [(r[3], r[4]) for r in late] == [(10, 20), (5, 15)]
    rows = {r[:2]: r[3] for r in a.found(all_windows)}
    assert rows == {(15, 25): 1, (20, 30): 1, (25, 35): 1}


def test_a_run_that_is_cut_short_is_finished_first(spark, tmp_path, monkeypatch):
    a = Arrivals(spark, tmp_path, tens())
    a.arrive((1, "x", 1), (2, "x", 30))
    with monkeypatch.context() as patch:
        patch.setattr(windows, "_finish", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            a.run()
    a.arrive((3, "x", 2))
    a.run()
    # Run 1 closed the first window before run 2 came, as without the failure.
    assert a.found(closed_windows) == [(0, 10, "x", 1)]
    assert [r[0] for r in a.found(late_rows)] == [3]


def test_sessions_across_runs(spark, tmp_path):
    spec = Windows(time="at", delay="1 minute", gap="10 minutes", keys=["k"],
                   aggregates={"n": F.count(F.lit(1)), "last": F.max("id")})
    a = Arrivals(spark, tmp_path, spec)
    a.arrive((1, "x", 0), (2, "x", 7), (3, "y", 9))
    a.run()
    a.arrive((4, "x", 12), (5, "y", 60), (6, "x", 49))
    a.run()
    assert a.found(closed_windows) == [(0, 22, "x", 3, 4), (49, 59, "x", 1, 6), (9, 19, "y", 1, 3)]
    assert a.found(open_windows) == [(60, 70, "y", 1, 5)]


def test_windows_are_either_fixed_or_sessions():
    with pytest.raises(ValueError, match="either"):
        tens(gap="1 minute")
    with pytest.raises(ValueError, match="keys"):
        tens(length=None, gap="1 minute", keys=[])


def test_zones_do_not_shift_times_without_one(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1, "x", datetime(2024, 3, 10, 2, 30))], SCHEMA)  # does not exist there
        row = tens(length="1 day").over(df).first()
        assert (row["window_start"], row["window_end"]) == (datetime(2024, 3, 10), datetime(2024, 3, 11))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_join_within_on_batches(spark):
    left = spark.createDataFrame([("a", 1, at(0)), ("a", 2, at(30)), (None, 3, at(0)), ("b", 4, None)], "k string, l int, t timestamp_ntz")
    right = spark.createDataFrame([("a", 1, at(10)), ("a", 2, at(11)), ("a", 3, at(-5)), ("c", 4, at(0))], "k string, r int, u timestamp_ntz")
    pairs = lambda how: sorted(
        ((r["l"], r["r"]) for r in join_within(left, right, ["k"], "t", "u", "-5 minutes", "10 minutes", "1 hour", "1 hour", how).collect()), key=repr)
    assert pairs("inner") == [(1, 1), (1, 3)]
    assert pairs("left") == [(1, 1), (1, 3), (2, None), (3, None)]
    assert pairs("full") == sorted([(1, 1), (1, 3), (2, None), (3, None), (None, 2), (None, 4)], key=repr)
    with pytest.raises(ValueError, match="how"):
        pairs("cross")
    with pytest.raises(ValueError, match="both sides"):
        join_within(left, right.withColumnRenamed("r", "l"), ["k"], "t", "u", "0 minutes", "1 minute", "1 hour", "1 hour")


def test_latest_until_idle_on_a_batch(spark):
    df = spark.createDataFrame([(1, "x", at(0)), (2, "x", at(5)), (3, "x", at(30)), (4, None, at(0)), (5, "y", None)], SCHEMA)
    rows = latest_until_idle(df, ["k"], "at", ["at", "id"], "10 minutes", "1 hour").collect()
    assert sorted(((r["id"], r["k"], r["n_rows"]) for r in rows), key=repr) == sorted([(2, "x", 2), (3, "x", 1), (4, None, 1)], key=repr)
