"""Streams whose state ends: windows, sessions, joins and keys that fall silent."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import encode_envelope
from millrace.registry.base import query, table
from millrace.streaming import (
    Windows,
    all_windows,
    first_within,
    join_within,
    late_rows,
    latest_until_idle,
    read_envelopes,
    stream_decode,
    window_available,
    write_stream,
)
from millrace.workspace import fresh_path

# What arrives first: events of the month's first half but for one in ten, which
# come with the second half and are late where their day is closed by then.
_FIRST = "(event_id % 10 <> 7 AND ts < {} '2024-01-16')"
_FIRST_SQL = _FIRST.format("TIMESTAMP")

_HALVES_SQL = f"""
    halves AS (SELECT *, {_FIRST_SQL} AS early, date_trunc('day', ts) AS day FROM events),
    marks AS (SELECT date_trunc('milliseconds', max(ts) FILTER (WHERE early)) - INTERVAL 2 DAY AS between_them,
                     date_trunc('milliseconds', max(ts)) - INTERVAL 2 DAY AS at_the_end FROM halves)"""


def _daily() -> Windows:
    return Windows(
        time="ts",
        delay="2 days",
        length="1 day",
        keys=["event_type"],
        aggregates={
            "n": F.count(F.lit(1)),
            "users": F.sum("user_id"),
            "highest": F.max("value"),
        },
    )


def _ingested(spark, sf_dir, windows, first):
    """A month of events in two arrivals; where they were ingested to, and their schema."""
    events = table(spark, sf_dir, "events")
    source, root = fresh_path(spark, "arrivals"), fresh_path(spark, "windowed-events")
    for arrival in (events.where(first), events.where(~first)):
        encode_envelope(arrival).write.mode("append").text(source)
        window_available(spark, source, events.schema, root, windows)
    return root, events.schema


@query(
    "stream_windows",
    f"""WITH {_HALVES_SQL}
        SELECT day AS window_start, day + INTERVAL 1 DAY AS window_end, event_type,
               count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users, max(value) AS highest,
               day + INTERVAL 1 DAY <= any_value(at_the_end) AS closed
        FROM halves, marks WHERE early OR day + INTERVAL 1 DAY > between_them
        GROUP BY day, event_type""",
)
def stream_windows(spark, sf_dir):
    """Daily windows, closed and open, without the rows that came too late for theirs."""
    root, schema = _ingested(spark, sf_dir, _daily(), F.expr(_FIRST.format("TIMESTAMP_NTZ")))
    return all_windows(spark, root, schema, _daily())


@query(
    "stream_late_rows",
    f"""WITH {_HALVES_SQL}
        SELECT event_id, ts, event_type, day AS window_start, day + INTERVAL 1 DAY AS window_end
        FROM halves, marks WHERE NOT early AND day + INTERVAL 1 DAY <= between_them""",
)
def stream_late_rows(spark, sf_dir):
    """The events that daily windows no longer took."""
    root, schema = _ingested(spark, sf_dir, _daily(), F.expr(_FIRST.format("TIMESTAMP_NTZ")))
    found = late_rows(spark, root, schema, _daily())
    return found.select("event_id", "ts", "event_type", "window_start", "window_end")


_STRETCHES_SQL = """
    stretches AS (
        SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS stretch
        FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                             < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS starts FROM events))"""


def _sessions() -> Windows:
    return Windows(
        time="ts",
        delay="1 day",
        gap="6 hours",
        keys=["user_id"],
        aggregates={"n": F.count(F.lit(1)), "last_event": F.max_by("event_id", F.struct("ts", "event_id"))},
    )


@query(
    "stream_sessions",
    f"""WITH {_STRETCHES_SQL}
        SELECT min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end, user_id, count(*) AS n,
               max_by(event_id, (ts, event_id)) AS last_event,
               max(ts) + INTERVAL 6 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY
                                             FROM events) AS closed
        FROM stretches GROUP BY user_id, stretch""",
)
def stream_sessions(spark, sf_dir):
    """Sessions of every user across two arrivals, one after the other in time."""
    first = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    root, schema = _ingested(spark, sf_dir, _sessions(), first)
    return all_windows(spark, root, schema, _sessions())


def _heartbeat(events, key):
    """An event of no user, far ahead in time, that lets everything before it settle."""
    return events.limit(1).withColumns(
        {
            "user_id": F.lit(key).cast("bigint"),
            "ts": F.lit("2025-01-01").cast("timestamp_ntz"),
        }
    )


def _arrivals(spark, rows, first, key):
    """Folder of envelopes, to which each call of the function adds the next arrival."""
    source = fresh_path(spark, "arrivals")
    parts = iter([rows.where(first), rows.where(~first), _heartbeat(rows, key)])
    return source, lambda: encode_envelope(next(parts)).write.mode("append").text(source)


def _after_three_arrivals(spark, sources, result, schema):
    """What a stream over the sources has written after three arrivals, with one start for each."""
    path, progress = fresh_path(spark, "emitted"), fresh_path(spark, "emitted-progress")
    for _ in range(3):
        for _, arrive in sources:
            arrive()
        streams = [stream_decode(read_envelopes(spark, source), schema) for source, _ in sources]
        rows = result(*streams)
        write_stream(rows, path, progress).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path).where("user_id >= 0")


@query(
    "stream_latest_until_idle",
    f"""WITH {_STRETCHES_SQL}
        SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, max(ts) AS ts,
               max_by(event_type, (ts, event_id)) AS event_type, max_by(value, (ts, event_id)) AS value,
               max_by(props, (ts, event_id)) AS props, min(ts) AS first_seen, count(*) AS n_rows
        FROM stretches GROUP BY user_id, stretch""",
)
def stream_latest_until_idle(spark, sf_dir):
    """The last event of every stretch in which a user was active."""
    events = table(spark, sf_dir, "events")
    first = F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")
    return _after_three_arrivals(
        spark,
        [_arrivals(spark, events, first, -1)],
        lambda rows: latest_until_idle(rows, ["user_id"], "ts", ["ts", "event_id"], "6 hours", "1 day"),
        events.schema,
    )


@query("stream_first_within", "SELECT DISTINCT user_id, event_type FROM events")
def stream_first_within(spark, sf_dir):
    """Every user's kinds of event, each emitted once in a month."""
    events = table(spark, sf_dir, "events")
    return _after_three_arrivals(
        spark,
        [_arrivals(spark, events, F.col("event_id") % 3 == 0, -1)],
        lambda rows: first_within(rows, ["user_id", "event_type"], "ts", "40 days").select(
            "user_id", "event_type"
        ),
        events.schema,
    )


def _pairs_sql(how: str) -> str:
    return f"""
        SELECT coalesce(l.user_id, r.user_id) AS user_id, l.event_id AS view_id, l.ts AS viewed,
               r.event_id AS click_id, r.ts AS clicked
        FROM (SELECT * FROM events WHERE event_type = 'view') AS l
        {how} JOIN (SELECT * FROM events WHERE event_type = 'click') AS r
        ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL 10 MINUTE AND l.ts + INTERVAL 2 HOUR"""


def _views_and_clicks(spark, sf_dir, how):
    events = table(spark, sf_dir, "events")
    first = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    kinds = [events.where(F.col("event_type") == kind) for kind in ("view", "click")]

    def pair(views, clicks):
        return join_within(
            views.select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("viewed")),
            clicks.select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("clicked")),
            ["user_id"],
            "viewed",
            "clicked",
            "-10 minutes",
            "2 hours",
            "1 hour",
            "1 hour",
            how,
        )

    sources = [_arrivals(spark, rows, first, -1 - i) for i, rows in enumerate(kinds)]
    return _after_three_arrivals(spark, sources, pair, events.schema)


@query("stream_join_within", _pairs_sql("INNER"))
def stream_join_within(spark, sf_dir):
    """Views with the clicks of the same user from ten minutes before to two hours after."""
    return _views_and_clicks(spark, sf_dir, "inner")


@query("stream_join_within_outer", _pairs_sql("FULL"))
def stream_join_within_outer(spark, sf_dir):
    """The same pairs, and the views and clicks that are in none, once they have expired."""
    return _views_and_clicks(spark, sf_dir, "full")
