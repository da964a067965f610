"""Queries that run as streams over the whole journal, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrolith.sources.tables import table
from agrolith.streaming import journal

KEYS = ["user_id", "k"]


def q_stream_event_windows(spark, d):
    out = journal.run_once(journal.windowed_totals(journal.event_stream(spark, d)), "event_windows")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "calls", F.col("total").cast("double").alias("total"))


def q_stream_open_reservations(spark, d):
    """The last balance of each user, of those that the batches gave out."""
    out = journal.run_once(journal.open_reservations(journal.event_stream(spark, d)), "open_reservations", "update")
    return out.groupBy("user_id").agg(*[F.max_by(c, "batch").alias(c) for c in ("opened", "settled", "open")])


def _keyed(events):
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def q_reservation_states(spark, d):
    return journal.reservation_states(_keyed(table(spark, d, "events")), KEYS)


def q_stream_reservation_states(spark, d):
    """The same states as a stream over the journal."""
    return journal.run_once(journal.reservation_states(_keyed(journal.event_stream(spark, d)), KEYS), "reservation_states")


_STATES = """WITH e AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type, ts FROM events WHERE event_type IN ('signup', 'purchase', 'error')),
  g AS (SELECT user_id, k, count(*) FILTER (WHERE event_type = 'signup') AS r, count(*) FILTER (WHERE event_type = 'purchase') AS s, count(*) FILTER (WHERE event_type = 'error') AS x,
    min(ts) FILTER (WHERE event_type = 'signup') AS r1, min(ts) FILTER (WHERE event_type <> 'signup') AS x1 FROM e GROUP BY ALL)
  SELECT user_id, k, CASE WHEN r = 0 THEN 'never reserved' WHEN r > 1 THEN 'reserved twice' WHEN s + x > 1 THEN 'resolved twice' WHEN x1 < r1 THEN 'resolved early' WHEN s = 1 THEN 'settled' WHEN x = 1 THEN 'released' ELSE 'open' END AS state FROM g"""
ORACLES = {
    "stream_event_windows": "SELECT date_trunc('day', ts)::timestamp AS start, event_type, count(*) AS calls, sum(value::decimal(18,4))::double AS total FROM events GROUP BY ALL",
    "stream_open_reservations": "SELECT user_id, count(*) FILTER (WHERE event_type = 'signup') AS opened, count(*) FILTER (WHERE event_type = 'purchase') AS settled, greatest(0, count(*) FILTER (WHERE event_type = 'signup') - count(*) FILTER (WHERE event_type = 'purchase')) AS open FROM events WHERE event_type IN ('signup', 'purchase') GROUP BY user_id",
    "reservation_states": _STATES,
    "stream_reservation_states": _STATES,
}
QUERIES = {name.removeprefix("q_"): f for name, f in list(globals().items()) if name.startswith("q_")}
