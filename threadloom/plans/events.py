"""Event-time queries, as batch and as streams, and plain relational shapes over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import ship, table
from ..streaming import events as st

Q: dict = {}


def query(name: str, sql: str | None):
    def add(fn):
        Q[name] = (fn, sql)
        return fn

    return add


def ev(s, d, *cols):
    return table(s, d, "events", *cols)


@query("tumbling_counts", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def tumbling_counts(s, d):
    g = ev(s, d, "ts", "event_type", "value").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


@query("sliding_counts", "SELECT w AS start, count(*) AS n FROM (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS w FROM events) GROUP BY w")
def sliding_counts(s, d):
    g = ev(s, d, "ts").groupBy(F.window("ts", "2 hours", "1 hour").alias("w")).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), "n")


@query("sessions_gap", """
WITH b AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events), k AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM b)
SELECT user_id, min(ts) AS start, count(*) AS n FROM k GROUP BY user_id, sid""")
def sessions_gap(s, d):
    g = ev(s, d, "user_id", "ts").groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), "n")


def _drained(s, d, transform, mode="append"):
    """The event table as six files that arrive in order of time, drained a file a batch."""
    ship(s)
    folder = st.in_slices(s, ev(s, d, "event_id", "ts", "user_id", "event_type", "value", "props"))
    return st.run(s, folder, transform, mode)


@query("stream_tumbling", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(s, d):
    """The tumbling counts as a drained stream in complete mode: equal to the batch result."""
    return _drained(s, d, st.tumbling, "complete").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


@query("stream_dedup", "SELECT DISTINCT event_id FROM events")
def stream_dedup(s, d):
    return _drained(s, d, st.deduplicated).select("event_id")


_MARK = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)"


@query("stream_sliding", f"SELECT w AS start, count(*) AS n FROM (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS w FROM events) WHERE w + INTERVAL 2 HOUR <= {_MARK} GROUP BY w")
def stream_sliding(s, d):
    """Sliding counts in append mode: the windows that the watermark has passed."""
    return _drained(s, d, st.sliding).select(F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("stream_sessions", f"""
WITH b AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events), k AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM b)
SELECT user_id, min(ts) AS start, count(*) AS n FROM k GROUP BY user_id, sid HAVING max(ts) + INTERVAL 30 MINUTE <= {_MARK}""")
def stream_sessions(s, d):
    return _drained(s, d, st.sessions).select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("stream_bursts", f"""
WITH w AS (SELECT user_id, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start FROM events)
SELECT user_id, start, count(*) AS n FROM w WHERE start + INTERVAL 1 HOUR <= {_MARK} GROUP BY user_id, start HAVING count(*) >= 3""")
def stream_bursts(s, d):
    return _drained(s, d, st.burst_alarms).select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("stream_cap_alarms", "SELECT user_id FROM events GROUP BY user_id HAVING sum(value) >= 0.95 * 3600")
def stream_cap_alarms(s, d):
    """Users whose running sum reaches 95 % of the cap: one alarm each, however many batches follow."""
    return _drained(s, d, lambda df: st.cap_alarms(df, 3600.0))


@query("spend_watchdog", """
WITH u AS (SELECT user_id, count(*) AS uptime FROM events GROUP BY user_id), c AS (SELECT user_id, round(0.79 * uptime / 3600, 6) AS spent FROM u)
SELECT user_id, spent, spent >= 0.95 * 0.015 AND spent < 0.015 AS warn, spent >= 0.015 AS stop FROM c""")
def spend_watchdog(s, d):
    c = ev(s, d, "user_id").groupBy("user_id").agg(F.round(F.lit(0.79) * F.count("*") / 3600, 6).alias("spent"))
    return c.select("user_id", "spent", ((F.col("spent") >= 0.95 * 0.015) & (F.col("spent") < 0.015)).alias("warn"), (F.col("spent") >= 0.015).alias("stop"))


@query("stale_age", "SELECT event_id FROM events WHERE date_diff('second', ts, TIMESTAMP '2024-01-31 00:00:00') > 36 * 3600")
def stale_age(s, d):
    # compared as instants, so the bound reaches the scan
    return ev(s, d, "event_id", "ts").where(F.col("ts") < F.expr("timestamp_ntz'2024-01-31 00:00:00' - interval 36 hours - interval 999999 microseconds")).select("event_id")


@query("revenue_by_nation", """
SELECT n.n_name, round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS revenue FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""")
def revenue_by_nation(s, d):
    l = table(s, d, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
    o, c, n = table(s, d, "orders", "o_orderkey", "o_custkey"), table(s, d, "customer", "c_custkey", "c_nationkey"), table(s, d, "nation", "n_nationkey", "n_name")
    j = l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


QUERIES = Q
