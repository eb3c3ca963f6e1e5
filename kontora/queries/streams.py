"""Streaming queries: each drains the feed once and returns what the sink holds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kontora.queries.base import query
from kontora.session import scratch_path
from kontora.sources import storage
from kontora.streaming import jobs, stateful


def _ntz(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _files(b, stream, label):
    out = scratch_path(b.spark, label)
    jobs.drain(jobs.to_files(stream, out, scratch_path(b.spark, f"{label}-checkpoint")))
    return b.spark.read.parquet(out)


def _batches(b, stream, step, label, mode="append"):
    jobs.drain(jobs.to_batches(stream, step, scratch_path(b.spark, f"{label}-checkpoint"), mode))


@query("stream_source", "SELECT transaction_id, customer_id, transaction_timestamp, CAST(amount AS DOUBLE) AS amount FROM transactions")
def stream_source(b):
    feed = jobs.transactions(b.spark, b.folder).select("transaction_id", "customer_id", "transaction_timestamp", "amount")
    return _ntz(_files(b, feed, "feed"), "transaction_timestamp")


@query("stream_micro_batch", "SELECT event_type, count(*) AS n, CAST(round(sum(value), 2) AS DOUBLE) AS v FROM events GROUP BY 1")
def stream_micro_batch(b):
    out = scratch_path(b.spark, "per-batch")

    def step(batch, batch_id):
        batch.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).alias("v")).write.mode("overwrite").parquet(
            f"{out}/batch={batch_id}"
        )

    _batches(b, jobs.raw_events(b.spark, b.folder), step, "per-batch")
    return b.spark.read.parquet(out).groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))


_WINDOW = """SELECT customer_id, date_trunc('hour', transaction_timestamp) AS window_start, date_trunc('hour', transaction_timestamp) + INTERVAL 1 HOUR AS window_end,
  count(*) AS transaction_count, CAST(max(amount) AS DOUBLE) AS max_amount FROM transactions GROUP BY 1, 2, 3"""


@query("stream_tumbling", _WINDOW)
def stream_tumbling(b):
    table = storage.UpsertLog(b.spark, scratch_path(b.spark, "hourly"), ["customer_id", "window_start"])
    _batches(b, jobs.tumbling(jobs.transactions(b.spark, b.folder)), jobs.upsert_windows(table), "hourly", "update")
    return _ntz(table.read(), "window_start", "window_end").drop("last_time")


@query("late_data", f"SELECT * FROM ({_WINDOW}) WHERE window_end <= (SELECT max(transaction_timestamp) FROM transactions) - INTERVAL 10 MINUTE")
def late_data(b):
    """Append mode gives a window once, after the watermark has passed its end."""
    closed = jobs.tumbling(jobs.transactions(b.spark, b.folder)).drop("last_time")
    return _ntz(_files(b, closed, "closed"), "window_start", "window_end")


@query("stream_rolling_hour", """
SELECT customer_id, w AS window_start, w + INTERVAL 1 HOUR AS window_end, count(*) AS transaction_count, CAST(max(amount) AS DOUBLE) AS max_amount, max(transaction_timestamp) AS last_time
FROM (SELECT *, unnest(generate_series(time_bucket(INTERVAL 5 MINUTE, transaction_timestamp) - INTERVAL 55 MINUTE, time_bucket(INTERVAL 5 MINUTE, transaction_timestamp), INTERVAL 5 MINUTE)) AS w FROM transactions)
GROUP BY 1, 2, 3""")
def stream_rolling_hour(b):
    """Windows of an hour every five minutes; state and table hold five-minute panes, a twelfth of the windows' rows."""
    stateful.use_timers(b.spark)  # that state store keeps its rows on disk
    table = storage.UpsertLog(b.spark, scratch_path(b.spark, "rolling"), ["customer_id", "window_start"])
    _batches(b, jobs.panes(jobs.transactions(b.spark, b.folder)), jobs.upsert_windows(table), "rolling", "update")
    return _ntz(jobs.rolled(table.read()), "window_start", "window_end", "last_time")


@query("stream_online_upsert", """
WITH e AS (SELECT max(transaction_timestamp) AS t FROM transactions)
SELECT CAST(customer_id AS VARCHAR) AS entity_id, CAST(count(*) AS DOUBLE) AS transaction_count_1h, CAST(max(amount) AS DOUBLE) AS max_amount_1h, max(e.t) AS last_updated
FROM transactions, e WHERE transaction_timestamp >= e.t - INTERVAL 1 HOUR GROUP BY 1""")
def stream_online_upsert(b):
    table = storage.UpsertLog(b.spark, scratch_path(b.spark, "online"), ["entity_id", "entity_type"])
    _batches(b, jobs.transactions(b.spark, b.folder), jobs.upsert_online(table), "online")
    v = F.col("feature_vector")
    return table.read().select("entity_id", v["transaction_count_1h"].alias("transaction_count_1h"), v["max_amount_1h"].alias("max_amount_1h"), "last_updated")


@query("stream_velocity", """
WITH r AS (SELECT transaction_id, customer_id, transaction_timestamp, merchant_city,
  lag(transaction_timestamp) OVER (PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id) AS prev_time,
  lag(merchant_city) OVER (PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id) AS prev_city FROM transactions)
SELECT transaction_id, customer_id, prev_time, prev_city, CASE WHEN date_diff('minute', prev_time, transaction_timestamp) < 5 AND merchant_city <> prev_city THEN 1 ELSE 0 END AS impossible_travel FROM r""")
def stream_velocity(b):
    state = jobs.velocity_state(b.spark, scratch_path(b.spark, "last-seen"))
    flags = scratch_path(b.spark, "flags")
    _batches(b, jobs.transactions(b.spark, b.folder), jobs.velocity(state, flags), "velocity")
    return _ntz(jobs.final_flags(b.spark, flags), "prev_time").select("transaction_id", "customer_id", "prev_time", "prev_city", "impossible_travel")


@query("stream_session", """
SELECT * FROM (SELECT user_id AS customer_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS actions FROM session_rows GROUP BY user_id, session_no)
WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_session(b):
    return _ntz(_files(b, jobs.sessions(jobs.transactions(b.spark, b.folder)), "sessions"), "session_start", "session_end")


@query("stream_velocity_timers", """
WITH r AS (SELECT transaction_id, customer_id, transaction_timestamp, merchant_city,
  lag(transaction_timestamp) OVER (PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id) AS prev_time,
  lag(merchant_city) OVER (PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id) AS prev_city FROM transactions)
SELECT transaction_id, customer_id, prev_time, prev_city, CASE WHEN date_diff('minute', prev_time, transaction_timestamp) < 5 AND merchant_city <> prev_city THEN 1 ELSE 0 END AS impossible_travel
FROM r WHERE date_trunc('millisecond', transaction_timestamp) < (SELECT date_trunc('millisecond', max(transaction_timestamp)) FROM transactions) - INTERVAL 10 MINUTE""")
def stream_velocity_timers(b):
    """Each flag once and for good, when the watermark has passed its row; the last ten minutes still wait."""
    flags = stateful.flag_velocity(jobs.transactions(b.spark, b.folder), idle=dt.timedelta(days=3650))
    return _ntz(_files(b, flags, "velocity-timers"), "prev_time").select("transaction_id", "customer_id", "prev_time", "prev_city", "impossible_travel")


@query("stream_delivered_twice", "SELECT transaction_id, customer_id, transaction_timestamp, CAST(amount AS DOUBLE) AS amount FROM transactions")
def stream_delivered_twice(b):
    """The whole feed comes a second time to a restarted query, and nothing changes."""
    folder, out, checkpoint = (scratch_path(b.spark, f"twice-{x}") for x in ("feed", "rows", "checkpoint"))
    for copy in (1, 2):
        b.raw("events").write.parquet(f"{folder}/events-{copy}.parquet")
        feed = jobs.transactions(b.spark, folder).select("transaction_id", "customer_id", "transaction_timestamp", "amount")
        jobs.drain(jobs.to_files(stateful.delivered_once(feed, "3650 days"), out, checkpoint))
    return _ntz(b.spark.read.parquet(out), "transaction_timestamp")
