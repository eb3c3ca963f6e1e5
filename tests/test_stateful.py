"""Timers and repeated deliveries over feeds of several batches: late rows, restarts, idle customers."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from kontora.session import scratch_path
from kontora.streaming import jobs, stateful

T0 = dt.datetime(2024, 1, 1, 10)


def feed(spark, folder, name, rows):
    df = spark.createDataFrame(
        [(i, None if m is None else T0 + dt.timedelta(minutes=m), u, "click", 1.0, '{"k": %d}' % k) for i, m, u, k in rows],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    )
    df.coalesce(1).write.parquet(f"{folder}/events-{name}.parquet")


def run(spark, folder, make, out, checkpoint):
    query = jobs.to_files(make(jobs.transactions(spark, folder, files_per_batch=1)), out, checkpoint)
    jobs.drain(query)
    return query


@pytest.fixture
def folders(spark):
    return [scratch_path(spark, f"stateful-{x}") for x in ("feed", "out", "checkpoint")]


def flags(spark, out):
    return {r.transaction_id: (r.prev_time and r.prev_time.minute, r.prev_city, r.impossible_travel) for r in spark.read.parquet(out).collect()}


def test_rows_wait_for_the_watermark_and_restarts_go_on(spark, folders):
    folder, out, checkpoint = folders
    flagged = lambda s: stateful.flag_velocity(s, "10 minutes")
    feed(spark, folder, "1", [(1, 0, 1, 1), (3, 4, 1, 3), (9, None, 1, 1)])
    feed(spark, folder, "2", [(2, 2, 1, 2), (4, 4, 1, 3)])  # row 2 is late, but not too late, and comes between 1 and 3
    run(spark, folder, flagged, out, checkpoint)
    assert set(flags(spark, out)) == {9}  # nothing is final, but for the row without a time
    feed(spark, folder, "3", [(5, 30, 2, 1)])
    feed(spark, folder, "4", [(7, 31, 2, 2)])
    feed(spark, folder, "4a", [(6, 3, 1, 9)])  # comes too late
    run(spark, folder, flagged, out, checkpoint)  # a new query on the old checkpoint
    got = flags(spark, out)
    assert got == {9: (None, None, 0), 1: (None, None, 0), 2: (0, "City 1", 1), 3: (2, "City 2", 1), 4: (4, "City 3", 0)}
    feed(spark, folder, "5", [(8, 90, 3, 1)])
    run(spark, folder, flagged, out, checkpoint)
    assert flags(spark, out) == got | {5: (None, None, 0), 7: (30, "City 1", 1)}
    assert spark.read.parquet(out).count() == len(got) + 2  # once each


def test_idle_customers_are_forgotten(spark, folders):
    folder, out, checkpoint = folders
    flagged = lambda s: stateful.flag_velocity(s, "10 minutes", idle=dt.timedelta(hours=1))
    for name, rows in enumerate([[(1, 0, 1, 1)], [(2, 40, 2, 1)], [(3, 200, 2, 1)], [(4, 201, 1, 2)], [(5, 400, 3, 1)]]):
        feed(spark, folder, str(name), rows)
        query = run(spark, folder, flagged, out, checkpoint)
    got = flags(spark, out)
    assert got[4] == (None, None, 0) and set(got) == {1, 2, 3, 4}
    assert all(r.prev_time is None for r in spark.read.parquet(out).collect())  # customer 2 was idle for over an hour, too


def test_deliveries_count_once(spark, folders):
    folder, out, checkpoint = folders
    once = lambda s: stateful.delivered_once(s.select("transaction_id", "transaction_timestamp"), "1 hour")
    feed(spark, folder, "1", [(1, 0, 1, 1), (2, 3, 1, 2), (2, 3, 1, 2)])
    feed(spark, folder, "2", [(1, 0, 1, 1), (2, 3, 1, 2), (3, 300, 1, 1)])
    feed(spark, folder, "3", [(3, 300, 1, 1)])
    feed(spark, folder, "4", [(4, 1, 1, 1)])  # is late
    query = run(spark, folder, once, out, checkpoint)
    assert sorted(r.transaction_id for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    assert stateful.deliveries(query) == {"seen": 8, "kept": 3, "late": 1, "repeated": 4}


class Counted:
    """State and timers in memory that count the messages."""

    def __init__(self):
        self.calls, self.lists, self.timers = 0, {}, set()

    def getListState(self, name, schema):
        handle, rows = self, self.lists.setdefault(name, [])

        class State:
            def appendValue(self, row):
                handle.calls += 1
                rows.append(row)

            def put(self, new):
                handle.calls += 1
                rows[:] = new

            def get(self):
                handle.calls += 1
                return iter(list(rows))

            def clear(self):
                handle.calls += 1
                rows.clear()

        return State()

    def listTimers(self):
        self.calls += 1
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)

    def getCurrentWatermarkInMs(self):
        return 2_000


def test_many_rows_take_few_messages():
    """3,000 rows of 30 customers: a batch, and the rows that become final, are a few messages to the state and not some per row."""
    state, job = Counted(), stateful._LastSeen(dt.timedelta(days=1))
    job.init(state)
    rows = [(c, k * 30 + c, k * 25_000, f"City {k % 7}") for k in range(100) for c in range(30)]
    block = pd.DataFrame(rows, columns=["customer", "transaction_id", "at", "merchant_city"])
    assert list(job.handleInputRows((7,), iter([block]), state)) == [] and state.timers == {1}
    out = pd.concat(job.handleExpiredTimer((7,), state, None))
    assert state.calls < 12 and len(out) == 30 * 80  # 80 of each customer's rows are before the watermark
    assert state.timers == {1, 2_001}
    last = out[out.customer_id == 4].iloc[-1]
    assert (last.transaction_id, last["at"], last.prev_at, last.prev_city) == (79 * 30 + 4, 79 * 25_000, 78 * 25_000, "City 1")
    again = pd.concat(job.handleExpiredTimer((7,), type("Late", (), {"getCurrentWatermarkInMs": lambda self: 9_000})(), None))
    assert len(again) == 30 * 20 and again[again.customer_id == 4].iloc[0].prev_at == 79 * 25_000
