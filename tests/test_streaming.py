"""Streams over hand-made feeds: late rows, repeated batches, several batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kontora.session import scratch_path
from kontora.sources import storage
from kontora.streaming import jobs

T0 = dt.datetime(2024, 1, 1, 10)


def feed(spark, folder, name, rows):
    df = spark.createDataFrame(
        [(i, T0 + dt.timedelta(minutes=m), u, "click", 1.0, '{"k": %d}' % k) for i, m, u, k in rows],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    )
    df.coalesce(1).write.parquet(f"{folder}/events-{name}.parquet")


@pytest.fixture
def batches(spark):
    folder = scratch_path(spark, "feed")
    feed(spark, folder, "1", [(1, 0, 1, 1), (2, 3, 1, 2), (3, 200, 2, 1)])
    feed(spark, folder, "2", [(4, 201, 2, 2), (6, 202, 3, 1)])
    feed(spark, folder, "3", [(5, 5, 1, 3)])  # comes long after its hour was closed
    return folder


def run(spark, folder, make, step_or_none, mode="append"):
    stream = jobs.transactions(spark, folder, files_per_batch=1)
    jobs.drain(jobs.to_batches(make(stream), step_or_none, scratch_path(spark, "cp"), mode))


def test_stream_equals_batch_over_batches(spark, batches):
    state, flags = jobs.velocity_state(spark, scratch_path(spark, "s")), scratch_path(spark, "f")
    seen = []
    inner = jobs.velocity(state, flags)

    def step(batch, batch_id):
        seen.append(batch_id)
        inner(batch, batch_id)
        inner(batch, batch_id)  # a repeated batch changes nothing

    run(spark, batches, lambda s: s, step)
    got = {r.transaction_id: r.prev_city for r in jobs.final_flags(spark, flags).collect()}
    assert len(seen) == 3 and len(got) == 6
    assert got[2] == "City 1" and got[4] == "City 1" and got[1] is None  # row 4 follows row 3 of the batch before


def test_windows_upsert_to_the_final_state(spark, batches):
    table = storage.UpsertLog(spark, scratch_path(spark, "w"), ["customer_id", "window_start"])
    run(spark, batches, lambda s: jobs.tumbling(s, late="1 day"), jobs.upsert_windows(table), "update")
    got = {(r.customer_id, r.window_start.hour): r.transaction_count for r in table.read().collect()}
    assert got == {(1, 10): 3, (2, 13): 2, (3, 13): 1}


def test_sliding_windows_are_made_of_panes(spark):
    folder = scratch_path(spark, "feed")
    minutes = {1: [0, 3, 4, 5, 55, 58, 59, 60, 119], 2: [61, 200], 3: [57]}
    first, *rest = [(10 * u + i, m, u, 1) for u, ms in minutes.items() for i, m in enumerate(ms)]
    feed(spark, folder, "1", rest)
    feed(spark, folder, "2", [(900, 201, 2, 1)])
    feed(spark, folder, "3", [first[:1] + (140,) + first[2:]])  # 61 minutes late: its last window is open
    table, held = storage.UpsertLog(spark, scratch_path(spark, "w"), ["customer_id", "window_start"]), []
    step = jobs.upsert_windows(table)

    def counted(batch, batch_id):
        held.append(batch.count())
        step(batch, batch_id)

    run(spark, folder, jobs.panes, counted, "update")
    assert held == [8, 1, 1]  # panes: no row is held twelve times
    rows = [(u, m) for u, ms in minutes.items() for m in ms if (u, m) != (1, 0)] + [(1, 140), (2, 201)]
    want = {}
    for u, m in rows:
        for w in range(m // 5 * 5 - 55, m // 5 * 5 + 1, 5):
            n, last = want.get((u, w), (0, m))
            want[u, w] = n + 1, max(last, m)
    at = lambda t: round((t - T0).total_seconds() / 60)
    got = {(r.customer_id, at(r.window_start)): (r.transaction_count, at(r.last_time)) for r in jobs.rolled(table.read()).collect()}
    assert got == want
    assert all(r.window_end - r.window_start == dt.timedelta(hours=1) for r in jobs.rolled(table.read()).collect())


def test_late_rows_are_left_out_after_the_watermark(spark, batches):
    out = scratch_path(spark, "closed")
    stream = jobs.tumbling(jobs.transactions(spark, batches, files_per_batch=1), late="10 minutes")
    jobs.drain(jobs.to_files(stream, out, scratch_path(spark, "cp")))
    got = {(r.customer_id, r.window_start.hour): r.transaction_count for r in spark.read.parquet(out).collect()}
    assert got == {(1, 10): 2}  # the open 13h windows wait; the late row is dropped


def test_late_rows_find_their_place(spark):
    folder, flags = scratch_path(spark, "feed"), scratch_path(spark, "f")
    feed(spark, folder, "1", [(1, 0, 1, 1), (2, 10, 1, 2)])
    feed(spark, folder, "2", [(3, 3, 1, 3)])  # late, in reach: row 2 now follows it
    feed(spark, folder, "3", [(4, 3000, 1, 1)])
    feed(spark, folder, "4", [(5, 1, 1, 2), (6, 3001, 1, 2)])  # row 5 is out of reach
    state = jobs.velocity_state(spark, scratch_path(spark, "s"), compact_every=2)
    run(spark, folder, lambda s: s, jobs.velocity(state, flags))
    got = {r.transaction_id: (r.prev_city, r.impossible_travel) for r in jobs.final_flags(spark, flags).collect()}
    assert got == {1: (None, 0), 3: ("City 1", 1), 2: ("City 3", 0), 4: ("City 2", 0), 6: ("City 1", 1)}
    assert [r.transaction_id for r in spark.read.parquet(f"{flags}-late").collect()] == [5]
    # the last compaction left what is in reach and the customer's last row before
    assert {r.transaction_id for r in state.read().collect()} == {2, 4, 6}


@pytest.mark.parametrize("per_batch", [False, True])
def test_online_vectors_over_batches(spark, batches, per_batch):
    feed(spark, batches, "4", [(7, 150, 2, 5)])  # late, within the hour that ends at minute 202
    table = storage.UpsertLog(spark, scratch_path(spark, "o"), ["entity_id", "entity_type"])
    step = jobs.upsert_online(table, per_batch=per_batch)

    def twice(batch, batch_id):
        step(batch, batch_id)
        step(batch, batch_id)

    run(spark, batches, lambda s: s, twice)
    got = {r.entity_id: r.feature_vector["transaction_count_1h"] for r in table.read().collect()}
    # of the batch alone, or of the hour up to minute 202: customer 2 at 150, 200 and 201, customer 3 at 202
    assert got == ({"1": 1.0, "2": 1.0, "3": 1.0} if per_batch else {"2": 3.0, "3": 1.0})


def test_idle_customers_decay(spark):
    folder = scratch_path(spark, "feed")
    feed(spark, folder, "1", [(1, 0, 1, 1), (2, 5, 1, 2)])
    feed(spark, folder, "2", [(3, 62, 2, 1)])
    feed(spark, folder, "3", [(4, 300, 2, 1)])
    table, seen = storage.UpsertLog(spark, scratch_path(spark, "o"), ["entity_id", "entity_type"]), []
    inner = jobs.upsert_online(table)

    def step(batch, batch_id):
        inner(batch, batch_id)
        seen.append({r.entity_id: r.feature_vector["transaction_count_1h"] for r in table.read().collect()})

    run(spark, folder, lambda s: s, step)
    assert seen == [{"1": 2.0}, {"1": 1.0, "2": 1.0}, {"1": 0.0, "2": 1.0}]
