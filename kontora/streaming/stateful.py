"""Keyed state with event-time timers, and repeated deliveries.

``flag_velocity`` is the append-only form of the velocity job: a row waits until the watermark has passed it, so its predecessor is
final and each transaction is written once. A bucket of customers' rows of a batch meet in one task, as in any keyed state; where one
customer holds much of the feed, ``jobs.velocity`` cuts customers into slices instead.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from kontora.functions.scalars import date_diff, flag

#: Timers and several states per key need this state store; ``use_timers`` sets it where it is not.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Keys that the customers of the velocity job are dealt to. A checkpoint holds for one number.
BUCKETS = 4096
#: Rows that an entry of the state, or a frame that is written, holds at most.
PACK = 10_000
_ROW = "customer_id long, transaction_id long, at long, merchant_city string, prev_at long, prev_city string"


def use_timers(spark: SparkSession) -> None:
    if spark.conf.get(PROVIDER, None) != ROCKS:
        spark.conf.set(PROVIDER, ROCKS)


class _LastSeen(StatefulProcessor):
    """Per bucket of customers: rows that the watermark has not passed, and the last row of each customer that it has.

    Every call to the state is a message to the JVM and every key a frame each way, so customers share ``BUCKETS`` keys and their rows lie
    in entries of up to ``PACK`` rows: a bucket takes a few messages a batch, however many customers and rows it holds. Of rows that
    repeat customer, time and id the last one counts. Customers without an id are one customer, in a bucket of its own.
    """

    def __init__(self, idle: dt.timedelta):
        self.idle = idle // dt.timedelta(milliseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "customer array<long>, at array<long>, id array<long>, city array<string>")
        self.last = handle.getListState("last", "customer array<long>, at array<long>, city array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        undated, first = [], None
        for block in rows:
            dated = []
            for c, at, i, city in zip(*(block[x].tolist() for x in ("customer", "at", "transaction_id", "merchant_city"))):
                city = None if pd.isna(city) else str(city)
                if pd.isna(at):
                    undated.append((None if key[0] < 0 else c, int(i), None, city, None, None))
                else:
                    dated.append((c, int(at), int(i), city))
            for pack in _packs(dated):
                self.waiting.appendValue(pack)
            if dated:
                first = min(r[1] for r in dated) if first is None else min(first, *(r[1] for r in dated))
        if first is not None:
            self._wake(first // 1000 + 1)
        if undated:
            yield _frame(undated)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        rows, last = {}, {}
        for *names, cities in self.waiting.get():
            rows.update(zip(zip(*names), cities))
        for customers, ats, cities in self.last.get():
            last.update(zip(customers, zip(ats, cities)))
        out, moved = [], set()
        for c, at, i in sorted(k for k in rows if k[1] // 1000 < passed):
            city, before = rows.pop((c, at, i)), last.get(c)
            near = before is not None and (at - before[0]) // 1000 <= self.idle
            out.append((None if key[0] < 0 else c, i, at, city, *(before if near else (None, None))))
            last[c] = (at, city)
            moved.add(c)
        if out:
            _replace(self.waiting, [(*k, city) for k, city in rows.items()])
        held = {c for c, _, _ in rows}
        gone = [c for c, (at, _) in last.items() if c not in moved and c not in held and at // 1000 + self.idle < passed]
        for c in gone:
            del last[c]
        if out or gone:
            _replace(self.last, [(c, *v) for c, v in last.items()])
        due = [at // 1000 + 1 for _, at, _ in rows] + [at // 1000 + self.idle + 1 for c, (at, _) in last.items() if c not in held]
        if due:  # behind the timer that fired, which goes when this is done
            self.handle.registerTimer(max(min(due), passed + 1))
        for k in range(0, len(out), PACK):
            yield _frame(out[k : k + PACK])

    def _wake(self, at: int) -> None:
        """One timer per bucket: when its first waiting row can go or a customer is idle for too long."""
        timers = [t if isinstance(t, int) else t[0] for t in self.handle.listTimers()]
        if timers and min(timers) <= at:
            return
        for t in timers:
            self.handle.deleteTimer(t)
        self.handle.registerTimer(at)

    def close(self) -> None:
        pass


def _packs(rows: list[tuple]) -> Iterator[tuple[list, ...]]:
    """Rows as entries of the state, a list per column."""
    for k in range(0, len(rows), PACK):
        yield tuple(map(list, zip(*rows[k : k + PACK])))


def _replace(state, rows: list[tuple]) -> None:
    if rows:
        state.put(list(_packs(rows)))
    else:
        state.clear()


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _ROW.split(", ")], dtype=object)


def flag_velocity(stream: DataFrame, late: str = "10 minutes", idle: dt.timedelta = dt.timedelta(days=30)) -> DataFrame:
    """``customer_id, transaction_id, prev_time, prev_city, impossible_travel`` once per row, when the watermark has passed it.

    Rows behind the watermark of the batch before are dropped, all others find their place; rows without a time come out at once,
    without a predecessor. A row more than ``idle`` after the one before has no predecessor, so idle customers are forgotten.
    """
    use_timers(stream.sparkSession)
    rows = stream.select("customer_id", "transaction_id", "transaction_timestamp", "merchant_city").withWatermark("transaction_timestamp", late)
    rows = rows.withColumn("at", F.unix_micros("transaction_timestamp"))
    bucket = F.when(F.col("customer_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("customer_id"), F.lit(BUCKETS))).cast("int")
    rows = rows.select(bucket.alias("bucket"), F.coalesce("customer_id", F.lit(0)).cast("long").alias("customer"), "transaction_id", "transaction_timestamp", "at", "merchant_city")
    lined = rows.groupBy("bucket").transformWithStateInPandas(_LastSeen(idle), _ROW, "append", "eventTime")
    timed = lined.withColumns({"time": F.timestamp_micros("at"), "prev_time": F.timestamp_micros("prev_at")})
    travel = (date_diff("minute", "prev_time", "time") < 5) & (F.col("merchant_city") != F.col("prev_city"))
    return timed.select("customer_id", "transaction_id", "prev_time", "prev_city", flag(travel).alias("impossible_travel"))


def delivered_once(stream: DataFrame, late: str = "1 day", name: str = "deliveries", id_col: str = "transaction_id") -> DataFrame:
    """The stream without rows whose id came before, however often a feed delivers them.

    The state of an id goes when the watermark has passed it by ``late``; rows that come later still are dropped as late. What
    was seen and what was kept is counted by observations, which ``deliveries`` reads.
    """
    seen = stream.observe(f"{name}_seen", F.count(F.lit(1)).alias("n")).withWatermark("transaction_timestamp", late)
    return seen.dropDuplicatesWithinWatermark([id_col]).observe(f"{name}_kept", F.count(F.lit(1)).alias("n"))


def deliveries(query: StreamingQuery, name: str = "deliveries") -> dict[str, int]:
    """Rows seen, kept, late and repeated over the progress reports that the query still holds."""
    out = {"seen": 0, "kept": 0, "late": 0}
    for p in query.recentProgress:
        for part in ("seen", "kept"):
            row = p.observedMetrics.get(f"{name}_{part}")
            out[part] += row["n"] if row is not None else 0
        out["late"] += sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
    out["repeated"] = out["seen"] - out["kept"] - out["late"]
    return out
