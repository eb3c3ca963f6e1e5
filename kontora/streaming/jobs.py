"""Streams over transactions: windows, sessions, online upserts and fraud flags.

Every job takes its output and checkpoint folders, so a restarted query goes on
where it stopped. Batch sinks carry the batch id as a token, which makes a
repeated batch a no-op.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from kontora.functions.scalars import date_diff, flag
from kontora.operators.ranking import latest_per_key
from kontora.operators.windows import framed, slice_of
from kontora.sources import storage
from kontora.sources.mapping import MAPPING, SPARK

WATERMARK = "10 minutes"


def raw_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The event feed as an append-only file stream.

    Event time has to be a timestamp with zone: streaming refuses zone-free ones.
    """
    pattern = f"{folder.rstrip('/')}/events*.parquet"
    reader = spark.readStream.schema(spark.read.parquet(pattern).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(pattern)


def transactions(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The feed as transactions, event time in ``transaction_timestamp``."""
    cols = MAPPING["transactions"].columns
    feed = raw_events(spark, folder, files_per_batch).selectExpr(*[f"{SPARK.fill(e)} AS {c}" for c, e in cols.items()])
    return feed.withColumn("transaction_timestamp", F.col("transaction_timestamp").cast("timestamp"))


def drain(query: StreamingQuery) -> None:
    """Wait until everything that was there at the start is processed."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def to_files(stream: DataFrame, out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append to a parquet folder; without ``every`` what is there is processed and the query ends."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start(out)


def to_batches(
    stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    """Run ``step(batch, batch_id)`` per micro-batch; empty triggers run nothing."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(step)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def tumbling(stream: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = WATERMARK) -> DataFrame:
    """Count and largest amount per customer and window."""
    window = F.window("transaction_timestamp", size, slide) if slide else F.window("transaction_timestamp", size)
    return (
        stream.withWatermark("transaction_timestamp", late)
        .groupBy(window.alias("w"), "customer_id")
        .agg(F.count("*").alias("transaction_count"), F.max("amount").alias("max_amount"), F.max("transaction_timestamp").alias("last_time"))
        .select("customer_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "transaction_count", "max_amount", "last_time")
    )


def panes(stream: DataFrame, size_minutes: int = 60, slide_minutes: int = 5, late_minutes: int = 10) -> DataFrame:
    """What sliding windows are made of: count, largest amount and last time per customer and slide.

    A row is in the state once, not once per window that it is in; ``rolled`` puts the windows together where they are read. A pane takes
    rows in until the last window that it is in is closed.
    """
    return tumbling(stream, f"{slide_minutes} minutes", late=f"{late_minutes + size_minutes - slide_minutes} minutes")


def rolled(pane_rows: DataFrame, size_minutes: int = 60, slide_minutes: int = 5) -> DataFrame:
    """Count, largest amount and last time per customer and sliding window that has a row, from the newest state of ``panes``.

    A pane is in windows that begin in two spans of a window's length. It is shuffled to these two and not to each window, and the windows
    of a span are made there.
    """
    if size_minutes % slide_minutes:
        raise ValueError("a window must be a whole number of slides")
    size, slide = (F.lit(m * 60_000_000).cast("long") for m in (size_minutes, slide_minutes))
    pane = pane_rows.select("customer_id", F.unix_micros("window_start").alias("pane"), "transaction_count", "max_amount", "last_time")
    own = F.col("pane") - F.pmod("pane", size)
    # the rows grow after this shuffle, so its parts are not merged by their size
    parts = int(pane_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = pane.withColumn("span", F.explode(F.array(own - size, own))).repartition(parts, "customer_id", "span")
    first, last = F.greatest("span", F.col("pane") - size + slide), F.least(F.col("span") + size - slide, "pane")
    begins = F.when(first <= last, F.sequence(first, last, slide))  # the last pane of a span is in no window of the span before
    at = spans.withColumn("at", F.explode(begins)).groupBy("customer_id", "span", "at").agg(
        F.sum("transaction_count").alias("transaction_count"), F.max("max_amount").alias("max_amount"), F.max("last_time").alias("last_time")
    )
    return at.select(
        "customer_id", F.timestamp_micros("at").alias("window_start"), F.timestamp_micros(F.col("at") + size).alias("window_end"),
        "transaction_count", "max_amount", "last_time",
    )


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = WATERMARK) -> DataFrame:
    """Bursts of activity per customer."""
    return (
        stream.withWatermark("transaction_timestamp", late)
        .groupBy(F.session_window("transaction_timestamp", gap).alias("w"), "customer_id")
        .agg(F.count("*").alias("actions"))
        .select("customer_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "actions")
    )


def upsert_windows(table: storage.UpsertLog) -> Callable[[DataFrame, int], None]:
    """Keep the newest state of every (customer, window) that an update-mode stream emits."""

    def step(batch: DataFrame, batch_id: int) -> None:
        table.put(batch, str(batch_id))

    return step


def _vectors(counted: DataFrame, stamp: Column) -> DataFrame:
    vector = F.create_map(F.lit("transaction_count_1h"), "n", F.lit("max_amount_1h"), "m", F.lit("last_transaction_time"), "t")
    return counted.select(
        F.col("customer_id").cast("string").alias("entity_id"), F.lit("CUSTOMER").alias("entity_type"),
        vector.alias("feature_vector"), stamp.alias("last_updated"),
    )


def _in_window(test: Column) -> tuple[Column, Column, Column]:
    """Count, largest amount and last time (in seconds) of the rows that pass."""
    return (
        F.count(F.when(test, 1)).cast("double"), F.max(F.when(test, F.col("amount").cast("double"))),
        F.max(F.when(test, F.col("transaction_timestamp").cast("double"))),
    )


def upsert_online(table: storage.UpsertLog, hours: int = 1, per_batch: bool = False) -> Callable[[DataFrame, int], None]:
    """Merge the customers' last-hour features into the online vectors.

    The hour ends at the newest event so far, and its transactions are kept from
    batch to batch, so late ones count and idle customers decay to zero. A batch
    writes only the vectors that it changes. ``per_batch`` counts the rows of the
    batch alone, within the hour before its newest event.
    """
    span = F.expr(f"INTERVAL {hours} HOURS")
    cols = ["customer_id", "transaction_id", "transaction_timestamp", "amount"]

    def in_reach(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("transaction_timestamp") >= rows.agg(F.max("transaction_timestamp")).scalar() - span)

    recent = storage.UpsertLog(table.spark, f"{table.root}-recent", ["customer_id", "transaction_id"], keep=in_reach)

    def newest(rows: DataFrame):
        return rows.agg(F.max("transaction_timestamp").alias("end")).first().end

    def step(batch: DataFrame, batch_id: int) -> None:
        rows, token = batch.select(*cols), str(batch_id)
        if not table.done(token):
            kept = None if per_batch else recent.read()
            before, last = None if kept is None else newest(kept), newest(rows)
            if last is None:
                return
            end = last if before is None else max(before, last)
            work = (rows if per_batch else rows.dropDuplicates(recent.keys)).withColumn("_new", F.lit(True))
            if kept is not None:
                work = work.join(kept, recent.keys, "left_anti").unionByName(kept.withColumn("_new", F.lit(False)))
            now = _in_window(F.col("transaction_timestamp") >= F.lit(end) - span)
            old = _in_window(~F.col("_new") & (F.col("transaction_timestamp") >= F.lit(before if before is not None else end) - span))
            names = ["n", "m", "t"]
            counted = work.groupBy("customer_id").agg(
                *[c.alias(k) for c, k in zip(now, names)], *[c.alias(f"old_{k}") for c, k in zip(old, names)]
            )
            changed = ~(F.col("n").eqNullSafe(F.col("old_n")) & F.col("m").eqNullSafe(F.col("old_m")) & F.col("t").eqNullSafe(F.col("old_t")))
            stamp = F.lit(end).cast("timestamp_ntz")
            fresh = _vectors(counted.where(changed), stamp)
            known = table.matching(fresh)
            if known is not None:
                fresh = storage.merge_rows(
                    known, fresh, ["entity_id", "entity_type"],
                    {"feature_vector": storage.overlay(F.col("t.feature_vector"), F.col("s.feature_vector")), "last_updated": stamp},
                )
            table.put(fresh, token)
        if not per_batch:  # after the vectors: a batch that broke off in between is finished here
            recent.put(rows.dropDuplicates(recent.keys), token)

    return step


def velocity_state(spark: SparkSession, root: str, late: str = "1 day", compact_every: int = 50) -> storage.UpsertLog:
    """Transactions that a row up to ``late`` behind the newest may follow or precede: those in reach, and each customer's last before."""

    def keep(rows: DataFrame) -> DataFrame:
        newest = rows.agg(F.max("transaction_timestamp")).scalar()
        dated = rows.withColumn("_old", F.col("transaction_timestamp") < newest - F.expr(f"INTERVAL {late}"))
        edge = latest_per_key(dated.where("_old"), ["customer_id"], ["transaction_timestamp", "transaction_id"])
        return dated.where("NOT coalesce(_old, false)").unionByName(edge).drop("_old")

    return storage.UpsertLog(spark, root, ["customer_id", "transaction_id"], compact_every, keep)


def velocity(table: storage.UpsertLog, flags: str, late: str = "1 day") -> Callable[[DataFrame, int], None]:
    """Flag impossible travel against the customer's previous transaction.

    ``table`` comes from ``velocity_state``. A row up to ``late`` behind the
    newest one finds its place, and the row after it is written again with its new
    predecessor: the newest batch of a transaction in ``flags`` counts (see
    ``final_flags``). Rows that come later go to ``<flags>-late``. Rows are lined
    up by the chunked window, so a busy customer does not meet in one task.
    """
    cols = ["customer_id", "transaction_id", "transaction_timestamp", "merchant_city", "amount"]
    prev = ["prev_time", "prev_city"]

    def step(batch: DataFrame, batch_id: int) -> None:
        if table.done(str(batch_id)):
            return
        rows = batch.select(*cols).withColumns({"_new": F.lit(True), "_time": F.lit(None).cast("timestamp"), "_city": F.lit(None).cast("string")})
        state = table.read()
        newest = None if state is None else state.agg(F.max("transaction_timestamp").alias("end")).first().end
        if newest is not None:
            behind = F.coalesce(F.col("transaction_timestamp") < F.lit(newest) - F.expr(f"INTERVAL {late}"), F.lit(False))
            rows.where(behind).select(*cols).write.mode("overwrite").parquet(f"{flags}-late/batch={batch_id}")
            rows = rows.where(~behind)
            known = table.matching(rows, ["customer_id"]).withColumnsRenamed({"prev_time": "_time", "prev_city": "_city"})
            rows = rows.unionByName(known.select(*cols, "_time", "_city").withColumn("_new", F.lit(False)))
        lined = framed(
            rows, ["customer_id"], ["transaction_timestamp", "transaction_id"],
            slice_of(F.date_trunc("minute", "transaction_timestamp")), 1,
            lambda w: {"prev_time": F.lag("transaction_timestamp").over(w), "prev_city": F.lag("merchant_city").over(w)},
        )
        # a known row without a row before it here keeps what it had: its predecessor is out of reach
        moved = F.col("prev_time").isNotNull() & ~(F.col("prev_time").eqNullSafe(F.col("_time")) & F.col("prev_city").eqNullSafe(F.col("_city")))
        travel = (date_diff("minute", "prev_time", "transaction_timestamp") < 5) & (F.col("merchant_city") != F.col("prev_city"))
        out = lined.where(F.col("_new") | moved).select(*cols, *prev, flag(travel).alias("impossible_travel"))
        written = f"{flags}/batch={batch_id}"
        out.write.mode("overwrite").parquet(written)
        table.put(table.spark.read.schema(out.schema).parquet(written).drop("impossible_travel"), str(batch_id))

    return step


def final_flags(spark: SparkSession, flags: str) -> DataFrame:
    """The newest verdict on each transaction."""
    return latest_per_key(spark.read.parquet(flags), ["customer_id", "transaction_id"], ["batch"]).drop("batch")
