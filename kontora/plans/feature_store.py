"""Feature computation, history, online vectors, training sets and drift."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from kontora.functions.scalars import (
    band, count_if, date_diff, day, days_before, draw, flag, mean, midnight, moment, ratio, ratio0,
)
from kontora.operators.aggregates import exact_percentiles
from kontora.operators.joins import asof_at, asof_join
from kontora.operators.ranking import latest_per_key
from kontora.plans import activity, customers
from kontora.plans.feature_history import DATE, known_to, within
from kontora.plans.registry import FeatureView, ViewRegistry
from kontora.sources import storage
from kontora.sources.mapping import FEATURE_IDS

PERCENTILES = {"percentile_25": 0.25, "percentile_50": 0.5, "percentile_75": 0.75, "percentile_95": 0.95, "percentile_99": 0.99}
DRIFT_THRESHOLD = 0.15


# ---------------------------------------------------------------- computing features


@dataclass(frozen=True)
class FeatureSpec:
    """One aggregate per customer over a table, optionally over the last days.

    ``value`` gets the row test of the feature and returns the aggregate, so that
    features of one table share one pass.
    """

    table: str
    frequency: str
    value: Callable[[Column], Column]
    date: str | None = None
    days: int | None = None


def _kept(test: Column, value: Column) -> Column:
    return F.when(test, value)


SPECS: dict[str, FeatureSpec] = {
    FEATURE_IDS[0]: FeatureSpec("transactions", "DAILY", lambda t: count_if(t).cast("double"), "transaction_date", 30),
    FEATURE_IDS[1]: FeatureSpec(
        "transactions", "DAILY", lambda t: F.sum(_kept(t, F.abs("amount"))).cast("double"), "transaction_date", 30
    ),
    FEATURE_IDS[2]: FeatureSpec(
        "transactions", "DAILY", lambda t: F.count_distinct(_kept(t, F.col("merchant_name"))).cast("double"), "transaction_date", 30
    ),
    FEATURE_IDS[3]: FeatureSpec("accounts", "REAL_TIME", lambda t: mean(_kept(t, F.col("current_balance")))),
    FEATURE_IDS[4]: FeatureSpec(
        "cash_advances", "DAILY", lambda t: ratio(count_if(t & (F.col("advance_status") != "DEFAULTED")), count_if(t))
    ),
    FEATURE_IDS[5]: FeatureSpec(
        "transactions", "HOURLY", lambda t: mean(_kept(t, flag(F.col("fraud_score") > 0.5))), "transaction_date", 90
    ),
}


def compute_features(b, feature_ids: Sequence[str], as_of: dt.date | None = None) -> DataFrame:
    """Values of the features at ``as_of`` as (entity, feature, value, time) rows.

    Features that read the same table are one grouped pass over it.
    """
    as_of = as_of or b.as_of
    out = None
    for table in dict.fromkeys(SPECS[f].table for f in feature_ids):
        specs = {f: SPECS[f] for f in feature_ids if SPECS[f].table == table}
        tests = {
            f: F.lit(True) if s.days is None else F.col(s.date) >= days_before(as_of, s.days) for f, s in specs.items()
        }
        rows = getattr(b, table)
        if all(s.days is not None for s in specs.values()):
            widest = max(specs.values(), key=lambda s: s.days)
            rows = rows.where(F.col(widest.date) >= days_before(as_of, widest.days))
        names = {f: f"f{i}" for i, f in enumerate(specs)}
        wide = rows.groupBy("customer_id").agg(
            *[s.value(tests[f]).alias(names[f]) for f, s in specs.items()],
            *[count_if(tests[f]).alias(f"n_{names[f]}") for f in specs],
        )
        pairs = ", ".join(f"'{f}', {n}, n_{n}" for f, n in names.items())
        long = wide.select(
            F.col("customer_id").cast("string").alias("entity_id"),
            F.expr(f"stack({len(names)}, {pairs}) AS (feature_id, feature_value, n_rows)"),
        ).where("n_rows > 0")  # no row of the feature's window, no value
        out = long if out is None else out.unionByName(long)
    return out.select(
        "entity_id", F.lit("CUSTOMER").alias("entity_type"), "feature_id", "feature_value",
        moment(midnight(as_of)).alias("feature_timestamp"),
    )


def compute_batch_features(b, frequency: str, as_of: dt.date | None = None) -> DataFrame:
    """Values of all features refreshed at one frequency."""
    return compute_features(b, [f for f, s in SPECS.items() if s.frequency == frequency], as_of)


def run_batch(b, frequency: str, values_path: str, log_path: str, as_of: dt.date | None = None) -> None:
    """Compute, append to the value history by date and log one row per feature.

    A retried run replaces its own date and frequency folder, so nothing is
    appended twice.
    """
    as_of = as_of or b.as_of
    started = dt.datetime.now()
    folder = f"{values_path}/feature_date={as_of}/refresh={frequency}"
    compute_batch_features(b, frequency, as_of).write.mode("overwrite").parquet(folder)
    done = dt.datetime.now()
    written = b.spark.read.parquet(folder)
    written.groupBy("feature_id").agg(F.count("*").alias("rows_processed")).select(
        F.concat_ws("-", "feature_id", F.lit(str(as_of)), F.lit(frequency)).alias("compute_id"),
        "feature_id", moment(started).alias("compute_start"), moment(done).alias("compute_end"),
        "rows_processed", F.lit("SUCCESS").alias("compute_status"),
    ).write.mode("overwrite").parquet(f"{log_path}/run={as_of}-{frequency}")


def backfill(b, dates: Sequence[dt.date], days: int = 30) -> DataFrame:
    """The additive velocity features for many as-of dates in one job.

    Transactions are first added up per customer and day; each day then counts
    for every as-of date whose window holds it.
    """
    first, last = min(dates), max(dates)
    daily = (
        b.transactions.where(
            (F.col("status") == "COMPLETED")
            & F.col("transaction_date").between(days_before(first, days), day(last))
        )
        .groupBy("customer_id", "transaction_date")
        .agg(F.count("*").alias("n"), F.sum("amount").alias("v"), F.max("amount").alias("m"))
    )
    wanted = F.array(*[F.lit(d) for d in sorted(dates)])
    hit = F.filter(
        wanted,
        lambda d: (F.col("transaction_date") >= F.date_sub(d, days)) & (F.col("transaction_date") <= d),
    )
    return (
        daily.withColumn("as_of", F.explode(hit))
        .groupBy("customer_id", "as_of")
        .agg(F.sum("n").alias("txn_count"), F.sum("v").alias("txn_amount"), F.max("m").alias("max_amount"))
    )


# ---------------------------------------------------------------- registered feature views


def view_profile(b, as_of=None) -> DataFrame:
    return b.customers.where("customer_status = 'ACTIVE'").select(
        "customer_id", F.col("updated_at").alias("feature_timestamp"),
        "date_of_birth", "acquisition_date", "credit_score", "income_verified",
    )


def _zero(*names):
    return [F.coalesce(n, F.lit(0)).alias(n) for n in names]


def _stamped(b, features: DataFrame, names: Sequence[str], history: str) -> DataFrame:
    """Features of customers with completed transactions.

    ``as_of`` stamps them with the computation time. ``as_written`` repeats
    today's values on the time of every past transaction, which leaks the
    future into training and is kept only for comparison.
    """
    done = b.transactions.where("status = 'COMPLETED'")
    if history == "as_written":
        base = done.select("customer_id", F.col("created_at").alias("feature_timestamp")).distinct()
    else:
        base = done.select("customer_id").distinct().withColumn("feature_timestamp", moment(b.now))
    return base.join(features, "customer_id", "left").select("customer_id", "feature_timestamp", *_zero(*names))


def view_txn_pattern(b, history: str = "as_of") -> DataFrame:
    return _stamped(b, activity.txn_pattern_aggs(b), ["txn_count_7d", "txn_volume_7d", "txn_count_1h"], history)


def view_fraud(b, history: str = "as_of") -> DataFrame:
    return _stamped(b, activity.fraud_detection_aggs(b), ["has_unusual_amount", "impossible_travel_flag"], history)


def view_advance(b, as_of=None) -> DataFrame:
    active = b.customers.where("customer_status = 'ACTIVE'").select("customer_id", F.col("updated_at").alias("feature_timestamp"))
    return active.join(customers.advance_risk_aggs(b), "customer_id", "left").select(
        "customer_id", "feature_timestamp", *_zero("total_advances_taken"),
        F.coalesce("avg_advance_amount", F.lit(0.0)).alias("avg_advance_amount"), *_zero("num_defaults"),
    )


VIEWS = ViewRegistry()
for _name, _build, _refresh, _lag in (
    ("CUSTOMER_PROFILE_FEATURES", view_profile, "1 hour", "5 minutes"),
    ("TRANSACTION_PATTERN_FEATURES", view_txn_pattern, "30 minutes", "30 seconds"),
    ("ADVANCE_RISK_FEATURES", view_advance, "1 hour", "5 minutes"),
    ("FRAUD_DETECTION_FEATURES", view_fraud, "15 minutes", "30 seconds"),
):
    VIEWS.register(FeatureView(_name, "CUSTOMER", ("customer_id",), "feature_timestamp", _build, _refresh, _lag))


def refresh_view(b, name: str, offline: storage.Versions, token: str = "") -> DataFrame:
    """Full refresh of one view into its offline table."""
    offline.change(lambda _: VIEWS.get(name).build(b), token)
    return offline.read()


def sync_online(view: FeatureView, offline: DataFrame, online: storage.Versions, token: str = "") -> DataFrame:
    """Newest offline row per key as the online table."""
    online.change(lambda _: latest_per_key(offline, list(view.keys), [view.timestamp]), token)
    return online.read()


# ---------------------------------------------------------------- history and online vectors


def online_snapshot(values: DataFrame) -> DataFrame:
    """Latest value of every feature as one vector per entity."""
    newest = latest_per_key(
        values.select("entity_id", "entity_type", "feature_id", "feature_value", "feature_timestamp"),
        ["entity_id", "entity_type", "feature_id"], ["feature_timestamp"],
    )
    return newest.groupBy("entity_id", "entity_type").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature_id", "feature_value")))).alias("feature_vector"),
        F.max("feature_timestamp").alias("last_updated"),
    )


def vector_wide(values: DataFrame, feature_ids: Sequence[str]) -> DataFrame:
    """Long to wide with a fixed list of features, newest value each."""
    newest = F.max_by("feature_value", "feature_timestamp")
    return values.groupBy("entity_id", "entity_type").pivot("feature_id", list(feature_ids)).agg(newest)


def get_customer_features(online: DataFrame, wanted: DataFrame) -> DataFrame:
    """Vectors of the wanted customers; ``wanted`` holds customer_id."""
    keys = wanted.select(F.col("customer_id").cast("string").alias("entity_id"))
    rows = online.where("entity_type = 'CUSTOMER'")
    return storage.read_keys(rows, "entity_id", keys, "last_updated")


def pit_features(values: DataFrame, entities: DataFrame, feature_ids: Sequence[str], as_of: dt.datetime) -> DataFrame:
    """One vector per entity from the values known at ``as_of``."""
    known = within(values, end=as_of).where(F.col("feature_id").isin(*feature_ids)).join(entities.select("entity_id").distinct(), "entity_id", "left_semi")
    newest = asof_at(
        known.select("entity_id", "feature_id", "feature_value", "feature_timestamp"),
        ["entity_id", "feature_id"], "feature_timestamp", as_of,
    )
    return newest.groupBy("entity_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature_id", "feature_value")))).alias("features")
    )


def training_dataset(
    labels: DataFrame, values: DataFrame, feature_ids: Sequence[str], ttl: dt.timedelta | None = None
) -> DataFrame:
    """Labels with every feature as it was known at label time.

    ``labels`` holds (label_id, entity_id, label_ts, label). A label asks for each
    feature of the set; one as-of pass answers them all.
    """
    values = known_to(values, labels, ttl)
    ids = F.array(*[F.lit(f) for f in feature_ids])
    asked = labels.select("entity_id", "label_id", "label_ts", F.explode(ids).alias("feature_id"))
    found = asof_join(
        asked, values.where(F.col("feature_id").isin(*feature_ids)).select("entity_id", "feature_id", "feature_timestamp", "feature_value"),
        ["entity_id", "feature_id"], "label_id", "label_ts", "feature_timestamp", ["feature_value"], ttl,
    )
    wide = found.groupBy("label_id").agg(
        *[F.max(F.when(F.col("feature_id") == f, F.col("feature_value"))).alias(f) for f in feature_ids]
    )
    return labels.join(wide, "label_id", "left")


def training_record(
    name: str, model: str, feature_set_id: str, data: DataFrame, location: str, start: dt.date, end: dt.date,
    split: float = 0.8, stratified: bool = False,
) -> DataFrame:
    """The catalogue row describing a training set."""
    return data.agg(F.count_distinct("entity_id").alias("entity_count"), F.count("*").alias("row_count")).select(
        F.lit(f"{name}-{end}").alias("dataset_id"), F.lit(name).alias("dataset_name"), F.lit(model).alias("model_name"),
        F.lit(feature_set_id).alias("feature_set_id"), day(start).alias("start_date"), day(end).alias("end_date"),
        "entity_count", "row_count", F.lit(location).alias("dataset_location"),
        F.lit(stratified).alias("is_stratified"), F.lit(split).alias("train_test_split_ratio"),
    )


def split_rows(df: DataFrame, row_id: str, train_percent: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the row id: the same however the data is laid out."""
    d = draw(row_id, f"split-{seed}")
    return df.where(d < train_percent), df.where(d >= train_percent)


def stratified_split(df: DataFrame, row_id: str, stratum: str, train_percent: int = 80, seed: int = 42) -> DataFrame:
    """The rows with ``in_train``: of every stratum the rows with the least hashes of their ids, as many as the share asks for, to the row.

    The cut is found by counting: first by a hash's leading 16 bits, then by the next 16 where the quota is met. Only rows that
    share all 32 bits with the cut are ordered, so no class meets in one task. A null stratum is one of its own. The same rows are
    chosen however the data is laid out.
    """
    digest = F.substring(F.md5(F.concat_ws("|", F.col(row_id).cast("string"), F.lit(f"split-{seed}"))), 1, 12)
    mark = F.conv(digest, 16, 10).cast("long")
    rows = df.withColumns({"_s": F.struct(stratum), "_h": mark, "_a": F.shiftright(mark, 32), "_b": F.shiftright(mark, 16).bitwiseAND(0xFFFF)})
    sums = rows.groupBy("_s").agg(F.round(F.count("*") * train_percent / 100).cast("long").alias("_left"))

    def cut(level: str, within_rows: DataFrame, quota: DataFrame) -> DataFrame:
        """Per stratum, the value of a level at which the quota is met and what is left of it there."""
        counts = within_rows.groupBy("_s", level).agg(F.count("*").alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("_s").orderBy(level)))
        at = upto.join(quota, "_s").where((F.col("upto") >= F.col("_left")) & (F.col("upto") - F.col("n") < F.col("_left")))
        return at.select("_s", F.col(level).alias(f"{level}_cut"), (F.col("_left") - F.col("upto") + F.col("n")).alias("_left"))

    first = cut("_a", rows, sums)
    inside = rows.join(first.drop("_left"), "_s").where("_a = _a_cut")
    second = cut("_b", inside, first.select("_s", "_left")).join(first.drop("_left"), "_s")
    placed = rows.join(second, "_s", "left")
    on_cut = (F.col("_a") == F.col("_a_cut")) & (F.col("_b") == F.col("_b_cut"))
    ahead = (F.col("_a") < F.col("_a_cut")) | ((F.col("_a") == F.col("_a_cut")) & (F.col("_b") < F.col("_b_cut")))
    clear = placed.where(~F.coalesce(on_cut, F.lit(False))).withColumn("in_train", F.coalesce(ahead, F.lit(False)))
    rank = F.row_number().over(Window.partitionBy("_s").orderBy("_h", row_id))
    tied = placed.where(on_cut).withColumn("in_train", rank <= F.col("_left"))
    return clear.unionByName(tied).select(*df.columns, "in_train")


# ---------------------------------------------------------------- statistics and drift


def feature_stats(values: DataFrame) -> DataFrame:
    """Distribution of every feature per day."""
    # the folder's date, where the values are stored by day: a condition on it reaches the scan
    date = F.col(DATE) if DATE in values.columns else F.to_date("feature_timestamp")
    daily = values.withColumn("computation_date", date)
    keys = ["feature_id", "computation_date"]
    v = F.col("feature_value")
    basic = daily.groupBy(*keys).agg(
        F.avg(v).alias("mean_value"), F.stddev_samp(v).alias("std_deviation"), F.min(v).alias("min_value"), F.max(v).alias("max_value"),
        count_if(v.isNull()).alias("null_count"), F.count_distinct(v).alias("unique_count"), F.count("*").alias("total_count"),
    )
    ranks = exact_percentiles(daily, keys, "feature_value", PERCENTILES)
    rounded = ["mean_value", "std_deviation", "min_value", "max_value", *PERCENTILES]
    return basic.join(ranks, keys, "left").withColumns({c: F.round(c, 6) for c in rounded})


def drift(values: DataFrame, as_of: dt.date, lookback: int = 7, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Mean shift of the last days against the days before, per feature.

    Both periods hold the boundary moment. One pass, no per-feature loop.
    """
    at, v = F.col("feature_timestamp"), F.col("feature_value")
    edge = midnight(as_of - dt.timedelta(days=lookback))
    start = midnight(as_of - dt.timedelta(days=2 * lookback))
    before, now = at.between(moment(start), moment(edge)), at >= moment(edge)
    stats = within(values, start).groupBy("feature_id").agg(
        *[
            fn(F.when(test, v)).alias(f"{side}_{name}")
            for side, test in (("baseline", before), ("current", now))
            for name, fn in (("mean", F.avg), ("stddev", F.stddev_samp), ("min", F.min), ("max", F.max))
        ]
    )
    score = F.try_divide(F.abs(F.col("current_mean") - F.col("baseline_mean")), F.col("baseline_stddev"))
    return stats.withColumn("drift_score", score).withColumn("alert_required", F.col("drift_score") > threshold)


def monitoring_rows(values: DataFrame, as_of: dt.date, lookback: int = 7) -> DataFrame:
    """Drift checks in the shape of the monitoring table."""
    d = drift(values, as_of, lookback)

    def stats(side):
        return F.create_map(*[x for n in ("mean", "stddev", "min", "max") for x in (F.lit(n), F.col(f"{side}_{n}"))])

    return d.select(
        F.concat_ws("-", "feature_id", F.lit("DRIFT"), F.lit(str(as_of))).alias("monitor_id"), "feature_id",
        F.lit("DRIFT").alias("monitor_type"), day(as_of).alias("monitor_date"),
        stats("baseline").alias("baseline_stats"), stats("current").alias("current_stats"), "drift_score",
        F.col("alert_required").alias("alert_triggered"),
        F.when(F.col("alert_required"), "HIGH").otherwise("LOW").alias("alert_severity"),
        F.when(F.col("alert_required"), "Feature drift detected").otherwise("Feature stable").alias("alert_message"),
    )


def freshness(values: DataFrame, now: dt.datetime) -> DataFrame:
    """Minutes since the newest value of each feature."""
    return values.groupBy("feature_id").agg(F.max("feature_timestamp").alias("last_computed")).withColumn(
        "minutes_stale", date_diff("minute", "last_computed", moment(now))
    ).withColumn("freshness_status", band("minutes_stale", [(120, "CRITICAL"), (60, "WARNING")], "OK"))


def coverage(b, hours: int = 2, share: float = 0.95) -> DataFrame:
    """Whether enough active customers have a recent value, per feature."""
    recent = F.col("feature_timestamp") >= moment(b.now - dt.timedelta(hours=hours))
    seen = b.feature_values.groupBy("feature_id").agg(F.count_distinct(F.when(recent, F.col("entity_id"))).alias("actual"))
    expected = b.customers.where("customer_status = 'ACTIVE'").agg(F.count("*").alias("n"))
    counted = seen.withColumn("expected", expected.scalar())
    a, e = F.col("actual").cast("string"), F.col("expected").cast("string")
    return counted.withColumn(
        "result",
        F.when(F.col("actual") >= F.col("expected") * share, F.concat(F.lit("PASSED: "), a, F.lit(" of "), e, F.lit(" entities have features")))
        .otherwise(F.concat(F.lit("FAILED: Only "), a, F.lit(" of "), e, F.lit(" entities have features"))),
    )


def recent_runs(logs: DataFrame, status: str | None = None) -> DataFrame:
    """Runs of the compute log, newest first."""
    rows = logs if status is None else logs.where(F.col("compute_status") == status)
    return rows.orderBy(F.desc("compute_start"), F.desc("compute_id"))
