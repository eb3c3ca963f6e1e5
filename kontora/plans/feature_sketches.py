"""Mergeable states of feature values, a row per feature and day, for statistics of any range of days.

The exact statistics (``feature_stats``) read all values of the days again for every range. A state is a few KB however many values
its day has, and states add up: counts, sums and extremes exactly, quantiles and distinct counts within the bounds below.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from kontora.plans.feature_history import DATE
from kontora.sources.storage import replace_partitions

#: Size of a quantile state. The rank of an answer is off by about 1 % of the values, and by over ``RANK_BOUND`` of them hardly ever.
QUANTILE_K = 256
RANK_BOUND = 0.03
#: Registers of a distinct count, as a power of two. Its relative standard error is 1.04 / sqrt(2^12) = 1.6 %; the bound is four times that.
DISTINCT_LG = 12
DISTINCT_BOUND = 0.065
PERCENTILES = (0.25, 0.5, 0.75, 0.95, 0.99)

_FOLDER = "sketches"


def daily_states(values: DataFrame) -> DataFrame:
    """One state per feature and day of ``values``. Null values count as nulls and enter nothing else; NaN is a value like any other
    for the distinct count and is left out of the quantiles, which have no place for it."""
    v = F.col("feature_value").cast("double")
    there = F.when(~F.isnan(v), v)
    return values.groupBy("feature_id", F.to_date("feature_timestamp").alias(DATE)).agg(
        F.count("*").alias("total_count"), F.count(v).alias("value_count"), F.sum(v).alias("value_sum"),
        (F.var_pop(v) * F.count(v)).alias("square_dev"),
        F.min(v).alias("min_value"), F.max(v).alias("max_value"),
        F.kll_sketch_agg_double(there, F.lit(QUANTILE_K)).alias("quantile_state"), F.hll_sketch_agg(v.cast("string"), F.lit(DISTINCT_LG)).alias("distinct_state"),
    )


def merged(states: DataFrame, *by: str) -> DataFrame:
    """States of whatever ``by`` tells apart (nothing: one row), added up from finer ones.

    Squared deviations are moved to the common mean one state at a time (a few bytes per state), as differences of
    sums of squares would lose a small spread around a large mean.
    """
    part = F.struct(F.col("value_count").alias("n"), F.try_divide("value_sum", "value_count").alias("m"))
    added = states.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("total_count", "value_count", "value_sum", "square_dev")], F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.kll_merge_agg_double("quantile_state").alias("quantile_state"), F.hll_union_agg("distinct_state").alias("distinct_state"),
        F.collect_list(F.when(F.col("value_count") > 0, part)).alias("_parts"),
    )
    mean = F.try_divide("value_sum", "value_count")
    between = F.aggregate("_parts", F.lit(0.0), lambda a, x: a + x["n"] * (x["m"] - mean) * (x["m"] - mean))
    return added.withColumn("square_dev", F.col("square_dev") + between).drop("_parts")


def read_off(states: DataFrame, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """The statistics that states hold. Percentiles are values that occur; of a state without values all but the counts are null."""
    n, some = F.col("value_count"), F.kll_sketch_get_n_double("quantile_state") > 0
    names = [f"percentile_{round(p * 100)}" for p in percentiles]
    return states.select(
        *[c for c in states.columns if c not in ("value_count", "value_sum", "square_dev", "quantile_state", "distinct_state")],
        (F.col("total_count") - n).alias("null_count"), F.try_divide("value_sum", n).alias("mean_value"),
        F.when(n > 1, F.sqrt(F.try_divide("square_dev", n - 1))).alias("std_deviation"), F.hll_sketch_estimate("distinct_state").alias("unique_count"),
        *[F.when(some, F.kll_sketch_get_quantile_double("quantile_state", F.lit(p))).alias(c) for p, c in zip(percentiles, names)],
    )


class Sketches:
    """Daily states under ``root``, a folder per day, beside the stored history."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{_FOLDER}"

    def refresh(self, values: DataFrame, days: Sequence[dt.date] | None = None) -> None:
        """Replace the states of the named days (or all that ``values`` has); a stored history is read for those days only."""
        if days is not None:
            values = values.where((F.col(DATE) if DATE in values.columns else F.to_date("feature_timestamp")).isin(*days))
        replace_partitions(daily_states(values), self.path, DATE, days)

    def read(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """The states from ``start`` to ``end``; only those folders are read."""
        states = self.spark.read.parquet(self.path)
        if start is not None:
            states = states.where(F.col(DATE) >= F.lit(start))
        return states if end is None else states.where(F.col(DATE) <= F.lit(end))

    def statistics(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """Statistics per feature over the days from ``start`` to ``end``."""
        return read_off(merged(self.read(start, end), "feature_id"))


def held_against(stats: DataFrame, values: DataFrame, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """How far answers lie from the values they speak of, per feature: the largest error of a rank and that of the distinct count.

    A percentile's rank is any share between the values below it and the values not above it, so ties are no error.
    """
    names = [f"percentile_{round(p * 100)}" for p in percentiles]
    v = F.col("feature_value").cast("double")
    rows = values.join(stats.select("feature_id", *names), "feature_id")
    counts = rows.groupBy("feature_id").agg(
        F.count(v).alias("n"), *[F.count(F.when(v < F.col(c), 1)).alias(f"below_{c}") for c in names], *[F.count(F.when(v <= F.col(c), 1)).alias(f"upto_{c}") for c in names]
    )
    distinct = values.groupBy("feature_id").agg(F.count_distinct(v).alias("true_distinct"))
    off = [F.greatest(F.try_divide(f"below_{c}", "n") - p, p - F.try_divide(f"upto_{c}", "n"), F.lit(0.0)) for p, c in zip(percentiles, names)]
    return stats.join(counts, "feature_id").join(distinct, "feature_id").select(
        "feature_id", F.when(F.col("n") > 0, F.greatest(*off)).alias("rank_error"), F.abs(F.try_divide(F.col("unique_count"), F.col("true_distinct")) - 1).alias("distinct_error")
    )
