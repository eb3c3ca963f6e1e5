"""The history of feature values and its daily statistics, stored in a folder per day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kontora.functions.scalars import moment
from kontora.sources.storage import folder_exists, replace_partitions

#: The partition column: the day of ``feature_timestamp``.
DATE = "feature_date"


class History:
    """Feature values under ``root/values`` and their statistics under ``root/statistics``, a folder per day.

    A day is replaced as a whole (dynamic partition overwrite), so a job that is run again for its days changes nothing else and
    appends nothing twice. One writer at a time per day.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def store(self, values: DataFrame, days: Sequence[dt.date] | None = None) -> None:
        """Replace the days that ``values`` has rows of or, if days are named, just those (one without rows becomes empty)."""
        replace_partitions(values.withColumn(DATE, F.to_date("feature_timestamp")), f"{self.root}/values", DATE, days)

    def read(self) -> DataFrame:
        """All values with their ``feature_date``; conditions on it choose the folders that are read."""
        return self.spark.read.parquet(f"{self.root}/values")

    def refresh_statistics(self, days: Sequence[dt.date] | None = None) -> None:
        """Compute the statistics of the named days (or all) from those days' folders alone and replace them."""
        from kontora.plans.feature_store import feature_stats

        rows = self.read()
        rows = rows if days is None else rows.where(F.col(DATE).isin(*days))
        replace_partitions(feature_stats(rows), f"{self.root}/statistics", "computation_date", days)

    def statistics(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/statistics")

    def exists(self) -> bool:
        return folder_exists(self.spark, f"{self.root}/values")


def _days_of(labels: DataFrame, ttl: dt.timedelta) -> DataFrame:
    span = F.sequence(F.to_date(F.col("label_ts") - F.lit(ttl)), F.to_date("label_ts"))
    return labels.select(F.explode(span).alias(DATE)).distinct()


def within(values: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    """Values stamped from ``start`` to ``end``; of a stored history only those days are read."""
    tests: list[Column] = []
    dated = DATE in values.columns
    if start is not None:
        tests += [F.col("feature_timestamp") >= moment(start)] + [F.col(DATE) >= F.lit(start.date())] * dated
    if end is not None:
        tests += [F.col("feature_timestamp") <= moment(end)] + [F.col(DATE) <= F.lit(end.date())] * dated
    for t in tests:
        values = values.where(t)
    return values


def known_to(values: DataFrame, labels: DataFrame, ttl: dt.timedelta | None = None) -> DataFrame:
    """The values that a label of ``labels`` (with ``label_ts``) may use, as far as days tell.

    Without ``ttl`` those are the days up to the last label's; with it, the days that reach back so far from some label, which
    Spark finds before it lists the folders to read.
    """
    if DATE not in values.columns:
        return values
    if ttl is None:
        return values.where(F.col(DATE) <= labels.agg(F.max(F.to_date("label_ts"))).scalar())
    return values.join(_days_of(labels, ttl), DATE, "left_semi")
