"""Validation checks. Every check is rows, so checks can be combined and stored."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from kontora.functions.scalars import date_diff, moment
from kontora.operators.joins import presence
from kontora.sources.storage import catalog_counts


def check_objects(required: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """PASS or FAIL for every required object."""
    return presence(required, actual, key)


def row_count(df: DataFrame, name: str, threshold: int, noun: str) -> DataFrame:
    n = F.col("actual_count").cast("string")
    return df.agg(F.count("*").alias("actual_count")).select(
        F.lit(name).alias("check_name"), "actual_count",
        F.when(F.col("actual_count") > threshold, F.concat(F.lit("PASS - "), n, F.lit(f" {noun}")))
        .otherwise(F.concat(F.lit("WARN - Only "), n, F.lit(f" {noun}"))).alias("status"),
    )


def freshness(df: DataFrame, time: str, now: dt.datetime, minutes: int = 120) -> DataFrame:
    """Minutes since the newest row of the last day."""
    recent = df.where(F.col(time) > moment(now - dt.timedelta(days=1)))
    m = F.col("minutes_since_update")
    return recent.agg(date_diff("minute", F.max(time), moment(now)).alias("minutes_since_update")).select(
        F.lit("Feature Freshness").alias("check_name"), "minutes_since_update",
        F.when(m < minutes, F.concat(F.lit("PASS - Features updated "), m.cast("string"), F.lit(" minutes ago")))
        .otherwise(F.concat(F.lit("FAIL - Features not updated for "), m.cast("string"), F.lit(" minutes"))).alias("status"),
    )


def orphans(child: DataFrame, parent: DataFrame, column: str, key: str, name: str, text: str) -> DataFrame:
    """Rows of the child whose parent is missing."""
    keys = parent.select(F.col(key).alias("_pk"))
    lost = child.join(keys, F.col(column) == F.col("_pk"), "left_anti")
    n = F.col("orphan_count")
    return lost.agg(F.count("*").alias("orphan_count")).select(
        F.lit(name).alias("check_name"), "orphan_count",
        F.when(n == 0, F.lit(f"PASS - No orphaned {text}")).otherwise(F.concat(F.lit("FAIL - "), n.cast("string"), F.lit(f" {text}"))).alias("status"),
    )


def unique_key(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """How many key values occur more than once.

    Counts are combined on the map side, so a repeated key ships one row per task.
    """
    counts = df.groupBy(*key).agg(F.count("*").alias("n"))
    return counts.agg(
        F.count("*").alias("keys"), F.sum("n").alias("rows"), F.count(F.when(F.col("n") > 1, 1)).alias("repeated_keys")
    ).select(
        F.lit(name).alias("check_name"), "keys", F.coalesce("rows", F.lit(0)).alias("rows"), "repeated_keys",
        F.when(F.col("repeated_keys") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def summary(results: Mapping[str, DataFrame]) -> DataFrame:
    """One row per category: FAIL if any of its checks failed, with a symbol."""
    out = None
    for category, df in results.items():
        row = df.agg(F.max(F.col("status").startswith("FAIL")).alias("failed")).select(
            F.lit(category).alias("category"), F.when(F.col("failed"), "FAIL").otherwise("PASS").alias("overall_status")
        )
        out = row if out is None else out.unionByName(row)
    return out.withColumn("symbol", F.when(F.col("overall_status") == "PASS", "✓").otherwise("✗"))


def checks(b) -> dict[str, DataFrame]:
    """The standard set over the banking tables."""
    counts = catalog_counts({t: getattr(b, t) for t in ("customers", "accounts", "transactions")}).where("row_count > 0")
    required = b.spark.createDataFrame([("customers",), ("accounts",), ("transactions",)], "table_name string")
    return {
        "Database Objects": check_objects(required, counts, "table_name").select("status"),
        "Data Quality": row_count(b.customers, "Customer Count", 1000, "customers").select("status"),
        "Feature Store": freshness(b.feature_values, "created_at", b.now).select("status"),
        "Foreign Keys": orphans(b.accounts, b.customers, "customer_id", "customer_id", "Orphaned Accounts", "accounts").select("status")
        .unionByName(orphans(b.transactions, b.accounts, "account_id", "account_id", "Orphaned Transactions", "transactions").select("status")),
    }
