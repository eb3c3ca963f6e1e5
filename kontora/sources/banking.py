"""The banking tables as DataFrames over one parquet folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontora.functions.scalars import midnight
from kontora.session import scratch_path
from kontora.sources.mapping import AS_OF, AS_OF_ORDERS, FEATURE_IDS, MAPPING, SPARK

_HISTORIES: dict = {}
SESSION_GAP = "30 minutes"


class Bank:
    """Lazily built tables: ``bank.transactions``, ``bank.accounts``, ...

    Raw driver tables are reached by ``bank.raw(name)``. Nothing is cached; each
    attribute is a plan that the reader of it extends.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        as_of: dt.date = AS_OF,
        as_of_orders: dt.date = AS_OF_ORDERS,
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.as_of = as_of
        self.as_of_orders = as_of_orders
        self.now = midnight(as_of)
        self._plans: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._plans:
            if name in MAPPING:
                self._plans[name] = self._mapped(name)
            elif hasattr(type(self), f"_make_{name}"):
                self._plans[name] = getattr(self, f"_make_{name}")()
            else:
                raise AttributeError(name)
        return self._plans[name]

    def _mapped(self, name: str) -> DataFrame:
        spec = MAPPING[name]
        if spec.base in MAPPING or hasattr(type(self), f"_make_{spec.base}"):
            base = getattr(self, spec.base)
        else:
            base = self.raw(spec.base)
        if spec.where:
            base = base.where(SPARK.fill(spec.where))
        if spec.copies > 1:
            base = base.withColumn("k2", F.explode(F.sequence(F.lit(0), F.lit(spec.copies - 1))))
        return base.selectExpr(
            *[f"{SPARK.fill(e)} AS {c}" for c, e in spec.columns.items()]
        )

    def _make_customer_nation(self) -> DataFrame:
        return self.raw("customer").join(
            self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )

    def _make_conversation_heads(self) -> DataFrame:
        everyone = self.raw("customer").agg(F.count("*").alias("n"))
        heads = self.raw("conversations").groupBy("conv_id").agg(F.count("*").alias("n_turns"))
        return heads.withColumn("n_customers", everyone.scalar())

    def _make_device_sessions(self) -> DataFrame:
        """App sessions: events of one user with gaps of up to half an hour."""
        return (
            self.raw("events")
            .groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), SESSION_GAP).alias("w"))
            .agg(
                F.count("*").alias("actions"),
                F.max("ts").alias("last_action"),
                F.max(F.col("event_type") == "error").alias("suspicious_activity_flag"),
                F.max((F.expr(SPARK.k) % 2) == 0).alias("biometric_used"),
            )
            .select(
                F.concat_ws("-", "user_id", F.unix_seconds("w.start")).alias("session_id"),
                F.col("user_id").alias("customer_id"),
                F.concat(F.lit("D"), (F.col("user_id") % 40).cast("string")).alias("device_id"),
                F.expr(
                    "CASE user_id % 3 WHEN 0 THEN 'IOS' WHEN 1 THEN 'ANDROID' ELSE 'WEB' END"
                ).alias("device_type"),
                F.concat(F.lit("10.0.0."), (F.col("user_id") % 60).cast("string")).alias("ip_address"),
                F.concat(F.lit("S"), (F.unix_seconds("w.start") % 5).cast("string")).alias("geolocation"),
                F.col("w.start").cast("timestamp_ntz").alias("session_start"),
                F.col("last_action").alias("session_end"),
                "actions",
                "biometric_used",
                "suspicious_activity_flag",
            )
        )

    def _make_support_transcripts(self) -> DataFrame:
        from kontora.plans.retrieval import assemble_transcripts

        return assemble_transcripts(self.raw("conversations"), self.support_interactions)

    def _make_feature_values(self) -> DataFrame:
        """One row per customer, feature and day, stamped at the end of the day."""
        daily = self.transactions.groupBy("customer_id", "transaction_date").agg(
            F.count("*").cast("double").alias("n"),
            F.sum(F.abs("amount")).cast("double").alias("v"),
            F.count(F.when(F.col("fraud_score") > 0.5, 1)).cast("double").alias("f"),
        )
        long = daily.select(
            F.col("customer_id").cast("string").alias("entity_id"),
            F.lit("CUSTOMER").alias("entity_type"),
            F.expr(
                f"stack(3, '{FEATURE_IDS[0]}', n, '{FEATURE_IDS[1]}', v, '{FEATURE_IDS[5]}', f / n)"
                " AS (feature_id, feature_value)"
            ),
            (F.col("transaction_date").cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")).alias(
                "feature_timestamp"
            ),
        )
        return long.withColumn("created_at", F.col("feature_timestamp"))

    def _make_feature_statistics(self) -> DataFrame:
        from kontora.plans.feature_store import feature_stats

        return feature_stats(self.feature_history)

    def _make_feature_history(self) -> DataFrame:
        """The values as stored by day; written once per session and folder."""
        from kontora.plans.feature_history import History

        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _HISTORIES:
            history = History(self.spark, scratch_path(self.spark, "feature-history"))
            history.store(self.feature_values)
            _HISTORIES[key] = history
        return _HISTORIES[key].read()

    def _make_feature_definitions(self) -> DataFrame:
        from kontora.plans.registry import definitions

        return definitions(self.spark)

    def _make_feature_sets(self) -> DataFrame:
        from kontora.plans.registry import feature_sets

        return feature_sets(self.spark)

    def _make_model_features(self) -> DataFrame:
        from kontora.plans.registry import model_features

        return model_features(self.spark)

    def _make_online_features(self) -> DataFrame:
        from kontora.plans.feature_store import online_snapshot

        return online_snapshot(self.feature_values)
