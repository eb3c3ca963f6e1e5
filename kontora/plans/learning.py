"""Training sets, MLlib pipelines, model registry and batch scoring."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.stat import Summarizer
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from kontora.functions.scalars import (
    count_if, date_diff, day, days_before, mean, midnight, moment, months_before,
)
from kontora.operators.joins import Child, join_children
from kontora.operators.ranking import latest_per_key
from kontora.plans.feature_store import split_rows
from kontora.session import shared_dir

#: Rows of a fit that a task passes over at most, about.
FIT_ROWS = 200_000
FRAUD, ADVANCE, LTV = "FRAUD_DETECTION_MODEL", "ADVANCE_ELIGIBILITY_MODEL", "CUSTOMER_LTV_MODEL"


# ---------------------------------------------------------------- training sets


def _dbl(name: str, default=None):
    c = F.col(name).cast("double")
    return (c if default is None else F.coalesce(c, F.lit(float(default)))).alias(name)


def train_set_fraud(b, as_of: dt.date | None = None, threshold: float = 0.7) -> DataFrame:
    """Transactions of six months with a signed amount above 10, labelled by their score."""
    as_of = as_of or b.as_of
    who = b.customers.select("customer_id", "credit_score", "risk_tier")
    held = b.accounts.select("account_id", F.col("current_balance").alias("account_balance"))
    return (
        b.transactions.where((F.col("transaction_date") >= months_before(as_of, 6)) & (F.col("amount") > 10))
        .join(who, "customer_id", "left").join(held, "account_id", "left")
        .select(
            "transaction_id", "customer_id", _dbl("amount"),
            F.coalesce("merchant_category", F.lit("UNKNOWN")).alias("merchant_category"),
            F.coalesce("transaction_type", F.lit("DEBIT")).alias("transaction_type"),
            F.coalesce("is_international", F.lit(False)).alias("is_international"),
            _dbl("credit_score", 650), F.coalesce("risk_tier", F.lit("MEDIUM")).alias("risk_tier"), _dbl("account_balance", 0),
            (F.coalesce(F.col("fraud_score").cast("double"), F.lit(0.0)) > threshold).alias("is_fraud"),
        )
    )


def _deposits(b) -> DataFrame:
    return b.direct_deposits.where("amount IS NOT NULL").groupBy("customer_id").agg(
        F.count("deposit_id").cast("double").alias("deposit_count"), mean("amount").alias("avg_deposit_amount")
    )


def train_set_advance(b, as_of: dt.date | None = None) -> DataFrame:
    """Advances of a year of customers with deposits, labelled by repayment."""
    as_of = as_of or b.as_of
    who = b.customers.where("credit_score IS NOT NULL AND risk_tier IS NOT NULL AND employment_status IS NOT NULL").select(
        "customer_id", "credit_score", "risk_tier", "employment_status"
    )
    return (
        b.cash_advances.where((F.col("advance_date") >= months_before(as_of, 12)) & F.col("eligibility_score").isNotNull())
        .join(who, "customer_id").join(_deposits(b), "customer_id")
        .select(
            "advance_id", "customer_id", _dbl("advance_amount"), _dbl("fee_amount"), _dbl("eligibility_score"), _dbl("credit_score"),
            "risk_tier", "employment_status", "deposit_count", "avg_deposit_amount", (F.col("advance_status") == "REPAID").alias("was_repaid"),
        )
    )


def _ltv_features(b, base: DataFrame, as_of: dt.date) -> DataFrame:
    children = [
        Child(b.accounts, "customer_id", {"product_count": F.count("account_id"), "avg_account_balance": mean("current_balance")}),
        Child(
            b.transactions.where(F.col("transaction_date") >= days_before(as_of, 90)), "customer_id",
            {"recent_transaction_count": F.count("transaction_id")},
        ),
        Child(b.direct_deposits, "customer_id", {"_deposits": F.count("deposit_id")}),
    ]
    return join_children(base, "customer_id", children).select(
        "customer_id", *[c for c in base.columns if c in ("lifetime_value",)],
        date_diff("month", "acquisition_date", day(as_of)).cast("double").alias("tenure_months"),
        _dbl("credit_score", 650), "risk_tier", "acquisition_channel", _dbl("product_count", 0), _dbl("avg_account_balance", 0),
        _dbl("recent_transaction_count", 0), (F.coalesce("_deposits", F.lit(0)) > 0).alias("has_direct_deposit"),
    )


def train_set_ltv(b, as_of: dt.date | None = None) -> DataFrame:
    """Active customers with a positive lifetime value."""
    base = b.customers.where("customer_status = 'ACTIVE' AND lifetime_value > 0").select(
        "customer_id", F.col("lifetime_value").cast("double").alias("lifetime_value"), "acquisition_date", "credit_score", "risk_tier",
        "acquisition_channel",
    )
    return _ltv_features(b, base, as_of or b.as_of)


# ---------------------------------------------------------------- pipelines


@dataclass(frozen=True)
class ModelSpec:
    """How one model is trained: columns, fill values, label and estimator."""

    name: str
    rows: Callable[..., DataFrame]
    row_id: str
    label: str
    categories: tuple[str, ...]
    scaled: tuple[str, ...]
    plain: tuple[str, ...]
    fill: Mapping[str, float]
    estimator: Callable[[], object]
    prediction: str


SPECS = {
    FRAUD: ModelSpec(
        FRAUD, train_set_fraud, "transaction_id", "is_fraud", ("merchant_category", "transaction_type", "risk_tier"),
        ("amount", "credit_score", "account_balance"), ("is_international",), {"account_balance": 0.0, "credit_score": 650.0},
        lambda: RandomForestClassifier(numTrees=100, maxDepth=10, seed=42, labelCol="label"), "fraud_prediction",
    ),
    ADVANCE: ModelSpec(
        ADVANCE, train_set_advance, "advance_id", "was_repaid", ("risk_tier", "employment_status"),
        ("advance_amount", "fee_amount", "eligibility_score", "credit_score", "deposit_count"), ("avg_deposit_amount",),
        {"advance_amount": 100.0, "fee_amount": 5.0, "eligibility_score": 0.5, "credit_score": 650.0, "deposit_count": 0.0, "avg_deposit_amount": 1000.0},
        lambda: LogisticRegression(labelCol="label"), "repayment_prediction",
    ),
    LTV: ModelSpec(
        LTV, train_set_ltv, "customer_id", "lifetime_value", ("risk_tier", "acquisition_channel"),
        ("tenure_months", "credit_score", "product_count", "avg_account_balance", "recent_transaction_count"), ("has_direct_deposit",),
        {"tenure_months": 1.0, "credit_score": 650.0, "product_count": 1.0, "avg_account_balance": 0.0, "recent_transaction_count": 0.0},
        lambda: GBTRegressor(maxIter=100, maxDepth=6, seed=42, labelCol="label", checkpointInterval=10), "predicted_ltv",
    ),
}


def encoders(spec: ModelSpec) -> list:
    """Category index and one-hot vector; unseen categories get a slot of their own."""
    if not spec.categories:
        return []
    return [
        StringIndexer(inputCols=list(spec.categories), outputCols=[f"{c}_ix" for c in spec.categories], handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_ix" for c in spec.categories], outputCols=[f"{c}_enc" for c in spec.categories], dropLast=False),
    ]


def scalers(spec: ModelSpec) -> list:
    return [
        VectorAssembler(inputCols=list(spec.scaled), outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="numbers_scaled", withMean=True, withStd=True),
    ]


def pipeline(spec: ModelSpec) -> Pipeline:
    inputs = [*[f"{c}_enc" for c in spec.categories], "numbers_scaled", *[f"{c}_num" for c in spec.plain]]
    return Pipeline(stages=[
        *encoders(spec), *scalers(spec), VectorAssembler(inputCols=inputs, outputCol="features"),
        spec.estimator().setPredictionCol(spec.prediction),
    ])


def prepared(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Fill gaps and give the pipeline numeric inputs."""
    df = df.na.fill({k: v for k, v in spec.fill.items() if k in df.columns})
    df = df.withColumns({f"{c}_num": F.col(c).cast("double") for c in spec.plain})
    return df.withColumn("label", F.col(spec.label).cast("double")) if spec.label in df.columns else df


def slot_inputs(scored: DataFrame, spec: ModelSpec) -> list[str]:
    """The input column behind every slot of the ``features`` vector, by the attributes that the pipeline's stages record."""
    groups = scored.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in groups.values() for a in kind}
    sources = {f"{c}_enc": c for c in spec.categories} | {f"{c}_num": c for c in spec.plain}

    def source(name: str) -> str:
        if name.startswith("numbers_scaled"):
            return spec.scaled[int(name.rpartition("_")[2])]
        # the longest match: one column's name may begin another's
        return sources[max((s for s in sources if name == s or name.startswith(f"{s}_")), key=len)]

    return [source(names[k]) for k in sorted(names)]


def importances(model: PipelineModel, scored: DataFrame, spec: ModelSpec) -> dict[str, float]:
    """Share of every input column in a fitted model, adding up to 1, the greatest first.

    Trees say what their splits gained per slot; for a linear model a slot counts by its coefficient times its spread over
    ``scored``. The slots of a column's categories are added up.
    """
    fitted, slots = model.stages[-1], slot_inputs(scored, spec)
    if hasattr(fitted, "featureImportances"):
        weights = fitted.featureImportances.toArray()
    else:
        spread = scored.select(Summarizer.std(F.col("features")).alias("s")).first().s.toArray()
        weights = abs(fitted.coefficients.toArray() * spread)
    sums = {c: 0.0 for c in slots}
    for column, w in zip(slots, weights):
        sums[column] += float(w)
    total = sum(sums.values()) or 1.0
    return dict(sorted(((c, w / total) for c, w in sums.items()), key=lambda x: (-x[1], x[0])))


def train(b, name: str) -> tuple[PipelineModel, DataFrame]:
    """Fit on four fifths of the rows; also returns the rest with predictions."""
    return fit(b.spark, SPECS[name], SPECS[name].rows(b))


def feature_spec(name: str, feature_ids: Sequence[str], label: str = "label") -> ModelSpec:
    """A forest over stored features, for rows made by ``training_dataset``; a missing value counts as 0."""
    return ModelSpec(
        name, None, "label_id", label, (), tuple(feature_ids), (), {f: 0.0 for f in feature_ids},
        lambda: RandomForestClassifier(numTrees=20, maxDepth=5, seed=42, labelCol="label"), "prediction",
    )


def _held(rows: DataFrame, spec: ModelSpec) -> DataFrame:
    """The inputs of a fit, kept while it runs and dealt over all cores.

    A fit passes over its rows hundreds of times, so the number of their parts bounds how many cores work; adaptive execution merges such
    small rows to few parts. Sorted, so that the same rows give the same parts.
    """
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // FIT_ROWS))
    wanted = dict.fromkeys([spec.row_id, *spec.categories, *spec.scaled, *(f"{c}_num" for c in spec.plain), "label"])
    return rows.select(*wanted).repartition(parts, spec.row_id).sortWithinPartitions(*wanted).persist(StorageLevel.MEMORY_AND_DISK)


def fit(spark: SparkSession, spec: ModelSpec, rows: DataFrame) -> tuple[PipelineModel, DataFrame]:
    shared_dir(spark)  # boosting cuts its lineage by checkpoints there
    fit_rows, test_rows = split_rows(rows, spec.row_id)
    held = _held(prepared(fit_rows, spec), spec)
    try:
        model = pipeline(spec).fit(held)
    finally:
        held.unpersist()
    return model, model.transform(prepared(test_rows, spec))


def score(model: PipelineModel, rows: DataFrame, name: str) -> DataFrame:
    spec = SPECS[name]
    return model.transform(prepared(rows, spec)).select(*rows.columns, spec.prediction)


def accuracy(scored: DataFrame, name: str) -> DataFrame:
    right = F.col("label") == F.col(SPECS[name].prediction)
    return scored.agg((count_if(right).cast("double") / F.count("*")).alias("accuracy"), F.count("*").alias("rows"))


def mae_rmse(scored: DataFrame, name: str) -> DataFrame:
    off = F.col("label") - F.col(SPECS[name].prediction)
    return scored.agg(F.avg(F.abs(off)).alias("mae"), F.sqrt(F.avg(off * off)).alias("rmse"), F.count("*").alias("rows"))


# ---------------------------------------------------------------- registry


class ModelStore:
    """Fitted pipelines by name and version, with their metrics and the importance of their inputs, under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def log(self, name: str, model: PipelineModel, metrics: Mapping[str, float], comment: str = "", importance: Mapping[str, float] | None = None) -> int:
        known = self.rows()
        versions = [] if known is None else known.where(F.col("model_name") == name).select("version").orderBy(F.desc("version")).limit(1).collect()
        version = versions[0].version + 1 if versions else 1
        model.write().overwrite().save(f"{self.root}/models/{name}/v{version}")
        shares = [(name, version, k, float(v)) for k, v in (importance or {}).items()]
        rows = self.spark.createDataFrame(shares, "model_name string, version int, feature_id string, feature_importance double")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/importances/{name}/v{version}")
        self.spark.createDataFrame(
            [(name, version, {k: float(v) for k, v in metrics.items()}, comment)],
            "model_name string, version int, metrics map<string,double>, comment string",
        ).write.mode("append").parquet(f"{self.root}/registry")
        return version

    def rows(self) -> DataFrame | None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        path = hadoop.Path(f"{self.root}/registry")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return self.spark.read.parquet(str(path)) if fs.exists(path) else None

    def newest(self, name: str) -> int:
        return self.rows().where(F.col("model_name") == name).agg(F.max("version")).first()[0]

    def importances(self, name: str, version: int | None = None) -> DataFrame:
        """``model_name, version, feature_id, feature_importance`` as they were fitted, for a version or the newest."""
        return self.spark.read.parquet(f"{self.root}/importances/{name}/v{version or self.newest(name)}")

    def load(self, name: str, version: int | None = None) -> PipelineModel:
        """A version, or the newest."""
        return PipelineModel.load(f"{self.root}/models/{name}/v{version or self.newest(name)}")


# ---------------------------------------------------------------- inputs for scoring whole tables


def fraud_inputs(b) -> DataFrame:
    """One row per transaction with its customer's lowest-numbered account."""
    first = latest_per_key(
        b.accounts.select("customer_id", "account_id", F.coalesce("current_balance", F.lit(0)).cast("double").alias("account_balance")),
        ["customer_id"], [-F.col("account_id")],
    ).drop("account_id")
    who = b.customers.select("customer_id", F.col("credit_score").cast("double").alias("credit_score"), "risk_tier")
    return (
        b.transactions.select("transaction_id", "customer_id", F.abs("amount").cast("double").alias("amount"), "merchant_category", "is_international")
        .join(who, "customer_id").join(first, "customer_id", "left")
        .na.fill({"account_balance": 0.0}).withColumn("transaction_type", F.lit("DEBIT"))
    )


def advance_inputs(b) -> DataFrame:
    """One row per customer: a 100 advance with a fee of 5, newest active advance's score."""
    active = latest_per_key(
        b.cash_advances.where("advance_status = 'ACTIVE'").select("customer_id", "advance_date", "advance_id", "eligibility_score"),
        ["customer_id"], ["advance_date", -F.col("advance_id")],
    )
    deposits = b.direct_deposits.groupBy("customer_id").agg(F.count("deposit_id").alias("deposit_count"), mean("amount").alias("avg_deposit_amount"))
    return (
        b.customers.select("customer_id", "credit_score", "risk_tier", "employment_status")
        .join(active, "customer_id", "left").join(deposits, "customer_id", "left")
        .select(
            "customer_id", F.lit(100.0).alias("advance_amount"), F.lit(5.0).alias("fee_amount"), _dbl("eligibility_score", 0.5), _dbl("credit_score", 650),
            "risk_tier", "employment_status", _dbl("deposit_count", 0), _dbl("avg_deposit_amount", 1000),
        )
    )


def ltv_inputs(b, as_of: dt.date | None = None) -> DataFrame:
    """One row per customer, of any status."""
    base = b.customers.select("customer_id", "acquisition_date", "credit_score", "risk_tier", "acquisition_channel")
    return _ltv_features(b, base, as_of or b.as_of)


def recommend_credit_limit(customers: DataFrame, product: str) -> DataFrame:
    """Limit by score steps, doubled for a line of credit; unknown customers get 0.

    ``customers`` holds requested customer_id and credit_score, NULL score where
    there is none, and found = whether the customer exists.
    """
    s = F.coalesce(F.col("credit_score"), F.lit(600))
    limit = F.when(s >= 750, 5000).when(s >= 700, 2500).when(s >= 650, 1000).otherwise(500)
    if product == "LINE_OF_CREDIT":
        limit = limit * 2
    return customers.select(
        "customer_id", F.lit(product).alias("product_type"), F.when(F.col("found"), limit).otherwise(0).alias("recommended_limit"),
        F.when(F.col("found"), s.cast("long")).alias("credit_score"), F.when(~F.col("found"), "CUSTOMER_NOT_FOUND").alias("reason"),
    )
