"""Training-set, model and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from kontora.plans import feature_store as fs
from kontora.plans import learning as L
from kontora.plans import questions
from kontora.queries.base import TODAY, avg, query
from kontora.queries.features import labels_from
from kontora.session import scratch_path
from kontora.sources.mapping import FEATURE_IDS

_FITTED: dict = {}
#: A model over stored features: whether a purchase is a large one.
PURCHASES, STORED = "PURCHASE_VALUE_MODEL", (FEATURE_IDS[0], FEATURE_IDS[1], FEATURE_IDS[5])


def fitted(b, name):
    """One fit per session and data folder."""
    key = (b.spark.sparkContext.applicationId, b.folder, name)
    if key not in _FITTED:
        _FITTED[key] = L.train(b, name)
    return _FITTED[key]


_FRAUD_ROWS = f"""
SELECT t.transaction_id, t.customer_id, CAST(t.amount AS DOUBLE) AS amount, t.merchant_category, t.transaction_type, t.is_international,
  CAST(coalesce(c.credit_score, 650) AS DOUBLE) AS credit_score, coalesce(c.risk_tier, 'MEDIUM') AS risk_tier, CAST(coalesce(a.current_balance, 0) AS DOUBLE) AS account_balance,
  t.fraud_score > 0.7 AS is_fraud
FROM transactions t LEFT JOIN customers c ON t.customer_id = c.customer_id LEFT JOIN accounts a ON t.account_id = a.account_id
WHERE t.transaction_date >= {TODAY} - INTERVAL 6 MONTH AND t.amount > 10"""


@query("train_set_fraud", _FRAUD_ROWS)
def train_set_fraud(b):
    return L.train_set_fraud(b)


_ADVANCE_ROWS = f"""
SELECT ca.advance_id, ca.customer_id, CAST(ca.advance_amount AS DOUBLE) AS advance_amount, CAST(ca.fee_amount AS DOUBLE) AS fee_amount, CAST(ca.eligibility_score AS DOUBLE) AS eligibility_score,
  CAST(c.credit_score AS DOUBLE) AS credit_score, c.risk_tier, c.employment_status, CAST(count(DISTINCT dd.deposit_id) AS DOUBLE) AS deposit_count, {avg("dd.amount")} AS avg_deposit_amount,
  ca.advance_status = 'REPAID' AS was_repaid
FROM cash_advances ca JOIN customers c ON ca.customer_id = c.customer_id JOIN direct_deposits dd ON ca.customer_id = dd.customer_id
WHERE ca.advance_date >= {TODAY} - INTERVAL 12 MONTH
GROUP BY ca.advance_id, ca.customer_id, ca.advance_amount, ca.fee_amount, ca.eligibility_score, c.credit_score, c.risk_tier, c.employment_status, ca.advance_status"""


@query("train_set_advance", _ADVANCE_ROWS)
def train_set_advance(b):
    return L.train_set_advance(b)


_LTV = f"""
SELECT c.customer_id, {{extra}} CAST(date_diff('month', c.acquisition_date, {TODAY}) AS DOUBLE) AS tenure_months, CAST(c.credit_score AS DOUBLE) AS credit_score, c.risk_tier, c.acquisition_channel,
  CAST(count(DISTINCT a.account_id) AS DOUBLE) AS product_count, coalesce(min(av.b), 0) AS avg_account_balance, coalesce(min(tx.n), 0)::DOUBLE AS recent_transaction_count, coalesce(min(dx.n), 0) > 0 AS has_direct_deposit
FROM customers c LEFT JOIN accounts a ON c.customer_id = a.customer_id
LEFT JOIN (SELECT customer_id, {avg("current_balance")} AS b FROM accounts GROUP BY 1) av ON av.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n FROM transactions WHERE transaction_date >= {TODAY} - 90 GROUP BY 1) tx ON tx.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n FROM direct_deposits GROUP BY 1) dx ON dx.customer_id = c.customer_id
{{where}} GROUP BY c.customer_id, c.lifetime_value, c.acquisition_date, c.credit_score, c.risk_tier, c.acquisition_channel"""


@query("train_set_ltv", _LTV.format(extra="CAST(c.lifetime_value AS DOUBLE) AS lifetime_value,", where="WHERE c.customer_status = 'ACTIVE' AND c.lifetime_value > 0"))
def train_set_ltv(b):
    return L.train_set_ltv(b)


@query("predict_ltv_inputs", _LTV.format(extra="", where=""))
def predict_ltv_inputs(b):
    return L.ltv_inputs(b)


@query("score_fraud_inputs", """
SELECT t.transaction_id, t.customer_id, CAST(abs(t.amount) AS DOUBLE) AS amount, t.merchant_category, t.is_international, CAST(c.credit_score AS DOUBLE) AS credit_score, c.risk_tier,
  CAST(a.current_balance AS DOUBLE) AS account_balance, 'DEBIT' AS transaction_type
FROM transactions t JOIN customers c ON c.customer_id = t.customer_id
LEFT JOIN (SELECT * FROM accounts QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY account_id) = 1) a ON a.customer_id = t.customer_id""")
def score_fraud_inputs(b):
    return L.fraud_inputs(b)


@query("advance_eligibility_inputs", f"""
SELECT c.customer_id, 100.0::DOUBLE AS advance_amount, 5.0::DOUBLE AS fee_amount, CAST(coalesce(v.eligibility_score, 0.5) AS DOUBLE) AS eligibility_score, CAST(c.credit_score AS DOUBLE) AS credit_score,
  c.risk_tier, c.employment_status, CAST(coalesce(d.n, 0) AS DOUBLE) AS deposit_count, coalesce(d.a, 1000) AS avg_deposit_amount
FROM customers c LEFT JOIN (SELECT * FROM cash_advances WHERE advance_status = 'ACTIVE' QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY advance_date DESC, advance_id) = 1) v ON v.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n, {avg("amount")} AS a FROM direct_deposits GROUP BY 1) d ON d.customer_id = c.customer_id""")
def advance_eligibility_inputs(b):
    return L.advance_inputs(b)


@query("recommend_credit_limit", """
WITH asked AS (SELECT customer_id FROM customers UNION ALL SELECT max(customer_id) + 1 FROM customers)
SELECT a.customer_id, 'LINE_OF_CREDIT' AS product_type, CASE WHEN c.customer_id IS NULL THEN 0 WHEN credit_score >= 750 THEN 10000 WHEN credit_score >= 700 THEN 5000 WHEN credit_score >= 650 THEN 2000 ELSE 1000 END AS recommended_limit,
  CASE WHEN c.customer_id IS NOT NULL THEN CAST(credit_score AS BIGINT) END AS credit_score, CASE WHEN c.customer_id IS NULL THEN 'CUSTOMER_NOT_FOUND' END AS reason
FROM asked a LEFT JOIN customers c USING (customer_id)""")
def recommend_credit_limit(b):
    asked = b.customers.select("customer_id").unionByName(b.customers.agg((F.max("customer_id") + 1).alias("customer_id")))
    known = b.customers.select("customer_id", "credit_score", F.lit(True).alias("found"))
    return L.recommend_credit_limit(asked.join(known, "customer_id", "left").na.fill(False, ["found"]), "LINE_OF_CREDIT")


@query("encode_onehot", """
WITH f AS (SELECT employment_status, row_number() OVER (ORDER BY n DESC, employment_status) - 1 AS ix FROM (SELECT employment_status, count(*) AS n FROM customers GROUP BY 1))
SELECT c.customer_id, CAST(f.ix AS DOUBLE) AS category_index, CAST(f.ix AS INT) AS hot_position FROM customers c JOIN f USING (employment_status)""")
def encode_onehot(b):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    rows = b.customers.select("customer_id", "employment_status")
    model = Pipeline(stages=[
        StringIndexer(inputCol="employment_status", outputCol="category_index", handleInvalid="keep"),
        OneHotEncoder(inputCol="category_index", outputCol="enc", dropLast=False),
    ]).fit(rows)
    hot = F.array_position(vector_to_array("enc"), 1.0) - 1
    return model.transform(rows).select("customer_id", "category_index", hot.cast("int").alias("hot_position"))


@query("scale_standard", """
SELECT customer_id, round((credit_score - (SELECT avg(credit_score) FROM customers)) / (SELECT stddev_samp(credit_score) FROM customers), 6) AS credit_score_scaled FROM customers""")
def scale_standard(b):
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    rows = VectorAssembler(inputCols=["credit_score"], outputCol="v").transform(b.customers.select("customer_id", "credit_score"))
    scaled = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(rows).transform(rows)
    return scaled.select("customer_id", F.round(vector_to_array("s")[0], 6).alias("credit_score_scaled"))


@query("model_fraud_rf")
def model_fraud_rf(b):
    _, scored = fitted(b, L.FRAUD)
    return scored.select("transaction_id", "is_fraud", "fraud_prediction", F.round(vector_to_array("probability")[1], 6).alias("fraud_probability"))


@query("model_advance_lr")
def model_advance_lr(b):
    _, scored = fitted(b, L.ADVANCE)
    return scored.select("advance_id", "was_repaid", "repayment_prediction")


@query("model_ltv_gbt")
def model_ltv_gbt(b):
    _, scored = fitted(b, L.LTV)
    return scored.select("customer_id", "lifetime_value", F.round("predicted_ltv", 2).alias("predicted_ltv"))


@query("eval_accuracy")
def eval_accuracy(b):
    parts = [L.accuracy(fitted(b, n)[1], n).withColumn("model_name", F.lit(n)) for n in (L.FRAUD, L.ADVANCE)]
    return parts[0].unionByName(parts[1])


@query("eval_mae_rmse")
def eval_mae_rmse(b):
    return L.mae_rmse(fitted(b, L.LTV)[1], L.LTV).withColumn("model_name", F.lit(L.LTV))


def stored_models(b):
    """The fitted models in one store per session and folder, a version each."""
    key = (b.spark.sparkContext.applicationId, b.folder, "store")
    if key not in _FITTED:
        store = L.ModelStore(b.spark, scratch_path(b.spark, "models"))
        for name in (L.FRAUD, L.ADVANCE, L.LTV):
            model, scored = fitted(b, name)
            store.log(name, model, {}, "", L.importances(model, scored, L.SPECS[name]))
        spec = L.feature_spec(PURCHASES, STORED)
        model, scored = L.fit(b.spark, spec, fs.training_dataset(labels_from(b), b.feature_history, STORED))
        store.log(PURCHASES, model, {}, "", L.importances(model, scored, spec))
        _FITTED[key] = store
    return _FITTED[key]


@query("model_importances")
def model_importances(b):
    store, out = stored_models(b), None
    for name in (L.FRAUD, L.ADVANCE, L.LTV, PURCHASES):
        out = store.importances(name) if out is None else out.unionByName(store.importances(name))
    return out


@query("q_drift_impact_fitted")
def q_drift_impact_fitted(b):
    return questions.drift_impact_fitted(b, stored_models(b).importances(PURCHASES))


# A prediction has no SQL, but which rows are held out, their labels, and that every one has a prediction of the right kind does.
_TESTED = "CAST(concat('0x', substr(md5(concat(CAST({} AS VARCHAR), '|split-42')), 1, 8)) AS BIGINT) % 100 >= 80"


def _held_out(rows, row_id, label):
    return f"SELECT {row_id}, {label}, true AS sound FROM ({rows}) t WHERE {_TESTED.format(row_id)}"


def _sure(prediction):
    """A class that is the likelier one."""
    p = vector_to_array("probability")
    return F.col(prediction) == F.when(p[1] > p[0], 1.0).otherwise(0.0)


@query("model_fraud_rf_facts", _held_out(_FRAUD_ROWS, "transaction_id", "is_fraud"))
def model_fraud_rf_facts(b):
    return fitted(b, L.FRAUD)[1].select("transaction_id", "is_fraud", _sure("fraud_prediction").alias("sound"))


@query("model_advance_lr_facts", _held_out(_ADVANCE_ROWS, "advance_id", "was_repaid"))
def model_advance_lr_facts(b):
    return fitted(b, L.ADVANCE)[1].select("advance_id", "was_repaid", _sure("repayment_prediction").alias("sound"))


@query("model_ltv_gbt_facts", _held_out(_LTV.format(extra="CAST(c.lifetime_value AS DOUBLE) AS lifetime_value,", where="WHERE c.customer_status = 'ACTIVE' AND c.lifetime_value > 0"), "customer_id", "lifetime_value"))
def model_ltv_gbt_facts(b):
    sound = F.col("predicted_ltv").isNotNull() & ~F.isnan("predicted_ltv")
    return fitted(b, L.LTV)[1].select("customer_id", "lifetime_value", sound.alias("sound"))


@query("scored_rows_facts", """
SELECT 'fraud' AS scores, count(*) AS n, count(DISTINCT transaction_id) AS ids, CAST(sum(abs(amount)) AS DOUBLE) AS carried FROM transactions t JOIN customers c USING (customer_id)
UNION ALL SELECT 'eligibility', count(*), count(DISTINCT customer_id), CAST(sum(customer_id) AS DOUBLE) FROM customers
UNION ALL SELECT 'lifetime', count(*), count(DISTINCT customer_id), CAST(sum(customer_id) AS DOUBLE) FROM customers""")
def scored_rows_facts(b):
    """Scoring keeps every row with its inputs."""
    out = None
    for name, rows, model, key, carried in (
        ("fraud", L.fraud_inputs(b), L.FRAUD, "transaction_id", F.col("amount").cast("decimal(38,2)")),
        ("eligibility", L.advance_inputs(b), L.ADVANCE, "customer_id", F.col("customer_id")),
        ("lifetime", L.ltv_inputs(b), L.LTV, "customer_id", F.col("customer_id")),
    ):
        scored = L.score(fitted(b, model)[0], rows, model).where(F.col(L.SPECS[model].prediction).isNotNull())
        one = scored.agg(F.count("*").alias("n"), F.count_distinct(key).alias("ids"), F.sum(carried).cast("double").alias("carried")).withColumn("scores", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("model_registry_facts", f"""
SELECT m AS model_name, CAST(1 AS INT) AS version, CAST(n AS BIGINT) AS inputs, 1.0::DOUBLE AS total
FROM (VALUES ('{L.FRAUD}', 7), ('{L.ADVANCE}', 8), ('{L.LTV}', 8), ('{PURCHASES}', 3)) x(m, n)""")
def model_registry_facts(b):
    """Versions, and that a model's importances name each of its inputs and add up to one."""
    shares = model_importances(b).groupBy("model_name", "version").agg(F.count_distinct("feature_id").alias("inputs"), F.round(F.sum("feature_importance"), 9).alias("total"))
    return stored_models(b).rows().select("model_name", "version").join(shares, ["model_name", "version"])


@query("model_registry")
def model_registry(b):
    store = L.ModelStore(b.spark, scratch_path(b.spark, "models"))
    model, scored = fitted(b, L.ADVANCE)
    acc = L.accuracy(scored, L.ADVANCE).first().accuracy
    for _ in range(2):
        store.log(L.ADVANCE, model, {"accuracy": acc}, "repayment")
    newest = store.load(L.ADVANCE)
    n = L.score(newest, L.advance_inputs(b), L.ADVANCE).agg(F.count("*").alias("n"))
    return store.rows().select("model_name", "version", F.col("metrics")["accuracy"].alias("accuracy")).withColumn("scored_rows", n.scalar())


@query("score_fraud_model")
def score_fraud_model(b):
    out = L.score(fitted(b, L.FRAUD)[0], L.fraud_inputs(b), L.FRAUD)
    return out.select("transaction_id", "customer_id", "amount", (F.col("fraud_prediction") == 1).alias("is_fraud_predicted"))


@query("advance_eligibility")
def advance_eligibility(b):
    out = L.score(fitted(b, L.ADVANCE)[0], L.advance_inputs(b), L.ADVANCE)
    return out.select("customer_id", (F.col("repayment_prediction") == 1).alias("is_eligible"))


@query("predict_ltv")
def predict_ltv(b):
    out = L.score(fitted(b, L.LTV)[0], L.ltv_inputs(b), L.LTV)
    return out.select("customer_id", F.round("predicted_ltv", 2).alias("predicted_ltv"))


@query("batch_score")
def batch_score(b):
    """Share of customers predicted to repay, by risk tier."""
    out = L.score(fitted(b, L.ADVANCE)[0], L.advance_inputs(b), L.ADVANCE)
    return out.groupBy("risk_tier").agg(F.count("*").alias("n"), F.sum("repayment_prediction").alias("will_repay"))
