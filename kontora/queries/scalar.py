"""Scalar function families, each as one projection over a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from kontora.functions import scalars as S
from kontora.plans import activity
from kontora.queries.base import NOW, TODAY, query


@query("fn_string", """
SELECT customer_id, concat('CUST', lpad(CAST(customer_id AS VARCHAR), 8, '0')) AS padded, lower(acquisition_channel) AS channel,
  concat(first_name, ' ', CASE WHEN credit_score > 600 THEN 'In' ELSE 'Out' END) AS label, email LIKE '%7@%' AS sevens FROM customers""")
def fn_string(b):
    return b.customers.select(
        "customer_id", F.concat(F.lit("CUST"), F.lpad(F.col("customer_id").cast("string"), 8, "0")).alias("padded"),
        F.lower("acquisition_channel").alias("channel"),
        F.concat("first_name", F.lit(" "), F.when(F.col("credit_score") > 600, "In").otherwise("Out")).alias("label"),
        F.col("email").like("%7@%").alias("sevens"),
    )


@query("fn_date_add", """
SELECT transaction_id, transaction_timestamp + to_seconds(CAST(transaction_id % 90 AS INT)) AS plus_seconds, transaction_timestamp - INTERVAL 5 MINUTE AS minus_minutes,
  transaction_timestamp + INTERVAL 3 HOUR AS plus_hours, transaction_date + CAST(transaction_id % 40 AS INT) AS plus_days, transaction_date + 14 AS plus_weeks,
  CAST(transaction_date + INTERVAL 1 MONTH AS DATE) AS plus_month, CAST(transaction_date - INTERVAL 2 YEAR AS DATE) AS minus_years, transaction_date - 1 AS yesterday
FROM transactions""")
def fn_date_add(b):
    at, day = F.col("transaction_timestamp"), F.col("transaction_date")
    return b.transactions.select(
        "transaction_id",
        (at + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("transaction_id") % 90).cast("decimal(18,6)"))).alias("plus_seconds"),
        (at - F.expr("INTERVAL 5 MINUTES")).alias("minus_minutes"), (at + F.expr("INTERVAL 3 HOURS")).alias("plus_hours"),
        F.date_add(day, (F.col("transaction_id") % 40).cast("int")).alias("plus_days"), F.date_add(day, 14).alias("plus_weeks"),
        F.add_months(day, 1).alias("plus_month"), F.add_months(day, -24).alias("minus_years"), F.date_sub(day, 1).alias("yesterday"),
    )


@query("fn_date_diff", f"""
SELECT transaction_id, date_diff('millisecond', transaction_timestamp, {NOW}) AS ms, date_diff('second', transaction_timestamp, {NOW}) AS sec,
  date_diff('minute', transaction_timestamp, {NOW}) AS mins, date_diff('hour', transaction_timestamp, {NOW}) AS hrs, date_diff('day', transaction_date, {TODAY}) AS days,
  date_diff('month', DATE '2019-03-31', transaction_date) AS months, date_diff('year', DATE '2019-12-31', transaction_date) AS years FROM transactions""")
def fn_date_diff(b):
    at, day, now = F.col("transaction_timestamp"), F.col("transaction_date"), S.moment(b.now)
    fixed = lambda d: F.lit(d).cast("date")
    return b.transactions.select(
        "transaction_id", S.date_diff("millisecond", at, now).alias("ms"), S.date_diff("second", at, now).alias("sec"),
        S.date_diff("minute", at, now).alias("mins"), S.date_diff("hour", at, now).alias("hrs"), S.date_diff("day", day, S.day(b.as_of)).alias("days"),
        S.date_diff("month", fixed("2019-03-31"), day).alias("months"), S.date_diff("year", fixed("2019-12-31"), day).alias("years"),
    )


@query("fn_date_part", """
SELECT transaction_id, hour(transaction_timestamp)::INT AS h, strftime(transaction_date, '%a') AS day_name, dayofweek(transaction_date) IN (0, 6) AS weekend,
  CAST(transaction_timestamp AS DATE) AS d, date_trunc('hour', transaction_timestamp) AS hour_start FROM transactions""")
def fn_date_part(b):
    at = F.col("transaction_timestamp")
    return b.transactions.select(
        "transaction_id", F.hour(at).alias("h"), F.date_format("transaction_date", "E").alias("day_name"), S.is_weekend("transaction_date").alias("weekend"),
        F.to_date(at).alias("d"), F.date_trunc("hour", at).cast("timestamp_ntz").alias("hour_start"),
    )


@query("fn_now", f"SELECT account_id, {TODAY} AS as_of, {NOW} AS as_of_time, date_diff('day', opening_date, {TODAY}) AS age FROM accounts")
def fn_now(b):
    return b.accounts.select(
        "account_id", S.day(b.as_of).alias("as_of"), S.moment(b.now).alias("as_of_time"), S.date_diff("day", "opening_date", S.day(b.as_of)).alias("age")
    )


@query("fn_math", """
SELECT customer_id, CAST(abs(lifetime_value) AS DOUBLE) AS a, CAST(round(lifetime_value, 1) AS DOUBLE) AS r1, CAST(round(lifetime_value, -3) AS DOUBLE) AS r3,
  CAST(least(lifetime_value, 100) AS DOUBLE) AS lo, CAST(greatest(lifetime_value, 0) AS DOUBLE) AS hi, power(credit_score, 2) AS p, -credit_score AS neg,
  CAST(lifetime_value AS DOUBLE) / credit_score AS q, (credit_score - 300) * 2 + 1 AS s FROM customers""")
def fn_math(b):
    v, s = F.col("lifetime_value"), F.col("credit_score")
    return b.customers.select(
        "customer_id", F.abs(v).alias("a"), F.round(v, 1).alias("r1"), F.round(v, -3).alias("r3"), F.least(v, F.lit(100)).alias("lo"),
        F.greatest(v, F.lit(0)).alias("hi"), F.pow(s, F.lit(2)).alias("p"), (-s).alias("neg"), (v.cast("double") / s).alias("q"), ((s - 300) * 2 + 1).alias("s"),
    )


@query("fn_clamp", "SELECT transaction_id, least(99, greatest(1, CAST(round(CAST(abs(amount) AS DOUBLE) / 10) AS BIGINT))) / 100.0::DOUBLE AS score FROM transactions")
def fn_clamp(b):
    return b.transactions.select(
        "transaction_id", (F.least(F.lit(99), F.greatest(F.lit(1), F.round(F.abs("amount").cast("double") / 10).cast("long"))) / F.lit(100.0)).alias("score")
    )


@query("fn_null", """
SELECT a.account_id, CAST(coalesce(credit_limit, 0) AS DOUBLE) AS lim, CAST(nullif(credit_limit, 500) AS DOUBLE) AS not_500,
  CASE WHEN coalesce(credit_limit, 0) = 0 THEN 0.0::DOUBLE ELSE CAST(current_balance AS DOUBLE) / CAST(credit_limit AS DOUBLE) END AS used FROM accounts a""")
def fn_null(b):
    lim = F.col("credit_limit")
    return b.accounts.select(
        "account_id", F.coalesce(lim, F.lit(0)).alias("lim"), F.nullif(lim, F.lit(500)).alias("not_500"), S.ratio0("current_balance", lim).alias("used")
    )


def _draw(key: str, salt: str, n: int) -> str:
    return f"CAST(concat('0x', substr(md5(concat(CAST({key} AS VARCHAR), '|{salt}')), 1, 8)) AS BIGINT) % {n}"


@query("fn_random", f"SELECT customer_id, {_draw('customer_id', 'status', 100)} AS draw, 18 + {_draw('customer_id', 'age', 58)} AS age FROM customers")
def fn_random(b):
    return b.customers.select(
        "customer_id", S.draw("customer_id", "status").alias("draw"), (F.lit(18) + S.draw("customer_id", "age", 58)).alias("age")
    )


@query("fn_pick", f"SELECT customer_id, ['Main', 'Oak', 'Elm', 'Maple', 'Pine'][{_draw('customer_id', 'street', 5)} + 1] AS street, ['LOW', 'MEDIUM', 'HIGH'][customer_id % 3 + 1] AS tier FROM customers")
def fn_pick(b):
    return b.customers.select(
        "customer_id", S.pick(["Main", "Oak", "Elm", "Maple", "Pine"], S.draw("customer_id", "street", 5)).alias("street"),
        S.pick(["LOW", "MEDIUM", "HIGH"], F.col("customer_id")).alias("tier"),
    )


@query("fn_array", """
SELECT customer_id, part, array_to_string([risk_tier, kyc_status], ', ') AS joined, list_contains([risk_tier, kyc_status], 'HIGH') AS has_high, [risk_tier, kyc_status][1] AS first
FROM customers, LATERAL (SELECT unnest([risk_tier, kyc_status]) AS part)""")
def fn_array(b):
    a = F.array("risk_tier", "kyc_status")
    return b.customers.select(
        "customer_id", F.explode(a).alias("part"), F.array_join(a, ", ").alias("joined"), F.array_contains(a, "HIGH").alias("has_high"), a[0].alias("first")
    )


@query("fn_object", """
SELECT customer_id, CAST(to_json(struct_pack(score := credit_score, tier := risk_tier, risk := 'SET')) AS VARCHAR) AS inserted, credit_score AS score FROM customers""")
def fn_object(b):
    from kontora.sources.storage import overlay

    base = F.create_map(F.lit("score"), F.col("credit_score").cast("string"), F.lit("risk"), F.lit("old"))
    m = overlay(base, F.create_map(F.lit("tier"), F.col("risk_tier"), F.lit("risk"), F.lit("SET")))
    return b.customers.select("customer_id", m.alias("m")).select(
        "customer_id",
        F.to_json(F.struct(F.col("m")["score"].cast("long").alias("score"), F.col("m")["tier"].alias("tier"), F.col("m")["risk"].alias("risk"))).alias("inserted"),
        F.col("m")["score"].cast("long").alias("score"),
    )


@query("fn_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def fn_json(b):
    return b.raw("events").withColumn("v", F.parse_json("props")).select(
        "event_id", F.expr("v:k::int AS k"), F.try_variant_get("v", "$.missing", "string").alias("missing")
    )


@query("fn_cast", """
SELECT transaction_id, CAST(amount AS DOUBLE) AS f, CAST(round(amount) AS BIGINT) AS i, CAST(transaction_id AS VARCHAR) AS s, CAST(CAST(transaction_date AS VARCHAR) AS DATE) AS d,
  CAST(transaction_date AS TIMESTAMP) AS ts, CAST('True' AS BOOLEAN) AS t, TRY_CAST(merchant_city AS INT) AS bad FROM transactions""")
def fn_cast(b):
    return b.transactions.select(
        "transaction_id", F.col("amount").cast("double").alias("f"), F.round("amount").cast("long").alias("i"), F.col("transaction_id").cast("string").alias("s"),
        F.col("transaction_date").cast("string").cast("date").alias("d"), F.col("transaction_date").cast("timestamp_ntz").alias("ts"),
        F.lit("True").cast("boolean").alias("t"), F.col("merchant_city").try_cast("int").alias("bad"),
    )


_SCORE = """least(0.99, greatest(0.01, round(0.1 + CASE WHEN CAST(round(abs(amount)) AS BIGINT) > 1000 THEN 0.2 ELSE 0 END
  + CASE WHEN is_international THEN 0.15 ELSE 0 END + CASE WHEN merchant_category IN ('7995', '5933', '6010') THEN 0.25 ELSE 0 END, 2)))"""


@query("score_transaction_risk", f"SELECT transaction_id, CAST({_SCORE} AS DOUBLE) AS risk_score FROM transactions")
def score_transaction_risk(b):
    payload = b.transactions.select(
        "transaction_id",
        F.to_json(F.struct(F.abs("amount").cast("double").alias("amount"), "is_international", "merchant_category")).alias("payload"),
    )
    return activity.score_transaction_risk(payload, "payload").select("transaction_id", "risk_score")
