"""Scans, writes, projections, filters and joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kontora.functions import scalars as S
from kontora.operators import joins as J
from kontora.operators.ranking import latest_per_key, sample_share
from kontora.plans.feature_history import known_to
from kontora.queries.base import NOW, TODAY, TODAY_ORDERS, avg, query, total
from kontora.schemas import TABLES
from kontora.session import scratch_path
from kontora.sources import storage
from kontora.sources.mapping import FEATURE_IDS

# ---------------------------------------------------------------- scans and writes


@query("scan_table", "SELECT account_id, customer_id, account_type, CAST(current_balance AS DOUBLE) AS current_balance FROM accounts")
def scan_table(b):
    return b.accounts.select("account_id", "customer_id", "account_type", "current_balance")


# Advance amount to fee (fixed values).
FEE_LADDER = [(20, 0), (50, 3), (100, 5), (250, 12), (500, 25)]


@query("inline_values", """
SELECT a.advance_id, v.tier_amount, v.tier_fee, CAST(a.fee_amount AS DOUBLE) AS fee_amount
FROM cash_advances a JOIN (VALUES (20, 0), (50, 3), (100, 5), (250, 12), (500, 25)) v(tier_amount, tier_fee) ON a.advance_amount = v.tier_amount""")
def inline_values(b):
    tiers = b.spark.createDataFrame(FEE_LADDER, "tier_amount int, tier_fee int")
    return b.cash_advances.join(tiers, F.col("advance_amount") == F.col("tier_amount")).select(
        "advance_id", "tier_amount", "tier_fee", "fee_amount"
    )


@query("generate_rows", f"""
SELECT {TODAY} - CAST(i AS INT) AS day, coalesce(n, 0) AS transactions
FROM range(0, 60) g(i) LEFT JOIN (SELECT transaction_date, count(*) AS n FROM transactions GROUP BY 1) d ON d.transaction_date = {TODAY} - CAST(i AS INT)""")
def generate_rows(b):
    days = b.spark.range(60).select(F.date_sub(S.day(b.as_of), F.col("id").cast("int")).alias("day"))
    daily = b.transactions.groupBy("transaction_date").agg(F.count("*").alias("n"))
    return days.join(daily, F.col("day") == F.col("transaction_date"), "left").select(
        "day", F.coalesce("n", F.lit(0)).alias("transactions")
    )


@query("multiply_rows", "SELECT customer_id, i AS copy FROM customers, (VALUES (1), (2), (3)) v(i)")
def multiply_rows(b):
    return b.customers.select("customer_id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("copy"))


@query("literal_row", """
SELECT status, count(*) AS n, 'observed' AS origin FROM transactions GROUP BY 1 UNION ALL SELECT 'REVERSED', 0, 'declared'""")
def literal_row(b):
    seen = b.transactions.groupBy("status").agg(F.count("*").alias("n")).withColumn("origin", F.lit("observed"))
    row = b.spark.range(1).select(
        F.lit("REVERSED").alias("status"), F.lit(0).cast("long").alias("n"), F.lit("declared").alias("origin")
    )
    return seen.unionByName(row)


@query("temp_table", f"""
SELECT a.account_type, count(*) AS accounts, {total("a.current_balance")} AS balance FROM accounts a JOIN customers c USING (customer_id)
WHERE c.customer_status = 'ACTIVE' GROUP BY 1
UNION ALL SELECT 'ALL', count(*), {total("a.current_balance")} FROM accounts a JOIN customers c USING (customer_id) WHERE c.customer_status = 'ACTIVE'""")
def temp_table(b):
    path = scratch_path(b.spark, "active-accounts")
    active = b.customers.where("customer_status = 'ACTIVE'").select("customer_id")
    storage.reload_table(b.accounts.join(active, "customer_id").select("account_type", "current_balance"), path)
    t = b.spark.read.parquet(path)
    sums = [F.count("*").alias("accounts"), F.sum("current_balance").alias("balance")]
    return t.groupBy("account_type").agg(*sums).unionByName(
        t.agg(*sums).select(F.lit("ALL").alias("account_type"), "accounts", "balance")
    )


@query("append_insert", """
SELECT CAST(account_id AS VARCHAR) AS account_id, account_type, CAST(current_balance AS DOUBLE) AS current_balance,
  CAST(available_balance AS DOUBLE) AS available_balance, CAST(credit_limit AS DOUBLE) AS credit_limit, account_status FROM accounts""")
def append_insert(b):
    path = scratch_path(b.spark, "accounts")
    # column order differs from the table's; rows go in by name, in two appends
    rows = b.accounts.select("account_id", "account_type", "credit_limit", "current_balance", "available_balance", "account_status")
    storage.append_rows(rows.where("account_type = 'CHECKING'"), path, "accounts", b.now)
    storage.append_rows(rows.where("account_type <> 'CHECKING'"), path, "accounts", b.now)
    return storage.scan_table(b.spark, path, "accounts").select(
        "account_id", "account_type", "current_balance", "available_balance", "credit_limit", "account_status"
    )


@query("apply_defaults", f"""
SELECT CAST(customer_id AS VARCHAR) AS customer_id, 'ACTIVE' AS customer_status, kyc_status, 0.0::DOUBLE AS lifetime_value, {NOW} AS created_at FROM customers""")
def apply_defaults(b):
    given = b.customers.select("customer_id", "kyc_status")
    return storage.prepared(given, "customers", b.now).select(
        "customer_id", "customer_status", "kyc_status", "lifetime_value", "created_at"
    )


@query("update_where", """
SELECT card_id, account_id, CASE WHEN card_status IN ('LOST', 'STOLEN') THEN 'INACTIVE' ELSE card_status END AS card_status FROM cards""")
def update_where(b):
    return storage.update_where(
        b.cards.select("card_id", "account_id", "card_status"),
        F.col("card_status").isin("LOST", "STOLEN"), {"card_status": F.lit("INACTIVE")},
    )


@query("truncate_reload", "SELECT deposit_type, count(*) AS n FROM direct_deposits GROUP BY 1")
def truncate_reload(b):
    path = scratch_path(b.spark, "deposits")
    for _ in range(2):  # loading twice leaves one copy
        storage.reload_table(b.direct_deposits.select("deposit_id", "deposit_type"), path)
    return b.spark.read.parquet(path).groupBy("deposit_type").agg(F.count("*").alias("n"))


@query("merge_upsert", f"""
WITH t AS (SELECT customer_id, count(*) AS n, max(transaction_timestamp) AS seen FROM transactions WHERE transaction_date < {TODAY} - 10 GROUP BY 1),
s AS (SELECT customer_id, count(*) AS n, CAST(max(amount) AS DOUBLE) AS m FROM transactions WHERE transaction_timestamp >= {NOW} - INTERVAL 1 HOUR GROUP BY 1)
SELECT CAST(coalesce(t.customer_id, s.customer_id) AS VARCHAR) AS entity_id, CAST(t.n AS DOUBLE) AS total_count,
  CAST(s.n AS DOUBLE) AS transaction_count_1h, s.m AS max_amount_1h,
  CASE WHEN s.customer_id IS NULL THEN t.seen ELSE {NOW} END AS last_updated
FROM t FULL JOIN s ON t.customer_id = s.customer_id""")
def merge_upsert(b):
    who = [F.col("customer_id").cast("string").alias("entity_id"), F.lit("CUSTOMER").alias("entity_type")]
    old = b.transactions.where(F.col("transaction_date") < S.days_before(b.as_of, 10)).groupBy("customer_id").agg(
        F.count("*").cast("double").alias("n"), F.max("transaction_timestamp").alias("last_updated")
    ).select(*who, F.create_map(F.lit("total_count"), "n").alias("feature_vector"), "last_updated")
    new = b.transactions.where(F.col("transaction_timestamp") >= S.moment(b.now - dt.timedelta(hours=1))).groupBy("customer_id").agg(
        F.count("*").cast("double").alias("n"), F.max("amount").cast("double").alias("m")
    ).select(
        *who,
        F.create_map(F.lit("transaction_count_1h"), "n", F.lit("max_amount_1h"), "m").alias("feature_vector"),
        S.moment(b.now).alias("last_updated"),
    )
    merged = storage.merge_online(old, new, b.now)
    v = F.col("feature_vector")
    return merged.select(
        "entity_id", *[v[k].alias(k) for k in ("total_count", "transaction_count_1h", "max_amount_1h")], "last_updated"
    )


@query("retention_delete", f"""
SELECT CASE WHEN feature_timestamp < {NOW} - INTERVAL 14 DAY THEN 'archived' ELSE 'kept' END AS place, feature_id, count(*) AS n
FROM feature_values GROUP BY 1, 2""")
def retention_delete(b):
    kept, old = storage.split_by_age(b.feature_values, "feature_timestamp", b.now - dt.timedelta(days=14))
    archive = scratch_path(b.spark, "archive")
    table = scratch_path(b.spark, "feature-values")
    storage.reload_table(old, archive)  # the archive is complete before rows are dropped
    storage.reload_table(kept, table)

    def counted(path, place):
        return b.spark.read.parquet(path).groupBy("feature_id").agg(F.count("*").alias("n")).withColumn("place", F.lit(place))

    return counted(table, "kept").unionByName(counted(archive, "archived")).select("place", "feature_id", "n")


@query("create_view", f"""
SELECT customer_state, count(*) AS customers, {avg("credit_score")} AS avg_score FROM (SELECT address_state AS customer_state, credit_score FROM customers) GROUP BY 1""")
def create_view(b):
    b.customers.select(F.col("address_state").alias("customer_state"), "credit_score").createOrReplaceTempView("customer_states")
    return b.spark.sql(
        "SELECT customer_state, count(*) AS customers, CAST(sum(credit_score) AS DOUBLE) / count(credit_score) AS avg_score "
        "FROM customer_states GROUP BY customer_state"
    )


@query("materialize_snapshot", f"""
SELECT customer_id, {NOW} AS feature_timestamp, count(*) AS txn_count_30d, {total("amount")} AS txn_amount_30d
FROM transactions WHERE transaction_date >= {TODAY} - 30 AND status = 'COMPLETED' GROUP BY customer_id""")
def materialize_snapshot(b):
    from kontora.plans.activity import txn_velocity_30d

    table = storage.Versions(b.spark, scratch_path(b.spark, "velocity"))
    for as_of in (b.as_of - dt.timedelta(days=1), b.as_of):  # two refreshes; readers see the newest
        table.publish(txn_velocity_30d(b, as_of), token=str(as_of))
    return table.read().select("customer_id", "feature_timestamp", "txn_count_30d", "txn_amount_30d")


_COUNTED = ["customers", "accounts", "transactions", "cards", "direct_deposits", "cash_advances", "support_interactions",
            "merchant_categories", "marketing_campaigns", "customer_campaigns", "external_data", "credit_applications",
            "compliance_events"]


@query("catalog_scan", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED))
def catalog_scan(b):
    return storage.catalog_counts({t: getattr(b, t) for t in _COUNTED})


_SECS = "date_diff('second', compute_start, compute_end)"


@query("usage_log_scan", f"""
SELECT pool, CAST(compute_start AS DATE) AS usage_date, {total("credits_used")} AS daily_credits, count(DISTINCT compute_id) AS query_count,
  {avg(_SECS)} AS avg_query_seconds, max({_SECS}) AS max_query_seconds
FROM feature_compute_logs GROUP BY 1, 2""")
def usage_log_scan(b):
    seconds = S.date_diff("second", "compute_start", "compute_end")
    return b.feature_compute_logs.groupBy("pool", F.to_date("compute_start").alias("usage_date")).agg(
        F.sum("credits_used").alias("daily_credits"), F.count_distinct("compute_id").alias("query_count"),
        S.mean(seconds).alias("avg_query_seconds"), F.max(seconds).alias("max_query_seconds"),
    )


@query("json_result", """
SELECT customer_id, CAST(to_json(struct_pack(customer_id := customer_id, transaction_count := count(*), last_date := CAST(max(transaction_date) AS VARCHAR))) AS VARCHAR) AS result
FROM transactions GROUP BY customer_id""")
def json_result(b):
    grouped = b.transactions.groupBy("customer_id").agg(
        F.count("*").alias("transaction_count"), F.max("transaction_date").cast("string").alias("last_date")
    )
    return grouped.select("customer_id", F.to_json(F.struct("customer_id", "transaction_count", "last_date")).alias("result"))


@query("read_wide_row", """
SELECT o.entity_id, o.last_updated, o.customer_txn_count_30d, o.customer_txn_amount_30d
FROM online_features o WHERE o.entity_id IN (SELECT CAST(customer_id AS VARCHAR) FROM customers WHERE risk_tier = 'HIGH')""")
def read_wide_row(b):
    wanted = b.customers.where("risk_tier = 'HIGH'").select(F.col("customer_id").cast("string").alias("entity_id"))
    rows = storage.read_keys(b.online_features.drop("entity_type"), "entity_id", wanted, "last_updated")
    v = F.col("feature_vector")
    return rows.select("entity_id", "last_updated", v[FEATURE_IDS[0]].alias(FEATURE_IDS[0]), v[FEATURE_IDS[1]].alias(FEATURE_IDS[1]))


# ---------------------------------------------------------------- projections and filters


@query("project_alias", """
SELECT transaction_id AS id, concat(first_name, ' / ', merchant_name) AS label, CAST(amount AS DOUBLE) AS signed_amount, CAST(abs(amount) * 2 AS DOUBLE) AS doubled
FROM transactions JOIN customers USING (customer_id)""")
def project_alias(b):
    return b.transactions.join(b.customers, "customer_id").select(
        F.col("transaction_id").alias("id"), F.concat("first_name", F.lit(" / "), "merchant_name").alias("label"),
        F.col("amount").alias("signed_amount"), (F.abs("amount") * 2).alias("doubled"),
    )


@query("star_plus", "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount), deposit_date > expected_date - 1 AS on_time FROM direct_deposits")
def star_plus(b):
    return b.direct_deposits.select("*", (F.col("deposit_date") > F.date_sub("expected_date", 1)).alias("on_time"))


@query("star_dedupe", "SELECT a.* REPLACE (CAST(current_balance AS DOUBLE) AS current_balance, CAST(available_balance AS DOUBLE) AS available_balance, CAST(credit_limit AS DOUBLE) AS credit_limit, CAST(apy_rate AS DOUBLE) AS apy_rate), c.risk_tier FROM accounts a JOIN customers c ON a.customer_id = c.customer_id")
def star_dedupe(b):
    c = b.customers.select(F.col("customer_id").alias("cust_id"), "risk_tier")
    return b.accounts.join(c, F.col("customer_id") == F.col("cust_id")).drop("cust_id")


@query("lateral_alias", """
SELECT advance_id, CAST(advance_amount + fee_amount AS DOUBLE) AS owed, CASE WHEN advance_amount + fee_amount > 200 THEN 'LARGE' ELSE 'SMALL' END AS size FROM cash_advances""")
def lateral_alias(b):
    return b.cash_advances.selectExpr(
        "advance_id", "advance_amount + fee_amount AS owed", "CASE WHEN owed > 200 THEN 'LARGE' ELSE 'SMALL' END AS size"
    )


@query("distinct_rows", "SELECT DISTINCT customer_id, transaction_category, merchant_state FROM transactions")
def distinct_rows(b):
    return b.transactions.select("customer_id", "transaction_category", "merchant_state").distinct()


@query("filter_cmp", """
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, status FROM transactions
WHERE (amount < -500 AND status = 'COMPLETED') OR (amount >= 4000 AND status <> 'COMPLETED') OR fraud_score <= 0.05""")
def filter_cmp(b):
    a, s = F.col("amount"), F.col("status")
    return b.transactions.where(
        ((a < -500) & (s == "COMPLETED")) | ((a >= 4000) & (s != "COMPLETED")) | (F.col("fraud_score") <= F.expr("0.05"))
    ).select("transaction_id", "amount", "status")


@query("filter_in_list", "SELECT card_id, card_status FROM cards WHERE card_status IN ('LOST', 'STOLEN', 'DAMAGED')")
def filter_in_list(b):
    return b.cards.where(F.col("card_status").isin("LOST", "STOLEN", "DAMAGED")).select("card_id", "card_status")


@query("filter_in_subquery", "SELECT customer_id, risk_tier FROM customers WHERE customer_id IN (SELECT customer_id FROM cash_advances WHERE advance_status = 'DEFAULTED')")
def filter_in_subquery(b):
    bad = b.cash_advances.where("advance_status = 'DEFAULTED'").select("customer_id")
    return b.customers.select("customer_id", "risk_tier").join(bad, "customer_id", "left_semi")


@query("filter_between", f"""
SELECT transaction_id, transaction_date FROM transactions WHERE transaction_date BETWEEN {TODAY} - 14 AND {TODAY} - 7 AND abs(amount) BETWEEN 100 AND 1000""")
def filter_between(b):
    return b.transactions.where(
        F.col("transaction_date").between(S.days_before(b.as_of, 14), S.days_before(b.as_of, 7)) & F.abs("amount").between(100, 1000)
    ).select("transaction_id", "transaction_date")


@query("filter_null", "SELECT deposit_id, employer_name FROM direct_deposits WHERE employer_name IS NULL OR (employer_name IS NOT NULL AND amount > 200)")
def filter_null(b):
    e = F.col("employer_name")
    return b.direct_deposits.where(e.isNull() | (e.isNotNull() & (F.col("amount") > 200))).select("deposit_id", "employer_name")


@query("filter_like", "SELECT transaction_id, description FROM transactions WHERE description LIKE 'pur%' OR description LIKE '%77%'")
def filter_like(b):
    d = F.col("description")
    return b.transactions.where(d.like("pur%") | d.like("%77%")).select("transaction_id", "description")


@query("filter_rolling", f"""
SELECT '1h' AS span, count(*) AS n FROM transactions WHERE transaction_timestamp >= {NOW} - INTERVAL 1 HOUR
UNION ALL SELECT '24h', count(*) FROM transactions WHERE transaction_timestamp >= {NOW} - INTERVAL 24 HOUR
UNION ALL SELECT '7d', count(*) FROM transactions WHERE transaction_date >= {TODAY} - 7
UNION ALL SELECT '30d', count(*) FROM transactions WHERE transaction_date >= {TODAY} - 30
UNION ALL SELECT '6m', count(*) FROM transactions WHERE transaction_date >= {TODAY} - INTERVAL 6 MONTH""")
def filter_rolling(b):
    at, date = F.col("transaction_timestamp"), F.col("transaction_date")
    spans = {
        "1h": at >= S.moment(b.now - dt.timedelta(hours=1)),
        "24h": at >= S.moment(b.now - dt.timedelta(hours=24)),
        "7d": date >= S.days_before(b.as_of, 7),
        "30d": date >= S.days_before(b.as_of, 30),
        "6m": date >= S.months_before(b.as_of, 6),
    }
    # one pass for all spans, then one row per span
    wide = b.transactions.agg(*[S.count_if(t).alias(n) for n, t in spans.items()])
    return wide.unpivot([], [F.col(f"`{n}`") for n in spans], "span", "n")


@query("filter_validity", f"SELECT account_id FROM accounts WHERE opening_date <= {TODAY} - 200 AND (closing_date IS NULL OR closing_date >= {TODAY} - 200)")
def filter_validity(b):
    d = S.days_before(b.as_of, 200)
    return b.accounts.where((F.col("opening_date") <= d) & (F.col("closing_date").isNull() | (F.col("closing_date") >= d))).select("account_id")


@query("filter_sample", "SELECT transaction_id FROM transactions WHERE CAST(concat('0x', substr(md5(concat(CAST(transaction_id AS VARCHAR), '|share')), 1, 8)) AS BIGINT) % 100 < 20")
def filter_sample(b):
    return sample_share(b.transactions.select("transaction_id"), "transaction_id", 20)


@query("case_searched", "SELECT customer_id, CASE WHEN credit_score >= 750 THEN 'EXCELLENT' WHEN credit_score >= 700 THEN 'GOOD' WHEN credit_score >= 650 THEN 'FAIR' ELSE 'POOR' END AS score_band FROM customers")
def case_searched(b):
    return b.customers.select(
        "customer_id", S.band("credit_score", [(750, "EXCELLENT"), (700, "GOOD"), (650, "FAIR")], "POOR", ">=").alias("score_band")
    )


@query("case_simple", "SELECT deposit_id, CASE frequency WHEN 'WEEKLY' THEN 7 WHEN 'BIWEEKLY' THEN 14 ELSE 30 END AS period_days FROM direct_deposits")
def case_simple(b):
    f = F.col("frequency")
    return b.direct_deposits.select("deposit_id", F.when(f == "WEEKLY", 7).when(f == "BIWEEKLY", 14).otherwise(30).alias("period_days"))


@query("bool_column", "SELECT account_id, credit_limit > 1000 AS high_limit, auto_save_enabled AND NOT overdraft_protection AS saver FROM accounts")
def bool_column(b):
    return b.accounts.select(
        "account_id", (F.col("credit_limit") > 1000).alias("high_limit"),
        (F.col("auto_save_enabled") & ~F.col("overdraft_protection")).alias("saver"),
    )


@query("scalar_subquery", """
SELECT (SELECT count(*) FROM customers) AS customer_count, (SELECT count(*) FROM accounts) AS account_count,
  (SELECT count(*) FROM transactions) AS transaction_count, (SELECT count(*) FROM cash_advances) AS advance_count""")
def scalar_subquery(b):
    names = {"customer_count": b.customers, "account_count": b.accounts, "transaction_count": b.transactions, "advance_count": b.cash_advances}
    return b.spark.range(1).select(*[df.agg(F.count("*")).scalar().alias(n) for n, df in names.items()])


@query("exists_check", "SELECT EXISTS (SELECT 1 FROM transactions WHERE fraud_score > 0.95) AS any_high, EXISTS (SELECT 1 FROM transactions WHERE fraud_score > 2) AS any_impossible")
def exists_check(b):
    def any_row(test):
        return F.coalesce(b.transactions.where(test).limit(1).agg(F.count("*") > 0).scalar(), F.lit(False))

    return b.spark.range(1).select(
        any_row("fraud_score > 0.95").alias("any_high"), any_row("fraud_score > 2").alias("any_impossible")
    )


@query("null_fill", "SELECT deposit_id, coalesce(employer_name, 'Transfer') AS employer_name, CAST(coalesce(a.credit_limit, 650) AS DOUBLE) AS credit_limit FROM direct_deposits JOIN accounts a USING (account_id)")
def null_fill(b):
    return (
        b.direct_deposits.select("deposit_id", "account_id", "employer_name")
        .join(b.accounts.select("account_id", F.col("credit_limit").cast("double")), "account_id")
        .na.fill({"employer_name": "Transfer", "credit_limit": 650.0}).drop("account_id")
    )


@query("drop_columns", "SELECT deposit_type, frequency, is_recurring, CAST(amount AS DOUBLE) AS amount FROM direct_deposits")
def drop_columns(b):
    return b.direct_deposits.select("deposit_id", "customer_id", "deposit_type", "frequency", "is_recurring", "amount").drop("deposit_id", "customer_id")


# ---------------------------------------------------------------- joins


@query("join_inner", "SELECT a.account_id, a.account_type, c.customer_status FROM accounts a JOIN customers c ON a.customer_id = c.customer_id")
def join_inner(b):
    return b.accounts.join(b.customers, "customer_id").select("account_id", "account_type", "customer_status")


@query("join_left", "SELECT a.account_id, k.card_id, k.card_status FROM accounts a LEFT JOIN cards k ON a.account_id = k.account_id")
def join_left(b):
    return b.accounts.join(b.cards.select("account_id", "card_id", "card_status"), "account_id", "left").select("account_id", "card_id", "card_status")


@query("join_left_filtered", f"""
SELECT c.customer_id, count(t.transaction_id) AS recent FROM customers c
LEFT JOIN transactions t ON t.customer_id = c.customer_id AND t.transaction_date >= {TODAY} - 7 GROUP BY 1""")
def join_left_filtered(b):
    recent = (
        b.transactions.where(F.col("transaction_date") >= S.days_before(b.as_of, 7))
        .groupBy("customer_id").agg(F.count("transaction_id").alias("recent"))
    )
    return b.customers.select("customer_id").join(recent, "customer_id", "left").select("customer_id", F.coalesce("recent", F.lit(0)).alias("recent"))


@query("join_lookup", "SELECT t.transaction_id, m.category_group, m.high_risk_category FROM transactions t LEFT JOIN merchant_categories m ON t.merchant_category = m.mcc_code")
def join_lookup(b):
    m = b.merchant_categories.select("mcc_code", "category_group", "high_risk_category")
    return b.transactions.join(m, F.col("merchant_category") == F.col("mcc_code"), "left").select("transaction_id", "category_group", "high_risk_category")


@query("join_multi_child", f"""
SELECT c.customer_id, coalesce(t.n, 0) AS transactions, t.s AS amount, coalesce(d.n, 0) AS deposits, d.s AS deposited, coalesce(a.n, 0) AS accounts
FROM customers c LEFT JOIN (SELECT customer_id, count(*) AS n, {total("amount")} AS s FROM transactions GROUP BY 1) t ON t.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n, {total("amount")} AS s FROM direct_deposits GROUP BY 1) d ON d.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n FROM accounts GROUP BY 1) a ON a.customer_id = c.customer_id""")
def join_multi_child(b):
    wide = J.join_children(b.customers.select("customer_id"), "customer_id", [
        J.Child(b.transactions, "customer_id", {"transactions": F.count("*")}, {"amount": F.sum("amount")}),
        J.Child(b.direct_deposits, "customer_id", {"deposits": F.count("*")}, {"deposited": F.sum("amount")}),
        J.Child(b.accounts, "customer_id", {"accounts": F.count("*")}),
    ])
    return wide.na.fill(0, ["transactions", "deposits", "accounts"])


@query("join_preagg", f"SELECT t.transaction_id, CAST(t.amount AS DOUBLE) AS amount, u.usual FROM transactions t LEFT JOIN (SELECT customer_id, {avg('abs(amount)')} AS usual FROM transactions GROUP BY 1) u ON u.customer_id = t.customer_id")
def join_preagg(b):
    usual = b.transactions.groupBy("customer_id").agg(S.mean(F.abs("amount")).alias("usual"))
    return b.transactions.join(usual, "customer_id", "left").select("transaction_id", "amount", "usual")


@query("join_back", f"WITH m AS (SELECT customer_id AS cid, count(*) AS n FROM accounts GROUP BY 1) SELECT c.customer_id, c.customer_status, m.n FROM customers c JOIN m ON m.cid = c.customer_id")
def join_back(b):
    m = b.accounts.groupBy(F.col("customer_id").alias("cid")).agg(F.count("*").alias("n"))
    return b.customers.join(m, F.col("customer_id") == F.col("cid")).select("customer_id", "customer_status", "n")


@query("join_latest", """
SELECT c.customer_id, x.transaction_id, x.merchant_city FROM customers c LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY transaction_timestamp DESC, transaction_id DESC) AS rn FROM transactions) x
ON x.customer_id = c.customer_id AND rn = 1""")
def join_latest(b):
    latest = latest_per_key(
        b.transactions.select("customer_id", "transaction_id", "transaction_timestamp", "merchant_city"),
        ["customer_id"], ["transaction_timestamp", "transaction_id"],
    )
    return b.customers.select("customer_id").join(latest, "customer_id", "left").select("customer_id", "transaction_id", "merchant_city")


@query("join_cross", """
SELECT m.model_name, m.feature_id, d.transaction_date, d.n FROM model_features m,
  (SELECT transaction_date, count(*) AS n FROM transactions GROUP BY 1) d""")
def join_cross(b):
    daily = b.transactions.groupBy("transaction_date").agg(F.count("*").alias("n"))
    return J.with_each(daily, b.model_features.select("model_name", "feature_id"), "m").select(
        "m.model_name", "m.feature_id", "transaction_date", "n"
    )


@query("join_single_row", """
SELECT c.customer_id, x.mcc_code AS top_code, x.n AS top_count FROM customers c, (
  SELECT merchant_category AS mcc_code, count(*) AS n FROM transactions GROUP BY 1 ORDER BY n DESC, mcc_code LIMIT 1) x""")
def join_single_row(b):
    top = (
        b.transactions.groupBy(F.col("merchant_category").alias("mcc_code")).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "mcc_code").limit(1)
    )
    return J.with_row(b.customers.select("customer_id"), top, "x").select(
        "customer_id", F.col("x.mcc_code").alias("top_code"), F.col("x.n").alias("top_count")
    )


_SPINE = f"""
SELECT account_id, CAST(g.day AS DATE) AS day FROM accounts, LATERAL (SELECT unnest(generate_series(
  CAST(greatest(opening_date, {TODAY} - 30) AS TIMESTAMP), CAST(least(coalesce(closing_date, {TODAY}), {TODAY}) AS TIMESTAMP), INTERVAL 1 DAY)) AS day) g"""


def _spine(b):
    return J.day_spine(
        b.accounts.select("account_id", "opening_date", "closing_date"),
        F.greatest("opening_date", S.days_before(b.as_of, 30)),
        F.least(F.coalesce("closing_date", S.day(b.as_of)), S.day(b.as_of)),
    ).select("account_id", "day")


@query("join_date_spine", _SPINE)
def join_date_spine(b):
    return _spine(b)


@query("join_computed_key", f"""
WITH spine AS ({_SPINE})
SELECT s.account_id, s.day, coalesce(d.n, 0) AS deposits, d.v AS deposited FROM spine s
LEFT JOIN (SELECT account_id, deposit_date, count(*) AS n, {total("amount")} AS v FROM direct_deposits GROUP BY 1, 2) d
ON d.account_id = s.account_id AND d.deposit_date = s.day""")
def join_computed_key(b):
    daily = b.direct_deposits.groupBy("account_id", F.col("deposit_date").alias("day")).agg(
        F.count("*").alias("deposits"), F.sum("amount").alias("deposited")
    )
    return _spine(b).join(daily, ["account_id", "day"], "left").na.fill(0, ["deposits"])


@query("join_many_to_many_date", f"""
WITH a AS (SELECT transaction_date AS d, count(*) AS n, {total("abs(amount)")} AS v FROM transactions GROUP BY 1),
x AS (SELECT advance_date AS d, count(*) AS n, {total("advance_amount")} AS v FROM cash_advances GROUP BY 1)
SELECT a.d AS day, a.n AS transactions, coalesce(x.n, 0) AS advances, a.n * greatest(1, coalesce(x.n, 0)) AS joined_rows, a.v AS volume, x.v AS advanced
FROM a LEFT JOIN x ON x.d = a.d""")
def join_many_to_many_date(b):
    a = b.transactions.groupBy(F.col("transaction_date").alias("day")).agg(F.count("*").alias("transactions"), F.sum(F.abs("amount")).alias("volume"))
    x = b.cash_advances.groupBy(F.col("advance_date").alias("day")).agg(F.count("*").alias("advances"), F.sum("advance_amount").alias("advanced"))
    return a.join(x, "day", "left").na.fill(0, ["advances"]).withColumn(
        "joined_rows", F.col("transactions") * F.greatest(F.lit(1), "advances")
    )


@query("join_semi", "SELECT account_id FROM accounts a WHERE EXISTS (SELECT 1 FROM direct_deposits d WHERE d.account_id = a.account_id)")
def join_semi(b):
    return b.accounts.join(b.direct_deposits.select("account_id"), "account_id", "left_semi").select("account_id")


@query("join_anti", "SELECT a.account_id FROM accounts a LEFT JOIN transactions t ON t.account_id = a.account_id WHERE t.account_id IS NULL")
def join_anti(b):
    return b.accounts.join(b.transactions.select("account_id"), "account_id", "left_anti").select("account_id")


@query("join_presence", """
SELECT r.category, CASE WHEN s.category IS NULL THEN 'FAIL' ELSE 'PASS' END AS status
FROM (VALUES ('ACCOUNT'), ('TRANSACTION'), ('CARD'), ('ADVANCE'), ('GENERAL'), ('MORTGAGE')) r(category)
LEFT JOIN (SELECT DISTINCT category FROM support_interactions) s ON s.category = r.category""")
def join_presence(b):
    required = b.spark.createDataFrame([(c,) for c in ("ACCOUNT", "TRANSACTION", "CARD", "ADVANCE", "GENERAL", "MORTGAGE")], "category string")
    return J.presence(required, b.support_interactions, "category")


@query("join_asof", """
SELECT p.event_id AS label_id, CAST(p.user_id AS VARCHAR) AS entity_id, p.ts AS label_ts, f.feature_timestamp, f.feature_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM feature_values WHERE feature_id = 'customer_txn_count_30d') f
ON f.entity_id = CAST(p.user_id AS VARCHAR) AND f.feature_timestamp <= p.ts""")
def join_asof(b):
    labels = b.raw("events").where("event_type = 'purchase'").select(
        F.col("event_id").alias("label_id"), F.col("user_id").cast("string").alias("entity_id"), F.col("ts").alias("label_ts")
    )
    history = known_to(b.feature_history, labels).where(F.col("feature_id") == FEATURE_IDS[0]).select("entity_id", "feature_timestamp", "feature_value")
    return J.asof_join(labels, history, ["entity_id"], "label_id", "label_ts", "feature_timestamp", ["feature_value"])


@query("join_shared_attr", """
WITH m AS (SELECT DISTINCT customer_id, device_id FROM device_sessions),
a AS (SELECT device_id, min(customer_id) AS anchor, count(*) AS members FROM m GROUP BY 1 HAVING count(*) > 1)
SELECT m.device_id, m.customer_id, a.anchor, a.members FROM m JOIN a USING (device_id) WHERE m.customer_id <> a.anchor""")
def join_shared_attr(b):
    return J.shared_attribute_links(b.device_sessions, "customer_id", "device_id")


@query("join_full_stitch", f"""
WITH l AS (SELECT employer_name, count(*) AS deposits FROM direct_deposits WHERE deposit_type = 'PAYROLL' GROUP BY 1),
r AS (SELECT employer_name, {total("amount")} AS other_amount FROM direct_deposits WHERE deposit_type <> 'PAYROLL' GROUP BY 1)
SELECT CASE WHEN l.deposits IS NULL THEN r.employer_name ELSE l.employer_name END AS employer_name, deposits, other_amount
FROM l FULL JOIN r ON l.employer_name IS NOT DISTINCT FROM r.employer_name""")
def join_full_stitch(b):
    d = b.direct_deposits
    left = d.where("deposit_type = 'PAYROLL'").groupBy("employer_name").agg(F.count("*").alias("deposits"))
    right = d.where("deposit_type <> 'PAYROLL'").groupBy("employer_name").agg(F.sum("amount").alias("other_amount"))
    return J.full_stitch(left, right, ["employer_name"])
