"""Metric-layer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kontora.plans import semantic as sem
from kontora.plans.rollups import Rollups
from kontora.queries.base import SQL, TODAY, avg, query, total
from kontora.session import scratch_path
from kontora.sources.storage import catalog_counts

_CB = [m for m in sem.CUSTOMER_BANKING.metrics]
_TP = [m for m in sem.TRANSACTION_PAYMENT.metrics]
_CR = [m for m in sem.CREDIT_RISK.metrics]


@query("semantic_query", f"""
WITH a AS (SELECT c.address_state, {total("CASE WHEN account_type IN ('CHECKING', 'SAVINGS') THEN current_balance ELSE 0 END")} AS accounts_total_deposits, count(*) AS total_accounts
  FROM accounts a JOIN customers c USING (customer_id) WHERE c.customer_status = 'ACTIVE' GROUP BY 1),
d AS (SELECT c.address_state, {avg("amount")} AS avg_deposit_amount FROM direct_deposits d JOIN customers c USING (customer_id) WHERE c.customer_status = 'ACTIVE' GROUP BY 1)
SELECT coalesce(a.address_state, d.address_state) AS address_state, accounts_total_deposits, total_accounts, avg_deposit_amount FROM a FULL JOIN d ON a.address_state = d.address_state""")
def semantic_query(b):
    return sem.semantic_query(
        b, sem.CUSTOMER_BANKING, ["accounts.total_deposits", "total_accounts", "avg_deposit_amount"], ["address_state"],
        "{customer_status} = 'ACTIVE'", ["customer_status"],
    )


def _by(dim: str, parts: list[str]) -> str:
    ctes = ", ".join(f"p{i} AS ({p})" for i, p in enumerate(parts))
    cols = ", ".join(f"p{i}.* EXCLUDE ({dim})" for i in range(len(parts)))
    joins = " ".join(f"LEFT JOIN p{i} ON p{i}.{dim} = k.{dim}" for i in range(len(parts)))
    return f"WITH {ctes} SELECT k.{dim}, {cols} FROM (SELECT DISTINCT {dim} FROM customers) k {joins}"


def _part(dim, table, cols):
    own = table == "customers"
    source = "customers x" if own else f"{table} x JOIN customers c ON c.customer_id = x.customer_id"
    return f"SELECT {'x' if own else 'c'}.{dim}, {cols} FROM {source} GROUP BY 1"


_CB_SQL = [
    ("customers", f"count(*) AS customers_total_customers, count(CASE WHEN customer_status = 'ACTIVE' THEN 1 END) AS customers_active_customers, {avg('credit_score')} AS customers_avg_credit_score, {avg('income_verified')} AS customers_avg_income"),
    ("accounts", f"""count(*) AS accounts_total_accounts, count(CASE WHEN account_type = 'CHECKING' THEN 1 END) AS accounts_checking_accounts, count(CASE WHEN account_type = 'SAVINGS' THEN 1 END) AS accounts_savings_accounts,
      count(CASE WHEN account_type IN ('BELIEVE_CARD', 'LINE_OF_CREDIT') THEN 1 END) AS accounts_credit_accounts, {avg("CASE WHEN account_type = 'CHECKING' THEN current_balance END")} AS accounts_avg_checking_balance,
      {avg("CASE WHEN account_type = 'SAVINGS' THEN current_balance END")} AS accounts_avg_savings_balance, {total("CASE WHEN account_type IN ('CHECKING', 'SAVINGS') THEN current_balance ELSE 0 END")} AS accounts_total_deposits"""),
    ("cards", "count(DISTINCT CASE WHEN card_status = 'ACTIVE' THEN card_id END) AS cards_active_cards"),
    ("direct_deposits", f"count(DISTINCT deposit_id) AS direct_deposits_total_deposits, {avg('amount')} AS direct_deposits_avg_deposit_amount, {total(f'CASE WHEN deposit_date >= {TODAY} - INTERVAL 1 MONTH THEN amount END')} AS direct_deposits_monthly_deposit_volume"),
    ("cash_advances", f"""count(DISTINCT advance_id) AS cash_advances_total_advances, count(CASE WHEN advance_status = 'ACTIVE' THEN 1 END) AS cash_advances_active_advances, {avg('advance_amount')} AS cash_advances_avg_advance_amount,
      CAST(count(CASE WHEN advance_status = 'DEFAULTED' THEN 1 END) AS DOUBLE) / count(*) AS cash_advances_default_rate"""),
    ("support_interactions", f"count(DISTINCT interaction_id) AS support_interactions_total_interactions, {avg('satisfaction_score')} AS support_interactions_avg_satisfaction"),
]


@query("sv_customer_banking", _by("risk_tier", [_part("risk_tier", t, c) for t, c in _CB_SQL]))
def sv_customer_banking(b):
    return sem.semantic_query(b, sem.CUSTOMER_BANKING, _CB, ["risk_tier"])


@query("sv_transaction_payment", f"""
SELECT category_group, cashback_eligible, count(DISTINCT transaction_id) AS transactions_total_transactions, {total("abs(amount)")} AS transactions_transaction_volume, {avg("abs(amount)")} AS transactions_avg_transaction_amount,
  {total("CASE WHEN transaction_type = 'DEBIT' THEN abs(amount) ELSE 0 END")} AS transactions_debit_volume, {total("CASE WHEN transaction_type = 'CREDIT' THEN amount ELSE 0 END")} AS transactions_credit_volume,
  {total("CASE WHEN transaction_category = 'ATM' THEN abs(amount) ELSE 0 END")} AS transactions_atm_volume, count(CASE WHEN transaction_category = 'POS' THEN 1 END) AS transactions_pos_transactions,
  count(CASE WHEN transaction_category = 'ONLINE' THEN 1 END) AS transactions_online_transactions, count(CASE WHEN is_recurring THEN 1 END) AS transactions_recurring_count,
  count(CASE WHEN is_international THEN 1 END) AS transactions_international_count, count(CASE WHEN status = 'DECLINED' THEN 1 END) AS transactions_declined_count,
  count(DISTINCT merchant_name) AS transactions_unique_merchants, count(DISTINCT merchant_category) AS transactions_unique_categories,
  {total("abs(amount)")} AS transactions_cashback_eligible_volume, {total("abs(amount)")} AS transactions_high_risk_volume, {avg("fraud_score")} AS transactions_avg_fraud_score
FROM transactions LEFT JOIN merchant_categories ON merchant_category = mcc_code GROUP BY 1, 2""")
def sv_transaction_payment(b):
    return sem.semantic_query(b, sem.TRANSACTION_PAYMENT, _TP, ["category_group", "cashback_eligible"])


_CR_SQL = [
    ("credit_applications", f"""count(*) AS credit_applications_total_applications, count(CASE WHEN application_status = 'APPROVED' THEN 1 END) AS credit_applications_approved_applications,
      CAST(count(CASE WHEN application_status = 'APPROVED' THEN 1 END) AS DOUBLE) / count(*) AS credit_applications_approval_rate, {avg('approved_amount')} AS credit_applications_avg_approved_amount"""),
    ("cash_advances", f"""{total('advance_amount')} AS cash_advances_total_advance_volume, {total("CASE WHEN advance_status = 'ACTIVE' THEN advance_amount + fee_amount ELSE 0 END")} AS cash_advances_outstanding_balance,
      {total("CASE WHEN advance_status = 'DEFAULTED' THEN advance_amount ELSE 0 END")} AS cash_advances_default_volume,
      {total("CASE WHEN advance_status = 'REPAID' THEN repayment_amount ELSE 0 END")} / {total('advance_amount + fee_amount')} AS cash_advances_collection_rate,
      {avg("CASE WHEN advance_status = 'REPAID' THEN date_diff('day', advance_date, repayment_date) END")} AS cash_advances_avg_days_to_repay, {avg('default_risk_score')} AS cash_advances_avg_risk_score"""),
    ("accounts", f"{total('credit_limit')} AS accounts_total_credit_exposure, round(avg(CASE WHEN credit_limit > 0 THEN CAST(abs(current_balance) AS DOUBLE) / CAST(credit_limit AS DOUBLE) END), 6) AS accounts_credit_utilization"),
    ("external_data", "count(DISTINCT CASE WHEN data_type = 'INCOME_VERIFICATION' THEN x.customer_id END) AS external_data_verified_customers"),
    ("compliance_events", "count(*) AS compliance_events_total_events, count(CASE WHEN severity IN ('HIGH', 'CRITICAL') THEN 1 END) AS compliance_events_high_severity_events"),
]


@query("sv_credit_risk", _by("employment_status", [_part("employment_status", t, c) for t, c in _CR_SQL]))
def sv_credit_risk(b):
    out = sem.semantic_query(b, sem.CREDIT_RISK, _CR, ["employment_status"])
    return out.withColumn("accounts_credit_utilization", F.round("accounts_credit_utilization", 6))


#: The levels kept per metric table, widest first; the questions above ask for the narrow ones.
_LEVELS = {
    "customers": [("risk_tier", "acquisition_channel", "customer_status"), ("risk_tier",)],
    "accounts": [("risk_tier", "account_type", "address_state", "customer_status"), ("address_state", "customer_status"), ("risk_tier",)],
    "cards": [("risk_tier", "card_type"), ("risk_tier",)],
    "direct_deposits": [("risk_tier", "deposit_type", "address_state", "customer_status"), ("address_state", "customer_status"), ("risk_tier",)],
    "cash_advances": [("risk_tier", "advance_status"), ("risk_tier",)],
    "support_interactions": [("risk_tier", "category"), ("risk_tier",)],
}
_LEVELS_TP = {"transactions": [("category_group", "cashback_eligible", "transaction_category", "status"), ("category_group", "cashback_eligible")]}
_LEVELS_CR = {
    "credit_applications": [("employment_status", "product_type"), ("employment_status",)], "cash_advances": [("employment_status", "advance_status"), ("employment_status",)],
    "accounts": [("employment_status", "account_type"), ("employment_status",)], "external_data": [("employment_status", "data_type"), ("employment_status",)],
    "compliance_events": [("employment_status", "severity"), ("employment_status",)],
}


def stored_rollups(b, view: sem.SemanticView, levels) -> Rollups:
    """The view's rollups, built anew in the shared folder."""
    rollups = Rollups(b.spark, scratch_path(b.spark, "rollups"))
    for table, sets in levels.items():
        rollups.build(b, view, table, sets)
    return rollups


@query("semantic_query_rollup")
def semantic_query_rollup(b):
    stored = stored_rollups(b, sem.CUSTOMER_BANKING, {t: _LEVELS[t] for t in ("accounts", "direct_deposits")})
    return sem.semantic_query(
        b, sem.CUSTOMER_BANKING, ["accounts.total_deposits", "total_accounts", "avg_deposit_amount"], ["address_state"],
        "{customer_status} = 'ACTIVE'", ["customer_status"], stored,
    )


@query("sv_customer_banking_rollup")
def sv_customer_banking_rollup(b):
    return sem.semantic_query(b, sem.CUSTOMER_BANKING, _CB, ["risk_tier"], rollups=stored_rollups(b, sem.CUSTOMER_BANKING, _LEVELS))


@query("sv_transaction_payment_rollup")
def sv_transaction_payment_rollup(b):
    stored = stored_rollups(b, sem.TRANSACTION_PAYMENT, _LEVELS_TP)
    return sem.semantic_query(b, sem.TRANSACTION_PAYMENT, _TP, ["category_group", "cashback_eligible"], rollups=stored)


@query("sv_credit_risk_rollup")
def sv_credit_risk_rollup(b):
    out = sem.semantic_query(b, sem.CREDIT_RISK, _CR, ["employment_status"], rollups=stored_rollups(b, sem.CREDIT_RISK, _LEVELS_CR))
    return out.withColumn("accounts_credit_utilization", F.round("accounts_credit_utilization", 6))


for _name in ("semantic_query", "sv_customer_banking", "sv_transaction_payment", "sv_credit_risk"):
    SQL[f"{_name}_rollup"] = SQL[_name]

_SYN = [(s, t) for t, names in sem.TRANSACTION_PAYMENT.synonyms.items() for s in names]


@query("synonym_lookup", "SELECT v.synonym, v.tbl AS object, n.n AS row_count FROM (VALUES " + ", ".join(f"('{s}', '{t}')" for s, t in _SYN) + ") v(synonym, tbl) JOIN ("
       + " UNION ALL ".join(f"SELECT '{t}' AS tbl, count(*) AS n FROM {t}" for t in sem.TRANSACTION_PAYMENT.synonyms) + ") n ON n.tbl = v.tbl")
def synonym_lookup(b):
    rows = b.spark.createDataFrame(sem.synonym_rows(sem.TRANSACTION_PAYMENT), "synonym string, kind string, object string")
    sizes = catalog_counts({t: getattr(b, t) for t in sem.TRANSACTION_PAYMENT.synonyms}).select(F.col("table_name").alias("object"), "row_count")
    return rows.where("kind = 'table'").join(sizes, "object").select("synonym", "object", "row_count")
