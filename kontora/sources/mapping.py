"""How each banking table is read off the supplied parquet tables.

Every entry is a projection: column name -> expression. The expressions are
plain SQL so that the DuckDB side of the checks can state the same mapping;
the few spellings that differ are the {placeholders} filled by ``Dialect``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# "Now" for tables read off events, and for tables read off orders and lineitem.
AS_OF = dt.date(2024, 1, 31)
AS_OF_ORDERS = dt.date(2001, 11, 5)


@dataclass(frozen=True)
class Dialect:
    k: str
    ntz: str
    seconds: str

    def fill(self, text: str) -> str:
        return text.format(k=self.k, ntz=self.ntz, seconds=self.seconds)


SPARK = Dialect(
    k="CAST(get_json_object(props, '$.k') AS INT)",
    ntz="TIMESTAMP_NTZ",
    seconds="make_dt_interval(0, 0, 0, CAST(15 + l_quantity AS INT))",
)
DUCKDB = Dialect(
    k="CAST(json_extract_string(props, '$.k') AS INT)",
    ntz="TIMESTAMP",
    seconds="to_seconds(CAST(15 + l_quantity AS INT))",
)


@dataclass(frozen=True)
class Mapped:
    base: str
    columns: dict[str, str]
    where: str | None = None
    copies: int = 1  # the base is repeated with copy number k2 = 0..copies-1


MONEY = "DECIMAL(12,2)"

MAPPING: dict[str, Mapped] = {}

MAPPING["customers"] = Mapped("customer_nation", {
    "customer_id": "c_custkey",
    "email": "concat('c', CAST(c_custkey AS STRING), '@example.com')",
    "phone_number": "concat('+1', CAST(2000000000 + c_custkey AS STRING))",
    "first_name": "c_name",
    "last_name": "n_name",
    "date_of_birth": "DATE '1950-01-01' + CAST((c_custkey * 31) % 18000 AS INT)",
    "address_city": "concat('City ', CAST(c_custkey % 20 AS STRING))",
    "address_state": "n_name",
    "customer_status": "CASE WHEN c_custkey % 20 = 0 THEN 'CLOSED' WHEN c_custkey % 20 = 1 THEN 'SUSPENDED' ELSE 'ACTIVE' END",
    "kyc_status": "CASE WHEN c_custkey % 10 = 0 THEN 'FAILED' WHEN c_custkey % 10 = 1 THEN 'PENDING' ELSE 'VERIFIED' END",
    "risk_tier": "CASE WHEN c_custkey % 3 = 0 THEN 'LOW' WHEN c_custkey % 3 = 1 THEN 'MEDIUM' ELSE 'HIGH' END",
    "acquisition_channel": "c_mktsegment",
    "acquisition_date": "DATE '2019-01-01' + CAST((c_custkey * 7) % 1825 AS INT)",
    "churn_date": "CASE WHEN c_custkey % 20 = 0 THEN DATE '2023-06-01' + CAST(c_custkey % 200 AS INT) END",
    "lifetime_value": f"CAST(c_acctbal AS {MONEY})",
    "credit_score": "300 + (c_custkey * 37) % 551",
    "income_verified": f"CAST(20000 + ((c_custkey * 97) % 130) * 1000 AS {MONEY})",
    "employment_status": "CASE c_custkey % 6 WHEN 0 THEN 'EMPLOYED_FULL_TIME' WHEN 1 THEN 'EMPLOYED_PART_TIME' "
                         "WHEN 2 THEN 'SELF_EMPLOYED' WHEN 3 THEN 'UNEMPLOYED' WHEN 4 THEN 'RETIRED' ELSE 'STUDENT' END",
    "created_at": "{ntz} '2024-01-30 06:00:00'",
    "updated_at": "{ntz} '2024-01-30 12:00:00'",
})

MAPPING["accounts"] = Mapped("customers", {
    "account_id": "customer_id * 10 + k2",
    "customer_id": "customer_id",
    "account_type": "CASE WHEN k2 = 0 THEN 'CHECKING' WHEN customer_id % 3 = 0 THEN 'SAVINGS' "
                    "WHEN customer_id % 3 = 1 THEN 'BELIEVE_CARD' ELSE 'LINE_OF_CREDIT' END",
    "account_status": "CASE WHEN customer_status = 'CLOSED' THEN 'CLOSED' ELSE 'ACTIVE' END",
    "opening_date": "acquisition_date + CAST(k2 * 30 AS INT)",
    "closing_date": "churn_date",
    "current_balance": f"CAST(CASE WHEN k2 = 1 AND customer_id % 3 <> 0 THEN -abs(lifetime_value) ELSE lifetime_value * (k2 + 1) END AS {MONEY})",
    "available_balance": f"CAST(lifetime_value AS {MONEY})",
    "credit_limit": f"CAST(CASE WHEN k2 = 0 OR customer_id % 3 = 0 THEN NULL WHEN credit_score >= 750 THEN 5000 "
                    f"WHEN credit_score >= 700 THEN 2500 WHEN credit_score >= 650 THEN 1000 ELSE 500 END AS {MONEY})",
    "apy_rate": "CAST(CASE WHEN k2 = 1 AND customer_id % 3 = 0 THEN CASE WHEN customer_id % 2 = 0 THEN 5.0 ELSE 2.5 END END AS DECIMAL(5,4))",
    "overdraft_protection": "k2 = 0",
    "auto_save_enabled": "customer_id % 4 = 0",
    "created_at": "created_at",
    "updated_at": "updated_at",
}, copies=2)

MAPPING["transactions"] = Mapped("events", {
    "transaction_id": "event_id",
    "account_id": "user_id * 10 + event_id % 2",
    "customer_id": "user_id",
    "transaction_type": "CASE event_type WHEN 'signup' THEN 'CREDIT' WHEN 'error' THEN 'TRANSFER' ELSE 'DEBIT' END",
    "transaction_category": "CASE event_type WHEN 'purchase' THEN 'POS' WHEN 'click' THEN 'ONLINE' WHEN 'view' THEN 'ATM' "
                            "WHEN 'signup' THEN 'ACH' ELSE 'TRANSFER' END",
    "transaction_date": "CAST(ts AS DATE)",
    "transaction_timestamp": "ts",
    "amount": f"CAST(CASE WHEN event_type IN ('signup', 'error') THEN value * 20 ELSE -value * 20 END AS {MONEY})",
    "running_balance": f"CAST((event_id * 37) % 10000 AS {MONEY})",
    "merchant_name": "concat('Merchant ', CAST({k} % 40 AS STRING))",
    "merchant_category": "CAST(5900 + {k} AS STRING)",
    "merchant_city": "concat('City ', CAST({k} % 7 AS STRING))",
    "merchant_state": "concat('S', CAST({k} % 5 AS STRING))",
    "description": "concat(event_type, ' ', CAST(event_id AS STRING))",
    "is_recurring": "{k} % 10 = 3",
    "is_international": "{k} % 20 = 0",
    # large, foreign and some merchants' transactions score higher, so that a model of the score has something to learn
    "fraud_score": "CAST(((event_id * 7919) % 45 + CASE WHEN value > 60 THEN 25 ELSE 0 END + CASE WHEN {k} % 20 = 0 THEN 20 ELSE 0 END"
                   " + CASE WHEN {k} % 40 < 8 THEN 9 ELSE 0 END) / 100 AS DECIMAL(3,2))",
    "status": "CASE WHEN event_id % 100 = 0 THEN 'DECLINED' WHEN event_id % 100 = 1 THEN 'PENDING' ELSE 'COMPLETED' END",
    "created_at": "ts",
})

MAPPING["merchant_categories"] = Mapped("part", {
    "mcc_code": "CAST(5900 + p_partkey AS STRING)",
    "category_name": "p_name",
    "category_group": "p_type",
    "cashback_eligible": "p_size % 2 = 0",
    "cashback_percentage": "CAST(p_size % 4 AS DECIMAL(3,2))",
    "high_risk_category": "p_size >= 45",
    "typical_transaction_amount": f"CAST(p_retailprice AS {MONEY})",
})

MAPPING["cards"] = Mapped("accounts", {
    "card_id": "account_id * 10 + 1",
    "account_id": "account_id",
    "customer_id": "customer_id",
    "card_type": "CASE WHEN account_type = 'BELIEVE_CARD' THEN 'BELIEVE_CREDIT' ELSE 'DEBIT' END",
    "card_status": "CASE account_id % 50 WHEN 0 THEN 'LOST' WHEN 1 THEN 'STOLEN' WHEN 10 THEN 'DAMAGED' WHEN 11 THEN 'INACTIVE' ELSE 'ACTIVE' END",
    "issue_date": "opening_date",
    "activation_date": "opening_date + 5",
}, where="account_type <> 'LINE_OF_CREDIT'")

MAPPING["direct_deposits"] = Mapped("events", {
    "deposit_id": "event_id",
    "account_id": "user_id * 10",
    "customer_id": "user_id",
    "employer_name": "CASE WHEN {k} % 6 <> 5 THEN concat('EMP', CAST({k} % 5 AS STRING)) END",
    "deposit_type": "CASE {k} % 3 WHEN 0 THEN 'PAYROLL' WHEN 1 THEN 'GOVERNMENT' ELSE 'OTHER' END",
    "deposit_date": "CAST(ts AS DATE)",
    "expected_date": "CAST(ts AS DATE) + CAST({k} % 3 AS INT)",
    "amount": f"CAST(value AS {MONEY})",
    "is_recurring": "{k} % 2 = 0",
    "frequency": "CASE user_id % 3 WHEN 0 THEN 'WEEKLY' WHEN 1 THEN 'BIWEEKLY' ELSE 'MONTHLY' END",
    "early_access_eligible": "user_id % 2 = 0",
    "early_access_used": "{k} % 2 = 0",
    "created_at": "ts",
}, where="event_type = 'signup'")

_ADVANCE = "CASE {k} % 5 WHEN 0 THEN 20 WHEN 1 THEN 50 WHEN 2 THEN 100 WHEN 3 THEN 250 ELSE 500 END"
_FEE = "CASE {k} % 5 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 5 WHEN 3 THEN 12 ELSE 25 END"
MAPPING["cash_advances"] = Mapped("events", {
    "advance_id": "event_id",
    "customer_id": "user_id",
    "account_id": "user_id * 10",
    "advance_amount": f"CAST({_ADVANCE} AS {MONEY})",
    "fee_amount": f"CAST({_FEE} AS {MONEY})",
    "advance_date": "CAST(ts AS DATE)",
    "due_date": "CAST(ts AS DATE) + 30",
    "repayment_date": "CASE WHEN {k} % 20 < 16 OR {k} % 20 = 19 THEN CAST(ts AS DATE) + CAST(1 + {k} % 35 AS INT) END",
    "repayment_amount": f"CAST(CASE WHEN {{k}} % 20 < 16 THEN {_ADVANCE} + {_FEE} END AS {MONEY})",
    "advance_status": "CASE WHEN {k} % 20 < 16 THEN 'REPAID' WHEN {k} % 20 < 19 THEN 'ACTIVE' ELSE 'DEFAULTED' END",
    "eligibility_score": "CAST((event_id % 100) / 100 AS DECIMAL(3,2))",
    "default_risk_score": "CAST((event_id * 13 % 100) / 100 AS DECIMAL(3,2))",
    "created_at": "ts",
}, where="event_type = 'error'")

MAPPING["support_interactions"] = Mapped("conversation_heads", {
    "interaction_id": "conv_id",
    "customer_id": "conv_id % n_customers",
    "interaction_type": "CASE conv_id % 3 WHEN 0 THEN 'CHAT' WHEN 1 THEN 'PHONE' ELSE 'EMAIL' END",
    "interaction_date": "DATE '2024-01-31' - CAST(conv_id % 120 AS INT)",
    "category": "CASE conv_id % 5 WHEN 0 THEN 'ACCOUNT' WHEN 1 THEN 'TRANSACTION' WHEN 2 THEN 'CARD' WHEN 3 THEN 'ADVANCE' ELSE 'GENERAL' END",
    "subcategory": "CASE WHEN conv_id % 7 = 0 THEN 'DISPUTE' WHEN conv_id % 7 = 1 THEN 'REGULATION_E' ELSE 'QUESTION' END",
    "issue_resolved": "conv_id % 4 <> 0",
    "resolution_time_minutes": "CAST(5 + n_turns * 3 AS INT)",
    "agent_id": "concat('A', CAST(conv_id % 12 AS STRING))",
    "satisfaction_score": "CAST(1 + conv_id % 5 AS INT)",
})

MAPPING["marketing_campaigns"] = Mapped("region", {
    "campaign_id": "r_regionkey",
    "campaign_name": "r_name",
    "campaign_type": "CASE r_regionkey % 3 WHEN 0 THEN 'EMAIL' WHEN 1 THEN 'PUSH' ELSE 'REFERRAL' END",
    "target_segment": "concat('SEGMENT_', CAST(r_regionkey AS STRING))",
    "start_date": "DATE '2024-01-01'",
    "end_date": "DATE '2024-01-31'",
    "budget": f"CAST(1000 * (r_regionkey + 1) AS {MONEY})",
    "expected_roi": "CAST(2 AS DECIMAL(5,2))",
    "actual_roi": "CAST(1 + r_regionkey AS DECIMAL(5,2))",
    "campaign_status": "'ACTIVE'",
})

MAPPING["customer_campaigns"] = Mapped("events", {
    "customer_campaign_id": "event_id",
    "customer_id": "user_id",
    "campaign_id": "{k} % 5",
    "sent_date": "CAST(ts AS DATE)",
    "sent_at": "ts",
    "opened": "event_type <> 'error'",
    "clicked": "event_type IN ('click', 'purchase')",
    "converted": "event_type = 'purchase'",
    "conversion_value": f"CAST(CASE WHEN event_type = 'purchase' THEN value END AS {MONEY})",
})

# Large movements are what compliance looks at.
MAPPING["compliance_events"] = Mapped("events", {
    "event_id": "event_id",
    "customer_id": "user_id",
    "account_id": "user_id * 10",
    "event_type": "CASE event_id % 4 WHEN 0 THEN 'SAR' WHEN 1 THEN 'CTR' WHEN 2 THEN 'KYC_UPDATE' ELSE 'OFAC_HIT' END",
    "event_date": "CAST(ts AS DATE)",
    "severity": "CASE {k} % 4 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HIGH' ELSE 'CRITICAL' END",
    "resolved": "{k} % 2 = 0",
}, where="value > 200")

MAPPING["external_data"] = Mapped("customers", {
    "external_data_id": "customer_id * 10 + k2",
    "customer_id": "customer_id",
    "data_source": "CASE customer_id % 3 WHEN 0 THEN 'EQUIFAX' WHEN 1 THEN 'EXPERIAN' ELSE 'PLAID' END",
    "data_type": "CASE (customer_id + k2) % 3 WHEN 0 THEN 'CREDIT_REPORT' WHEN 1 THEN 'BANK_VERIFICATION' ELSE 'INCOME_VERIFICATION' END",
    "pull_date": "DATE '2024-01-31' - CAST(30 * k2 AS INT)",
    "credit_score": "300 + (customer_id * 37 + k2 * 11) % 551",
    "credit_utilization": "CAST((customer_id % 100) / 100 AS DECIMAL(5,2))",
}, copies=2)

MAPPING["credit_applications"] = Mapped("customers", {
    "application_id": "customer_id",
    "customer_id": "customer_id",
    "product_type": "CASE WHEN customer_id % 8 < 4 THEN 'BELIEVE_CARD' ELSE 'LINE_OF_CREDIT' END",
    "application_date": "acquisition_date + 10",
    "application_status": "CASE customer_id % 3 WHEN 0 THEN 'APPROVED' WHEN 1 THEN 'PENDING' ELSE 'DECLINED' END",
    "requested_amount": f"CAST(credit_score * 10 AS {MONEY})",
    "approved_amount": f"CAST(CASE WHEN customer_id % 3 = 0 THEN credit_score * 5 END AS {MONEY})",
    "decision_reason_codes": "CASE WHEN customer_id % 3 = 2 THEN concat('R', CAST(customer_id % 4 AS STRING)) END",
})

# The six seeded feature ids, in registry order (fixed values).
FEATURE_IDS = [
    "customer_txn_count_30d",
    "customer_txn_amount_30d",
    "customer_unique_merchants_30d",
    "customer_avg_daily_balance",
    "customer_advance_utilization",
    "customer_fraud_transaction_ratio",
]

_LOG_FEATURE = "CASE l_partkey % 6 " + " ".join(
    f"WHEN {i} THEN '{f}'" for i, f in enumerate(FEATURE_IDS)
) + " END"
MAPPING["feature_compute_logs"] = Mapped("lineitem", {
    "compute_id": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING))",
    "feature_id": _LOG_FEATURE,
    "compute_start": "CAST(l_shipdate AS {ntz})",
    "compute_end": "CAST(l_shipdate AS {ntz}) + {seconds}",
    "rows_processed": "CAST(floor(l_extendedprice) AS BIGINT)",
    "compute_status": "CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'FAILED' ELSE 'SUCCESS' END",
    "pool": "CASE WHEN l_linestatus = 'F' THEN 'FEATURE_POOL' ELSE 'LEGACY_POOL' END",
    "credits_used": "CAST(l_tax AS DECIMAL(10,4))",
})

MAPPING["transactions_large"] = Mapped("lineitem", {
    "order_id": "l_orderkey",
    "line_number": "l_linenumber",
    "merchant_category": "l_partkey",
    "transaction_date": "CAST(l_shipdate AS DATE)",
    "amount": f"CAST(l_extendedprice AS {MONEY})",
})
