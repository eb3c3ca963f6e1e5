"""Declared tables: column types, defaults and keys.

Types are Spark DDL. A default is a SQL expression applied where an inserted row
leaves the column out or NULL. Keys are declared, not enforced; ``plans.quality``
checks them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    ddl: str
    key: tuple[str, ...]
    defaults: dict[str, str] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)  # column -> parent table

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


_NOW = {"created_at": "{now}", "updated_at": "{now}"}
_CREATED = {"created_at": "{now}"}

TABLES: dict[str, Table] = {
    "customers": Table(
        "customer_id STRING, email STRING, phone_number STRING, first_name STRING, last_name STRING, "
        "date_of_birth DATE, ssn_last4 STRING, address_street STRING, address_city STRING, address_state STRING, "
        "address_zip STRING, customer_status STRING, kyc_status STRING, risk_tier STRING, acquisition_channel STRING, "
        "acquisition_date DATE, first_deposit_date DATE, churn_date DATE, lifetime_value DECIMAL(12,2), "
        "credit_score DECIMAL(3,0), income_verified DECIMAL(12,2), employment_status STRING, "
        "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
        ("customer_id",),
        {"customer_status": "'ACTIVE'", "kyc_status": "'PENDING'", "lifetime_value": "0", **_NOW},
    ),
    "accounts": Table(
        "account_id STRING, customer_id STRING, account_type STRING, account_number STRING, routing_number STRING, "
        "account_status STRING, opening_date DATE, closing_date DATE, current_balance DECIMAL(12,2), "
        "available_balance DECIMAL(12,2), credit_limit DECIMAL(12,2), apy_rate DECIMAL(5,4), "
        "overdraft_protection BOOLEAN, auto_save_enabled BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
        ("account_id",),
        {"account_status": "'ACTIVE'", "current_balance": "0", "available_balance": "0",
         "overdraft_protection": "false", "auto_save_enabled": "false", **_NOW},
        {"customer_id": "customers"},
    ),
    "transactions": Table(
        "transaction_id STRING, account_id STRING, customer_id STRING, transaction_type STRING, "
        "transaction_category STRING, transaction_date DATE, transaction_timestamp TIMESTAMP_NTZ, "
        "amount DECIMAL(12,2), running_balance DECIMAL(12,2), merchant_name STRING, merchant_category STRING, "
        "merchant_city STRING, merchant_state STRING, description STRING, is_recurring BOOLEAN, "
        "is_international BOOLEAN, fraud_score DECIMAL(3,2), status STRING, created_at TIMESTAMP_NTZ",
        ("transaction_id",),
        {"is_recurring": "false", "is_international": "false", "fraud_score": "0", "status": "'COMPLETED'", **_CREATED},
        {"account_id": "accounts", "customer_id": "customers", "merchant_category": "merchant_categories"},
    ),
    "cards": Table(
        "card_id STRING, account_id STRING, customer_id STRING, card_type STRING, card_number_last4 STRING, "
        "card_status STRING, issue_date DATE, expiration_date DATE, activation_date DATE, pin_set BOOLEAN, "
        "contactless_enabled BOOLEAN, international_enabled BOOLEAN, atm_enabled BOOLEAN, online_enabled BOOLEAN, "
        "daily_limit DECIMAL(10,2), created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
        ("card_id",), {"card_status": "'ACTIVE'", **_NOW},
        {"account_id": "accounts", "customer_id": "customers"},
    ),
    "direct_deposits": Table(
        "deposit_id STRING, account_id STRING, customer_id STRING, employer_name STRING, deposit_type STRING, "
        "deposit_date DATE, expected_date DATE, amount DECIMAL(12,2), is_recurring BOOLEAN, frequency STRING, "
        "early_access_eligible BOOLEAN, early_access_used BOOLEAN, created_at TIMESTAMP_NTZ",
        ("deposit_id",), {**_CREATED}, {"account_id": "accounts", "customer_id": "customers"},
    ),
    "cash_advances": Table(
        "advance_id STRING, customer_id STRING, account_id STRING, advance_amount DECIMAL(10,2), "
        "fee_amount DECIMAL(10,2), advance_date DATE, due_date DATE, repayment_date DATE, "
        "repayment_amount DECIMAL(10,2), advance_status STRING, eligibility_score DECIMAL(3,2), "
        "default_risk_score DECIMAL(3,2), created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
        ("advance_id",), {"advance_status": "'ACTIVE'", **_NOW},
        {"account_id": "accounts", "customer_id": "customers"},
    ),
    "credit_applications": Table(
        "application_id STRING, customer_id STRING, product_type STRING, application_date DATE, "
        "application_status STRING, decision_date DATE, approved_amount DECIMAL(10,2), requested_amount DECIMAL(10,2), "
        "credit_score_at_application DECIMAL(3,0), income_stated DECIMAL(12,2), debt_to_income_ratio DECIMAL(5,2), "
        "decision_reason_codes STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
        ("application_id",), {"application_status": "'PENDING'", **_NOW}, {"customer_id": "customers"},
    ),
    "merchant_categories": Table(
        "mcc_code STRING, category_name STRING, category_group STRING, cashback_eligible BOOLEAN, "
        "cashback_percentage DECIMAL(3,2), high_risk_category BOOLEAN, typical_transaction_amount DECIMAL(10,2), "
        "created_at TIMESTAMP_NTZ",
        ("mcc_code",), {"cashback_eligible": "false", "high_risk_category": "false", **_CREATED},
    ),
    "device_sessions": Table(
        "session_id STRING, customer_id STRING, device_id STRING, device_type STRING, app_version STRING, "
        "session_start TIMESTAMP_NTZ, session_end TIMESTAMP_NTZ, ip_address STRING, geolocation STRING, "
        "actions_performed STRING, biometric_used BOOLEAN, suspicious_activity_flag BOOLEAN, created_at TIMESTAMP_NTZ",
        ("session_id",), {"suspicious_activity_flag": "false", **_CREATED}, {"customer_id": "customers"},
    ),
    "support_interactions": Table(
        "interaction_id STRING, customer_id STRING, interaction_type STRING, interaction_date DATE, category STRING, "
        "subcategory STRING, issue_resolved BOOLEAN, resolution_time_minutes INT, agent_id STRING, "
        "satisfaction_score INT, transcript_available BOOLEAN, created_at TIMESTAMP_NTZ",
        ("interaction_id",), {"transcript_available": "false", **_CREATED}, {"customer_id": "customers"},
    ),
    "marketing_campaigns": Table(
        "campaign_id STRING, campaign_name STRING, campaign_type STRING, target_segment STRING, start_date DATE, "
        "end_date DATE, budget DECIMAL(10,2), expected_roi DECIMAL(5,2), actual_roi DECIMAL(5,2), "
        "campaign_status STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
        ("campaign_id",), {"campaign_status": "'ACTIVE'", **_NOW},
    ),
    "customer_campaigns": Table(
        "customer_campaign_id STRING, customer_id STRING, campaign_id STRING, sent_date DATE, opened BOOLEAN, "
        "clicked BOOLEAN, converted BOOLEAN, conversion_value DECIMAL(10,2), unsubscribed BOOLEAN, "
        "created_at TIMESTAMP_NTZ",
        ("customer_campaign_id",),
        {"opened": "false", "clicked": "false", "converted": "false", "unsubscribed": "false", **_CREATED},
        {"customer_id": "customers", "campaign_id": "marketing_campaigns"},
    ),
    "external_data": Table(
        "external_data_id STRING, customer_id STRING, data_source STRING, data_type STRING, pull_date DATE, "
        "credit_score DECIMAL(3,0), credit_utilization DECIMAL(5,2), total_debt DECIMAL(12,2), "
        "monthly_income DECIMAL(10,2), number_of_accounts INT, oldest_account_age_months INT, recent_inquiries INT, "
        "data_json VARIANT, created_at TIMESTAMP_NTZ",
        ("external_data_id",), {**_CREATED}, {"customer_id": "customers"},
    ),
    "compliance_events": Table(
        "event_id STRING, customer_id STRING, account_id STRING, event_type STRING, event_date DATE, severity STRING, "
        "description STRING, action_taken STRING, resolved BOOLEAN, resolution_date DATE, "
        "reported_to_regulator BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
        ("event_id",), {"resolved": "false", "reported_to_regulator": "false", **_NOW},
        {"customer_id": "customers", "account_id": "accounts"},
    ),
    "support_transcripts": Table(
        "transcript_id STRING, interaction_id STRING, customer_id STRING, agent_id STRING, interaction_date DATE, "
        "interaction_type STRING, category STRING, subcategory STRING, transcript_text STRING, "
        "sentiment_score DECIMAL(3,2), resolution_achieved BOOLEAN, created_at TIMESTAMP_NTZ",
        ("transcript_id",), {**_CREATED}, {"interaction_id": "support_interactions"},
    ),
    "compliance_documents": Table(
        "document_id STRING, document_type STRING, title STRING, content STRING, effective_date DATE, "
        "tags ARRAY<STRING>, created_at TIMESTAMP_NTZ",
        ("document_id",), {**_CREATED},
    ),
    "product_knowledge": Table(
        "knowledge_id STRING, product_name STRING, category STRING, title STRING, content STRING, version STRING, "
        "created_at TIMESTAMP_NTZ",
        ("knowledge_id",), {**_CREATED},
    ),
    "feature_definitions": Table(
        "feature_id STRING, feature_name STRING, feature_group STRING, description STRING, data_type STRING, "
        "computation_type STRING, feature_sql STRING, source_tables ARRAY<STRING>, refresh_frequency STRING, "
        "version INT, is_active BOOLEAN, created_by STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
        ("feature_id",), {"version": "1", "is_active": "true", **_NOW},
    ),
    "feature_sets": Table(
        "feature_set_id STRING, feature_set_name STRING, use_case STRING, description STRING, "
        "feature_ids ARRAY<STRING>, is_active BOOLEAN, created_by STRING, created_at TIMESTAMP_NTZ, "
        "updated_at TIMESTAMP_NTZ",
        ("feature_set_id",), {"is_active": "true", **_NOW},
    ),
    "feature_values": Table(
        "entity_id STRING, entity_type STRING, feature_id STRING, feature_value DOUBLE, "
        "feature_timestamp TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ",
        ("entity_id", "feature_id", "feature_timestamp"), {**_CREATED}, {"feature_id": "feature_definitions"},
    ),
    "feature_statistics": Table(
        "stat_id STRING, feature_id STRING, computation_date DATE, mean_value DECIMAL(20,6), "
        "std_deviation DECIMAL(20,6), min_value DECIMAL(20,6), max_value DECIMAL(20,6), null_count BIGINT, "
        "unique_count BIGINT, total_count BIGINT, percentile_25 DECIMAL(20,6), percentile_50 DECIMAL(20,6), "
        "percentile_75 DECIMAL(20,6), percentile_95 DECIMAL(20,6), percentile_99 DECIMAL(20,6), "
        "created_at TIMESTAMP_NTZ",
        ("stat_id",), {**_CREATED}, {"feature_id": "feature_definitions"},
    ),
    "training_datasets": Table(
        "dataset_id STRING, dataset_name STRING, model_name STRING, feature_set_id STRING, label_definition STRING, "
        "start_date DATE, end_date DATE, entity_count BIGINT, row_count BIGINT, dataset_location STRING, "
        "is_stratified BOOLEAN, train_test_split_ratio DECIMAL(3,2), created_by STRING, created_at TIMESTAMP_NTZ",
        ("dataset_id",), {"is_stratified": "false", "train_test_split_ratio": "0.8", **_CREATED},
        {"feature_set_id": "feature_sets"},
    ),
    "feature_lineage": Table(
        "lineage_id STRING, feature_id STRING, parent_feature_id STRING, parent_table STRING, "
        "dependency_type STRING, transformation_logic STRING, created_at TIMESTAMP_NTZ",
        ("lineage_id",), {**_CREATED}, {"feature_id": "feature_definitions"},
    ),
    "feature_monitoring": Table(
        "monitor_id STRING, feature_id STRING, monitor_type STRING, monitor_date DATE, "
        "baseline_stats MAP<STRING, DOUBLE>, current_stats MAP<STRING, DOUBLE>, drift_score DECIMAL(5,4), "
        "alert_triggered BOOLEAN, alert_severity STRING, alert_message STRING, created_at TIMESTAMP_NTZ",
        ("monitor_id",), {"alert_triggered": "false", **_CREATED}, {"feature_id": "feature_definitions"},
    ),
    "model_features": Table(
        "model_feature_id STRING, model_name STRING, model_version STRING, feature_id STRING, "
        "feature_importance DECIMAL(5,4), feature_type STRING, created_at TIMESTAMP_NTZ",
        ("model_feature_id",), {**_CREATED}, {"feature_id": "feature_definitions"},
    ),
    "online_features": Table(
        "entity_id STRING, entity_type STRING, feature_vector MAP<STRING, DOUBLE>, last_updated TIMESTAMP_NTZ",
        ("entity_id", "entity_type"),
    ),
    "feature_compute_logs": Table(
        "compute_id STRING, feature_id STRING, compute_start TIMESTAMP_NTZ, compute_end TIMESTAMP_NTZ, "
        "rows_processed BIGINT, compute_status STRING, error_message STRING, pool STRING, "
        "credits_used DECIMAL(10,4), created_at TIMESTAMP_NTZ",
        ("compute_id",), {"compute_status": "'RUNNING'", **_CREATED}, {"feature_id": "feature_definitions"},
    ),
}
