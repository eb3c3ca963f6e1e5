"""Question workloads with their checks."""

from __future__ import annotations

from kontora.plans import questions as q
from kontora.plans.retrieval import words_of
from kontora.queries.base import NOW, TODAY, avg, corr, query, total
from kontora.queries.health import DRIFT
from kontora.queries.search import words_sql
from kontora.queries.views import _C360, _c360


def _flag(test: str) -> str:
    return f"CASE WHEN {test} THEN 1 ELSE 0 END"


def _band(c: str) -> str:
    return f"CASE WHEN {c} >= 750 THEN 'EXCELLENT' WHEN {c} >= 700 THEN 'GOOD' WHEN {c} >= 650 THEN 'FAIR' ELSE 'POOR' END"


def ask(name: str, fn, sql: str | None) -> None:
    query(name, sql)(fn)


ask("q_ltv_by_channel", q.ltv_by_channel, f"""
WITH x AS (SELECT c.customer_id, acquisition_channel, lifetime_value, {_flag("customer_status = 'ACTIVE'")} AS kept,
  c.customer_id IN (SELECT customer_id FROM direct_deposits) AS has_direct_deposit, (SELECT count(*) FROM accounts a WHERE a.customer_id = c.customer_id) AS product_count FROM customers c)
SELECT g.*, l.r AS deposit_retention_corr FROM (SELECT acquisition_channel, product_count, has_direct_deposit, count(*) AS customers, {avg("lifetime_value")} AS avg_ltv, {avg("kept")} AS retention FROM x GROUP BY 1, 2, 3) g
JOIN (SELECT acquisition_channel, round({corr("CAST(has_direct_deposit AS INT)", "kept")}, 6) AS r FROM x GROUP BY 1) l USING (acquisition_channel)""")

_PAID = "CASE WHEN advance_status = 'REPAID' THEN fee_amount ELSE 0 END"
_LOST = "CASE WHEN advance_status = 'DEFAULTED' THEN advance_amount ELSE 0 END"
ask("q_advance_default", q.advance_default, f"""
SELECT {_band("credit_score")} AS score_band, count(*) AS advances, {avg(_flag("advance_status = 'DEFAULTED'"))} AS default_rate, {avg("advance_amount")} AS avg_amount,
  {total(_PAID)} AS fees_collected, {total(_LOST)} AS default_volume, CAST(sum({_PAID}) - sum({_LOST}) AS DOUBLE) AS profit,
  round({corr("d.a", _flag("advance_status = 'REPAID'"))}, 6) AS deposit_repay_corr, {avg("CASE WHEN advance_status = 'DEFAULTED' THEN date_diff('day', advance_date, repayment_date) END")} AS avg_days_to_default
FROM cash_advances v JOIN customers c USING (customer_id) LEFT JOIN (SELECT customer_id, {avg("amount")} AS a FROM direct_deposits GROUP BY 1) d USING (customer_id) GROUP BY 1""")

ask("q_fraud_24h", q.fraud_24h, f"""
WITH n AS (SELECT customer_id, count(*) AS transactions, CAST(max(abs(amount)) AS DOUBLE) AS largest, count(DISTINCT merchant_state) AS states, {avg("fraud_score")} AS avg_fraud_score
  FROM transactions WHERE transaction_timestamp >= {NOW} - INTERVAL 24 HOUR GROUP BY 1),
u AS (SELECT customer_id, CAST(count(*) AS DOUBLE) / 30 AS r, {avg("abs(amount)")} AS a FROM transactions WHERE transaction_date >= {TODAY} - 30 GROUP BY 1),
x AS (SELECT n.*, transactions > r * 2 AS velocity_spike, largest > a * 1.5 AS unusual_amount, states > 3 AS wide_geography FROM n JOIN u USING (customer_id))
SELECT * FROM x WHERE velocity_spike OR unusual_amount OR wide_geography""")

ask("q_fraud_merchants", q.fraud_merchants, f"SELECT merchant_name, count(*) AS transactions, {avg('fraud_score')} AS avg_fraud_score FROM transactions GROUP BY 1")

_SECS = "date_diff('second', compute_start, compute_end)"
ask("q_feature_perf", q.feature_cost, f"SELECT feature_id, {total('credits_used')} AS credits, {avg(_SECS)} AS avg_seconds, count(*) AS runs FROM feature_compute_logs GROUP BY 1")

_N, _SX, _SY = "CAST(count(*) AS DOUBLE)", total("x"), total("amount")
ask("q_deposit_loss", q.deposit_loss, f"""
WITH d AS (SELECT customer_id, count(*) AS deposits, ({_N} * {total("x * amount")} - {_SX} * {_SY}) / nullif({_N} * {total("x * x")} - {_SX} * {_SX}, 0) AS amount_trend,
  date_diff('day', max(deposit_date), {TODAY}) AS days_since_deposit FROM (SELECT *, date_diff('day', DATE '2024-01-01', deposit_date) AS x FROM direct_deposits) GROUP BY 1)
SELECT d.*, h.balance, coalesce(s.n, 0) AS contacts, coalesce(amount_trend < 0, false) AS declining, days_since_deposit > 45 AS stopped
FROM d JOIN (SELECT customer_id, {total("current_balance")} AS balance FROM accounts GROUP BY 1) h USING (customer_id) LEFT JOIN (SELECT customer_id, count(*) AS n FROM support_interactions GROUP BY 1) s USING (customer_id)""")

_USED = "CAST(abs(current_balance) AS DOUBLE) / CAST(credit_limit AS DOUBLE)"
ask("q_limit_optimization", q.limit_optimization, f"""
SELECT a.account_id, c.credit_score, CAST(c.income_verified AS DOUBLE) AS income_verified, CAST(credit_limit AS DOUBLE) AS credit_limit, {_USED} AS utilization, CAST(coalesce(s.v, 0) AS DOUBLE) AS spend_30d,
  CASE WHEN credit_score >= 700 AND {_USED} > 0.5 THEN 'INCREASE' WHEN credit_score < 600 AND {_USED} > 1 THEN 'REDUCE' ELSE 'KEEP' END AS action
FROM accounts a JOIN customers c USING (customer_id)
LEFT JOIN (SELECT account_id, sum(CASE WHEN transaction_type = 'DEBIT' THEN abs(amount) ELSE 0 END) AS v FROM transactions WHERE transaction_date >= {TODAY} - 30 GROUP BY 1) s ON s.account_id = a.account_id
WHERE account_type = 'BELIEVE_CARD'""")

ask("q_cashback_roi", q.cashback_roi, f"""
SELECT category_group, {total("abs(amount)")} AS volume, {total("CASE WHEN cashback_eligible THEN abs(amount) ELSE 0 END")} AS eligible_volume,
  {total("CASE WHEN cashback_eligible THEN abs(amount) * cashback_percentage ELSE 0 END")} / 100 AS cashback_paid, count(DISTINCT customer_id) AS customers, {avg(_flag("cashback_eligible"))} AS eligible_share
FROM transactions JOIN merchant_categories ON merchant_category = mcc_code WHERE transaction_type = 'DEBIT' GROUP BY 1""")

ask("q_aml_patterns", q.aml_patterns, f"""
WITH d AS (SELECT customer_id, transaction_date, count(CASE WHEN amount BETWEEN 8000 AND 9999.99 THEN 1 END) AS s, max({_flag("amount >= 1000")}) * max({_flag("amount <= -1000")}) AS io, count(CASE WHEN high_risk_category THEN 1 END) AS r
  FROM transactions LEFT JOIN merchant_categories ON merchant_category = mcc_code GROUP BY 1, 2),
p AS (SELECT customer_id, sum(s)::BIGINT AS structured_deposits, sum(io)::BIGINT AS in_out_days, sum(r)::BIGINT AS risky_merchants FROM d GROUP BY 1)
SELECT p.*, coalesce(e.n, 0) AS sar_count, coalesce(e.n, 0) * 3 + structured_deposits * 2 + in_out_days + risky_merchants AS priority
FROM p LEFT JOIN (SELECT customer_id, count(CASE WHEN event_type = 'SAR' THEN 1 END) AS n FROM compliance_events GROUP BY 1) e USING (customer_id)""")

ask("q_support_efficiency", q.support_efficiency, f"""
SELECT interaction_type, category, count(*) AS contacts, {avg("resolution_time_minutes")} AS avg_minutes, {avg(_flag("issue_resolved"))} AS resolved_share, {avg("satisfaction_score")} AS satisfaction,
  {avg(_flag("customer_status = 'CLOSED'"))} AS closed_share, CAST(sum(resolution_time_minutes) AS DOUBLE) * 0.75 AS cost FROM support_interactions JOIN customers USING (customer_id) GROUP BY 1, 2""")

ask("q_cross_sell", q.cross_sell, f"""
WITH a AS (SELECT customer_id, bool_or(account_type = 'CHECKING') AS ch, bool_or(account_type = 'SAVINGS') AS sv, bool_or(account_type IN ('BELIEVE_CARD', 'LINE_OF_CREDIT')) AS cr,
  sum(CASE WHEN account_type IN ('CHECKING', 'SAVINGS') THEN current_balance ELSE 0 END) AS bal FROM accounts GROUP BY 1)
SELECT c.customer_id, coalesce(ch, false) AND NOT coalesce(sv, false) AS needs_savings, coalesce(bal > 5000 AND NOT cr, false) AS needs_credit,
  c.customer_id IN (SELECT customer_id FROM direct_deposits) AND c.customer_id NOT IN (SELECT customer_id FROM cash_advances) AS could_use_advance
FROM customers c LEFT JOIN a USING (customer_id) WHERE customer_status = 'ACTIVE'""")

ask("q_weekend_weekday", q.weekend_weekday, f"""
SELECT CASE WHEN dayofweek(transaction_date) IN (0, 6) THEN 'WEEKEND' ELSE 'WEEKDAY' END AS day_type, risk_tier, count(*) AS transactions, {total("abs(amount)")} AS volume, {avg("abs(amount)")} AS avg_amount,
  {avg("fraud_score")} AS avg_fraud_score, count(DISTINCT merchant_category) AS categories FROM transactions JOIN customers USING (customer_id) GROUP BY 1, 2""")

ask("q_savings_growth", q.savings_growth, f"""
SELECT CAST(apy_rate AS DOUBLE) AS apy_rate, count(*) AS accounts, {avg("current_balance")} AS avg_balance, {avg(_flag("auto_save_enabled"))} AS auto_save_share,
  round({corr("current_balance", f"date_diff('day', opening_date, {TODAY})")}, 6) AS balance_age_corr FROM accounts WHERE account_type = 'SAVINGS' GROUP BY 1""")

ask("q_international", q.international, f"SELECT is_international, merchant_state, count(*) AS transactions, {total('abs(amount)')} AS volume, {avg(_flag('fraud_score > 0.7'))} AS fraud_rate FROM transactions GROUP BY 1, 2")

ask("q_frequent_travellers", q.frequent_travellers, "SELECT customer_id, count(*) AS international, count(DISTINCT merchant_state) AS states FROM transactions WHERE is_international GROUP BY 1 HAVING count(*) >= 3")

ask("q_drift_impact", lambda b: _rounded(q.drift_impact(b), "normalized_shift", "impact"), f"""WITH {DRIFT} SELECT m.model_name, m.feature_id, m.feature_importance::DOUBLE AS feature_importance,
  round(d.normalized_shift, 4) AS normalized_shift, d.drift_status, round(d.normalized_shift * m.feature_importance, 4) AS impact FROM model_features m JOIN drift d USING (feature_id)""")


def _rounded(df, *names):
    from pyspark.sql import functions as F

    return df.withColumns({n: F.round(n, 4) for n in names})


_EDGE = f"{NOW} - INTERVAL 7 DAY"
ask("q_drift_by_segment", q.drift_by_segment, f"""
SELECT feature_id, risk_tier, round(x, 6) AS before, round(y, 6) AS after, round(abs(y - x), 6) AS shift FROM (SELECT feature_id, risk_tier, avg(CASE WHEN feature_timestamp < {_EDGE} THEN feature_value END) AS x,
  avg(CASE WHEN feature_timestamp >= {_EDGE} THEN feature_value END) AS y FROM feature_values JOIN customers c ON CAST(c.customer_id AS VARCHAR) = entity_id GROUP BY 1, 2)""")

ask("q_attribution", q.attribution, f"""
WITH p AS (SELECT *, row_number() OVER w AS n, first_value(campaign_id) OVER w AS first_campaign, min(sent_at) OVER w AS first_at
  FROM customer_campaigns WINDOW w AS (PARTITION BY customer_id ORDER BY sent_at, customer_campaign_id)),
l AS (SELECT t.campaign_id, round(coalesce(sum(1.0::DOUBLE / c.n), 0), 6) AS linear_credit FROM p t LEFT JOIN p c ON c.customer_id = t.customer_id AND c.converted AND c.n >= t.n GROUP BY 1),
f AS (SELECT first_campaign AS campaign_id, count(*) AS n, {total("conversion_value")} AS v, {avg("date_diff('hour', first_at, sent_at)")} AS h FROM p WHERE converted GROUP BY 1),
e AS (SELECT campaign_id, count(*) AS n, {total("conversion_value")} AS v FROM p WHERE converted GROUP BY 1)
SELECT c.campaign_id, c.campaign_name, linear_credit, coalesce(f.n, 0) AS first_touch, f.v AS first_touch_value, f.h AS avg_hours_to_convert, coalesce(e.n, 0) AS last_touch, e.v AS last_touch_value,
  e.v / CAST(c.budget AS DOUBLE) AS last_touch_roi FROM marketing_campaigns c LEFT JOIN l USING (campaign_id) LEFT JOIN f USING (campaign_id) LEFT JOIN e USING (campaign_id)""")

ask("q_disputes", q.disputes, f"""
WITH r AS (SELECT *, count(*) OVER (PARTITION BY customer_id) > 1 AS again FROM support_interactions WHERE subcategory IN ('DISPUTE', 'REGULATION_E'))
SELECT subcategory, interaction_type, count(*) AS disputes, {avg("resolution_time_minutes")} AS avg_minutes, count(CASE WHEN resolution_time_minutes > 20 THEN 1 END) AS over_limit,
  count(DISTINCT CASE WHEN again THEN customer_id END) AS repeat_customers FROM r GROUP BY 1, 2""")

ask("q_app_engagement", q.app_engagement, f"""
SELECT device_type, CAST(session_start AS DATE) AS day, count(DISTINCT customer_id) AS daily_users, count(*) AS sessions, sum(actions)::BIGINT AS actions, {avg(_flag("biometric_used"))} AS biometric_share,
  count(CASE WHEN suspicious_activity_flag THEN 1 END) AS suspicious, count(DISTINCT geolocation) AS locations FROM device_sessions GROUP BY 1, 2""")

ask("q_credit_building", q.credit_building, f"""
WITH p AS (SELECT customer_id, arg_min(credit_score, pull_date) AS f, arg_max(credit_score, pull_date) AS l, date_diff('day', min(pull_date), max(pull_date)) AS d FROM external_data GROUP BY 1)
SELECT {_band("f")} AS first_band, count(*) AS customers, {avg("l - f")} AS avg_gain, {avg(_flag("l > f"))} AS improved_share, {avg("d")} AS avg_days FROM p GROUP BY 1""")

ask("q_serving_latency", q.serving_latency, f"SELECT feature_id, quantile_cont({_SECS}, 0.5) AS p50, quantile_cont({_SECS}, 0.95) AS p95, quantile_cont({_SECS}, 0.99) AS p99 FROM feature_compute_logs GROUP BY 1")

ask("q_fraud_rings", q.fraud_rings, f"""
WITH RECURSIVE m AS (SELECT DISTINCT customer_id AS c, device_id AS a FROM device_sessions UNION SELECT DISTINCT customer_id, ip_address FROM device_sessions),
e AS (SELECT DISTINCT x.c AS c, y.c AS o FROM m x JOIN m y ON x.a = y.a WHERE x.c <> y.c),
walk(c, o) AS (SELECT c, o FROM e UNION SELECT w.c, e.o FROM walk w JOIN e ON e.c = w.o),
g AS (SELECT c, least(c, min(o)) AS group_id FROM walk GROUP BY c)
SELECT group_id, count(*) AS members, CAST(sum(h.x) AS DOUBLE) AS exposure FROM g JOIN (SELECT customer_id, sum(abs(current_balance)) AS x FROM accounts GROUP BY 1) h ON h.customer_id = g.c GROUP BY 1""")

_CV = "sd / avg_deposit"
ask("q_cash_flow", q.cash_flow, f"""
WITH p AS (SELECT customer_id, count(*) AS deposits, {avg("amount")} AS avg_deposit, stddev_samp(CAST(amount AS DOUBLE)) AS sd, sum(amount) AS tot FROM direct_deposits GROUP BY 1),
l AS (SELECT customer_id, {avg("amount")} AS expected_next FROM (SELECT * FROM direct_deposits QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY deposit_date DESC, deposit_id DESC) <= 6) GROUP BY 1)
SELECT customer_id, deposits, avg_deposit, round({_CV}, 6) AS variation, expected_next, CASE WHEN {_CV} IS NULL THEN 'UNKNOWN' WHEN {_CV} < 0.4 THEN 'STABLE' ELSE 'VARIABLE' END AS income,
  CAST(least(500, round(tot * 0.1, 2)) AS DOUBLE) AS advance_limit FROM p JOIN l USING (customer_id)""")

ask("q_cash_flow_seasonal", q.seasonal_cash_flow, """
WITH m AS (SELECT customer_id, CAST(date_trunc('month', deposit_date) AS DATE) AS month, CAST(sum(amount) AS DOUBLE) AS v FROM direct_deposits GROUP BY 1, 2),
g AS (SELECT customer_id, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM m GROUP BY 1),
z AS (SELECT g.customer_id, g.month, coalesce(v, 0) AS v FROM g LEFT JOIN m USING (customer_id, month)),
f AS (SELECT month(month) AS mm, avg(v) / (SELECT avg(v) FROM z) AS f FROM z GROUP BY 1 HAVING avg(v) > 0),
d AS (SELECT z.customer_id, z.month, v / coalesce(f, 1) AS x, row_number() OVER (PARTITION BY z.customer_id ORDER BY z.month) AS k, count(*) OVER (PARTITION BY z.customer_id) AS n FROM z LEFT JOIN f ON f.mm = month(z.month)),
l AS (SELECT customer_id, max(n) AS months, sum(x * power(0.7, n - k) * CASE WHEN k = 1 THEN 1 ELSE 0.3 END) AS level, CAST(max(month) + INTERVAL 1 MONTH AS DATE) AS next_month FROM d GROUP BY 1)
SELECT customer_id, months, round(level, 4) AS level, next_month, round(level * coalesce(f, 1), 4) AS expected FROM l LEFT JOIN f ON f.mm = month(next_month)""")

ask("q_compliance_score", q.compliance_score, f"""
WITH e AS (SELECT customer_id, count(CASE WHEN event_type = 'SAR' THEN 1 END) AS s, count(CASE WHEN event_type = 'CTR' THEN 1 END) AS t FROM compliance_events GROUP BY 1),
x AS (SELECT customer_id, count(CASE WHEN high_risk_category THEN 1 END) AS r, count(CASE WHEN is_international THEN 1 END) AS i FROM transactions LEFT JOIN merchant_categories ON merchant_category = mcc_code
  WHERE transaction_date >= {TODAY} - 90 GROUP BY 1),
y AS (SELECT c.customer_id, {_flag("s > 0")} * 40 + {_flag("t > 0")} * 20 + {_flag("risk_tier = 'HIGH'")} * 15 + {_flag("r > 5")} * 15 + {_flag("i > 3")} * 10 AS score
  FROM customers c LEFT JOIN e USING (customer_id) LEFT JOIN x USING (customer_id))
SELECT *, CASE WHEN score >= 70 THEN 'URGENT' WHEN score >= 40 THEN 'SOON' ELSE 'ROUTINE' END AS review FROM y""")

ask("q_balance_shift", q.balance_shift, f"""
WITH s AS (SELECT customer_id, min(opening_date) AS f FROM accounts WHERE account_type = 'SAVINGS' GROUP BY 1)
SELECT risk_tier, count(DISTINCT t.customer_id) AS customers, {total("CASE WHEN transaction_date < f THEN amount ELSE 0 END")} AS flow_before, {total("CASE WHEN transaction_date >= f THEN amount ELSE 0 END")} AS flow_after,
  {total("amount")} AS net_flow FROM transactions t JOIN s USING (customer_id) JOIN customers c USING (customer_id) GROUP BY 1""")

ask("q_support_deflection", q.support_deflection, r"""
WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS term FROM documents)
SELECT t.topic, t.tickets, t.minutes, coalesce(a.n, 0) AS articles, coalesce(a.n, 0) = 0 AS is_gap FROM (SELECT lower(category) AS topic, count(*) AS tickets, sum(resolution_time_minutes)::BIGINT AS minutes FROM support_interactions GROUP BY 1) t
LEFT JOIN (SELECT term, count(*) AS n FROM w GROUP BY 1) a ON a.term = t.topic""")


def _points(c: str, full: int, weight: int) -> str:
    return f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(CAST({c} AS DOUBLE), 0) / {full})) * {weight}"


ask("q_health_score", q.health_score, _c360(_C360) + f"""
SELECT customer_id, round({_points("total_deposit_balance", 10000, 25)} + {_points("transactions_30d", 50, 25)} + {_points("total_direct_deposits", 10, 20)} + {_points("avg_satisfaction_score", 5, 15)}
    + {_points("total_accounts", 3, 15)}, 6) AS score,
  CASE WHEN total_deposit_balance >= 10000 THEN 'HIGH_VALUE' WHEN total_deposit_balance >= 1000 THEN 'MEDIUM_VALUE' WHEN total_deposit_balance >= 100 THEN 'LOW_VALUE' ELSE 'MINIMAL_VALUE' END AS value_segment,
  CASE WHEN transactions_30d >= 50 AND total_direct_deposits > 0 THEN 'HIGHLY_ENGAGED' WHEN transactions_30d >= 20 THEN 'ENGAGED' WHEN transactions_30d >= 5 THEN 'OCCASIONAL' ELSE 'DORMANT' END AS engagement_level
FROM w WHERE customer_status = 'ACTIVE' ORDER BY score, customer_id LIMIT 100""")

ask("q_closure_signals", q.closure_signals, f"""
SELECT customer_id IN (SELECT customer_id FROM direct_deposits) AS has_deposit, customer_id IN (SELECT customer_id FROM transactions) AS has_activity, customer_id IN (SELECT customer_id FROM support_interactions) AS has_contact,
  count(*) AS customers, {avg(_flag("customer_status = 'CLOSED'"))} AS closed_share FROM customers GROUP BY 1, 2, 3""")

ask("q_early_deposit_retention", q.early_deposit_retention, f"""
SELECT early_user, count(*) AS customers, {avg(_flag("customer_status = 'ACTIVE'"))} AS retention FROM customers JOIN (SELECT customer_id, bool_or(early_access_used) AS early_user FROM direct_deposits GROUP BY 1) USING (customer_id) GROUP BY 1""")

ask("q_direct_deposit_share", q.direct_deposit_share, f"SELECT address_state, count(*) AS customers, {avg(_flag('customer_id IN (SELECT customer_id FROM direct_deposits)'))} AS deposit_share FROM customers GROUP BY 1")

ask("q_daily_trend", q.daily_trend, f"SELECT transaction_date, count(*) AS total_transactions, {total('abs(amount)')} AS transaction_volume FROM transactions GROUP BY 1")

ask("q_acquisition_trend", q.acquisition_trend, "SELECT CAST(date_trunc('month', acquisition_date) AS DATE) AS month, acquisition_channel, count(*) AS customers FROM customers GROUP BY 1, 2")

ask("q_top_categories", q.top_categories, f"""SELECT category_group, {total("abs(amount)")} AS transaction_volume, count(*) AS total_transactions FROM transactions LEFT JOIN merchant_categories ON merchant_category = mcc_code
GROUP BY 1 ORDER BY transaction_volume DESC, category_group LIMIT 5""")

ask("q_avg_by_account_type", q.avg_by_account_type, f"SELECT account_type, {avg('abs(amount)')} AS avg_transaction_amount, {avg('fraud_score')} AS avg_fraud_score FROM transactions JOIN accounts USING (account_id) GROUP BY 1")

ask("q_compliance_90d", q.compliance_90d, f"""SELECT event_type, severity, count(*) AS events, count(DISTINCT customer_id) AS customers, count(CASE WHEN NOT resolved THEN 1 END) AS unresolved FROM compliance_events
WHERE event_date >= {TODAY} - 90 GROUP BY 1, 2""")


ask("q_advance_segments", q.advance_segments, f"""
WITH x AS (SELECT risk_tier, employment_status, acquisition_channel, count(*) AS advances, {avg(_flag("advance_status = 'DEFAULTED'"))} AS default_rate, {total(_LOST)} AS default_volume,
  CAST(sum({_PAID}) - sum({_LOST}) AS DOUBLE) AS profit FROM cash_advances JOIN customers USING (customer_id) GROUP BY 1, 2, 3)
SELECT *, default_volume / nullif(sum(default_volume) OVER (), 0) AS share_of_losses FROM x""")

ask("q_advance_trend", q.advance_trend, f"""
WITH x AS (SELECT CAST(date_trunc('month', advance_date) AS DATE) AS month, count(*) AS advances, {avg(_flag("advance_status = 'DEFAULTED'"))} AS default_rate,
  CAST(sum({_PAID}) - sum({_LOST}) AS DOUBLE) AS profit FROM cash_advances GROUP BY 1)
SELECT *, default_rate - lag(default_rate) OVER (ORDER BY month) AS rate_change FROM x""")

ask("q_advance_default_times", q.advance_default_times, f"""
WITH x AS (SELECT {_band("credit_score")} AS score_band, CAST(floor(date_diff('day', advance_date, repayment_date) / 7) AS BIGINT) AS week, count(*) AS defaults
  FROM cash_advances JOIN customers USING (customer_id) WHERE advance_status = 'DEFAULTED' AND repayment_date IS NOT NULL GROUP BY 1, 2)
SELECT *, CAST(sum(defaults) OVER (PARTITION BY score_band ORDER BY week) AS DOUBLE) / sum(defaults) OVER (PARTITION BY score_band) AS share_so_far FROM x""")

_DAY = f"transaction_timestamp >= {NOW} - INTERVAL 24 HOUR"
ask("q_fraud_international", q.fraud_international, f"""
SELECT is_international, transaction_category, count(*) AS transactions, {total("abs(amount)")} AS volume, {avg(_flag("status = 'DECLINED'"))} AS declined_share, {avg("fraud_score")} AS avg_fraud_score,
  {avg(_flag("fraud_score > 0.5"))} AS risky_share FROM transactions WHERE {_DAY} GROUP BY 1, 2""")

ask("q_fraud_top10", q.fraud_top, f"""
SELECT transaction_id, customer_id, CAST(amount AS DOUBLE) AS amount, merchant_name, is_international, CAST(fraud_score AS DOUBLE) AS fraud_score FROM transactions WHERE {_DAY}
ORDER BY fraud_score DESC NULLS LAST, abs(transactions.amount) DESC NULLS LAST, transaction_id LIMIT 10""")

ask("q_support_segments", q.support_segments, f"""
WITH o AS (SELECT customer_id, count(*) AS n, sum(resolution_time_minutes) AS m FROM support_interactions GROUP BY 1),
x AS (SELECT risk_tier, acquisition_channel, {_flag("customer_status = 'CLOSED'")} AS closed, coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM customers LEFT JOIN o USING (customer_id))
SELECT risk_tier, acquisition_channel, count(*) AS customers, CAST(sum(n) AS BIGINT) AS contacts, CAST(sum(m) AS DOUBLE) * 0.75 AS cost, CAST(sum(m) AS DOUBLE) * 0.75 / count(*) AS cost_per_customer,
  round({corr("n", "closed")}, 6) AS contact_closure_corr FROM x GROUP BY 1, 2""")

#: What support asks its transcripts; the words are those of the supplied texts.
_HOW = [("h1", "ment equen tion"), ("h2", "nicht einach")]
_HOW_TERMS = ", ".join(f"('{i}', '{w}')" for i, t in _HOW for w in words_of(t))
ask("q_support_resolutions", lambda b: q.support_resolutions(b, _HOW), f"""
WITH ask(query_id, term) AS (VALUES {_HOW_TERMS}),
tok AS (SELECT t.interaction_id, {words_sql("transcript_text")} AS words FROM support_transcripts t JOIN support_interactions s USING (interaction_id) WHERE s.issue_resolved AND transcript_text IS NOT NULL),
post AS (SELECT interaction_id, term, n AS length, count(*) AS tf FROM (SELECT interaction_id, len(words) AS n, unnest(words) AS term FROM tok) GROUP BY 1, 2, 3),
dfs AS (SELECT term, count(*) AS df FROM post GROUP BY 1), size AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(len(words)) AS DOUBLE) / count(*) AS al FROM tok),
scored AS (SELECT query_id, interaction_id, round(sum(ln(1 + (size.n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * length / size.al))), 9) AS score
  FROM post JOIN ask USING (term) JOIN dfs USING (term), size GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, interaction_id) AS INT) AS rank FROM scored QUALIFY rank <= 5)
SELECT query_id, interaction_id, score, rank, interaction_type, category, resolution_time_minutes AS minutes FROM ranked JOIN support_interactions USING (interaction_id)""")
