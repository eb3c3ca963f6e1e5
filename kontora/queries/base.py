"""Query registry and the SQL spelling of the banking tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from kontora.plans import registry as feature_registry
from kontora.sources.banking import Bank
from kontora.sources.mapping import AS_OF, AS_OF_ORDERS, DUCKDB, FEATURE_IDS, MAPPING

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TODAY = f"DATE '{AS_OF}'"
NOW = f"TIMESTAMP '{AS_OF} 00:00:00'"
TODAY_ORDERS = f"DATE '{AS_OF_ORDERS}'"
NOW_ORDERS = f"TIMESTAMP '{AS_OF_ORDERS} 00:00:00'"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which both engines print alike."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None):
    """Register ``fn(bank) -> DataFrame`` under a name, with its check."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: plain(fn(Bank(spark, folder)))
        if sql is not None:
            SQL[name] = with_tables(sql)
        return fn

    return wrap


_BASES = {
    "customer_nation": "customer JOIN nation ON c_nationkey = n_nationkey",
    "conversation_heads": "(SELECT conv_id, count(*) AS n_turns, (SELECT count(*) FROM customer) AS n_customers FROM conversations GROUP BY conv_id) heads",
}


def _mapped_sql(name: str) -> str:
    spec = MAPPING[name]
    cols = ", ".join(f"{DUCKDB.fill(e)} AS {c}" for c, e in spec.columns.items())
    source = _BASES.get(spec.base, spec.base)
    if spec.copies > 1:
        source += ", (VALUES " + ", ".join(f"({i})" for i in range(spec.copies)) + ") copies(k2)"
    where = f" WHERE {DUCKDB.fill(spec.where)}" if spec.where else ""
    return f"SELECT {cols} FROM {source}{where}"


def _values(columns: list[str], rows: list[tuple]) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, (int, float)):
            return str(v)
        if isinstance(v, list):
            return "[" + ", ".join(lit(x) for x in v) + "]"
        return "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) v({', '.join(columns)})"


TABLE_SQL: dict[str, str] = {name: _mapped_sql(name) for name in MAPPING}
TABLE_SQL["feature_daily"] = """
SELECT customer_id, transaction_date, CAST(count(*) AS DOUBLE) AS n, CAST(sum(abs(amount)) AS DOUBLE) AS v,
       CAST(count(CASE WHEN fraud_score > 0.5 THEN 1 END) AS DOUBLE) AS f
FROM transactions GROUP BY customer_id, transaction_date"""
TABLE_SQL["feature_values"] = " UNION ALL ".join(
    f"SELECT CAST(customer_id AS VARCHAR) AS entity_id, 'CUSTOMER' AS entity_type, '{f}' AS feature_id, {e} AS feature_value, "
    "CAST(transaction_date AS TIMESTAMP) + INTERVAL 86399 SECOND AS feature_timestamp, "
    "CAST(transaction_date AS TIMESTAMP) + INTERVAL 86399 SECOND AS created_at FROM feature_daily"
    for f, e in ((FEATURE_IDS[0], "n"), (FEATURE_IDS[1], "v"), (FEATURE_IDS[5], "f / n"))
)
_PCT = {25: 0.25, 50: 0.5, 75: 0.75, 95: 0.95, 99: 0.99}
TABLE_SQL["feature_statistics"] = """
SELECT feature_id, CAST(feature_timestamp AS DATE) AS computation_date,
       round(avg(feature_value), 6) AS mean_value, round(stddev_samp(feature_value), 6) AS std_deviation,
       round(min(feature_value), 6) AS min_value, round(max(feature_value), 6) AS max_value,
       count(CASE WHEN feature_value IS NULL THEN 1 END) AS null_count,
       count(DISTINCT feature_value) AS unique_count, count(*) AS total_count, """ + ", ".join(
    f"round(quantile_cont(feature_value, {p}), 6) AS percentile_{n}" for n, p in _PCT.items()
) + " FROM feature_values GROUP BY 1, 2"
TABLE_SQL["feature_definitions"] = _values(feature_registry.DEFINITION_COLUMNS, feature_registry.DEFINITION_ROWS)
TABLE_SQL["feature_sets"] = _values(feature_registry.SET_COLUMNS, feature_registry.SET_ROWS)
TABLE_SQL["model_features"] = _values(feature_registry.MODEL_COLUMNS, feature_registry.MODEL_ROWS)
TABLE_SQL["feature_latest"] = """
SELECT entity_id, entity_type, feature_id, arg_max(feature_value, feature_timestamp) AS feature_value,
       max(feature_timestamp) AS feature_timestamp
FROM feature_values GROUP BY entity_id, entity_type, feature_id"""
TABLE_SQL["online_features"] = f"""
SELECT entity_id, entity_type, max(feature_timestamp) AS last_updated, """ + ", ".join(
    f"max(CASE WHEN feature_id = '{f}' THEN feature_value END) AS {f}"
    for f in (FEATURE_IDS[0], FEATURE_IDS[1], FEATURE_IDS[5])
) + " FROM feature_latest GROUP BY entity_id, entity_type"
TABLE_SQL["session_marks"] = """
SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                 OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh
FROM events"""
TABLE_SQL["session_rows"] = """
SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM session_marks"""
TABLE_SQL["device_sessions"] = f"""
SELECT concat_ws('-', CAST(user_id AS VARCHAR), CAST(CAST(floor(epoch(min(ts))) AS BIGINT) AS VARCHAR)) AS session_id,
       user_id AS customer_id, concat('D', CAST(user_id % 40 AS VARCHAR)) AS device_id,
       CASE user_id % 3 WHEN 0 THEN 'IOS' WHEN 1 THEN 'ANDROID' ELSE 'WEB' END AS device_type,
       concat('10.0.0.', CAST(user_id % 60 AS VARCHAR)) AS ip_address,
       concat('S', CAST(CAST(floor(epoch(min(ts))) AS BIGINT) % 5 AS VARCHAR)) AS geolocation,
       min(ts) AS session_start, max(ts) AS session_end, count(*) AS actions,
       bool_or({DUCKDB.k} % 2 = 0) AS biometric_used, bool_or(event_type = 'error') AS suspicious_activity_flag
FROM session_rows GROUP BY user_id, session_no"""
TABLE_SQL["support_transcripts"] = """
SELECT conv_id AS interaction_id, s.customer_id, s.agent_id, s.interaction_date, s.interaction_type,
       s.category, s.subcategory, string_agg(concat(role, ': ', text), chr(10) ORDER BY turn) AS transcript_text,
       count(*) AS n_turns
FROM conversations JOIN support_interactions s ON s.interaction_id = conv_id
GROUP BY ALL"""

_NAMES = re.compile(r"\b(" + "|".join(sorted(TABLE_SQL, key=len, reverse=True)) + r")\b")


def _needs(text: str, done: dict[str, str]) -> None:
    for name in dict.fromkeys(_NAMES.findall(text)):
        if name not in done:
            _needs(TABLE_SQL[name], done)
            done.setdefault(name, TABLE_SQL[name].strip())


def with_tables(sql: str) -> str:
    """Put the tables a query names in front of it as CTEs."""
    done: dict[str, str] = {}
    _needs(sql, done)
    if not done:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({t})" for n, t in done.items())
    body = sql.strip()
    recursive = ""
    if re.match(r"WITH\s+RECURSIVE\b", body, re.I):
        recursive = "RECURSIVE "
        body = "WITH " + re.sub(r"^WITH\s+RECURSIVE\s+", "", body, flags=re.I)
    if re.match(r"WITH\b", body, re.I):
        return f"WITH {recursive}{ctes},\n" + body[4:].lstrip()
    return f"WITH {ctes}\n{body}"


# Spellings used over and over in the checks.
def avg(expr: str) -> str:
    return f"(CAST(sum({expr}) AS DOUBLE) / nullif(count({expr}), 0))"


def total(expr: str) -> str:
    return f"CAST(sum({expr}) AS DOUBLE)"


def corr(y: str, x: str) -> str:
    """Over rows where both are set; neither may be an aggregate."""
    ys, xs = (f"CASE WHEN ({y}) IS NOT NULL AND ({x}) IS NOT NULL THEN CAST({e} AS DOUBLE) END" for e in (y, x))
    return f"(covar_pop({ys}, {xs}) / nullif(stddev_pop({ys}) * stddev_pop({xs}), 0))"


def share0(top: str, bottom: str) -> str:
    return (
        f"CASE WHEN coalesce(CAST({bottom} AS DOUBLE), 0) = 0 THEN 0.0::DOUBLE "
        f"ELSE CAST({top} AS DOUBLE) / CAST({bottom} AS DOUBLE) END"
    )
