"""Metric layer: named metrics and dimensions over related tables.

A metric is evaluated at the grain of its own table, so joining dimensions never
repeats a row: dimensions are reached from child to parent only, by the shortest
path. Metrics of different tables meet on the shared dimensions.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from kontora.functions.scalars import month_earlier
from kontora.operators.joins import full_stitch

#: SQL of the aggregates a metric may be made of.
AGGREGATES = {"sum": "SUM({})", "count": "COUNT({})", "min": "MIN({})", "max": "MAX({})", "distinct": "COUNT(DISTINCT {})"}


@dataclass(frozen=True)
class Metric:
    """A formula over aggregates: ``{0}``, ``{1}`` .. stand for ``states``, each a kind of aggregate and its input.

    States of ever finer groups add up, so such a metric can be answered from stored rollups (``rollups.py``).
    """

    formula: str
    states: tuple[tuple[str, str], ...]

    def bound(self, month_ago: str) -> Metric:
        return Metric(self.formula, tuple((kind, x.format(month_ago=month_ago)) for kind, x in self.states))

    def sql(self) -> str:
        return self.formula.format(*[AGGREGATES[kind].format(x) for kind, x in self.states])


@dataclass(frozen=True)
class SemanticView:
    name: str
    keys: dict[str, str]  # table -> primary key
    links: list[tuple[str, str, str]]  # child, foreign key column, parent
    dimensions: dict[str, str]  # name -> table holding the column
    metrics: dict[str, Metric | str]  # "table.name" -> metric, or an aggregate expression that is always taken from the rows
    synonyms: dict[str, list[str]] = field(default_factory=dict)  # table -> names

    def metric(self, name: str) -> tuple[str, Metric | str]:
        """(table, definition) of a metric given as name or table.name."""
        hits = [m for m in self.metrics if m == name or m.split(".")[1] == name]
        if len(hits) != 1:
            raise KeyError(f"{name}: {'unknown' if not hits else 'say which of ' + ', '.join(hits)}")
        return hits[0].split(".")[0], self.metrics[hits[0]]

    def path(self, start: str, goal: str) -> list[tuple[str, str, str]] | None:
        """Shortest chain of child-to-parent links."""
        queue: deque = deque([(start, [])])
        seen = {start}
        while queue:
            at, steps = queue.popleft()
            if at == goal:
                return steps
            for link in self.links:
                if link[0] == at and link[2] not in seen:
                    seen.add(link[2])
                    queue.append((link[2], steps + [link]))
        return None

    def reachable(self, metric: str) -> list[str]:
        """Dimensions that a metric can be split by."""
        table, _ = self.metric(metric)
        return [d for d, t in self.dimensions.items() if self.path(table, t) is not None]


def with_dimensions(b, view: SemanticView, table: str, dims: Sequence[str]) -> DataFrame:
    """The table with the dimension columns ``d_<name>`` it can reach."""
    df = getattr(b, table)
    wanted: dict[str, list[str]] = {}
    for d in dims:
        if d not in view.dimensions:
            raise KeyError(f"no dimension {d} in {view.name}")
        wanted.setdefault(view.dimensions[d], []).append(d)
    local = wanted.pop(table, [])
    df = df.select("*", *[F.col(d).alias(f"d_{d}") for d in local])
    # the foreign keys along each path decide which parents have to be read
    joined = {table}
    needed: list[tuple[str, str, str]] = []
    for parent in wanted:
        steps = view.path(table, parent)
        if steps is None:
            raise ValueError(f"{parent} cannot be reached from {table}")
        needed += [s for s in steps if s not in needed]
    for child, column, parent in needed:
        if parent in joined:
            continue
        joined.add(parent)
        onward = [c for ch, c, _ in needed if ch == parent]
        side = getattr(b, parent).select(
            F.col(view.keys[parent]).alias(f"k_{parent}"),
            *[F.col(d).alias(f"d_{d}") for d in wanted.get(parent, [])],
            *[F.col(c).alias(f"f_{parent}_{c}") for c in dict.fromkeys(onward)],
        )
        on = F.col(column if child == table else f"f_{child}_{column}") == F.col(f"k_{parent}")
        df = df.join(side, on, "left").drop(f"k_{parent}")
    return df


def bound_metric(b, metric: Metric | str) -> Metric | str:
    """The metric as of the bank's day."""
    month = f"DATE '{month_earlier(b.as_of)}'"
    return metric.bound(month) if isinstance(metric, Metric) else metric.format(month_ago=month)


def semantic_query(
    b, view: SemanticView, metrics: Sequence[str], dimensions: Sequence[str] = (), where: str | None = None,
    where_dimensions: Sequence[str] = (), rollups=None,
) -> DataFrame:
    """Metrics split by dimensions.

    ``where`` is a condition over dimension names; those it uses are listed in
    ``where_dimensions``. One grouped pass per metric table. With ``rollups`` a table whose
    metrics a stored level covers is answered from the smallest such level, the others from their rows.
    """
    by_table: dict[str, dict[str, Metric | str]] = {}
    for m in metrics:
        table, definition = view.metric(m)
        by_table.setdefault(table, {})[m.replace(".", "_")] = bound_metric(b, definition)
    condition = where
    for d in where_dimensions:
        condition = condition and condition.replace("{" + d + "}", f"d_{d}")
    used = list(dict.fromkeys([*dimensions, *where_dimensions]))
    out = None
    for table, wanted in by_table.items():
        part = rollups.answer(view, table, wanted, dimensions, used, condition) if rollups is not None else None
        if part is None:
            rows = with_dimensions(b, view, table, used)
            if condition:
                rows = rows.where(condition)
            exprs = [F.expr(m.sql() if isinstance(m, Metric) else m).alias(n) for n, m in wanted.items()]
            part = rows.groupBy(*[F.col(f"d_{d}").alias(d) for d in dimensions]).agg(*exprs)
        out = part if out is None else full_stitch(out, part, list(dimensions))
    return out


def synonym_rows(view: SemanticView) -> list[tuple[str, str, str]]:
    """(synonym, kind, object). Dimensions and metrics also answer to their words."""
    rows = [(s, "table", t) for t, names in view.synonyms.items() for s in names]
    rows += [(d.replace("_", " "), "dimension", f"{t}.{d}") for d, t in view.dimensions.items()]
    rows += [(m.split(".")[1].replace("_", " "), "metric", m) for m in view.metrics]
    return rows


def _sum(x: str) -> Metric:
    return Metric("{0}", (("sum", x),))


def _avg(x: str) -> Metric:
    return Metric("CAST({0} AS DOUBLE) / NULLIF({1}, 0)", (("sum", x), ("count", x)))


def _share(part: str, whole: tuple[str, str]) -> Metric:
    """Of the inputs named by ``whole``, those of ``part``; both counted or both summed."""
    kind, x = whole
    return Metric("CAST({0} AS DOUBLE) / NULLIF(CAST({1} AS DOUBLE), 0)", ((kind, part), (kind, x)))


def _all(key: str) -> Metric:
    return Metric("{0}", (("count", key),))


def _count(test: str, key: str) -> Metric:
    # keys are unique, so counting them needs no distinct
    return Metric("{0}", (("count", f"CASE WHEN {test} THEN {key} END"),))


def _distinct(x: str) -> Metric:
    return Metric("{0}", (("distinct", x),))


CUSTOMER_BANKING = SemanticView(
    "customer_banking",
    {"customers": "customer_id", "accounts": "account_id", "cards": "card_id", "direct_deposits": "deposit_id",
     "cash_advances": "advance_id", "support_interactions": "interaction_id"},
    [
        ("accounts", "customer_id", "customers"), ("cards", "customer_id", "customers"), ("cards", "account_id", "accounts"),
        ("direct_deposits", "customer_id", "customers"), ("direct_deposits", "account_id", "accounts"),
        ("cash_advances", "customer_id", "customers"), ("cash_advances", "account_id", "accounts"),
        ("support_interactions", "customer_id", "customers"),
    ],
    {
        **dict.fromkeys(["customer_id", "email", "customer_status", "kyc_status", "risk_tier", "acquisition_channel",
                         "employment_status", "address_state"], "customers"),
        **dict.fromkeys(["account_type", "account_status", "apy_rate"], "accounts"),
        **dict.fromkeys(["card_type", "card_status"], "cards"),
        **dict.fromkeys(["deposit_type", "frequency"], "direct_deposits"),
        "advance_status": "cash_advances",
        **dict.fromkeys(["interaction_type", "category"], "support_interactions"),
    },
    {
        "customers.total_customers": _all("customer_id"),
        "customers.active_customers": _count("customer_status = 'ACTIVE'", "customer_id"),
        "customers.avg_credit_score": _avg("credit_score"),
        "customers.avg_income": _avg("income_verified"),
        "accounts.total_accounts": _all("account_id"),
        "accounts.checking_accounts": _count("account_type = 'CHECKING'", "account_id"),
        "accounts.savings_accounts": _count("account_type = 'SAVINGS'", "account_id"),
        "accounts.credit_accounts": _count("account_type IN ('BELIEVE_CARD', 'LINE_OF_CREDIT')", "account_id"),
        "accounts.avg_checking_balance": _avg("CASE WHEN account_type = 'CHECKING' THEN current_balance END"),
        "accounts.avg_savings_balance": _avg("CASE WHEN account_type = 'SAVINGS' THEN current_balance END"),
        "accounts.total_deposits": _sum("CASE WHEN account_type IN ('CHECKING', 'SAVINGS') THEN current_balance ELSE 0 END"),
        "cards.active_cards": _count("card_status = 'ACTIVE'", "card_id"),
        "direct_deposits.total_deposits": _all("deposit_id"),
        "direct_deposits.avg_deposit_amount": _avg("amount"),
        "direct_deposits.monthly_deposit_volume": _sum("CASE WHEN deposit_date >= {month_ago} THEN amount END"),
        "cash_advances.total_advances": _all("advance_id"),
        "cash_advances.active_advances": _count("advance_status = 'ACTIVE'", "advance_id"),
        "cash_advances.avg_advance_amount": _avg("advance_amount"),
        "cash_advances.default_rate": _share("CASE WHEN advance_status = 'DEFAULTED' THEN advance_id END", ("count", "advance_id")),
        "support_interactions.total_interactions": _all("interaction_id"),
        "support_interactions.avg_satisfaction": _avg("satisfaction_score"),
    },
    {  # fixed values
        "customers": ["bank customers", "account holders"],
        "accounts": ["bank accounts", "customer accounts", "financial accounts"],
        "cards": ["debit cards", "credit cards", "payment cards"],
        "direct_deposits": ["payroll deposits", "recurring deposits", "employer deposits"],
        "cash_advances": ["payday advances", "short term loans"],
        "support_interactions": ["customer support", "service interactions", "help requests"],
    },
)

TRANSACTION_PAYMENT = SemanticView(
    "transaction_payment",
    {"transactions": "transaction_id", "accounts": "account_id", "customers": "customer_id",
     "merchant_categories": "mcc_code", "cards": "card_id"},
    [
        ("transactions", "account_id", "accounts"), ("transactions", "customer_id", "customers"),
        ("transactions", "merchant_category", "merchant_categories"), ("accounts", "customer_id", "customers"),
        ("cards", "account_id", "accounts"), ("cards", "customer_id", "customers"),
    ],
    {
        **dict.fromkeys(["transaction_type", "transaction_category", "transaction_date", "merchant_name", "merchant_category",
                         "merchant_state", "is_recurring", "is_international", "status"], "transactions"),
        **dict.fromkeys(["category_name", "category_group", "cashback_eligible", "high_risk_category"], "merchant_categories"),
        "account_type": "accounts", "customer_status": "customers",
    },
    {
        "transactions.total_transactions": _all("transaction_id"),
        "transactions.transaction_volume": _sum("ABS(amount)"),
        "transactions.avg_transaction_amount": _avg("ABS(amount)"),
        "transactions.debit_volume": _sum("CASE WHEN transaction_type = 'DEBIT' THEN ABS(amount) ELSE 0 END"),
        "transactions.credit_volume": _sum("CASE WHEN transaction_type = 'CREDIT' THEN amount ELSE 0 END"),
        "transactions.atm_volume": _sum("CASE WHEN transaction_category = 'ATM' THEN ABS(amount) ELSE 0 END"),
        "transactions.pos_transactions": _count("transaction_category = 'POS'", "transaction_id"),
        "transactions.online_transactions": _count("transaction_category = 'ONLINE'", "transaction_id"),
        "transactions.recurring_count": _count("is_recurring", "transaction_id"),
        "transactions.international_count": _count("is_international", "transaction_id"),
        "transactions.declined_count": _count("status = 'DECLINED'", "transaction_id"),
        "transactions.unique_merchants": _distinct("merchant_name"),
        "transactions.unique_categories": _distinct("merchant_category"),
        # filtered by the category dimensions, not here
        "transactions.cashback_eligible_volume": _sum("ABS(amount)"),
        "transactions.high_risk_volume": _sum("ABS(amount)"),
        "transactions.avg_fraud_score": _avg("fraud_score"),
    },
    {  # fixed values
        "transactions": ["payments", "financial transactions", "money movements"],
        "accounts": ["source accounts", "transaction accounts", "payment accounts"],
        "customers": ["transaction customers", "payers", "account owners"],
        "merchant_categories": ["merchant types", "business categories", "mcc codes"],
        "cards": ["payment instruments", "transaction cards", "plastic cards"],
    },
)

CREDIT_RISK = SemanticView(
    "credit_risk",
    {"credit_applications": "application_id", "cash_advances": "advance_id", "accounts": "account_id",
     "customers": "customer_id", "external_data": "external_data_id", "compliance_events": "event_id"},
    [
        ("credit_applications", "customer_id", "customers"), ("cash_advances", "customer_id", "customers"),
        ("cash_advances", "account_id", "accounts"), ("accounts", "customer_id", "customers"),
        ("external_data", "customer_id", "customers"), ("compliance_events", "customer_id", "customers"),
    ],
    {
        **dict.fromkeys(["product_type", "application_status", "decision_reason_codes"], "credit_applications"),
        "advance_status": "cash_advances",
        **dict.fromkeys(["account_type", "credit_limit"], "accounts"),
        **dict.fromkeys(["credit_score", "risk_tier", "employment_status"], "customers"),
        **dict.fromkeys(["data_source", "data_type"], "external_data"),
        **dict.fromkeys(["event_type", "severity"], "compliance_events"),
    },
    {
        "credit_applications.total_applications": _all("application_id"),
        "credit_applications.approved_applications": _count("application_status = 'APPROVED'", "application_id"),
        "credit_applications.approval_rate": _share("CASE WHEN application_status = 'APPROVED' THEN application_id END", ("count", "application_id")),
        "credit_applications.avg_approved_amount": _avg("approved_amount"),
        "cash_advances.total_advance_volume": _sum("advance_amount"),
        "cash_advances.outstanding_balance": _sum("CASE WHEN advance_status = 'ACTIVE' THEN advance_amount + fee_amount ELSE 0 END"),
        "cash_advances.default_volume": _sum("CASE WHEN advance_status = 'DEFAULTED' THEN advance_amount ELSE 0 END"),
        "cash_advances.collection_rate": _share("CASE WHEN advance_status = 'REPAID' THEN repayment_amount ELSE 0 END", ("sum", "advance_amount + fee_amount")),
        "cash_advances.avg_days_to_repay": _avg("CASE WHEN advance_status = 'REPAID' THEN datediff(repayment_date, advance_date) END"),
        "accounts.total_credit_exposure": _sum("credit_limit"),
        "accounts.credit_utilization": _avg("CASE WHEN credit_limit > 0 THEN CAST(ABS(current_balance) AS DOUBLE) / CAST(credit_limit AS DOUBLE) END"),
        "cash_advances.avg_risk_score": _avg("default_risk_score"),
        "external_data.verified_customers": _distinct("CASE WHEN data_type = 'INCOME_VERIFICATION' THEN customer_id END"),
        "compliance_events.total_events": _all("event_id"),
        "compliance_events.high_severity_events": _count("severity IN ('HIGH', 'CRITICAL')", "event_id"),
    },
    {  # fixed values
        "credit_applications": ["loan applications", "credit requests", "lending applications"],
        "cash_advances": ["short term lending", "payday loans risk", "advance lending"],
        "accounts": ["credit accounts risk", "lending products", "credit lines"],
        "customers": ["borrowers", "credit customers", "lending clients"],
        "external_data": ["credit bureau data", "third party data", "external credit info"],
        "compliance_events": ["regulatory events", "compliance issues", "risk events"],
    },
)

VIEWS = {v.name: v for v in (CUSTOMER_BANKING, TRANSACTION_PAYMENT, CREDIT_RISK)}
