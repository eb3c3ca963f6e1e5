"""Business questions on made tables."""

import datetime as dt
import random
from types import SimpleNamespace

from pyspark.sql import functions as F

from kontora.plans import questions as q


def test_attribution_of_a_busy_customer(spark):
    rng = random.Random(6)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        who = 1 if i % 3 == 0 else i % 400 + 2
        rows.append((who, rng.randrange(4), i, start + dt.timedelta(minutes=rng.randrange(20 * 1440)), rng.random() < 0.2, 10.0))
    touches = spark.createDataFrame(rows, "customer_id long, campaign_id int, customer_campaign_id long, sent_at timestamp_ntz, converted boolean, conversion_value double")
    plans = spark.createDataFrame([(c, f"c{c}", 100.0) for c in range(5)], "campaign_id int, campaign_name string, budget double")
    got = {r.campaign_id: r for r in q.attribution(SimpleNamespace(customer_campaigns=touches, marketing_campaigns=plans)).collect()}
    linear, first, last = ([0.0] * 4, [0] * 4, [0] * 4)
    paths = {}
    for r in sorted(rows, key=lambda r: (r[3], r[2])):
        path = paths.setdefault(r[0], [])
        path.append(r[1])
        if r[4]:
            for c in path:
                linear[c] += 1 / len(path)
            first[path[0]] += 1
            last[r[1]] += 1
    for c in range(4):
        assert abs(got[c].linear_credit - linear[c]) < 1e-3 and (got[c].first_touch, got[c].last_touch) == (first[c], last[c])
    assert got[4].linear_credit is None and got[4].last_touch == 0


def test_seasonal_estimate_folds_months_in_order(spark):
    """Against plain arithmetic: gaps count as empty months, December pays double, one customer has a single month."""
    rng = random.Random(8)
    rows, paid = [], {}
    for who in range(1, 6):
        for k in range(1 if who == 5 else 20):
            if who == 2 and k in (4, 5, 11):
                continue
            year, month = 2022 + k // 12, k % 12 + 1
            for part in range(2):
                amount = rng.randrange(100, 900) * (2 if month == 12 else 1)
                rows.append((who, 10 * who + k, dt.date(year, month, 3 + part), amount))
                paid.setdefault(who, {}).setdefault(k, 0)
                paid[who][k] += amount
    rows.append((1, 999, None, 5))
    deposits = spark.createDataFrame(rows, "customer_id long, deposit_id long, deposit_date date, amount int").withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    got = {r.customer_id: r for r in q.seasonal_cash_flow(SimpleNamespace(direct_deposits=deposits)).collect()}
    series = {who: [p.get(k, 0) for k in range(min(p), max(p) + 1)] for who, p in paid.items()}
    every = [(k % 12, v) for s in series.values() for k, v in enumerate(s)]
    mean = sum(v for _, v in every) / len(every)
    factor = {m: sum(v for n, v in every if n == m) / sum(1 for n, _ in every if n == m) / mean for m in {m for m, _ in every}}
    assert factor[11] > 1.5 and set(got) == set(series)
    for who, s in series.items():
        level = s[0] / factor[0]
        for k, v in list(enumerate(s))[1:]:
            level += 0.3 * (v / factor[k % 12] - level)
        assert got[who].months == len(s) and abs(got[who].level - level) < 1e-3
        assert abs(got[who].expected - level * factor[len(s) % 12]) < 1e-3
    assert q.seasonal_cash_flow(SimpleNamespace(direct_deposits=deposits.limit(0))).collect() == []
