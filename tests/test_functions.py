import datetime as dt

from pyspark.sql import functions as F

from kontora.functions import scalars as S


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_date_diff_counts_boundaries(spark):
    a, b = ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:01")
    assert one(spark, S.date_diff("minute", a, b), S.date_diff("second", a, b), S.date_diff("hour", a, b)) == (1, 2, 0)
    y = S.date_diff("year", F.lit("2023-12-31").cast("date"), F.lit("2024-01-01").cast("date"))
    m = S.date_diff("month", F.lit("2023-11-30").cast("date"), F.lit("2024-02-01").cast("date"))
    assert one(spark, y, m) == (1, 3)
    assert one(spark, S.date_diff("minute", b, a), S.date_diff("millisecond", a, b)) == (-1, 2000)


def test_date_diff_does_not_depend_on_the_session_zone(spark):
    a, b = ts("2024-03-10 00:30:00.250"), ts("2024-03-10 05:15:00.5")  # clocks change in New York that night
    units = ["hour", "minute", "second", "millisecond", "day"]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, *[S.date_diff(u, a, b) for u in units]) == (5, 285, 17100, 17100250, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_constant_side_has_no_correlation(spark):
    df = spark.createDataFrame([(1, 2.0, 5), (1, 4.0, 7), (1, 6.0, 9), (1, None, 1)], "k int, x double, y int")
    r = df.agg(S.corr("k", "x").alias("c"), S.corr("y", "x").alias("d"), S.slope("y", F.col("x").cast("int")).alias("s")).first()
    assert r.c is None and abs(r.d - 1) < 1e-12 and r.s == 1.0


def test_ratios(spark):
    n = F.lit(None).cast("int")
    assert one(spark, S.ratio0(F.lit(4), F.lit(0)), S.ratio0(F.lit(4), n), S.ratio0(F.lit(1), F.lit(4))) == (0.0, 0.0, 0.25)
    assert one(spark, S.ratio(F.lit(4), F.lit(0)), S.ratio0(n, F.lit(2))) == (None, None)


def test_bands_take_the_first_that_passes(spark):
    b = lambda v: S.band(F.lit(v), [(0.7, "HIGH"), (0.4, "MEDIUM")], "LOW")
    assert one(spark, b(0.71), b(0.7), b(0.4), b(None)) == ("HIGH", "MEDIUM", "LOW", "LOW")


def test_clamp_pick_and_weekend(spark):
    assert one(spark, S.clamp(F.lit(5.0), 0.0, 1.0), S.clamp(F.lit(-5.0), 0.0, 1.0)) == (1.0, 0.0)
    assert one(spark, S.pick(["a", "b", "c"], F.lit(4)), S.pick(["a", "b", "c"], F.lit(-1))) == ("b", "c")
    d = lambda t: S.is_weekend(F.lit(t).cast("date"))
    assert one(spark, d("2024-01-06"), d("2024-01-07"), d("2024-01-08")) == (True, True, False)


def test_draw_is_even_and_repeatable(spark):
    df = spark.range(20000).select(S.draw("id", "s", 10).alias("d"))
    counts = [r["count"] for r in df.groupBy("d").count().collect()]
    assert len(counts) == 10 and min(counts) > 1800 and max(counts) < 2200


def test_month_earlier():
    assert S.month_earlier(dt.date(2024, 3, 31)) == dt.date(2024, 2, 29)
    assert S.month_earlier(dt.date(2024, 1, 31)) == dt.date(2023, 12, 31)


def test_risk_score(spark):
    from kontora.plans.activity import score_transaction_risk

    df = spark.createDataFrame(
        [('{"amount": 1500, "is_international": true, "merchant_category": "7995"}',), ('{"amount": 10, "is_international": false, "merchant_category": "5411"}',),
         ("{}",), ("not json",)], "p string",
    )
    assert [float(r.risk_score) for r in score_transaction_risk(df, "p").collect()] == [0.7, 0.1, 0.1, 0.1]
