"""Aggregates that Spark would otherwise evaluate inside one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kontora.functions.scalars import ColumnLike, col
from kontora.session import scratch_path, shared_dir

SLICES = 4096
#: Distinct values that one task may put in order.
ORDERED = 1 << 16


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: ColumnLike,
    percentiles: Mapping[str, float],
    slices: int = SLICES,
    ordered: int = ORDERED,
) -> DataFrame:
    """Interpolated exact percentiles per key.

    Equal values are counted once, and the counts are written to the shared folder.
    Ranges that hold a wanted rank are then cut, and the parts that still hold one
    are shrunk to their least and largest value and cut again, until none has more
    than ``ordered`` distinct values. Only those are put in order, each on its own,
    so no distribution of a key's values gathers them in one task.
    """
    work = df.select(*keys, col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    if not keys:
        work = work.withColumn("_all", F.lit(1))
    by = list(keys) or ["_all"]
    counts = _written(work.groupBy(*by, "_v").agg(F.count("*").alias("_n")), "value-counts")
    ranges = wanted_ranges(counts, by, percentiles, slices, ordered)
    inside = Window.partitionBy(*by, "_lo").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranged = _within(counts, ranges, by).withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
    ranged = ranged.withColumn("_start", F.col("_end") - F.col("_n"))
    ranks = _ranks(percentiles)
    parts = []
    for n, pos in ranks.items():
        for tag, at in (("l", F.floor(pos)), ("h", F.ceil(pos))):
            parts.append(
                F.max(F.when((at >= F.col("_start")) & (at < F.col("_end")), F.col("_v"))).alias(f"_{tag}_{n}")
            )
    found = ranged.groupBy(*by).agg(F.max("_total").alias("_total"), *parts)
    low, high = ({n: F.col(f"_{tag}_{n}") for n in ranks} for tag in "lh")
    return found.select(
        *keys,
        *[
            F.when(low[n] == high[n], low[n]).otherwise(low[n] + (high[n] - low[n]) * (pos - F.floor(pos))).alias(n)
            for n, pos in ranks.items()
        ],
    )


def wanted_ranges(
    counts: DataFrame, by: Sequence[str], percentiles: Mapping[str, float], slices: int = SLICES, ordered: int = ORDERED
) -> DataFrame:
    """Disjoint ranges ``_lo.._hi`` per key that hold every wanted rank, with ``_in`` rows, ``_distinct`` values, and ``_before`` rows below.

    ``counts`` has ``_n`` rows of each key's value ``_v``. Every cut parts the least value of a range from its largest, so the
    loop ends; only the largest number of distinct values reaches the driver.
    """
    ends = [F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_in"), F.count("*").alias("_distinct")]
    ranges = counts.groupBy(*by).agg(*ends).withColumn("_total", F.col("_in")).withColumn("_before", F.lit(0).cast("long"))
    earlier = Window.partitionBy(*by, "_outer").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        ranges = _written(ranges, "value-ranges")
        largest = ranges.agg(F.max("_distinct")).first()[0]
        if largest is None or largest <= max(ordered, 1):
            return ranges
        cut = _within(counts, ranges, by).withColumn("_s", _slice(slices)).withColumnRenamed("_lo", "_outer")
        cut = cut.groupBy(*by, "_outer", "_before", "_total", "_s").agg(*ends)
        cut = cut.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_in").over(earlier), F.lit(0)))
        holds = F.lit(False)
        for pos in _ranks(percentiles).values():
            holds = holds | ((F.ceil(pos) >= F.col("_before")) & (F.floor(pos) < F.col("_before") + F.col("_in")))
        ranges = cut.where(holds).drop("_outer", "_s")


def _slice(slices: int):
    """Which part of its range a value is in: by sign first, then in equal steps, on a log scale where the range spans magnitudes."""
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    last = max(slices, 3) - 1
    wide = F.greatest(F.abs(lo), F.abs(hi)) > 2 * F.least(F.abs(lo), F.abs(hi))

    def scale(x):
        return F.when(wide, F.signum(hi) * F.log(F.abs(x))).otherwise(x)

    step = (scale(v) - scale(lo)) / (scale(hi) - scale(lo)) * (last + 1)
    inner = F.when(F.isnan(step), 1).otherwise(F.greatest(F.lit(0), F.least(F.floor(step), F.lit(last))))  # no number: an infinite end
    ends = F.when(v == lo, 0).when(v == hi, last).otherwise(inner)
    return F.when(F.signum(lo) * F.signum(hi) <= 0, F.signum(v) + 1).otherwise(ends).cast("long")


def _within(counts: DataFrame, ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Values with the range of their key that they are in; a key has at most two ranges per percentile."""
    named = ranges.select(*[F.col(b).alias(f"_k_{b}") for b in by], "_lo", "_hi", "_before", "_total")
    met = counts.join(named, _null_safe(by) & F.col("_v").between(F.col("_lo"), F.col("_hi")))
    return met.drop(*[f"_k_{b}" for b in by])


def _ranks(percentiles: Mapping[str, float]):
    return {n: (F.col("_total") - 1) * F.lit(p) for n, p in percentiles.items()}


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _null_safe(by: Sequence[str]):
    out = None
    for b in by:
        c = F.col(b).eqNullSafe(F.col(f"_k_{b}"))
        out = c if out is None else out & c
    return out


def histogram(df: DataFrame, value: ColumnLike, low: float, high: float, buckets: int) -> DataFrame:
    """Rows per equal-width bucket; 0 and buckets+1 hold what lies outside."""
    return (
        df.select(F.width_bucket(col(value).cast("double"), F.lit(low), F.lit(high), F.lit(buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"))
    )


def connected_groups(links: DataFrame, left: str, right: str) -> DataFrame:
    """Smallest reachable member for every node of an undirected link table.

    Each round a node takes the smallest label among its neighbours, and then
    the label of its label, so long chains close quickly. Lineage is cut by a
    checkpoint in the shared folder every round; the loop stops when nothing
    changes, which one aggregate row tells the driver.
    """
    shared_dir(links.sparkSession)
    both = (
        links.select(F.col(left).alias("a"), F.col(right).alias("b"))
        .unionByName(links.select(F.col(right).alias("a"), F.col(left).alias("b")))
        .distinct()
        .checkpoint()
    )
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).checkpoint()
    while True:
        offered = (
            both.join(labels.select(F.col("a").alias("b"), "label"), "b")
            .groupBy("a").agg(F.min("label").alias("offer"))
        )
        stepped = labels.join(offered, "a").select("a", F.least("label", "offer").alias("label"), F.col("label").alias("old"))
        hop = stepped.select(F.col("a").alias("label"), F.col("label").alias("hop"))
        nxt = (
            stepped.join(hop, "label", "left")
            .select("a", F.least("label", F.coalesce("hop", "label")).alias("label"), "old")
            .checkpoint()
        )
        changed = nxt.where("label <> old").limit(1).count()
        labels = nxt.drop("old")
        if changed == 0:
            return labels.select(F.col("a").alias("node"), F.col("label").alias("group_id"))
