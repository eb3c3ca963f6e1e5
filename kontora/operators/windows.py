"""Window functions that do not put a whole key into one task.

Spark evaluates a window with all rows of a partition key in one task. One key
may hold a third of the table, so ordered windows here are cut into slices:

* ``running`` adds up inside a slice and shifts it by what earlier slices of the
  same key hold. Only one summary row per (key, slice) meets in one task.
* ``framed`` first numbers the rows with ``running``, cuts each key into chunks
  of a fixed row count and copies the few rows that a bounded frame needs from
  the chunk before.

A slice is made of the leading order column alone (or a coarser form of it), so
it never falls along the ordering, whatever the types of the columns behind it.
* ``range_sums`` and ``ranged`` are frames of time over raw rows, by differences
  of running sums and by slices with a halo.

Results equal the plain window.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontora.functions.scalars import ColumnLike, col
from kontora.session import shared_dir

CHUNK_ROWS = 1 << 18


def slice_of(period: ColumnLike) -> Column:
    """A slice for orderings that begin with ``period`` or with a finer form of it.

    As a struct, so that rows without a time have a slice of their own.
    """
    return F.struct(col(period).alias("p"))


def positioned(df: DataFrame, order: Sequence[ColumnLike], name: str = "rn") -> DataFrame:
    """Add the 1-based position of each row in the whole table.

    Ranges of rows are sorted and numbered apart; one row per range, with its
    count, shifts them. The ranges are checkpointed, so they are the same twice.
    """
    shared_dir(df.sparkSession)
    by = [col(o) for o in order]
    spread = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__i", F.monotonically_increasing_id()).checkpoint()
    ranges = spread.groupBy(F.shiftright("__i", 33).alias("__p")).agg(F.count("*").alias("__n"), F.min("__i").alias("__low"))
    shift = ranges.select("__p", "__low", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__before"))
    out = spread.withColumn("__p", F.shiftright("__i", 33)).join(shift, "__p")
    return out.select(*df.columns, (F.col("__i") - F.col("__low") + F.col("__before") + 1).alias(name))


def _key(keys: Sequence[ColumnLike]) -> Column:
    # as a struct, so that rows with NULL key parts stay in a group of their own
    return F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)])


def running(
    df: DataFrame,
    keys: Sequence[ColumnLike],
    order: Sequence[ColumnLike],
    slices: Column,
    sums: Mapping[str, ColumnLike],
) -> DataFrame:
    """Add inclusive running sums per key. ``order`` must leave no ties."""
    names = list(sums)
    work = df.withColumn("__k", _key(keys)).withColumn("__s", slices)
    for i, name in enumerate(names):
        work = work.withColumn(f"__v{i}", col(sums[name]))
    totals = work.groupBy("__k", "__s").agg(*[F.sum(f"__v{i}").alias(f"__t{i}") for i in range(len(names))])
    earlier = Window.partitionBy("__k").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select("__k", "__s", *[F.sum(f"__t{i}").over(earlier).alias(f"__b{i}") for i in range(len(names))])
    inside = (
        Window.partitionBy("__k", "__s")
        .orderBy(*[col(o) for o in order])
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = work.select("*", *[F.sum(f"__v{i}").over(inside).alias(f"__l{i}") for i in range(len(names))])
    out = local.join(shift, ["__k", "__s"])
    return out.select(
        *[F.col(c) for c in df.columns],
        *[
            (F.coalesce(F.col(f"__l{i}"), F.lit(0)) + F.coalesce(F.col(f"__b{i}"), F.lit(0))).alias(name)
            for i, name in enumerate(names)
        ],
    )


def numbered(
    df: DataFrame, keys: Sequence[ColumnLike], order: Sequence[ColumnLike], slices: Column, name: str = "rn"
) -> DataFrame:
    """Add the 1-based position of each row within its key."""
    return running(df, keys, order, slices, {name: F.lit(1).cast("long")})


def framed(
    df: DataFrame,
    keys: Sequence[ColumnLike],
    order: Sequence[ColumnLike],
    slices: Column,
    preceding: int,
    build: Callable[[Window], Mapping[str, Column]],
    number: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add window columns that look back at most ``preceding`` rows.

    ``build`` gets the ordered window spec and returns name -> column, e.g.
    ``lambda w: {"prev": F.lag("ts").over(w)}``. ``number`` also keeps the row
    position under that name.
    """
    if preceding >= chunk_rows:
        raise ValueError("a frame must be shorter than a chunk")
    ranked = numbered(df.withColumn("__k", _key(keys)), ["__k"], order, slices, "__rn")
    index = F.col("__rn") - 1
    chunk = F.floor(index / chunk_rows)
    tail = index % chunk_rows >= chunk_rows - preceding
    placed = (
        ranked.withColumn("__c", chunk)
        .withColumn("__p", F.explode(F.when(tail, F.array("__c", F.col("__c") + 1)).otherwise(F.array("__c"))))
    )
    columns = build(Window.partitionBy("__k", "__p").orderBy("__rn"))
    kept = [F.col(c) for c in df.columns]
    if number:
        kept.append(F.col("__rn").alias(number))
    return (
        placed.select("*", *[c.alias(n) for n, c in columns.items()])
        .where(F.col("__p") == F.col("__c"))
        .select(*kept, *[F.col(n) for n in columns])
    )


def carried(
    df: DataFrame,
    keys: Sequence[ColumnLike],
    order: Sequence[ColumnLike],
    slices: Column,
    values: Sequence[str],
) -> DataFrame:
    """Replace each value column by its last non-NULL value up to the row.

    All columns in ``values`` are carried together from the newest row on which
    the first of them is set.
    """
    work = df.withColumn("__k", _key(keys)).withColumn("__s", slices)
    position = F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)])
    packed = F.when(F.col(values[0]).isNotNull(), F.struct(*values))
    work = work.withColumn("__o", position).withColumn("__v", packed)
    # max_by leaves out rows whose ordering is NULL, so a slice without values ends in NULL
    slots = work.groupBy("__k", "__s").agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col("__o"))).alias("__e"))
    earlier = Window.partitionBy("__k").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    before = slots.select("__k", "__s", F.last("__e", ignorenulls=True).over(earlier).alias("__before"))
    inside = Window.partitionBy("__k", "__s").orderBy("__o").rowsBetween(Window.unboundedPreceding, 0)
    local = work.select("*", F.last("__v", ignorenulls=True).over(inside).alias("__local"))
    out = local.join(before, ["__k", "__s"])
    found = F.coalesce(F.col("__local"), F.col("__before"))
    return out.withColumn("__f", found).select(
        *[F.col(c) for c in df.columns if c not in values],
        *[F.col(f"__f.{v}").alias(v) for v in values],
    )


def over_key(
    df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], source: DataFrame | None = None
) -> DataFrame:
    """Whole-key aggregates on every row, as a grouped result joined back.

    The grouping combines on the map side and the join may be split by adaptive
    execution, which a window over the key cannot. ``source`` holds the same rows
    before other steps were added to ``df``, so these are not computed twice.
    """
    grouped = (df if source is None else source).withColumn("__k", _key(keys)).groupBy("__k").agg(
        *[c.alias(n) for n, c in aggregates.items()]
    )
    return df.withColumn("__k", _key(keys)).join(grouped, "__k").select(*df.columns, *aggregates)


def _micros(time: ColumnLike) -> Column:
    return F.unix_micros(col(time).cast("timestamp"))


def range_sums(
    df: DataFrame, keys: Sequence[ColumnLike], time: str, ids: Sequence[str], reach: dt.timedelta, sums: Mapping[str, ColumnLike], slice_width: str = "minute"
) -> DataFrame:
    """Sums over the rows of the key from ``reach`` before a row's time up to it, rows of the same time included.

    Equals RANGE BETWEEN reach PRECEDING AND CURRENT ROW, but a sum over no value is 0. ``ids`` tell the rows of the table apart.
    Every row sends one empty row to the moment before its frame; the frame is the difference of two running sums, so
    a task holds a slice of a key and never a frame, however many rows a frame has. Use integers or decimals: differences of
    doubles lose digits. Rows without a time are peers of each other and of no other row.
    """
    names = list(sums)
    values = [col(sums[n]) for n in names]
    work = df.select(F.struct(*df.columns).alias("__row"), _key(ids).alias("__id"), _key(keys).alias("__k"), _micros(time).alias("__t"), *[
        v.alias(f"__v{i}") for i, v in enumerate(values)
    ])
    span = F.lit(reach // dt.timedelta(microseconds=1)).cast("long")
    ends = F.array(F.struct(F.lit(True).alias("last"), F.col("__t").alias("at")), F.struct(F.lit(False).alias("last"), (F.col("__t") - span - 1).alias("at")))
    marks = work.select("*", F.inline(ends)).select(
        F.when(F.col("last"), F.col("__row")).alias("__row"), "__id", "__k", "last", "at",
        slice_of(F.date_trunc(slice_width, F.timestamp_micros("at"))).alias("__s"),
        *[F.when(F.col("last"), F.col(f"__v{i}")).alias(f"__v{i}") for i in range(len(names))],
    )
    # the empty rows have no values, so one grouping gives every slice that has a row of either kind; slices are small and compress well,
    # so their parts are not merged by their size
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spots = marks.groupBy("__k", "__s").agg(*[F.sum(f"__v{i}").alias(f"__t{i}") for i in range(len(names))]).repartition(parts, "__k")
    earlier = Window.partitionBy("__k").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    shift = spots.select("__k", "__s", *[F.sum(f"__t{i}").over(earlier).alias(f"__b{i}") for i in range(len(names))])
    inside = Window.partitionBy("__k", "__s").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    local = marks.select("__row", "__id", "__k", "last", "at", "__s", *[F.sum(f"__v{i}").over(inside).alias(f"__l{i}") for i in range(len(names))])
    reached = local.join(shift, ["__k", "__s"]).select(
        "__row", "__id", "__k", "last", "at",
        *[(F.coalesce(f"__l{i}", F.lit(0)) + F.when(F.col("at").isNull(), 0).otherwise(F.coalesce(f"__b{i}", F.lit(0)))).alias(f"__a{i}") for i in range(len(names))],
    )
    # a row without a time sends its empty row to its own peers, which must not be taken off again
    taken = [F.when(F.col("last"), F.col(f"__a{i}")).otherwise(F.when(F.col("at").isNull(), 0).otherwise(-F.col(f"__a{i}"))) for i in range(len(names))]
    out = reached.groupBy("__id").agg(F.first("__row", ignorenulls=True).alias("__row"), *[F.sum(t).alias(f"__a{i}") for i, t in enumerate(taken)])
    return out.select(*[F.col(f"__row.`{c}`").alias(c) for c in df.columns], *[F.col(f"__a{i}").alias(n) for i, n in enumerate(names)])


def ranged(
    df: DataFrame, keys: Sequence[ColumnLike], time: str, reach: dt.timedelta, build: Callable[[Window], Mapping[str, Column]]
) -> DataFrame:
    """Any window columns over the rows of the key from ``reach`` before a row's time up to it.

    ``build`` gets the window with its frame, e.g. ``lambda w: {"top": F.max("amount").over(w)}``. A key is cut into slices of
    time as wide as the frame, and a row goes to its own slice and, as a halo, to the next one; so a task holds at most twice
    the rows of one reach. Where single frames are too many rows for a task, use ``range_sums``. Rows without a time are peers.
    """
    span = reach // dt.timedelta(microseconds=1)
    own = F.floor(F.col("__t") / F.lit(span + 1)).cast("long")
    work = df.withColumn("__k", _key(keys)).withColumn("__t", _micros(time)).withColumn("__o", own)
    placed = work.withColumn("__s", F.explode(F.when(F.col("__o").isNull(), F.array("__o")).otherwise(F.array("__o", F.col("__o") + 1))))
    columns = build(Window.partitionBy("__k", "__s").orderBy("__t").rangeBetween(-span, 0))
    return placed.select("*", *[c.alias(n) for n, c in columns.items()]).where(F.col("__s").eqNullSafe(F.col("__o"))).select(*df.columns, *columns)
