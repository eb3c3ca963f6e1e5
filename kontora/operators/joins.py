"""Joins that keep sums right and keys spread.

No join here forces a broadcast: which side is shipped whole is left to Spark,
which checks the size against spark.sql.autoBroadcastJoinThreshold when planning
and again at run time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontora.functions.scalars import ColumnLike, col, moment
from kontora.operators.windows import carried


@dataclass
class Child:
    """One child table grouped on the parent key.

    ``safe`` aggregates do not change when other children multiply the rows
    (distinct counts, min, max, averages, ratios). ``sums`` do: they grow by the
    row counts of the other children when children are joined side by side.
    """

    rows: DataFrame
    key: str
    safe: dict[str, Column] = field(default_factory=dict)
    sums: dict[str, Column] = field(default_factory=dict)


def join_children(
    parent: DataFrame, key: str, children: Sequence[Child], fanout: str = "correct"
) -> DataFrame:
    """Parent with several one-to-many children, each grouped before the join.

    ``fanout="correct"`` gives true sums. ``fanout="as_written"`` gives the sums
    that joining all children at once would give, by multiplying with the other
    children's row counts; the product of rows is never built.
    """
    if fanout not in ("correct", "as_written"):
        raise ValueError(fanout)
    out = parent
    sizes: list[str] = []
    for i, child in enumerate(children):
        size = f"_n{i}"
        grouped = child.rows.groupBy(F.col(child.key).alias("_ck")).agg(
            F.count("*").alias(size),
            *[c.alias(n) for n, c in {**child.safe, **child.sums}.items()],
        )
        out = out.join(grouped, F.col(key) == F.col("_ck"), "left").drop("_ck")
        sizes.append(size)
    if fanout == "as_written":
        for i, child in enumerate(children):
            for name in child.sums:
                factor = F.lit(1).cast("long")
                for j, size in enumerate(sizes):
                    if j != i:
                        factor = factor * F.greatest(F.lit(1).cast("long"), F.coalesce(F.col(size), F.lit(0)))
                out = out.withColumn(name, F.col(name) * factor)
    return out.drop(*sizes)


def asof_join(
    probes: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    probe_id: str,
    probe_time: str,
    history_time: str,
    values: Sequence[str],
    ttl: dt.timedelta | None = None,
) -> DataFrame:
    """For every probe, the newest history row with history_time <= probe_time.

    Both sides go into one sequence per key and the last history row is carried
    forward, cut by minute, so neither a long history nor a busy key meets in one
    task and no time range is ever cross joined. Needs one history row per key
    and time. ``ttl`` drops matches older than that.
    """
    h = history.where(F.col(history_time).isNotNull()).select(
        *keys,
        F.col(history_time).alias("_t"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast(probes.schema[probe_id].dataType).alias(probe_id),
        F.col(history_time).alias("_matched"),
        *values,
    )
    p = probes.select(
        *keys,
        F.col(probe_time).alias("_t"),
        F.lit(1).alias("_kind"),
        probe_id,
        F.lit(None).cast(history.schema[history_time].dataType).alias("_matched"),
        *[F.lit(None).cast(history.schema[v].dataType).alias(v) for v in values],
    )
    lined = carried(
        h.unionByName(p),
        keys,
        ["_t", "_kind", probe_id],
        F.struct(F.date_trunc("minute", "_t").alias("p")),
        ["_matched", *values],
    ).where("_kind = 1")
    if ttl is not None:
        fresh = F.col("_t") - F.col("_matched") <= F.lit(ttl)
        lined = lined.select(
            *keys, "_t", probe_id,
            *[F.when(fresh, F.col(c)).alias(c) for c in ["_matched", *values]],
        )
    return lined.select(probe_id, *keys, F.col("_t").alias(probe_time), F.col("_matched").alias(history_time), *values)


def asof_at(history: DataFrame, keys: Sequence[str], time: str, as_of: dt.datetime) -> DataFrame:
    """State of a history table at one moment: newest row per key not after it."""
    from kontora.operators.ranking import latest_per_key

    return latest_per_key(history.where(F.col(time) <= moment(as_of)), list(keys), [time])


def full_stitch(left: DataFrame, right: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Full outer join on dimensions where NULL equals NULL."""
    if not dims:  # one row each
        one = F.lit(1).alias("_one")
        return left.select(one, "*").join(right.select(one, "*"), "_one", "full_outer").drop("_one")
    r = right.select(*[F.col(d).alias(f"_r_{d}") for d in dims], *[c for c in right.columns if c not in dims])
    on = [F.col(d).eqNullSafe(F.col(f"_r_{d}")) for d in dims]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    left = left.withColumn("_in_left", F.lit(True))
    joined = left.join(r, condition, "full_outer")
    return joined.select(
        *[F.when(F.col("_in_left"), F.col(d)).otherwise(F.col(f"_r_{d}")).alias(d) for d in dims],
        *[c for c in left.columns if c not in dims and c != "_in_left"],
        *[c for c in right.columns if c not in dims],
    )


def shared_attribute_links(df: DataFrame, entity: str, attribute: str) -> DataFrame:
    """Link entities that share an attribute value.

    Every entity is linked to the smallest entity of its group, which keeps the
    groups connected with one link per member rather than one per pair.
    """
    members = df.select(entity, attribute).where(F.col(attribute).isNotNull()).distinct()
    anchors = members.groupBy(attribute).agg(
        F.min(entity).alias("anchor"), F.count("*").alias("members")
    ).where("members > 1")
    return members.join(anchors, attribute).where(F.col(entity) != F.col("anchor"))


def day_spine(df: DataFrame, start: ColumnLike, end: ColumnLike, name: str = "day") -> DataFrame:
    """One row per day of each row's validity, without a join."""
    span = F.when(col(start) <= col(end), F.sequence(col(start), col(end)))
    return df.withColumn(name, F.explode(span))


def with_each(df: DataFrame, small: DataFrame, name: str) -> DataFrame:
    """Every row with every row of a small relation, as a struct column.

    The relation is read once as an array through a scalar subquery and exploded
    in place: no join and no shuffle of the large side. It must be a relation of
    declared, bounded size such as a registry.
    """
    items = small.agg(F.sort_array(F.collect_list(F.struct(*small.columns))).alias("items"))
    return df.withColumn(name, F.explode(items.scalar()))


def with_row(df: DataFrame, one: DataFrame, name: str) -> DataFrame:
    """Every row with the columns of a one-row relation, as a struct column."""
    return df.withColumn(name, one.select(F.struct(*one.columns)).scalar())


def presence(required: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Required names against what exists: PASS or FAIL."""
    found = actual.select(key).distinct().withColumn("_found", F.lit(True))
    return required.join(found, key, "left").select(
        *required.columns, F.when(F.col("_found"), "PASS").otherwise("FAIL").alias("status")
    )
