"""Latest row, top rows and samples per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontora.functions.scalars import ColumnLike, col, draw


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[ColumnLike]) -> DataFrame:
    """The row with the greatest ``newest`` tuple per key.

    An aggregate (max_by) keeps one candidate per key and map task; a window
    would ship every row.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[col(n).alias(f"o{i}") for i, n in enumerate(newest)])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def top_per_key(df: DataFrame, keys: Sequence[ColumnLike], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """At most k rows per key.

    Spark limits each map task to its own best k before the shuffle, since the
    filter bounds a row_number.
    """
    name = rank or "_rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def sample_per_key(df: DataFrame, keys: Sequence[str], row_id: str, k: int, salt: str = "sample") -> DataFrame:
    """k rows per key picked by a hash of the row id: the same rows on every run."""
    return top_per_key(df, keys, [F.md5(F.concat_ws("|", col(row_id).cast("string"), F.lit(salt))), F.col(row_id)], k)


def sample_share(df: DataFrame, row_id: str, percent: int, salt: str = "share") -> DataFrame:
    """About ``percent`` of the rows, chosen by a hash of the row id."""
    return df.where(draw(row_id, salt) < percent)
