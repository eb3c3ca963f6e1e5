"""Writing tables: by-name appends, snapshots, upserts and retention.

Plain parquet has no MERGE, UPDATE or DELETE. A changed table is written as a new
version next to the old one and a pointer names the current version, so readers
never see a half-written table and a retried job writes its version again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kontora.functions.scalars import moment
from kontora.operators.ranking import latest_per_key
from kontora.schemas import TABLES


def scan_table(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Read a parquet table, with its declared schema where it has one."""
    reader = spark.read
    if table:
        reader = reader.schema(TABLES[table].schema)
    return reader.parquet(path)


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns by name, in table order, cast to the table's types.

    Missing columns become NULL; unknown ones are refused.
    """
    unknown = set(df.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def with_defaults(df: DataFrame, defaults: Mapping[str, str], now: dt.datetime) -> DataFrame:
    """Fill missing or NULL columns from default expressions; {now} is the load time."""
    stamp = f"TIMESTAMP_NTZ '{now.isoformat(sep=' ')}'"
    for name, expr in defaults.items():
        value = F.expr(expr.format(now=stamp))
        df = df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return df


def prepared(df: DataFrame, table: str, now: dt.datetime) -> DataFrame:
    spec = TABLES[table]
    return align(with_defaults(df, spec.defaults, now), spec.schema)


def _laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one folder together, large folders over several files."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append_rows(df: DataFrame, path: str, table: str, now: dt.datetime, partition_by: Sequence[str] = ()) -> None:
    """INSERT ... SELECT, matching columns by name."""
    _laid_out(prepared(df, table, now), partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def reload_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table. Not for a path the plan itself reads; use Versions."""
    _laid_out(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _folder(spark, path)
    return fs.exists(at)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    fs, at = _folder(spark, path)
    fs.delete(at, True)


def replace_partitions(df: DataFrame, path: str, column: str, values: Sequence | None = None) -> None:
    """Replace the folders of the partitions that ``df`` has rows of; other folders stay.

    If values are named, just those are replaced, and one that has no rows becomes empty. ``df`` must not read the path.
    """
    rows = df if values is None else df.where(F.col(column).isin(*values))
    rows.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    if values is not None:  # a partition without rows is not overwritten by itself
        left = {r[0] for r in rows.select(column).distinct().collect()}  # at most the values asked for
        for v in values:
            if v not in left:
                remove_folder(df.sparkSession, f"{path}/{column}={v}")


class Versions:
    """A table kept as numbered versions with a pointer to the current one, for one writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        return _folder(self.spark, path)

    def _pointers(self) -> DataFrame | None:
        fs, path = self._fs(f"{self.root}/pointer")
        return self.spark.read.schema("token STRING, version LONG").parquet(str(path)) if fs.exists(path) else None

    def current(self) -> tuple[int, str] | None:
        """Number of the newest version and the token of the job that wrote it."""
        pointers = self._pointers()
        if pointers is None:
            return None
        row = pointers.orderBy(F.desc("version")).first()
        return (row.version, row.token) if row else None

    def read(self) -> DataFrame | None:
        at = self.current()
        return None if at is None else self.spark.read.parquet(f"{self.root}/v{at[0]}")

    def publish(self, df: DataFrame, token: str = "") -> int:
        at = self.current()
        version = 1 if at is None else at[0] + 1
        df.write.mode("overwrite").parquet(f"{self.root}/v{version}")
        # a folder per pointer, so that old ones can go
        self.spark.range(1).select(F.lit(token).alias("token")).write.mode("overwrite").parquet(f"{self.root}/pointer/version={version}")
        return version

    def drop(self, version: int) -> None:
        """Remove a version that no pointer in use needs. The pointer goes last, so a broken removal is done again."""
        for path in (f"{self.root}/v{version}", f"{self.root}/pointer/version={version}"):
            fs, at = self._fs(path)
            fs.delete(at, True)

    def change(self, step: Callable[[DataFrame | None], DataFrame], token: str = "") -> int:
        """Publish step(current table); a token that was already published is skipped."""
        at = self.current()
        if token and at and at[1] == token:
            return at[0]
        return self.publish(step(self.read()), token)


class UpsertLog:
    """Keyed rows kept as a base and the changes after it, for one writer at a time (a streaming query's checkpoint gives that).

    Each batch writes only the rows it touched; a read takes the newest row per
    key. After ``compact_every`` batches the changes are folded into a new base,
    where ``keep`` says which rows stay, and what the base before replaced is
    removed; readers of the last base go on. A token that was already written is
    skipped, so a repeated micro-batch changes nothing; tokens that are numbers
    have to rise, since a base remembers the newest one only.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: Sequence[str], compact_every: int = 50,
        keep: Callable[[DataFrame], DataFrame] | None = None,
    ):
        self.spark, self.root, self.keys, self.compact_every, self.keep = spark, root.rstrip("/"), list(keys), compact_every, keep
        self.log = Versions(spark, f"{self.root}/log")

    def _entries(self) -> list:
        # two rounds of compaction at most, as older entries are removed
        pointers = self.log._pointers()
        return [] if pointers is None else sorted(pointers.collect(), key=lambda e: e.version)

    @staticmethod
    def _live(entries: list) -> list:
        """The newest base and what came after it."""
        base = max((i for i, e in enumerate(entries) if e.token.startswith("base:")), default=0)
        return entries[base:]

    def _rows(self, live: list) -> DataFrame:
        parts = self.spark.read.parquet(*[f"{self.log.root}/v{e.version}" for e in live])
        return latest_per_key(parts, self.keys, ["_version"]).drop("_version")

    def read(self) -> DataFrame | None:
        live = self._live(self._entries())
        return self._rows(live) if live else None

    def matching(self, rows: DataFrame, keys: Sequence[str] | None = None) -> DataFrame | None:
        """Current rows of the keys (or of some key columns) that occur in ``rows``."""
        now, by = self.read(), list(keys or self.keys)
        return None if now is None else now.join(rows.select(*by).distinct(), by, "left_semi")

    @staticmethod
    def _covers(entry: str, token: str) -> bool:
        known = entry.removeprefix("base:")
        folded = entry.startswith("base:") and known.isdigit() and token.isdigit()
        return known == token or (folded and int(token) <= int(known))

    def done(self, token: str) -> bool:
        return any(self._covers(e.token, token) for e in self._entries())

    def put(self, rows: DataFrame, token: str) -> None:
        entries = self._entries()
        if any(self._covers(e.token, token) for e in entries):
            return
        version = entries[-1].version + 1 if entries else 1
        self.log.publish(rows.withColumn("_version", F.lit(version)), token)
        if len(self._live(entries)) + 1 >= self.compact_every:
            self._compact(token)

    def _compact(self, token: str) -> None:
        entries = self._entries()
        live = self._live(entries)
        rows = self._rows(live)
        if self.keep is not None:
            rows = self.keep(rows)
        self.log.publish(rows.withColumn("_version", F.lit(live[-1].version + 1)), f"base:{token}")
        for e in entries:
            if e.version < live[0].version:
                self.log.drop(e.version)


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    combine: Mapping[str, Column],
) -> DataFrame:
    """MERGE: matched rows get ``combine`` columns, unmatched source rows are added.

    ``combine`` may refer to ``t.x`` (old) and ``s.x`` (new); columns not in it
    keep the old value where one exists.
    """
    t = target.withColumn("_t", F.lit(True)).alias("t")
    s = source.withColumn("_s", F.lit(True)).alias("s")
    condition = None
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        condition = c if condition is None else condition & c
    joined = t.join(s, condition, "full_outer")
    matched = F.col("t._t").isNotNull() & F.col("s._s").isNotNull()
    out = []
    for c in target.columns:
        old, new = F.col(f"t.{c}"), F.col(f"s.{c}")
        if c in combine:
            both = combine[c]
        else:
            both = old
        out.append(
            F.when(matched, both).when(F.col("t._t").isNotNull(), old).otherwise(new).alias(c)
        )
    return joined.select(*out)


def overlay(old: Column, new: Column) -> Column:
    """Map with the entries of ``new`` written over those of ``old``."""
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.map_concat(kept, new))


def merge_online(target: DataFrame, source: DataFrame, now: dt.datetime) -> DataFrame:
    """Upsert feature vectors: new keys overwrite, other keys of the vector stay."""
    return merge_rows(
        target,
        source,
        ["entity_id", "entity_type"],
        {
            "feature_vector": overlay(F.col("t.feature_vector"), F.col("s.feature_vector")),
            "last_updated": moment(now),
        },
    )


def update_where(df: DataFrame, test: Column, changes: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE: rows where the test is NULL stay as they are."""
    return df.select(
        *[
            (F.when(test, changes[c]).otherwise(F.col(c)) if c in changes else F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def split_by_age(df: DataFrame, time: str, keep_from: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows to archive) for a retention rule; NULL times are kept."""
    old = F.col(time) < moment(keep_from)
    return df.where(~F.coalesce(old, F.lit(False))), df.where(old)


def read_keys(df: DataFrame, key: str, wanted: DataFrame, newest: str) -> DataFrame:
    """Latest row for each wanted key."""
    return latest_per_key(df.join(wanted.select(key).distinct(), key, "left_semi"), [key], [newest])


def catalog_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, one counting pass each, as one result."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
