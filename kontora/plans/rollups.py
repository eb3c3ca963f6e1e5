"""Stored rollups of the metric layer: mergeable states per group of dimensions, and answers from the smallest level that covers a question.

A level is a set of dimensions of one metric table. The widest one is grouped from the rows; the coarser levels come from its
states by grouping sets, so the rows are read once. States are sums, counts, extremes and, for distinct counts, both a sketch and
the values themselves (a row per group and value), which count exactly. Rows arrive in batches; a batch that is built again
replaces its own folders, and the answer merges the batches. The manifest of a batch is written last, so a batch that was cut off
is not read. One writer at a time per table.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kontora.operators.joins import full_stitch
from kontora.plans.semantic import Metric, SemanticView, bound_metric, with_dimensions
from kontora.sources.storage import folder_exists

#: Registers of a distinct count's sketch, as a power of two (relative standard error 1.6 %).
DISTINCT_LG = 12
_MANIFEST = "level string, dims array<string>, states array<string>, n_rows long"


def state_name(kind: str, expr: str) -> str:
    """The column of a state. It comes from the expression itself, so a changed one, or one as of another day, finds no column."""
    return f"{kind}_{zlib.crc32(expr.encode()):08x}"


@dataclass(frozen=True)
class Level:
    name: str
    dims: tuple[str, ...]
    n_rows: int


def _first(kind: str, expr: str) -> Column:
    """The state of rows."""
    e = F.expr(expr)
    if kind == "distinct":
        return F.hll_sketch_agg(e.cast("string"), F.lit(DISTINCT_LG))
    return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[kind](e)


def _merged(states: DataFrame, name: str) -> Column:
    """The state of states, in the stored type: a total fits where the total of the same rows did."""
    kind = name.split("_")[0]
    if kind == "distinct":
        return F.hll_union_agg(name)
    if kind == "count":
        return F.coalesce(F.sum(name), F.lit(0).cast("long"))
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](name).cast(states.schema[name].dataType)


class Rollups:
    """Rollups under ``root``. ``exact_distinct=False`` answers distinct counts from sketches."""

    def __init__(self, spark: SparkSession, root: str, exact_distinct: bool = True):
        self.spark, self.root, self.exact_distinct = spark, root.rstrip("/"), exact_distinct

    def _at(self, view: SemanticView, table: str, kind: str) -> str:
        return f"{self.root}/{view.name}.{table}/{kind}"

    def build(self, b, view: SemanticView, table: str, levels: Sequence[Sequence[str]], batch: str = "all", rows: DataFrame | None = None) -> None:
        """Store the states of all metrics of a table at the named levels.

        ``rows`` are the batch's rows, with the columns of the table (default: the whole table). Dimensions of parents enter as they
        are now; batches whose parents changed since are to be built again.
        """
        dims = list(dict.fromkeys(d for level in levels for d in level))
        source = with_dimensions(b if rows is None else _Instead(b, table, rows), view, table, dims)
        definitions = [bound_metric(b, m) for name, m in view.metrics.items() if name.split(".")[0] == table]
        wanted = dict.fromkeys(s for m in definitions if isinstance(m, Metric) for s in m.states)
        states = {state_name(kind, x): (kind, x) for kind, x in wanted}
        if len(states) != len(wanted):
            raise ValueError("two states of one name")
        keys = [f"d_{d}" for d in dims]
        names = {"wide": tuple(dims)}
        for level in levels:
            if set(level) != set(dims):
                names["by_" + "_".join(level) if level else "total"] = tuple(level)

        wide = source.groupBy(*keys).agg(*[_first(kind, x).alias(n) for n, (kind, x) in states.items()])
        sums = self._store(wide, view, table, "wide", batch)
        coarse = {n: level for n, level in names.items() if n != "wide"}
        if coarse:
            grouped = sums.groupingSets([[f"d_{d}" for d in level] for level in coarse.values()], *keys)
            rolled = grouped.agg(F.grouping_id().alias("_set"), *[_merged(sums, n).alias(n) for n in states])
            rolled = rolled.withColumn("level", _level_of(dims, coarse)).drop("_set")
            rolled = self._store(rolled, view, table, "levels", batch, by_level=True)
        for n, (kind, x) in states.items():
            if kind == "distinct":
                # a row per group and value, at every level; a null is not counted
                seen = source.select(*keys, F.expr(x).alias("value")).where("value IS NOT NULL").distinct()
                seen = self._store(seen, view, table, f"{n}_wide", batch)
                if coarse:
                    grouped = seen.groupingSets([[f"d_{d}" for d in level] + ["value"] for level in coarse.values()], *keys, "value")
                    each = grouped.agg(F.shiftright(F.grouping_id(), 1).alias("_set")).withColumn("level", _level_of(dims, coarse)).drop("_set")
                    self._store(each, view, table, f"{n}_levels", batch, by_level=True)
        sizes = {"wide": sums.count()}
        if coarse:
            sizes |= {r.level: r.n for r in rolled.groupBy("level").agg(F.count("*").alias("n")).collect()}  # a row per level
        manifest = [(n, list(level), list(states), sizes.get(n, 0)) for n, level in names.items()]
        self.spark.createDataFrame(manifest, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self._at(view, table, 'manifest')}/batch={batch}")

    def _store(self, df: DataFrame, view: SemanticView, table: str, kind: str, batch: str, by_level: bool = False) -> DataFrame:
        path = f"{self._at(view, table, kind)}/batch={batch}"
        if by_level:
            df.hint("rebalance", "level").write.mode("overwrite").partitionBy("level").parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _manifest(self, view: SemanticView, table: str) -> list:
        path = self._at(view, table, "manifest")
        if not folder_exists(self.spark, path):
            return []
        return self.spark.read.schema(_MANIFEST + ", batch string").parquet(path).collect()  # a row per level and batch

    def covering(self, view: SemanticView, table: str, states: Sequence[str], dims: Sequence[str]) -> Level | None:
        """The level with the fewest rows that has the states and dimensions in every batch."""
        rows = self._manifest(view, table)
        batches, fit = {r.batch for r in rows}, {}
        for r in rows:
            if set(dims) <= set(r.dims) and set(states) <= set(r.states):
                # "wide" may be other dimensions in each batch, any of which will do
                fit.setdefault(r.level, []).append(r)
        levels = [
            Level(name, tuple(rs[0].dims), sum(r.n_rows for r in rs)) for name, rs in fit.items() if {r.batch for r in rs} == batches
        ]
        return min(levels, key=lambda x: (x.n_rows, len(x.dims), x.name), default=None)

    def _read(self, view: SemanticView, table: str, prefix: str, level: Level) -> DataFrame:
        """The rows of a level in all batches that a manifest names."""
        wide = self._at(view, table, f"{prefix}wide")
        folder = wide if level.name == "wide" else self._at(view, table, f"{prefix}levels")
        batches = sorted({r.batch for r in self._manifest(view, table)})
        tail = "" if level.name == "wide" else f"/level={level.name}"
        paths = [p for p in (f"{folder}/batch={x}{tail}" for x in batches) if folder_exists(self.spark, p)]
        if not paths:  # a level without a row has no folder
            return self.spark.read.parquet(*[f"{wide}/batch={x}" for x in batches]).where(F.lit(False))
        return self.spark.read.option("mergeSchema", "true").parquet(*paths)

    def answer(
        self, view: SemanticView, table: str, wanted: Mapping[str, Metric | str], dimensions: Sequence[str], used: Sequence[str], where: str | None,
    ) -> DataFrame | None:
        """The metrics by ``dimensions`` from stored states, or None if no level covers them and the dimensions in ``used``."""
        if not all(isinstance(m, Metric) for m in wanted.values()):
            return None
        states = list(dict.fromkeys(s for m in wanted.values() for s in m.states))
        level = self.covering(view, table, [state_name(*s) for s in states], used)
        if level is None:
            return None

        def grouped(df: DataFrame):
            return (df.where(where) if where else df).groupBy(*[F.col(f"d_{d}").alias(d) for d in dimensions])

        stored = self._read(view, table, "", level)
        names = {s: state_name(*s) for s in states}
        by_value = [n for (kind, _), n in names.items() if kind == "distinct" and self.exact_distinct]
        # the count keeps the groups, and the one row of no dimensions, when every state is counted by its values
        out = grouped(stored).agg(F.count("*").alias("_states"), *[_merged(stored, n).alias(n) for n in names.values() if n not in by_value])
        for n in by_value:
            counts = grouped(self._read(view, table, f"{n}_", level)).agg(F.count_distinct("value").alias(n))
            out = full_stitch(out, counts, list(dimensions)).withColumn(n, F.coalesce(n, F.lit(0).cast("long")))
        for (kind, _), n in names.items():
            if kind == "distinct" and n not in by_value:
                out = out.withColumn(n, F.coalesce(F.hll_sketch_estimate(n), F.lit(0).cast("long")))
        formulas = [F.expr(m.formula.format(*[names[s] for s in m.states])).alias(n) for n, m in wanted.items()]
        return out.select(*dimensions, *formulas)


class _Instead:
    """A bank with one table's rows replaced; its other tables are the dimensions."""

    def __init__(self, b, table: str, rows: DataFrame):
        self._b, self._table, self._rows = b, table, rows

    def __getattr__(self, name: str):
        return self._rows if name == self._table else getattr(self._b, name)


def _level_of(dims: Sequence[str], levels: Mapping[str, Sequence[str]]) -> Column:
    """The level's name by its grouping id, which has a bit for every dimension, the first one highest, set where it is not in the group."""
    top = len(dims) - 1
    out = F.lit(None).cast("string")
    for name, level in levels.items():
        mask = sum(1 << (top - i) for i, d in enumerate(dims) if d not in level)
        out = F.when(F.col("_set") == mask, F.lit(name)).otherwise(out)
    return out
