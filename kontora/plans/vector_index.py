"""Approximate nearest vectors: coarse cells, some of them probed per query, exact scores within."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from kontora.operators.ranking import top_per_key
from kontora.plans.retrieval import BLOCK, ROWS, block_scores, vector_topk
from kontora.sources.storage import replace_partitions

#: Cells are fitted on about so many vectors, chosen by a hash of their ids; every vector is indexed.
SAMPLE = 50_000
#: Cells at most; below, about the square root of the number of vectors.
CELLS = 4096
#: When an index is built, so many of its vectors ask for their nearest others exactly, and as many cells are probed from then on as hold
#: this share of the answers.
ASKED, NEAREST, SHARE = 64, 10, 0.95


def _unit(v):
    """The vector at length one; null where it has none (no entries, all 0, null or not finite)."""
    size = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    # the length as the one entry of an array: it is worked out once, not once per entry of the vector
    return F.transform(F.array(size), lambda s: F.when((s > 0) & (s < float("inf")), F.transform(v, lambda x: x / s)))[0]


class VectorIndex:
    """Vectors under ``root/vectors`` in a folder per cell, the cells' centres under ``root/cells``.

    Vectors that have no direction are in no cell and are never found. Ids are expected to be distinct.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def build(self, df: DataFrame, vec_id: str, vector: str, cells: int | None = None, seed: int = 1) -> int:
        """Fit the cells and store every vector of ``df`` in its cell; returns the number of cells."""
        rows = df.select(F.col(vec_id).alias("vec_id"), _unit(F.col(vector).cast("array<double>")).alias("v")).where("v IS NOT NULL")
        n = rows.count()
        cells = min(cells or round(n**0.5), CELLS, n)
        if not cells:
            self._note(0, 0)
            return 0
        known = rows.withColumn("features", array_to_vector("v"))
        share = min(1.0, SAMPLE / n)
        picked = known.where(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
        picked = known if picked.limit(cells).count() < cells else picked
        model = KMeans(k=cells, seed=seed, maxIter=10, distanceMeasure="cosine", featuresCol="features", predictionCol="cell").fit(picked)
        model.write().overwrite().save(f"{self.root}/cells")
        self._place(known, model, None)
        cells = len(model.clusterCenters())
        self._note(cells, self._enough(seed))
        return cells

    def _note(self, cells: int, probes: int) -> None:
        self.spark.createDataFrame([(cells, probes)], "cells int, probes int").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/settings")

    def settings(self) -> tuple[int, int]:
        """Number of cells, and of those that a search probes."""
        return tuple(self.spark.read.parquet(f"{self.root}/settings").first())

    def _enough(self, seed: int) -> int:
        """How many cells hold ``SHARE`` of the nearest vectors of some of the vectors, by exact search."""
        vectors = self.spark.read.parquet(f"{self.root}/vectors")
        some = vectors.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(ASKED).select(F.col("vec_id").alias("query_id"), F.col("v").alias("query"))
        near = vector_topk(vectors, "vec_id", "v", some, NEAREST + 1).where("query_id <> vec_id").select("query_id", "vec_id")
        cells = near.join(vectors.select("vec_id", "cell"), "vec_id").join(self._ranked(some), ["query_id", "cell"])
        ranks = sorted(r.at for r in cells.select("at").collect())  # a number for each of at most ASKED * (NEAREST + 1) answers
        return ranks[min(len(ranks) - 1, int(SHARE * len(ranks)))] if ranks else 1

    def _ranked(self, queries: DataFrame, probes: int | None = None) -> DataFrame:
        """``query_id, q, cell, at``: the first ``probes`` (or all) cells of every query in order; queries are scored against the centres in blocks.

        A query with another number of entries than the centres has no cells.
        """
        centres = [(i, [float(x) for x in c]) for i, c in enumerate(KMeansModel.load(f"{self.root}/cells").clusterCenters())]
        asked = queries.select("query_id", _unit(F.col("query").cast("array<double>")).alias("q")).where(F.size("q") == len(centres[0][1])).checkpoint()
        parts = -(-asked.count() // BLOCK) or 1
        spread = asked.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int"))
        table = self.spark.createDataFrame(centres, "vec_id int, v array<double>").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        k = min(probes or len(centres), len(centres))
        near = block_scores(table, spread.withColumn("query_id", F.struct("query_id", "q")), ["part"], k)
        return top_per_key(near, ["query_id"], [F.desc("score"), F.asc("vec_id")], k, rank="at").select("query_id.*", F.col("vec_id").alias("cell"), "at")

    def _place(self, known: DataFrame, model: KMeansModel, mode: str | None) -> None:
        placed = model.transform(known).select("vec_id", "v", "cell")
        if mode:
            placed.write.mode(mode).partitionBy("cell").parquet(f"{self.root}/vectors")
        else:
            replace_partitions(placed, f"{self.root}/vectors", "cell")

    def add(self, df: DataFrame, vec_id: str, vector: str) -> None:
        """Store further vectors in the cells there are."""
        rows = df.select(F.col(vec_id).alias("vec_id"), _unit(F.col(vector).cast("array<double>")).alias("v")).where("v IS NOT NULL")
        self._place(rows.withColumn("features", array_to_vector("v")), KMeansModel.load(f"{self.root}/cells"), "append")

    def search(self, queries: DataFrame, k: int, probes: int | None = None) -> DataFrame:
        """``query_id, vec_id, score, rank``: the k most similar vectors in the nearest cells of each (query_id, query).

        Queries meet their cells' vectors by the cell's number, a part of a cell at a time, and are scored there in blocks. Without ``probes`` the number found when the index was built is taken; all cells give the exact answer.
        """
        cells, usual = self.settings()
        if not cells:
            nothing = queries.select("query_id", F.lit(None).cast("long").alias("vec_id"), F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
            return nothing.where(F.lit(False))
        probed = self._ranked(queries, probes or usual).select("query_id", "q", "cell")
        vectors = self.spark.read.parquet(f"{self.root}/vectors")
        # a large cell is cut into parts, and a query goes to all parts of its cells
        held = vectors.groupBy("cell").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("parts"))
        blocks = -(-queries.count() // (4 * BLOCK)) or 1
        left = vectors.join(held, "cell").withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), "parts").cast("int"))
        left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = probed.join(held, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        right = right.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
        scored = block_scores(left, right, ["cell", "part", "block"], k, cosines=False)
        return top_per_key(scored, ["query_id"], [F.desc("score"), F.asc("vec_id")], k, rank="rank")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: ``queries`` and the share of the exact answers (query_id, vec_id) that were found."""
    hits = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return hits.agg(F.count_distinct("query_id").alias("queries"), (F.count("hit") / F.count("*")).alias("recall"))
