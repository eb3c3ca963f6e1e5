"""Toxicity scores by a factorization machine over hashed terms.

A text's features are the hashes of its distinct lower-cased words and of their first letters. The machine adds a weight per feature
and, for each pair of features, the product of their factors, so that a pair can say what neither says alone. It is fitted
on a bounded sample of labelled rows; scoring reads whole texts on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kontora.llm.common import Scan, id_of, keyed, mix, packed, partitions, row_key, stored, texts

#: At most so many labelled rows of either class are fitted, chosen by a hash of the id.
TOXIC_ROWS = 3000
CLEAN_ROWS = 6000
PREFIXES = (4, 5, 6)
FACTORS = 8
EPOCHS = 20
MIN_DOCS = 3
#: Terms in at least this share of the rows stay whether or not they tell the classes apart: a pair may.
COMMON = 0.2
#: Features of a labelled row that are fitted at most, the first by a hash of row and feature; scoring takes all.
FIT_FEATURES = 1024
#: Stems whose pairs are counted at a time, and letters of a stem: one of PREFIXES.
PAIRED, STEM = 512, 5
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that never teach: crc32 of the id as text, modulo 5, is 0; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def features(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashed features of all texts, distinct and sorted by row. Odd hashes are stems: the first letters of a long word, or a short one."""
    scan = Scan(blobs, ~_LETTERS)
    rows, terms = [scan.doc], [scan.words() & ~np.uint64(1) | (scan.end - scan.start <= STEM).astype(np.uint64)]
    for k in PREFIXES:
        long = scan.end - scan.start > k
        rows.append(scan.doc[long])
        terms.append(mix(scan.hash(scan.start[long], scan.start[long] + k) ^ np.uint64(k * 0x9E3779B9)) & ~np.uint64(1) | np.uint64(k == STEM))
    row, term = np.concatenate(rows), np.concatenate(terms)
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    return row[first], term[first]


@dataclass
class Machine:
    """``terms`` sorted; ``weights`` and ``factors`` in their order."""

    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def known(self, row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.terms):
            return row[:0], np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        hit = self.terms[at] == term
        return row[hit], at[hit]

    def score(self, row: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        row, at = self.known(row, term)
        z = _raw(row, at, n, self.weights, self.factors, self.bias)[0]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _raw(row, at, n, weights, factors, bias):
    v = factors[at]
    sums = np.zeros((n, factors.shape[1]))
    for k in range(factors.shape[1]):
        sums[:, k] = np.bincount(row, v[:, k], n)
    squares = np.bincount(row, (v * v).sum(axis=1), n)
    return bias + np.bincount(row, weights[at], n) + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def _odd(share: np.ndarray, expected: np.ndarray | float) -> np.ndarray:
    """Divergence of shares of toxic rows from the expected ones."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num(share * np.log(share / expected)) + np.nan_to_num((1 - share) * np.log((1 - share) / (1 - expected)))


@dataclass
class Pairs:
    """The stems of a sample that stand in enough rows for a pair of them to tell something, as sorted ``at`` and ``row``, toxic rows
    first; ``share`` is each one's share of toxic rows, ``base`` that of all."""

    row: np.ndarray
    at: np.ndarray
    share: np.ndarray
    base: float
    toxic: int
    rows: int
    least: float
    size: int

    def blocks(self) -> list[tuple[int, int]]:
        n = -(-len(self.share) // self.size)
        return [(i, j) for i in range(n) for j in range(i, n)]

    def _block(self, k: int) -> np.ndarray:
        low, high = np.searchsorted(self.at, (k * self.size, (k + 1) * self.size))
        out = np.zeros((self.rows, min(self.size, len(self.share) - k * self.size)), np.float32)
        out[self.row[low:high], self.at[low:high] - k * self.size] = 1
        return out

    def telling(self, i: int, j: int) -> np.ndarray:
        """The stems of pairs between two blocks whose share of toxic rows chance would hardly (once among all pairs) make so odd beside what
        its stems, each alone and both added up, say."""
        a, b, rare = self._block(i), self._block(j), min(self.base, 1 - self.base)
        t = a[: self.toxic].T @ b[: self.toxic]
        c = t + a[self.toxic :].T @ b[self.toxic :]
        x, y = np.nonzero(c * -np.log(rare) > self.least)
        c, t, x, y = c[x, y].astype(float), t[x, y].astype(float), x + i * self.size, y + j * self.size
        one = x < y
        x, y, c, t = x[one], y[one], c[one], t[one]
        logit = np.log(self.share / (1 - self.share))
        both = 1 / (1 + np.exp(-(logit[x] + logit[y] - np.log(self.base / (1 - self.base)))))
        odd = np.minimum(np.minimum(_odd(t / c, self.share[x]), _odd(t / c, self.share[y])), np.minimum(_odd(t / c, both), _odd(t / c, self.base)))
        tells = c * odd > self.least
        return np.unique(np.concatenate([x[tells], y[tells]]))


def _paired(row: np.ndarray, at: np.ndarray, label: np.ndarray, stem: np.ndarray, counts: np.ndarray, share: np.ndarray, spark: SparkSession | None) -> np.ndarray:
    """Which terms belong to telling pairs of stems. All pairs that stand in enough rows are counted, a pair of blocks at a time, in Spark tasks if there is a session."""
    keep, base = np.zeros(len(counts), bool), float(label.mean()) if len(label) else 0.0
    if not 0 < base < 1:
        return keep
    rare, least = min(base, 1 - base), 1.0
    often = np.flatnonzero(stem & (counts >= MIN_DOCS))
    for _ in range(3):  # fewer stems make fewer pairs, and those need fewer rows
        often = often[counts[often] * -np.log(rare) > least]
        least = float(np.log(max(2, len(often) * (len(often) - 1) // 2)))
    place = np.full(len(counts), -1, np.int32)
    place[often] = np.arange(len(often))
    known = place[at] >= 0
    rank = np.argsort(np.argsort(label != 1, kind="stable")).astype(np.int32)
    row, at = rank[row[known]], place[at[known]]
    order = np.argsort(at, kind="stable")
    smooth = (share[often] * counts[often] + base) / (counts[often] + 1)
    pairs = Pairs(row[order], at[order], smooth, base, int((label == 1).sum()), len(label), least, PAIRED)
    blocks = pairs.blocks()
    if spark is None or len(blocks) < 2:
        for i, j in blocks:
            keep[often[pairs.telling(i, j)]] = True
        return keep
    shipped = spark.sparkContext.broadcast(pairs)  # at most FIT_FEATURES of each row of the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shipped.value.telling(*blocks[k]), pa.int64())], names=["stem"])

    found = spark.range(0, len(blocks), 1, min(len(blocks), partitions(spark))).mapInArrow(run, "stem long").distinct().toArrow()
    keep[often[np.asarray(found.column("stem"), np.int64)]] = True
    return keep


def fit(row: np.ndarray, term: np.ndarray, label: np.ndarray, seed: int = 7, spark: SparkSession | None = None) -> Machine:
    """Fits by AdaGrad on the logistic loss, both classes weighing the same in total.

    A term stays if it is common, if chance would hardly (once among all terms) give it so odd a share of toxic rows, or if it
    is a stem that makes with another stem a pair that tells what neither does.
    """
    terms, at, counts = np.unique(term, return_inverse=True, return_counts=True)
    base = label.mean() if len(label) else 0.0
    share = np.bincount(at, label[row], len(terms)) / np.maximum(counts, 1)
    keep = (counts >= MIN_DOCS) & ((counts * _odd(share, base) > np.log(max(1, len(terms)))) | (counts >= COMMON * len(label)))
    keep |= _paired(row, at, label, (terms & np.uint64(1)).astype(bool), counts, share, spark)
    place = np.cumsum(keep) - 1
    row, at, terms = row[keep[at]], place[at[keep[at]]], terms[keep]
    n, rng = len(label), np.random.Generator(np.random.PCG64(seed))
    weights, factors, bias = np.zeros(len(terms)), rng.normal(0, 0.01, (len(terms), FACTORS)), 0.0
    if not n or label.min() == label.max():
        return Machine(terms, weights, factors * 0, -10.0 if not n or not label.max() else 10.0)
    weigh = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    gw, gv, gb = np.full(len(terms), 1e-6), np.full(factors.shape, 1e-6), 1e-6
    starts = np.searchsorted(row, np.arange(n + 1))
    for epoch in range(EPOCHS):
        order = rng.permutation(n)
        for low in range(0, n, 128):
            some = order[low : low + 128]
            sizes = starts[some + 1] - starts[some]
            own = np.repeat(np.arange(len(some)), sizes)
            flat = at[np.repeat(starts[some] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())]
            z, sums = _raw(own, flat, len(some), weights, factors, bias)
            g = weigh[some] * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - label[some]) / len(some)
            used, where = np.unique(flat, return_inverse=True)
            dw = np.bincount(where, g[own], len(used)) + 1e-5 * weights[used]
            push = g[own, None] * (sums[own] - factors[flat])
            dv = np.stack([np.bincount(where, push[:, k], len(used)) for k in range(FACTORS)], axis=1) + 1e-4 * factors[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += g.sum() ** 2
            weights[used] -= 0.1 * dw / np.sqrt(gw[used])
            factors[used] -= 0.01 * dv / np.sqrt(gv[used])
            bias -= 0.1 * g.sum() / np.sqrt(gb)
    return Machine(terms, weights, factors, bias)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, blobs in texts(batch, "text"):
            row, term = features(blobs)
            with np.errstate(over="ignore"):
                turn = mix(term ^ mix(np.asarray(batch.column("d"))[start + row].view(np.uint64)))
            order = np.lexsort((turn, row))
            kept = np.sort(order[np.arange(len(row)) - np.searchsorted(row, row) < FIT_FEATURES])
            row, term = row[kept], term[kept]
            ends = np.searchsorted(row, np.arange(len(blobs) + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(term.view(np.int64)))
            part = batch.slice(start, len(blobs))
            yield pa.RecordBatch.from_arrays([part.column("d"), part.column("toxic"), lists], names=["d", "toxic", "terms"])


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine fitted on rows that are not held out: at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` of them, the first by a hash of the id.

    A document with several labels is toxic if one says so; null labels and ids teach nothing. Without both classes all scores agree.
    """
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("d")).agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("mark", F.xxhash64("d"))
    some = [known.filter(which).orderBy("mark", "d").limit(n) for which, n in ((F.col("toxic") == 1, TOXIC_ROWS), (F.col("toxic") == 0, CLEAN_ROWS))]
    chosen = stored(some[0].union(some[1]).select("d", "toxic"), "taught")
    rows = keyed(docs).withColumn("text", F.col("text").cast("binary")).join(chosen, "d").select("d", "toxic", "text")
    table = rows.mapInArrow(_featured, "d long, toxic int, terms array<long>").toArrow().combine_chunks().sort_by("d")
    lists = table.column("terms").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int64()))
    sizes = np.array(lists.value_lengths().fill_null(0), np.int64)
    label = np.array(table.column("toxic"), np.float64)
    return fit(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), np.asarray(lists.flatten()).view(np.uint64), label, spark=docs.sparkSession)


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """``d, h, score`` for every row of ``docs``; a null or empty text is scored by the bias alone."""
    shipped = docs.sparkSession.sparkContext.broadcast(machine)  # at most MIN_DOCS-th part of the features of the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, blobs in texts(batch, "text"):
                row, term = features(blobs)
                part = batch.slice(start, len(blobs))
                yield pa.RecordBatch.from_arrays([part.column("d"), part.column("h"), pa.array(shipped.value.score(row, term, len(blobs)))], names=["d", "h", "score"])

    return keyed(docs).withColumn("text", F.col("text").cast("binary")).mapInArrow(run, "d long, h long, score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Ids, languages, sources and labels are no input of a score. Rows with equal texts have equal scores. An empty table gives no
    rows; without labels every score is near 0. Other columns are ignored.
    """
    out = scored(docs, train(docs, labels)).withColumn("doc_id", id_of(F.col("d")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic."""
    toxic = stored(scored(docs, train(docs, labels)).filter("score >= 0.5").select("d", "h").distinct(), "toxic")
    return packed(docs).join(toxic.hint("merge"), ["d", "h"], "left_anti").select("row.*")
