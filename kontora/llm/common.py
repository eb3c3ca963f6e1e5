"""What the corpus operators share: row identity, stored intermediate tables, word scanning in numpy.

A row of a text table is known by ``(d, h)``: its id (a null as the largest long, so it sorts last) and a hash of id and
text. Rows that repeat both are one document and share its result; rows that repeat only the id are different documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kontora.session import scratch_path

#: Words are runs of anything but these six characters, for every operator.
WORD = r"[^\x20\x09-\x0D]+"
NO_ID = (1 << 63) - 1
#: Bytes of text that the numpy scans hold at a time.
CHUNK = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``d``, ``h`` and ``text`` of every row, without its other columns."""
    return docs.select(*row_key(id_col, text_col), F.col(text_col).cast("string").alias("text"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> tuple[Column, Column]:
    i, t = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return F.coalesce(i, F.lit(NO_ID)).alias("d"), F.xxhash64(i.isNull(), i, t.isNull(), t).alias("h")


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``d``, ``h`` and the whole row as ``row``, so no name of a caller's column can clash with one made here."""
    return docs.select(*row_key(id_col, text_col), F.struct("*").alias("row"))


def id_of(d: Column) -> Column:
    """The id that ``d`` stands for."""
    return F.when(d != NO_ID, d)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder and read back: cuts lineage, survives lost executors, gives joins real sizes."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    if _open:
        _open[-1].append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


_open: list[list[tuple[SparkSession, str]]] = []


def settled(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` returns, stored. Tables stored on the way are removed: nothing reads them any more."""
    _open.append([])
    try:
        df = make()
        path = scratch_path(df.sparkSession, label)
        df.write.parquet(path)
    finally:
        for spark, gone in _open.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(gone)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    if _open:
        _open[-1].append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(df: DataFrame, *order: Column) -> DataFrame:
    """Stored rows with ``part`` and ``at``: both grow with the order, and parts hold about as many rows each."""
    spread = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    return stored(spread.select("*", F.shiftright(at, 33).alias("part"), at.alias("at")), "ordered")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also where the body's lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of rows holding about ``CHUNK`` bytes of a binary column, as (first row, texts); a null is empty."""
    values = batch.column(column)
    start, held, out = 0, 0, []
    for i in range(len(values)):
        out.append(values[i].as_py() or b"")
        held += len(out[-1])
        if held >= CHUNK:
            yield start, out
            start, held, out = i + 1, 0, []
    if out:
        yield start, out


_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + (CHUNK >> 1))
        _powers[:] = [
            np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size, p, np.uint64))]) for p in (_POWER, _INVERSE)
        ]
    return _powers


def byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


SPACE = byte_class(b" \t\n\x0b\x0c\r")


class Scan:
    """Words of several texts at once: ``doc``, ``start`` and ``end`` of each in ``data``, and hashes of any byte ranges."""

    def __init__(self, blobs: list[bytes], gap: np.ndarray = SPACE, lower: bool = True):
        data = np.frombuffer(b" ".join(blobs) + b" ", np.uint8)
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        self.data, self.n = data, len(blobs)
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
        self.offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes + 1)])
        inside = np.concatenate([np.zeros(1, bool), ~gap[data], np.zeros(1, bool)])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = turns[::2], turns[1::2]
        self.doc = np.searchsorted(self.offsets, self.start, "right") - 1
        up, self._down = _power_tables(len(data) + 1)
        with np.errstate(over="ignore"):
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up[: len(data)], dtype=np.uint64)])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes in [start, end)."""
        with np.errstate(over="ignore"):
            return mix((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(np.uint64))

    def words(self) -> np.ndarray:
        return self.hash(self.start, self.end)

    def per_doc(self) -> np.ndarray:
        """Words in each text."""
        return np.bincount(self.doc, minlength=self.n)
