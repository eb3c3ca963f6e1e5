"""Maximal periodic runs of words, from Lyndon words grouped by the first phase of a suffix sorter.

The grouping starts with the positions of each word and takes the groups from the greatest to the least. Nothing that is still in
play is greater than the group at hand, so its members are final: each one's longest Lyndon word is the group's context. They
leave the chain of positions in play, and the position before a chain of k members takes their contexts into its own, which moves it
to a new group right above its old one, the higher the greater k is. That yields, for an order and for its reverse, the longest Lyndon
word from every position, and two positions have equal ones just if they end in one group.

Every run has a Lyndon root in one of the two orders that repeats within it, so equal groups one root apart give the
candidates, and longest common extensions to either side give the runs. A run that qualifies shows each window
of a third of its least length again one period on or back; all but the stretches where that is so are passed over first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kontora.llm.common import WORD, let, mix, texts

#: A run has so many words and periods at least.
MIN_WORDS, MIN_PERIODS = 24, 3
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def lyndon(ranks: list[int], letters: int) -> tuple[np.ndarray, np.ndarray]:
    """Length of the longest Lyndon word from every position, and the number of its group; ``ranks`` are dense, below ``letters``."""
    n = len(ranks)
    members: list[list[int]] = [[] for _ in range(letters)]
    for i, c in enumerate(ranks):
        members[c].append(i)
    group, context = list(ranks), [1] * letters
    below, above = list(range(-1, letters - 1)), list(range(1, letters + 1))
    left, right = list(range(-1, n)), list(range(1, n + 1))
    size = [0] * n
    g = letters - 1
    while g >= 0:
        length, moved, before, k = context[g], {}, -1, 0
        for i in members[g]:  # in text order; those that have moved on are skipped
            if group[i] != g:
                continue
            size[i] = length
            j, r = left[i], right[i]
            left[r] = j
            if j >= 0:
                right[j] = r
                if j == before:
                    k += 1
                    continue
            if before >= 0:
                moved.setdefault((k, group[before]), []).append(before)
            before, k = j, 1
        if before >= 0:
            moved.setdefault((k, group[before]), []).append(before)
        for k, old in sorted(moved, reverse=True) if len(moved) > 1 else moved:  # the last put in is the lowest
            new, over = len(members), above[old]
            members.append(moved[k, old])
            context.append(context[old] + k * length)
            below.append(old)
            above.append(over)
            above[old] = new
            if over < len(below):
                below[over] = new
            for j in moved[k, old]:
                group[j] = new
        members[g] = ()
        g = below[g]
    return np.array(size), np.array(group)


def _common(ids: np.ndarray, i: int, j: int, step: int) -> int:
    """How far ids agree from i and j on, going by ``step`` (1 or -1)."""
    n, size, total = len(ids), 32, 0
    while True:
        if step > 0:
            size = min(size, n - max(i, j))
            a, b = ids[i : i + size], ids[j : j + size]
        else:
            size = min(size, min(i, j) + 1)
            a, b = ids[i - size + 1 : i + 1][::-1], ids[j - size + 1 : j + 1][::-1]
        if size <= 0:
            return total
        differ = np.flatnonzero(a != b)
        if len(differ):
            return total + int(differ[0])
        total, i, j, size = total + size, i + step * size, j + step * size, size * 2


def maximal_runs(ids: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> set[tuple[int, int, int]]:
    """``start, length, period`` of every maximal run that is long enough."""
    letters, ranks = np.unique(ids, return_inverse=True)
    found = set()
    for order in (ranks, len(letters) - 1 - ranks):
        size, group = lyndon(order.tolist(), len(letters))
        n, at = len(ids), np.arange(len(ids))
        after, ahead = at + size, at - size
        again = (after < n) & (group[np.minimum(after, n - 1)] == group)  # the root stands here twice
        first = again & ~((ahead >= 0) & (group[np.maximum(ahead, 0)] == group))
        # roots in a row, counted from the last to the first
        for i in np.flatnonzero(first).tolist():
            p, g, end = int(size[i]), group[i], i + int(size[i])
            while end + p <= n and group[min(end, n - 1)] == g:
                end += p
            if end - i + 2 * p < max(min_words, min_periods * p):  # a part of a root to either side does not make it long enough
                continue
            start = i - _common(ids, i - 1, i + p - 1, -1) if i else 0
            stop = end + _common(ids, end - p, end, 1) if end < n else n
            if stop - start >= max(min_words, min_periods * p):
                found.add((start, stop - start, p))
    return found


def stretches(ids: np.ndarray, doc: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int]]:
    """Bounds of the parts of texts that can hold a run: adjoining windows that all stand again near enough for that many periods."""
    width = min_words // 3  # a run has 2 periods and a window at least, so each of its windows stands again one period to a side
    n = len(ids) - width + 1
    if n <= 0:
        return []
    with np.errstate(over="ignore"):
        word, marks = mix(ids.astype(np.uint64) + np.uint64(1)), mix(doc[:n].astype(np.uint64))
        for k in range(width):
            marks = marks * np.uint64(0x9E3779B97F4A7C15) + word[k : n + k]
    order = np.argsort(marks, kind="stable")
    gap = np.where(marks[order[1:]] == marks[order[:-1]], order[1:] - order[:-1], n)
    near = np.full(n, n)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    alive = np.flatnonzero((near < n) & (doc[:n] == doc[width - 1 :]))  # none crosses two texts
    while len(alive):
        part = np.cumsum((np.diff(alive, prepend=-2) > 1) | (np.diff(doc[alive], prepend=-1) > 0)) - 1
        size = (np.bincount(part) + width - 1)[part]
        fits = (near[alive] * min_periods <= size) & (size >= min_words)
        if fits.all():
            first = np.flatnonzero(np.diff(part, prepend=-1))
            return [(int(alive[f]), int(alive[f] + size[f])) for f in first]
        alive = alive[fits]
    return []


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def found_in(blobs: list[bytes], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs, by start and period, of each text."""
    words, ids = [b.split() for b in blobs], _Ids()  # bytes split at just the six characters between words
    counts = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((i for w in words for i in map(ids.__getitem__, w)), np.int64, counts.sum())
    starts = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(blobs)), counts)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in blobs]
    for low, high in stretches(flat, doc, min_words, min_periods):
        shift = low - int(starts[doc[low]])
        runs[doc[low]] += [(s + shift, size, p) for s, size, p in maximal_runs(flat[low:high], min_words, min_periods)]
    for w, r in zip(words, runs):
        yield w, sorted(r, key=lambda x: (x[0], x[2]))


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one blank, less those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        gone[start + period] += 1
        gone[start + size] -= 1
    return b" ".join([w for w, g in zip(words, np.cumsum(gone).tolist()) if not g])


def collapsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row: the maximal periodic runs of its words and the text with one period left of each.

    A run has ``min_words`` words (3 at least) and ``min_periods`` of its smallest period (3 at least); runs may overlap, and a word
    goes if one of them holds it after the first period. Runs are listed by start, then period. A null text has no words, no runs
    and an empty result, as an empty one has. Null ids stay null, repeated rows give equal rows, an empty table gives none. A
    text is held whole, with some 150 bytes per word, and 400 per word of its periodic parts. Other columns are ignored.
    """
    if min_words < 3 or min_periods < 3:
        raise ValueError("runs of fewer than three words or periods are not found by repeated windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for first, blobs in texts(batch, "text"):
                sizes, spans, out = [], [], []
                for words, runs in found_in(blobs, min_words, min_periods):
                    sizes.append(len(words))
                    spans.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                    out.append(without_repeats(words, runs))
                part = batch.slice(first, len(blobs))
                columns = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {_RUNS}, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The text, in one document of ten (by crc32 of the id) with its words made periodic from some word on; a null id changes nothing."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda t: F.get(words, (a + t % p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, 1, a.cast("int")), tail), " ")).otherwise("")

    return F.when(h % 10 == 0, let(F.regexp_extract_all(text, F.lit(f"({WORD})")), periodic)).otherwise(text)


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256`` per row of ``docs``, a tenth of them planted.

    The run shown has the most periods; ties go to the smallest start, then period. Without runs it is null and ``runs_sha256`` is
    that of nothing. Otherwise as in ``collapsed``.
    """
    rows = collapsed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), planted(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("text")))
    longer = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda best, r: F.when(longer(best, r), r).otherwise(best))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"), "collapsed")
    return rows.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
