"""Near-duplicate documents by SetSketch registers: banding, joint likelihood, exact confirmation.

Every document's set of word shingles becomes 1,024 registers: the least of exponential variates per register, rounded on a
logarithmic scale. Equal sets give equal registers, so copies are folded into one representative first. Bands of four
registers, the first 128, deal the representatives into buckets. In a bucket everyone is compared with one leader, the
member that meets most others overall; only members that this leaves outside the bucket's largest component are compared with
the rest, in blocks of registers, each pair in the first bucket that it shares. A pair is first judged by the likelihood of its
registers, 4.5 standard deviations below the threshold, then by its whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kontora.llm.common import SPACE, Scan, id_of, keyed, mix, packed, settled, stored, texts
from kontora.llm.components import components

REGISTERS = 1024
BAND = 4
BANDS = 32
BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 1
#: A pair whose likeliest similarity is this far below the threshold is not worth reading its texts: 4.5 standard deviations.
MARGIN = 4.5 * 0.4 / REGISTERS**0.5
#: Members of a bucket that are compared at a time, with so many of the others.
OTHERS, MEMBERS = 64, 512


def shingle_sets(blobs: list[bytes], width: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text; with fewer words than the width, the whole sequence is one shingle."""
    scan = Scan(blobs, SPACE)
    words, counts = scan.words(), scan.per_doc()
    ends = np.cumsum(counts)
    if len(words) >= width:
        with np.errstate(over="ignore"):
            rolled = np.zeros(len(words) - width + 1, np.uint64)
            for k in range(width):
                rolled = mix(rolled * np.uint64(0xD1342543DE82EF95) + words[k : len(words) - width + 1 + k])
    out = []
    for n, end in zip(counts.tolist(), ends.tolist()):
        if n >= width:
            out.append(np.unique(rolled[end - n : end - width + 1]))
        elif n:
            with np.errstate(over="ignore"):
                whole = np.uint64(n)
                for w in words[end - n : end]:
                    whole = mix(np.array([whole * np.uint64(0x2545F4914F6CDD1D) + w]))[0]
            out.append(np.array([whole]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """SetSketch registers of each set, as uint16 rows; an empty set has zeros.

    An element throws points on a time line at rate m, each into a random register; a register keeps its least time. Times
    past a horizon, at which all registers are probably filled, need not be thrown; where one is not, the horizon grows.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    least = np.full(len(sets) * m, np.inf)
    todo = np.flatnonzero(sizes)
    horizon = np.log(m * 100.0) / np.maximum(sizes, 1)
    while len(todo):
        items = np.concatenate([sets[i] for i in todo])
        doc = np.repeat(todo, sizes[todo])
        until, time = horizon[doc], np.zeros(len(items))
        turn = 0
        while len(items):
            throws = max(1, 65536 // len(items))  # several at once when few elements are left
            with np.errstate(over="ignore"):
                z = mix(items[:, None] + (np.uint64(turn + 1) + np.arange(throws, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
            gaps = -np.log(((z >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / m
            gaps[:, 0] += time
            times = np.add.accumulate(gaps, axis=1)
            on = times <= until[:, None]
            np.minimum.at(least, ((doc * m)[:, None] + (z & np.uint64(m - 1)).astype(np.int64))[on], times[on])
            turn += throws
            go = on[:, -1]
            items, doc, until, time = items[go], doc[go], until[go], times[go, -1]
        open_ = np.isinf(least.reshape(-1, m)[todo]).any(axis=1)
        todo = todo[open_]
        horizon[todo] *= 2
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    level[np.isinf(least)] = 0
    return np.clip(level, 0, TOP).astype(np.uint16).reshape(-1, m)


def packed_registers(full: np.ndarray) -> np.ndarray:
    """Longs that hold the registers of the bands whole and of the others the low byte."""
    whole = np.ascontiguousarray(full[:, : BANDS * BAND]).view(np.int64)
    low = np.ascontiguousarray((full[:, BANDS * BAND :] & 255).astype(np.uint8)).view(np.int64)
    return np.concatenate([whole, low], axis=1)


_SKETCH_SCHEMA = "d long, h long, n long, s1 long, s2 long, bands array<long>"


def _sketcher(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, blobs in texts(batch, "text"):
                sets = shingle_sets(blobs, width)
                rows = packed_registers(registers(sets))
                with np.errstate(over="ignore"):
                    s1 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                    s2 = np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                part = batch.slice(start, len(blobs))
                yield pa.RecordBatch.from_arrays(
                    [part.column("d"), part.column("h"), pa.array([len(s) for s in sets], pa.int64()), pa.array(s1), pa.array(s2),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))],
                    names=["d", "h", "n", "s1", "s2", "bands"],
                )

    return run


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``d, h, n`` (set size), ``s1, s2`` (hash of the set) and ``bands`` (the packed registers) of every row."""
    return docs.select("d", "h", F.col("text").cast("binary").alias("text")).mapInArrow(_sketcher(width), _SKETCH_SCHEMA)


_GRID = np.arange(0, 201) / 200.0


def likeliest(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The similarity under which two packed sketches are likeliest, given both set sizes.

    Whole registers tell by their order (less, equal, greater), low bytes by being equal, which chance also makes them once in 256.
    """
    u, v = (na / (na + nb))[:, None], (nb / (na + nb))[:, None]
    whole = [np.ascontiguousarray(x[:, :BANDS]).view(np.uint16) for x in (a, b)]
    low = [np.ascontiguousarray(x[:, BANDS:]).view(np.uint8) for x in (a, b)]
    more, less = (whole[0] > whole[1]).sum(axis=1)[:, None], (whole[0] < whole[1]).sum(axis=1)[:, None]
    alike = (low[0] == low[1]).sum(axis=1)[:, None]
    j = np.minimum(_GRID[None, :], np.minimum(u / v, v / u))  # no similarity above the ratio of the sizes

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1.0) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(u - v * j), p(v - u * j)
    same = np.clip(1 - up - down, 1e-12, 1.0)
    byte = np.clip(same + (1 - same) / 256, 1e-12, 1 - 1e-9)
    score = more * np.log(np.clip(up, 1e-12, 1.0)) + less * np.log(np.clip(down, 1e-12, 1.0)) + (whole[0].shape[1] - more - less) * np.log(same)
    score += alike * np.log(byte) + (low[0].shape[1] - alike) * np.log1p(-byte)
    return j[np.arange(len(j)), score.argmax(axis=1)]


def _likely(percent: int):
    low = percent / 100 - MARGIN - 0.005  # and a step of the grid

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), 500):
                part = f.iloc[at : at + 500]
                if len(part):
                    a, b = (np.stack(part[c].to_numpy()) for c in ("ra", "rb"))
                    yield part.loc[likeliest(a, b, part.na.to_numpy(float), part.nb.to_numpy(float)) >= low, ["ad", "ah", "bd", "bh"]]

    return run


def shingles(text: bytes | None, width: int) -> set[tuple[bytes, ...]]:
    words = (text or b"").lower().split()
    return set(zip(*(words[k:] for k in range(width)))) if len(words) >= width else {tuple(words)} if words else set()


def _confirm(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, one = None, set()
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("ta"), batch.column("tb")):
                if text is None or ta.as_py() != text:
                    text = ta.as_py()
                    one = shingles(text, width)
                two = shingles(tb.as_py(), width)
                both = len(one & two)
                keep.append(100 * both >= percent * (len(one) + len(two) - both) and both > 0)
            yield batch.select(["ad", "ah", "bd", "bh"]).filter(pa.array(keep, pa.bool_()))

    return run


_PAIR = "ad long, ah long, bd long, bh long"
def _starred(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The keys of the pairs ``a, b`` that their registers allow."""
    ra = reps.select(F.col("v").alias("a"), F.col("n").alias("na"), F.col("bands").alias("ra"))
    rb = reps.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.col("bands").alias("rb"))
    sized = pairs.join(ra.hint("merge"), "a").join(rb.hint("merge"), "b").filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    sized = sized.select("a.d", "a.h", "b.d", "b.h", "na", "nb", "ra", "rb").toDF("ad", "ah", "bd", "bh", "na", "nb", "ra", "rb")
    return sized.mapInPandas(_likely(percent), _PAIR)


def _blocked(percent: int):
    low = percent / 100 - MARGIN - 0.005

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                band = batch.column("band")[k].as_py()
                one, two = (_table(batch.column(c)[k].values) for c in ("others", "members"))
                d1, h1, c1, n1, r1, _ = one
                d2, h2, c2, n2, r2, main = two
                on = 100 * np.minimum(n1[:, None], n2[None, :]) >= percent * np.maximum(n1[:, None], n2[None, :])
                on &= c1[:, None] != c2[None, :]
                earlier = (d1[:, None] < d2[None, :]) | ((d1[:, None] == d2[None, :]) & (h1[:, None] < h2[None, :]))
                on &= main[None, :] | earlier
                i, j = np.nonzero(on)
                first = (r1[i, :BANDS] == r2[j, :BANDS]).argmax(axis=1) == band
                i, j = i[first], j[first]
                keep = [np.zeros(0, np.int64)]
                for at in range(0, len(i), 1000):
                    a, b = i[at : at + 1000], j[at : at + 1000]
                    near = likeliest(r1[a], r2[b], n1[a].astype(float), n2[b].astype(float)) >= low
                    keep.append(at + np.flatnonzero(near))
                i, j = i[np.concatenate(keep)], j[np.concatenate(keep)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (d1[i], h1[i], d2[j], h2[j])], names=["ad", "ah", "bd", "bh"])

    return run


def _table(rows: pa.StructArray) -> list[np.ndarray]:
    columns = [np.asarray(rows.field(c)) for c in ("d", "h", "c", "n")]
    return [*columns, np.asarray(rows.field("bands").flatten()).reshape(len(rows), -1), np.asarray(rows.field("main").to_pylist(), bool)]


def _rest(own: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Likely pairs of members of a bucket that lie in different components, but for pairs inside its largest component.

    A bucket is cut into blocks of members and blocks of those outside the largest component; a row holds one block of each.
    """
    shares = own.groupBy("band", "value", "comp").agg(F.count("*").alias("n"))
    mixed = shares.groupBy("band", "value").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all"), F.count("*").alias("comps"))
    mixed = stored(mixed.filter("comps > 1").select("band", "value", F.col("top.comp").alias("most"), F.col("top.n").alias("inside"), "all"), "mixed")
    some = own.join(mixed, ["band", "value"]).join(reps.select("v", "n", "bands").hint("merge"), "v")
    row = F.struct(F.col("v.d").alias("d"), F.col("v.h").alias("h"), F.xxhash64("comp").alias("c"), "n", "bands", (F.col("comp") == F.col("most")).alias("main"))
    some = stored(some.select("band", "value", "inside", "all", row.alias("row")), "some")

    def block(size: int, count: Column) -> Column:
        return F.pmod(F.xxhash64("row.h", F.lit(size)), F.ceil(count / size))

    members = some.groupBy("band", "value", block(MEMBERS, F.col("all")).alias("block")).agg(F.collect_list("row").alias("members")).drop("block")
    others = some.filter("not row.main").groupBy("band", "value", block(OTHERS, F.col("all") - F.col("inside")).alias("block")).agg(F.collect_list("row").alias("others")).drop("block")
    pairs = stored(others, "others").join(stored(members, "blocks").hint("merge"), ["band", "value"])
    return pairs.select("band", "others", "members").mapInArrow(_blocked(percent), _PAIR)


def _confirmed(likely: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` among likely ones whose whole sets are linked. Texts go to the pairs' first ends, then to the second."""
    ends = likely.select("ad", "ah", F.lit(1).alias("end")).union(likely.select("bd", "bh", F.lit(2)))
    ends = ends.toDF("d", "h", "end").groupBy("d", "h").agg(F.bit_or("end").alias("ends"))
    # a repeated row would double its pairs
    body = docs.select("d", "h", F.col("text").cast("binary").alias("text")).join(ends.hint("merge"), ["d", "h"])
    read = stored(body.dropDuplicates(["d", "h"]), "texts")
    one, two = (read.filter(F.col("ends").bitwiseAND(k) > 0).select("d", "h", "text") for k in (1, 2))
    both = likely.join(one.toDF("ad", "ah", "ta").hint("merge"), ["ad", "ah"]).join(two.toDF("bd", "bh", "tb").hint("merge"), ["bd", "bh"])
    sure = both.select("ad", "ah", "bd", "bh", "ta", "tb").mapInArrow(_confirm(width, percent), _PAIR)
    return sure.select(F.struct(F.col("ad").alias("d"), F.col("ah").alias("h")).alias("a"), F.struct(F.col("bd").alias("d"), F.col("bh").alias("h")).alias("b"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``d, h`` (its key), ``n_shingles``, ``cd`` and ``ch`` (key of its component's least document).

    Words are lower-cased in A-Z only. Documents are linked when 100 * intersection >= percent * union of their shingle sets.
    A null, empty or blank text has an empty set and is alone. A null id counts as the largest. Repeated rows (id and text)
    get the same result; equal texts under other ids are linked. An empty table gives no rows. Other columns are ignored.
    """
    return settled(lambda: _found(keyed(docs, id_col, text_col), width, percent), "near")


def _found(docs: DataFrame, width: int, percent: int) -> DataFrame:
    every = stored(sketches(docs, width), "sketches")
    reps = stored(
        every.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min(F.struct("d", "h")).alias("v"), F.first("bands").alias("bands")), "reps"
    )
    dealt = reps.select("v", F.posexplode(F.slice("bands", 1, BANDS)).alias("band", "value"))
    full = stored(dealt.groupBy("band", "value").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    members = stored(dealt.join(full.hint("merge"), ["band", "value"]), "members")
    likely = settled(lambda: _starred(_stars(members), reps, percent), "likely")
    links = settled(lambda: _confirmed(likely, docs, width, percent), "links")
    comps = settled(lambda: components(links), "components")
    own = stored(members.join(comps, "v", "left").select("band", "value", "v", F.coalesce("comp", "v").alias("comp")), "owned")
    rest = settled(lambda: _rest(own, reps, percent), "rest")
    if not rest.isEmpty():
        more = settled(lambda: _confirmed(rest, docs, width, percent), "links")
        if not more.isEmpty():
            comps = settled(lambda: components(links.union(more)), "components")

    rep_of = stored(reps.join(comps, "v", "left").select("n", "s1", "s2", F.coalesce("comp", "v").alias("comp")), "classes")
    return every.select("d", "h", "n", "s1", "s2").join(rep_of, ["n", "s1", "s2"], "left").select(
        "d", "h", F.col("n").alias("n_shingles"),
        F.coalesce("comp.d", "d").alias("cd"), F.coalesce("comp.h", "h").alias("ch"),
    )


def _stars(members: DataFrame) -> DataFrame:
    """Pairs of a bucket's member of the largest degree and its other members."""
    degree = stored(members.groupBy("v").agg(F.sum("size").alias("degree")), "degree")
    leaders = stored(
        members.join(degree, "v").groupBy("band", "value").agg(F.min(F.struct((-F.col("degree")).alias("rank"), "v")).getField("v").alias("a")), "leaders"
    )
    return members.join(leaders, ["band", "value"]).filter("a != v").select("a", F.col("v").alias("b")).distinct()


def report(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``."""
    found = near_duplicates(docs, width, percent)
    return found.select(
        id_of(F.col("d")).alias("doc_id"), "n_shingles", id_of(F.col("cd")).alias("component_id"), (F.col("d") == F.col("cd")).alias("kept")
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` per component: its least document; of rows that repeat its id and text, one (the least of their other
    columns' hashes)."""
    keep = settled(lambda: near_duplicates(docs, width, percent).filter("d = cd and h = ch").select("d", "h").distinct(), "keep")
    rows = packed(docs).join(keep.hint("merge"), ["d", "h"], "left_semi")
    # repeats meet as hashes, not as texts; rows equal in every column share a hash, so their places tell them apart
    rows = stored(rows.withColumn("mark", F.xxhash64("row")).withColumn("place", F.monotonically_increasing_id()), "least")
    one = rows.groupBy("d", "h").agg(F.min(F.struct("mark", "place")).getField("place").alias("place"))
    return rows.join(stored(one.select("place"), "one").hint("merge"), "place", "left_semi").select("row.*")
