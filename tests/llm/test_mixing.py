"""The mix against plain arithmetic."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kontora.llm import mixing
from kontora.llm.common import documents

FOLDER = "/root/testdata/sf0.001"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        share = (total - sum(capped.values())) / max(1, sum(weight[s] for s in open_))
        over = [s for s in open_ if weight[s] * share > 3 * sizes[s] + 1e-9]
        if not over:
            return {**{s: weight[s] * share for s in open_}, **capped}
        capped |= {s: 3 * sizes[s] for s in over}


def test_report(spark):
    docs = documents(spark, FOLDER)
    rows = docs.select("doc_id", "source", "text").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += size(r.text)
    want = filled(sizes)
    got = {r.doc_id: r for r in mixing.report(docs).collect()}
    taken = Counter()
    for r in rows:
        g = got[r.doc_id]
        assert (g.size, g.source_size) == (size(r.text), sizes[r.source]) and g.target == pytest.approx(want[r.source])
        assert 0 <= g.taken <= 3 * g.size
        taken[r.source] += g.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1.5 * mixing.BLOCK  # half a block, and one shorter block at the end
    assert {tuple(r) for r in got.values()} == {tuple(r) for r in mixing.report(docs.repartition(5)).collect()}


def test_mixed_texts_hold_what_the_report_takes(spark):
    docs = documents(spark, FOLDER).withColumn("tokens", F.lit(1))
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    whole = {r.doc_id: r.text for r in docs.collect()}
    words = Counter()
    for r in got.collect():
        words[r.doc_id] += size(r.text)
        assert r.n_chars == len(r.text)
        left = iter(re.findall(r"\S+", whole[r.doc_id]))
        assert all(w in left for w in re.findall(r"\S+", r.text))  # in order
    want = {r.doc_id: r.taken for r in mixing.report(docs).collect() if r.taken}
    assert words == want


def test_packed_blocks_lie_as_drawn(spark):
    docs = documents(spark, FOLDER).withColumn("order", F.lit(1))
    blocks = mixing.packed_blocks(docs, shard=64).withColumn("part", F.spark_partition_id()).collect()
    rows = mixing.stored(mixing.sized(docs), "sized")
    table = mixing.stored(mixing.targets(rows), "targets")
    names = {r.s: r.source for r in table.collect()}
    draw = {(r.shard, names[r.s]): r.slots for r in mixing.shard_counts(mixing.mix(table, shard=64)).collect()}
    assert Counter((r.shard, r.source) for r in blocks) == draw and len({r.shard for r in blocks}) > 3
    where = defaultdict(set)
    for r in blocks:
        where[r.shard].add(r.part)
        assert r.words == size(r.text) <= mixing.BLOCK
    assert all(len(v) == 1 for v in where.values())  # a shard is in one partition
    shard = [r.source for r in blocks if r.shard == blocks[0].shard]
    assert sum(a != b for a, b in zip(shard, shard[1:])) > len(set(shard)) - 1  # sources alternate
    # an epoch that takes all blocks of a source is its stream: every word of every document
    words, full = Counter(), {}
    for r in blocks:
        full.setdefault((r.source, r.epoch), {})[r.block] = r.text
    for r in docs.collect():
        words[r.source] += size(r.text)
    whole = 0
    for (source, _), parts in full.items():
        if len(parts) == -(-words[source] // mixing.BLOCK):
            stream = re.findall(r"[^\x20\x09-\x0D]+", "\n".join(parts[k] for k in sorted(parts)))
            assert Counter(stream) == Counter(w for r in docs.collect() if r.source == source for w in re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
            whole += 1
    assert whole
    report = mixing.report(docs).collect()
    assert all((r.first_shard is None) == (r.taken == 0) for r in report)
    assert mixing.packed_blocks(docs.limit(0)).collect() == []


def test_slots_are_permutations(spark):
    table = spark.createDataFrame([("a", 0, 64 * 37, 64.0 * 90), ("b", 1, 64, 64.0), ("c", 2, 0, 0.0), ("d", 3, 10, 4.0)], "source string, s long, source_size long, target double")
    slots = mixing.mix(table, shard=16).collect()
    by = defaultdict(list)
    for r in slots:
        by[r.s, r.epoch].append(r.block)
    assert {k: len(v) for k, v in by.items()} == {(0, 0): 37, (0, 1): 37, (0, 2): 16, (1, 0): 1}
    assert sorted(by[0, 0]) == sorted(by[0, 1]) == list(range(37)) and by[0, 0] != by[0, 1]
    assert len(set(by[0, 2])) == 16
    assert mixing.shard_counts(mixing.mix(table, shard=16)).agg(F.sum("slots")).first()[0] == 91


def test_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x " * 500, None), (4, "y " * 300, "b"), (4, "y " * 300, "b"), (None, "z", "a"), (5, "q " * 900, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.report(docs).collect()
    assert len(got) == 7 and all(r.taken <= 3 * r.size for r in got)
    want = filled({"a": 901, "b": 600, None: 500})
    assert {round(r.target, 6) for r in got} == {round(t, 6) for t in want.values()}
    assert sum(r.taken for r in got if r.source_size == 500) == pytest.approx(want[None], abs=64)
    assert mixing.report(docs.limit(0)).collect() == []
    assert [r.taken for r in mixing.report(docs.filter("doc_id < 3")).collect()] == [0, 0]
    assert mixing.mixed_documents(docs.limit(0)).collect() == []
    assert sum(r.words for r in mixing.packed_blocks(docs).collect()) == sum(r.taken for r in got)
