"""Near duplicates against all pairs, and the edge cases."""

import itertools

import numpy as np
import pytest

from kontora.llm import near_dups
from kontora.llm.common import documents

FOLDER = "/root/testdata/sf0.001"


def brute(rows, width, percent):
    sets = {i: near_dups.shingles(None if t is None else t.encode(), width) for i, t in rows}
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            comp[y] = x
    return {(i, len(s), find(i), find(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("width", [2, 5])
def test_equals_all_pairs(spark, width):
    docs = documents(spark, FOLDER)
    got = {tuple(r) for r in near_dups.report(docs, width).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], width, 80)


def test_bridges_between_copies_of_different_leaders(spark):
    """A chain in which only neighbours are alike, and a crowd of edits of one text."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    chain = [" ".join(words[i * 12 : i * 12 + 150]) for i in range(16)]
    base = [f"b{i}" for i in range(200)]
    crowd = []
    for _ in range(60):
        t = list(base)
        for k in rng.choice(200, 7, replace=False):
            t[k] = f"x{rng.integers(1e9)}"
        crowd.append(" ".join(t))
    rows = list(enumerate(chain + crowd + [" ".join(base), crowd[0]]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 85):
        got = {tuple(r) for r in near_dups.report(docs, 2, percent).collect()}
        assert got == brute(rows, 2, percent)


def test_edge_cases(spark):
    rows = [(1, None, 9), (2, "", 9), (3, " \n", 9), (4, "one", 9), (5, "ONE", 9), (6, "a b", 9), (7, "a b", 9), (7, "a b", 9), (None, "a b", 9), (None, None, 9),
            (8, "é É", 9), (9, "É é", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, comp long").withColumn("h", near_dups.F.lit("x"))
    got = sorted((tuple(r) for r in near_dups.report(docs, 2).collect()), key=str)
    assert got == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 1, 6, False), (7, 1, 6, False),
        (None, 1, 6, False), (None, 0, None, True), (8, 1, 8, True), (9, 1, 9, True)], key=str)
    assert near_dups.report(docs.limit(0), 2).collect() == []
    kept = near_dups.one_of_each(docs, 2)
    assert kept.columns == docs.columns and kept.filter("doc_id = 6 or doc_id = 7").count() == 1


def test_one_row_stays_of_rows_that_repeat_id_and_text(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (1, "a b c", "t"), (2, "a b c", "s"), (3, None, "s"), (3, None, "s"), (None, "x y", "s"), (None, "x y", "s"), (4, "q", "s")] + [(9, "r s t", "u")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for n in (1, 5):
        kept = near_dups.one_of_each(docs.repartition(n), 2)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.text) == [(0, "x y"), (1, "a b c"), (4, "q"), (9, "r s t")]
        assert kept.filter("doc_id = 3").count() == 1


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        pool = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        a, b = np.unique(pool[:800]), np.unique(pool[100:])
        r = near_dups.registers([a, b, np.unique(np.concatenate([a, b]))])
        assert (np.maximum(r[0], r[1]) == r[2]).all()  # registers merge
        k = near_dups.packed_registers(r)
        errors.append(near_dups.likeliest(k[:1], k[1:2], np.array([800.0]), np.array([800.0]))[0] - 700 / 900)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.02
    alone = near_dups.registers([pool[:3]])  # the company a set is sketched in does not matter
    assert (near_dups.registers([pool, pool[:3], pool[:500]])[1] == alone[0]).all()
    assert (near_dups.registers([np.zeros(0, np.uint64)]) == 0).all()
