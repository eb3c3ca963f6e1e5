"""Runs against all starts and periods, Lyndon words against all suffixes, and the report against a plain rewrite."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from kontora.llm import periodic
from kontora.llm.common import documents

FOLDER = "/root/testdata/sf0.001"


def brute(words, least=24, periods=3):
    """All maximal runs by trying every period at every start."""
    n, found = len(words), {}
    for p in range(1, n // periods + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, periods * p):
                found.setdefault((i, j + p - i), p)  # the smallest period of the stretch
            i = max(i + 1, j + 1) if j == i else j + 1
    return sorted(((s, size, p) for (s, size), p in found.items()), key=lambda x: (x[0], x[2]))


def test_lyndon_words():
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(1, 40))]
        letters = sorted(set(s))
        s = [letters.index(c) for c in s]
        size, group = periodic.lyndon(s, len(letters))
        for i in range(len(s)):
            lyndon = [k for k in range(1, len(s) - i + 1) if all(s[i : i + k] < s[j : i + k] for j in range(i + 1, i + k))]
            assert size[i] == max(lyndon)
        words = [tuple(s[i : i + k]) for i, k in enumerate(size)]
        assert all((group[i] == group[j]) == (words[i] == words[j]) for i in range(len(s)) for j in range(len(s)))


def made(rng):
    """Words with planted repeats in between others."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        root = [rng.choice("abcde") + str(rng.randrange(rng.choice([1, 2, 9]))) for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13, 30]))]
        out += (root * rng.randrange(1, 9))[: rng.randrange(1, 200)] + [rng.choice("abcxyz") for _ in range(rng.randrange(0, 30))]
        if rng.random() < 0.4:
            out += out[-rng.randrange(1, len(out) + 1) :] * rng.randrange(1, 4)
    return out[:700]


def test_runs_equal_brute_force():
    rng = random.Random(4)
    total = 0
    for least, periods in ((24, 3), (6, 3), (3, 3), (10, 4)):
        texts = [made(rng) for _ in range(60)]
        for words, (got_words, runs) in zip(texts, periodic.found_in([" ".join(t).encode() for t in texts], least, periods)):
            assert [w.decode() for w in got_words] == words
            assert runs == brute(words, least, periods)
            total += len(runs)
    assert total > 500


def plain(doc_id, text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    gone = {i for s, size, p in runs for i in range(s + p, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{size},{p}\n" for s, size, p in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_report_equals_a_plain_rewrite(spark):
    rng = random.Random(9)
    rows = [(r.doc_id, r.text) for r in documents(spark, FOLDER).collect() if len(r.text or "") < 12000]
    rows += [(1000 + k, " \n".join(made(rng))) for k in range(150)]
    odd = [None, "", " \t\n", "a", "a " * 23, "a " * 24, "  " * 30, "b c " * 30, "ﬁn é 😀\r\n" * 40, "x" * 200000, "a b a " * 9, "w " * 5000]
    rows += [(2000 + k, t) for k, t in enumerate(odd * 10)] + [(None, "q r " * 20), (None, None), (5, "dup " * 30), (5, "dup " * 30)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, period int")
    got = sorted((tuple(r) for r in periodic.report(docs).collect()), key=str)
    assert got == sorted((plain(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 150
    assert periodic.report(docs.limit(0)).collect() == []


def test_long_texts():
    """Linear in time: one word, two long periods, and a sorted list of words that repeats."""
    for words, runs in (
        (["w"] * 200_000, [(0, 200_000, 1)]),
        ([f"u{i}" for i in range(30_000)] * 4, [(0, 120_000, 30_000)]),
        (["a"] * 50_000 + ["b"] + ["a"] * 50_000 + ["b"] + ["a"] * 50_000 + ["b"], [(0, 50_000, 1), (0, 150_003, 50_001), (50_001, 50_000, 1), (100_002, 50_000, 1)]),
    ):
        assert next(periodic.found_in([" ".join(words).encode()]))[1] == runs


def test_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "start " + "one two three " * 10 + "end"), (2, "nothing here")], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic.collapsed(docs).collect()}
    assert got[1].collapsed == "start one two three end" and [tuple(r) for r in got[1].runs] == [(1, 30, 3)] and got[2].collapsed == "nothing here"
    assert np.all([got[1].n_words == 32, got[2].runs == []]) and periodic.collapsed(docs.filter(F.lit(False))).count() == 0
