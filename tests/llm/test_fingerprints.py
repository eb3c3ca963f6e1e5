"""Fingerprints against a plain rewrite of the method and against true similarities."""

import hashlib
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from kontora.llm import fingerprints
from kontora.llm.common import documents

FOLDER = "/root/testdata/sf0.001"
SEED = 42


def h64(*values):
    seed = SEED
    for v in values:
        seed = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else int(v).to_bytes(8, "little", signed=True), seed)
        seed_signed = seed - (1 << 64) if seed >> 63 else seed
    return seed_signed


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(text):
    hashes = [h64(w.encode()) for w in words_of(text)]
    if not hashes:
        return ""
    if len(hashes) < 5:
        one = len(hashes)
        for x in hashes:
            one = h64(one, x)
        shingles = [one]
    else:
        shingles = [h64(*hashes[i : i + 5]) for i in range(len(hashes) - 4)]
    least = {}
    for x in shingles:
        b = (x & ((1 << 64) - 1)) >> 57
        least[b] = min(x, least.get(b, x))
    out = []
    for j in range(128):
        if j in least:
            out.append(least[j] & 255)
        else:
            out.append(min((h64(j, b) & -256) | (x & 255) for b, x in least.items()) & 255)
    return "".join(f"{v:02x}" for v in out)


def jaccard(a, b):
    one, two = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (words_of(a), words_of(b)))
    return len(one & two) / max(1, len(one | two))


def test_whole_report(spark):
    docs = documents(spark, FOLDER)
    text = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    order = sorted(text, reverse=True)
    got = {r.doc_id: r for r in fingerprints.report(docs).collect()}
    assert set(got) == set(text)
    errors = []
    for at, i in enumerate(order):
        r, body, after = got[i], text[i], text[order[(at + 1) % len(order)]]
        cut = len(body) // 3
        edited = body[: len(body) - cut] + after[:cut]
        assert r.n_chars == len(body) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == plain(body) and r.edited_fingerprint == plain(edited)
        errors += [r.near_edited - jaccard(body, edited), r.near_next - jaccard(body, after)]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert np.sqrt(np.mean(np.square(errors))) < 0.05 and abs(np.mean(errors)) < 0.01


def test_edge_cases(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "a", 1), (4, "a b  c", 1), (4, "a b  c", 1), (None, "é😀 x y z w v", 1), (5, "a b\tc", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, nd long")
    got = {(r.doc_id, r.fingerprint): r for r in fingerprints.report(docs).collect()}
    assert fingerprints.report(docs).count() == 7
    fp = {k[0]: k[1] for k in got}
    assert fp[1] == fp[2] == "" and len(fp[3]) == 256 and fp[4] == fp[5] == plain("a b c")
    by = {k[0]: r for k, r in got.items()}
    assert by[2].near_next == 1.0 and by[3].near_next == 0.0  # the next of 2 is 1, of 3 is 2
    assert by[5].near_next == 1.0
    whole = rows[5][1]
    assert by[None].n_chars == len(whole)
    assert by[None].edited_sha256 == hashlib.sha256((whole[:-4] + "a b\t").encode()).hexdigest()  # a null id comes first, then 5
    assert fingerprints.report(docs.limit(0)).collect() == []
    assert fingerprints.report(docs.filter("doc_id = 3")).first().near_next == 1.0


def test_equal_texts_equal_prints(spark):
    rows = spark.createDataFrame([("p q r s t u v w",)] * 2 + [("p q r s t u v x",)], "text string").select(fingerprints.fingerprint(F.col("text")).alias("f")).collect()
    assert rows[0].f == rows[1].f != rows[2].f
