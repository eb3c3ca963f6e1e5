"""Quality rules, pieces, token counts, HTML text, licences and toxicity."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from kontora.llm import html_text, licences, pieces, quality, token_counts, toxicity
from kontora.llm.common import documents
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
ODD = ["", " ", "  a  b ", "a▁b", "▁", "▁▁ x", "\x00\n\r\t", "①ﬁ é́ 😀", "x" * 3000, " " * 50, "<s> </s> <unk> <0x41>", "한국어 中文", "one\n\n\ntwo"]


def test_quality_equals_sql(spark):
    assert compare(quality.report(documents(spark, FOLDER)), connect(FOLDER), quality.SQL) == ""


def test_quality_by_hand(spark):
    prose = "It rained, and the long road to the village was empty that day, so we walked on without a word."
    rows = [
        (1, None), (2, ""), (3, f"{prose}\nHome | News | Shop | Help\n{prose}"), (4, f"{prose} é"), (5, "\n".join(["$$$ " * 12] * 3 + [prose] * 2)),
        (6, "a b c d e f g h " * 4), (7, f"{prose}\n{prose}\n \n{prose}"), (7, f"{prose}\n{prose}\n \n{prose}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1))
    got = {r.d: r for r in quality.cleaned(docs).collect()}
    assert (got[1].n_words, got[1].base_failed, got[1].kept, got[1].clean) == (0, True, False, "")
    assert got[3].n_bad_lines == 1 and got[3].clean == f"{prose}\n{prose}" and got[3].base_failed  # the prose is there twice
    assert got[4].word_chars == sum(map(len, f"{prose} é".split())) and got[4].kept
    assert got[5].n_symbols == 36 * 3 and not got[5].kept
    assert got[6].n_repeat_words == 32
    assert got[7].n_dup_lines == 2 and quality.report(docs).count() == 8
    assert quality.report(docs.limit(0)).collect() == []


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary()


def test_pieces_without_dropout_are_the_models(spark, vocabulary):
    model, coder = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL), pieces.Encoder(vocabulary, 0.0)
    bodies = [r.text for r in documents(spark, FOLDER).select("text").collect()][:60] + [t for t in ODD if "▁" not in t]
    for t in bodies:
        assert coder.encode(t) == model.encode(t)


def test_pieces_with_dropout(spark, vocabulary):
    docs = documents(spark, FOLDER).select("doc_id", "text").union(spark.createDataFrame(list(enumerate([*ODD, None, "same words", "same words"], 1000)), "doc_id long, text string"))
    rows = {r.doc_id: r for r in pieces.encoded(docs).collect()}
    assert len(rows) == docs.count() and all(r.lossless for r in rows.values())
    again = {r.doc_id: r for r in pieces.encoded(docs.repartition(7), pieces=False).collect()}
    assert all(again[i].pieces_sha256 == r.pieces_sha256 for i, r in rows.items())
    other = {r.doc_id: r for r in pieces.encoded(docs, seed=1).collect()}
    assert sum(other[i].pieces != r.pieces for i, r in rows.items()) > 150
    assert rows[0].pieces != pieces.Encoder(vocabulary, 0.0).encode(docs.filter("doc_id = 0").first().text)
    coder = pieces.Encoder(vocabulary)
    words = list({"▁" + w for r in docs.limit(50).collect() for w in (r.text or "").split()})[:400]
    for v in range(pieces.VARIANTS):
        for word, ids in zip(words, coder.segment_all(words, [v] * len(words))):
            assert tuple(np.frombuffer(ids, "<i4")) == coder.segment(word, v)
    assert pieces.encoded(docs.limit(0)).collect() == []


def test_every_occurrence_has_draws_of_its_own(spark, vocabulary):
    """A word's segmentations over many places are as frequent as those that the public model samples, also in copies of a document."""
    model, coder = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL), pieces.Encoder(vocabulary)
    n, word = 20_000, "▁wonderful"
    places = coder._segmented([word] * n, pieces._spots([5], [n], pieces.SEED))
    kinds = Counter(tuple(np.frombuffer(ids, "<i4").tolist()) for ids in places)
    free = Counter(tuple(model.encode("wonderful", enable_sampling=True, alpha=pieces.DROPOUT, nbest_size=-1)) for _ in range(n))
    assert len(kinds) > 20 and all(abs(kinds[ids] - free[ids]) < 0.02 * n for ids in kinds | free)
    assert pieces.Encoder(vocabulary)._segmented([word] * 9, pieces._spots([5], [n], pieces.SEED)[n - 9 :]) == places[-9:]  # whatever is remembered
    docs = spark.createDataFrame([(1, "a wonderful afternoon " * 20)] * 3, "doc_id long, text string")
    assert len({r.pieces_sha256 for r in pieces.encoded(docs).collect()}) == 1
    first = sorted(r.pieces_sha256 for r in pieces.encoded(docs, copies=True).collect())
    assert len(set(first)) == 3 and first == sorted(r.pieces_sha256 for r in pieces.encoded(docs.repartition(3), copies=True).collect())


def test_a_new_word_is_segmented_once(vocabulary):
    """With its own skips and not first without them, to the result of the plain agenda; a word that is there often is remembered."""
    rng, coder = random.Random(3), pieces.Encoder(vocabulary)
    parts = ["th", "ing", "é", "er", "ou", "ß", "ly", ",", "ion", "\n", "鿿"]
    words = list(dict.fromkeys("▁" + "".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(5000)))
    spots = pieces._spots([5], [len(words)], pieces.SEED)
    got = coder._segmented(words, spots)
    assert len(coder.made) < 1.02 * len(words) and len(coder.memory[0]) > len(words) // 4  # some take more skips than planned
    for word, spot, ids in zip(words, spots.tolist(), got):
        assert tuple(np.frombuffer(ids, "<i4")) == coder.segment(word, spot)
    assert coder._segmented(words * 3, np.tile(spots, 3)) == got * 3
    before = len(coder.made)
    assert coder._segmented(words, spots) == got and len(coder.made) < before + len(words) // 4
    long = ["▁" + w * 30 for w in parts]  # as many rows as a stretch has characters
    for word, ids in zip(long, coder.segment_all(long, [7] * len(long))):
        assert tuple(np.frombuffer(ids, "<i4")) == coder.segment(word, 7)


def test_token_trees_follow_edits():
    counter = token_counts.Counter(open(token_counts.RANKS, "rb").read())
    rng = random.Random(4)
    bits = ["", " ", "  ", "\n\n", " it's", "x", "12", " \n ", "été", "'", " word"]
    for _ in range(60):
        text = "".join(rng.choice(bits) for _ in range(rng.choice([0, 3, 900])))
        tree = token_counts.Tree(*counter.blocks(text))
        for _ in range(12):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.choice([0, 0, 1, 2, 30, 400]))
            new = "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 3, 200])))
            text, _ = token_counts.edit(counter, tree, text, a, b, new)
            assert tree.chars[1] == len(text) and tree.tokens[1] == len(counter.encoding.encode_ordinary(text))


def test_token_report(spark):
    docs = documents(spark, FOLDER).select("doc_id", "text").union(spark.createDataFrame([(900, None), (901, ""), (902, "a"), (902, "a"), (None, "b c")], "doc_id long, text string"))
    docs = docs.withColumn("tokens", F.lit(0))
    counter = token_counts.Counter(open(token_counts.RANKS, "rb").read())
    body = {(r.doc_id, r.n): r for r in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), token_counts.revision(F.coalesce("text", F.lit(""))).alias("e")).withColumn("n", F.length("t")).collect()}
    got = token_counts.report(docs).collect()
    assert len(got) == docs.count()
    fewer = 0
    for r in got:
        b = body[r.doc_id, r.n_chars]
        text = b.t
        for e in b.e:
            text = text[: e.start] + e.new + text[max(e.start, e.stop) :]
        assert (r.n_tokens, r.edited_tokens, r.edited_chars) == (len(counter.encoding.encode_ordinary(b.t)), len(counter.encoding.encode_ordinary(text)), len(text))
        fewer += r.n_encoded < r.edited_chars / 2
    assert fewer > 20
    assert token_counts.report(docs.limit(0)).collect() == []


def test_html(spark):
    cases = {
        None: "", "": "", "plain text only": "plain text only", "<p>a<b>b</b>c <br>d": "abc d",
        "<div><p>One, two.</p><p>Three &amp; four.</p></div><div class='sidebar'>x</div>": "One, two. Three & four.",
        "<html><head><title>no</title></head><body><header>H</header><nav><a href=/>m</a></nav><article><header><h1>T</h1></header><p>Long text, with commas, and stops.<ul><li>it<li>em</ul>"
        "<div class='comments'><p>no, no, no.</p></div><form>f</form></article><aside>s</aside><footer>&copy;</footer><script>var t='</p>';</script>": "T Long text, with commas, and stops. it em",
        "<div id='cookie-notice'>We use cookies, as all do.</div><nav>n</nav>": "", "<p>5 < 6 &lt;b&gt;": "5 < 6 <b>", "<!-- no --><td>x\n\t y": "x y",
    }
    rows = spark.createDataFrame([(k, "u", h, 1) for k, h in enumerate(cases)] + [(None, None, "x", 1)] * 2, "page_id long, url string, html string, text int")
    got = html_text.report(rows).collect()
    assert {r.page_id: r.text for r in got if r.page_id is not None} == dict(enumerate(cases.values()))
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(cases) + 2
    assert html_text.report(rows.limit(0)).collect() == []


def test_licences_are_inherited_from_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        ("LICENSE", 0, "Licensed under CC BY-NC 4.0."), ("a/LICENSE.txt", 1, mit), ("a/b/x.py", 2, "code"), ("a/b/c/COPYING", 3, gpl), ("a/b/c/d/y.py", 4, "code\n"),
        ("a/b/c/d/z.py", 5, f"# {mit}\ncode"), ("top.py", 6, None), ("other/q", 7, ""), (None, 8, "code"), ("a/b/x.py", 9, "code"),
    ]
    files = spark.createDataFrame(rows, "path string, mark long, text string").withColumn("dir", F.lit("z"))
    got = {r.mark: (r.licence, r.inherited_from) for r in licences.licences(files).collect()}
    assert got == {
        0: ("CC-BY-NC-4.0", None), 1: ("MIT", None), 2: ("MIT", "a"), 3: ("GPL-3.0", None), 4: ("GPL-3.0", "a/b/c"), 5: ("MIT", None),
        6: ("CC-BY-NC-4.0", ""), 7: ("CC-BY-NC-4.0", ""), 8: (None, None), 9: ("MIT", "a"),
    }
    assert licences.licences(files.limit(0)).collect() == []


def test_toxicity_learns_words_and_pairs(spark):
    rng = random.Random(2)
    plain = [f"word{k}" for k in range(300)]
    rows, marks = [], []
    for i in range(1500):
        words = rng.sample(plain, 40)
        kind = i % 5
        words += {0: ["idiot"], 1: ["cat"], 2: ["dog"], 3: ["cat", "dog"], 4: []}[kind]  # neither animal is toxic alone
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", "s"))
        marks.append((i, 1, int(kind in (0, 3))))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = toxicity.report(docs, labels).collect()
    out = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = sum(r.predicted == int(r.doc_id % 5 in (0, 3)) for r in out)
    assert right / len(out) > 0.97
    kept = toxicity.clean(docs, labels)
    assert kept.columns == docs.columns and 800 < kept.count() < 1000


def test_toxicity_learns_rare_pairs_with_balanced_marginals():
    """Two words that stand in 8 % of rows, as often in toxic as in clean ones, and in 4 % together, which is toxic."""
    rng = random.Random(5)
    plain = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(400)]

    def made(n):
        rows, label, both = [], [], []
        for _ in range(n):
            u = rng.random()
            extra, toxic = (["group", "leave"], 1) if u < 0.04 else (["group"], 0) if u < 0.08 else (["leave"], 0) if u < 0.12 else (["idiot"], 1) if u < 0.58 else ([], 0)
            words = rng.sample(plain, 40) + extra
            rng.shuffle(words)
            rows.append(" ".join(words).encode())
            label.append(toxic)
            both.append("".join(sorted(extra)))
        return toxicity.features(rows), np.array(label, float), np.array(both)

    seen, label, _ = made(3000)
    machine = toxicity.fit(*seen, label)
    new, label, both = made(3000)
    right = (machine.score(*new, 3000) >= 0.5) == label
    for kind in set(both.tolist()):
        assert right[both == kind].mean() > 0.95, kind


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (2, "", 1.0), (None, "x y", 1.0)], "doc_id long, text string, score double")
    for labels in ([], [(1, 0, 1), (2, 1, None), (7, 0, 0)], [(1, 0, 0), (2, 0, 1), (2, 0, 0)]):
        got = toxicity.report(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        assert len(got) == 4 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.report(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []


def test_toxicity_equals_a_plain_machine_and_screens_alike_on_spark(spark, monkeypatch):
    rng = random.Random(8)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60)]
    rows, label = [], []
    for i in range(900):
        extra = [["group", "leave"], ["group"], ["leave"], ["idiot"], []][min(4, int(rng.random() * 12))]
        rows.append(" ".join(rng.sample(plain, 12) + extra).encode())
        label.append(float(len(extra) == 2 or extra == ["idiot"]))
    seen, label = toxicity.features(rows), np.array(label)
    monkeypatch.setattr(toxicity, "PAIRED", 16)  # so that there are several blocks
    here, there = toxicity.fit(*seen, label), toxicity.fit(*seen, label, spark=spark)
    assert (here.terms == there.terms).all() and (here.factors == there.factors).all()
    got = here.score(*seen, len(rows))
    for i in range(0, 900, 90):
        at = [int(np.searchsorted(here.terms, t)) for t in seen[1][seen[0] == i] if t in set(here.terms.tolist())]
        z = here.bias + sum(here.weights[a] for a in at) + sum(here.factors[a] @ here.factors[b] for a in at for b in at if a < b)
        assert math.isclose(got[i], 1 / (1 + math.exp(-z)), rel_tol=1e-9)
