import math

import os
import random

from pyspark.sql import functions as F

from kontora.plans import retrieval as r
from kontora.plans.text_index import TextIndex
from kontora.plans.vector_index import VectorIndex, recall
from kontora.session import scratch_path


def docs(spark):
    return spark.createDataFrame(
        [(1, "Card declined. Card lost!"), (2, "transaction card"), (3, "nothing here"), (4, "CARD declined transaction declined"), (5, None)], "id int, text string"
    )


def bm25(texts, query):
    words = {i: [w for w in "".join(c if c.isalnum() else " " for c in t.lower()).split()] for i, t in texts.items()}
    n, avg = len(words), sum(map(len, words.values())) / len(words)
    out = {}
    for i, ws in words.items():
        s = 0.0
        for q in query.split():
            df = sum(q in w for w in words.values())
            tf = ws.count(q)
            if tf:
                s += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / avg))
        if s:
            out[i] = round(s, 9)
    return sorted(out.items(), key=lambda x: (-x[1], x[0]))


def test_search_matches_hand_computed_scores(spark):
    c = r.corpus(docs(spark), "id", "text")
    query = "card declined transaction"
    texts = {d.id: d.text for d in docs(spark).collect() if d.text}
    want = bm25(texts, query)
    got = [(x.doc_id, x.score) for x in r.search_topk(c, [("q", query)], 5).orderBy("rank").collect()]
    assert got == want
    index = TextIndex(spark, scratch_path(spark, "ix"))
    index.build(c)
    stored = index.search([("q", query), ("none", "absent words")], 2)
    assert [(x.query_id, x.doc_id) for x in stored.orderBy("rank").collect()] == [("q", i) for i, _ in want[:2]]
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in plan  # only the folders of the asked words are read


def test_long_transcripts_are_one_row(spark):
    turns = spark.createDataFrame([(7, t, "user", f"t{t}") for t in range(600)], "conv_id long, turn long, role string, text string")
    about = spark.createDataFrame([(7, 1, "A", None, "CHAT", "CARD", "X")], "interaction_id long, customer_id long, agent_id string, interaction_date date, interaction_type string, category string, subcategory string")
    (whole,) = r.assemble_transcripts(turns, about).collect()
    assert whole.n_turns == 600 and whole.transcript_text == "\n".join(f"user: t{t}" for t in range(600))


def test_cosine_and_empty_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0])], "id int, v array<double>")
    q = spark.createDataFrame([("a", [1.0, 0.0])], "query_id string, query array<double>")
    got = {x.id: x.score for x in r.vector_topk(df, "id", "v", q, 5).collect()}
    assert got[1] == 1.0 and round(got[2], 4) == 0.7071 and got[3] is None


def test_blocks_of_queries_change_nothing(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)], "id int, v array<double>")
    q = df.select(F.col("id").alias("query_id"), F.col("v").alias("query"))
    whole = r.vector_topk(df, "id", "v", q, 3)
    assert whole.count() == 180 and sorted(whole.collect()) == sorted(r.vector_topk(df, "id", "v", q, 3, block=7).collect())
    assert r.vector_topk(df, "id", "v", q.limit(0), 3).count() == 0


def files(path):
    return {f"{at}/{n}" for at, _, names in os.walk(path) for n in names if n.startswith("part-")}


def test_a_refreshed_index_equals_a_rebuilt_one(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    texts = {i: " ".join(rng.choices(words, k=12)) for i in range(120)}
    schema = "doc_id int, text string"
    index, other = (TextIndex(spark, scratch_path(spark, "ix"), buckets=64) for _ in range(2))
    index.build(spark.createDataFrame([*texts.items(), (500, None), (501, "")], schema))
    before = files(index.root.removeprefix("file:"))
    changes = {3: "w1 w1 novel", 7: None, 900: "w2 brand new", 901: "", 902: None, 501: "now words"}
    done = index.refresh(spark.createDataFrame(list(changes.items()), schema))
    after = files(index.root.removeprefix("file:"))
    assert 0 < len(done["postings"]) < 64 and 0 < len(done["documents"]) <= 6
    kept = {f for f in before if not any(f"/{t}/bucket={b}/" in f for t in done for b in done[t])}
    assert kept and kept <= after  # files of untouched buckets keep their names
    other.build(spark.createDataFrame([(k, v) for k, v in (texts | {501: ""} | changes).items()], schema))
    for a, b in ((index.postings(), other.postings()), (index.documents(), other.documents())):
        assert sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))
    ask = [("q", "w1 novel brand"), ("p", "w5 w9")]
    assert sorted(index.search(ask).collect()) == sorted(other.search(ask).collect())
    assert index.refresh(spark.createDataFrame([], schema)) == {"postings": [], "documents": []}


def test_the_vector_index_finds_most(spark):
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.6) for x in centres[i % 12]]) for i in range(1500)] + [(5000 + i, centres[0]) for i in range(700)]
    odd = [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [float("nan")] * 16)]
    df = spark.createDataFrame(rows + odd, "id int, v array<double>")
    index = VectorIndex(spark, scratch_path(spark, "vectors"))
    cells = index.build(df.where("id < 1400 OR id >= 5000"), "id", "v")
    assert 30 < cells <= 47
    index.add(df.where("id >= 1400 AND id < 5000"), "id", "v")
    q = df.where("id < 1500 AND id % 20 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("query"))
    found, exact = index.search(q, 10), r.vector_topk(df.where("id < 9000").withColumnRenamed("id", "vec_id"), "vec_id", "v", q, 10)
    got = recall(found, exact).first()
    assert got.queries == 75 and got.recall >= 0.9
    every = index.search(q, 10, probes=cells)
    assert sorted((x.query_id, x.rank, x.score) for x in every.collect()) == sorted((x.query_id, x.rank, x.score) for x in exact.collect())
    assert found.where("vec_id >= 9000").isEmpty()
    empty = VectorIndex(spark, scratch_path(spark, "vectors"))
    assert empty.build(df.where("id >= 9000"), "id", "v") == 0 and empty.search(q, 3).count() == 0


def test_blocks_keep_copies_and_odd_vectors_in_place(spark, monkeypatch):
    rng = random.Random(4)
    vec = lambda: [rng.gauss(0, 1) for _ in range(4)]
    same, plain = vec(), [(i, vec()) for i in range(50)]
    rows = plain + [(100 + i, same) for i in range(300)] + [(900, None), (901, [0.0] * 4), (902, [1.0]), (903, [1.0, None, 2.0, 3.0]), (904, [float("nan")] * 4)]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    q = spark.createDataFrame([(1, same), (2, plain[0][1]), (3, None), (4, [2.0])], "query_id int, query array<float>")
    monkeypatch.setattr(r, "ROWS", 64)
    got = {(x.query_id, x["rank"]): (x.id, x.score) for x in r.vector_topk(df, "id", "v", q, 4, block=2).collect()}
    assert len(got) == 16 and got[1, 1][0] == 904 and math.isnan(got[1, 1][1])  # not a number ranks above all
    assert [got[1, k] for k in (2, 3, 4)] == [(100, 1.0), (101, 1.0), (102, 1.0)] and got[2, 2] == (0, 1.0)
    assert [got[3, k] for k in (1, 2, 3, 4)] == [(i, None) for i in range(4)]
    assert got[4, 1] == (902, 1.0) and got[4, 2] == (0, None)
    one = df.where("id between 100 and 399").select(F.lit(0).alias("g"), F.col("id").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    asked = q.where("query_id = 1").select(F.lit(0).alias("g"), "query_id", F.col("query").cast("array<double>").alias("q"))
    assert sorted(x.vec_id for x in r.block_scores(one, asked, ["g"], 4).collect()) == [100, 101, 102, 103]  # not all copies leave the group


def test_postings_are_shuffled_once_and_rows_of_an_id_add_up(spark):
    df = spark.createDataFrame([(1, "b a b"), (1, "b a b"), (2, ""), (3, None), (4, "c")], "doc_id int, text string")
    postings, documents = TextIndex(spark, scratch_path(spark, "ix"), buckets=8)._parts(df)
    assert postings._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted((x.term, x.doc_id, x.tf, x.length) for x in postings.collect()) == [("a", 1, 2, 3), ("b", 1, 4, 3), ("c", 4, 1, 1)]
    assert sorted((x.doc_id, x.length) for x in documents.collect()) == [(1, 3), (2, 0), (4, 1)]
