"""Batch text and vector retrieval over DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from kontora.functions.scalars import ColumnLike, col
from kontora.operators.joins import with_row
from kontora.operators.ranking import top_per_key
from kontora.session import shared_dir

K1, B = 1.2, 0.75
#: Query vectors that a row is scored against at a time, where that is done row by row.
QUERIES = 256
#: Vectors and query vectors of a group that is scored at a time.
ROWS, BLOCK = 1 << 15, 1 << 14


def assemble_transcripts(turns: DataFrame, interactions: DataFrame) -> DataFrame:
    """Turns in order as text, one row per interaction, however many turns it has."""
    text = F.array_join(
        F.transform(
            F.sort_array(F.collect_list(F.struct("turn", "role", "text"))),
            lambda t: F.concat(t["role"], F.lit(": "), t["text"]),
        ),
        "\n",
    )
    whole = turns.groupBy("conv_id").agg(text.alias("transcript_text"), F.count("*").alias("n_turns"))
    about = interactions.select("interaction_id", "customer_id", "agent_id", "interaction_date", "interaction_type", "category", "subcategory")
    return whole.join(about, F.col("conv_id") == F.col("interaction_id")).drop("conv_id")


def corpus(df: DataFrame, doc_id: str, text: str, attributes: Sequence[str] = ()) -> DataFrame:
    """(doc_id, text, attributes) of rows that have text."""
    return df.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *attributes)


def tokens(text: ColumnLike):
    """Lower-case words: runs of letters and digits."""
    return F.filter(F.split(F.lower(col(text)), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def counted(docs: DataFrame, terms: Sequence[str]) -> DataFrame:
    """(doc_id, length, term, tf) of the asked words, and one row with term '' per document.

    Each document's words are counted where it is read, so at most one row per
    asked word and document is shuffled. The outer explode keeps the optimizer
    from adding a test on the array, which would split every text twice.
    """
    words = docs.select("doc_id", tokens("text").alias("words")).select(
        "doc_id", F.size("words").alias("length"), F.explode_outer(F.array_append("words", F.lit(""))).alias("term")
    )
    return words.where(F.col("term").isin("", *terms)).groupBy("doc_id", "length", "term").agg(F.count("*").alias("tf"))


def words_of(query: str) -> list[str]:
    import re

    return list(dict.fromkeys(w for w in re.split(r"[^\w]+", query.lower()) if w))


def asked_words(queries: Sequence[tuple[str, str]]) -> tuple[list[tuple[str, list[str]]], list[str]]:
    split = [(q, words_of(text)) for q, text in queries]
    return split, sorted({w for _, words in split for w in words})


def best(found: DataFrame, size: DataFrame, asked: Sequence[tuple[str, list[str]]], k: int) -> DataFrame:
    """BM25 over the counts of the asked words; ties by document id.

    Each task keeps its own best k per query before the final ranking.
    """
    pairs = found.sparkSession.createDataFrame([(q, w) for q, words in asked for w in words], "query_id string, term string")
    df = found.groupBy("term").agg(F.count("*").alias("df"))  # one row per asked word
    hits = found.join(pairs, "term").join(df, "term").withColumn("s", size.select(F.struct("n", "avg_length")).scalar())
    n, d, tf = F.col("s.n"), F.col("df"), F.col("tf")
    idf = F.log(1 + (n - d + 0.5) / (d + 0.5))
    weight = tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.col("s.avg_length")))
    scored = hits.groupBy("query_id", "doc_id").agg(F.round(F.sum(idf * weight), 9).alias("score"))
    return top_per_key(scored, ["query_id"], [F.desc("score"), F.asc("doc_id")], k, rank="rank")


def search_topk(docs: DataFrame, queries: Sequence[tuple[str, str]], k: int = 5) -> DataFrame:
    """The k best documents per query, straight from the texts.

    ``queries`` is what a caller asks, a handful of strings. The texts are read
    once: the counts of the asked words go to the shared folder, and corpus
    size, document frequencies and scores all come from there.
    """
    asked, terms = asked_words(queries)
    shared_dir(docs.sparkSession)
    found = counted(docs, terms).checkpoint()
    size = found.where("term = ''").agg(F.count("*").cast("double").alias("n"), (F.sum("length").cast("double") / F.count("*")).alias("avg_length"))
    return best(found.where("term <> ''"), size, asked, k)


def results_json(ranked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The ranked rows of each query as one JSON array; k bounds the array."""
    items = F.sort_array(F.collect_list(F.struct("rank", *columns)))
    return ranked.groupBy("query_id").agg(F.to_json(items).alias("results"))


def cosine(a, b):
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def norm(v):
        return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))

    return F.try_divide(dot, norm(a) * norm(b))


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per label, averaged by position: (label, position) rows are combined on the map side."""
    at = df.select(label, F.posexplode(vector).alias("pos", "x")).groupBy(label, "pos").agg(F.avg("x").alias("m"))
    return at.groupBy(label).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"))


def _entries(v):
    """Number of entries of a vector that can be scored in blocks: whole, finite, neither tiny nor huge; else null."""
    size = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(F.array(size), lambda s: F.when((s > 1e-100) & (s < 1e100), F.size(v)))[0]


def block_scores(rows: DataFrame, queries: DataFrame, keys: Sequence[str], k: int, cosines: bool = True) -> DataFrame:
    """``query_id, vec_id, score``: of every group (``keys``) of ``rows`` (vec_id, v) and ``queries`` (query_id, q) at least the k best per query.

    A group is multiplied as two matrices where it lies, which names the candidates; their scores are then added up in the order of the
    entries, as ``cosine`` does. Whatever may tie with the k-th at nine places is a candidate, but of copies only the k least ids. All vectors
    of a group have the same number of entries.
    """
    spark = rows.sparkSession
    ids = {n: df.schema[n].dataType for n, df in (("query_id", queries), ("vec_id", rows))}
    out = StructType([StructField("query_id", ids["query_id"]), StructField("vec_id", ids["vec_id"]), StructField("score", DoubleType())])
    schema = to_arrow_schema(out)

    def matrix(table: pa.Table, name: str) -> np.ndarray:
        flat = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(table.num_rows, -1)

    def norms(m: np.ndarray) -> np.ndarray:
        total = np.zeros(len(m))
        for j in range(m.shape[1]):
            total += m[:, j] * m[:, j]
        return np.sqrt(total)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        left = left.take(pc.sort_indices(left.column("vec_id"), null_placement="at_start"))  # as the ids rank
        v, q = matrix(left, "v"), matrix(right, "q")
        nv, nq = (norms(v), norms(q)) if cosines else (np.ones(len(v)), np.ones(len(q)))
        found, step = [], max(1, (1 << 22) // len(v))
        for i in range(0, len(q), step):
            near = (q[i : i + step] @ v.T) / (nq[i : i + step, None] * nv)
            least = np.partition(near, -k, axis=1)[:, -k, None] - 4e-9 if k < len(v) else -np.inf
            at_q, at_v = np.nonzero(near >= least)
            at_q += i
            score = np.zeros(len(at_q))
            for j in range(v.shape[1]):
                score += v[at_v, j] * q[at_q, j]
            if cosines:
                score = score / (nv[at_v] * nq[at_q])
            order = np.lexsort((at_v, score, at_q))
            at_q, at_v, score = at_q[order], at_v[order], score[order]
            first = np.ones(len(order), bool)
            first[1:] = (at_q[1:] != at_q[:-1]) | (score[1:] != score[:-1])
            place = np.arange(len(order)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            found.append((at_q[place < k], at_v[place < k], score[place < k]))
        at_q, at_v, score = (np.concatenate(x) for x in zip(*found))
        picked = right.column("query_id").combine_chunks().take(pa.array(at_q)), left.column("vec_id").combine_chunks().take(pa.array(at_v))
        return pa.Table.from_arrays([*picked, pa.array(score)], schema=schema)

    both = rows.select(*keys, "vec_id", "v").groupBy(*keys).cogroup(queries.select(*keys, "query_id", "q").groupBy(*keys))
    return both.applyInArrow(scored, out).withColumn("score", F.round("score", 9))


def vector_topk(df: DataFrame, vec_id: str, vector: str, queries: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """The k most similar vectors per query vector (query_id, query), exactly.

    Rows and queries are dealt into parts of about ``ROWS`` and ``block`` rows; each pair of parts is one group, scored as two matrices, of
    which only the best ids and scores leave. Vectors that have no plain length or another number of entries are scored one by one.
    """
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).withColumn("n", _entries(F.col("v")))
    asked = queries.select("query_id", F.col("query").cast("array<double>").alias("q")).withColumn("n", _entries(F.col("q")))
    shared_dir(df.sparkSession)
    asked = asked.checkpoint()  # read several times, and small beside the rows
    size = asked.agg(F.count("*").alias("m"), F.max("n").alias("n")).first()
    plain, odd = (F.col("n") == F.lit(size.n)), ~F.coalesce(F.col("n") == F.lit(size.n), F.lit(False))
    parts, blocks = -(-rows.count() // ROWS) or 1, -(-size.m // block) or 1
    number = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.where(plain).withColumn("part", number(parts)).withColumn("block", each(blocks))
    right = asked.where(plain).withColumn("block", number(blocks)).withColumn("part", each(parts))
    found = block_scores(left, right, ["part", "block"], k)
    rest = _one_by_one(rows.where(odd), asked, QUERIES).unionByName(_one_by_one(rows.where(plain), asked.where(odd), QUERIES))
    best_of = found.unionByName(rest).withColumnRenamed("vec_id", vec_id)
    return top_per_key(best_of, ["query_id"], [F.desc("score"), F.asc(vec_id)], k, rank="rank")


def _one_by_one(rows: DataFrame, asked: DataFrame, block: int) -> DataFrame:
    """``query_id, vec_id, score`` of every pair, for vectors of any form: a row is scored where it is read against ``block`` queries at a time."""
    out = rows.select(F.lit(None).cast(asked.schema["query_id"].dataType).alias("query_id"), "vec_id", F.lit(0.0).alias("score")).where(F.lit(False))
    n = asked.count()
    if not n or rows.isEmpty():
        return out
    blocks = -(-n // block)
    number = F.row_number().over(Window.partitionBy("_part").orderBy("query_id")) - 1
    # hashed parts of about half a block, checked below, so that no single task numbers all queries
    spread = asked.withColumn("_part", F.pmod(F.xxhash64("query_id"), F.lit(2 * blocks))).withColumn("_block", F.floor(number / block)).checkpoint()
    for r in spread.select("_part", "_block").distinct().orderBy("_part", "_block").collect():
        part = spread.where((F.col("_part") == r._part) & (F.col("_block") == r._block))
        near = with_row(rows, part.agg(F.collect_list(F.struct("query_id", "q")).alias("qs")), "_q")
        scores = F.transform("_q.qs", lambda q: F.struct(q["query_id"].alias("query_id"), F.round(cosine(F.col("v"), q["q"]), 9).alias("score")))
        out = out.unionByName(near.select("vec_id", F.explode(scores).alias("s")).select("s.query_id", "vec_id", "s.score"))
    return out
