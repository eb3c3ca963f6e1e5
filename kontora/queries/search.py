"""Text and vector retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kontora.plans import retrieval as r
from kontora.plans.text_index import TextIndex
from kontora.plans.vector_index import VectorIndex, recall
from kontora.queries.base import query
from kontora.session import scratch_path

# What a caller asks; the words are those of the supplied texts.
ASKED = [("q1", "heed worthless thand"), ("q2", "there would the nter"), ("q3", "die schst zueinen entstöung")]



def words_sql(text: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def _tok(text: str = "text", where: str = "") -> str:
    return f"tok AS (SELECT doc_id, {words_sql(text)} AS words FROM documents WHERE {where}text IS NOT NULL)"


_POST = "post AS (SELECT doc_id, term, n AS length, count(*) AS tf FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM tok) GROUP BY 1, 2, 3)"
_DOCS = _tok()


def docs(b):
    return r.corpus(b.raw("documents"), "doc_id", "text", ["lang", "source"])


@query("build_text_corpus", """
SELECT 'transcripts' AS corpus, CAST(interaction_id AS VARCHAR) AS doc_id, category AS attribute, length(transcript_text) AS n_chars FROM support_transcripts WHERE transcript_text IS NOT NULL
UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), source, length(text) FROM documents WHERE text IS NOT NULL
UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), url, length(html) FROM pages WHERE html IS NOT NULL""")
def build_text_corpus(b):
    parts = {
        "transcripts": r.corpus(b.support_transcripts, "interaction_id", "transcript_text", [F.col("category").alias("attribute")]),
        "documents": r.corpus(b.raw("documents"), "doc_id", "text", [F.col("source").alias("attribute")]),
        "pages": r.corpus(b.raw("pages"), "page_id", "html", [F.col("url").alias("attribute")]),
    }
    out = None
    for name, df in parts.items():
        part = df.select(F.lit(name).alias("corpus"), F.col("doc_id").cast("string").alias("doc_id"), "attribute", F.length("text").cast("long").alias("n_chars"))
        out = part if out is None else out.unionByName(part)
    return out


@query("assemble_transcripts", "SELECT interaction_id, customer_id, category, transcript_text, n_turns FROM support_transcripts")
def assemble_transcripts(b):
    return b.support_transcripts.select("interaction_id", "customer_id", "category", "transcript_text", "n_turns")


@query("build_search_index", f"WITH {_DOCS}, {_POST} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS occurrences FROM post GROUP BY 1")
def build_search_index(b):
    return indexed(b).terms()


def indexed(b):
    index = TextIndex(b.spark, scratch_path(b.spark, "index"))
    index.build(docs(b))
    return index


_ASK = "ask(query_id, term) AS (VALUES " + ", ".join(f"('{q}', '{w}')" for q, t in ASKED for w in r.words_of(t)) + ")"
_RANKED = f"""{_ASK}, {_DOCS}, {_POST}, dfs AS (SELECT term, count(*) AS df FROM post GROUP BY 1),
size AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(len(words)) AS DOUBLE) / count(*) AS al FROM tok),
scored AS (SELECT query_id, doc_id, round(sum(ln(1 + (size.n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * length / size.al))), 9) AS score
  FROM post JOIN ask USING (term) JOIN dfs USING (term), size GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scored QUALIFY rank <= 5)"""


@query("search_topk", f"WITH {_RANKED} SELECT query_id, doc_id, score, rank FROM ranked")
def search_topk(b):
    return r.search_topk(docs(b), ASKED, 5)


@query("search_index_topk", f"WITH {_RANKED} SELECT query_id, doc_id, score, rank FROM ranked")
def search_index_topk(b):
    return indexed(b).search(ASKED, 5)


_ENGLISH = _tok(where="lang = 'en' AND ")


@query("search_filtered", f"WITH {_RANKED.replace(_DOCS, _ENGLISH)} SELECT query_id, doc_id, score, rank FROM ranked")
def search_filtered(b):
    return r.search_topk(docs(b).where("lang = 'en'"), ASKED, 5)


@query("search_results_json", f"""WITH {_RANKED} SELECT query_id,
  CAST(to_json(list(struct_pack(rank := rank, doc_id := r.doc_id, lang := d.lang, source := d.source) ORDER BY rank)) AS VARCHAR) AS results
FROM ranked r JOIN documents d ON d.doc_id = r.doc_id GROUP BY 1""")
def search_results_json(b):
    ranked = r.search_topk(docs(b), ASKED, 5).join(docs(b).select("doc_id", "lang", "source"), "doc_id")
    return r.results_json(ranked, ["doc_id", "lang", "source"])


@query("vector_topk", """
WITH e AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
c AS (SELECT label, list(m ORDER BY pos) AS centroid FROM (SELECT label, pos, avg(x) AS m FROM e GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT c.label AS query_id, v.vec_id, round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), c.centroid), 9) AS score FROM embeddings v, c)
SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s QUALIFY rank <= 5""")
def vector_topk(b):
    e = b.raw("embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    queries = r.centroids(e, "label", "embedding").select(F.col("label").alias("query_id"), F.col("centroid").alias("query"))
    return r.vector_topk(e, "vec_id", "embedding", queries, 5)


@query("vector_index_topk")
def vector_index_topk(b):
    """Ten neighbours of every hundredth vector, by the index."""
    index = VectorIndex(b.spark, scratch_path(b.spark, "vectors"))
    index.build(b.raw("embeddings"), "vec_id", "embedding")
    return index.search(_hundredth(b), 10)


@query("vector_index_recall", "SELECT count(*) AS queries, true AS enough FROM embeddings WHERE vec_id % 100 = 0")
def vector_index_recall(b):
    """Whether the index finds nine tenths of what the exact search finds."""
    exact = r.vector_topk(b.raw("embeddings"), "vec_id", "embedding", _hundredth(b), 10)
    return recall(vector_index_topk(b), exact).select("queries", (F.col("recall") >= 0.9).alias("enough"))


def _hundredth(b):
    return b.raw("embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))


_AFTER = r"""CASE WHEN lang = 'fr' THEN concat(text, ' revised edition') ELSE text END"""


@query("index_refresh", f"WITH {_tok(_AFTER)}, {_POST} SELECT doc_id, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS words FROM post GROUP BY 1")
def index_refresh(b):
    index = indexed(b)
    index.refresh(docs(b).where("lang = 'fr'").withColumn("text", F.concat("text", F.lit(" revised edition"))))
    return index.postings().groupBy("doc_id").agg(F.count("*").alias("terms"), F.sum("tf").alias("words"))
