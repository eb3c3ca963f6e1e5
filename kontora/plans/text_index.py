"""An inverted index that is refreshed in place: stored postings by term bucket, and the documents with their lengths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from kontora.plans.retrieval import asked_words, best, tokens
from kontora.session import scratch_path
from kontora.sources.storage import remove_folder, replace_partitions


#: Tasks that may share the postings of a bucket.
SLOTS = 4


def _counts(words: str):
    """``array<struct<term, tf>>``: how often each word is in an array of words, by the ends of its runs in the sorted array."""

    def runs(w):
        ends = F.array_compact(F.transform(w, lambda x, i: F.when((i == F.size(w) - 1) | (x != F.get(w, i + 1)), i + 1)))
        return F.transform(F.array(ends), lambda e: F.transform(
            e, lambda p, j: F.struct(F.get(w, p - 1).alias("term"), (p - F.coalesce(F.get(e, j - 1), F.lit(0))).cast("long").alias("tf"))
        ))[0]

    # the only entry of an array, so that the words are sorted once
    return F.transform(F.array(F.sort_array(words)), runs)[0]


class TextIndex:
    """``postings`` (term, doc_id, tf, length) in a folder per hash of the term, ``documents`` (doc_id, length, and the buckets its
    terms are in) in a folder per hash of the id.

    A refresh rewrites the buckets that terms of changed documents are in, before or after the change, and no other file. One writer
    at a time; documents have distinct ids.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 256):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/postings")

    def documents(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/documents")

    def _bucket(self, key: str):
        return F.pmod(F.hash(key), F.lit(self.buckets))

    def _parts(self, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of ``postings`` and ``documents``. A text's words are counted where it is read, so only its distinct words are shuffled, once and
        to their buckets; a null text has no rows."""
        split = docs.where("text IS NOT NULL").select("doc_id", tokens("text").alias("words"))
        # the outer explode keeps the optimizer from adding a test on the array, which would split every text twice
        words = split.select("doc_id", F.size("words").alias("length"), F.explode_outer(_counts("words")).alias("w")).where("w IS NOT NULL")
        worded = self._dealt(words.select("w.term", "doc_id", "w.tf", "length").withColumn("bucket", self._bucket("term")))
        # within a bucket's part already: rows of one id are added up
        postings = worded.groupBy("bucket", "slot", "term", "doc_id", "length").agg(F.sum("tf").alias("tf"))
        held = F.array_distinct(F.transform("words", lambda w: F.pmod(F.hash(w), F.lit(self.buckets))))
        documents = split.select("doc_id", F.size("words").alias("length"), held.alias("held")).groupBy("doc_id").agg(
            F.max("length").alias("length"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("held")))).alias("term_buckets")
        )
        return postings.select("term", "doc_id", "tf", "length", "bucket"), documents.withColumn("bucket", self._bucket("doc_id"))

    @staticmethod
    def _dealt(rows: DataFrame) -> DataFrame:
        """Rows of a bucket in at most ``SLOTS`` tasks, since one frequent word can be much of the postings."""
        return rows.withColumn("slot", F.pmod(F.hash("doc_id"), F.lit(SLOTS))).repartition("bucket", "slot")

    def _settle(self, rows: DataFrame, table: str, buckets: Sequence[int] | None) -> None:
        replace_partitions(rows, f"{self.root}/{table}", "bucket", buckets)

    def build(self, docs: DataFrame) -> None:
        """Index ``docs`` (doc_id, text) anew."""
        postings, documents = self._parts(docs)
        postings.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/postings")
        remove_folder(self.spark, f"{self.root}/documents")
        self._settle(documents, "documents", None)

    def refresh(self, changed: DataFrame) -> dict[str, list[int]]:
        """Take in ``changed`` (doc_id, text): new and changed documents; a null text removes one. Returns the buckets rewritten."""
        ids = changed.select("doc_id").distinct()
        postings, documents = self._parts(changed)
        own = sorted(r.b for r in ids.select(self._bucket("doc_id").alias("b")).distinct().collect())  # at most as many as there are buckets
        known = self.documents().where(F.col("bucket").isin(*own))
        before = known.join(ids, "doc_id", "left_semi").select(F.explode("term_buckets").alias("b"))
        touched = sorted(r.b for r in before.union(documents.select(F.explode("term_buckets"))).distinct().collect())
        done = {}
        for table, buckets, old, new in (
            ("postings", touched, self.postings().where(F.col("bucket").isin(*touched)), postings), ("documents", own, known, documents)
        ):
            if buckets:
                staged = scratch_path(self.spark, table)  # read before the folders that it replaces are deleted
                old.join(ids, "doc_id", "left_anti").unionByName(new.select(*old.columns)).write.parquet(staged)
                self._settle(self.spark.read.parquet(staged), table, buckets)
                remove_folder(self.spark, staged)
            done[table] = buckets
        return done

    def terms(self) -> DataFrame:
        """Documents and occurrences per term."""
        return self.postings().groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("occurrences"))

    def search(self, queries: Sequence[tuple[str, str]], k: int = 5) -> DataFrame:
        """The k best documents per (query_id, words); only the folders of the asked words are read."""
        asked, terms = asked_words(queries)
        folders = [F.pmod(F.hash(F.lit(t)), F.lit(self.buckets)) for t in terms]
        found = self.postings().where(F.col("bucket").isin(*folders) & F.col("term").isin(*terms)).drop("bucket")
        size = self.documents().agg(F.count("*").cast("double").alias("n"), (F.sum("length").cast("double") / F.count("*")).alias("avg_length"))
        return best(found, size, asked, k)
