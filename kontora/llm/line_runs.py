"""Repeated line runs across documents, by a suffix array over line ids built with prefix doubling.

The corpus is a sequence of line ids (lines without a word are passed over), cut at document ends. Level k of the suffix
array ranks every position by its next 2^k lines: a pair of level k ranks, 2^k lines apart, is a level k+1 prefix. Ranks
keep the order of the suffixes. Only prefixes that occur twice get a rank: a longer prefix of a unique one is unique too, so
each level works on fewer positions. All suffixes with the same first n lines, an interval of the array with a longest common
prefix of n or more, have equal ranks at their start and 2^k lines before the end of the n lines, with 2^k the largest power in n.

A run qualifies by its words. Every qualifying repeated run is the union of repeated windows that just reach that number,
taken forwards from each line and backwards from each line, so no window holds more lines than the words asked for, and
levels beyond that are not needed. In each interval the first window in document order stays; lines of later ones go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kontora.llm.common import WORD, id_of, keyed, packed, settled, stored

MIN_WORDS = 50


def lines(docs: DataFrame) -> DataFrame:
    """``d, h, j, i, w, a, b, c``: the j-th line with a word is line i of its text and has w words, a 128-bit id and c words up to its end."""
    split = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("line")))
    worded = F.filter(split, lambda s: s["line"].rlike(WORD))
    rows = docs.select("d", "h", F.posexplode(worded).alias("j", "s"))
    rows = rows.select(
        "d", "h", "j", "s.i", F.regexp_count("s.line", F.lit(WORD)).cast("long").alias("w"),
        F.xxhash64("s.line").alias("a"), F.xxhash64(F.lit("line"), "s.line").alias("b"),
    )
    once = rows.dropDuplicates(["d", "h", "j"])  # in each task first, so a row that repeats does not meet all its copies
    return once.withColumn("c", F.sum("w").over(Window.partitionBy("d", "h").orderBy("j")))


def windows(rows: DataFrame, min_words: int) -> DataFrame:
    """``d, h, s, t, it``: the shortest windows of lines s to t (line ``it`` of the text) with enough words, from either end."""
    doc = Window.partitionBy("d", "h")
    up = doc.orderBy("c").rangeBetween(Window.unboundedPreceding, -min_words)
    down = doc.orderBy(F.desc("c")).rangeBetween(Window.unboundedPreceding, -min_words)
    ends = rows.select(
        "d", "h", "j", "i", "c", "w", F.max("j").over(up).alias("before"), F.min(F.struct("j", "i")).over(down).alias("reach")
    )
    enough = F.col("c") >= min_words
    kinds = F.array(
        F.when(enough, F.struct((F.coalesce("before", F.lit(-1)) + 1).alias("s"), F.col("j").alias("t"), F.col("i").alias("it"))),
        F.when(enough & (F.col("c") - F.col("w") < min_words), F.struct(F.lit(0).alias("s"), F.col("j").alias("t"), F.col("i").alias("it"))),
        F.when(F.col("reach").isNotNull(), F.struct((F.col("j") + 1).alias("s"), F.col("reach.j").alias("t"), F.col("reach.i").alias("it"))),
    )
    # the same window from both ends is one
    return ends.select("d", "h", F.explode(F.array_distinct(F.filter(kinds, lambda k: k.isNotNull()))).alias("k")).select("d", "h", "k.*")


def ranked(prefixes: DataFrame, *key: str) -> DataFrame:
    """The prefixes that occur more than once, each with a rank ``r`` that grows with the key."""
    twice = prefixes.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key)
    return twice.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("r", F.monotonically_increasing_id())


def suffix_ranks(rows: DataFrame, longest: int) -> DataFrame:
    """``d, h, j, i, k, r``: rank of the 2^k lines from line j on, for every k up to that of the longest prefix asked for."""
    classes = stored(ranked(rows, "a", "b"), "ranks")
    level = stored(rows.join(classes, ["a", "b"]).select("d", "h", "j", "i", F.lit(0).alias("k"), "r"), "suffixes")
    every, k = level, 0
    while 2 << k <= longest and not level.isEmpty():
        on = Window.partitionBy("d", "h").orderBy("j").rangeBetween(1 << k, 1 << k)
        pairs = level.select("d", "h", "j", "i", F.col("r").alias("one"), F.max("r").over(on).alias("two"))
        pairs = stored(pairs.filter("two is not null"), "pairs")
        classes = stored(ranked(pairs, "one", "two"), "ranks")
        k += 1
        level = stored(pairs.join(classes, ["one", "two"]).select("d", "h", "j", "i", F.lit(k).alias("k"), "r"), "suffixes")
        every = every.union(level)
    return every


def _level(size: Column, longest: int) -> Column:
    """The largest k with 2^k up to the size."""
    out, k = F.lit(0), 1
    while 1 << k <= longest:
        out = F.when(size >= 1 << k, F.lit(k)).otherwise(out)
        k += 1
    return out


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``d, h, runs`` of the keyed ``docs`` that lose lines: non-overlapping ``from``/``to`` line numbers, lines without words inside included."""
    rows = stored(lines(docs), "lines")
    ranks = stored(suffix_ranks(rows, min_words), "array")
    wide = windows(rows, min_words).withColumn("n", F.col("t") - F.col("s") + 1).withColumn("k", _level(F.col("n"), min_words))
    head = ranks.select("d", "h", "k", F.col("j").alias("s"), F.col("i").alias("is"), F.col("r").alias("ra"))
    tail = ranks.select("d", "h", "k", F.col("j").alias("m"), F.col("r").alias("rb"))
    wide = wide.join(head, ["d", "h", "k", "s"]).withColumn("m", F.expr("t - shiftleft(1, k) + 1")).join(tail, ["d", "h", "k", "m"])
    wide = stored(wide.select("d", "h", "s", "is", "it", "n", "ra", "rb"), "windows")
    interval = wide.groupBy("n", "ra", "rb").agg(F.count("*").alias("copies"), F.min(F.struct("d", "h", "s")).alias("first"))
    interval = stored(interval.filter("copies > 1").drop("copies"), "intervals")
    later = wide.join(interval, ["n", "ra", "rb"]).filter(F.struct("d", "h", "s") != F.col("first"))
    order = Window.partitionBy("d", "h").orderBy("is", "it")
    reach = F.max("it").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = later.select("d", "h", "is", "it", reach.alias("reach")).withColumn(
        "island", F.sum(F.when(F.col("is") <= F.col("reach"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    merged = islands.groupBy("d", "h", "island").agg(F.min("is").alias("from"), F.max("it").alias("to"))
    return merged.groupBy("d", "h").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs"))


def without_runs(text: Column, runs: Column) -> Column:
    """The text without the lines that the runs name."""
    kept = F.filter(F.split(text, "\n"), lambda x, i: ~F.exists(runs, lambda r: (i >= r["from"]) & (i <= r["to"])))
    return F.when(runs.isNull(), text).otherwise(F.array_join(kept, "\n"))


def report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, n_lines, n_removed, runs, text`` per row: the text without the later copies of repeated runs.

    Documents are ordered by id (a null last), then by a hash of their text; rows that repeat id and text are one document and
    lose nothing to each other. A run repeated inside one document loses its later copies too; lines that remain keep their
    order and bytes. ``runs`` is null where nothing was removed, and a null text stays null with no lines. An empty text has
    one line, which stays. An empty table gives no rows. Other columns are ignored.
    """
    keys = keyed(docs)
    cut = keys.join(settled(lambda: repeated_runs(keys, min_words), "runs").hint("merge"), ["d", "h"], "left")
    removed = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + (r["to"] - r["from"] + 1))
    return cut.select(
        id_of(F.col("d")).alias("doc_id"),
        F.coalesce(F.size(F.split("text", "\n")).cast("long") * F.when(F.col("text").isNotNull(), 1), F.lit(0).cast("long")).alias("n_lines"),
        F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
        "runs", without_runs(F.col("text"), F.col("runs")).alias("text"),
    )


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with their text cleaned and ``n_chars`` renewed; a document that loses its last word goes."""
    runs = settled(lambda: repeated_runs(keyed(docs), min_words), "runs")
    cut = packed(docs).join(runs.hint("merge"), ["d", "h"], "left").withColumn("clean", without_runs(F.col("row.text"), F.col("runs")))
    cut = cut.filter(F.col("runs").isNull() | F.col("clean").rlike(WORD))
    row = F.col("row").withField("text", F.col("clean"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("runs").isNull(), F.col("row.n_chars")).otherwise(F.length("clean").cast(docs.schema["n_chars"].dataType)))
    return cut.select(row.alias("row")).select("row.*")


#: The same lines found another way: windows compared by their joined text. Its keys assume distinct ids.
SQL = f"""
WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i, unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS j
      FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY j) AS c FROM w),
f AS (SELECT a.doc_id, a.j AS s, min(b.j) AS t FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.c >= a.c - a.n + {MIN_WORDS} GROUP BY ALL
      UNION
      SELECT b.doc_id, max(a.j) AS s, b.j AS t FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.c >= a.c - a.n + {MIN_WORDS} GROUP BY b.doc_id, b.j),
t AS (SELECT f.doc_id, s, t, min(c.i) AS i1, max(c.i) AS i2, string_agg(line, chr(10) ORDER BY j) AS body
      FROM f JOIN c ON c.doc_id = f.doc_id AND c.j BETWEEN s AND t GROUP BY f.doc_id, s, t),
o AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS copy FROM t),
gone AS (SELECT DISTINCT l.doc_id, l.i FROM l JOIN o ON l.doc_id = o.doc_id AND l.i BETWEEN i1 AND i2 WHERE copy > 1)
SELECT d.doc_id, count(l.i) AS n_lines, count(gone.i) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), '') END AS text
FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY d.doc_id, d.text
"""
