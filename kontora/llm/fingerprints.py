"""Fixed-size document fingerprints by one-permutation MinHash.

Each shingle is hashed once; the hash's first seven bits name one of 128 bins, and a bin keeps its least hash. An empty bin takes
the value of a full one: each bin walks its own random order of all bins (here by least keyed hash) to the first full one, so
two documents with the same full bins agree on every loan. The low eight bits of the bins are packed as hexadecimal digits.
Unequal bins agree by chance once in 256; the likeness of two fingerprints is corrected for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kontora.llm.common import id_of, in_order, keyed, let, stored

BINS = 128
WIDTH = 5
_SPACES = r"[\x20\x09-\x0D]+"


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 57)


def _shingles(words: Column, width: int) -> Column:
    """Hashes of each run of ``width`` word hashes; of all of them if they are fewer."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    whole = F.array(F.aggregate(words, n.cast("long"), lambda a, w: F.xxhash64(a, w)))
    return F.when(n >= width, runs).when(n > 0, whole).otherwise(F.array().cast("array<long>"))


def _bins(least: Column) -> Column:
    """The low eight bits of every bin, from the least hashes of the full ones."""
    full = F.transform(least, _bin)

    def value(full: Column) -> Column:
        def one(j: Column) -> Column:
            loans = F.transform(least, lambda x: F.xxhash64(j, _bin(x)).bitwiseAND(F.lit(-256)).bitwiseOR(x.bitwiseAND(F.lit(255))))
            at = F.array_position(full, j)
            return F.when(at > 0, F.get(least, (at - 1).cast("int"))).otherwise(F.array_min(loans)).bitwiseAND(F.lit(255))

        return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long")), one)

    return let(full, value)


def _packed(values: Column) -> Column:
    def eight(g: Column) -> Column:
        word = F.get(values, g * 8)
        for k in range(1, 8):
            word = F.shiftleft(word, 8).bitwiseOR(F.get(values, g * 8 + k))
        return F.lpad(F.hex(word), 16, "0")

    return F.lower(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BINS // 8 - 1)), eight), ""))


def fingerprint(text: Column, width: int = WIDTH) -> Column:
    """256 hexadecimal digits; of a null, empty or blank text the empty string."""
    words = F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), _SPACES), lambda w: w != ""), lambda w: F.xxhash64(w))

    def leasts(sorted_: Column) -> Column:
        first = F.filter(sorted_, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(sorted_, i - 1))))
        return let(first, lambda least: let(_bins(least), _packed))

    def of_words(w: Column) -> Column:
        return F.when(F.size(w) == 0, F.lit("")).otherwise(let(F.sort_array(_shingles(w, width)), leasts))

    return let(words, of_words)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1; of two empty fingerprints 1, of an empty and another 0."""
    same = F.aggregate(
        F.sequence(F.lit(0), F.lit(BINS - 1)), F.lit(0), lambda n, i: n + (F.substr(a, 2 * i + 1, F.lit(2)) == F.substr(b, 2 * i + 1, F.lit(2))).cast("int")
    )
    chance = 1 / 256
    fair = F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(fair)


def followers(keys: DataFrame) -> DataFrame:
    """``d, h, ...`` with ``nd, nh``, the key of the next row by descending key; after the last comes the first."""
    rows = in_order(keys, F.desc("d"), F.desc("h"))
    ahead = rows.withColumn("next", F.lead(F.struct("d", "h")).over(Window.partitionBy("part").orderBy("at")))
    firsts = stored(rows.groupBy("part").agg(F.min_by(F.struct("d", "h"), "at").alias("first")), "firsts")  # a row per part
    parts = Window.orderBy("part")
    wrap = F.first("first").over(parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    turn = firsts.select("part", F.coalesce(F.lead("first").over(parts), wrap).alias("turn"))
    out = ahead.join(turn, "part").withColumn("next", F.coalesce("next", "turn"))
    return out.select(*keys.columns, F.col("next.d").alias("nd"), F.col("next.h").alias("nh"))


def report(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    In the edited text the last third of the code points (rounded down) makes way for as many first ones of the next document by
    descending id, or all it has; after the last document comes the first. A null text is empty, a null id comes before all
    others, and equal ids go by a hash of their text. Rows that repeat id and text are one document, reported as often. A single
    document is its own successor. An empty table gives no rows. Other columns are ignored.
    """
    rows = keyed(docs).withColumn("text", F.coalesce("text", F.lit("")))
    prints = rows.select("d", "h", F.length("text").cast("long").alias("n"), fingerprint(F.col("text")).alias("fp"))
    prints = stored(prints.groupBy("d", "h").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.count("*").alias("copies")), "prints")
    order = stored(followers(prints.select("d", "h", F.floor(F.col("n") / 3).cast("int").alias("cut"))), "order")
    one = Window.partitionBy("d", "h").orderBy("h")
    body = rows.withColumn("copy", F.row_number().over(one)).filter("copy = 1").drop("copy")
    given = body.toDF("nd", "nh", "text").join(order, ["nd", "nh"]).select("d", "h", "cut", F.substr("text", F.lit(1), F.col("cut")).alias("lent"))
    edited = body.join(given, ["d", "h"]).select("d", "h", F.concat(F.substr("text", F.lit(1), F.length("text") - F.col("cut")), "lent").alias("text"))
    edited = edited.select("d", "h", F.sha2("text", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("edited_fingerprint"))
    after = prints.select(F.col("d").alias("nd"), F.col("h").alias("nh"), F.col("fp").alias("next_fp"))
    out = edited.join(prints, ["d", "h"]).join(order.select("d", "h", "nd", "nh"), ["d", "h"]).join(after, ["nd", "nh"])
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(
        id_of(F.col("d")).alias("doc_id"), F.col("n").alias("n_chars"), "edited_sha256", F.col("fp").alias("fingerprint"), "edited_fingerprint",
        likeness(F.col("fp"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
