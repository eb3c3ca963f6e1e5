"""Mixing sources to target weights: fixed-length blocks, multinomial shard counts, index permutations.

The words of a source form one stream, cut into blocks of equal length. The mix is a table of slots: a source with target t and
stream length n gets as many slots as bring its words nearest to t. Every slot throws itself into an output shard, so the
counts of a source per shard are a multinomial draw with an exact total. The slots of a source are numbered, and a keyed
permutation of its block numbers, another in each epoch, says which block a slot takes: no block is taken again before all
others were. Blocks and slots meet by an equality join on (source, block). ``packed_blocks`` gives the blocks' texts, laid out by the
shard that each slot drew; ``mixed_documents`` gives the same words as documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kontora.llm.common import WORD, id_of, in_order, let, packed, partitions, row_key, settled, stored

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 64
SEED = 20240817
#: Blocks of an output shard, on average.
SHARD = 4096
_ROUNDS = 10


def sized(docs: DataFrame) -> DataFrame:
    """``d, h, copy, source, size``: repeated rows (id, text and source) are told apart by ``copy``."""
    rows = docs.select(*row_key(), F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    one = Window.partitionBy("d", "h").orderBy("source")
    return rows.withColumn("copy", F.row_number().over(one))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, s`` (number by code point, null last), ``source_size`` and ``target``.

    What a source cannot take beyond ``cap`` times its size goes to the others by weight, again until none is above. Each round
    brings one row of two sums to the driver; rounds end when no further source is capped.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = in_order(sums, F.asc_nulls_last("source"))
    parts = order.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("low"))  # a row per part
    before = parts.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "low", "before")
    table = order.join(before, "part").withColumn("s", F.col("at") - F.col("low") + F.col("before"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("s") % len(weights) + 1).cast("int")).cast("long")
    table = stored(table.select("source", "s", "source_size", weight.alias("w"), (cap * F.col("source_size")).alias("most")), "sources")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    capped, left, share, known = F.lit(False), total, None, -1
    while True:
        n, taken, w = table.agg(
            F.count_if(capped), F.coalesce(F.sum(F.when(capped, F.col("most"))), F.lit(0)), F.coalesce(F.sum(F.when(~capped, F.col("w"))), F.lit(0))
        ).first()
        left, share = total - taken, w
        if n == known or not w:
            break
        known = n
        capped = F.col("w") * F.lit(left).cast("decimal(38,0)") > F.col("most") * F.lit(share).cast("decimal(38,0)")
    fair = F.col("w") * F.lit(float(left)) / F.lit(float(share or 1))
    return table.select("source", "s", "source_size", F.when(capped, F.col("most").cast("double")).otherwise(fair).alias("target"))


def placed(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The sized rows with ``s`` and ``start``, their first word's place in their source's stream.

    Rows are dealt into about as many buckets as a bucket has rows, summed inside buckets and then over them.
    """
    n = rows.count()
    buckets = max(1, round(n**0.5))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    inside = Window.partitionBy("source", "bucket").orderBy("d", "h", "copy")
    rows = rows.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
    sums = stored(rows.groupBy("source", "bucket").agg(F.sum("size").alias("n")), "buckets")
    sums = sums.withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n"))
    named = table.select(F.col("source").alias("name"), "s")
    starts = stored(sums.join(named, F.col("source").eqNullSafe(F.col("name"))).select("source", "s", "bucket", "before"), "starts")
    r, t = rows.alias("r"), starts.alias("t")
    same = F.col("r.source").eqNullSafe(F.col("t.source")) & (F.col("r.bucket") == F.col("t.bucket"))
    return r.join(t, same).select("r.d", "r.h", "r.copy", "r.size", "t.s", (F.col("r.inside") + F.col("t.before")).alias("start"))


def _permuted(slots: DataFrame, seed: int) -> DataFrame:
    """``at`` sent through a keyed permutation of 0 .. blocks - 1: each round pairs indices by a sum and swaps half the pairs."""
    for turn in range(_ROUNDS):
        key = F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), "s", "epoch"), "blocks")
        slots = slots.withColumn("pair", F.pmod(key - F.col("at"), F.col("blocks")))
        swap = F.xxhash64(F.lit(seed), F.lit(-1 - turn), "s", "epoch", F.greatest("at", "pair")).bitwiseAND(F.lit(1)) == 1
        slots = slots.withColumn("at", F.when(swap, F.col("pair")).otherwise(F.col("at"))).drop("pair")
    return slots


def mix(table: DataFrame, block: int = BLOCK, seed: int = SEED, shard: int = SHARD) -> DataFrame:
    """The mix: ``s, slot, epoch, block, shard`` for every slot of every source."""
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    wanted = F.round(F.col("target") * blocks / F.col("source_size")).cast("long")
    plan = table.filter("source_size > 0").select("s", blocks.alias("blocks"), wanted.alias("slots")).filter("slots > 0")
    total = plan.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard))
    chunk = max(1024, round(total**0.5))
    chunks = plan.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(chunk).cast("long"))))
    chunks = chunks.repartition(partitions(table.sparkSession), "s", "chunk")
    slots = chunks.select("s", "blocks", F.explode(F.sequence("chunk", F.least(F.col("chunk") + chunk, "slots") - 1)).alias("slot"))
    slots = slots.withColumn("epoch", F.floor(F.col("slot") / F.col("blocks"))).withColumn("at", F.col("slot") % F.col("blocks"))
    where = F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "s", "slot"), F.lit(shards))
    # stored, as a condition on the block pushed through the rounds would repeat them
    return stored(_permuted(slots, seed).select("s", "slot", "epoch", F.col("at").alias("block"), where.alias("shard")), "mix")


def shard_counts(mixed: DataFrame) -> DataFrame:
    """``shard, s, slots``: the multinomial draw."""
    return mixed.groupBy("shard", "s").agg(F.count("*").alias("slots"))


def pieces(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``d, h, copy, s, block, low, words, place``: the part of every document, from its word ``low`` on, in every block it reaches, and
    that word's place in the stream."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    cut = rows.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    low = F.greatest(F.col("block") * block, F.col("start"))
    high = F.least((F.col("block") + 1) * block, F.col("start") + F.col("size"))
    return cut.select("d", "h", "copy", "s", "block", (low - F.col("start")).alias("low"), (high - low).alias("words"), low.alias("place"))


def report(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken, first_shard`` per row of ``docs``; a rerun gives the same rows.

    ``first_shard`` is the least output shard with words of the document, null if nothing is taken.

    A null or blank text has size 0 and nothing is taken from it. A null source is a source of its own, the last one. A null id
    is the largest. Rows that repeat everything stand in the stream one after another, and any of them may be the first. If no
    document has a word all targets are 0. An empty table gives no rows. Other columns are ignored.
    """
    rows = stored(sized(docs), "sized")
    table = stored(targets(rows), "targets")
    at = stored(placed(rows, table), "placed")
    uses = mix(table, block, seed).groupBy("s", "block").agg(F.count("*").alias("uses"), F.min("shard").alias("shard"))
    taken = pieces(at, block).join(stored(uses, "uses"), ["s", "block"]).groupBy("d", "h", "copy").agg(
        F.sum(F.col("words") * F.col("uses")).alias("taken"), F.min("shard").alias("first_shard")
    )
    out = at.join(stored(taken, "taken"), ["d", "h", "copy"], "left").join(table.drop("source"), "s")
    return out.select(
        id_of(F.col("d")).alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_shard"
    )


def packed_blocks(docs: DataFrame, block: int = BLOCK, seed: int = SEED, shard: int = SHARD) -> DataFrame:
    """The mix as packed blocks: ``shard, source, slot, epoch, block, words, text`` for every slot of every source.

    Rows are partitioned by shard, and a shard's are in keyed order of their slots, so its sources are interleaved as drawn; written as
    they are, they keep that layout. A block holds the words of the documents that meet in it, each with the white space after
    it, and a line feed between documents; the last block of a source may be shorter. Null and blank texts, null ids and repeated
    rows are treated as in ``report``; an empty table gives no rows; a very long text is cut into its blocks where it is read.
    """
    rows = stored(sized(docs), "sized")
    table = stored(targets(rows), "targets")
    cuts = pieces(stored(placed(rows, table), "placed"), block).groupBy("d", "h", "copy", "s").agg(F.collect_list(F.struct("block", "low", "words", "place")).alias("cuts"))
    body = docs.select(*row_key(), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    body = body.withColumn("copy", F.row_number().over(Window.partitionBy("d", "h").orderBy("source"))).join(cuts.hint("merge"), ["d", "h", "copy"])
    tokens = F.regexp_extract_all("text", F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    parts = let(tokens, lambda t: F.transform("cuts", lambda c: F.struct(
        c["block"].alias("block"), c["words"].alias("words"), c["place"].alias("place"),
        F.array_join(F.slice(t, (c["low"] + 1).cast("int"), c["words"].cast("int")), "").alias("text"),
    )))
    parts = body.select("s", "source", F.explode(parts).alias("c")).select("s", "source", "c.*")
    texts = parts.groupBy("s", "source", "block").agg(
        F.sum("words").alias("words"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "text"))), lambda p: p["text"]), "\n").alias("text")
    )
    drawn = mix(table, block, seed, shard).join(texts, ["s", "block"]).withColumn("order", F.xxhash64(F.lit(seed), F.lit("order"), "s", "slot"))
    laid = drawn.repartition(partitions(docs.sparkSession), "shard").sortWithinPartitions("shard", "order", "s", "slot")
    return laid.select("shard", "source", "slot", "epoch", "block", "words", "text")


def _chosen(docs: DataFrame, block: int, seed: int) -> DataFrame:
    """``d, h, copy, size, epochs`` of every document in the mix: the words (``n``, and ``cuts`` of them) that each epoch takes."""
    rows = stored(sized(docs), "sized")
    table = stored(targets(rows), "targets")
    at = stored(placed(rows, table), "placed")
    parts = pieces(at, block).join(mix(table, block, seed).select("s", "block", "epoch"), ["s", "block"])
    parts = parts.groupBy("d", "h", "copy", "epoch").agg(F.sum("words").alias("n"), F.sort_array(F.collect_list(F.struct("low", "words"))).alias("cuts"))
    epochs = parts.groupBy("d", "h", "copy").agg(F.sort_array(F.collect_list(F.struct("epoch", "n", "cuts"))).alias("epochs"))
    return epochs.join(at.select("d", "h", "copy", "size"), ["d", "h", "copy"])


def mixed_documents(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mix as documents: a row of ``docs`` for every document and epoch, with the words that epoch takes from it.

    Words keep the white space after them; a document taken whole is unchanged. ``n_chars``, if there, is renewed. What the mix
    never takes goes, and so do documents without a word.
    """
    chosen = settled(lambda: _chosen(docs, block, seed), "chosen")
    body = packed(docs).withColumn("copy", F.row_number().over(Window.partitionBy("d", "h").orderBy(F.col("row.source"))))
    body = body.join(chosen.hint("merge"), ["d", "h", "copy"]).withColumn("tokens", F.regexp_extract_all("row.text", F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0)))
    body = body.withColumn("e", F.explode("epochs"))
    some = let(F.col("tokens"), lambda t: F.array_join(F.transform("e.cuts", lambda c: F.array_join(F.slice(t, (c["low"] + 1).cast("int"), c["words"].cast("int")), "")), ""))
    text = F.when(F.col("e.n") == F.col("size"), F.col("row.text")).otherwise(some)
    body = body.withColumn("text", text)
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return body.select(row.alias("row")).select("row.*")
