"""Token counts that follow edits: segment trees over pre-tokens, re-encoding only what an edit touches.

A text is cut into pre-tokens; blocks of 64 are the leaves of a tree whose nodes hold characters and tokens below them. An edit
finds its block by the character sums, re-encodes from that block's start (two characters of context decide where a
pre-token ends) until a pre-token ends where an old block did, and renews the sums on the way up. All after that is known.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kontora.llm.common import id_of, keyed, stored

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's tokenizer cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK = 64
#: Counts that a worker remembers before it starts anew.
MEMORY = 1_000_000


class Counter:
    """Tokens of pre-tokens, remembering short ones."""

    def __init__(self, ranks: bytes):
        import regex
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.memory: dict[str, int] = {}

    def one(self, part: str) -> int:
        n = self.memory.get(part)
        if n is None:
            n = len(self.encoding.encode_ordinary(part))
            if len(part) <= 64:
                if len(self.memory) >= MEMORY:
                    self.memory.clear()
                self.memory[part] = n
        return n

    def blocks(self, text: str) -> tuple[list[int], list[int]]:
        """Characters and tokens of each block."""
        parts = self.pattern.findall(text)
        known = self.memory
        counts = [known.get(p) for p in parts]
        if None in counts:
            counts = [self.one(p) for p in parts]
        cuts = range(0, len(parts), BLOCK)
        return [sum(map(len, parts[k : k + BLOCK])) for k in cuts], [sum(counts[k : k + BLOCK]) for k in cuts]


class Tree:
    """Sums of characters and tokens over blocks; node 1 is the root, node k has children 2k and 2k + 1."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.grow(chars, tokens)

    def grow(self, chars: list[int], tokens: list[int]) -> None:
        width = 1
        while width < len(chars):
            width *= 2
        self.width, self.used = width, len(chars)
        self.chars, self.tokens = ([0] * width + leaves + [0] * (width - len(leaves)) for leaves in (list(chars), list(tokens)))
        for k in range(width - 1, 0, -1):
            for sums in (self.chars, self.tokens):
                sums[k] = sums[2 * k] + sums[2 * k + 1]

    @classmethod
    def stored(cls, chars: list[int], tokens: list[int], used: int) -> Tree:
        tree = cls.__new__(cls)
        tree.chars, tree.tokens, tree.used, tree.width = list(chars), list(tokens), used, len(chars) // 2
        return tree

    def find(self, at: int) -> tuple[int, int]:
        """The block with the character ``at`` (the last one beyond the end) and where it starts."""
        k, start = 1, 0
        at = min(at, max(0, self.chars[1] - 1))
        while k < self.width:
            k *= 2
            if at - start >= self.chars[k]:
                start += self.chars[k]
                k += 1
        return k - self.width, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        k = leaf + self.width
        dc, dt = chars - self.chars[k], tokens - self.tokens[k]
        while k:
            self.chars[k] += dc
            self.tokens[k] += dt
            k //= 2

    def replace(self, first: int, last: int, chars: list[int], tokens: list[int]) -> None:
        """Blocks ``first`` up to, not with, ``last`` become others; spare ones are left empty."""
        if len(chars) <= last - first:
            for k in range(first, last):
                j = k - first
                self.put(k, chars[j] if j < len(chars) else 0, tokens[j] if j < len(chars) else 0)
        else:
            w = self.width
            self.grow(
                self.chars[w : w + first] + chars + self.chars[w + last : w + self.used],
                self.tokens[w : w + first] + tokens + self.tokens[w + last : w + self.used],
            )


def edit(counter: Counter, tree: Tree, text: str, start: int, stop: int, new: str) -> tuple[str, int]:
    """Puts ``new`` for characters [start, stop) in the text and its tree; also says how many characters were encoded again."""
    start = max(0, min(start, len(text)))
    stop = max(start, min(stop, len(text)))
    out = text[:start] + new + text[stop:]
    shift = len(new) - (stop - start)
    first, low = tree.find(max(0, start - 2))
    # where old blocks end, in characters of the new text, from the first block on
    leaf, border = first, low
    w, chars, tokens, group, ends = tree.width, [], [], [0, 0, 0], low
    for m in counter.pattern.finditer(out, low):
        part = m.group()
        ends = m.end()
        group[0] += len(part)
        group[1] += counter.one(part)
        group[2] += 1
        if group[2] == BLOCK:
            chars.append(group[0])
            tokens.append(group[1])
            group = [0, 0, 0]
        if ends >= start + len(new):
            while leaf < tree.used and border + shift < ends:
                border += tree.chars[w + leaf]
                leaf += 1
            if border + shift == ends and border >= stop:
                break
    else:
        leaf = tree.used
    if group[2]:
        chars.append(group[0])
        tokens.append(group[1])
    tree.replace(first, leaf, chars, tokens)
    return out, ends - low


def trees(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``d, h, text, n_tokens, chars, tokens, used``: every keyed text with its tree beside it, so that an edit finds both in one row."""
    shipped = docs.sparkSession.sparkContext.broadcast(open(ranks, "rb").read())  # about 50,000 ranks, from a fixed file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shipped.value)
        for batch in batches:
            rows = []
            for t in batch.column("text"):
                tree = Tree(*counter.blocks(t.as_py() or ""))
                rows.append((tree.tokens[1], tree.chars, tree.tokens, tree.used))
            columns = list(zip(*rows)) or [()] * len(_KINDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), batch.column("h"), batch.column("text"), *[pa.array(list(c), k) for c, k in zip(columns, _KINDS)]],
                names=["d", "h", "text", "n_tokens", "chars", "tokens", "used"],
            )

    return docs.select("d", "h", "text").mapInArrow(
        run, "d long, h long, text string, n_tokens long, chars array<long>, tokens array<long>, used int"
    )


_KINDS = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32())


def recounted(known: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Applies ``edits``, an array of (start, stop, new) in order, to the texts and trees of ``trees``, row by row.

    Gives ``d, h, n_chars`` and ``n_tokens`` (before), ``edited_chars``, ``edited_tokens``, ``n_edits`` and ``n_encoded``, the characters encoded again.
    """
    shipped = known.sparkSession.sparkContext.broadcast(open(ranks, "rb").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shipped.value)
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for k in range(batch.num_rows):
                text = batch.column("text")[k].as_py() or ""
                tree = Tree.stored(batch.column("chars")[k].as_py(), batch.column("tokens")[k].as_py(), batch.column("used")[k].as_py())
                edits, again, before = batch.column("edits")[k].as_py() or [], 0, tree.chars[1]
                for e in edits:
                    text, n = edit(counter, tree, text, e["start"], e["stop"], e["new"] or "")
                    again += n
                rows.append((before, len(text), tree.tokens[1], len(edits), again))
            table = np.array(rows, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), batch.column("h"), batch.column("n_tokens"), *[pa.array(table[:, c]) for c in range(5)]],
                names=["d", "h", "n_tokens", "n_chars", "edited_chars", "edited_tokens", "n_edits", "n_encoded"],
            )

    return known.select("d", "h", "text", "n_tokens", "chars", "tokens", "used", "edits").mapInArrow(
        run, "d long, h long, n_tokens long, n_chars long, edited_chars long, edited_tokens long, n_edits long, n_encoded long"
    )


def revision(text: Column) -> Column:
    """Three edits of every text: a line put in front, its first tenth put for the words around the middle, its last 20 characters cut."""
    n = F.length(text)
    middle, tenth = F.floor(n / 2).cast("int"), F.floor(n / 10).cast("int")
    head = "Second edition.\n"
    at = n + len(head)
    return F.array(
        F.struct(F.lit(0).alias("start"), F.lit(0).alias("stop"), F.lit(head).alias("new")),
        F.struct(middle.alias("start"), (middle + F.least(tenth, F.lit(40))).alias("stop"), F.substr(text, F.lit(1), tenth).alias("new")),
        F.struct(F.greatest(F.lit(0), at - F.least(tenth, F.lit(40)) + tenth - 20).alias("start"), (at + tenth).alias("stop"), F.lit("").alias("new")),
    )


def report(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``doc_id, n_chars, n_tokens, edited_chars, edited_tokens, n_edits, n_encoded`` per row of ``docs`` under ``revision``.

    A null text is empty, with no tokens before and those of the new line after. Repeated rows are reported as often as they
    come. Texts may have any length; one long pre-token is encoded whole. An empty table gives no rows. Other columns are
    ignored. Texts are stored with their trees, so nothing is shuffled: the second pass reads what the first one wrote.
    """
    known = stored(trees(keyed(docs).withColumn("text", F.coalesce("text", F.lit(""))), ranks), "trees")
    out = recounted(known.withColumn("edits", revision(F.col("text"))), ranks)
    return out.select(
        id_of(F.col("d")).alias("doc_id"), "n_chars", "n_tokens", "edited_chars", "edited_tokens", "n_edits", "n_encoded"
    )
