"""SentencePiece encoding with seeded merge dropout, and lossless decoding.

Merges run by an agenda: of all adjacent pairs that form a piece, the best-scored one is taken, leftmost first. Every candidate
taken is skipped for good with the dropout rate. The draws of an occurrence come from the seed, its document, the document's
copy and its place in the text, as the numbers of steps between skips, so each occurrence has draws of its own and runs are
repeatable. What a word becomes depends on its skipped steps alone, so a worker remembers segmentations by word and skips: that
saves time and leaves out none. Characters without a piece become byte pieces.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, compress, repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kontora.llm.common import id_of, keyed, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 20240817
#: Segmentations with up to so many skips are remembered; those with more are made anew each time.
VARIANTS = 2
#: Skips that are drawn for an occurrence at first; more are drawn where they fall within the steps it takes.
PLANNED = VARIANTS + 4
#: Segmentations that a worker remembers before it starts anew.
MEMORY = 1_200_000
#: Longest stretch, in characters, that is segmented along with others.
WIDE = 40
MARK = "▁"
_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_FULL = (1 << 64) - 1
_NEVER = 1 << 40
#: What a pair that forms no piece costs.
_APART = (1 << 31) - 1
#: Stretches that are segmented at a time, so that their tables stay in a core's cache.
AT_ONCE = 4096


def vocabulary(path: str = MODEL) -> tuple[dict[str, int], list[float], list[int]]:
    """Pieces that merges may form with their ids, the scores by id, and the ids of the 256 bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = {model.id_to_piece(i): i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
    return plain, [model.get_score(i) for i in range(size)], [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


def _spots(keys: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """A 64-bit key per stretch of texts with the given keys and numbers of stretches."""
    with np.errstate(over="ignore"):
        text = mix(np.array([k & _FULL for k in keys], np.uint64) + mix(np.full(1, seed & _FULL, np.uint64)))
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = (np.arange(len(first)) - first + 1).astype(np.uint64)
        return mix(np.repeat(text, sizes) + place * np.uint64(0x9E3779B97F4A7C15))


def _plan(spots: np.ndarray, skips: int, dropout: float) -> np.ndarray:
    """Per key the steps at which the first ``skips`` skips fall: each step is one with the dropout rate."""
    with np.errstate(over="ignore", divide="ignore"):
        draws = mix(spots[:, None] + np.arange(1, skips + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        gaps = np.log(((draws >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / np.log1p(-dropout)
    return np.cumsum(np.minimum(gaps, _NEVER).astype(np.int64) + 1, axis=1) - 1


def _marks(steps: np.ndarray) -> str:
    """A character for each step; a step that no short stretch comes to is like any other."""
    return np.minimum(steps, 4 * WIDE).astype("<u4").tobytes().decode("utf-32-le")


class Encoder:
    """Segments stretches; those of up to ``WIDE`` characters many at a time, one step of every agenda per round."""

    def __init__(self, vocab, dropout: float = DROPOUT, seed: int = SEED):
        self.ids, scores, self.bytes = vocab
        self.rank = {p: -scores[i] for p, i in self.ids.items()}
        self.dropout, self.seed = dropout, seed
        # the empty stretch stands for a mark in the text itself
        self.marks = np.array([self.bytes[b] for b in MARK.encode()], "<i4").tobytes()
        # by number of skips: stretch and skipped steps (as characters) to a place in ``made`` (packed ids) and ``steps``
        self.memory: list[dict[str, int]] = [{} for _ in range(VARIANTS + 1 if dropout else 1)]
        self._forget()
        pieces = {i: p.replace(MARK, " ").encode() for p, i in self.ids.items()} | {i: bytes([b]) for b, i in enumerate(self.bytes)}
        self.piece_bytes = [pieces.get(i, b"") for i in range(len(scores))]
        self.none = len(scores)  # what characters without a piece and the ends of a stretch count as: nothing joins it
        self.of_point = np.full(0x110000, self.none, np.int32)
        self.of_point[:128] = self.bytes[:128]  # one byte each, unless there is a piece
        joins = {}
        for p, i in self.ids.items():
            if len(p) == 1:
                self.of_point[ord(p)] = i
            for k in range(1, len(p)):
                if p[:k] in self.ids and p[k:] in self.ids:
                    joins[self.ids[p[:k]] << 32 | self.ids[p[k:]]] = i
        cost = np.unique([-scores[i] for i in joins.values()], return_inverse=True)[1]
        self._hash(np.fromiter(joins, np.int64, len(joins)), cost.astype(np.int64) << 20 | np.fromiter(joins.values(), np.int64, len(joins)))

    def _forget(self) -> None:
        for m in self.memory:
            m.clear()
        self.memory[0][""] = 0
        self.made, self.steps = [self.marks], array("q", [0])

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        """A table of the joins by linear probing: the key of a slot, or -1, and its value."""
        self.shift = np.uint64(64 - max(4, int(4 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.slots, self.values = np.full(size, -1, np.int64), np.full(size, _APART << 20, np.int64)
        at = self._slot(keys)
        while len(keys):
            free = self.slots[at] < 0
            self.slots[at[free]] = keys[free]
            left = self.slots[at] != keys
            self.values[at[~left]] = values[~left]
            keys, values, at = keys[left], values[left], (at[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The join that two symbols make: the order of its score and its piece, in 20 bits; or ``_APART`` and none."""
        keys = a.ravel() << 32 | b.ravel()
        at = self._slot(keys)
        got = self.slots.take(at)
        out = np.where(got == keys, self.values.take(at), _APART << 20)
        rest = np.flatnonzero((got != keys) & (got >= 0))
        keys, at = keys[rest], at[rest]
        while len(rest):
            at = (at + 1) & (len(self.slots) - 1)
            got = self.slots.take(at)
            hit, more = got == keys, (got != keys) & (got >= 0)
            out[rest[hit]] = self.values.take(at[hit])
            rest, keys, at = rest[more], keys[more], at[more]
        return out.reshape(a.shape)

    def _skips(self, spots: np.ndarray, length: int) -> np.ndarray:
        """All skips that stretches of ``length`` characters may come to: a pair and each merge's two new ones are a step at most."""
        return _plan(spots, 3 * length, self.dropout) if self.dropout else np.full((len(spots), 1), _NEVER)

    def segment(self, word: str, key: int = 0) -> tuple[int, ...]:
        """Piece ids of one stretch that no merge crosses, with the draws of ``key``."""
        parts = list(word)
        rank, at = self.rank, list(range(len(parts)))
        skips = iter(self._skips(np.array([key & _FULL], np.uint64), len(parts))[0].tolist())
        step, skip = 0, next(skips, _NEVER)
        agenda = [(rank[p], i, i + 1, i + 2) for i, p in enumerate(map("".join, zip(parts, parts[1:]))) if p in rank]
        heapify(agenda)
        before, after = [i - 1 for i in at], [i + 1 for i in at]
        n = len(parts)
        while agenda:
            _, start, middle, end = heappop(agenda)
            if parts[start] is None or after[start] != middle or parts[middle] is None or after[middle] != end:
                continue
            step += 1
            if step > skip:
                skip = next(skips, _NEVER)
                continue
            parts[start] += parts[middle]
            parts[middle] = None
            after[start] = end
            if end < n:
                before[end] = start
                if (cost := rank.get(parts[start] + parts[end])) is not None:
                    heappush(agenda, (cost, start, end, after[end]))
            if (left := before[start]) >= 0 and (cost := rank.get(parts[left] + parts[start])) is not None:
                heappush(agenda, (cost, left, start, end))
        out: list[int] = []
        for p in parts:
            if p is not None:
                i = self.ids.get(p)
                out.extend([i] if i is not None else [self.bytes[b] for b in p.encode()])
        return tuple(out)

    def segment_all(self, words: list[str], keys: list[int]) -> list[bytes]:
        """``segment`` of many stretches of about the same length, packed as little-endian 32-bit integers."""
        return self._planned(words, self._skips(np.array([k & _FULL for k in keys], np.uint64), max(map(len, words))))[0]

    def _planned(self, words: list[str], skips: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Packed ids of stretches that skip the given steps (in order, per row), how many steps each took and how many it skipped."""
        n, sizes = len(words), np.fromiter(map(len, words), np.int64, len(words))
        wide = int(sizes.max())
        inside = np.arange(wide)[None, :] < sizes[:, None]
        points = np.zeros((n, wide), np.uint32)
        points[inside] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        # a column per stretch and a row per character, with a row of no symbol before and behind
        symbols = np.full((wide + 2, n), self.none, np.int64)
        symbols[1:-1] = np.where(inside, self.of_point[points], self.none).T
        found = self._pairs(symbols[:-1], symbols[1:])
        # the order of a pair's score and its row, so that the least is the leftmost of the best
        bits, rows = (wide + 1).bit_length(), np.arange(wide + 2)[:, None]
        costs = np.minimum(found >> 20 << bits | rows[:-1], _APART).astype(np.int32)
        joined, alive = (found & 0xFFFFF).ravel(), np.ones((wide + 2, n), bool)
        where = rows * n + np.arange(n)
        after, before, place = (where + n).ravel(), (where - n).ravel(), np.repeat(rows, n)
        symbol, cost, live = symbols.ravel(), costs.ravel(), alive.ravel()
        last = skips.shape[1]
        skips = np.concatenate([skips, np.full((n, 1), _NEVER)], axis=1).ravel()
        turn, step = np.arange(n) * (last + 1), np.zeros(n, np.int64)
        next_skip = skips[turn]
        while True:
            best = costs.min(axis=0)
            column = np.flatnonzero(best < _APART)
            if not len(column):
                break
            best = best[column]
            start = (best & (1 << bits) - 1).astype(np.int64) * n + column
            cost[start] = _APART
            now = step[column]
            step[column] = now + 1
            skip = next_skip[column] == now
            if skip.any():
                on = column[skip]
                turn[on] += 1
                next_skip[on] = skips[turn[on]]
                start = start[~skip]
            middle = after.take(start)
            end = after.take(middle)
            left = before.take(start)
            piece = joined.take(start)
            symbol[start] = piece
            after[start] = end
            before[end] = start
            live[middle] = False
            cost[middle] = _APART
            firsts = np.concatenate([start, left])
            found = self._pairs(np.concatenate([piece, symbol.take(left)]), np.concatenate([symbol.take(end), piece]))
            joined[firsts] = found & 0xFFFFF
            cost[firsts] = np.minimum(found >> 20 << bits | place.take(firsts), _APART)
        turn -= np.arange(n) * (last + 1)
        keep = alive[1:-1].T & inside
        got = symbols[1:-1].T
        cuts = [0, *np.cumsum(keep.sum(axis=1)).tolist()]
        flat = got[keep].astype("<i4").tobytes()
        out = [flat[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])]
        for k in np.flatnonzero((keep & (got == self.none)).any(axis=1)).tolist():
            ids = chain.from_iterable(
                [i] if i != self.none else [self.bytes[b] for b in chr(p).encode()] for i, p in zip(got[k, keep[k]].tolist(), points[k, keep[k]].tolist())
            )
            out[k] = np.array(list(ids), "<i4").tobytes()
        return out, step, turn

    def _learn(self, words: list[str], plan: np.ndarray, most: int = VARIANTS) -> np.ndarray:
        """Places in ``made`` of short stretches, those of about the same length segmented together. Those that took ``most`` skips or
        fewer are remembered by them."""
        places, group = np.zeros(len(words), np.int64), np.fromiter(map(len, words), np.int64, len(words)) // 4
        for g in np.unique(group).tolist():
            same = np.flatnonzero(group == g)
            for part in (same[k : k + AT_ONCE] for k in range(0, len(same), AT_ONCE)):
                some, first = [words[k] for k in part], len(self.made)
                made, steps, used = self._planned(some, plan[part])
                self.made += made
                self.steps.frombytes(steps.tobytes())
                places[part] = np.arange(first, len(self.made))
                names = some
                for n, known in enumerate(self.memory[: min(most, plan.shape[1]) + 1]):
                    names = list(map(add, names, _marks(plan[part, n - 1]))) if n else names
                    on = (used == n).tolist()
                    known.update(zip(compress(names, on), compress(range(first, len(self.made)), on)))
        return places

    def _drawn(self, words: list[str], spots: np.ndarray, plan: np.ndarray, most: int = VARIANTS) -> np.ndarray:
        """``_learn`` of occurrences, whose draws go on where a plan ends."""
        places = self._learn(words, plan, most)
        for n in np.flatnonzero(plan[:, -1] < np.frombuffer(self.steps, np.int64)[places]).tolist():  # more skips than planned
            places[n] = len(self.made)
            self.made.append(np.array(self.segment(words[n], int(spots[n])), "<i4").tobytes())
            self.steps.append(0)
        return places

    def _segmented(self, words: list[str], spots: np.ndarray) -> list[bytes]:
        """Packed ids of every stretch: looked up by its skips as long as these fall within the steps it takes."""
        long = np.flatnonzero(np.fromiter(map(len, words), np.int64, len(words)) > WIDE).tolist()
        short = words
        if long:
            short = list(words)
            for k in long:
                short[k] = ""
        known = self.memory[0]
        at = np.fromiter(map(known.get, short, repeat(-1)), np.int64, len(short))
        skipping = _plan(spots, 1, self.dropout)[:, 0] if self.dropout else np.full(len(short), _NEVER)
        new = np.flatnonzero(at < 0)
        if len(new):
            names = list(map(short.__getitem__, new.tolist()))
            times = Counter(names)
            # an unknown word that is here once is segmented with its skips alone, and remembered without skips: many never come again
            once = (np.fromiter(map(times.__getitem__, names), np.int64, len(names)) == 1) & bool(self.dropout)
            if once.any():
                alone, here = list(compress(names, once.tolist())), new[once]
                at[here] = self._drawn(alone, spots[here], _plan(spots[here], PLANNED, self.dropout), 0)
                skipping[here] = _NEVER
                new, names = new[~once], list(compress(names, (~once).tolist()))
            if names:
                plain = list(dict.fromkeys(names))
                self._learn(plain, np.zeros((len(plain), 0), np.int64))
                at[new] = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        skipping = np.flatnonzero(skipping < np.frombuffer(self.steps, np.int64)[at])
        if len(skipping):
            some, spots_ = list(map(short.__getitem__, skipping.tolist())), spots[skipping]
            plan = _plan(spots_, PLANNED, self.dropout)
            names, open_, found = some, np.arange(len(some)), np.full(len(some), -1)
            for skips, known in enumerate(self.memory[1:], 1):
                names = list(map(add, names, _marks(plan[open_, skips - 1])))
                place = np.fromiter(map(known.get, names, repeat(-1)), np.int64, len(names))
                hit = (place >= 0) & (np.frombuffer(self.steps, np.int64)[place] <= plan[open_, skips])
                found[open_[hit]] = place[hit]
                names, open_ = list(compress(names, (~hit).tolist())), open_[~hit]
            if len(open_):
                found[open_] = self._drawn(list(map(some.__getitem__, open_.tolist())), spots_[open_], plan[open_])
            at[skipping] = found
        got = list(map(self.made.__getitem__, at.tolist()))
        for k in long:
            got[k] = np.array(self.segment(words[k], int(spots[k])), "<i4").tobytes()
        return got

    def encode_all(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Piece ids of every text. A mark that stands in a text itself becomes bytes, as a piece would read as a space."""
        if len(self.made) > MEMORY:
            self._forget()
        words, sizes = [], []
        for text in texts:
            before = len(words)
            for k, part in enumerate(text.split(MARK) if text else ()):
                words += [""] * (k > 0) + _SEGMENT.findall((MARK if not k else "") + part.replace(" ", MARK))
            sizes.append(len(words) - before)
        got = self._segmented(words, _spots(keys, sizes, self.seed))
        cuts = np.cumsum([0, *sizes]).tolist()
        return [np.frombuffer(b"".join(got[a:b]), "<i4") for a, b in zip(cuts, cuts[1:])]

    def encode(self, text: str, key: int = 0) -> list[int]:
        return self.encode_all([text], [key])[0].tolist()

    def decode(self, ids: list[int] | np.ndarray) -> str:
        known = self.piece_bytes
        return b"".join([known[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)]).decode("utf-8", "replace")[1:]


def encoded(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED, pieces: bool = True, copies: bool = False) -> DataFrame:
    """``doc_id, n_chars, n_pieces, pieces_sha256, lossless`` and, if asked for, ``pieces`` (array of ids), per row of ``docs``.

    The digest is of the ids as little-endian 32-bit integers; ``lossless`` says whether decoding gave the text back. A null or
    empty text has no pieces. Rows that repeat id and text get equal pieces, equal texts under other ids others; with ``copies``
    such rows are numbered and each gets pieces of its own, as the epochs of a mix should. An empty table gives no rows. Other
    columns are ignored. Any length works; only segmentations of short stretches are remembered.
    """
    # about 32,000 pieces, read where the model lies and sent once to each executor
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(shipped.value, dropout, seed)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                bodies = [t or "" for t in part.column("text").to_pylist()]
                rows = [
                    (len(t), ids, coder.decode(ids) == t)
                    for t, ids in zip(bodies, coder.encode_all(bodies, part.column("k").to_pylist()))
                ]
                columns = [
                    part.column("d"), pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(r[1].tobytes()).hexdigest() for r in rows]), pa.array([r[2] for r in rows]),
                ]
                if pieces:
                    ends = np.concatenate([[0], np.cumsum([len(r[1]) for r in rows])])
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([r[1] for r in rows]), pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "d long, n_chars long, n_pieces long, pieces_sha256 string, lossless boolean" + ", pieces array<int>" * pieces
    names = [c.split()[0] for c in schema.split(", ")]
    rows = keyed(docs).withColumn("k", F.col("h"))
    if copies:
        copy = F.row_number().over(Window.partitionBy("d", "h").orderBy("d"))
        rows = rows.withColumn("k", F.when(copy == 1, F.col("h")).otherwise(F.xxhash64("h", copy)))
    out = rows.mapInArrow(run, schema)
    return out.select(id_of(F.col("d")).alias("doc_id"), *names[1:])


def report(docs: DataFrame) -> DataFrame:
    """Digest columns of ``encoded``."""
    return encoded(docs, pieces=False)
