"""Quality rules, line first: bad lines go, then documents that lost too much.

A line with a word fails when it is symbols (over one of ``# * $ % & | < >`` per three words), navigation (three or more bars or
arrows standing alone, a quarter of its words), boilerplate (up to 20 words with a legal or site phrase), shouting (ten
capitals or more, and more capitals than small letters among A-Z) or ten words or more without any punctuation. A document is
kept when the base rules pass and the failed lines hold at most half of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kontora.llm.common import Scan, byte_class, id_of, keyed, mix, texts

WINDOW = 8
#: Phrases of legal notices and site furniture.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "creative commons", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "accept cookies", "click here", "sign up for", "subscribe to", "log in", "share this",
)
_PHRASE = re.compile("|".join(map(re.escape, BOILERPLATE)).encode())
_SYMBOL, _PUNCT = byte_class(b"#*$%&|<>"), byte_class(b".,;:!?")
_UPPER, _LOWER = byte_class(bytes(range(65, 91))), byte_class(bytes(range(97, 123)))
_BARS = (b"|", b">", b"\xc2\xbb", b"\xc2\xb7")


def _repeated(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows share (group, key) with another row, and which with an earlier one."""
    order = np.lexsort((np.arange(len(key)), key, group))
    g, k = group[order], key[order]
    same = (g[1:] == g[:-1]) & (k[1:] == k[:-1])
    later = np.zeros(len(key), bool)
    later[order[1:][same]] = True
    any_ = later.copy()
    any_[order[:-1][same]] = True
    return any_, later


def measured(blobs: list[bytes]) -> dict[str, np.ndarray]:
    """The base counts and line verdicts of several texts."""
    scan = Scan(blobs, lower=False)
    data, n = scan.data, len(blobs)
    starts = scan.offsets[:-1]
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, scan.start, 1)
    np.add.at(inside, scan.end, -1)
    points = (np.cumsum(inside[:-1]) > 0) & ((data & 0xC0) != 0x80)

    def per_doc(mask):
        return np.add.reduceat(mask.astype(np.int64), starts)

    n_words = scan.per_doc()
    words = scan.words()

    # lines: a text ends where the next begins
    breaks = np.flatnonzero(data == 10)
    first = np.sort(np.concatenate([starts, breaks + 1]))
    last = np.sort(np.concatenate([breaks, scan.offsets[1:] - 1]))
    doc = np.searchsorted(scan.offsets, first, "right") - 1

    def per_line(mask):
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[last] - sums[first]

    at = np.searchsorted(first, scan.start, "right") - 1
    line_words = np.bincount(at, minlength=len(first))
    full = line_words > 0
    dup = np.zeros(len(first), bool)
    dup[full] = _repeated(doc[full], scan.hash(first[full], last[full]))[1]

    covered = np.zeros(len(words) + 1, np.int64)
    if len(words) >= WINDOW:
        rolled = np.zeros(len(words) - WINDOW + 1, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(WINDOW):
                rolled = mix(rolled * np.uint64(0xD1342543DE82EF95) + words[k : len(words) - WINDOW + 1 + k])
        whole = np.flatnonzero(scan.doc[: len(rolled)] == scan.doc[WINDOW - 1 :])
        twice = whole[_repeated(scan.doc[whole], rolled[whole])[0]]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + WINDOW, -1)
    repeat = np.bincount(scan.doc, np.cumsum(covered[:-1]) > 0, n).astype(np.int64)

    size = scan.end - scan.start
    bar = np.zeros(len(words), bool)
    for b in _BARS:
        hit = np.flatnonzero(size == len(b))
        for k, byte in enumerate(b):
            hit = hit[data[scan.start[hit] + k] == byte]
        bar[hit] = True
    bars = np.bincount(at, bar, len(first)).astype(np.int64)
    symbols, upper = per_line(_SYMBOL[data]), per_line(_UPPER[data])
    bad = (3 * symbols > line_words) | ((bars >= 3) & (4 * bars >= line_words)) | ((upper >= 10) & (upper > per_line(_LOWER[data])))
    bad |= (line_words >= 10) & (per_line(_PUNCT[data]) == 0)
    raw = data.tobytes()
    for k in np.flatnonzero(full & ~bad & (line_words <= 20)).tolist():
        bad[k] = _PHRASE.search(raw[first[k] : last[k]].lower()) is not None
    bad &= full
    lost = np.bincount(doc, np.where(bad, line_words, 0), n).astype(np.int64)
    failed = (n_words < 20) | (100 * repeat > 30 * n_words)
    return {
        "n_words": n_words, "word_chars": per_doc(points), "n_symbols": per_doc(_SYMBOL[data]), "n_dup_lines": np.bincount(doc, dup, n).astype(np.int64),
        "n_repeat_words": repeat, "base_failed": failed, "n_bad_lines": np.bincount(doc, bad, n).astype(np.int64), "n_bad_words": lost,
        "kept": ~failed & (2 * lost <= n_words), "_lines": (first, last, doc, bad, raw),
    }


_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bad_lines", "n_bad_words")
_FLAGS = ("base_failed", "kept")


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, blobs in texts(batch, "text"):
            found = measured(blobs)
            first, last, doc, bad, raw = found["_lines"]
            left: list[list[bytes]] = [[] for _ in blobs]
            touched = np.isin(doc, np.unique(doc[bad]))
            for k in np.flatnonzero(touched & ~bad).tolist():
                left[doc[k]].append(raw[first[k] : last[k]])
            changed = np.bincount(doc, bad, len(blobs)) > 0
            clean = [b"\n".join(left[i]) if changed[i] else blobs[i] for i in range(len(blobs))]
            part = batch.slice(start, len(blobs))
            yield pa.RecordBatch.from_arrays(
                [part.column("d"), part.column("h"), *[pa.array(found[c].astype(np.int64)) for c in _LONGS], *[pa.array(found[c]) for c in _FLAGS], pa.array(clean, pa.binary()).cast(pa.string())],
                names=["d", "h", *_LONGS, *_FLAGS, "clean"],
            )


def cleaned(docs: DataFrame) -> DataFrame:
    """``d, h``, all counts and verdicts, and ``clean``, the text without its failed lines, per row of ``docs``.

    A null or empty text has no words, fails the base rules and cleans to an empty text. Repeated rows give equal rows. An empty
    table gives no rows. Other columns are ignored.
    """
    schema = "d long, h long, " + ", ".join(f"{c} long" for c in _LONGS) + ", " + ", ".join(f"{c} boolean" for c in _FLAGS) + ", clean string"
    return keyed(docs).withColumn("text", F.col("text").cast("binary")).mapInArrow(_run, schema)


def report(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept``, and what the line rules removed."""
    return cleaned(docs).select(
        id_of(F.col("d")).alias("doc_id"), *_LONGS[:5], "base_failed", "kept", "n_bad_lines", "n_bad_words"
    )


_W = r"[^\x20\x09-\x0D]+"
SQL = f"""
WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM documents),
m AS (SELECT doc_id, i, line, regexp_extract_all(line, '{_W}') AS w, len(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS sy,
             len(regexp_replace(line, '[^A-Z]', '', 'g')) AS up, len(regexp_replace(line, '[^a-z]', '', 'g')) AS lo FROM l),
v AS (SELECT *, len(w) AS n, len(list_filter(w, lambda x: x IN ('|', '>', '»', '·'))) AS bars,
             row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS dup FROM m WHERE len(w) > 0),
b AS (SELECT *, 3 * sy > n OR (bars >= 3 AND 4 * bars >= n) OR (up >= 10 AND up > lo) OR (n >= 10 AND NOT regexp_matches(line, '[.,;:!?]'))
             OR (n <= 20 AND regexp_matches(line, '(?i){"|".join(BOILERPLATE)}')) AS bad FROM v),
lines AS (SELECT doc_id, count(*) FILTER (WHERE dup) AS n_dup_lines, count(*) FILTER (WHERE bad) AS n_bad_lines, coalesce(sum(n) FILTER (WHERE bad), 0)::BIGINT AS n_bad_words FROM b GROUP BY doc_id),
w AS (SELECT doc_id, text, coalesce(regexp_extract_all(text, '{_W}'), []) AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS p, w FROM w WHERE len(w) >= 8),
g8 AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, list_slice(w, p, p + 7)) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM g8, (SELECT unnest(range(8)) AS k) WHERE c > 1 GROUP BY doc_id),
t AS (SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             coalesce(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0)::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(n_bad_lines, 0) AS n_bad_lines, coalesce(n_bad_words, 0) AS n_bad_words
      FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 2 * n_bad_words <= n_words AS kept FROM t
"""
