"""Licences of files: sparse TF-IDF cosine of notices to templates, then inheritance from directories.

Templates are names, tags, notices and whole licence texts. A text is compared with a template in windows of the template's number
of words (the whole text if it has fewer), at every word, across lines, so a year, a holder or a comment around a notice does not
dilute it. Windows and templates are vectors of term counts times inverse document frequencies over all files; words that no
template has are hashed to places of their own. A template of up to ``NAME`` words must be there with all its words, as one other
word makes another licence; a longer one needs a cosine of ``COSINE``. Of the windows that pass, the greatest product
of squared cosine and template norm gives the file's own licence: a whole notice outweighs the name inside it, and half of a longer text
does not outweigh a whole shorter one.

A directory declares the licence of the best licence file that lies in it. Every other file inherits from the nearest directory
above it that declares one, found by joining the directories of its path with the declarations.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kontora.llm.common import CHUNK, NO_ID, Scan, id_of, stored, texts

COSINE = 0.8
NAME = 8
WHOLE = 0.999
#: Places of the words that no template has.
PLACES = 1 << 15
#: Cells of the window matrices compared at a time.
_CELLS = 1 << 19

# Licences with the names they go by, the tag's name first.
NAMES = (
    ("Apache-2.0", "Apache-2.0", "Apache License", "Apache License, Version 2.0", "Apache 2.0 License"),
    ("MIT", "MIT", "MIT License"),
    ("BSD-2-Clause", "BSD-2-Clause", "BSD 2-Clause License", "Simplified BSD License"),
    ("BSD-3-Clause", "BSD-3-Clause", "BSD 3-Clause License", "New BSD License", "BSD License"),
    ("ISC", "ISC", "ISC License"),
    ("GPL-2.0", "GPL-2.0", "GNU General Public License version 2", "GNU GPL version 2", "GPLv2"),
    ("GPL-3.0", "GPL-3.0", "GNU General Public License version 3", "GNU General Public License", "GNU GPL version 3", "GPLv3"),
    ("LGPL-2.1", "LGPL-2.1", "GNU Lesser General Public License version 2.1", "LGPLv2.1"),
    ("LGPL-3.0", "LGPL-3.0", "GNU Lesser General Public License version 3", "GNU Lesser General Public License", "LGPLv3"),
    ("AGPL-3.0", "AGPL-3.0", "GNU Affero General Public License version 3", "GNU Affero General Public License", "AGPLv3"),
    ("MPL-2.0", "MPL-2.0", "Mozilla Public License Version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License"),
    ("CC-BY-4.0", "CC-BY-4.0", "CC BY 4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-SA-4.0", "CC-BY-SA-4.0", "CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC-BY-NC-4.0", "CC-BY-NC-4.0", "CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC0-1.0", "CC0-1.0", "CC0 1.0 Universal"),
    ("Unlicense", "Unlicense", "The Unlicense"),
)
# Notices and texts as their licences word them.
_GPL = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the {1} as published by the Free Software Foundation, "
    "either version {2} of the License, or (at your option) any later version."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission."
)
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
     "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", _MIT_GRANT),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD-2-Clause", _BSD_GRANT),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", f"{_BSD_GRANT} {_BSD_NAMES}"),
    ("BSD-3-Clause", _BSD_NAMES),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
     "copyright notice and this permission notice appear in all copies."),
    ("GPL-2.0", _GPL.format("program", "GNU General Public License", "2")),
    ("GPL-3.0", _GPL.format("program", "GNU General Public License", "3")),
    ("LGPL-2.1", _GPL.format("library", "GNU Lesser General Public License", "2.1")),
    ("LGPL-3.0", _GPL.format("program", "GNU Lesser General Public License", "3")),
    ("AGPL-3.0", _GPL.format("program", "GNU Affero General Public License", "3")),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
     "You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved"),
)
TEMPLATES = tuple((k, n) for k, tag, *names in NAMES for n in (f"SPDX-License-Identifier: {tag}", *names)) + NOTICES
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|copyright|notice)[^/]*$"
_CHARS = np.zeros(256, bool)
_CHARS[48:58] = _CHARS[65:91] = _CHARS[97:123] = _CHARS[128:] = True
_TERM = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def terms(text: str) -> list[str]:
    return _TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


class Places:
    """The place of every word: one of its own for a word of a template, a hashed one for others."""

    def __init__(self, templates: Sequence[tuple[str, str]]):
        self.words = [terms(t) for _, t in templates]
        self.vocabulary = sorted({w for ws in self.words for w in ws})
        scan = Scan([w.encode() for w in self.vocabulary], ~_CHARS)
        hashes = scan.words()
        self._order = np.argsort(hashes)
        self._hashes = hashes[self._order]
        self.longest = max(map(len, self.words))
        self.size = len(self.vocabulary) + PLACES

    def of(self, words: np.ndarray) -> np.ndarray:
        """Places of word hashes."""
        at = np.minimum(np.searchsorted(self._hashes, words), len(self._hashes) - 1)
        other = len(self.vocabulary) + (words % np.uint64(PLACES)).astype(np.int64)
        return np.where(self._hashes[at] == words, self._order[at], other)

    def scans(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
        """``(row of the batch per text, text and place per word, whole)`` for runs of texts, so that about ``CHUNK`` bytes are held.

        A text above that comes in pieces cut between words, each starting with the last words of the one before, as many as the
        longest template has but one: no window is lost. ``whole`` is false for pieces. A single word is never cut.
        """
        for start, blobs in texts(batch, "text"):
            short = [k for k, blob in enumerate(blobs) if len(blob) <= CHUNK]
            if short:
                scan = Scan([blobs[k] for k in short], ~_CHARS)
                yield start + np.array(short), scan.doc, self.of(scan.words()), True
            for k in set(range(len(blobs))) - set(short):
                blob, low, size = blobs[k], 0, CHUNK
                while True:
                    gap = _GAP.search(blob, min(len(blob), low + size))
                    high = gap.start() if gap else len(blob)
                    scan = Scan([blob[low:high]], ~_CHARS)
                    if len(scan.start) < 2 * self.longest and high < len(blob):
                        size *= 2
                        continue
                    yield np.array([start + k]), scan.doc, self.of(scan.words()), low == 0 and high == len(blob)
                    if high == len(blob):
                        break
                    low, size = low + int(scan.start[len(scan.start) - self.longest + 1]), CHUNK


def _counter(templates: Sequence[tuple[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(templates)
        df, n = np.zeros(places.size + 1, np.int64), 0
        for batch in batches:
            n, last, seen = n + batch.num_rows, -1, None
            for rows, doc, place, whole in places.scans(batch):
                if whole:
                    df[:-1] += np.bincount(np.unique(doc * places.size + place) % places.size, minlength=places.size)
                    continue
                if rows[0] != last:  # pieces of a text count its words once
                    last, seen = rows[0], np.zeros(places.size, bool)
                new = np.unique(place)
                df[new[~seen[new]]] += 1
                seen[new] = True
        df[-1] = n
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["place", "n"])

    return run


def frequencies(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> np.ndarray:
    """Inverse document frequency of every place over all files.

    ``files(text)`` with binary texts. A task adds up its files; a row per place, of a fixed number, reaches the driver.
    """
    size = Places(templates).size
    counts = files.select("text").mapInArrow(_counter(templates), "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    df = np.zeros(size + 1)
    for r in counts.collect():
        df[r.place] = r.n
    return np.log((1 + df[-1]) / (1 + df[:-1])) + 1


def _matcher(idf: np.ndarray, templates: Sequence[tuple[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(templates)
        goals = []
        for words in places.words:
            count = np.bincount([places.vocabulary.index(w) for w in words], minlength=len(places.vocabulary))
            weight = count * idf[: len(count)]
            goals.append((len(words), weight / np.linalg.norm(weight), np.linalg.norm(weight), WHOLE if len(words) <= NAME else COSINE))
        for batch in batches:
            best, cosine, name = np.zeros(batch.num_rows), np.zeros(batch.num_rows), np.full(batch.num_rows, -1)
            for rows, doc, place, whole in places.scans(batch):
                for row, mass, cos, k in _found(goals, idf, rows, doc, place, whole, len(places.vocabulary)):
                    if mass > best[row] or (mass == best[row] and k < name[row]):
                        best[row], cosine[row], name[row] = mass, cos, k
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("mark"), batch.column("licence_file"), pa.array([templates[k][0] if k >= 0 else None for k in name], pa.string()), pa.array(cosine), pa.array(best)],
                names=["path", "mark", "licence_file", "own", "cosine", "mass"],
            )

    return run


def _found(goals, idf, rows, doc, place, whole, n_own) -> Iterator[tuple[int, float, float, int]]:
    """``(row, mass, cosine, template)``: every template's best window in every text that has one above its threshold."""
    n = len(place)
    if not n:
        return
    own = place < n_own
    weight = idf[place]
    squares = np.concatenate([np.zeros(1), np.cumsum(weight * weight)])
    ends = np.searchsorted(doc, doc, "right")
    first = np.searchsorted(doc, doc, "left") == np.arange(n)
    at = np.where(own, place, 0)
    for k, (length, goal, norm, least) in enumerate(goals):
        gain = np.where(own, weight * goal[at], 0.0)
        dots = np.concatenate([np.zeros(1), np.cumsum(gain)])
        full = np.arange(n) + length <= ends
        stop = np.where(full, np.arange(n) + length, ends)
        # a window's norm is at least that of its words taken once each, so this bounds the cosine from above
        bound = (dots[stop] - dots[:-1]) >= (least - 1e-6) * np.sqrt(squares[stop] - squares[:-1])
        some = np.flatnonzero(bound & (full | (first & whole)))
        step = max(1, _CELLS // length)
        for low in range(0, len(some), step):
            start = some[low : low + step]
            cell = start[:, None] + np.arange(length)
            inside = cell < stop[start][:, None]
            cell = np.minimum(cell, n - 1)
            dot = np.where(inside, gain[cell], 0.0).sum(axis=1)
            # sorted, equal places stand together; the r-th of them adds 2 r - 1 squares
            what = np.sort(np.where(inside, place[cell], -1), axis=1)
            run = np.arange(length) - np.maximum.accumulate(np.where(np.diff(what, axis=1, prepend=-2) != 0, np.arange(length), 0), axis=1)
            size = np.sqrt((np.where(what >= 0, idf[what] ** 2, 0.0) * (2 * run + 1)).sum(axis=1))
            cos = np.round(dot / size, 9)
            for j in np.flatnonzero(cos >= least).tolist():
                yield int(rows[doc[start[j]]]), round(float(cos[j]) ** 2 * norm, 6), float(cos[j]), k


def licences(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``path, mark, own, cosine, licence, inherited_from`` per row of ``files(path, mark, text)``; ``mark`` is any long the caller wants back.

    ``own`` is the licence the file states, with its cosine; ``licence`` is that or the inherited one, ``inherited_from`` the
    directory it came from. ``templates`` are (licence, text) pairs; whole texts of other licences can be added. Of windows that hold
    equally much the earlier template wins, of equal licence files the least path. A null or empty text states nothing; a long text is
    read in pieces; a null path has no directories; repeated rows give equal rows; an empty table gives none. Other columns are ignored.
    """
    rows = files.select(F.col("path").cast("string").alias("path"), F.col("mark").cast("long").alias("mark"), F.col("text").cast("binary").alias("text"))
    rows = rows.withColumn("licence_file", F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False)))
    idf = frequencies(rows, templates)
    found = stored(rows.mapInArrow(_matcher(idf, templates), "path string, mark long, licence_file boolean, own string, cosine double, mass double"), "licences")
    home = F.regexp_replace("path", "/?[^/]*$", "")
    declared = found.filter("licence_file and own is not null").groupBy(home.alias("dir")).agg(
        F.min(F.struct((-F.col("mass")).alias("rank"), "path", "own")).getField("own").alias("given")
    )
    steps = F.split(home, "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.when(k == 0, F.lit("")).otherwise(F.array_join(F.slice(steps, 1, k), "/")))
    need = found.filter("own is null and path is not null").select("path").distinct()
    up = need.select("path", F.explode(F.array_distinct(above)).alias("dir")).join(stored(declared, "declared"), "dir")
    nearest = up.groupBy("path").agg(F.max_by(F.struct("dir", "given"), F.length("dir")).alias("from"))
    return found.join(stored(nearest, "nearest"), "path", "left").select(
        "path", "mark", "own", F.when(F.col("own").isNotNull(), F.col("cosine")).alias("cosine"),
        F.coalesce("own", "from.given").alias("licence"), F.when(F.col("own").isNull(), F.col("from.dir")).alias("inherited_from"),
    )


def shelved(docs: DataFrame) -> DataFrame:
    """Documents as files: source/language/shelf/id.txt, a shelf holding 64 ids; ids that 10 divides are licence files of their
    language's directory, those that 100 divides of their source's."""
    i = F.col("doc_id").cast("long")
    source, lang = (F.coalesce(F.regexp_replace(F.col(c).cast("string"), "/", "_"), F.lit("unknown")) for c in ("source", "lang"))
    name = F.concat(F.lit("LICENSE-"), i.cast("string"))
    path = (
        F.when(i % 100 == 0, F.concat_ws("/", source, name)).when(i % 10 == 0, F.concat_ws("/", source, lang, name))
        .otherwise(F.concat_ws("/", source, lang, F.floor(i / 64).cast("string"), F.concat(F.coalesce(i.cast("string"), F.lit("none")), F.lit(".txt"))))
    )
    return docs.select(path.alias("path"), F.coalesce(i, F.lit(NO_ID)).alias("mark"), F.col("text").cast("string").alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, path, own_licence, cosine, licence, inherited_from`` per row of ``docs``, shelved as files."""
    out = licences(shelved(docs))
    return out.select(
        id_of(F.col("mark")).alias("doc_id"), "path", F.col("own").alias("own_licence"), F.round("cosine", 6).alias("cosine"), "licence", "inherited_from"
    )
