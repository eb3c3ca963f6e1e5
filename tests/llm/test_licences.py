"""Licence notices: a dictionary version over every window, notices with names and years, long texts."""

import math
from collections import Counter

import numpy as np
import pytest

from kontora.llm import licences as lic
from kontora.llm.common import CHUNK, Scan, documents

FOLDER = "/root/testdata/sf0.001"


def brute(rows):
    """(licence, cosine) of every text: every window against every template, with dictionaries."""
    own = {w for _, t in lic.TEMPLATES for w in lic.terms(t)}
    split = [lic.terms(t or "") for t in rows]

    def place(w):
        return w if w in own else int(Scan([w.encode()], ~lic._CHARS).words()[0] % np.uint64(lic.PLACES))

    known = {w: place(w) for ws in split for w in ws} | {w: w for w in own}
    split = [[known[w] for w in ws] for ws in split]
    df = Counter(p for ws in split for p in set(ws))
    idf = lambda p: math.log((1 + len(rows)) / (1 + df[p])) + 1
    goals = [(name, Counter(lic.terms(t)), len(lic.terms(t))) for name, t in lic.TEMPLATES]
    out = []
    for ws in split:
        best = (0.0, 0.0, None)
        for name, goal, length in goals:
            g = {w: c * idf(w) for w, c in goal.items()}
            norm = math.hypot(*g.values())
            least = lic.WHOLE if length <= lic.NAME else lic.COSINE
            for i in range(max(1, len(ws) - length + 1)):
                part = ws[i : i + length]
                if not any(w in g for w in part):
                    continue
                v = {w: c * idf(w) for w, c in Counter(part).items()}
                cos = sum(x * g.get(w, 0) for w, x in v.items()) / math.hypot(*v.values()) / norm
                if cos >= least - 1e-10 and cos * cos * norm > best[0] + 1e-5:
                    best = (cos * cos * norm, cos, name)
        out.append(best[1:][::-1])
    return out


def own(spark, texts, filler=()):
    rows = [(f"f{i}", i, t) for i, t in enumerate([*texts, *filler])]
    got = {r.mark: r for r in lic.licences(spark.createDataFrame(rows, "path string, mark long, text string")).collect()}
    assert len(got) == len(rows)
    return [got[i] for i in range(len(texts))]


@pytest.fixture(scope="module")
def prose(spark):
    return [r.text for r in documents(spark, FOLDER).select("text").collect()][:60]


def test_equal_to_dictionaries(spark, prose):
    texts = [t for t in prose if t and len(t) < 4000][:40] + ["x all rights x reserved all rights all rights reserved y", lic._MIT_GRANT.replace("Software", "Work"), "", None, "license"]
    got = own(spark, texts)
    want = brute(texts)
    for g, (name, cos) in zip(got, want):
        assert g.own == name
        assert name is None or g.cosine == pytest.approx(cos, abs=1e-6)
    assert sum(r.own is not None for r in got) > 3


NOTICES = [
    ("Copyright 2024 Example Corp. All rights reserved.", "Proprietary"),
    ("// SPDX-License-Identifier: MIT", "MIT"),
    ("# SPDX-License-Identifier: BSD-3-Clause\n# Copyright (c) 2019 The Authors", "BSD-3-Clause"),
    ("This project is released under the MIT License by Jane Doe.", "MIT"),
    ("Apache License", "Apache-2.0"),
    ("Copyright 2021 Jane Doe\n\n" + lic.NOTICES[0][1], "Apache-2.0"),
    ("BSD 3-Clause License\n\nCopyright (c) 2020, Jane Doe\nAll rights reserved.\n\n" + lic._BSD_GRANT + "\n\n" + lic._BSD_NAMES.replace("the copyright holder", "Jane Doe"), "BSD-3-Clause"),
    ("Copyright (c) 2020, Jane Doe\nAll rights reserved.\n\n" + lic._BSD_GRANT, "BSD-2-Clause"),
    ("Mozilla Public License Version 2.0", "MPL-2.0"),
    ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "LGPL-3.0"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991", "GPL-2.0"),
    ("/*\n * frob 1.2\n * Copyright (C) 2012 Jane Doe\n *\n * " + lic._GPL.format("program", "GNU Lesser General Public License", "3").replace(" modify it", "\n * modify it"), "LGPL-3.0"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
     "Foundation; either version 2 of the License, or (at your option) any later version.", "GPL-2.0"),
    ("The MIT License (MIT)\n\nCopyright (c) 2014 Jane Doe\n\n" + lic._MIT_GRANT, "MIT"),
    (lic._MIT_GRANT, "MIT"),
    ("ISC License\n\nCopyright (c) 2004-2010 by Some Consortium\n\n" + lic.NOTICES[8][1], "ISC"),
    ("Licensed under CC BY-NC 4.0, Jane Doe 2022.", "CC-BY-NC-4.0"),
    ("Licensed under CC BY 4.0, Jane Doe 2022.", "CC-BY-4.0"),
]
NONE = ["SPDX-License-Identifier: Zlib", "the public can use all its rights", "a licence to drive", "We reserved a table; all rights and wrongs aside.", "version 2 of the software is free", "my driving license, version 3"]


def test_notices_with_names_and_years(spark, prose):
    got = own(spark, [t for t, _ in NOTICES], prose)
    assert [r.own for r in got] == [name for _, name in NOTICES]
    # the same notices between paragraphs of prose
    inside = own(spark, [f"{prose[k % 60]}\n\n{t}\n\n{prose[(k + 7) % 60]}" for k, (t, _) in enumerate(NOTICES[:6])], prose)
    assert sum(r.own == name for r, (_, name) in zip(inside, NOTICES)) >= 5  # one may hold a longer notice of its own
    assert [r.own for r in own(spark, NONE, prose)] == [None] * len(NONE)


def test_long_texts_are_read_in_pieces(spark):
    words = "lorem ipsum dolor sit amet consectetur " * (CHUNK // 39)
    cut = words[: CHUNK - 60]  # the notice lies across the end of the first piece
    got = own(spark, [f"{cut} {lic._MIT_GRANT} {words * 2}", words * 3, "x" * (CHUNK + 9), f"{'x' * (CHUNK + 9)} Released under the MIT License"])
    assert [r.own for r in got] == ["MIT", None, None, "MIT"] and got[0].cosine == pytest.approx(1, abs=1e-6)


def test_other_templates(spark):
    rows = spark.createDataFrame([("LICENSE", 0, "Public loan terms of the town library, 2020 edition"), ("a/b", 1, "code")], "path string, mark long, text string")
    got = {r.mark: (r.licence, r.inherited_from) for r in lic.licences(rows, (("Town", "terms of the town library"),)).collect()}
    assert got == {0: ("Town", None), 1: ("Town", "")}
