"""License scan against a search in plain Python."""

import random
import re

from millrace.llm import licenses

SCHEMA = "doc_id long, text string, row long, norm string, labels string"


def normal(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, rules):
    words = normal(text)
    norm = " ".join(words)
    found = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, norm, re.ASCII):
            start = norm[: m.start()].count(" ")
            found.append((start, start + m.group().count(" ") + 1, r.priority, k, r.label, r.base))
    base = [x for x in found if x[5]]
    found.sort(key=lambda x: (x[0], -x[1], x[2], x[3]))
    outer, reach = [], -1
    for x in found:
        if reach < x[1]:
            outer.append(x)
        reach = max(reach, x[1])
    kept = []
    for i, x in enumerate(outer):
        lost = i > 0 and outer[i - 1][1] > x[0] and outer[i - 1][2] <= x[2]
        lost |= i + 1 < len(outer) and outer[i + 1][0] < x[1] and outer[i + 1][2] < x[2]
        if not lost:
            kept.append(x)
    covered = {w for x in kept for w in range(x[0], x[1])}
    starts = [x[0] for x in base]
    names = sorted({x[4] for x in base})
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(names),
            ",".join(sorted({x[4] for x in kept} | set(names))), round(len(covered) / len(words), 9) if words and kept else 0.0)


def test_equals_plain_search(spark):
    rules = licenses.rules()
    assert len(rules) > 300 and all(re.compile(r.pattern) for r in rules)
    rng = random.Random(6)
    pieces = ["Licensed under the Apache License, Version 2.0", "under the MIT license", "CC BY-NC", "CC-BY-NC-SA 4.0", "GNU General Public License v3 or later",
              "SPDX-License-Identifier: GPL-2.0", "BSD 3-Clause", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", "LGPL 2.1",
              "released into the public domain", "Mozilla Public License 2.0", "ISC license", "all rights reserved", "under the mit licenses", "É cc by nc É", "K mit",
              "cc by nc cc by nc", "gpl gpl 2 or later version", "the MIT X11 licence", "cc0 1.0"]
    texts = [" ".join(rng.choice([rng.choice(pieces), "wörd and, more."]) for _ in range(rng.randrange(0, 12))) for _ in range(150)]
    texts += [*pieces, None, "", " .,", "under the mit license " * 300, "x " * 100_000 + "cc by nc"]
    rows = [(i, t, 1, "clash", "clash") for i, t in enumerate(texts)] + [(None, pieces[0], None, None, None), (3, texts[3], 0, "", "")]
    out = licenses.license_scan(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in out]
    assert sorted(got, key=str) == sorted(((r[0], *brute(r[1], rules)) for r in rows), key=str)
    assert licenses.license_scan(spark.createDataFrame([], SCHEMA)).count() == 0


def sample(pattern):
    """A text that the pattern matches: first alternatives, optional parts left out."""
    group = re.compile(r"\(\?:([^()]*)\)(\?|\{(\d+),\d+\})?")
    while group.search(pattern):
        pattern = group.sub(lambda m: "" if m.group(2) == "?" else m.group(1).split("|")[0].replace("[^ ]+", "word") * int(m.group(3) or 1), pattern)
    for old, new in (("[cs]", "c"), ("[1-4]", "4"), ("[05]", "0")):
        pattern = pattern.replace(old, new)
    return re.sub(r"[a-z0-9 ]\?", "", pattern.split("|")[0])


def test_every_sentence_passes_its_gate():
    assert len({(label, pattern) for label, _, pattern in licenses.TEXTS}) == len(licenses.TEXTS) >= 90
    for label, keyword, pattern in licenses.TEXTS:
        for part in pattern.split("|") if "(" not in pattern else [pattern]:
            text = sample(part)
            assert re.fullmatch(rf"(?i)(?:{pattern})", text), (pattern, text)
            assert keyword in f" {text} ", (keyword, text)


TEXTS = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software""",
    "bsd-3": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: * Neither the name of the University nor the names of its contributors may be used to endorse or promote products""",
    "apache-2": """// you may not use this file except in compliance with the License.
        // You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
    "gpl-3": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "zlib": "# Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mpl-2": "/* This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. */",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-sa": "https://creativecommons.org/licenses/by-sa/4.0/",
    None: "A person obtaining a copy of the book may use it with the permission of the library; the software is provided by us.",
}


def test_license_texts_without_a_name(spark):
    rows = list(enumerate(TEXTS.values()))
    out = {r.doc_id: r.labels.split(",") for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, label in enumerate(TEXTS):
        assert label in out[i] if label else out[i] == [""], (label, out[i])
