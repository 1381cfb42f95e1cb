"""The scan against a plain search with the same rules."""

import re

import pytest

from voxsift.llm.license_rules import BASE, ROOTS, rules
from voxsift.llm.license_scan import scan, spans

TEXTS = [
    "", "   ", "no licence here", "MIT License", "This is MIT-licensed. MIT\nLicense, mit license!",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "SPDX-License-Identifier: GPL-3.0-or-later", "cc by cc by CC-BY-SA 4.0 cc by",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GNU General Public License GNU General Public License v2", "GNU GENERAL PUBLIC LICENSE İ É \u212a all\u212a mar\u212aed", "émit license mité license", "gnu général public license",
    "Copyright (c) 2020 X. All rights reserved. " * 40, "word " * 4000 + "apache license",
]


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base = [(words_at, label) for phrase, label in BASE.items() for words_at in range(len(words)) if words[words_at:words_at + len(phrase.split())] == phrase.split()]
    padded = " " + " ".join(words) + " "
    found = []
    for number, rule in enumerate(rules()):
        if any(root in padded for root in ROOTS) and rule.keyword in padded:
            for m in re.finditer(f" ({rule.pattern})(?= )", padded):
                start = padded[:m.start()].count(" ")
                found.append((start, start + m[0].count(" "), rule.rank, number, rule.label))
    left = [
        d for d in found
        if not any(
            e is not d and e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2]
            and (e[:3] != d[:3] or e[3] < d[3]) for e in found
        )
    ]
    best = min((d[2] for d in left), default=9)
    score = {1: 1.0, 2: 0.8, 3: 0.5}.get(best, 0.5 if base else 0.0)
    starts = [at for at, _ in base]
    labels = {label for _, label in base}
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | {d[4] for d in left})), score,
    ), sorted((d[4], d[0], d[1] - d[0]) for d in left)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (70, None), (None, "mit license")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS l_words", "2 AS l_found", "3 AS n_words")
    return rows, frame


def test_scan(docs):
    rows, frame = docs
    got = sorted((tuple(r) for r in scan(frame).collect()), key=str)
    assert got == sorted(((i, *plain(t)[0]) for i, t in rows), key=str)


def test_spans(docs):
    rows, frame = docs
    got = sorted((r.doc_id, r.label, r.first_word, r.n_words) for r in spans(frame.where("doc_id < 60 AND doc_id != 3")).collect())
    assert got == sorted((i, *span) for i, t in rows if i not in (None, 3, 70) for span in plain(t)[1])


def test_there_are_hundreds_of_rules_and_they_compile():
    assert len(rules()) > 200
    for rule in rules():
        assert re.compile(rule.pattern)


def test_empty_table(docs):
    assert scan(docs[1].limit(0)).collect() == []
