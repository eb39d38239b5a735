"""The licence scan against a word-by-word search, and the expression parser."""

import re

import pytest

from corpusgrove.llm import license_scan

from .helpers import LOWER, corpus, documents

TEXTS = [
    "Released under the MIT License.", "mit\nlicense MIT-License mit  license", "the mitlicense, submit license",
    "GNU General\tPublic, License v3; Apache License 2.0", "lesser general public license", "general public license general public license",
    "SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0\nrest",
    "// spdx-license-identifier: mit and proprietary */ code", "License: nothing to see here", "license: BSD-3-Clause\r\nx",
    "Émit license ümit license mit licensé", "mit license " * 3000, "CC BY-NC 4.0", "cc by 4.0 and all rights reserved",
]


def naive(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in license_scan.BASE.items():
        parts = phrase.split()
        places = [k for k in range(len(found)) if found[k : k + len(parts)] == parts]
        starts += places
        labels |= {label} if places else set()
    return len(found), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_base_scan_equals_word_by_word_search(spark):
    rows = corpus(20) + [(1000 + k, t) for k, t in enumerate(TEXTS)]
    got = license_scan.scan(documents(spark, rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted([(i, *naive(t)) for i, t in rows], key=key)
    for r in got:
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}


def test_labels_and_scores_of_the_method(spark):
    rows = license_scan.scan(documents(spark, list(enumerate(TEXTS)))).collect()
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in rows}
    assert got[4] == ("gpl,lgpl", 0.5)
    assert got[6] == ("apache,gpl,mit", 1.0)
    assert got[7] == ("mit,proprietary", 0.0)
    assert got[8] == ("", 0.5)
    assert got[9] == ("bsd", 1.0)
    assert got[12] == ("cc-by-nc", 0.1)
    assert got[13] == ("cc-by,proprietary", 0.0)


@pytest.mark.parametrize(
    "expression, labels, score",
    [
        ("MIT", {"mit"}, 1.0), ("gpl-3.0+ OR mit", {"gpl", "mit"}, 1.0), ("MIT AND GPL-2.0", {"mit", "gpl"}, 0.3),
        ("mit or apache-2.0 and agpl-3.0", {"mit", "apache", "agpl"}, 1.0), ("(mit or apache-2.0) and agpl-3.0", {"mit", "apache", "agpl"}, 0.2),
        ("gpl-2.0 with classpath", {"gpl"}, 0.5), ("mit with x or gpl", {"mit", "gpl"}, 1.0), ("((mit))", {"mit"}, 1.0),
        ("mit or", {"mit"}, 1.0), ("(mit", {"mit"}, 1.0), ("mit gpl", {"mit", "gpl"}, 0.3), ("unheard-of", {"unheard-of"}, 0.5),
    ],
)
def test_expressions(expression, labels, score):
    assert license_scan.evaluate(expression) == (labels, pytest.approx(score))


def test_expressions_without_licences():
    assert license_scan.evaluate("") is None and license_scan.evaluate("or ( with") is None


def test_postfix_order():
    assert license_scan.postfix("a or b and c with d") == ["a", "b", "c", "d", "with", "and", "or"]


def test_empty_table(spark):
    assert license_scan.scan(documents(spark, [])).count() == 0
