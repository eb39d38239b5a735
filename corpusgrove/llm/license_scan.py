"""Licence scan: one automaton for tags and notice phrases, and a parser for licence expressions.

Two Aho-Corasick automata read every whole text once each: one over its words
(lower case, single spaces) for notice phrases, one over its lower-case bytes
for identifier tags.  What follows a tag on its line is a licence expression of
``and``, ``or``, ``with`` and parentheses; a shunting-yard parser turns it into
postfix order and evaluates it to the licences it names and a permissiveness
from 0 to 1: ``or`` lets the user choose the better side, ``and`` binds to the
worse, ``with`` an exception lifts its licence by a step.

Defined results: null and empty text have no words, no labels and score 0.5,
as every text without a licence; an expression that does not parse counts the
licences it names as joined by ``and``; rows that repeat are scanned each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusgrove.llm.hashing import LETTERS_DIGITS, LOWER, text_bytes

# Fixed values of the base scan: phrase and label.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Phrases and labels this method adds.
NOTICES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "creative commons attribution": "cc-by",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
TAGS = ["spdx-license-identifier:", "license-expression:", "@license", "license:"]
# How freely text under a label may be used.
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "cc0": 1.0, "public-domain": 1.0, "cc-by": 0.9, "mpl": 0.7, "cc-by-sa": 0.6,
    "lgpl": 0.5, "gpl": 0.3, "cc-by-nd": 0.3, "agpl": 0.2, "cc-by-nc": 0.1, "proprietary": 0.0,
}
UNKNOWN = 0.5
EXCEPTION_STEP = 0.2
FAMILIES = ["apache", "agpl", "lgpl", "gpl", "mit", "bsd", "mpl", "cc0", "cc-by-nc", "cc-by-nd", "cc-by-sa", "cc-by"]
TOKEN = re.compile(r"[()]|[^\s()]+")
ENDS = re.compile(rb"\*/|-->|[\r\n]")
STRENGTH = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str:
    """The label of a licence identifier, such as apache for apache-2.0."""
    for name in FAMILIES:
        if identifier == name or identifier.startswith((name + "-", name + "+")):
            return name
    return identifier


def postfix(expression: str) -> list[str] | None:
    """Shunting yard: the tokens in postfix order, None if the expression is not well formed."""
    out, waiting, want_name = [], [], True
    for token in TOKEN.findall(expression.lower()):
        if token == "(":
            if not want_name:
                return None
            waiting.append(token)
        elif token == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if want_name or not waiting:
                return None
            waiting.pop()
        elif token in STRENGTH:
            if want_name:
                return None
            while waiting and waiting[-1] != "(" and STRENGTH[waiting[-1]] >= STRENGTH[token]:
                out.append(waiting.pop())
            waiting.append(token)
            want_name = True
        else:
            if not want_name:
                return None
            out.append(token)
            want_name = False
    if want_name or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(expression: str) -> tuple[frozenset[str], float] | None:
    """Labels and permissiveness of an expression; None if it names nothing."""
    order = postfix(expression)
    if order is None:
        names = [t for t in TOKEN.findall(expression.lower()) if t not in STRENGTH and t not in "()" and family(t) in FREEDOM]
        labels = frozenset(map(family, names))
        return (labels, min(FREEDOM[n] for n in labels)) if labels else None
    stack: list[tuple[frozenset[str], float]] = []
    for token in order:
        if token not in STRENGTH:
            label = family(token)
            stack.append((frozenset([label]), FREEDOM.get(label, UNKNOWN)))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "or":
            stack.append((left[0] | right[0], max(left[1], right[1])))
        elif token == "and":
            stack.append((left[0] | right[0], min(left[1], right[1])))
        else:
            stack.append((left[0], min(1.0, left[1] + EXCEPTION_STEP)))
    return stack[0]


def automaton(phrases: dict[str, object]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, value in phrases.items():
        found.add_word(phrase, value)
    found.make_automaton()
    return found


def word_text(data: np.ndarray) -> tuple[str, int]:
    """Words joined by single spaces, a space at both ends, one character for each byte; and their number."""
    word = LETTERS_DIGITS[data]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    n = int(starts.sum())
    if not n:
        return " ", 0
    # every kept byte moves back by the bytes dropped so far, a word start forward by its space
    at = np.cumsum(word) + np.cumsum(starts) - 1
    out = np.full(int(word.sum()) + n + 1, 32, np.uint8)
    out[at[word]] = LOWER[data[word]]
    return out.tobytes().decode("latin-1"), n


def scan_text(data: np.ndarray, phrases, tags) -> tuple[int, list[int], set[str], set[str], list[float]]:
    """Words, starts of base phrases, base labels, all labels, and the score of each finding."""
    text, n_words = word_text(data)
    starts, base, labels, scores = [], set(), set(), []
    hits = [(end - len(phrase) + 1, phrase) for end, phrase in phrases.iter(text)] if n_words else []
    if hits:
        spaces = np.cumsum(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
        places = [(int(spaces[begin]) - 1, phrase.strip()) for begin, phrase in hits]
        reach = -1
        for start, end, phrase in sorted(((s, s + len(p.split()), p) for s, p in places), key=lambda x: (x[0], -x[1])):
            # a place inside a longer phrase's place speaks of the longer phrase
            covered, reach = end <= reach, max(reach, end)
            label = BASE.get(phrase) or NOTICES[phrase]
            if phrase in BASE:
                starts.append(start)
                base.add(label)
            if phrase in BASE or not covered:
                labels.add(label)
            if not covered:
                scores.append(FREEDOM[label])
    low = LOWER[data].tobytes()
    if b"license" in low:
        line_text = low.decode("latin-1")
        for end, tag in tags.iter(line_text):
            stop = ENDS.search(low, end + 1)
            expression = low[end + 1 : stop.start() if stop else len(low)].decode("utf-8", "replace").strip(" \t:;,.\"'*#")
            found = evaluate(expression) if tag != "license:" or postfix(expression) else None
            if found and (found[0] & FREEDOM.keys() or tag != "license:"):
                labels |= found[0]
                scores.append(found[1])
    return n_words, starts, base, labels, scores


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: words, places of the base phrases, labels and the lowest score found."""

    def run(batches):
        phrases = automaton({f" {p} ": f" {p} " for p in [*BASE, *NOTICES]})
        tags = automaton({t: t for t in TAGS})
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                data, offsets = text_bytes(batch.column(1))
                rows = []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    n, starts, base, labels, scores = scan_text(data[a:b], phrases, tags)
                    rows.append(
                        (n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                         ",".join(sorted(labels)), min(scores, default=UNKNOWN))
                    )
                columns = list(zip(*rows)) if rows else [[]] * 7
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
                names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
