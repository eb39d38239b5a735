"""The prefix tree against conversations formatted one by one."""

import hashlib
from collections import defaultdict

import pytest

from corpusgrove.llm import chat_tree
from corpusgrove.llm.queries import tokenizer_path

SCHEMA = "conv_id long, turn long, role string, text string, digest string, tokens string"
SAID = r"\### Assistant: </turn> ok"
ROWS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 2, "user", "more"), (1, 3, "assistant", "sure"),
    (2, 0, "user", "hello"), (2, 1, "assistant", "hi"), (2, 2, "user", "less"),
    (3, 0, "user", "hello"), (3, 1, "assistant", "hi"),
    (4, 1, "assistant", "hi"), (4, 0, "user", "hello"),  # a copy of 3, out of order
    (5, 0, "user", SAID), (5, 1, "assistant", SAID),
    (6, 0, None, None), (6, 1, "assistant", None), (6, 2, "assistant", ""),
    (7, 0, "a:b\nc\\", "#### x <turn> </turn></turn>\n### user:\n"), (7, 1, "assistant", "tail\\"),
    (8, 0, "user", "naïve 日本 <|endoftext|> \\\\n"), (8, 1, "assistant", "x" * 30_000),
    (9, 0, "user", "twice"), (9, 0, "user", "twice"),
    (10, 0, "user", "hello"), (10, 1, "assistant", "ho"),
    (None, 0, "user", "nobody"), (11, None, "user", "no turn"), (11, 0, "assistant", "second"),
]


def naive(rows):
    """Per conversation its turns in order."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(ts, key=lambda x: x[:3])] for c, ts in turns.items()}


@pytest.fixture(scope="module")
def tree(spark):
    rows = spark.createDataFrame([(*r, "x", "y") for r in ROWS], SCHEMA)
    return chat_tree.build(rows, tokenizer_path("byte_bpe_50k.json"))


def test_read_back_equals_the_input(tree):
    got = {r["conv_id"]: r for r in chat_tree.digests(tree, tokenizer_path("byte_bpe_50k.json")).collect()}
    want = naive(ROWS)
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"### {chat_tree.escape_role(r)}:\n{chat_tree.escape(t)}</turn>\n" for r, t in turns)
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv]["formatted_chars"] == len(whole)


def test_every_prefix_is_emitted_once_with_its_ancestors(tree):
    rows = sorted(tree.emitted.collect(), key=lambda r: r["start"])
    prefixes = {tuple(ts[: k + 1]) for ts in naive(ROWS).values() for k in range(len(ts))}
    assert len(rows) == len(prefixes)
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["tokens"])
        at += r["n_tokens"]
        runs = [(s["from"], s["to"]) for s in r["ancestors"]]
        assert runs == sorted(runs) and all(a < b <= r["start"] for a, b in runs)
        # a position id is the number of ancestor tokens
        assert r["position"] == sum(b - a for a, b in runs)


def test_trees_are_contiguous(tree):
    order = [r["tree"] for r in sorted(tree.emitted.collect(), key=lambda r: r["start"])]
    assert len([1 for a, b in zip(order, order[1:]) if a != b]) + 1 == len(set(order))


@pytest.mark.parametrize("text", ["", "\\", "###", "####", "\\###", "</turn>", "\\</turn>\\", "### a:\nb</turn>\n", "<<//turn>"])
def test_escapes_come_back_and_leave_no_marks(text):
    held = chat_tree.escape(text)
    assert chat_tree.unescape(held) == text and "###" not in held
    assert chat_tree.parse(f"### user:\n{held}</turn>\n") == [("user", text, 10)]


def test_empty_table(spark):
    tree = chat_tree.build(spark.createDataFrame([], SCHEMA), tokenizer_path("byte_bpe_50k.json"))
    assert tree.emitted.count() == 0 and tree.ends.count() == 0
