"""Small tables with odd rows for the operators' tests."""

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SYLLABLES = "an ar ba ce do el fi go hu in ka lo mi ne or pa qu ri so ta um ve wo xe yl zu".split()
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, size string, spans string"


def prose(rng: random.Random, words: int) -> str:
    out = []
    for k in range(words):
        word = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
        out.append(word.capitalize() if k % 11 == 0 else word + "." if k % 11 == 10 else word)
        out.append("\n" if k % 40 == 39 else " ")
    return "".join(out).strip()


def corpus(n: int = 60, seed: int = 1) -> list[tuple]:
    """Documents with exact and near copies, shared passages, null and empty texts, a long one, repeated rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(3, 160)) for _ in range(n)]
    passage = prose(rng, 60)
    for k in range(0, n, 7):
        words = texts[(k + 3) % n].split(" ")
        words[len(words) // 2] = "changed"
        texts[k] = " ".join(words)
    for k in range(1, n, 9):
        texts[k] = texts[(k + 5) % n]
    for k in range(2, n, 8):
        texts[k] += "\n" + passage + "\n" + prose(rng, 10)
    texts += [None, "", "   \n\t", "one two", "One two", "a" * 70_000, prose(rng, 9000), "ünï çødé " * 30, passage + passage]
    rows = [(k, t) for k, t in enumerate(texts)]
    return [*rows, rows[4], (5, "another text under a known id " * 5), (None, texts[3]), (None, None), (-3, texts[6])]


def documents(spark, rows, sources=("a", "b", None, "Z")):
    """The rows as a documents table with columns whose names operators use themselves."""
    full = [(i, t, "en", sources[k % len(sources)], len(t or ""), "x", "y", None, None) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCUMENTS)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text: str | None, width: int = 5) -> set[tuple]:
    found = words(text)
    return {tuple(found[k : k + width]) for k in range(max(1, len(found) - width + 1))} if found else set()
