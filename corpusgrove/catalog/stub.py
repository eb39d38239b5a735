"""A rule in place of a model, so that queries have responses to work on.

The rule reads the whole text: the two most frequent words of six letters or
more become the document's topics.  Some documents get an unlisted topic, a
lower-level line, an invalid line, no topic at all or a failed call.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusgrove.functions.text import let
from corpusgrove.sources.documents import read_documents
from corpusgrove.storage import materialize

LONG_WORD = r"(\p{L}{6,})"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/documents.parquet", "doc_id")


def top_words(text: Column, k: int = 2) -> Column:
    """Most frequent long words, most frequent first, ties alphabetical.

    Counted inside the row: sort, find where runs of equal words start, take
    run lengths.  No shuffle, whatever the length of the text.
    """
    # the lower case of İ is two characters, a letter and a mark that would end the word
    lowered = F.lower(F.replace(text, F.lit("İ"), F.lit("i")))
    words = F.sort_array(F.regexp_extract_all(lowered, F.lit(LONG_WORD), F.lit(1)))

    def runs(s: Column) -> Column:
        starts = F.filter(
            F.transform(s, lambda w, i: F.when((i == 0) | (w != F.get(s, i - 1)), i)), lambda i: i.isNotNull()
        )
        return let(
            starts,
            lambda st: F.transform(
                st,
                lambda p, k: F.struct(
                    (p - F.coalesce(F.get(st, k + 1), F.size(s))).alias("minus_count"), F.get(s, p).alias("word")
                ),
            ),
        )

    best = F.slice(F.sort_array(let(words, runs)), 1, k)
    return F.transform(best, lambda r: r["word"])


def capital(word: Column) -> Column:
    """``word`` with a capital letter for its first, one for one, so that it stays the same topic in any case.

    ``upper`` and ``initcap`` make two letters of some: ``ß`` becomes ``Ss``, another name, and ``ᾳ`` becomes ``ΑΙ`` in
    upper case but ``ᾼ`` as the first letter of a word.
    """
    first = F.substring(word, 1, 1)
    upper = F.when(first == "ß", "ẞ").when(F.length(F.upper(first)) == 1, F.upper(first))
    upper = upper.when(F.length(F.initcap(first)) == 1, F.initcap(first)).otherwise(first)
    return F.concat(upper, F.substring(word, F.lit(2), F.length(word)))


def level1_response(words: Column, doc: Column, source: Column) -> Column:
    def line(found: Column, i: int) -> Column:
        word = F.get(found, F.lit(i))
        shown = F.when(doc % 2 == 0, capital(word)).otherwise(word)
        return F.concat(F.lit("[1] "), shown, F.lit(": Documents from "), source, F.lit(" about "), word, F.lit("."))

    text = let(
        words,
        lambda found: F.concat_ws(
            "\n",
            line(found, 0),
            line(found, 1),
            F.when(doc % 23 == 22, "[1] Unlisted Matter: Nothing in the tree covers this."),
            F.when(doc % 13 == 12, "[2] Detail: A lower level line."),
            F.when(doc % 11 == 10, "no topic on this line"),
        ),
    )
    return F.when(doc % 29 == 28, "Error").when(doc % 17 == 16, "None").otherwise(
        F.coalesce(F.nullif(text, F.lit("")), F.lit("None"))
    )


def worded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with ``words``, without their text."""
    docs = documents(spark, sf_dir)
    return docs.select("doc_idx", "lang", "source", top_words(F.col("text")).alias("words"))


def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_idx, lang, source, responses, status`` of the first stage.

    Written once and read back, as completions always are: they are paid for
    and most queries read them more than once.
    """
    response = level1_response(F.col("words"), F.col("doc_idx"), F.col("source"))
    answers = worded(spark, sf_dir).select("doc_idx", "lang", "source", response.alias("responses"))
    status = F.when(F.col("responses") == "Error", "error").otherwise("ok")
    return materialize(answers, "answers").withColumn("status", status)


def merge_response(words: Column) -> Column:
    """A merge line for the document's two topics; ``None`` with fewer."""
    a, b = capital(F.get(words, F.lit(0))), capital(F.get(words, F.lit(1)))
    line = F.concat(
        F.lit("[1] "), a, F.lit(": Texts on "), F.lower(a), F.lit(" and "), F.lower(b),
        F.lit(". ([1] "), a, F.lit(", [1] "), b, F.lit(")"),
    )
    return F.coalesce(line, F.lit("None"))


def subtopic_response(words: Column, lang: Column) -> Column:
    """The document's first topic as branch, its second as subtopic."""
    a, b = capital(F.get(words, F.lit(0))), capital(F.get(words, F.lit(1)))
    text = F.concat(
        F.lit("[1] "), a,
        F.lit("\n    [2] "), b, F.lit(" (Document: 1, 3): Texts on "), F.lower(b),
        F.lit(".\n    [2] Group "), lang, F.lit(" (Documents: 2): More in "), lang, F.lit("."),
        F.lit("\n    not a subtopic (line)"),
    )
    return F.coalesce(text, F.lit("None"))


# ------------------------------------------------------------ completers

_LONG = re.compile(r"[^\W\d_]{6,}")
GENERATION_TEMPLATE = "Known topics:\n{Topics}\nText:\n{Document}"
ASSIGN_TEMPLATE = "Pick a topic.\n{tree}\n#####\n{Document}"
CORRECT_TEMPLATE = "Pick a listed topic.\n{tree}\n#####\n{Document}\n#####\n{Message}"
SUBTOPIC_TEMPLATE = "Topic: {Topic}\nDocuments:\n{Document}"
REFINE_TEMPLATE = "Merge what belongs together.\n{Topics}\nMerged:"


def capital_word(word: str) -> str:
    """``capital`` of a string."""
    forms = ("ẞ" if word[0] == "ß" else word[0].upper(), word[0].title(), word[0])
    return next(form for form in forms if len(form) == 1) + word[1:]


def long_words(text: str) -> list[str]:
    """Runs of six letters or more, in lower case as in ``top_words``."""
    found = []
    for run in _LONG.findall(text.replace("İ", "i").lower()):
        # numbers such as ² and Ⅷ are no digits to the pattern, and no letters
        parts = [run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split()
        found += [w for w in parts if len(w) >= 6]
    return found


def name_topics(prompt: str) -> str:
    """Completer: the two most frequent long words of the text."""
    words = Counter(long_words(prompt.split("\nText:\n", 1)[1]))
    best = sorted(words.items(), key=lambda item: (-item[1], item[0]))[:2]
    return "\n".join(f"[1] {capital_word(w)}: Documents about {w}." for w, _ in best) or "None"


def name_initial(prompt: str) -> str:
    """Completer: the first letter of the most frequent long word."""
    words = Counter(long_words(prompt.split("\nText:\n", 1)[1]))
    if not words:
        return "None"
    letter = min(words.items(), key=lambda item: (-item[1], item[0]))[0][0]
    return f"[1] Words in {letter}: Texts led by a word in {letter}."


def pick_topic(prompt: str) -> str:
    """Completer: the listed topic at the position the text's length gives."""
    tree, text = prompt.split("\n", 1)[1].split("\n#####\n")[:2]
    labels = tree.split("\n")
    return labels[len(text) % len(labels)]


def first_listed(prompt: str) -> str:
    """Completer: the first topic of the list."""
    return prompt.split("\n")[1].split(":")[0] + ": Reassigned."


def learn_slowly(prompt: str) -> str:
    """Completer: a listed topic, but at first an unlisted one for some texts, and for some of them twice."""
    _, text, message = prompt.split("\n#####\n")
    if len(text) % 5 == 0:
        return "[1] Second Matter: Again." if "Stubborn Matter" in message else "[1] Stubborn Matter: Not listed."
    if len(text) % 3 == 0 and "Stubborn Matter" not in message:
        return "[1] Stubborn Matter: Not listed."
    return first_listed(prompt)


def group_subtopic(prompt: str) -> str:
    """Completer: one subtopic per prompt."""
    label = prompt.split("\n")[0][len("Topic: "):]
    name = label.split("] ", 1)[1]
    return f"{label}\n    [2] {name} Group (Document: 1): One prompt of {name}."


def merge_listed(prompt: str) -> str:
    """Completer: merge the first two listed topics under the first one's name."""
    labels = prompt.split("\n")[1:-1][:2]
    (a, b) = (label.split(":")[0] for label in labels)
    return f"{a}: Merged topics. ({a}, {b})"
