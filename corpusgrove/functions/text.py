"""Column expressions over response text, labels, tokens and prompts."""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from corpusgrove.functions import grammar as G


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    """Drop leading and trailing whitespace of any kind, not just blanks."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def strip_chars(c: Column, chars: str) -> Column:
    return F.btrim(c, F.lit(chars))


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def group(c: Column, pattern: str, idx: int, multiline: bool = False) -> Column:
    return F.regexp_extract(c, G.java(pattern, multiline), idx)


def all_groups(c: Column, pattern: str, idx: int, multiline: bool = False) -> Column:
    return F.regexp_extract_all(c, F.lit(G.java(pattern, multiline)), F.lit(idx))


def matches(c: Column, pattern: str) -> Column:
    return c.rlike(G.java(pattern))


# ---------------------------------------------------------------- tokens


def count_tokens(c: Column) -> Column:
    return F.regexp_count(c, F.lit(G.TOKEN)).cast("long")


def truncate_tokens(c: Column, n: Column | int) -> Column:
    """Text up to the end of its n-th token; the whole text when it is shorter."""
    n = F.greatest(n if isinstance(n, Column) else F.lit(n), F.lit(0)).cast("int")

    def cut(parts: Column) -> Column:
        return F.when(F.size(parts) > n, F.array_join(F.slice(parts, 1, n), "")).otherwise(c)

    return let(F.regexp_extract_all(c, F.lit(G.SPACED_TOKEN), F.lit(0)), cut)


class TokenCounter:
    """How tokens are counted and cut.  Replace both for another tokenizer.

    ``truncate`` must return a text that is not longer than asked unchanged.
    """

    def __init__(
        self,
        count: Callable[[Column], Column] = count_tokens,
        truncate: Callable[[Column, Column], Column] = truncate_tokens,
    ):
        self.count = count
        self.truncate = truncate


DEFAULT_TOKENS = TokenCounter()


# ---------------------------------------------------------------- labels


def topic_label(lvl: Column, name: Column, count: Column | None = None, desc: Column | None = None) -> Column:
    parts = [F.lit("["), lvl.cast("string"), F.lit("] "), name]
    if count is not None:
        parts += [F.lit(" (Count: "), count.cast("string"), F.lit(")")]
    if desc is not None:
        parts += [F.lit(": "), desc]
    return F.concat(*parts)


def label_of(desc: bool = False, count: bool = False) -> Column:
    """Label of a topic row, in one of its four renderings."""
    return topic_label(
        F.col("lvl"),
        F.col("name"),
        F.col("count") if count else None,
        F.col("desc") if desc else None,
    )


def strip_topic_desc(label: Column) -> Column:
    return strip(F.split(label, ":", -1)[0])


# ---------------------------------------------------------------- responses


def response_column(df: DataFrame) -> str:
    return "refined_responses" if "refined_responses" in df.columns else "responses"


def doc_topic_labels(response: Column) -> Column:
    """Labels ``[l] name`` named by a response, in line order, unchecked."""
    named = F.filter(lines(response), lambda x: matches(x, G.DOC_TOPIC_LINE))
    return F.transform(
        named,
        lambda x: F.concat(
            F.lit("["), group(x, G.DOC_TOPIC_LINE, 1), F.lit("] "), group(x, G.DOC_TOPIC_LINE, 2)
        ),
    )


def assigned_topics(response: Column) -> Column:
    return F.transform(all_groups(response, G.ASSIGNED_TOPIC, 1, multiline=True), strip)


def first_topic(response: Column) -> Column:
    """Name of the first assigned topic, null when there is none."""
    found = all_groups(response, G.FIRST_TOPIC, 1)
    return F.get(found, 0)


def merge_originals(text: Column) -> Column:
    """``array<struct<lvl, name>>`` of the topics a merge line replaces."""
    return F.transform(
        F.arrays_zip(
            all_groups(text, G.MERGE_ORIGINAL, 1).alias("l"),
            all_groups(text, G.MERGE_ORIGINAL, 2).alias("n"),
        ),
        lambda x: F.struct(
            x["l"].try_cast("int").alias("lvl"), strip_chars(x["n"], ", ").alias("name")
        ),
    )


def rewrite_topics(text: Column, mapping: Column) -> Column:
    """Replace every ``old`` by ``new``, line by line, in mapping order.

    ``mapping`` is an ``array<struct<old, new>>`` without empty or unchanged
    keys; a later pair sees the result of the earlier ones, and descriptions
    are rewritten like names.
    """

    def one(line: Column) -> Column:
        return F.aggregate(mapping, line, lambda acc, m: F.replace(acc, m["old"], m["new"]))

    return F.array_join(F.transform(lines(text), one), "\n")


def flatten_newlines(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit(" "))


# ---------------------------------------------------------------- prompts


def fill_template(template: str, **values: Column) -> Column:
    """Fill ``{Name}`` placeholders; filled-in text is never scanned again."""
    parts: list[Column] = []
    for literal, field, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(values[field])
    return F.concat(*parts) if parts else F.lit("")


def template_fields(template: str) -> list[str] | None:
    """Placeholders of a template, if no token of a filled one can span two of its parts.

    That holds when no placeholder touches a word character of the template or
    another placeholder.
    """
    word = lambda c: unicodedata.category(c)[0] in "LMN" or c == "_"
    fields, before = [], None
    for literal, field, _, _ in string.Formatter().parse(template):
        if before is not None and (not literal and field is not None or literal and word(literal[0])):
            return None
        if field is not None:
            if literal and word(literal[-1]):
                return None
            fields.append(field)
        before = field
    return fields


def filled_tokens(template: str, **counts: Column) -> Column | None:
    """Tokens of a filled template from those of its parts, by the default counter; None if they do not add up."""
    fields = template_fields(template)
    if fields is None:
        return None
    literals = " ".join(literal for literal, _, _, _ in string.Formatter().parse(template))
    total = count_tokens(F.lit(literals))
    for field in fields:
        total = total + counts[field]
    return total
