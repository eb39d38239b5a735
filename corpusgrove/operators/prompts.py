"""Prompts of the five stages, as columns over documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusgrove.functions import grammar as G, text as X
from corpusgrove.functions.vectors import embed, hashed_terms
from corpusgrove.operators.backend import Parts
from corpusgrove.operators.similarity import budgeted_list, half_context_list
from corpusgrove.operators.tree import list_text, topic_list


PROMPT_TOKENS = "__prompt_tokens"


def labelled_topics(tree: DataFrame, desc: bool, tokens: X.TokenCounter, encode=None, vectors: bool = True) -> DataFrame:
    """``ord, label, tokens`` (and ``embedding``) of a tree's distinct labels."""
    listed = topic_list(tree, desc=desc, count=False)
    once = listed.groupBy("label").agg(F.min("position").alias("ord"))
    rows = once.select("ord", "label", tokens.count(F.concat("label", F.lit("\n"))).alias("tokens"))
    return rows.withColumn("embedding", embed(F.col("label"), encode)) if vectors else rows


def _with_tokens(df: DataFrame, template: str, tokens: X.TokenCounter, **counts: Column) -> DataFrame:
    """Adds the prompt's tokens where they are the sum over its parts: prompts carry whole trees, and counting is slow."""
    total = X.filled_tokens(template, **counts) if tokens is X.DEFAULT_TOKENS else None
    return df if total is None else df.withColumn(PROMPT_TOKENS, total)


def list_tokens(tree: DataFrame, desc: bool, tokens: X.TokenCounter, strip_desc: bool = False) -> int:
    """Tokens of the whole topic list, summed per label."""
    label = X.label_of(desc)
    if strip_desc:
        label = X.strip_topic_desc(label)
    return tree.agg(F.coalesce(F.sum(tokens.count(label)), F.lit(0))).first()[0]


def _generation(
    docs: DataFrame,
    tree: DataFrame,
    template: str,
    context_len: int,
    with_desc: bool = False,
    max_topic_tokens: int = G.MAX_TOPIC_TOKENS,
    tokens: X.TokenCounter = X.DEFAULT_TOKENS,
    encode=None,
) -> tuple[DataFrame, Column, Column | None, Column]:
    """Documents with ``fit`` and the tokens of their prompt, then its document, its list of topics where that is not the whole one, and the whole list."""
    template_tokens = tokens.count(F.lit(template))
    topic_tokens = list_tokens(tree, with_desc, tokens, strip_desc=True)
    whole, own = list_text(tree, desc=with_desc, strip_desc=True), None
    room = F.lit(context_len) - template_tokens
    sized = docs.withColumn("doc_tokens", tokens.count(F.col("text")))
    over = F.col("doc_tokens") + F.lit(topic_tokens) > room
    sized = sized.withColumn(
        "fit",
        F.when(~over, F.lit("whole"))
        .when(F.col("doc_tokens") > room - max_topic_tokens, F.lit("cut_document"))
        .otherwise(F.lit("prune_topics")),
    )
    cut = tokens.truncate(F.col("text"), room - max_topic_tokens)
    document = F.when(F.col("fit") == "cut_document", cut).otherwise(F.col("text"))
    left = F.greatest(room - max_topic_tokens, F.lit(0))
    sent = F.when(F.col("fit") == "cut_document", F.least(F.col("doc_tokens"), left)).otherwise(F.col("doc_tokens"))
    listed = F.lit(topic_tokens)
    # a list of at most max_topic_tokens is never the part that does not fit
    if topic_tokens > max_topic_tokens:
        prune = F.col("fit") == "prune_topics"
        budget = F.when(prune, room - F.col("doc_tokens")).otherwise(F.lit(0))
        sized = sized.withColumn("__prune", prune)
        sized = budgeted_list(sized, labelled_topics(tree, with_desc, tokens, encode), budget, "text", encode or hashed_terms(), "__prune")
        own = F.when(F.col("__prune"), F.coalesce("listed", F.lit("")))
        listed = F.when(prune, F.coalesce("listed_tokens", F.lit(0))).otherwise(listed)
    return _with_tokens(sized, template, tokens, Document=sent, Topics=listed), document, own, whole


def generation_prompts(docs: DataFrame, tree: DataFrame, template: str, *args, **options) -> DataFrame:
    """Adds ``fit`` and ``prompt`` for the first stage.

    ``whole``: template, document and topics fit the context.  ``cut_document``:
    the document leaves less than ``max_topic_tokens`` and is cut to leave that,
    the topics stay whole.  ``prune_topics``: the topics most similar to the
    document stay, as far as they fit (labels with descriptions if ``with_desc``).
    """
    sized, document, own, whole = _generation(docs, tree, template, *args, **options)
    topics = whole if own is None else F.when(F.col("__prune"), own).otherwise(whole)
    return sized.withColumn("prompt", X.fill_template(template, Document=document, Topics=topics)).drop("__prune", "listed", "listed_tokens")


def generation_parts(docs: DataFrame, tree: DataFrame, template: str, *args, **options) -> tuple[DataFrame, Parts]:
    """``generation_prompts`` for a completer: the whole list goes to the workers once, which put the prompts together."""
    sized, document, own, whole = _generation(docs, tree, template, *args, **options)
    listed = docs.sparkSession.range(1).select(whole).first()[0]
    sized = sized.withColumn("__document", document).withColumn("__topics", F.lit(None).cast("string") if own is None else own)
    return sized.drop("__prune", "listed", "listed_tokens"), Parts(template, {"Document": ("__document", None), "Topics": ("__topics", listed)})


def assign_prompts(
    docs: DataFrame,
    tree: DataFrame,
    template: str,
    context_len: int,
    tokens: X.TokenCounter = X.DEFAULT_TOKENS,
    encode=None,
) -> DataFrame:
    """Adds ``prompted_docs`` (the document, cut to the room left) and ``prompt``.

    Only a tree longer than the context is pruned, per document.
    """
    tree_tokens = list_tokens(tree, True, tokens)
    if tree_tokens <= context_len:
        shown, shown_tokens = list_text(tree, desc=True), F.lit(tree_tokens)
    else:
        topics = labelled_topics(tree, True, tokens, encode)
        docs = budgeted_list(docs, topics, F.lit(context_len), "text", encode or hashed_terms())
        shown, shown_tokens = F.coalesce("listed", F.lit("")), F.coalesce("listed_tokens", F.lit(0))
    room = F.lit(context_len) - tokens.count(F.lit(template)) - shown_tokens
    out = docs.withColumn("prompted_docs", tokens.truncate(F.col("text"), room))
    prompt = X.fill_template(template, Document=F.col("prompted_docs"), tree=shown)
    out = _with_tokens(out.withColumn("prompt", prompt), template, tokens, Document=tokens.count(F.col("prompted_docs")), tree=shown_tokens)
    return out.drop("listed", "listed_tokens")


def correct_prompts(
    docs: DataFrame,
    tree: DataFrame,
    template: str,
    context_len: int,
    floor: int = G.CORRECTION_TOPIC_FLOOR,
    tokens: X.TokenCounter = X.DEFAULT_TOKENS,
    encode=None,
    longest: int | None = None,
) -> DataFrame:
    """Adds ``prompt`` asking again for ``prompted_docs``, given ``responses``.

    Where document, template and tree exceed the context, the least similar
    topics go until the list fits half of it (but ``floor`` topics stay), and
    the document is cut to what is left.  ``longest``, the characters of the
    longest document where known, spares the ranking if none can exceed it: a
    token of the default counter has a character at least.
    """
    before, after = G.REASSIGN_MESSAGE
    message = F.concat(F.lit(before), F.col("responses"), F.lit(after))
    doc = F.col("prompted_docs")
    template_tokens = tokens.count(F.lit(template))
    tree_tokens = list_tokens(tree, True, tokens)
    whole = list_text(tree, desc=True)
    if longest is not None and tokens is X.DEFAULT_TOKENS and longest + len(template) + tree_tokens <= context_len:
        made = docs.withColumn("prompt", X.fill_template(template, Document=doc, tree=whole, Message=message))
        return _with_tokens(made, template, tokens, Document=tokens.count(doc), tree=F.lit(tree_tokens), Message=tokens.count(message))
    over = tokens.count(doc) + template_tokens + F.lit(tree_tokens) > F.lit(context_len)
    marked = docs.withColumn("__over", over)
    topics = labelled_topics(tree, True, tokens, encode)
    ranked = half_context_list(marked, topics, context_len, floor, "prompted_docs", encode or hashed_terms(), "__over")
    kept = F.coalesce("listed_tokens", F.lit(0))
    room = F.lit(context_len) - template_tokens - kept
    cut = F.when(F.col("__over"), tokens.truncate(doc, room)).otherwise(doc)
    shown = F.when(F.col("__over"), F.coalesce("listed", F.lit(""))).otherwise(whole)
    prompt = X.fill_template(template, Document=cut, tree=shown, Message=message)
    doc_tokens, listed = tokens.count(doc), F.when(F.col("__over"), kept).otherwise(F.lit(tree_tokens))
    sent = F.when(F.col("__over"), F.least(doc_tokens, F.greatest(room, F.lit(0)))).otherwise(doc_tokens)
    ranked = _with_tokens(ranked.withColumn("prompt", prompt), template, tokens, Document=sent, tree=listed, Message=tokens.count(message))
    return ranked.drop("__over", "listed", "listed_tokens")


def subtopic_budget(template: str, context_len: int, max_tokens: int) -> Column:
    """Tokens left for documents; the reply is subtracted here once more."""
    return F.lit(context_len) - X.count_tokens(F.lit(template)) - F.lit(max_tokens)


def subtopic_prompts(packed: DataFrame, template: str) -> DataFrame:
    """Adds ``prompt`` to packed documents (``topic``, ``text``)."""
    return packed.withColumn(
        "prompt", X.fill_template(template, Topic=F.col("topic"), Document=F.col("text"))
    )


def refine_prompt(pairs: DataFrame, template: str) -> DataFrame:
    """One row: the prompt for the selected pairs, best first."""
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "i", "j", "a", "b")))
    labels = F.flatten(F.transform(ordered, lambda p: F.array(p["a"], p["b"])))
    joined = pairs.agg(F.array_join(labels, "\n").alias("topics"), F.count(F.lit(1)).alias("pairs"))
    return joined.filter("pairs > 0").select("topics", X.fill_template(template, Topics=F.col("topics")).alias("prompt"))
