"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from corpusgrove.catalog import stub
from corpusgrove.functions import text as X, vectors as V
from corpusgrove.operators import (
    backend as B,
    fold,
    grounding as R,
    merge as Mg,
    metrics as M,
    packing,
    prompts as P,
    responses as L,
    similarity as S,
    subtopics as Sub,
    tree as T,
)
from corpusgrove.plans.assign import assign_topics as assign_plan, correct_topics
from corpusgrove.plans.generate import generate_topics_level1, generate_topics_level2
from corpusgrove.plans.refine import refine_topics as refine_plan
from corpusgrove.plans.stages import run_stages
from corpusgrove.schema import CREATED_BASE, node_ordinal
from corpusgrove.sources import documents as SD, topics as ST
from corpusgrove.storage import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PATIENCE = 5
RARE = 0.002
PACK_BUDGET = 3000
PAIR_THRESHOLD = 0.3
REFINED = 0.003
LINKS = 64
SMALL_CONTEXT, FIRST_ROUND = 900, 512


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


# ------------------------------------------------------------ shared inputs


def topic_lines(answers: DataFrame) -> DataFrame:
    return L.level_gate(L.response_lines(answers))


def topics(answers: DataFrame) -> DataFrame:
    return fold.topic_counts(topic_lines(answers))


def frequent_topics(answers: DataFrame) -> DataFrame:
    tree = materialize(topics(answers), "topics")
    return materialize(T.remove_rare_topics(tree, RARE), "frequent")


def source_tree(spark, sf) -> DataFrame:
    """Sources on level 1, their languages on level 2, document counts."""
    docs = stub.documents(spark, sf)
    heads = docs.groupBy("source").agg(F.min("doc_idx").alias("head"), F.count(F.lit(1)).alias("count"))
    langs = docs.groupBy("source", "lang").agg(F.min("doc_idx").alias("at"), F.count(F.lit(1)).alias("count"))
    level1 = heads.select(
        F.array("head").alias("path"),
        F.lit(1).alias("lvl"),
        F.col("source").alias("name"),
        "count",
        F.concat(F.lit("Documents of "), "source").alias("desc"),
    )
    level2 = langs.join(heads.select("source", "head"), "source").select(
        F.array("head", "at").alias("path"),
        F.lit(2).alias("lvl"),
        F.col("lang").alias("name"),
        "count",
        F.when(F.col("lang") == "es", "").otherwise(F.concat(F.lit("Documents in "), "lang")).alias("desc"),
    )
    return level1.unionByName(level2)


def embeddings(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def cluster_topics(spark, sf) -> DataFrame:
    """One topic per embedding label: its first vector."""
    first = embeddings(spark, sf).groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    label = F.concat(F.lit("[1] Cluster "), F.col("label"), F.lit(": Vectors like the first of "), F.col("label"))
    return first.select(F.col("label").cast("long").alias("ord"), label.alias("label"), X.count_tokens(label).alias("tokens"), "embedding")


def path_text() -> Column:
    return F.array_join(F.col("path").cast("array<string>"), "/")


# ------------------------------------------------------------ level 1


@query
def topic_counts(spark, sf):
    answers = stub.answered(spark, sf)
    return topics(answers).select("name", "count", "desc")


@query
def first_seen_desc(spark, sf):
    answers = stub.answered(spark, sf)
    return fold.first_seen_desc(topic_lines(answers))


def lang_seeds(lines: DataFrame, docs: DataFrame) -> DataFrame:
    """The most used topic of every language, as seed nodes."""
    used = lines.join(docs.select("doc_idx", "lang"), "doc_idx").groupBy("lang", F.lower("name").alias("key")).count()
    top = used.groupBy("lang").agg(F.min_by("key", F.struct((-F.col("count")).alias("c"), "key")).alias("key"))
    order = F.array_position(F.array(*map(F.lit, ["de", "en", "es", "fr"])), F.col("lang"))
    return top.select(
        F.array(order.cast("long")).alias("path"),
        F.lit(1).alias("lvl"),
        F.upper("key").alias("name"),
        F.lit(1).cast("long").alias("count"),
        F.lit("").alias("desc"),
    )


@query
def seed_aware_counts(spark, sf):
    answers = stub.answered(spark, sf)
    lines = topic_lines(answers)
    seeds = lang_seeds(lines, stub.documents(spark, sf))
    return fold.topic_counts(lines, seeds).select("name", "count", "desc")


@query
def match_existing(spark, sf):
    answers = stub.answered(spark, sf)
    lines = topic_lines(answers).withColumn("lvl", F.lit(1))
    matched = fold.match_existing(lines, frequent_topics(answers))
    return matched.select("doc_idx", "line_idx", "name", "node_name")


@query
def early_stop_position(spark, sf):
    answers = stub.answered(spark, sf)
    numbered = materialize(fold.number_lines(topic_lines(answers)), "lines")
    return fold.early_stop_position(numbered, PATIENCE).select("doc_idx", "line_idx", "g")


@query
def early_stop_kept_docs(spark, sf):
    answers = stub.answered(spark, sf)
    numbered = materialize(fold.number_lines(topic_lines(answers)), "lines")
    stop = fold.early_stop_position(numbered, PATIENCE)
    return fold.early_stop_kept_docs(answers, stop).select("doc_idx", "responses")


@query
def early_stop_counts(spark, sf):
    answers = stub.answered(spark, sf)
    numbered = materialize(fold.number_lines(topic_lines(answers)), "lines")
    kept = fold.lines_until(numbered, fold.early_stop_position(numbered, PATIENCE))
    return fold.topic_counts(kept).select("name", "count")


@query
def stop_on_error_docs(spark, sf):
    answers = stub.answered(spark, sf)
    return fold.stop_on_error(answers).select("doc_idx", "status")


@query
def level1_rejects(spark, sf):
    answers = stub.answered(spark, sf)
    return L.level1_rejects(L.response_lines(answers))


@query
def level_gate(spark, sf):
    answers = stub.answered(spark, sf)
    return topic_lines(answers)


# ------------------------------------------------------------ documents and topics


def _labels(tree: DataFrame) -> DataFrame:
    return tree.select(X.label_of().alias("label"))


def _doc_topics(answers: DataFrame) -> DataFrame:
    return Sub.doc_topics(answers, _labels(frequent_topics(answers)))


@query
def doc_topics(spark, sf):
    answers = stub.answered(spark, sf)
    return _doc_topics(answers).select("doc_idx", F.array_join("topics", "|").alias("topics"))


@query
def docs_with_topics(spark, sf):
    answers = stub.answered(spark, sf)
    return Sub.docs_with_topics(_doc_topics(answers)).select("doc_idx")


def _mentions(answers: DataFrame) -> DataFrame:
    return Sub.topic_mentions(answers, _labels(frequent_topics(answers)))


@query
def doc_frequency(spark, sf):
    answers = stub.answered(spark, sf)
    return Sub.doc_frequency(_mentions(answers))


@query
def docs_for_topic(spark, sf):
    answers = stub.answered(spark, sf)
    mentions = materialize(_mentions(answers), "mentions")
    wanted = T.expandable_topics(frequent_topics(answers), F.lit(1000), 0.01)
    return Sub.docs_for_topics(mentions, _labels(wanted))


@query
def expandable_topics(spark, sf):
    answers = stub.answered(spark, sf)
    tree = frequent_topics(answers)
    with_topics = Sub.docs_with_topics(Sub.doc_topics(answers, _labels(tree)))
    return T.expandable_topics(tree, with_topics.agg(F.count(F.lit(1))).scalar(), 0.005).select("name", "count")


@query
def cap_parents(spark, sf):
    answers = stub.answered(spark, sf)
    tree = materialize(topics(answers), "topics")
    docs = stub.documents(spark, sf).agg(F.count(F.lit(1))).scalar()
    return T.expandable_topics(tree, docs, 0.005, 10).select("name", "count")


@query
def expandable_leaves(spark, sf):
    tree = materialize(source_tree(spark, sf), "tree")
    docs = stub.documents(spark, sf).agg(F.count(F.lit(1))).scalar()
    return T.expandable_topics(tree, docs, 0.01).select(path_text().alias("path"), "name", "count")


@query
def remove_rare_topics(spark, sf):
    answers = stub.answered(spark, sf)
    return frequent_topics(answers).select("name", "count")


@query
def level1_total(spark, sf):
    answers = stub.answered(spark, sf)
    return T.level1_total(topics(answers))


# ------------------------------------------------------------ trees


@query
def topic_labels(spark, sf):
    answers = stub.answered(spark, sf)
    return T.topic_labels(topics(answers)).drop("path")


@query
def topic_list(spark, sf):
    answers = stub.answered(spark, sf)
    tree = materialize(topics(answers), "topics")
    return T.topic_list(tree, desc=True, count=False).select("position", "label")


@query
def preorder(spark, sf):
    tree = materialize(source_tree(spark, sf), "tree")
    return T.topic_list(tree, desc=False, count=True).select("position", "label")


@query
def topic_names(spark, sf):
    return T.topic_names(source_tree(spark, sf))


@query
def tree_view(spark, sf):
    return T.tree_view(source_tree(spark, sf)).select(path_text().alias("path"), "line")


def _word_lines(spark, sf) -> DataFrame:
    """Every document as one tree line; the language sets the level."""
    level = F.when(F.col("lang") == "en", 1).when(F.col("lang") == "fr", 3).otherwise(2)
    return stub.worded(spark, sf).select(
        F.col("doc_idx").alias("line_no"),
        level.alias("lvl"),
        F.coalesce(F.get("words", F.lit(0)), F.lit("none")).alias("name"),
        F.lit(1).cast("long").alias("count"),
        F.col("source").alias("desc"),
    )


@query
def resolve_parents(spark, sf):
    return T.resolve_parents(_word_lines(spark, sf)).select(path_text().alias("path"), "lvl", "name", "count", "desc")


@query
def topic_file_round_trip(spark, sf):
    path = scratch_path(spark, "topic-file")
    ST.write_topics(source_tree(spark, sf), path)
    tree = materialize(ST.read_topics(spark, path), "read-topics")
    above = tree.filter("lvl = 1").select("path", F.col("name").alias("parent"))
    nested = tree.withColumn("path", T.parent_path()).join(above, "path", "left")
    return nested.select("lvl", "name", "count", "desc", F.coalesce("parent", F.lit("")).alias("parent"))


@query
def topic_file_rejects(spark, sf):
    """Responses as topic file lines: level-1 lines are given a count and are valid, the rest is rejected."""
    answers = stub.answered(spark, sf)
    lines = L.response_lines(answers).select("doc_idx", F.col("line_idx").alias("line_no"), "line")
    counted = F.when(F.col("line").startswith("[1]"), F.regexp_replace("line", ":", " (Count: 3):")).otherwise(F.col("line"))
    parsed = ST.parse_topic_lines(lines.withColumn("line", counted).withColumn("line_no", fold.line_ordinal("doc_idx", "line_no")))
    return parsed.groupBy("valid", "lvl", "count").agg(F.count(F.lit(1)).alias("lines"), F.countDistinct("name").alias("names"))


@query
def remove_topic(spark, sf):
    tree = materialize(source_tree(spark, sf), "tree")
    keys = spark.createDataFrame([("fr", 2), ("src3", 1), ("absent", 1)], "name string, lvl int")
    return T.remove_topic(tree, keys).select(path_text().alias("path"), "name", "count")


@query
def add_topic(spark, sf):
    """Every document adds its language under its source, new and known."""
    tree = materialize(source_tree(spark, sf), "tree")
    heads = tree.filter("lvl = 1").select(F.col("path").alias("parent"), F.col("name").alias("source"))
    docs = stub.documents(spark, sf).select(
        "source", F.when(F.col("doc_idx") % 3 == 0, F.concat(F.lit("late "), "lang")).otherwise(F.col("lang")).alias("name"),
        F.col("doc_idx").alias("d"),
    )
    additions = docs.join(heads, "source").select(
        "parent", F.lit(2).alias("lvl"), "name", F.lit(1).cast("long").alias("count"),
        F.lit("added").alias("desc"), (F.lit(CREATED_BASE) + F.col("d")).alias("ordinal"),
    )
    return T.add_topics(tree, additions).select("lvl", "name", "count", "desc", F.col("path")[0].alias("head"))


@query
def seed_tree(spark, sf):
    answers = stub.answered(spark, sf)
    path = scratch_path(spark, "seed-file")
    lines = topics(answers).select("path", F.concat(X.label_of(), F.lit(": "), "desc").alias("value"))
    lines.orderBy("path").select("value").write.text(path)
    return ST.read_seed(spark, path).select("lvl", "name", "count", "desc")


# ------------------------------------------------------------ tokens and prompts


@query
def token_counts(spark, sf):
    return stub.documents(spark, sf).select("doc_idx", X.count_tokens(F.col("text")).alias("tokens"))


@query
def truncate_tokens(spark, sf):
    return stub.documents(spark, sf).select("doc_idx", X.truncate_tokens(F.col("text"), 200).alias("text"))


@query
def user_token_counter(spark, sf):
    words = X.TokenCounter(count=lambda c: F.size(F.split(F.btrim(c), r"[ \n]+", -1)).cast("long"))
    return stub.documents(spark, sf).select("doc_idx", words.count(F.col("text")).alias("tokens"))


@query
def prompt_sizes(spark, sf):
    answers = stub.answered(spark, sf)
    tree = materialize(topics(answers), "topics")
    room = P.list_tokens(tree, False, X.DEFAULT_TOKENS, strip_desc=True) + 600
    sized = P.generation_prompts(stub.documents(spark, sf), tree, stub.GENERATION_TEMPLATE, room)
    return sized.select("doc_idx", "fit", "doc_tokens")


@query
def generation_prompt(spark, sf):
    answers = stub.answered(spark, sf)
    tree = frequent_topics(answers)
    made = P.generation_prompts(stub.documents(spark, sf), tree, stub.GENERATION_TEMPLATE, 1_000_000)
    return made.select("doc_idx", F.md5("prompt").alias("prompt_md5"), X.count_tokens(F.col("prompt")).alias("tokens"))


@query
def generation_prompt_budget(spark, sf):
    """Whole, cut and pruned prompts: the list fits, but not with every document."""
    tree = materialize(topics(stub.answered(spark, sf)), "topics")
    room = P.list_tokens(tree, False, X.DEFAULT_TOKENS, strip_desc=True) + 600
    made = P.generation_prompts(stub.documents(spark, sf), tree, stub.GENERATION_TEMPLATE, room)
    return made.select("doc_idx", "fit", F.md5("prompt").alias("prompt_md5"))


@query
def assign_prompt_pruned(spark, sf):
    """Half of the tree fits the context."""
    tree = frequent_topics(stub.answered(spark, sf))
    context = P.list_tokens(tree, True, X.DEFAULT_TOKENS) // 2
    made = P.assign_prompts(stub.documents(spark, sf), tree, stub.ASSIGN_TEMPLATE, context)
    return made.select("doc_idx", "prompted_docs", F.md5("prompt").alias("prompt_md5"))


@query
def assign_prompt(spark, sf):
    answers = stub.answered(spark, sf)
    tree = frequent_topics(answers)
    context = P.list_tokens(tree, True, X.DEFAULT_TOKENS) + 300
    made = P.assign_prompts(stub.documents(spark, sf), tree, stub.ASSIGN_TEMPLATE, context)
    return made.select("doc_idx", "prompted_docs", F.md5("prompt").alias("prompt_md5"))


def _lang_packed(spark, sf) -> DataFrame:
    docs = stub.documents(spark, sf)
    return packing.pack_documents(
        docs.select("doc_idx", "text"), docs.select(F.col("lang").alias("topic"), "doc_idx"), ["topic"], PACK_BUDGET
    )


@query
def pack_documents(spark, sf):
    return _lang_packed(spark, sf).select("topic", "batch_id", "n_docs", "n_tokens", F.md5("text").alias("text_md5"))


@query
def subtopic_prompts(spark, sf):
    path = scratch_path(spark, "subtopic-prompts")
    made = P.subtopic_prompts(_lang_packed(spark, sf), stub.SUBTOPIC_TEMPLATE)
    ST.write_subtopic_prompts(
        made.select("text", F.md5("prompt").alias("topics"), F.lit("ok").alias("status")), path
    )
    back = spark.read.schema("text string, topics string, status string").json(path)
    return back.select(F.md5("text").alias("text_md5"), F.col("topics").alias("prompt_md5"), "status")


# ------------------------------------------------------------ similarity


@query
def embedding_cosine(spark, sf):
    first = cluster_topics(spark, sf).select(F.col("ord").alias("label"), F.col("embedding").alias("other"))
    pairs = embeddings(spark, sf).join(first, "label")
    return pairs.select("vec_id", F.round(V.cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


@query
def embed_documents(spark, sf):
    # hashing a word costs more than all else here; workers remember the words they have met
    vectors = stub.documents(spark, sf).select("doc_idx", V.embed(F.col("text"), V.hashed_terms()).alias("v"))
    return vectors.select("doc_idx", F.posexplode("v").alias("dim", "weight")).filter("weight > 0")


def _ranked(df: DataFrame) -> DataFrame:
    return df.select("vec_id", F.posexplode("ranked").alias("position", "r")).select(
        "vec_id", "position", F.col("r.label").alias("topic"), F.round("r.similarity", 6).alias("similarity")
    )


@query
def similar_topics(spark, sf):
    return _ranked(S.similar_topics(embeddings(spark, sf), cluster_topics(spark, sf), 3))


@query
def budgeted_topics(spark, sf):
    budget = F.lit(20) + F.col("vec_id") % 40
    return _ranked(S.budgeted_topics(embeddings(spark, sf), cluster_topics(spark, sf), budget))


@query
def half_context_topics(spark, sf):
    return _ranked(S.half_context_topics(embeddings(spark, sf), cluster_topics(spark, sf), 80, 5))


def _labelled_vectors(spark, sf) -> DataFrame:
    return embeddings(spark, sf).select(F.col("vec_id").alias("ord"), "embedding", F.concat(F.lit("[1] Vector "), "vec_id").alias("label"))


def _vector_pairs(spark, sf) -> DataFrame:
    vectors = _labelled_vectors(spark, sf)
    return S.label_pairs(S.topic_pairs(vectors.select("ord", "embedding"), PAIR_THRESHOLD), vectors.select("ord", "label"))


@query
def topic_pairs(spark, sf):
    return _vector_pairs(spark, sf).select("i", "j", F.round("score", 6).alias("score"))


def _asked(pairs: DataFrame) -> DataFrame:
    """Pairs of an even and an odd vector count as asked, the wrong way round."""
    odd = pairs.filter((F.col("i") + F.col("j")) % 2 == 1)
    return S.prompted_pairs(None, odd.select(F.array_sort(F.array("b", "a")).alias("pair")))


@query
def unprompted_pairs(spark, sf):
    pairs = materialize(_vector_pairs(spark, sf).drop("score"), "pairs", "zstd")
    return S.unprompted_pairs(pairs, _asked(pairs)).select("i", "j")


@query
def prompted_pairs(spark, sf):
    pairs = materialize(_vector_pairs(spark, sf).drop("score"), "pairs", "zstd")
    grown = S.prompted_pairs(_asked(pairs), pairs.filter("i % 3 = 0"))
    return grown.select(F.array_join("pair", " + ").alias("pair"))


@query
def top_pairs(spark, sf):
    best = S.best_label_pairs(_labelled_vectors(spark, sf), 2, PAIR_THRESHOLD)
    return best.select("i", "j", F.round("score", 6).alias("score"))


@query
def refine_prompt(spark, sf):
    best = S.best_label_pairs(_labelled_vectors(spark, sf), 2, PAIR_THRESHOLD)
    return P.refine_prompt(best, stub.REFINE_TEMPLATE).select("prompt")


# ------------------------------------------------------------ merging


def _merge_answers(spark, sf) -> DataFrame:
    return stub.worded(spark, sf).select("doc_idx", stub.merge_response(F.col("words")).alias("responses"))


@query
def merge_lines(spark, sf):
    return L.parse_merge_lines(_merge_answers(spark, sf))


def _originals(spark, sf) -> DataFrame:
    return L.explode_originals(L.parse_merge_lines(_merge_answers(spark, sf)))


@query
def merge_originals(spark, sf):
    return _originals(spark, sf).select("doc_idx", "pos", "new_name", "old_name", "old_lvl")


def _merges(spark, sf) -> DataFrame:
    return _originals(spark, sf).select(F.col("doc_idx").alias("merge_id"), "pos", "new_name", "new_desc", "old_name", "old_lvl")


@query
def merge_nodes(spark, sf):
    answers = stub.answered(spark, sf)
    tree = materialize(topics(answers), "topics")
    return Mg.merge_nodes(tree, _merges(spark, sf)).select("merge_id", "pos", "name", "count")


@query
def merge_counts(spark, sf):
    answers = stub.answered(spark, sf)
    tree = frequent_topics(answers)
    merges = materialize(_merges(spark, sf), "merges")
    return Mg.merge_counts(tree, merges).select("merge_id", "new_name", "count")


@query
def apply_merge(spark, sf):
    """Topics sharing their first seven letters become one."""
    answers = stub.answered(spark, sf)
    tree = materialize(topics(answers), "topics")
    stem = F.substring(F.lower("name"), 1, 7)
    stems = tree.groupBy(stem.alias("stem")).agg(F.min(T.ordinal()).alias("at"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    merges = tree.withColumn("stem", stem).join(stems, "stem").select(
        (F.col("at") - CREATED_BASE).alias("merge_id"),
        T.ordinal().alias("pos"),
        stub.capital(F.col("stem")).alias("new_name"),
        F.concat(F.lit("Words on "), "stem").alias("new_desc"),
        F.col("name").alias("old_name"),
        F.lit(1).alias("old_lvl"),
    )
    return Mg.apply_merges(tree, merges).select("name", "count", "desc")


@query
def apply_merge_overlapping(spark, sf):
    """Topics sharing seven letters are merged one after another into a growing group; every topic has a child."""
    answers = stub.answered(spark, sf)
    heads = materialize(topics(answers), "topics")
    kid = F.concat(F.lit("Kid of "), "name")
    kids = heads.select(F.concat("path", F.array(F.lit(0).cast("long"))).alias("path"), F.lit(2).alias("lvl"), kid.alias("name"), F.lit(1).cast("long").alias("count"), F.lit("kid").alias("desc"))
    stem = F.substring(F.lower("name"), 1, 7).alias("stem")
    ranked = heads.select(stem, "name", T.ordinal().alias("at")).withColumn("k", F.row_number().over(W.partitionBy("stem").orderBy("at")))
    before = F.lag("name").over(W.partitionBy("stem").orderBy("at"))
    group = F.concat(F.lit("Group "), "stem")
    listed = F.array(F.when(F.col("k") == 2, F.col("before")).otherwise(group), F.col("name"), F.concat(F.lit("Unknown "), "stem"))
    merges = ranked.withColumn("before", before).filter("k > 1").select(
        (F.col("at") - CREATED_BASE).alias("merge_id"), group.alias("new_name"), F.concat(F.lit("Step "), F.col("k") - 1).alias("new_desc"),
        F.posexplode(listed).alias("pos", "old_name"), F.lit(1).alias("old_lvl"),
    )
    return Mg.apply_merges(heads.select(*T.NODE).unionByName(kids), merges).select("lvl", "name", "count", "desc")


def _mapping(spark, sf) -> DataFrame:
    seq = node_ordinal(0, F.col("doc_idx"), F.col("pos"))
    return Mg.merge_mapping(None, _originals(spark, sf).withColumn("seq", seq))


@query
def merge_mapping(spark, sf):
    earlier = _originals(spark, sf).filter("doc_idx % 2 = 0").select(
        node_ordinal(0, F.col("doc_idx"), F.col("pos")).alias("seq"), F.col("old_name").alias("old"), F.lit("Earlier").alias("new")
    )
    once = earlier.groupBy("old").agg(F.min("seq").alias("seq"), F.first("new").alias("new"))
    seq = node_ordinal(0, F.col("doc_idx"), F.col("pos"))
    later = _originals(spark, sf).filter("doc_idx % 2 = 1").withColumn("seq", seq)
    return Mg.merge_mapping(once, later).select("old", "new", (F.col("seq") >= CREATED_BASE).alias("added"))


def _source_mapping(spark, sf) -> DataFrame:
    """Each source is renamed; ``src1`` also hits inside ``src10``."""
    docs = stub.documents(spark, sf)
    first = docs.groupBy("source").agg(F.min("doc_idx").alias("seq"))
    return first.select("seq", F.col("source").alias("old"), F.concat(F.lit("origin "), F.substring("source", 4, 9)).alias("new"))


@query
def rewrite_topics(spark, sf):
    answers = stub.answered(spark, sf)
    out = Mg.rewrite_documents(answers, _source_mapping(spark, sf), "responses")
    return out.select("doc_idx", "refined_responses")


@query
def mapping_round_trip(spark, sf):
    path = scratch_path(spark, "mapping")
    ST.write_mapping(_mapping(spark, sf), path)
    return ST.read_mapping(spark, path)


@query
def mapping_object_round_trip(spark, sf):
    """The same through the one JSON object of a ``.json`` path, written twice."""
    path = scratch_path(spark, "mapping") + ".json"
    mapping = _mapping(spark, sf)
    ST.write_mapping(mapping.limit(0), path)
    ST.write_mapping(mapping, path)
    return ST.read_mapping(spark, path)


# ------------------------------------------------------------ subtopics


def _subtopic_answers(spark, sf) -> DataFrame:
    return stub.worded(spark, sf).select(
        F.col("doc_idx").alias("prompt_idx"), stub.subtopic_response(F.col("words"), F.col("lang")).alias("topics")
    )


@query
def subtopic_lines(spark, sf):
    lines = L.parse_subtopic_lines(_subtopic_answers(spark, sf), "topics", ["prompt_idx"])
    return lines.withColumn("documents", F.array_join(F.col("documents").cast("array<string>"), ","))


@query
def subtopic_parent(spark, sf):
    """Subtopics of every document under the frequent topics."""
    answers = stub.answered(spark, sf)
    tree = frequent_topics(answers)
    grown = materialize(Sub.fold_subtopics(tree, _subtopic_answers(spark, sf)), "grown")
    above = grown.select(F.col("path").alias("up"), F.col("name").alias("parent"))
    nested = grown.withColumn("up", T.parent_path()).join(above, "up", "left")
    return nested.select(F.coalesce("parent", F.lit("")).alias("parent"), "lvl", "name", "count", "desc")


@query
def subtopic_chain(spark, sf):
    """Every document adds a subtopic below that of the document before it, in chains of ``LINKS`` links."""
    d = F.col("doc_idx")
    name = lambda n: F.concat(F.lit("Chain "), F.expr(f"doc_idx div {LINKS}"), F.lit(" link "), n)
    link = d % LINKS
    above = F.when(link == 0, F.lit("[1] Roots")).otherwise(F.concat(F.lit("[2] "), name(link - 1)))
    answer = F.concat(above, F.lit("\n    [2] "), name(link), F.lit(" (Document: 1): part "), link, F.lit("."))
    answers = stub.documents(spark, sf).select(d.alias("prompt_idx"), answer.alias("topics"))
    tree = spark.createDataFrame([([0], 1, "Roots", 1, "of all chains")], "path array<long>, lvl int, name string, count long, desc string")
    grown = materialize(Sub.fold_subtopics(tree, answers), "grown")
    above = grown.select(F.col("path").alias("up"), F.col("name").alias("parent"))
    nested = grown.withColumn("up", T.parent_path()).join(above, "up", "left")
    return nested.select(F.coalesce("parent", F.lit("")).alias("parent"), "lvl", "name", "count", "desc")


# ------------------------------------------------------------ grounding


@query
def assigned_topics(spark, sf):
    answers = stub.answered(spark, sf)
    named = R.assignment_names(answers)
    return named.select("doc_idx", F.array_join("topics", "|").alias("topics"))


@query
def grounding_errors(spark, sf):
    answers = stub.answered(spark, sf)
    return R.grounding_errors(answers).select("doc_idx")


@query
def grounding_hallucinated(spark, sf):
    answers = stub.answered(spark, sf)
    return R.grounding_hallucinated(answers, T.topic_names(frequent_topics(answers)))


@query
def ungrounded_topics(spark, sf):
    answers = stub.answered(spark, sf)
    return R.ungrounded_topics(answers, T.topic_names(frequent_topics(answers)))


@query
def grounding_report(spark, sf):
    answers = stub.answered(spark, sf)
    return R.grounding_report(answers, T.topic_names(frequent_topics(answers)))


@query
def reprompt_set(spark, sf):
    answers = stub.answered(spark, sf)
    return R.reprompt_set(answers, T.topic_names(frequent_topics(answers)))


@query
def apply_corrections(spark, sf):
    answers = stub.answered(spark, sf)
    bad = R.reprompt_set(answers, T.topic_names(frequent_topics(answers)))
    corrections = bad.select("doc_idx", F.concat(F.lit("[1] Repaired: was "), "reason").alias("response"))
    return R.apply_corrections(answers, corrections).select("doc_idx", "responses")


def _with_text(spark, sf, *more: str) -> DataFrame:
    docs = stub.documents(spark, sf)
    response = stub.level1_response(stub.top_words(F.col("text")), F.col("doc_idx"), F.col("source"))
    return docs.select("doc_idx", *more, F.col("text").alias("prompted_docs"), response.alias("responses"))


@query
def correct_until_grounded(spark, sf):
    docs = materialize(_with_text(spark, sf), "assigned")
    tree = frequent_topics(docs)
    backend = B.Backend(B.one_by_one(stub.first_listed))
    out = correct_topics(docs, tree, backend, stub.CORRECT_TEMPLATE, 1_000_000, max_rounds=3)
    return out.select("doc_idx", "responses")


@query
def correct_rounds(spark, sf):
    """Two rounds with answers that are wrong once or twice; the latter stay wrong."""
    docs = materialize(_with_text(spark, sf), "assigned")
    backend = B.Backend(B.one_by_one(stub.learn_slowly))
    out = correct_topics(docs, frequent_topics(docs), backend, stub.CORRECT_TEMPLATE, 1_000_000, max_rounds=2)
    return out.select("doc_idx", "responses")


@query
def correct_prompt(spark, sf):
    docs = materialize(_with_text(spark, sf), "assigned")
    tree = frequent_topics(docs)
    bad = R.reprompt_set(docs, T.topic_names(tree))
    again = docs.join(bad.select("doc_idx"), "doc_idx", "left_semi")
    made = P.correct_prompts(again, tree, stub.CORRECT_TEMPLATE, 1_000_000)
    return made.select("doc_idx", F.md5("prompt").alias("prompt_md5"))


@query
def correct_prompt_pruned(spark, sf):
    """The tree and 300 tokens fit the context, so long documents lose topics and text."""
    docs = materialize(_with_text(spark, sf), "assigned")
    tree = frequent_topics(docs)
    again = docs.join(R.reprompt_set(docs, T.topic_names(tree)).select("doc_idx"), "doc_idx", "left_semi")
    listed = P.list_tokens(tree, True, X.DEFAULT_TOKENS)
    made = P.correct_prompts(again, tree, stub.CORRECT_TEMPLATE, listed + 300, floor=10)
    room = listed + X.count_tokens(F.col("prompted_docs")) + X.count_tokens(F.lit(stub.CORRECT_TEMPLATE))
    return made.select("doc_idx", (room <= listed + 300).alias("fits"), F.md5("prompt").alias("prompt_md5"))


# ------------------------------------------------------------ metrics


def _cells(answers: DataFrame) -> DataFrame:
    """Language against first assigned topic."""
    docs = M.with_first_topic(answers, "responses", unmatched="own")
    return M.contingency(docs, "lang", "pred")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


@query
def first_topic(spark, sf):
    answers = stub.answered(spark, sf)
    return M.with_first_topic(answers, "responses", "topic", "own").select("doc_idx", "topic")


@query
def contingency(spark, sf):
    answers = stub.answered(spark, sf)
    return _cells(answers)


@query
def purity(spark, sf):
    answers = stub.answered(spark, sf)
    return _rounded(M.purity(_cells(answers)))


@query
def inverse_purity(spark, sf):
    answers = stub.answered(spark, sf)
    return _rounded(M.inverse_purity(_cells(answers)))


@query
def harmonic_purity(spark, sf):
    answers = stub.answered(spark, sf)
    return _rounded(M.harmonic_purity(_cells(answers)))


@query
def adjusted_rand(spark, sf):
    answers = stub.answered(spark, sf)
    return _rounded(M.adjusted_rand(_cells(answers)))


@query
def normalized_mi(spark, sf):
    answers = stub.answered(spark, sf)
    return _rounded(M.normalized_mi(_cells(answers)))


@query
def alignment_report(spark, sf):
    """Quality labels against the first topic, in any case."""
    answers = stub.answered(spark, sf)
    docs = M.with_first_topic(answers, "responses", unmatched="own")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").alias("doc_idx"), "quality")
    joined = docs.join(labels, "doc_idx").withColumn("pred", F.lower("pred"))
    return _rounded(M.alignment_report(M.contingency(joined, "quality", "pred")))


# ------------------------------------------------------------ completion


@query
def assign_topics(spark, sf):
    answers = stub.answered(spark, sf)
    tree = frequent_topics(answers)
    context = P.list_tokens(tree, True, X.DEFAULT_TOKENS) + 300
    docs = stub.documents(spark, sf).select("doc_idx", "text")
    out = assign_plan(docs, tree, B.Backend(B.one_by_one(stub.pick_topic)), stub.ASSIGN_TEMPLATE, context)
    return out.select("doc_idx", "responses", "status")


def _turns(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/conversations.parquet")


def _summary(prompts: list[str]) -> list[str]:
    return [f"{len(p)} characters, {p.count(' ')} blanks, last {p[-1:]}" for p in prompts]


@query
def complete_batches(spark, sf):
    out = B.complete(_turns(spark, sf), "text", _summary, batch_size=32)
    return out.select("conv_id", "turn", "response", "status", "attempts", "prompt_hash")


def _picky(prompts: list[str]) -> list[str]:
    for p in prompts:
        if len(p) % 7 == 0:
            raise ValueError(f"refused {len(p)} characters")
    return _summary(prompts)


@query
def failed_calls(spark, sf):
    """One refused prompt fails its batch; the others of it are asked alone."""
    out = B.complete(_turns(spark, sf), "text", _picky, batch_size=8, tries=1, wait=0.0)
    return B.failed_calls(out).select("conv_id", "turn", "response", "error")


@query
def stage_usage(spark, sf):
    out = B.complete(_turns(spark, sf), "text", _summary, batch_size=32)
    return B.usage_of_calls(out.withColumn("stage", F.col("role"))).withColumn("cost", F.round("cost", 6))


@query
def replay_responses(spark, sf):
    """Every turn answered by the turn after it, recorded twice."""
    turns = _turns(spark, sf)
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    recorded = turns.join(following, ["conv_id", "turn"]).select(B.prompt_hash(F.col("text")).alias("prompt_hash"), "response")
    asked = turns.select("conv_id", "turn", "text")
    return B.replay_responses(asked, "text", recorded.unionByName(recorded)).select("conv_id", "turn", "response", "status")


@query
def usage_report(spark, sf):
    docs = _with_text(spark, sf, "lang")
    calls = docs.select(F.col("lang").alias("stage"), F.col("prompted_docs").alias("prompt"), F.col("responses").alias("response"))
    return B.usage_report(calls).withColumn("cost", F.round("cost", 6))


@query
def error_rows(spark, sf):
    answers = stub.answered(spark, sf)
    return R.error_rows(answers).select("doc_idx", "responses")


# ------------------------------------------------------------ files and samples


@query
def corpus_round_trip(spark, sf):
    path = scratch_path(spark, "corpus")
    docs = stub.documents(spark, sf).select("doc_idx", "id", "text", F.col("lang").alias("label"))
    SD.write_documents(docs.orderBy("doc_idx"), path)
    return SD.read_corpus(spark, path).select("doc_idx", "id", "text", "label")


@query
def sample_corpus(spark, sf):
    return SD.sample_corpus(stub.documents(spark, sf).select("doc_idx", "lang"), 100, seed=7)


# ------------------------------------------------------------ whole stages


@query
def generate_level1(spark, sf):
    backend = B.Backend(B.one_by_one(stub.name_topics))
    docs = stub.documents(spark, sf).select("doc_idx", "text")
    tree, _ = generate_topics_level1(docs, backend, stub.GENERATION_TEMPLATE, context_len=10_000_000, first_round=512)
    return tree.select("name", "count", "desc")


@query
def generate_level1_budget(spark, sf):
    """A context that cuts long documents and, from the second round on, prunes topics."""
    backend = B.Backend(B.one_by_one(stub.name_topics))
    docs = stub.documents(spark, sf).select("doc_idx", "text")
    tree, _ = generate_topics_level1(docs, backend, stub.GENERATION_TEMPLATE, context_len=SMALL_CONTEXT, first_round=FIRST_ROUND)
    return tree.select("name", "count", "desc")


@query
def generate_level1_docs(spark, sf):
    """Documents kept by a run that stops early."""
    backend = B.Backend(B.one_by_one(stub.name_topics))
    docs = stub.documents(spark, sf).select("doc_idx", "text")
    _, kept = generate_topics_level1(
        docs, backend, stub.GENERATION_TEMPLATE, early_stop=PATIENCE, context_len=10_000_000, first_round=512
    )
    return kept.select("doc_idx", "responses")


@query
def generate_level2(spark, sf):
    docs = stub.documents(spark, sf)
    response = stub.level1_response(stub.top_words(F.col("text")), F.col("doc_idx"), F.col("source"))
    docs = materialize(docs.select("doc_idx", "text", response.alias("responses")), "documents")
    tree = fold.topic_counts(L.level_gate(L.response_lines(docs)))
    backend = B.Backend(B.one_by_one(stub.group_subtopic))
    context = PACK_BUDGET + 10
    grown, _ = generate_topics_level2(docs, tree, backend, stub.SUBTOPIC_TEMPLATE, context, max_tokens=5, share=0.005)
    return grown.select("lvl", "name", "count", "desc")


@query
def refine_topics(spark, sf):
    answers = stub.answered(spark, sf)
    docs = answers.select("doc_idx", "responses")
    tree = T.remove_rare_topics(materialize(topics(answers), "topics"), 0.01)
    backend = B.Backend(B.one_by_one(stub.merge_listed))
    tree, mapping, rewritten = refine_plan(tree, backend, stub.REFINE_TEMPLATE, docs, threshold=0.5)
    return rewritten.select("doc_idx", "refined_responses")


@query
def refine_rounds(spark, sf):
    """The tree after two rounds of refinement."""
    tree = T.remove_rare_topics(materialize(topics(stub.answered(spark, sf)), "topics"), REFINED)
    backend = B.Backend(B.one_by_one(stub.merge_listed))
    tree, _, _ = refine_plan(tree, backend, stub.REFINE_TEMPLATE, remove=False, threshold=0.5, max_rounds=2)
    return tree.select("name", "count", "desc")


@query
def all_stages(spark, sf):
    """Every stage from files to files; returns the corrected assignment."""
    base = scratch_path(spark, "stages")
    SD.write_documents(stub.documents(spark, sf).select("id", "text", F.col("lang").alias("label")), f"{base}/corpus")
    templates = {
        "generation": stub.GENERATION_TEMPLATE,
        "refinement": stub.REFINE_TEMPLATE,
        "generation_2": stub.SUBTOPIC_TEMPLATE,
        "assignment": stub.ASSIGN_TEMPLATE,
        "correction": stub.CORRECT_TEMPLATE,
    }
    config = {"data_sample": f"{base}/corpus", "refining_topics": True, "generate_subtopics": True}
    for stage, template in templates.items():
        spark.createDataFrame([(template,)], "value string").coalesce(1).write.text(f"{base}/{stage}-prompt")
        config[stage] = {
            "prompt": f"{base}/{stage}-prompt",
            "output": f"{base}/{stage}.jsonl",
            "topic_output": f"{base}/{stage}.md",
            "mapping_file": f"{base}/mapping",
        }
    config["options"] = {
        "generation": {"context_len": 10_000_000, "first_round": 512},
        "refinement": {"threshold": 0.95, "share": 0.004},
        "generation_2": {"context_len": 20_000, "max_tokens": 5},
        "assignment": {"context_len": 10_000_000},
        "correction": {"context_len": 10_000_000},
    }
    completers = {
        "generation": stub.name_initial,
        "refinement": stub.merge_listed,
        "generation_2": stub.group_subtopic,
        "assignment": stub.pick_topic,
        "correction": stub.first_listed,
    }
    backends = {stage: B.Backend(B.one_by_one(fn)) for stage, fn in completers.items()}
    return run_stages(spark, config, backends)["corrected"].select("id", "label", "responses")
