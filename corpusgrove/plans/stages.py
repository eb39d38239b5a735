"""All stages from one configuration, with their outputs on disk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusgrove.operators import metrics as M
from corpusgrove.operators.backend import Backend, usage_of_calls
from corpusgrove.operators import grounding as R
from corpusgrove.operators.tree import topic_names
from corpusgrove.plans.assign import KEPT, assign_topics, correct_topics
from corpusgrove.plans.manifest import Manifest, files_of
from corpusgrove.plans.generate import generate_topics_level1, generate_topics_level2
from corpusgrove.plans.refine import refine_topics
from corpusgrove.sources.documents import read_corpus, write_documents
from corpusgrove.sources.topics import read_mapping, read_seed, write_mapping, write_subtopic_prompts, write_topics
from corpusgrove.storage import materialize


def _template(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def _calls(df: DataFrame, stage: str) -> DataFrame:
    kept = [F.col(c).cast("long").alias(c) if c in df.columns else F.lit(None).cast("long").alias(c) for c in ("prompt_tokens", "response_tokens")]
    return df.select(F.lit(stage).alias("stage"), *kept)


def align(assigned: DataFrame, truth: str = "label", column: str = "responses", unmatched: str = "error") -> DataFrame:
    """Harmonic purity, adjusted Rand index and NMI of an assignment."""
    return M.alignment_report(M.contingency(M.with_first_topic(assigned, column, unmatched=unmatched), truth, "pred"))


def run_stages(spark: SparkSession, config: dict, backends: dict[str, Backend]) -> dict[str, DataFrame]:
    """Run generation, refinement, subtopics, assignment and correction.

    ``config`` has the sections of a topic-modelling run: ``data_sample``,
    ``generation`` (prompt, seed, output, topic_output), ``refining_topics`` and
    ``refinement`` (prompt, output, topic_output, mapping_file, remove),
    ``generate_subtopics`` and ``generation_2``, ``assignment``, ``correction``;
    ``options`` holds keyword arguments per stage.  ``backends`` has one entry
    per stage name, or ``default``; with a store, a second run pays for nothing
    it already has.  Outputs of an earlier run are replaced.  ``manifest`` names
    a folder of shared storage that keeps the tables of finished stages: a run
    with the same inputs, templates and options reads them back, and a stage
    runs again when anything before it changed (put the name of a model into
    its section or options).  Besides the
    tables of the stages the result holds ``ungrounded`` (what correction left)
    and ``usage`` (calls, tokens and cost of the document stages).
    """
    options = config.get("options", {})
    manifest = Manifest(spark, config.get("manifest"), files_of(spark, config["data_sample"]))
    corpus = manifest.stage("corpus", None, lambda: {"corpus": read_corpus(spark, config["data_sample"])})["corpus"]

    def run(stage: str, build, *more) -> dict[str, DataFrame]:
        """``build(section, backend, template, options)`` or the tables it left earlier."""
        section, chosen = config[stage], options.get(stage, {})
        template = _template(spark, section["prompt"])
        return manifest.stage(stage, [section, chosen, template, *more], lambda: build(section, backends.get(stage) or backends["default"], template, chosen))

    def generate(section, backend, template, chosen):
        seeds = read_seed(spark, section.get("seed"))
        tree, documents = generate_topics_level1(corpus, backend, template, seeds, **chosen)
        documents = materialize(documents.select(*corpus.columns, "responses", *[c for c in KEPT if c in documents.columns]), "stage-documents")
        write_topics(tree, section["topic_output"])
        write_documents(documents.drop(*KEPT), section["output"])
        return {"tree": tree.filter("desc <> ''"), "documents": documents.drop(*KEPT), "calls": _calls(documents, "generation")}

    done = run("generation", generate, files_of(spark, config["generation"].get("seed") or "/absent"))
    tree, documents, calls = done["tree"], done["documents"], [done["calls"]]

    mapping = None
    if config.get("refining_topics"):
        section = config["refinement"]
        source = section.get("earlier_mapping") or section.get("mapping_file")
        # a mapping that a run leaves where it found one is no new input
        given = files_of(spark, section["earlier_mapping"]) if section.get("earlier_mapping") else None

        def refine(section, backend, template, chosen):
            earlier = materialize(read_mapping(spark, source), "earlier-mapping")
            refined, mapping, rewritten = refine_topics(tree, backend, template, documents, earlier, remove=section.get("remove", True), **chosen)
            rewritten = materialize(rewritten, "stage-refined")
            write_topics(refined, section["topic_output"])
            write_documents(rewritten, section["output"])
            write_mapping(mapping, section["mapping_file"])
            return {"tree": refined, "mapping": mapping, "documents": rewritten}

        done = run("refinement", refine, given)
        tree, mapping, documents = done["tree"], done["mapping"], done["documents"]

    prompts = None
    if config.get("generate_subtopics"):

        def expand(section, backend, template, chosen):
            grown, prompts = generate_topics_level2(documents, tree, backend, template, **chosen)
            write_topics(grown, section["topic_output"])
            write_subtopic_prompts(prompts, section["output"])
            return {"tree": grown, "prompts": prompts}

        done = run("generation_2", expand)
        tree, prompts = done["tree"], done["prompts"]
        calls.append(_calls(prompts, "generation_2"))

    def assign(section, backend, template, chosen):
        assigned = assign_topics(corpus, tree, backend, template, **chosen)
        write_documents(assigned.drop(*KEPT), section["output"])
        return {"assigned": assigned}

    assigned = run("assignment", assign)["assigned"]

    def correct(section, backend, template, chosen):
        corrected = correct_topics(assigned, tree, backend, template, stored=True, **chosen)
        write_documents(corrected.drop(*KEPT), section["output"])
        return {"corrected": corrected}

    corrected = run("correction", correct)["corrected"]
    changed = corrected.join(assigned.select("doc_idx", F.col("prompt_hash").alias("before")), "doc_idx").where("prompt_hash != before")
    calls += [_calls(assigned, "assignment"), _calls(changed, "correction")]
    return {
        "topics": tree,
        "documents": documents,
        "mapping": mapping,
        "subtopic_prompts": prompts,
        "assigned": assigned,
        "corrected": corrected,
        "ungrounded": R.reprompt_set(corrected, topic_names(tree)),
        "usage": usage_of_calls(reduce(DataFrame.unionByName, calls)),
    }
