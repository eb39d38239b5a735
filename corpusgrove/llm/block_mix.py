"""Mixing sources to target weights over fixed-length blocks of words.

The words of a source, its documents in a pseudorandom order, are cut into
blocks of equal length (the last block takes what is left).  Every output shard
draws how many blocks it gets of each source; the draws are multinomial with
their totals held to the targets, that is, taken without replacement from one
urn, because free multinomial totals would miss the target of a small source.
The j-th draw of a source means the j-th entry of a pseudorandom permutation of
its blocks, a new one after each full round, so no block is taken twice before
all were taken once.

DataFrame functions only.  No row of a source, however large the source, needs
to meet the others: positions come from sums per hash range.

Defined results: null text has size 0; documents of size 0 are returned with
nothing taken; a null source is a source of its own, after all others; rows that
repeat are documents of their own; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusgrove.storage import materialize

SPACE_BEFORE_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 32
RANGE_ROWS = 4096
CELLS = 1024
LEAST_BLOCK, LARGEST_BLOCK = 64, 2048
SLOTS_EACH = 256


@dataclass
class Mix:
    """``sources``: sid, source, size, target, blocks, slots.  ``draws``: shard,
    slot, sid, block.  ``spans``: one row per document with its word interval.
    """

    sources: DataFrame
    draws: DataFrame
    spans: DataFrame
    block_words: int


def _swap_or_not(x: Column, n: Column, key: Column) -> Column:
    """The place of ``x`` in a pseudorandom permutation of 0 .. n-1 named by ``key``.

    Each round pairs x with (k - x) mod n and swaps the pair or not by one hash
    bit of its larger member, so each round, and so the whole, is a bijection.
    """

    def step(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r, F.lit("turn")), n) - at, n)
        swap = F.xxhash64(key, r, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), step)


def source_targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """Per source: sid, size, weight and target.

    Sources in code-point order, null last, take the weights in turn.  Targets
    share the size of all by weight, none above ``cap`` times its source.  Taken
    in the order in which they fill up, the first source that does not fill up
    sets the level of itself and all later ones.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = W.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    numbered = (
        totals.withColumn("sid", F.row_number().over(ordered) - 1)
        .withColumn("weight", F.element_at(cycle, F.pmod("sid", F.lit(len(weights))) + 1))
        .withColumn("limit", F.col("source_size") * F.lit(float(cap)))
        .withColumn("fill", F.col("limit") / F.col("weight"))
    )
    fills = W.orderBy("fill", "sid")
    before = fills.rowsBetween(W.unboundedPreceding, -1)
    onward = fills.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = fills.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    leveled = numbered.withColumn("level", left / F.sum("weight").over(onward))
    first_open = F.min(F.when(F.col("fill") >= F.col("level"), F.struct("fill", "sid", "level"))).over(whole)
    share = first_open.getField("level") * F.col("weight")
    return leveled.withColumn("target", F.least("limit", F.coalesce(share, "limit"))).select(
        "sid", "source", "source_size", "weight", "target"
    )


def _spans(sizes: DataFrame, n_rows: int) -> DataFrame:
    """Each document's word interval [at, at + size) in the stream of its source."""
    bits = max(1, math.ceil(math.log2(max(2, n_rows / RANGE_ROWS))))
    hashed = sizes.withColumn("h", F.xxhash64("doc_id", F.lit("order"))).withColumn(
        "range", F.shiftrightunsigned("h", 64 - bits)
    )
    ranges = hashed.groupBy("sid", "range").agg(F.sum("size").alias("n"))
    earlier = W.partitionBy("sid").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    bases = ranges.select("sid", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = W.partitionBy("sid", "range").orderBy("h", "doc_id", "row_key").rowsBetween(W.unboundedPreceding, -1)
    return (
        hashed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(bases, ["sid", "range"])
        .withColumn("at", F.col("base") + F.col("inside"))
        .drop("range", "base", "inside", "h")
    )


def _draws(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """Which block of which source each output slot takes."""
    spark = sources.sparkSession
    earlier = W.orderBy("sid").rowsBetween(W.unboundedPreceding, -1)
    urn = sources.where("slots > 0").select(
        "sid", "blocks", "slots", F.coalesce(F.sum("slots").over(earlier), F.lit(0)).alias("base")
    )
    total = sources.agg(F.sum("slots")).first()[0] or 0
    cell = max(1, total // CELLS)
    cells = urn.withColumn("cell", F.explode(F.expr(f"sequence(base div {cell}, (base + slots - 1) div {cell})")))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = spark.range(0, total, 1, width).withColumnRenamed("id", "slot")
    tickets = slots.withColumn("ticket", _swap_or_not(F.col("slot"), F.lit(total), F.lit(seed))).withColumn(
        "cell", F.expr(f"ticket div {cell}")
    )
    draw = F.col("ticket") - F.col("base")
    return (
        tickets.join(cells, "cell")
        .where("ticket >= base and ticket < base + slots")
        .withColumn("draw", draw)
        .withColumn("round", F.expr("draw div blocks"))
        .withColumn("block", _swap_or_not(F.expr("draw % blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), "sid", "round")))
        .select(F.expr(f"slot div {shard_slots}").alias("shard"), "slot", "sid", "block")
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    cap: float = 3.0,
    block_words: int | None = 64,
    shard_slots: int = 4096,
    seed: int = 42,
    least_slots: int = 0,
) -> Mix:
    """Targets, output draws and document intervals of a mix of ``docs``.

    ``docs``: doc_id, text, source.  Each source's draws come within one block of its target,
    and a document is taken ``cap`` times at most.  The same input and seed give the same mix.
    Without ``block_words`` the smallest target gets ``SLOTS_EACH`` blocks, as far as blocks of
    ``LEAST_BLOCK`` to ``LARGEST_BLOCK`` words allow.  ``least_slots`` (``cap`` at most) is for
    sources whose target is under half a block; such a source has one block at least.
    """
    sized = docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("row_key"),
    )
    sizes = materialize(sized, "sizes")
    average = F.col("source_size") / F.col("blocks")
    targets = source_targets(sizes, weights, cap)
    if block_words is None:
        targets = materialize(targets, "targets")
        smallest = targets.where("target > 0").agg(F.min("target")).first()[0] or 0
        block_words = max(LEAST_BLOCK, min(LARGEST_BLOCK, int(smallest / SLOTS_EACH)))
    sources = materialize(
        targets
        .withColumn("blocks", F.when(F.col("source_size") > 0, F.greatest(F.lit(1), F.round(F.col("source_size") / block_words))).otherwise(0).cast("long"))
        .withColumn("slots", F.when(F.col("blocks") > 0, F.least(F.greatest(F.lit(float(least_slots)), F.round(F.col("target") / average)), F.floor(F.col("blocks") * F.lit(float(cap))))).otherwise(0).cast("long")),
        "sources",
    )
    named = sources.select("sid", F.col("source").alias("named"))
    keyed = sizes.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("named", "source")
    return Mix(sources, _draws(sources, shard_slots, seed), _spans(keyed, sizes.count()), block_words)


def shard_counts(mix: Mix) -> DataFrame:
    """How many blocks of each source every output shard drew."""
    return mix.draws.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("blocks"))


def block_pieces(mix: Mix) -> DataFrame:
    """Per document and block of it: where in the document, how many words, how often taken."""
    uses = mix.draws.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("uses"))
    source = mix.sources.select("sid", "source_size", "blocks")
    last = F.col("blocks") - 1
    whole = mix.spans.where("size > 0").join(source, "sid")
    first = F.least(F.expr(f"at div {mix.block_words}"), last)
    final = F.least(F.expr(f"(at + size - 1) div {mix.block_words}"), last)
    cut = whole.withColumn("block", F.explode(F.sequence(first, final)))
    low = F.greatest(F.col("at"), F.col("block") * mix.block_words)
    end = F.when(F.col("block") == last, F.col("source_size")).otherwise((F.col("block") + 1) * mix.block_words)
    high = F.least(F.col("at") + F.col("size"), end)
    return (
        cut.withColumn("from", low - F.col("at"))
        .withColumn("words", high - low)
        .select("doc_id", "row_key", "sid", "size", "at", "block", "from", "words")
        .join(uses, ["sid", "block"], "left")
        .withColumn("uses", F.coalesce("uses", F.lit(0)))
    )


def taken_words(mix: Mix) -> DataFrame:
    """One row per document: size, source_size, target and the words taken, repeats counted."""
    taken = block_pieces(mix).groupBy("doc_id", "sid", "size", "at").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    empty = mix.spans.where("size = 0").select("doc_id", "sid", "size", F.lit(0).cast("long").alias("taken"))
    rows = taken.drop("at").unionByName(empty)
    return rows.join(mix.sources.select("sid", "source", "source_size", "target"), "sid").select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def mixed_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mix as documents: per document and round, the text of the blocks taken in that round.

    A document whose blocks are all taken in a round keeps its text as it is.
    Rows taken several times appear several times; rows not taken are absent.
    All columns stay; ``n_chars``, if there, is the length of the new text.
    """
    parts = (
        block_pieces(mix)
        .groupBy("doc_id", "row_key", "sid", "at")
        .agg(F.sort_array(F.collect_list(F.struct("from", "words", "uses"))).alias("__parts"))
        .withColumn("__copy", F.row_number().over(W.partitionBy("doc_id", "row_key").orderBy("sid", "at")))
        .select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"), "__copy", "__parts")
    )
    keyed = docs.withColumn("__row_key", F.xxhash64("text"))
    # rows with the same id and text may differ in source or not at all: pair them by number
    same = W.partitionBy("doc_id", "__row_key").orderBy(F.col("source").isNull(), "source")
    numbered = keyed.where(F.length("text") > 0).withColumn("__number", F.row_number().over(same))
    joined = numbered.join(
        parts,
        F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row_key") == F.col("__key")) & (F.col("__number") == F.col("__copy")),
    )
    rounds = joined.withColumn("__most", F.array_max(F.transform("__parts", lambda p: p["uses"]))).where("__most > 0")
    rounds = rounds.withColumn("__round", F.explode(F.sequence(F.lit(1), F.col("__most"))))
    full = F.forall("__parts", lambda p: p["uses"] >= F.col("__round"))
    tokens = F.regexp_extract_all("text", F.lit(SPACE_BEFORE_WORD), F.lit(0))
    kept = F.filter("__parts", lambda p: p["uses"] >= F.col("__round"))
    cut = F.transform(kept, lambda p: F.array_join(F.slice(F.col("__tokens"), (p["from"] + 1).cast("int"), p["words"].cast("int")), ""))
    out = rounds.withColumn("__full", full).withColumn("__tokens", F.when(~F.col("__full"), tokens))
    out = out.withColumn("text", F.when(F.col("__full"), F.col("text")).otherwise(F.array_join(cut, "")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)
