r"""Chat formatting over a prefix tree of conversations.

A turn is written as ``### role:``, a line break, the text and ``</turn>`` with
a line break.  Inside roles and texts a backslash is doubled and every ``###``
and ``</turn>`` (in roles also colon and line break) is broken up by
backslashes, so marks stand only where turns begin and end and the text can be
had back.

Conversations that begin with the same turns share them.  Distinct conversations
are sorted by their sequences of turn digests; one that shares its first turns
with the conversation before it adds only the turns after those, a branch.  The
branches in this order are a depth-first walk of the tree: every distinct prefix
is emitted once.  An emitted turn carries its token ids, the position id of its
first token (the tokens of its ancestors), the token range under the loss, and
the intervals of the emitted stream that hold its ancestors: a token attends to
those intervals and to its own turn up to itself.

Turn texts meet nobody else's; only 16-byte digests of a conversation's turns
are gathered.  The join of emitted turns with the conversations that need them
replicates a turn, it does not group its users, so a first turn that a third of
all conversations share is no hot spot.

Defined results: null text and null role are empty; rows are ordered by turn
(null first), then role, then digest, and rows that repeat are turns of their
own; a null conv_id is a conversation; an empty table gives empty outputs; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from corpusgrove.storage import materialize

TURN = re.compile(r"### ((?:[^\\:]|\\.)*):\n((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)
CELL = 4096
TURNS = "conv_id long, turn long, role string, digest binary, tokens array<int>, loss_from int, loss_to int"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("###", "\\#\\#\\#").replace("</turn>", "\\</turn>")


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:").replace("\n", "\\\n")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str, int]]:
    """Role, text and the place of the escaped text for every turn of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        turn = TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(turn[1]), unescape(turn[2]), turn.start(2)))
        at = turn.end()
    return out


def tokenizer(path: str):
    """A byte-level tokenizer: its ids of a string decode to that string."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


@dataclass
class ChatTree:
    """``emitted``: one row per distinct prefix in emission order: tree, part, start,
    n_tokens, position, tokens, loss_from, loss_to (within the turn), ancestors.
    ``ends``: conv_id and the ``start`` of the turn that ends it.
    """

    emitted: DataFrame
    ends: DataFrame


def encoded_turns(rows: DataFrame, path: str, loss_role: str) -> DataFrame:
    """Turns with the digest of their formatted text and its token ids."""

    def encode(batches):
        made = tokenizer(path)
        for batch in batches:
            out = {name: [] for name in ("digest", "tokens", "loss_from", "loss_to")}
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                role, text = role or "", text or ""
                head, body, tail = f"### {escape_role(role)}:\n", escape(text), "</turn>\n"
                # three pieces, so that the loss begins and ends between tokens
                ids = [e.ids for e in made.encode_batch([head, body, tail], add_special_tokens=False)]
                learn = role == loss_role
                out["digest"].append(hashlib.blake2b((head + body + tail).encode(), digest_size=16).digest())
                out["tokens"].append(ids[0] + ids[1] + ids[2])
                out["loss_from"].append(len(ids[0]) if learn else 0)
                out["loss_to"].append(len(ids[0]) + len(ids[1]) if learn else 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([r or "" for r in batch.column(2).to_pylist()], pa.string()),
                    pa.array(out["digest"], pa.binary()), pa.array(out["tokens"], pa.list_(pa.int32())),
                    pa.array(out["loss_from"], pa.int32()), pa.array(out["loss_to"], pa.int32()),
                ],
                ["conv_id", "turn", "role", "digest", "tokens", "loss_from", "loss_to"],
            )

    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").mapInArrow(encode, TURNS)


def _prefixes(paths: DataFrame) -> DataFrame:
    """Adds to every path the ids of its prefixes: each a digest of the one before and the turn."""

    def chain(batches):
        for batch in batches:
            nodes = []
            for path in batch.column(1).to_pylist():
                at, ids = b"", []
                for digest in path:
                    at = hashlib.blake2b(at + digest, digest_size=16).digest()
                    ids.append(at)
                nodes.append(ids)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.list_(pa.binary()))], ["path_key", "path", "nodes"])

    return paths.select("path_key", "path").mapInArrow(chain, "path_key binary, path array<binary>, nodes array<binary>")


def _number_sorted(paths: DataFrame) -> DataFrame:
    """Sorts paths over range partitions and numbers them: part, then seq in it."""

    def number(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int64())],
                ["path_key", "path", "nodes", "part", "seq"],
            )
            seq += n

    width = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = paths.repartitionByRange(width, "path").sortWithinPartitions("path")
    return ordered.mapInArrow(number, "path_key binary, path array<binary>, nodes array<binary>, part int, seq long")


def _shared(mine: str, before: str):
    """How many first entries two arrays have in common."""
    differ = F.array_position(F.zip_with(mine, before, lambda a, b: F.coalesce(a == b, F.lit(False))), F.lit(False))
    return F.when(F.col(before).isNull(), 0).when(differ == 0, F.size(mine)).otherwise(differ - 1).cast("int")


def build(rows: DataFrame, tokenizer_path: str, loss_role: str = "assistant") -> ChatTree:
    """The prefix tree of conversations (conv_id, turn, role, text)."""
    turns = materialize(encoded_turns(rows, tokenizer_path, loss_role), "turns")
    paths = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "digest"))).alias("t"))
    paths = paths.select("conv_id", F.transform("t", lambda t: t["digest"]).alias("path"))
    key = F.unhex(F.sha2(F.concat_ws("", F.transform("path", F.hex)), 256))
    paths = materialize(paths.withColumn("path_key", key), "paths")
    distinct = paths.groupBy("path_key").agg(F.first("path").alias("path"))
    ordered = materialize(_number_sorted(_prefixes(distinct)), "sorted")

    # the path before: one place up, or the last of the nearest part before
    inner = ordered.select("part", (F.col("seq") + 1).alias("seq"), F.col("nodes").alias("before"))
    last = ordered.groupBy("part").agg(F.max_by("nodes", "seq").alias("last"))
    outer = last.select("part", F.lit(0).cast("long").alias("seq"), F.lag("last").over(W.orderBy("part")).alias("before"))
    branches = ordered.join(inner.unionByName(outer), ["part", "seq"], "left").withColumn("shared", _shared("nodes", "before"))
    content = turns.groupBy("digest").agg(
        F.first("tokens").alias("tokens"), F.first("loss_from").alias("loss_from"), F.first("loss_to").alias("loss_to")
    )
    content = materialize(content, "content")
    places = materialize(
        branches.select("path_key", "part", "seq", "shared", F.col("nodes")[0].alias("tree"), F.posexplode(F.arrays_zip("nodes", "path")).alias("depth", "at")).select(
            "path_key", "part", "seq", "shared", "tree", "depth", F.col("at.nodes").alias("node"), F.col("at.path").alias("digest")
        ),
        "places",
    )
    # every prefix once, in emission order; offsets by part, then within it
    added = places.where("depth >= shared").join(content.select("digest", F.size("tokens").alias("n_tokens")), "digest")
    bases = added.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = bases.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    within = W.partitionBy("part").orderBy("seq", "depth").rowsBetween(W.unboundedPreceding, -1)
    nodes = materialize(
        added.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(bases, "part")
        .select("node", "tree", "path_key", "part", "depth", "digest", "n_tokens", (F.col("base") + F.col("inside")).alias("start")),
        "nodes",
    )
    # the branches that hold a branch's ancestors: one run of the stream for each
    older = places.where("depth < shared").select("path_key", "node")
    holders = nodes.select("node", F.col("path_key").alias("holder"), "start", "n_tokens")
    runs = older.join(holders, "node").groupBy("path_key", "holder").agg(F.min("start").alias("from"), F.max(F.col("start") + F.col("n_tokens")).alias("to"))
    runs = runs.groupBy("path_key").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs"), F.sum(F.col("to") - F.col("from")).alias("above"))
    heads = nodes.groupBy("path_key").agg(F.min("start").alias("head"))
    spans = heads.join(runs, "path_key", "left").select(
        "path_key", "head", F.coalesce("above", F.lit(0)).alias("above"), F.coalesce("runs", F.expr("array()").cast("array<struct<from:bigint,to:bigint>>")).alias("runs")
    )
    own = F.when(F.col("start") > F.col("head"), F.concat("runs", F.array(F.struct(F.col("head").alias("from"), F.col("start").alias("to"))))).otherwise(F.col("runs"))
    emitted = (
        nodes.join(spans, "path_key")
        .join(content, "digest")
        .select("tree", "part", "start", "n_tokens", (F.col("above") + F.col("start") - F.col("head")).alias("position"), "tokens", "loss_from", "loss_to", own.alias("ancestors"))
    )
    leaves = places.groupBy("path_key").agg(F.max_by("node", "depth").alias("node"))
    ends = paths.select("conv_id", "path_key").join(leaves.join(nodes.select("node", F.col("start").alias("end")), "node").select("path_key", "end"), "path_key")
    return ChatTree(materialize(emitted, "emitted"), ends.select("conv_id", "end"))


def read_back(tree: ChatTree, schema: str, rows) -> DataFrame:
    """What ``rows(pieces)`` makes of every distinct conversation, joined to the ids that have it.

    ``pieces`` are the turns of a conversation from the emitted stream: token
    ids and range under the loss.  Only intervals and the stream are used.
    """
    starts = tree.ends.select("end").distinct()
    leaves = tree.emitted.select(F.col("start").alias("end"), "n_tokens", "ancestors").join(starts, "end")
    itself = F.array(F.struct(F.col("end").alias("from"), (F.col("end") + F.col("n_tokens")).alias("to")))
    spans = leaves.select("end", F.explode(F.concat("ancestors", itself)).alias("s")).select("end", "s.from", "s.to")
    cells = spans.withColumn("cell", F.explode(F.expr(f"sequence(from div {CELL}, (to - 1) div {CELL})")))
    stream = tree.emitted.select("start", "tokens", "loss_from", "loss_to").withColumn("cell", F.expr(f"start div {CELL}"))
    taken = cells.join(stream, "cell").where("start >= from and start < to")
    whole = taken.groupBy("end").agg(F.sort_array(F.collect_list(F.struct("start", "tokens", "loss_from", "loss_to"))).alias("turns"))

    def make(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1).to_pylist()[0]
                columns = rows(one["turns"])
                yield pa.RecordBatch.from_pydict({"end": pa.array([one["end"]], pa.int64())} | columns)

    made = whole.mapInArrow(make, f"end long, {schema}")
    return tree.ends.join(made, "end").drop("end")


def digests(tree: ChatTree, tokenizer_path: str) -> DataFrame:
    """Per conversation, read back from the stream: turns, loss text and formatted text."""
    held = {}

    def rows(turns):
        made = held.get("tokenizer") or held.setdefault("tokenizer", tokenizer(tokenizer_path))
        texts = [made.decode(t["tokens"], skip_special_tokens=False) for t in turns]
        parsed = parse("".join(texts))
        whole, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
        for role, text, _ in parsed:
            whole.update(f"{role}\n{text}\n".encode())
        for t in turns:
            if t["loss_to"] > t["loss_from"]:
                text = unescape(made.decode(t["tokens"][t["loss_from"] : t["loss_to"]], skip_special_tokens=False))
                loss.update(text.encode())
                chars += len(text)
        return {
            "n_turns": pa.array([len(parsed)], pa.int64()),
            "turns_sha256": [whole.hexdigest()],
            "loss_chars": pa.array([chars], pa.int64()),
            "loss_sha256": [loss.hexdigest()],
            "formatted_chars": pa.array([sum(map(len, texts))], pa.int64()),
        }

    schema = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return read_back(tree, schema, rows).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
