"""Text completion as a column: batches, retries, settings, replay and usage.

The completion itself is a callable the user supplies.  It runs inside tasks on
Arrow batches; only the prompt column travels to Python.  Persist the result
(``storage.materialize``) before using it twice, and keep speculative execution
off while it runs: a completion is paid for every time.  A ``Backend`` with a
store keeps every answer under the hash of its prompt and settings, and a rerun
asks for what is not there only.
"""

from __future__ import annotations

import hashlib
import inspect
import string
import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from corpusgrove.functions import grammar as G, text as X
from corpusgrove.storage import path_exists

FAILED = "Error"
COMPLETION = "response string, status string, attempts int, error string"
CALLS = ["response", "status", "attempts", "prompt_hash", "error", "prompt_tokens", "response_tokens"]
STORED = "prompt_hash string, response string, status string, attempts int, error string"


@dataclass(frozen=True)
class Settings:
    """What a call is made with; handed to completers that take ``settings``."""

    temperature: float = G.TEMPERATURE
    top_p: float = G.TOP_P
    max_tokens: int = G.MAX_TOKENS
    system: str = G.SYSTEM_MESSAGE


GENERATION = Settings()
CORRECTION = Settings(temperature=G.CORRECTION_TEMPERATURE, top_p=G.CORRECTION_TOP_P)


def _takes_settings(fn: Callable) -> bool:
    try:
        return "settings" in inspect.signature(fn).parameters
    except (TypeError, ValueError):
        return False


def one_by_one(fn: Callable[..., str]) -> Callable[..., list[str]]:
    """A batch completer from one that takes a single prompt."""
    if _takes_settings(fn):
        return lambda prompts, settings: [fn(p, settings=settings) for p in prompts]
    return lambda prompts: [fn(p) for p in prompts]


def prompt_hash(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def _with_retries(fn, prompts: list[str], tries: int, wait: float) -> list[tuple[str | None, int, str | None]]:
    """Answer, attempts and error of every prompt; a batch that fails is taken apart once."""
    reason = None
    for attempt in range(1, tries + 1):
        try:
            answers = list(fn(prompts))
            if len(answers) != len(prompts):
                raise ValueError("a completer must answer every prompt of its batch")
            return [(a, attempt, None) for a in answers]
        except Exception as cause:  # noqa: BLE001  the completer's failures become rows
            reason = f"{type(cause).__name__}: {cause}"
            if attempt < tries:
                time.sleep(wait)
    if len(prompts) == 1:
        return [(None, tries, reason)]
    alone = [_with_retries(fn, [p], 1, wait)[0] for p in prompts]
    return [(a, tries + 1, e) for a, _, e in alone]


@dataclass(frozen=True)
class Parts:
    """A prompt by its parts: ``fields`` has, for each placeholder, a column and the text that stands where it is null.

    A null without such a text makes the prompt null.  Text that most prompts
    share goes to a worker once and is hashed once.
    """

    template: str
    fields: dict[str, tuple[str, str | None]]

    def pieces(self) -> list[tuple[str | None, str | None]]:
        """Columns and texts in the order of the prompt; a literal has no column."""
        out: list[tuple[str | None, str | None]] = []
        for literal, field, _, _ in string.Formatter().parse(self.template):
            out += [(None, literal)] * bool(literal) + ([self.fields[field]] if field is not None else [])
        return out

    def column(self) -> Column:
        """The prompt put together by Spark."""
        return X.fill_template(self.template, **{k: F.col(c) if text is None else F.coalesce(c, F.lit(text)) for k, (c, text) in self.fields.items()})


class Assembler:
    """Prompts of one batch of columns, and their SHA-256 sums."""

    def __init__(self, pieces: list[tuple[str | None, str | None]]):
        self.pieces, self.leads = pieces, {}

    def _split(self, row: dict[str, str | None]) -> tuple[str, "hashlib._Hash", str] | None:
        """Text before the first piece of the row's own, its hash, and the rest; None for no prompt."""
        own = [None if c is None else row[c] for c, _ in self.pieces]
        if any(x is None and text is None for x, (_, text) in zip(own, self.pieces)):
            return None
        first = next((k for k, x in enumerate(own) if x is not None), len(own))
        if first not in self.leads:
            lead = "".join(text for _, text in self.pieces[:first])
            self.leads[first] = lead, hashlib.sha256(lead.encode())
        return *self.leads[first], "".join(text if x is None else x for x, (_, text) in zip(own[first:], self.pieces[first:]))

    def prompt(self, row: dict[str, str | None]) -> str | None:
        return None if (split := self._split(row)) is None else split[0] + split[2]

    def hash(self, row: dict[str, str | None]) -> str | None:
        """What ``prompt_hash`` gives."""
        if (split := self._split(row)) is None:
            return None
        state = split[1].copy()
        state.update(split[2].encode())
        return state.hexdigest()


def _counted(df: DataFrame, prompt: str, tokens: X.TokenCounter) -> DataFrame:
    """Adds the tokens of prompt and response, for ``usage_of_calls``; prompts may bring theirs along."""
    known = "__prompt_tokens" in df.columns and tokens is X.DEFAULT_TOKENS
    counted = F.col("__prompt_tokens") if known else tokens.count(F.col(prompt))
    counted = F.when(F.col(prompt).isNotNull(), counted).cast("long")
    return df.withColumn("prompt_tokens", counted).withColumn("response_tokens", tokens.count(F.col("response"))).drop("__prompt_tokens")


def _answers(call, sent: np.ndarray, size: int, prompts_of, batch_size: int, tries: int, wait: float) -> list[tuple]:
    """``response, status, attempts, error`` of ``size`` rows; ``sent`` are those with a prompt."""
    # plain lists: setting cells of a frame costs milliseconds a call
    rows: list[tuple] = [(None, "skipped", 0, None)] * size
    for start in range(0, len(sent), batch_size):
        part = sent[start : start + batch_size]
        for at, (a, n, e) in zip(part, _with_retries(call, prompts_of(part), tries, wait)):
            rows[at] = (FAILED if a is None else a, "error" if a is None else "ok", n, e)
    return rows


def complete(
    df: DataFrame,
    prompt: str | Parts,
    fn: Callable[..., list[str]],
    batch_size: int = 1,
    tries: int = G.TRIES,
    wait: float = G.RETRY_WAIT,
    settings: Settings = GENERATION,
    tokens: X.TokenCounter = X.DEFAULT_TOKENS,
) -> DataFrame:
    """Adds ``response, status, attempts, prompt_hash, error`` and token counts.

    ``batch_size`` prompts go to the completer per call.  A call that fails
    ``tries`` times gives the response ``Error``, status ``error`` and the
    exception's text; a null prompt is not sent and gets status ``skipped``.
    ``Parts`` become prompts in the worker, ``batch_size`` at a time.
    """
    call = (lambda prompts: fn(prompts, settings=settings)) if _takes_settings(fn) else fn
    if isinstance(prompt, Parts):
        if "__prompt_tokens" in df.columns and tokens is X.DEFAULT_TOKENS:
            return _complete_parts(df, prompt, call, batch_size, tries, wait, tokens)
        df, prompt = df.withColumn("prompt", prompt.column()), "prompt"

    @F.pandas_udf(COMPLETION)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            sent = np.flatnonzero(series.notna().to_numpy())
            rows = _answers(call, sent, len(series), lambda part: series.iloc[part].tolist(), batch_size, tries, wait)
            out = pd.DataFrame(rows, index=series.index, columns=["response", "status", "attempts", "error"], dtype=object)
            yield out.astype({"attempts": "int32"})

    answered = df.withColumn("__completion", run.asNondeterministic()(F.col(prompt)))
    columns = answered.select(
        *df.columns,
        F.col("__completion.response").alias("response"),
        F.col("__completion.status").alias("status"),
        F.col("__completion.attempts").alias("attempts"),
        prompt_hash(F.col(prompt)).alias("prompt_hash"),
        F.col("__completion.error").alias("error"),
    )
    return _counted(columns, prompt, tokens)


def _complete_parts(df: DataFrame, parts: Parts, call, batch_size: int, tries: int, wait: float, tokens: X.TokenCounter) -> DataFrame:
    """``complete`` for prompts that never are a column; their tokens are known."""
    shared = df.sparkSession.sparkContext.broadcast(parts.pieces())
    columns = [c for c, _ in parts.fields.values()]

    @F.pandas_udf(f"{COMPLETION}, prompt_hash string")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = Assembler(shared.value)
        for frame in batches:
            texts = [dict(zip(columns, (x if isinstance(x, str) else None for x in row))) for row in zip(*(frame[c].tolist() for c in columns))]
            hashes = [made.hash(row) for row in texts]
            sent = np.array([k for k, h in enumerate(hashes) if h is not None], np.int64)
            rows = _answers(call, sent, len(texts), lambda part: [made.prompt(texts[k]) for k in part], batch_size, tries, wait)
            out = pd.DataFrame([(*r, h) for r, h in zip(rows, hashes)], index=frame.index, columns=["response", "status", "attempts", "error", "prompt_hash"], dtype=object)
            yield out.astype({"attempts": "int32"})

    answered = df.withColumn("__completion", run.asNondeterministic()(F.struct(*columns)))
    kept = [F.col(f"__completion.{c}").alias(c) for c in ("response", "status", "attempts", "prompt_hash", "error")]
    counted = answered.select(*[c for c in df.columns if c not in columns], *kept)
    return _counted(counted, "prompt_hash", tokens)


def replay_responses(
    df: DataFrame, prompt: str, recorded: DataFrame, tokens: X.TokenCounter = X.DEFAULT_TOKENS, key: Callable[[Column], Column] = prompt_hash
) -> DataFrame:
    """Recorded responses (``prompt_hash, response``) in place of live calls.

    Of several recordings of one prompt the successful one that sorts first counts.
    """
    order = df.columns
    # rows without a prompt get keys of their own instead of one shared null
    spare = F.concat(F.lit("skipped-"), F.xxhash64(*order).cast("string"))
    keyed = df.withColumn("prompt_hash", key(F.col(prompt))).withColumn("__key", F.coalesce("prompt_hash", spare))
    error = F.col("error") if "error" in recorded.columns else F.lit(None).cast("string")
    attempts = F.col("attempts") if "attempts" in recorded.columns else F.lit(1)
    best = F.min(F.struct((F.col("response") == FAILED).alias("failed"), "response", attempts.alias("attempts"), error.alias("error")))
    answers = recorded.filter("response is not null").groupBy(F.col("prompt_hash").alias("__key")).agg(best.alias("__r"))
    found = keyed.join(answers, "__key", "left")
    missing = F.col("__r").isNull()
    columns = found.select(
        *order,
        F.when(~missing, F.col("__r.response")).when(F.col(prompt).isNotNull(), F.lit(FAILED)).alias("response"),
        F.when(F.col(prompt).isNull(), F.lit("skipped"))
        .when(missing | F.col("__r.failed"), F.lit("error"))
        .otherwise(F.lit("ok"))
        .alias("status"),
        F.coalesce("__r.attempts", F.lit(1)).alias("attempts"),
        "prompt_hash",
        F.when(missing & F.col(prompt).isNotNull(), F.lit("no recorded answer")).otherwise(F.col("__r.error")).alias("error"),
    )
    return _counted(columns, prompt, tokens)


class Backend:
    """How the stages get answers: a live completer, or recorded responses.

    ``store`` names a folder for the answers of a live completer.  Prompts that
    it already answers are not sent again, equal prompts are sent once, and
    failed ones are sent anew.
    """

    def __init__(self, fn=None, recorded: DataFrame | None = None, store: str | None = None, settings: Settings | None = None, **options):
        if (fn is None) == (recorded is None):
            raise ValueError("give either a completer or recorded responses")
        self.fn, self.recorded, self.store, self.settings, self.options = fn, recorded, store, settings, options

    @property
    def takes_parts(self) -> bool:
        """Whether prompts are only needed where they are answered."""
        return self.recorded is None and self.store is None

    def answer(self, df: DataFrame, prompt: str | Parts, settings: Settings = GENERATION) -> DataFrame:
        settings = self.settings or settings
        if self.recorded is not None:
            return replay_responses(df, prompt, self.recorded)
        if self.store is None:
            return complete(df, prompt, self.fn, settings=settings, **self.options)
        return self._stored(df, prompt, settings)

    def _stored(self, df: DataFrame, prompt: str, settings: Settings) -> DataFrame:
        spark = df.sparkSession

        def key(text: Column) -> Column:
            # null stays null: such a prompt is not sent
            return prompt_hash(F.concat(text, F.lit(repr(sorted(asdict(settings).items())))))

        asked = df.select(key(F.col(prompt)).alias("prompt_hash"), F.col(prompt).alias("prompt")).filter("prompt is not null").dropDuplicates(["prompt_hash"])
        if path_exists(spark, self.store):
            known = spark.read.schema(STORED).parquet(self.store).filter("status = 'ok'").select("prompt_hash")
            asked = asked.join(known, "prompt_hash", "left_anti")
        answers = complete(asked.withColumnRenamed("prompt_hash", "key"), "prompt", self.fn, settings=settings, **self.options)
        answers.select(F.col("key").alias("prompt_hash"), "response", "status", "attempts", "error").write.mode("append").parquet(self.store)
        return replay_responses(df, prompt, spark.read.schema(STORED).parquet(self.store), key=key)


def failed_calls(calls: DataFrame) -> DataFrame:
    """Calls that got no answer, with the cause."""
    return calls.filter("status = 'error'")


# Dollars per million prompt and response tokens.
PRICES = {"openai": (5.0, 15.0), "vertex": (3.0, 15.0)}


def usage_of_calls(calls: DataFrame, prices: tuple[float, float] = PRICES["openai"]) -> DataFrame:
    """Tokens and cost per stage and in total (``stage`` null), from
    ``stage, prompt_tokens, response_tokens`` as every stage keeps them."""
    return calls.rollup("stage").agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("response_tokens").alias("response_tokens"),
        ((F.sum("prompt_tokens") * F.lit(prices[0]) + F.sum("response_tokens") * F.lit(prices[1])) / 1e6).alias("cost"),
    )


def usage_report(calls: DataFrame, prices: tuple[float, float] = PRICES["openai"], tokens: X.TokenCounter = X.DEFAULT_TOKENS) -> DataFrame:
    """``usage_of_calls`` from the texts ``stage, prompt, response``."""
    counted = calls.select(
        "stage", tokens.count(F.col("prompt")).alias("prompt_tokens"), tokens.count(F.col("response")).alias("response_tokens")
    )
    return usage_of_calls(counted, prices)
