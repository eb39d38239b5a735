"""Embeddings and cosine similarity."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from corpusgrove.functions.text import let

VECTOR = T.ArrayType(T.DoubleType(), False)
WORDS = 1 << 18
_WORD = re.compile(r"[^\W_]+")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vector columns; 0 when either is a zero vector."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(
            F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")),
            F.lit(0.0),
            lambda acc, v: acc + v,
        )

    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0))


def hashed_terms(dims: int = 256) -> Callable[[list[str]], np.ndarray]:
    """A text encoder: term counts, each term hashed to one dimension."""

    class Slots(dict):
        """Slots of the words met so far; a worker keeps no more than ``WORDS`` of them."""

        def __missing__(self, word: str) -> int:
            if len(self) >= WORDS:
                self.clear()
            self[word] = slot = int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % dims
            return slot

    slots = Slots()

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dims))
        for row, text in enumerate(texts):
            words = _WORD.findall(text.lower())
            seen = np.fromiter(map(slots.__getitem__, words), np.int64, len(words))
            out[row] = np.bincount(seen, minlength=dims)
        return out

    return encode


def term_counts(text: Column, dims: int = 256) -> Column:
    """What ``hashed_terms`` gives, as one expression: no Python worker.

    Every slot is put among the slots of the words; sorted, each is a run one
    longer than its count.
    """

    def slot(word: Column) -> Column:
        return F.pmod(F.conv(F.substring(F.md5(word), 1, 4), 16, 10).cast("int"), F.lit(dims))

    def counts(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda v, i: F.when((i == 0) | (v != F.get(s, i - 1)), i)), lambda i: i.isNotNull())
        return let(starts, lambda st: F.transform(st, lambda p, k: (F.coalesce(F.get(st, k + 1), F.size(s)) - p - 1).cast("double")))

    words = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    slots = F.concat(F.transform(words, slot), F.sequence(F.lit(0), F.lit(dims - 1)))
    return F.when(text.isNotNull(), let(F.sort_array(slots), counts))


def embed(text: Column, encode: Callable[[list[str]], np.ndarray] | None = None) -> Column:
    """Vector column of ``text``, null where it is null.

    ``encode`` maps a list of texts to a matrix; without it terms are counted.
    """
    if encode is None:
        return term_counts(text)

    @F.pandas_udf(VECTOR)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.dropna()
            out = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            if len(texts):
                out[texts.index] = list(np.asarray(encode(texts.tolist()), dtype=float))
            yield out

    # deterministic UDFs may be duplicated by filter inference; this one is costly
    return run.asNondeterministic()(text)
