"""Secrets in texts: fixed patterns, and character Markov models for the rest.

Two first-order models over the characters of tokens are learned from labelled
samples: values that the fixed patterns found are samples of random strings, all
other identifier-like runs of the corpus are samples of ordinary identifiers. A
run that no pattern covers is a secret if the log-likelihood ratio of the two
models exceeds the log of the prior odds against it. Counts are made inside each
Arrow batch and added up in Spark; the models have one row for each pair of
characters, whatever the corpus size.

Nulls: a null text is the empty text, a null key stays. Repeated rows each get
their own result. Empty tables give untrained (uniform) models and no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.tables import mapped, texts_of
from gridtally.llm.words import code_points, slices

# The kinds, in the order of equal starts, and the patterns.
KINDS = ("assign", "access", "hex", "markov")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX_LENGTH = 24
_ASSIGN_LENGTH = 6

_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Symbol numbers; 0 stands for every other character and for both ends of a token.
_N = len(_SYMBOLS) + 1


def _table(chars: str) -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    for number, char in enumerate(chars, 1):
        out[ord(char)] = number
    return out


_NUMBER = _table(_SYMBOLS)
_IS_HEX = _table("0123456789abcdef") > 0


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio of random strings to identifiers for each pair of symbols.

    A run of ``shortest`` or more symbols is a secret if its ratio is above the
    log of ``odds`` and above ``per_symbol`` for each symbol.
    """

    ratio: np.ndarray
    shortest: int = 16
    odds: float = 1e6
    per_symbol: float = 0.7

    def score(self, symbols: np.ndarray) -> float:
        return float(self.ratio[symbols[:-1], symbols[1:]].sum())

    def is_secret(self, symbols: np.ndarray) -> bool:
        return self.score(symbols) > max(math.log(self.odds), self.per_symbol * (len(symbols) - 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the assign and access patterns."""
    found = []
    low = text.lower()
    if any(word in low for word in _WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    return found


def _runs(inside: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    start, end = edges[0::2], edges[1::2]
    long = end - start >= shortest
    return start[long], end[long]


class _Slice:
    """Code points of some texts and all base spans in them."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.codes, self.starts = code_points(texts)
        self.spans = [base_spans(text) for text in texts]
        start, end = _runs(_IS_HEX[self.codes], _HEX_LENGTH)
        for a, b, i in zip(start.tolist(), end.tolist(), self._text(start)):
            self.spans[i].append((a - int(self.starts[i]), 2, b - int(self.starts[i])))
        self.symbols = _NUMBER[self.codes]

    def _text(self, place: np.ndarray) -> list[int]:
        return (np.searchsorted(self.starts, place, "right") - 1).tolist()

    def placed(self) -> Iterator[tuple[int, int, int, int]]:
        """Base spans in places of the slice: kind number, whole start and end, value start."""
        for i, spans in enumerate(self.spans):
            at = int(self.starts[i])
            for start, kind, end in spans:
                value = start
                if kind == 0:
                    value = _ASSIGN.match(self.texts[i], start).start(2)
                yield kind, at + start, at + end, at + value

    def uncovered(self) -> np.ndarray:
        symbols = self.symbols.copy()
        for _, start, end, _ in self.placed():
            symbols[start:end] = 0
        return symbols

    def add_markov(self, model: Model) -> None:
        symbols = self.uncovered()
        start, end = _runs(symbols > 0, model.shortest)
        for a, b, i in zip(start.tolist(), end.tolist(), self._text(start)):
            if model.is_secret(np.concatenate(([0], symbols[a:b], [0]))):
                at = int(self.starts[i])
                self.spans[i].append((a - at, 3, b - at))


def _pairs(symbols: np.ndarray) -> np.ndarray:
    pairs = symbols[:-1].astype(np.int64) * _N + symbols[1:]
    return np.bincount(pairs, minlength=_N * _N)


def pair_counts(docs: DataFrame) -> DataFrame:
    """Counts of symbol pairs (pair, secret, n) in the labelled samples of all texts."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = texts_of(batch.column("text"))
        counts = np.zeros((2, _N * _N), np.int64)
        for part in slices(texts):
            found = _Slice(texts[part])
            counts[0] += _pairs(found.uncovered())
            for _, _, end, value in found.placed():
                counts[1] += _pairs(np.concatenate(([0], found.symbols[value:end], [0])))
        secret, pair = np.nonzero(counts)
        yield {"pair": pair, "secret": secret, "n": counts[secret, pair]}

    made = mapped(docs.select(F.col("text").cast("string")), step, "pair int, secret int, n long")
    return made.groupBy("pair", "secret").agg(F.sum("n").alias("n"))


def train(counts: DataFrame, **settings) -> Model:
    """Both models from pair counts: at most two rows for each pair of 68 symbols."""
    n = np.ones((2, _N * _N))
    for row in counts.collect():
        n[row.secret, row.pair] += row.n
    n = n.reshape(2, _N, _N)
    n[:, 0, 0] = 1  # stretches outside of tokens
    logs = np.log(n / n.sum(axis=2, keepdims=True))
    return Model(logs[1] - logs[0], **settings)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def find(docs: DataFrame, model: Model) -> DataFrame:
    """One row for each document with its base spans' digest and all its spans."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = texts_of(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        for part in slices(texts):
            found = _Slice(texts[part])
            base = [_joined(spans) for spans in found.spans]
            found.add_markov(model)
            kinds = [[kind for _, kind, _ in spans] for spans in found.spans]
            yield {
                "doc_id": ids[part],
                **{f"n_{name}": [k.count(i) for k in kinds] for i, name in enumerate(KINDS)},
                "base_sha256": [hashlib.sha256(text.encode()).hexdigest() for text in base],
                "spans": [_joined(spans) for spans in found.spans],
            }

    return mapped(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        step,
        "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string",
    )


def op1_secret_scan(docs: DataFrame) -> DataFrame:
    """Secrets of every document, with models learned from the same table."""
    return find(docs, train(pair_counts(docs)))
