"""Language of each word of code-switched texts, by a linear-chain conditional random field.

A word's features are its character n-grams (those at its ends are its affixes)
and the word itself as a lexicon entry, all hashed into fixed tables of weights.
Weights of features and of transitions between languages are learned together
by gradient steps on the conditional likelihood; forward-backward gives the
gradient in training and each word's language probabilities in prediction.

Training labels are languages of whole texts. Pieces of different texts are put
one after the other, so that transitions between languages are learned as well.
The sample is bounded: at most ``per_language`` texts with letters of each language,
chosen by a hash of the key, of at most ``longest`` characters each, whole. Where a
language has too few of these, its longer texts follow, each with the whole words
of its first ``longest`` characters. Repeated rows are learned from once.

Training goes through chains of at most CHAIN words one after the other and adds
up their slopes, so that memory is bounded by the sample's features.

The chains of many texts are worked through together: cut into equally long
stretches, each stretch's product of transition matrices is made in parallel,
the products are chained, and then all stretches are filled in. That is exact.

A text's language is the one with most of its letters by these probabilities,
the score its share. Null texts and those without letters are ``und`` with score
0, as is every text if no labelled text is given. A null key counts as the empty
text when rows are held out. Repeated rows each get their result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.tables import mapped, texts_of
from gridtally.llm.words import Words, kinds, slices, words

UNKNOWN = "und"
PER_LANGUAGE = 120
LONGEST = 20_000
BITS = 16
STEPS = 20
#: Words of one piece of a training chain.
PIECE = 40
#: Words of one training chain, at most.
CHAIN = 1 << 16

_K = np.random.default_rng(5).integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)
_DOWN = np.uint64(64 - BITS)


class Crf(NamedTuple):
    languages: tuple[str, ...]
    weights: np.ndarray  # features by language
    transitions: np.ndarray  # from by to


def features(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers (chars by 3) of the words' characters, each word's first character, and its lexicon feature."""
    kind = kinds()[found.codes]
    codes = np.where(kind > 0, found.codes, 0).astype(np.uint64)
    codes = np.concatenate((np.zeros(2, np.uint64), codes, np.zeros(2, np.uint64)))
    at = np.flatnonzero(kind > 0) + 2
    before, here, after = codes[at - 1], codes[at], codes[at + 1]
    inner = after > 0
    centre = before * _K[0] + here * _K[1] + after * _K[2]
    pair = here * _K[3] + after * _K[4]
    # Four characters from the one before; at the word's end the last three.
    four = np.where(
        inner,
        centre + codes[at + 2] * _K[5],
        np.where(before > 0, codes[at - 2], 0).astype(np.uint64) * _K[6] + centre,
    )
    out = np.stack([(x * _K[7]) >> _DOWN for x in (centre, pair + _K[0], four + _K[1])], axis=1).astype(np.int32)
    out += np.array([0, 1, 2], np.int32) << BITS
    begin = np.zeros(len(found.start), np.int64)
    np.cumsum((found.end - found.start)[:-1], out=begin[1:])
    return out, begin, (found.digest >> _DOWN).astype(np.int64) + (3 << BITS)


ROWS = 4 << BITS


def emissions(weights: np.ndarray, parts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    feature, begin, lexicon = parts
    if not len(begin):
        return np.zeros((0, weights.shape[1]))
    each = weights[feature[:, 0]] + weights[feature[:, 1]] + weights[feature[:, 2]]
    return np.add.reduceat(each, begin, axis=0).astype(np.float64) + weights[lexicon]


def _sweep(score: np.ndarray, starts: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward and backward values of the words, and their factors.

    ``starts`` marks words that begin a chain: nothing passes over to them.
    """
    n, size = score.shape
    stretch = max(1, int(np.ceil(np.sqrt(n))))
    count = -(-n // stretch)
    factor = np.ones((count * stretch, size))
    factor[:n] = np.exp(score - score.max(axis=1, keepdims=True)) + 1e-30
    fresh = np.ones(count * stretch, bool)
    fresh[:n] = starts
    factor = np.ascontiguousarray(factor.reshape(count, stretch, size).swapaxes(0, 1))
    fresh = np.ascontiguousarray(fresh.reshape(count, stretch).T)
    passing = np.exp(transitions - transitions.max())

    def forward(value: np.ndarray, k: int) -> np.ndarray:
        moved = value @ passing
        cut = fresh[k]
        if cut.any():
            moved[cut] = value[cut].sum(axis=-1, keepdims=True)
        moved *= factor[k] if value.ndim == 2 else factor[k][:, None, :]
        return moved / moved.sum(axis=tuple(range(1, moved.ndim)), keepdims=True)

    product = np.repeat(np.eye(size)[None], count, axis=0)
    for k in range(stretch):
        product = forward(product, k)
    left, right = np.full((count, size), 1 / size), np.full((count, size), 1 / size)
    for c in range(1, count):
        value = left[c - 1] @ product[c - 1]
        left[c] = value / value.sum()
    for c in range(count - 2, -1, -1):
        value = product[c + 1] @ right[c + 1]
        right[c] = value / value.sum()
    alpha, beta = np.empty_like(factor), np.empty_like(factor)
    value = left
    for k in range(stretch):
        value = forward(value, k)
        alpha[k] = value
    value = right
    for k in range(stretch - 1, -1, -1):
        beta[k] = value
        weighed = value * factor[k]
        value = weighed @ passing.T
        cut = fresh[k]
        value[cut] = weighed[cut].sum(axis=-1, keepdims=True)
        value /= value.sum(axis=1, keepdims=True)
    flat = [np.ascontiguousarray(x.swapaxes(0, 1)).reshape(-1, size)[:n] for x in (alpha, beta, factor)]
    return flat[0], flat[1], flat[2]


def marginals(score: np.ndarray, starts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probability of each language for each word."""
    if not len(score):
        return score
    alpha, beta, _ = _sweep(score, starts, transitions)
    out = alpha * beta
    return out / out.sum(axis=1, keepdims=True)


def _expectations(score: np.ndarray, starts: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word marginals, and expected numbers of transitions."""
    alpha, beta, factor = _sweep(score, starts, transitions)
    word = alpha * beta
    word /= word.sum(axis=1, keepdims=True)
    on = np.flatnonzero(~starts)
    on = on[on > 0]
    passing = np.exp(transitions - transitions.max())
    into = beta[on] * factor[on]
    weight = 1 / np.einsum("ti,ij,tj->t", alpha[on - 1], passing, into, optimize=True)
    return word, (alpha[on - 1] * weight[:, None]).T @ into * passing


def fit(texts: list[str], labels: list[str], steps: int = STEPS, rate: float = 0.3, decay: float = 1e-6) -> Crf:
    """A field learned from texts of one language each, in the order given."""
    languages = tuple(sorted(set(labels)))
    size = len(languages)
    weights, transitions = np.zeros((ROWS, max(size, 1)), np.float32), np.zeros((size, size))
    if size < 2 or not any(texts):
        return Crf(languages, weights, transitions)
    made = []
    for part in slices(texts):
        found = words(texts[part])
        feature, _, lexicon = features(found)
        made.append((feature, lexicon.astype(np.int32), (found.end - found.start).astype(np.int32), np.diff(found.first)))
    feature, lexicon, length, count = (np.concatenate(x) for x in zip(*made))
    del made
    gold = np.repeat(np.array([languages.index(x) for x in labels], np.int32), count)
    n = len(lexicon)
    if not n:
        return Crf(languages, weights, transitions)
    # Pieces in another order make long code-switched chains.
    owner = np.repeat(np.arange(len(count)), count)
    piece = owner * (n // PIECE + 1) + (np.arange(n) - (np.cumsum(count) - count)[owner]) // PIECE
    shuffled = np.random.default_rng(3).permutation(int(piece.max()) + 1)[piece]
    order = np.argsort(shuffled, kind="stable")
    first = np.cumsum(length, dtype=np.int64) - length
    chains = [order[k : k + CHAIN] for k in range(0, n, CHAIN)]
    observed = np.zeros((size, size))
    for chain in chains:
        np.add.at(observed, (gold[chain[:-1]], gold[chain[1:]]), 1)
    square, square_t = np.zeros_like(weights), np.zeros_like(transitions)
    for _ in range(steps):
        change, expected = np.zeros((ROWS, size)), np.zeros((size, size))
        for chain in chains:
            long = length[chain]
            begin = np.cumsum(long, dtype=np.int64) - long
            mine = feature[np.repeat(first[chain] - begin, long) + np.arange(int(long.sum()))]
            starts = np.zeros(len(chain), bool)
            starts[0] = True
            word, passed = _expectations(emissions(weights, (mine, begin, lexicon[chain])), starts, transitions)
            expected += passed
            slope = np.eye(size)[gold[chain]] - word
            word_of_char = np.repeat(np.arange(len(chain)), long)
            for label in range(size):
                by_char = slope[word_of_char, label]
                for column in range(3):
                    change[:, label] += np.bincount(mine[:, column], by_char, ROWS)
                change[:, label] += np.bincount(lexicon[chain], slope[:, label], ROWS)
        change -= decay * n * weights
        square += change**2
        weights += (rate * change / np.sqrt(square + 1e-8)).astype(np.float32)
        step = observed - expected - decay * n * transitions
        square_t += step**2
        transitions += rate * step / np.sqrt(square_t + 1e-8)
    return Crf(languages, weights, transitions)


def held_out() -> F.Column:
    """Rows that are never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, longest: int = LONGEST) -> DataFrame:
    """Labelled texts to learn from: at most ``per_language`` of each language."""
    text = F.col("text").cast("string")
    # A word that the cut goes through is left out.
    cut = F.regexp_replace(F.substring(text, 1, longest + 1), r"(?<![\p{L}\p{N}])[\p{L}\p{N}]++$", "")
    fits = F.length(text) <= longest
    labelled = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.when(fits, text).otherwise(F.substring(cut, 1, longest)).alias("text"),
        (~fits).alias("cut"),
        F.xxhash64(text).alias("digest"),
    ).where(~held_out() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    keys = ["doc_id", "lang", "cut", "digest"]
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("cut", F.xxhash64("doc_id"), "doc_id", "digest"))
    # Ranked without the texts, cut on each side of the shuffle; their number is bounded.
    chosen = labelled.select(*keys).distinct().withColumn("nth", nth).where(F.col("nth") <= per_language).select(*keys)
    return labelled.join(F.broadcast(chosen), keys).dropDuplicates(keys).select("doc_id", "lang", "text")


def train(docs: DataFrame, **settings) -> Crf:
    rows = sample(docs, **settings).orderBy("doc_id", "text").collect()
    return fit([row.text for row in rows], [row.lang for row in rows])


def label(docs: DataFrame, model: Crf) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_words, n_switches) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        model = sent.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        texts = texts_of(batch.column("text"))
        ids, held = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
        for part in slices(texts):
            found = words(texts[part])
            number = len(found.first) - 1
            share, switches = np.zeros((number, max(len(model.languages), 1))), np.zeros(number, np.int64)
            if len(found.digest):
                letters = np.concatenate(([0], np.cumsum(kinds()[found.codes] == 2)))
                weight = letters[found.end] - letters[found.start]
                text = found.text_of_word()
                if model.languages:
                    starts = np.concatenate(([True], text[1:] != text[:-1]))
                    word = marginals(emissions(model.weights, features(found)), starts, model.transitions)
                    for i in range(len(model.languages)):
                        share[:, i] = np.bincount(text, word[:, i] * weight, number)
                    tag = word.argmax(axis=1)
                    np.add.at(switches, text[1:], (tag[1:] != tag[:-1]) & ~starts[1:])
            total = share.sum(axis=1)
            best = np.where(total > 0, share.argmax(axis=1), len(model.languages))
            score = np.divide(share.max(axis=1), total, out=np.zeros(number), where=total > 0)
            yield {
                "doc_id": ids[part],
                "held_out": held[part],
                "lang_pred": names[best].tolist(),
                "score": np.clip(score, 0, 1),
                "n_words": np.diff(found.first),
                "n_switches": switches,
            }

    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held_out")
    )
    schema = "doc_id long, held_out boolean, lang_pred string, score double, n_words long, n_switches long"
    return mapped(keyed, step, schema)


def op5_language_id(docs: DataFrame) -> DataFrame:
    """Language of every document, learned from those of the same table that are not held out."""
    return label(docs, train(docs))
