"""Benchmark items that occur in training texts, by BM25 with block-max bounds.

The items are indexed; every passage of every text is a query. An item longer
than a passage step is indexed as several entries. Scores are BM25 scores over
the entry's own score as a query, so that one threshold serves all entries.

As in block-max WAND, only lists that can lift an entry over the threshold are
read: for each entry, the commonest terms that together stay below a reserve are
left to the end, and a passage is dropped as soon as a bound on the rest fails.
The bounds, each taken for all passages of a batch at once, are the sum of the
lists' maxima, then the sum of the block maxima for each block of entries, then
the entry's own impacts without its common terms. Entries that pass are scored in
full. All bounds are safe: every entry above the threshold is found.

What is found is verified: large enough parts of the word 3-grams of the item's
question and of its answer must occur around the passage, within as many words on
each side as the item has and a step more. Passages that start within an item's
length of each other are verified together, so that a text is read a bounded number
of times for each item, however long.

Equal items are indexed once, by a digest of their text. Document frequencies, the
number of entries and their mean length are counted by Spark over all entries and
handed to every shard of the index, so scores do not depend on the shards. The index
is broadcast in shards of MAX_ENTRIES entries (by hash of the text, so about), with
one pass over the texts for each shard.

Nulls: null or wordless texts and items match nothing; a null item_id is kept as
null; rows with a null doc_id are searched too. A pair of doc_id and item_id gives
one row, with its best match, if documents or items share a key (nulls together);
equal items of several ids give one row for each. Empty tables give no rows. Other
columns of both tables are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.tables import mapped, texts_of
from gridtally.llm.words import mixed, slices, words
from gridtally.session import written_once

#: Words of a passage, and from one passage to the next; an entry has no more words than a step.
PASSAGE = 128
STEP = 64
#: Part of an entry's own score that a passage must reach.
THRESHOLD = 0.6
#: Part of an entry's score that its commonest terms, left to the end, may make up.
RESERVE = 0.3
#: Parts of the question's and the answer's 3-grams that must be found.
OVERLAP = 0.6
#: Entries of one block.
BLOCK = 16
#: Entries of one shard of the index, about.
MAX_ENTRIES = 4096
K1, B = 1.2, 0.75

_GRAM = np.random.default_rng(11).integers(1, 2**63, 3, dtype=np.uint64) | np.uint64(1)
_FILTER_BITS = 18


def grams(digest: np.ndarray) -> np.ndarray:
    """Digests of word 3-grams; of all words together if there are fewer."""
    width = min(3, len(digest))
    if not width:
        return digest
    n = len(digest) - width + 1
    return mixed(sum((digest[i : i + n] * _GRAM[i] for i in range(width)), np.zeros(n, np.uint64)))


class Index(NamedTuple):
    """Postings of the entries' essential terms, cut into blocks of entries."""

    terms: np.ndarray  # digests, sorted
    passes: np.ndarray  # whether a digest with these first bits can be a term
    most: np.ndarray  # largest essential impact of each term
    block_first: np.ndarray  # term -> its blocks
    block: np.ndarray
    block_most: np.ndarray
    posting_first: np.ndarray  # block of a term -> its postings
    entry: np.ndarray
    impact: np.ndarray
    needed: np.ndarray  # essential score that an entry needs
    needed_in_block: np.ndarray
    full: list[dict[int, float]]  # entry -> impact of all its terms
    item: list  # entry -> item
    owner: list[int]  # entry -> number of its item
    length: list[int]  # entry -> words of its item
    questions: list[np.ndarray]
    answers: list[np.ndarray]


class Statistics(NamedTuple):
    """Counts over all entries of all shards; the terms are those of one shard."""

    entries: int
    words: int
    terms: np.ndarray  # digests, sorted
    seen: np.ndarray  # entries with each


def entries_of(digest: np.ndarray) -> list[np.ndarray]:
    """An item's words in entries of like length, none longer than a step."""
    return [e for e in np.array_split(digest, max(1, math.ceil(len(digest) / STEP))) if len(e)]


def statistics(entries: list[np.ndarray]) -> Statistics:
    terms, seen = np.unique(
        np.concatenate([np.zeros(0, np.uint64), *(np.unique(e) for e in entries)]), return_counts=True
    )
    return Statistics(len(entries), sum(map(len, entries)), terms, seen)


def build_index(items: list[tuple[object, str]], counted: Statistics | None = None) -> Index:
    """An index of (item, text); the first half of an item's words is its question.

    ``counted`` holds the statistics of all shards, if these items are one of several.
    """
    found = words([text or "" for _, text in items])
    entries: list[np.ndarray] = []
    owner: list[int] = []
    questions, answers, lengths = [], [], []
    for i in range(len(items)):
        digest = found.digest[found.first[i] : found.first[i + 1]]
        half = (len(digest) + 1) // 2
        lengths.append(len(digest))
        questions.append(np.unique(grams(digest[:half])))
        answers.append(np.unique(grams(digest[half:])))
        for piece in entries_of(digest):
            entries.append(piece)
            owner.append(i)
    everywhere, words_everywhere, terms, seen = counted or statistics(entries)
    number = len(entries)
    idf = np.log(1 + (everywhere - seen + 0.5) / (seen + 0.5))
    mean = words_everywhere / max(everywhere, 1)
    # Entries of like length lie in one block, so that block maxima are close to their impacts.
    order = sorted(range(number), key=lambda e: len(entries[e]))
    full, needed = [], np.zeros(number)
    posted: list[tuple[int, int, float]] = []
    for place, e in enumerate(order):
        often = Counter(np.searchsorted(terms, entries[e]).tolist())
        norm = K1 * (1 - B + B * len(entries[e]) / mean)
        weight = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in often.items()}
        own = sum(weight.values())
        weight = {t: w / own for t, w in weight.items()}
        full.append(weight)
        rest = 0.0
        for t in sorted(weight, key=lambda t: (-seen[t], t)):
            if rest + weight[t] <= RESERVE:
                rest += weight[t]
            else:
                posted.append((t, place, weight[t]))
        needed[place] = THRESHOLD - rest
    posted.sort()
    term = np.array([p[0] for p in posted], np.int64)
    entry = np.array([p[1] for p in posted], np.int64)
    impact = np.array([p[2] for p in posted], np.float64)
    pair = term * (number // BLOCK + 1) + entry // BLOCK
    begin = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.zeros(0, np.int64)
    most = np.zeros(len(terms))
    np.maximum.at(most, term, impact)
    passes = np.zeros(1 << _FILTER_BITS, bool)
    passes[terms >> np.uint64(64 - _FILTER_BITS)] = True
    blocks = max(1, math.ceil(number / BLOCK))
    needed_in_block = np.full(blocks, np.inf)
    np.minimum.at(needed_in_block, np.arange(number) // BLOCK, needed)
    return Index(
        terms,
        passes,
        most,
        np.searchsorted(term[begin], np.arange(len(terms) + 1)),
        entry[begin] // BLOCK,
        np.maximum.reduceat(impact, begin) if len(begin) else impact,
        np.append(begin, len(pair)),
        entry,
        impact,
        needed,
        needed_in_block,
        full,
        [items[owner[e]][0] for e in order],
        [owner[e] for e in order],
        [lengths[owner[e]] for e in order],
        [questions[owner[e]] for e in order],
        [answers[owner[e]] for e in order],
    )


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range of each."""
    count = end - begin
    owner = np.repeat(np.arange(len(count)), count)
    stop = np.cumsum(count)
    return np.arange(stop[-1] if len(stop) else 0) - np.repeat(stop - count, count) + begin[owner], owner


def _summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(key, return_inverse=True)
    return keys, np.bincount(inverse, value, len(keys))


_SLACK = 1e-9


def retrieve(index: Index, term: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int, float]]:
    """(passage, entry, score) of all entries above the threshold.

    ``term`` has the term of each word (-1: none), passages are word ranges.
    """
    if not len(index.needed):
        return []
    sums = np.concatenate(([0.0], np.cumsum(np.where(term >= 0, index.most[term], 0.0))))
    alive = np.flatnonzero(sums[end] - sums[begin] >= index.needed.min() - _SLACK)
    at, passage = _ranges(begin[alive], end[alive])
    held = term[at]
    useful = held >= 0
    useful[useful] = index.most[held[useful]] > 0
    size = len(index.terms)
    query = np.unique(alive[passage[useful]] * size + held[useful])
    passage, held = query // size, query % size
    # Blocks of the query's terms, and the bound of each block.
    slot, q = _ranges(index.block_first[held], index.block_first[held + 1])
    blocks = len(index.needed_in_block)
    key = passage[q] * blocks + index.block[slot]
    keys, bound = _summed(key, index.block_most[slot])
    open_ = keys[bound >= index.needed_in_block[keys % blocks] - _SLACK]
    stay = np.isin(key, open_)
    slot, q = slot[stay], q[stay]
    # Postings of the open blocks, and the essential score of each entry.
    posting, s = _ranges(index.posting_first[slot], index.posting_first[slot + 1])
    entries = len(index.needed)
    keys, score = _summed(passage[q[s]] * entries + index.entry[posting], index.impact[posting])
    keys = keys[score >= index.needed[keys % entries] - _SLACK]
    out = []
    for p, e in zip((keys // entries).tolist(), (keys % entries).tolist()):
        have = set(term[begin[p] : end[p]].tolist())
        total = sum(weight for t, weight in index.full[e].items() if t in have)
        if total >= THRESHOLD - _SLACK:
            out.append((p, e, total))
    return out


def terms_of(index: Index, digest: np.ndarray) -> np.ndarray:
    """Term of each word; -1 if no entry has it."""
    term = np.full(len(digest), -1, np.int64)
    maybe = np.flatnonzero(index.passes[digest >> np.uint64(64 - _FILTER_BITS)])
    place = np.searchsorted(index.terms, digest[maybe])
    place[place == len(index.terms)] = 0
    right = index.terms[place] == digest[maybe]
    term[maybe[right]] = place[right]
    return term


def passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ranges of all passages, and the text of each."""
    count = np.diff(first)
    number = np.where(count > 0, np.maximum(1, -(-(count - STEP) // STEP)), 0)
    nth, text = _ranges(np.zeros(len(number), np.int64), number)
    begin = first[text] + nth * STEP
    return begin, np.minimum(begin + PASSAGE, first[text + 1]), text


def together(hits: list[tuple[int, int, float]], index: Index, begin: np.ndarray, text: np.ndarray) -> Iterator[list[tuple[int, int, float]]]:
    """Hits of one item in one text whose passages start within the item's length."""
    group: list[tuple[int, int, float]] = []
    key = None
    for hit in sorted(hits, key=lambda x: (text[x[0]], index.owner[x[1]], x[0])):
        p, e, _ = hit
        if group and (key != (text[p], index.owner[e]) or begin[p] - begin[group[0][0]] > index.length[e]):
            yield group
            group = []
        key = (text[p], index.owner[e])
        group.append(hit)
    if group:
        yield group


def search(docs: DataFrame, index: Index) -> DataFrame:
    """Verified matches of one shard of the index: (doc_id, item, score, question_overlap, answer_overlap)."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def share(wanted: np.ndarray, have: np.ndarray) -> float:
        return float(np.isin(wanted, have).mean()) if len(wanted) else 1.0

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        index = sent.value
        texts, ids = texts_of(batch.column("text")), batch.column("doc_id").to_pylist()
        rows: dict[str, list] = {name: [] for name in _COLUMNS}
        for part in slices(texts):
            found = words(texts[part])
            begin, end, text = passages(found.first)
            by_item: dict[tuple[int, object], tuple[float, float, float]] = {}
            for group in together(retrieve(index, terms_of(index, found.digest), begin, end), index, begin, text):
                (p, e, _), last = group[0], group[-1][0]
                around = index.length[e] + STEP
                low = max(begin[p] - around, found.first[text[p]])
                high = min(end[last] + around, found.first[text[p] + 1])
                have = grams(found.digest[low:high])
                question, answer = share(index.questions[e], have), share(index.answers[e], have)
                if question >= OVERLAP and answer >= OVERLAP:
                    value = (max(score for _, _, score in group), question, answer)
                    key = (int(text[p]), index.item[e])
                    by_item[key] = max(by_item.get(key, value), value)
            for (t, item), value in sorted(by_item.items(), key=lambda x: x[0][0]):
                for name, x in zip(_COLUMNS, (ids[part][t], item, *value)):
                    rows[name].append(x)
        yield rows

    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return mapped(keyed, step, "doc_id long, item string, score double, question_overlap double, answer_overlap double")


_COLUMNS = ("doc_id", "item", "score", "question_overlap", "answer_overlap")


def _count(batch: pa.RecordBatch) -> Iterator[dict]:
    """Terms of each item with the entries that hold them; without a term, the item's entries and words."""
    rows: dict[str, list] = {"item": [], "term": [], "seen": [], "words": []}
    for item, text in zip(batch.column("item").to_pylist(), texts_of(batch.column("text"))):
        found = statistics(entries_of(words([text]).digest))
        rows["item"] += [item] * (len(found.terms) + 1)
        rows["term"] += [None, *found.terms.view(np.int64).tolist()]
        rows["seen"] += [found.entries, *found.seen.tolist()]
        rows["words"] += [found.words] + [0] * len(found.terms)
    yield rows


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The best verified match of each benchmark item in each document."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    items = items.withColumn("item", F.sha2("text", 256))
    texts = items.groupBy("item").agg(F.min("text").alias("text"))
    counts = written_once(mapped(texts, _count, "item string, term long, seen long, words long"), "item_terms")
    everywhere = counts.where("term is null").agg(F.sum("seen").alias("entries"), F.sum("words").alias("words")).first()
    shards = max(1, math.ceil((everywhere.entries or 0) / MAX_ENTRIES))
    shard = F.pmod(F.xxhash64("item"), F.lit(shards)).cast("int").alias("shard")
    texts = written_once(texts.select(shard, "item", "text"), "items")
    by_term = counts.where("term is not null").groupBy("term").agg(F.sum("seen").alias("seen"))
    in_shard = counts.where("term is not null").select(shard, "term").distinct().join(by_term, "term")
    in_shard = written_once(in_shard, "shard_terms")
    found = None
    for n in range(shards):
        # About MAX_ENTRIES entries of at most STEP words, and their terms.
        mine = texts.where(F.col("shard") == n).select("item", "text").toArrow()
        terms = in_shard.where(F.col("shard") == n).select("term", "seen").toArrow()
        digest = terms.column("term").to_numpy().view(np.uint64)
        order = np.argsort(digest)
        counted = Statistics(
            everywhere.entries or 0, everywhere.words or 0, digest[order], terms.column("seen").to_numpy()[order]
        )
        pairs = sorted(zip(mine.column("item").to_pylist(), mine.column("text").to_pylist()))
        part = search(docs, build_index(pairs, counted))
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("best")
    named = found.join(items.select("item", "item_id").distinct(), "item")
    return named.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def op10_benchmark_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items in every document, one row for each pair."""
    return leaks(docs, benchmark)
