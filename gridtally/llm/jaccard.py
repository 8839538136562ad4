"""All pairs of texts whose sets of word shingles have a Jaccard similarity of 0.8 or more.

1. Texts of the same words are one class; only one text of a class goes on.
2. Each class has MinHash values. Classes that agree in all values of a band meet
   in a bucket; 28 bands of 4 values miss a pair at 0.8 once in 2.5 million.
   Buckets of one class are dropped before any values are sent to a bucket.
3. In a bucket, pairs are compared on their values in steps. After each step a
   pair is dropped if the posterior probability that its similarity reaches the
   threshold is below the tolerance (uniform prior). What remains is not sent out
   as pairs: edges of a spanning forest of the bucket are enough to find clusters.
4. Inside each cluster every pair of classes is verified exactly on whole shingle
   sets, and links are counted there; again only a forest of links leaves.

Large buckets and clusters are cut into blocks, and each pair of blocks is a task
row group of its own, so no task holds more than two blocks of one group.

A text of one to four words is a single shingle. Nulls and texts without words
link with nothing. If a doc_id comes with several texts, one of them (the one of
the smallest digest) stands for it; repeated rows link with each other. Rows with
a null doc_id link with nothing and get a null class. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.components import components
from gridtally.llm.tables import Batches, in_groups, mapped, texts_of
from gridtally.llm.words import mixed, slices, words
from gridtally.session import written_once

WORDS = 5
THRESHOLD = 0.8
ROWS = 4
BANDS = 28
HASHES = ROWS * BANDS
#: Posterior probability below which a pair is dropped.
TOLERANCE = 1e-6
#: MinHash values compared in one step.
STEP = 16
#: Members of a bucket, and of a cluster, that are compared together.
BUCKET_BLOCK = 1024
CLUSTER_BLOCK = 256

_FACTORS = (np.random.default_rng(7).integers(0, 2**63, WORDS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_HASHES = (np.random.default_rng(8).integers(0, 2**63, HASHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def shingles(texts: list[str], width: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle digests of all texts in order, where each text's begin, and a digest of each text's words."""
    found = words(texts)
    count = np.diff(found.first)
    have = np.where(count > 0, np.maximum(count - width + 1, 1), 0)
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(have, out=begin[1:])
    # The word at which each shingle starts, and how many words it has.
    at = np.arange(begin[-1]) + np.repeat(found.first[:-1] - begin[:-1], have)
    wide = np.repeat(np.minimum(count, width), have)
    total = np.zeros(begin[-1], np.uint64)
    padded = np.append(found.digest, np.zeros(width, np.uint64))
    for i in range(width):
        total += np.where(i < wide, padded[at + i] * _FACTORS[i], np.uint64(0))
    total = mixed(total + wide.astype(np.uint64))
    place = np.arange(len(found.digest)) - np.repeat(found.first[:-1], count)
    weighed = mixed(found.digest + place.astype(np.uint64) * _FACTORS[0])
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(weighed)))
    other = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(weighed))))
    ends = found.first
    digest = np.stack([s[ends[1:]] - s[ends[:-1]] for s in (sums, other)], axis=1)
    return total, begin, digest


def signatures(total: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """MinHash values (uint32) of texts that all have shingles."""
    out = np.empty((len(begin) - 1, HASHES), np.uint32)
    for i, factor in enumerate(_HASHES):
        out[:, i] = np.minimum.reduceat(total * factor, begin[:-1]) >> np.uint64(32)
    return out


@cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, hashes: int = HASHES) -> tuple[int, ...]:
    """For each number of compared values, the fewest matches with which a pair stays.

    With a uniform prior, the posterior after m matches of n is Beta(m+1, n-m+1);
    its upper tail at the threshold is a binomial sum.
    """
    out = []
    for n in range(hashes + 1):
        tail, m = (1 - threshold) ** (n + 1), 0
        while tail < tolerance and m < n:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the edges (a, b) connect, one for each node but the smallest of its tree."""
    nodes, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def likely_pairs(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks of MinHash values that incremental comparison keeps."""
    least = least_matches()
    if same:
        i, j = np.triu_indices(len(left), 1)
    else:
        i, j = (x.ravel() for x in np.indices((len(left), len(right))))
    matches = np.zeros(len(i), np.int16)
    for begin in range(0, HASHES, STEP):
        end = min(begin + STEP, HASHES)
        for part in range(0, len(i), 100_000):
            cut = slice(part, part + 100_000)
            matches[cut] += (left[i[cut], begin:end] == right[j[cut], begin:end]).sum(axis=1, dtype=np.int16)
        stay = matches >= least[end]
        i, j, matches = i[stay], j[stay], matches[stay]
    return i, j


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def classes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, words_1, words_2, signature) of each row with words and a key."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        texts, ids = texts_of(batch.column("text")), batch.column("doc_id").to_numpy(zero_copy_only=False)
        for part in slices(texts):
            total, begin, digest = shingles(texts[part])
            full = np.diff(begin) > 0
            if not full.any():
                continue
            values = signatures(total, np.append(begin[:-1][full], begin[-1]))
            yield {
                "doc_id": ids[part][full],
                "words_1": _signed(digest[full, 0]),
                "words_2": _signed(digest[full, 1]),
                "signature": [row.tobytes() for row in values],
            }

    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null")
    return mapped(keyed, step, "doc_id long, words_1 long, words_2 long, signature binary")


def _banded(classes: DataFrame) -> DataFrame:
    """(rep, band, bucket) of each class."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        values = np.stack([np.frombuffer(x, np.uint32) for x in batch.column("signature").to_pylist()])
        bands = values.reshape(len(values), BANDS, ROWS).astype(np.uint64)
        bucket = np.zeros(bands.shape[:2], np.uint64)
        for i in range(ROWS):
            bucket = mixed(bucket + bands[:, :, i] * _FACTORS[i])
        yield {
            "rep": np.repeat(batch.column("rep").to_numpy(), BANDS),
            "band": np.tile(np.arange(BANDS, dtype=np.int32), len(values)),
            "bucket": _signed(bucket.ravel()),
        }

    return mapped(classes.select("rep", "signature"), step, "rep long, band int, bucket long")


def _in_blocks(rows: DataFrame, group: list[str], size: str, member: str, block: int) -> DataFrame:
    """Rows once for each pair of blocks they take part in: columns lo, hi and own (their block)."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    return (
        rows.withColumn("own", F.pmod(F.xxhash64(member), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("lo", F.least("own", "other"))
        .withColumn("hi", F.greatest("own", "other"))
        .drop("other")
        .repartition(*group, "lo", "hi")
        .sortWithinPartitions(*group, "lo", "hi")
    )


def candidate_edges(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all classes whose pairs survive in some bucket."""
    buckets = written_once(_banded(classes), "buckets")
    several = buckets.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    full = buckets.join(several, ["band", "bucket"])
    # Each class once with its buckets, then with its values, then spread out again.
    places = full.groupBy("rep").agg(F.collect_list(F.struct("band", "bucket", "n")).alias("places"))
    spread = (
        classes.select("rep", "signature")
        .join(places, "rep")
        .select("rep", "signature", F.inline("places"))
    )
    blocked = _in_blocks(spread, ["band", "bucket"], "n", "rep", BUCKET_BLOCK)

    def run(batches: Batches) -> Batches:
        for group in in_groups(batches, ["band", "bucket", "lo", "hi"]):
            rep = group.column("rep").to_numpy()
            own = group.column("own").to_numpy()
            lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
            values = np.stack([np.frombuffer(x, np.uint32) for x in group.column("signature").to_pylist()])
            left, right = own == lo, own == hi
            i, j = likely_pairs(values[left], values[right], lo == hi)
            if len(i):
                a, b = forest(rep[left][i], rep[right][j])
                yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    return blocked.select("band", "bucket", "lo", "hi", "own", "rep", "signature").mapInArrow(run, "a long, b long")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets."""
    sets = [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = int(column[-1]) + 1
    out = np.zeros((len(left), len(right)))
    chunk = max(1024, 4_000_000 // len(sets))
    for begin in range(0, width, chunk):
        some = slice(*np.searchsorted(column, (begin, begin + chunk)))
        held = np.zeros((len(sets), min(chunk, width - begin)), np.float32)
        held[owner[some], column[some] - begin] = 1
        out += held[: len(left)] @ held[len(left) :].T
    return out


def verified(texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Exact links inside clusters: (a, b, links).

    ``texts`` has rep, n (rows of the class), text, words_1 and words_2 (the digest
    of the text that stands for rep), cluster and cluster_size. A row with b null
    says that class a has ``links`` rows on the other side of links found in one
    pair of blocks; a row with b set is an edge of a forest.
    """

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        given = texts_of(batch.column("text"))
        names = ("rep", "n", "cluster", "cluster_size")
        rest = {name: batch.column(name).to_numpy() for name in (*names, "words_1", "words_2")}
        for part in slices(given):
            total, begin, digest = shingles(given[part])
            right = (_signed(digest[:, 0]) == rest["words_1"][part]) & (_signed(digest[:, 1]) == rest["words_2"][part])
            sets = [np.unique(total[begin[i] : begin[i + 1]]).tobytes() for i in np.flatnonzero(right)]
            yield {**{name: rest[name][part][right] for name in names}, "shingles": sets}

    sets = mapped(
        texts.select("rep", "n", "cluster", "cluster_size", "words_1", "words_2", "text"),
        cut,
        "rep long, n long, cluster long, cluster_size long, shingles binary",
    )
    blocked = _in_blocks(sets, ["cluster"], "cluster_size", "rep", CLUSTER_BLOCK)

    def run(batches: Batches) -> Batches:
        for group in in_groups(batches, ["cluster", "lo", "hi"]):
            # Repeated rows of one document come here together.
            rep, once = np.unique(group.column("rep").to_numpy(), return_index=True)
            weight, own = (group.column(name).to_numpy()[once] for name in ("n", "own"))
            lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
            held = [np.frombuffer(group.column("shingles")[i].as_py(), np.uint64) for i in once.tolist()]
            left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
            if not len(left) or not len(right):
                continue
            common = _overlaps([held[i] for i in left], [held[i] for i in right])
            size = np.array([len(x) for x in held])
            # Compared without a division: common / union >= threshold.
            linked = common * (1 + threshold) >= threshold * (size[left][:, None] + size[right]) - 1e-9
            if lo == hi:
                np.fill_diagonal(linked, False)
            sums = [(rep[left], linked @ weight[right])]
            if lo != hi:
                sums.append((rep[right], weight[left] @ linked))
            i, j = np.nonzero(linked)
            a, b = forest(rep[left][i], rep[right][j]) if len(i) else (rep[:0], rep[:0])
            node = np.concatenate([x for x, _ in sums])
            count = np.concatenate([x for _, x in sums]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((node, a))),
                    pa.concat_arrays([pa.nulls(len(node), pa.int64()), pa.array(b)]),
                    pa.array(np.concatenate((count, np.zeros(len(a), np.int64)))),
                ],
                names=["a", "b", "links"],
            )

    columns = ("cluster", "lo", "hi", "own", "rep", "n", "shingles")
    return blocked.select(*columns).mapInArrow(run, "a long, b long, links long")


def similar(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links) of every row.

    ``class_id`` is the smallest doc_id reachable by links, itself included, and
    ``n_links`` the number of other rows that the row is linked with directly.
    """
    rows = written_once(classes_of(docs), "signatures")
    chosen = rows.groupBy("doc_id").agg(
        F.min(F.struct("words_1", "words_2")).alias("w"), F.count(F.lit(1)).alias("copies")
    )
    chosen = chosen.select("doc_id", "w.words_1", "w.words_2", "copies")
    members = chosen.groupBy("words_1", "words_2").agg(F.min("doc_id").alias("rep"), F.sum("copies").alias("n"))
    members = written_once(members, "classes")
    classes = (
        members.join(rows.withColumnRenamed("doc_id", "rep"), ["rep", "words_1", "words_2"])
        .dropDuplicates(["rep"])
        .select("rep", "n", "signature")
    )
    classes = written_once(classes, "classes")
    clusters = components(candidate_edges(classes), "clusters")
    clusters = written_once(clusters.select(F.col("node").alias("rep"), F.col("root").alias("cluster")), "clusters")
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size"))
    wanted = (
        clusters.join(sizes, "cluster")
        .join(members, "rep")
        .select("rep", "n", "cluster", "cluster_size", "words_1", "words_2")
    )
    keyed = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    found = written_once(verified(keyed.join(wanted, "rep")), "links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("links").alias("outer_links"))
    roots = components(found.where("b is not null").select("a", "b"), "links")
    by_class = (
        members.join(counts.withColumnRenamed("a", "rep"), "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "words_1",
            "words_2",
            F.coalesce("root", "rep").alias("class_id"),
            (F.coalesce("outer_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        )
    )
    by_doc = chosen.join(by_class, ["words_1", "words_2"]).select("doc_id", "class_id", "n_links")
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    return keys.join(by_doc, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def op7_jaccard_join(docs: DataFrame) -> DataFrame:
    """Class and number of links of every document."""
    return similar(docs)
