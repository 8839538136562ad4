"""Near-duplicate vectors by cosine, with an inverted file and product quantisation.

Vectors are scaled to length 1, where a cosine of at least t is a distance of at
most r = sqrt(2 - 2t). Equal vectors are one class.

1. Coarse centroids and the codebooks of residual subspaces are fitted on a
   bounded sample (SAMPLE classes by hash). Every class is put into the inverted
   list of its nearest centroid, with the codes of its residual and the distance
   between the residual and what its codes stand for.
2. A query probes all lists but those from whose cell it is more than r away: a
   vector of such a list lies beyond the plane midway between the two centroids,
   so it is no loss. Where vectors have no groups that is most lists, and the work
   would grow with the square of the table. Where a trial on the sample says that
   it costs less, every class is put into lists of several random codes instead: of
   a number of random directions, the one that it has the largest part in. Two
   vectors of a given cosine share a list with a chance that depends on the cosine
   alone, whatever the data (``share``), and there are as many codes as make a pair
   at the threshold miss all of them less than once in 1 / MISS times; pairs
   beyond it are missed more rarely. With MISS = 0 only the bound is used.
3. In a list, distances come from lookup tables of the query's subspaces and the
   codes. A pair stays if that distance less the code's own error is at most r,
   which loses no link.
4. What stays gets its cosine in double precision. Links are counted for the
   query, of random lists in the first that the pair shares; a spanning forest of
   the links leaves the task, not the pairs.

Neighbouring lists lie in one section, so that a query is sent once to a section
and not to each list that it probes there. Sections of many members or queries are
cut into blocks, each pair of which is a group of its own; so are random lists.

Nulls: vectors that are null, zero, of another dimension than most, or that hold
null or non-finite components link with nothing; so do rows with a null vec_id,
whose component is null. If a vec_id comes with several vectors, the smallest
stands for it. Repeated rows link with each other. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.components import components
from gridtally.llm.jaccard import forest
from gridtally.llm.tables import Batches, in_groups, mapped
from gridtally.session import written_once

THRESHOLD = 0.9
#: Classes that the index is fitted on, at most.
SAMPLE = 20_000
#: Mean length of an inverted list, and the most lists there are.
LIST_LENGTH = 128
MOST_LISTS = 1024
SUBSPACES = 8
CODES = 256
#: Lists of one section, about.
SECTION = 32
#: Members and queries of one block.
MEMBERS = 4096
QUERIES = 8192
#: Chance that random lists miss a link at the threshold; with 0 they are not used.
MISS = 1e-9
#: Directions of a random code, and codes that make up a list, to choose from.
SIZES = (8, 16, 32, 64, 128, 256)
FACTORS = (1, 2, 3)
#: Rows of one block of a random list, and those of them looked up at once.
BLOCK = 4096
AT_ONCE = 512
#: Nanoseconds, about: a pair by probes and by random lists, a row of a random list,
#: a component of a direction.
PROBED, PAIR, ROW, COMPONENT = 100, 5, 15_000, 0.1
#: Classes of the sample that the costs are tried on, at most.
TRIAL = 4000
#: Distances are compared with this slack; cosines are not.
SLACK = 1e-6


class Index(NamedTuple):
    centroids: np.ndarray  # lists by dimension
    section: np.ndarray  # list -> section
    books: np.ndarray  # subspaces by codes by width
    width: int


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] + (y**2).sum(1) - 2 * x @ y.T, 0)


def _means(points: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centres of ``count`` groups (Lloyd's method)."""
    random = np.random.default_rng(1)
    centres = points[random.permutation(len(points))[:count]].copy()
    for _ in range(rounds):
        near = _squares(points, centres).argmin(axis=1)
        size = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


def fit(points: np.ndarray, lists: int) -> Index:
    centroids = _means(points, lists)
    residual = points - centroids[_squares(points, centroids).argmin(axis=1)]
    width = -(-points.shape[1] // SUBSPACES)
    padded = np.pad(residual, ((0, 0), (0, width * SUBSPACES - points.shape[1])))
    books = [_means(part, min(CODES, len(points))) for part in np.split(padded, SUBSPACES, axis=1)]
    middles = _means(centroids, -(-len(centroids) // SECTION))
    section = _squares(centroids, middles).argmin(axis=1)
    return Index(centroids, section, np.stack(books), width)


def _parts(index: Index, x: np.ndarray) -> list[np.ndarray]:
    return np.split(np.pad(x, ((0, 0), (0, index.width * SUBSPACES - x.shape[1]))), SUBSPACES, axis=1)


def encode(index: Index, points: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the residuals, and the distances from what they stand for."""
    codes, error = np.empty((len(points), SUBSPACES), np.uint8), np.zeros(len(points))
    for s, part in enumerate(_parts(index, points - index.centroids[home])):
        squares = _squares(part, index.books[s])
        codes[:, s] = squares.argmin(axis=1)
        error += ((part - index.books[s][codes[:, s]]) ** 2).sum(axis=1)
    return codes, np.sqrt(error)


def probes(index: Index, points: np.ndarray, home: np.ndarray, radius: float) -> np.ndarray:
    """Which lists each point has to probe."""
    squares = _squares(points, index.centroids)
    own = squares[np.arange(len(points)), home]
    apart = np.sqrt(_squares(index.centroids, index.centroids))[home]
    beyond = np.divide(squares - own[:, None], 2 * apart, out=np.zeros_like(squares), where=apart > 0)
    return beyond <= radius + SLACK


def share(size: int, cosine: float) -> float:
    """At least the chance that two vectors have their largest part in the same one of ``size`` random directions.

    Their parts in a normal direction are normal with the cosine as correlation, in any
    dimension. The joint density is summed over cells, with the probability below each
    cell's lower corner.
    """
    rho, step = min(max(cosine, -0.999), 0.999), 0.02
    x = np.arange(-6, 6, step) + step / 2
    a, b = x[:, None], x[None, :]
    density = np.zeros((len(x) + 1, len(x) + 1))
    density[1:, 1:] = np.exp(-(a**2 - 2 * rho * a * b + b**2) / (2 - 2 * rho**2))
    density /= density.sum()
    below = density.cumsum(axis=0).cumsum(axis=1)[:-1, :-1]
    return float(size * (density[1:, 1:] * below ** (size - 1)).sum())


def random_lists(directions: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The random list of each point in each turn; directions are turns by factors by size by dimension."""
    points = points.astype(np.float32)
    lists = np.zeros((len(points), len(directions)), np.int32)
    for t, turn in enumerate(directions):
        for factor in turn:
            lists[:, t] = lists[:, t] * len(factor) + (points @ factor.T).argmax(axis=1)
    return lists


def chosen_directions(index: Index, points: np.ndarray, number: int, threshold: float) -> np.ndarray | None:
    """Directions of the random lists that cost least, or None if probing by the bound does."""
    if not MISS or len(points) < 2:
        return None
    trial = points[:TRIAL]
    home = _squares(trial, index.centroids).argmin(axis=1)
    least = PROBED * number * probes(index, trial, home, math.sqrt(2 - 2 * threshold)).mean()
    random, best = np.random.default_rng(3), None
    for size in SIZES:
        for factors in FACTORS:
            chance = max(share(size, threshold) ** factors, 1e-12)
            turns = math.ceil(math.log(MISS) / math.log1p(-chance))
            row = ROW + COMPONENT * points.shape[1] * size * factors
            if turns * row >= least:
                continue
            tried = random.normal(size=(1, factors, size, points.shape[1])).astype(np.float32)
            met = np.unique(random_lists(tried, trial), return_counts=True)[1]
            alike = (met * (met - 1.0)).sum() / (len(trial) * (len(trial) - 1))
            cost = turns * (row + PAIR * number * alike / 2)
            if cost < least:
                least, best = cost, (turns, factors, size, points.shape[1])
    return None if best is None else random.normal(size=best).astype(np.float32)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.float64) for x in column.to_pylist()])


def _close(index: Index, home: int, queries: np.ndarray, codes: np.ndarray, error: np.ndarray, radius: float) -> np.ndarray:
    """Which pairs may be within the radius, by asymmetric table lookup."""
    # Members by queries, so that whole rows of a table are added.
    total = np.zeros((len(codes), len(queries)), np.float32)
    for s, part in enumerate(_parts(index, queries - index.centroids[home])):
        total += np.ascontiguousarray(_squares(part, index.books[s]).T, np.float32)[codes[:, s]]
    return (total <= ((radius + error + 1e-4) ** 2)[:, None]).T


def _may_link(
    index: Index, queries: np.ndarray, codes: np.ndarray, home: np.ndarray, error: np.ndarray, radius: float
) -> np.ndarray:
    """As ``_close``, for members of several lists: inner products are looked up, whose tables serve all of them."""
    at, home = np.unique(home, return_inverse=True)
    queries = queries.astype(np.float32)
    # Members by queries, so that whole rows of a table are added.
    total = (index.centroids[at].astype(np.float32) @ queries.T)[home]
    stands = np.pad(index.centroids[at], ((0, 0), (0, index.width * SUBSPACES - queries.shape[1])))[home]
    for s, part in enumerate(_parts(index, queries)):
        total += (index.books[s].astype(np.float32) @ part.T)[codes[:, s]]
        stands[:, s * index.width : (s + 1) * index.width] += index.books[s][codes[:, s]]
    least = (1 + (stands**2).sum(axis=1) - (radius + error + 1e-4) ** 2) / 2
    return (total >= least.astype(np.float32)[:, None]).T


def _linked(unit: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Those of the pairs whose exact cosine reaches the threshold."""
    parts = [np.zeros(0)]
    for k in range(0, len(i), 20_000):
        parts.append(np.einsum("ij,ij->i", unit[i[k : k + 20_000]], unit[j[k : k + 20_000]]))
    linked = np.concatenate(parts) >= threshold
    return np.stack((i[linked], j[linked]))


def _by_section(index: Index, lists: np.ndarray) -> list[dict]:
    section = index.section[lists]
    return [{"section": int(s), "lists": lists[section == s].tolist()} for s in np.unique(section)]


def classes_of(vectors: DataFrame) -> DataFrame:
    """(embedding, rep, n) of equal valid vectors, and the key's class, through one vector for each key."""
    good = (
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    keyed = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(F.coalesce(good, F.lit(False)))
    chosen = keyed.groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies"))
    return written_once(chosen, "vectors")


def _blocks(
    rows: DataFrame, sizes: dict[int, int], others: dict[int, int], block: int, other: int, own: str, far: str
) -> DataFrame:
    """Rows of sections in blocks of their own, once for each block of the other side."""
    counts = [
        (k, max(1, math.ceil(sizes[k] / block)), max(1, math.ceil(others[k] / other))) for k in sizes.keys() & others.keys()
    ]
    # One row for each section, of which there are fewer than MOST_LISTS.
    table = F.broadcast(rows.sparkSession.createDataFrame(sorted(counts), "section int, mine int, theirs int"))
    return (
        rows.join(table, "section")
        .withColumn(own, F.pmod(F.xxhash64("rep"), F.col("mine")).cast("int"))
        .withColumn(far, F.explode(F.sequence(F.lit(0), F.col("theirs") - 1)))
        .drop("mine", "theirs")
    )


def links(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, links): rows with b null count the rows linked with class a outside of it, the others are forest edges."""
    radius = math.sqrt(2 - 2 * threshold)
    spark = classes.sparkSession
    number = classes.count()
    lists = max(1, min(MOST_LISTS, number // LIST_LENGTH))
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("unit").collect()
    if not sample:
        return spark.createDataFrame([], "a long, b long, links long")
    points = np.stack([np.frombuffer(r.unit, np.float64) for r in sample])
    index = fit(points, lists)
    directions = chosen_directions(index, points, number, threshold)
    if directions is not None:
        return _random_links(classes, index, directions, threshold)
    sent = spark.sparkContext.broadcast(index)

    def place(batch: pa.RecordBatch) -> Iterator[dict]:
        index, points = sent.value, _matrix(batch.column("unit"))
        home = _squares(points, index.centroids).argmin(axis=1)
        codes, error = encode(index, points, home)
        wanted = probes(index, points, home, radius)
        yield {
            "rep": batch.column("rep"),
            "n": batch.column("n"),
            "unit": batch.column("unit"),
            "list": home.astype(np.int32),
            "section": index.section[home].astype(np.int32),
            "codes": [row.tobytes() for row in codes],
            "error": error,
            "probes": [_by_section(index, np.flatnonzero(row)) for row in wanted],
        }

    schema = (
        "rep long, n long, unit binary, list int, section int, codes binary, error double, "
        "probes array<struct<section:int,lists:array<int>>>"
    )
    placed = written_once(mapped(classes.select("rep", "n", "unit"), place, schema), "index")
    asked = placed.select("rep", "n", "unit", F.inline("probes"))
    # At most MOST_LISTS counts each.
    member_counts = {row.section: row["count"] for row in placed.groupBy("section").count().collect()}
    query_counts = {row.section: row["count"] for row in asked.groupBy("section").count().collect()}
    members = _blocks(
        placed.select("section", "rep", "n", "unit", "list", "codes", "error", F.lit(None).cast("array<int>").alias("lists")),
        member_counts, query_counts, MEMBERS, QUERIES, "member_block", "query_block",
    )
    empty = {"list": "int", "codes": "binary", "error": "double"}
    queries = _blocks(
        asked.select("section", "rep", "n", "unit", "lists", *(F.lit(None).cast(t).alias(c) for c, t in empty.items())),
        query_counts, member_counts, QUERIES, MEMBERS, "query_block", "member_block",
    )
    keys = ["section", "member_block", "query_block"]
    together = members.unionByName(queries).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Batches) -> Batches:
        for group in in_groups(batches, keys):
            is_query = group.column("codes").is_null().to_numpy()
            member = np.flatnonzero(~is_query)
            query = np.flatnonzero(is_query)
            if not len(member) or not len(query):
                continue
            rep, n, unit = group.column("rep").to_numpy(), group.column("n").to_numpy(), _matrix(group.column("unit"))
            codes = np.stack([np.frombuffer(group.column("codes")[i].as_py(), np.uint8) for i in member.tolist()])
            error = group.column("error").to_numpy()[member]
            home = group.column("list").to_numpy(zero_copy_only=False)[member].astype(np.int64)
            asked_lists = group.column("lists").to_pylist()
            wanted = np.concatenate([np.asarray(asked_lists[q], np.int64) for q in query.tolist()])
            asker = np.repeat(query, [len(asked_lists[q]) for q in query.tolist()])
            pairs = [np.zeros((2, 0), np.int64)]
            for at in np.unique(home).tolist():
                mine, theirs = np.flatnonzero(home == at), asker[wanted == at]
                if len(theirs):
                    i, j = np.nonzero(_close(sent.value, at, unit[theirs], codes[mine], error[mine], radius))
                    i, j = theirs[i], member[mine[j]]
                    other = rep[i] != rep[j]
                    pairs.append(_linked(unit, i[other], j[other], threshold))
            i, j = np.concatenate(pairs, axis=1)
            if not len(i):
                continue
            count = np.bincount(i, n[j], len(rep)).astype(np.int64)
            have = np.flatnonzero(count)
            a, b = forest(rep[i], rep[j])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((rep[have], a))),
                    pa.concat_arrays([pa.nulls(len(have), pa.int64()), pa.array(b)]),
                    pa.array(np.concatenate((count[have], np.zeros(len(a), np.int64)))),
                ],
                names=["a", "b", "links"],
            )

    columns = (*keys, "rep", "n", "unit", "list", "codes", "error", "lists")
    return together.select(*columns).mapInArrow(run, "a long, b long, links long")


def _random_links(classes: DataFrame, index: Index, directions: np.ndarray, threshold: float) -> DataFrame:
    """The links of classes that share a random list, as of ``links``."""
    radius = math.sqrt(2 - 2 * threshold)
    sent = classes.sparkSession.sparkContext.broadcast((index, directions))

    def place(batch: pa.RecordBatch) -> Iterator[dict]:
        index, directions = sent.value
        points = _matrix(batch.column("unit"))
        home = _squares(points, index.centroids).argmin(axis=1)
        codes, error = encode(index, points, home)
        yield {
            "rep": batch.column("rep"),
            "n": batch.column("n"),
            "unit": batch.column("unit"),
            "home": home.astype(np.int32),
            "codes": [row.tobytes() for row in codes],
            "error": error,
            "dealt": list(random_lists(directions, points)),
        }

    schema = "rep long, n long, unit binary, home int, codes binary, error double, dealt array<int>"
    placed = written_once(mapped(classes.select("rep", "n", "unit"), place, schema), "index")
    places = placed.select("*", F.posexplode("dealt").alias("turn", "place"))
    # One row for each list longer than a block.
    long = places.groupBy("turn", "place").count().where(F.col("count") > BLOCK)
    blocks = long.select("turn", "place", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    keys = ["turn", "place", "low", "high"]
    together = (
        places.join(F.broadcast(blocks), ["turn", "place"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .drop("blocks", "other")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
    )

    def run(batches: Batches) -> Batches:
        index, _ = sent.value
        for group in in_groups(batches, keys):
            if group.num_rows < 2:
                continue
            turn, low, high = (group.column(name)[0].as_py() for name in ("turn", "low", "high"))
            rep, n, unit = group.column("rep").to_numpy(), group.column("n").to_numpy(), _matrix(group.column("unit"))
            codes = np.stack([np.frombuffer(x, np.uint8) for x in group.column("codes").to_pylist()])
            home, error, own = (group.column(name).to_numpy() for name in ("home", "error", "own"))
            dealt = group.column("dealt").combine_chunks().flatten().to_numpy().reshape(len(rep), -1)[:, :turn]
            one, other = np.flatnonzero(own == low), np.flatnonzero(own == high)
            count, edges = np.zeros(len(rep)), [np.zeros((2, 0), np.int64)]
            for k in range(0, len(one), AT_ONCE):
                query, member = one[k : k + AT_ONCE], other[k:] if low == high else other
                close = _may_link(index, unit[query], codes[member], home[member], error[member], radius)
                i, j = np.nonzero(np.triu(close, 1) if low == high else close)
                i, j = query[i], member[j]
                # A pair counts in the first list that it shares.
                for before in dealt.T:
                    new = before[i] != before[j]
                    i, j = i[new], j[new]
                i, j = _linked(unit, i, j, threshold)
                if len(i):
                    count += np.bincount(i, n[j], len(rep)) + np.bincount(j, n[i], len(rep))
                    edges.append(np.stack(forest(rep[i], rep[j])))
            have = np.flatnonzero(count)
            if not len(have):
                continue
            a, b = np.concatenate(edges, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((rep[have], a))),
                    pa.concat_arrays([pa.nulls(len(have), pa.int64()), pa.array(b)]),
                    pa.array(np.concatenate((count[have].astype(np.int64), np.zeros(len(a), np.int64)))),
                ],
                names=["a", "b", "links"],
            )

    columns = (*keys, "own", "rep", "n", "unit", "home", "codes", "error", "dealt")
    return together.select(*columns).mapInArrow(run, "a long, b long, links long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    chosen = classes_of(vectors)
    size = chosen.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()
    chosen = chosen.where(F.size("embedding") == (size["size"] if size else 0))
    members = chosen.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.sum("copies").alias("n"))

    def scale(batch: pa.RecordBatch) -> Iterator[dict]:
        points = np.stack([np.asarray(x, np.float64) for x in batch.column("embedding").to_numpy(zero_copy_only=False)])
        points /= np.abs(points).max(axis=1, keepdims=True)
        points /= np.sqrt((points**2).sum(axis=1, keepdims=True))
        yield {"rep": batch.column("rep"), "n": batch.column("n"), "unit": [row.tobytes() for row in points]}

    classes = written_once(mapped(members, scale, "rep long, n long, unit binary"), "classes")
    found = written_once(links(classes, threshold), "links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("links").alias("outer_links"))
    roots = components(found.where("b is not null").select("a", "b"), "links")
    by_class = (
        members.join(counts.withColumnRenamed("a", "rep"), "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "embedding",
            F.coalesce("root", "rep").alias("component_id"),
            (F.coalesce("outer_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        )
    )
    by_vector = chosen.join(by_class, "embedding").select("vec_id", "component_id", "n_links")
    keys = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    component = F.coalesce("component_id", "vec_id")
    return keys.join(by_vector, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def op4_near_vectors(vectors: DataFrame) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicates(vectors)
