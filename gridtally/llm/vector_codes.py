"""Vector codes by Lloyd's method that looks again only at entries that moved.

Components become whole numbers, floor(scale * x), and a vector is cut into equal
consecutive parts. Each part position has a codebook, which starts as that part of
the vectors of the smallest keys. A round assigns every part to its nearest entry and
then moves each entry to the floor of its parts' mean. All distances are whole numbers
and exact: as products of doubles while they stay below 2^53, else as Python integers.

A state table holds each vector's parts, assigned entries and exact distances. When
entries move, a part whose entry did not move was already no farther from it than from
any other that stayed, so it compares only the moved entries with its stored distance;
ties go to the lower index. Parts whose entry moved rescan the whole codebook. Each
round writes the next state and then drops the last one. Only codebooks, of a size that
the parameters fix, and their sums pass through the driver. If no entry moves, later
rounds would change nothing and are left out.

Vectors of each dimension have codebooks of their own. A vector that is empty, whose
dimension the parts do not divide, or that has a component beyond 64-bit whole numbers
gets a null code and error. A distance beyond them is given as their largest.

Nulls: null vectors and those with null or non-finite components give no row. A null
key comes last in the order of keys; rows of equal keys are ordered by the bytes of their parts.
Repeated rows count each. Without 256 vectors the codebook is as long as there are.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtally.llm.tables import Batches, mapped
from gridtally.session import scratch_path, written_once

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Labels whose totals are handed to every task.
HEAVY_LABELS = 10_000
#: Groups in which the vectors of the smallest keys are looked for first.
SALTS = 64

_LARGEST = 2**63 - 1
#: A distance that is not stored, as it is beyond 64 bits.
_UNKNOWN = -1

Books = dict[int, np.ndarray]  # dimension -> parts by entries by width


class Codes(NamedTuple):
    """Coded rows, and the codebooks that they were coded with."""

    rows: DataFrame  # vec_id, carried columns, dimension, codes binary, error
    books: Books


def _packed(whole: np.ndarray) -> bytes:
    """Whole numbers in the fewest of 2, 4 or 8 bytes each."""
    for kind in ("<i2", "<i4"):
        limits = np.iinfo(kind)
        if whole.min() >= limits.min and whole.max() <= limits.max:
            return whole.astype(kind).tobytes()
    return whole.astype("<i8").tobytes()


def _wholes(packed: list[bytes], dimension: int) -> np.ndarray:
    """Vectors out of :func:`_packed`."""
    sizes = {len(x) for x in packed}
    kinds = {size: f"<i{size // dimension}" for size in sizes}
    if len(sizes) == 1:
        return np.frombuffer(b"".join(packed), kinds[sizes.pop()]).reshape(-1, dimension).astype(np.int64)
    return np.stack([np.frombuffer(x, kinds[len(x)]).astype(np.int64) for x in packed])


def _reach(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows and entries, exact."""
    if 4 * x.shape[1] * max(_reach(x), _reach(entries)) ** 2 < 2**53:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)
    b = entries.astype(object)
    return np.stack([((row - b) ** 2).sum(axis=1) for row in x.astype(object)])


def _stored(distance: np.ndarray) -> np.ndarray:
    if distance.dtype != object:
        return distance.astype(np.int64)
    return np.asarray([d if d <= _LARGEST else _UNKNOWN for d in distance], np.int64)


def assign(
    x: np.ndarray, entries: np.ndarray, entry: np.ndarray | None, distance: np.ndarray | None, moved: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of each row, out of the last ones and the entries that moved."""
    now, far = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    stays = np.zeros(len(x), bool) if entry is None else ~moved[entry] & (distance != _UNKNOWN)
    again = np.flatnonzero(~stays)
    if len(again):
        table = squares(x[again], entries)
        now[again] = table.argmin(axis=1)
        far[again] = _stored(table[np.arange(len(again)), now[again]])
    stays = np.flatnonzero(stays)
    if len(stays):
        now[stays], far[stays] = entry[stays], distance[stays]
        active = np.flatnonzero(moved)
        if len(active):
            table = squares(x[stays], entries[active])
            best = table.argmin(axis=1)
            least = table[np.arange(len(stays)), best]
            nearer = (least < far[stays]) | ((least == far[stays]) & (active[best] < now[stays]))
            now[stays[nearer]] = active[best[nearer]]
            far[stays[nearer]] = _stored(least[nearer])
    return now, far


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dimension = batch.column("dimension").to_numpy()
    for each in np.unique(dimension).tolist():
        yield each, batch.take(pa.array(np.flatnonzero(dimension == each)))


def _blobs(rows: np.ndarray, kind: str) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(rows, kind)]


def _whole(vectors: DataFrame, carry: list[str], parts: int, scale: int) -> DataFrame:
    """Valid vectors as whole numbers; null where they cannot be coded."""
    valid = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), *carry, F.col("embedding").cast("array<double>").alias("embedding")
    ).where(F.coalesce(valid, F.lit(False)))

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        packed, sizes = [], []
        for x in batch.column("embedding").to_numpy(zero_copy_only=False):
            with np.errstate(over="ignore"):
                whole = np.floor(scale * np.asarray(x, np.float64))
            fits = len(x) and not len(x) % parts and np.abs(whole).max() < 2.0**63
            packed.append(_packed(whole.astype(np.int64)) if fits else None)
            sizes.append(len(x))
        yield {"vec_id": batch.column("vec_id"), **{c: batch.column(c) for c in carry}, "dimension": sizes, "parts": packed}

    return mapped(rows, step, f"{_schema(rows, carry)}, dimension int, parts binary")


def _schema(rows: DataFrame, carry: list[str]) -> str:
    return ", ".join(["vec_id long", *(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)])


def first_books(state: DataFrame, parts: int, entries: int) -> Books:
    """Parts of the vectors of the smallest keys, for each dimension.

    Rows are ranked in groups of tasks first, so that what meets in a task does not
    grow with the number of all tasks.
    """
    order = (F.asc_nulls_last("vec_id"), F.asc("parts"))
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")
    whole = state.where("parts is not null").select("vec_id", "dimension", "parts", salt)
    for keys in (["dimension", "salt"], ["dimension"]):
        whole = whole.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(f"nth <= {entries}")
    books: dict[int, list[tuple[int, bytes]]] = {}
    for row in whole.select("dimension", "nth", "parts").collect():  # ``entries`` vectors of each dimension
        books.setdefault(row.dimension, []).append((row.nth, bytes(row.parts)))
    return {
        size: _wholes([x for _, x in sorted(rows)], size).reshape(len(rows), parts, -1).transpose(1, 0, 2)
        for size, rows in books.items()
    }


def _assigned(state: DataFrame, carry: list[str], books: Books, moved: dict[int, np.ndarray], known: bool) -> DataFrame:
    """The state with entries and distances under new codebooks."""
    sent = state.sparkSession.sparkContext.broadcast((books, moved))
    keys = ["vec_id", *carry]

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        books, moved = sent.value
        for dimension, rows in _by_dimension(batch):
            own = {**{c: rows.column(c) for c in keys}, "dimension": rows.column("dimension"), "parts": rows.column("parts")}
            usable = rows.column("parts").is_valid().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(usable)
            entry, distance = [None] * len(rows), [None] * len(rows)
            if len(at):
                book = books[dimension]
                count, width = len(book), book.shape[2]
                x = _wholes([b for b in rows.column("parts").to_pylist() if b is not None], dimension).reshape(-1, count, width)
                was = [None, None]
                if known:
                    blobs = ((rows.column(c).to_pylist(), kind) for c, kind in (("entry", "<i4"), ("distance", "<i8")))
                    was = [np.frombuffer(b"".join(b[i] for i in at.tolist()), kind).reshape(-1, count).astype(np.int64) for b, kind in blobs]
                now = [
                    assign(x[:, p], book[p], *(None if w is None else w[:, p] for w in was), moved[dimension][p])
                    for p in range(count)
                ]
                entries = _blobs(np.stack([n for n, _ in now], axis=1), "<i4")
                distances = _blobs(np.stack([d for _, d in now], axis=1), "<i8")
                for i, a, b in zip(at.tolist(), entries, distances):
                    entry[i], distance[i] = a, b
            yield {**own, "entry": entry, "distance": distance}

    columns = [*keys, "dimension", "parts", *(["entry", "distance"] if known else [])]
    return mapped(state.select(*columns), step, f"{_schema(state, carry)}, dimension int, parts binary, entry binary, distance binary")


def _sums(state: DataFrame, parts: int) -> DataFrame:
    """(dimension, part, entry, place, value): sums of the parts at each entry; place -1 counts them."""

    def run(batches: Batches) -> Batches:
        total: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            for dimension, rows in _by_dimension(batch):
                x = _wholes(rows.column("parts").to_pylist(), dimension).reshape(len(rows), parts, -1)
                if _reach(x) >= 2**40:
                    x = x.astype(object)
                entry = np.frombuffer(b"".join(rows.column("entry").to_pylist()), "<i4").reshape(-1, parts)
                for p in range(parts):
                    order = np.argsort(entry[:, p], kind="stable")
                    used, first, count = np.unique(entry[order, p], return_index=True, return_counts=True)
                    sums = np.add.reduceat(x[order, p], first, axis=0)
                    for e, s, n in zip(used.tolist(), sums, count.tolist()):
                        key = (dimension, p, e)
                        row = np.append(s.astype(object), n)
                        total[key] = total[key] + row if key in total else row
        if total:
            width = [len(row) for row in total.values()]
            keys = np.repeat(np.asarray(list(total), np.int32), width, axis=0)
            place = np.concatenate([np.append(np.arange(n - 1), -1) for n in width]).astype(np.int32)
            value = [Decimal(v) for row in total.values() for v in row]
            columns = [*(pa.array(keys[:, k]) for k in range(3)), pa.array(place), pa.array(value, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["dimension", "part", "entry", "place", "value"])

    schema = "dimension int, part int, entry int, place int, value decimal(38,0)"
    rows = state.where("parts is not null").select("dimension", "parts", "entry").mapInArrow(run, schema)
    return rows.groupBy("dimension", "part", "entry", "place").agg(F.sum("value").alias("value"))


def _means(state: DataFrame, books: Books, parts: int) -> Books:
    """Codebooks whose used entries are the floor of their parts' mean."""
    sums: dict[tuple[int, int, int], dict[int, int]] = {}
    # As many rows as the codebooks have numbers.
    for row in _sums(state, parts).collect():
        sums.setdefault((row.dimension, row.part, row.entry), {})[row.place] = int(row.value)
    new = {size: book.copy() for size, book in books.items()}
    for (size, part, entry), held in sums.items():
        new[size][part, entry] = [held[place] // held[-1] for place in range(size // parts)]
    return new


def _drop(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def compress(
    vectors: DataFrame,
    carry: tuple[str, ...] = (),
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codes:
    """Codes (little-endian 32-bit entries, in order of the parts) and total error of every valid vector."""
    spark, carry = vectors.sparkSession, list(carry)
    path = scratch_path(spark, "whole-vectors")
    _whole(vectors, carry, parts, scale).write.parquet(path)
    state = spark.read.parquet(path)
    books = first_books(state, parts, entries)
    moved = {size: np.ones(book.shape[:2], bool) for size, book in books.items()}
    for turn in range(rounds + 1):
        following = _assigned(state, carry, books, moved, turn > 0)
        last, path = path, scratch_path(spark, f"vectors-{turn}")
        following.write.parquet(path)
        state = spark.read.schema(following.schema).parquet(path)
        _drop(spark, last)
        if turn == rounds or not any(m.any() for m in moved.values()):
            break
        new = _means(state, books, parts)
        moved = {size: (new[size] != books[size]).any(axis=2) for size in books}
        books = new

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        error = []
        for blob in batch.column("distance").to_pylist():
            each = [] if blob is None else np.frombuffer(blob, "<i8").tolist()
            error.append(None if blob is None else _LARGEST if _UNKNOWN in each else min(sum(each), _LARGEST))
        own = {c: batch.column(c) for c in ("vec_id", *carry, "dimension")}
        yield {**own, "codes": batch.column("entry"), "error": error}

    return Codes(mapped(state.drop("parts"), step, f"{_schema(state, carry)}, dimension int, codes binary, error long"), books)


def _with_totals(rows: DataFrame, key: str, value: str, total: str, heavy_keys: int = HEAVY_LABELS) -> DataFrame:
    """Rows with the sum over their key, nulls together.

    Totals of the most frequent keys are broadcast, at most ``heavy_keys`` of them; rows
    of others are joined by key, of which none is then frequent.
    """
    totals = written_once(
        rows.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias("_total"), F.count(F.lit(1)).alias("_n")), "totals"
    )
    if totals.limit(heavy_keys + 1).count() <= heavy_keys:
        joined = rows.join(F.broadcast(totals), F.col(key).eqNullSafe(F.col("_key")), "left")
        return joined.withColumn(total, F.col("_total")).drop("_key", "_total", "_n")
    heavy = totals.orderBy(F.desc("_n"), F.asc_nulls_first("_key")).limit(heavy_keys)
    joined = rows.join(F.broadcast(heavy), F.col(key).eqNullSafe(F.col("_key")), "left")
    common = joined.where("_n is not null").withColumn(total, F.col("_total")).drop("_key", "_total", "_n")
    rare = joined.where("_n is null").drop("_key", "_total", "_n")
    rest = rare.join(totals, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn(total, F.col("_total"))
    return common.unionByName(rest.drop("_key", "_total", "_n"))


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers with commas, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def op12_vector_codes(vectors: DataFrame) -> DataFrame:
    """Codes and errors of all embeddings with four codebooks of 256 entries."""
    coded = compress(vectors, ("label",))
    rows = written_once(coded.rows, "coded")
    # Two hex digits for each entry: the low byte of each 32-bit number.
    places = [F.hex(F.substring("codes", 4 * p + 1, 1)) for p in range(PARTS)]
    digests = rows.sparkSession.createDataFrame(
        [(size, digest(book)) for size, book in sorted(coded.books.items())], "dimension int, codebooks_sha256 string"
    )
    # As many rows as there are dimensions.
    with_digest = _with_totals(rows, "label", "error", "label_error").join(F.broadcast(digests), "dimension", "left")
    return with_digest.select("vec_id", F.lower(F.concat(*places)).alias("code"), "error", "label_error", "codebooks_sha256")


def oracle() -> str:
    """The same in SQL, for tables whose vectors have one dimension and moderate components."""
    def near(n: int) -> str:
        return f"""
distances{n} AS MATERIALIZED (
  SELECT p.id, p.part, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM parts p JOIN books{n} b USING (part)),
near{n} AS MATERIALIZED (SELECT id, part, min(d) AS d, arg_min(entry, d * 256 + entry) AS entry FROM distances{n} GROUP BY id, part)"""

    def moved(n: int) -> str:
        return f"""
sums{n} AS (
  SELECT part, entry, place, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM (
    SELECT n.part, n.entry, unnest(p.x) AS v, unnest(range(len(p.x))) AS place FROM near{n} n JOIN parts p USING (id, part))
  GROUP BY part, entry, place),
means{n} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY place) AS x FROM sums{n} GROUP BY part, entry),
books{n + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM books{n} b LEFT JOIN means{n} m USING (part, entry))"""

    steps = ",".join(near(n) + "," + moved(n) for n in range(ROUNDS)) + "," + near(ROUNDS)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT id, CAST(part AS INT) AS part, list_slice(x, part * len(x) // {PARTS} + 1, (part + 1) * len(x) // {PARTS}) AS x
  FROM kept CROSS JOIN range({PARTS}) r(part)),
books0 AS MATERIALIZED (SELECT part, id AS entry, x FROM parts WHERE id < {ENTRIES}),
{steps},
coded AS (
  SELECT id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY id),
sha AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books{ROUNDS})
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, s.codebooks_sha256
FROM kept k JOIN coded c USING (id) CROSS JOIN sha s"""
