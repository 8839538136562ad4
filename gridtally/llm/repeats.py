"""Byte strings of 400 bytes that occur more than once in a corpus, by refining buckets of suffixes.

A sparse suffix array: of all suffixes only those at anchors are sorted. The
anchor of a start is the smallest 16-gram of the 273 that follow it, so equal
strings of 400 bytes have their anchors at equal places, and the 128 bytes from
the anchor on lie inside the string.

Buckets are refined as in bucket-pointer refinement. The identifier of a bucket
is a digest of the bytes that its suffixes share. The q-gram bucket of a suffix
is refined by the bucket identifier at the offset where it ends, and each refined
identifier is used for the next refinement: 16, 32, 64, 128 and 256 bytes, and
from there 400. Identifiers at later offsets are at hand where the text is, so
only the sorting into buckets moves data, and after each sorting the suffixes
alone in their bucket are done:

1. by the 128 bytes from the anchor on: who is alone here shares no string;
2. by all bytes that strings of that anchor can cover (the context): whoever
   shares these shares every string in them;
3. what is left, the edges of repeated passages, by each string of 400 bytes.

Sorting counts are combined before they are shuffled, so a bucket that holds a
large part of the corpus weighs no more than others. Of equal contexts that one
task meets, only one goes on.

Nulls: a null text has no bytes. A text of fewer than 400 bytes loses nothing.
Rows of equal key and text are treated alike; as both hold the strings, repeated
texts of 400 bytes or more lose all bytes. Null keys are keys. Empty tables give
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.tables import mapped
from gridtally.llm.words import SLICE, mixed
from gridtally.session import written_once

LENGTH = 400
GRAM = 16
BUCKET = 128
#: Starts that may share an anchor: an anchor and BUCKET bytes fit into LENGTH.
SPAN = LENGTH - BUCKET + 1

_RANDOM = np.random.default_rng(13)
_BYTES = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LEVEL = _RANDOM.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _texts(column: pa.Array) -> list[bytes]:
    return [(text or "").encode("utf-8", "surrogatepass") for text in column.to_pylist()]


def _slices(texts: list[bytes]) -> Iterator[slice]:
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    stop = np.cumsum(count)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(begin - stop + count, count)


class Identifiers:
    """Bucket identifiers of all suffixes of some texts, which lie one after the other.

    An identifier that reaches past the end of its text means nothing.
    """

    def __init__(self, texts: list[bytes], keep: tuple[int, ...]):
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begin = np.concatenate(([0], np.cumsum(self.size)))
        data = np.frombuffer(b"".join(texts), np.uint8)
        ids = np.append(_BYTES[data], np.zeros(2 * LENGTH, np.uint64))
        self.by_length: dict[int, np.ndarray] = {}
        length, level = 1, 0
        while length <= max(keep):
            if length in keep:
                self.by_length[length] = ids.copy() if length < max(keep) else ids
            if length < max(keep):
                ids[:-length] = ids[:-length] * _LEVEL[level] + ids[length:]
                ids ^= ids >> np.uint64(29)
            length, level = 2 * length, level + 1

    def at(self, place: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        """Identifiers of strings of the given lengths (256 to 768 bytes)."""
        ids = self.by_length[256]
        rest = length - 256
        middle = ids[place + rest // 2] * _LEVEL[13]
        out = ids[place] * _LEVEL[12] + middle + ids[place + rest] * _LEVEL[14]
        return mixed(out + np.asarray(length).astype(np.uint64))

    def starts(self) -> np.ndarray:
        """Places at which a string of LENGTH bytes starts."""
        return _ranges(self.begin[:-1], np.maximum(self.size - LENGTH + 1, 0))

    def text_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, place, "right") - 1


def anchors(ids: Identifiers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last start of each run of starts that share an anchor."""
    starts = ids.starts()
    if not len(starts):
        return starts, starts, starts
    least = mixed(ids.by_length[GRAM])
    bits = np.uint64(max(20, int(len(least)).bit_length()))
    place = np.arange(len(least), dtype=np.uint64)
    least = (least >> bits << bits) | place
    width = 1
    while 2 * width <= SPAN:
        least[:-width] = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = SPAN - width
    least = np.minimum(least[starts], least[starts + rest]) & ((np.uint64(1) << bits) - np.uint64(1))
    anchor = least.astype(np.int64)
    change = np.flatnonzero((anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first = np.concatenate(([0], change))
    last = np.append(change, len(starts)) - 1
    return anchor[first], starts[first], starts[last]


#: Contexts of one bucket up to which they are compared in one task (about 100 MB).
TOGETHER = 4096
#: Bytes of contexts that are worked through together.
CHUNK = 2_000_000


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _merged(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of intervals that touch, by text; the intervals come sorted by text and begin."""
    if not len(text):
        return text, begin, end
    reach = np.maximum.accumulate(end + text * (1 << 40)) - text * (1 << 40)
    fresh = np.concatenate(([True], (text[1:] != text[:-1]) | (begin[1:] > reach[:-1])))
    first = np.flatnonzero(fresh)
    return text[first], begin[first], np.maximum.reduceat(end, first)


def suffixes(keyed: DataFrame) -> DataFrame:
    """Anchors of all texts, one for equal contexts in a slice, and what is known to repeat.

    Rows with a bucket: (doc_id, text_key, bucket, context, start, offset, starts,
    n): the context begins at ``start``, the anchor is ``offset`` bytes on, and
    strings begin at ``starts`` places; ``n`` equal contexts were met. Rows with a
    null bucket: bytes from ``start`` to ``starts`` repeat within the slice.
    """

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = _texts(batch.column("text"))
        doc_id, text_key = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
        for part in _slices(texts):
            ids = Identifiers(texts[part], (GRAM, BUCKET, 256))
            anchor, first, last = anchors(ids)
            if not len(anchor):
                continue
            bucket = ids.by_length[BUCKET][anchor]
            context = ids.at(first, last - first + LENGTH) + mixed((anchor - first).astype(np.uint64))
            pair = np.stack([bucket, context], axis=1)
            order = np.lexsort((context, bucket))
            new = np.concatenate(([True], (pair[order][1:] != pair[order][:-1]).any(axis=1)))
            group = np.empty(len(order), np.int64)
            group[order] = np.cumsum(new) - 1
            count = np.bincount(group)
            one = np.sort(order[new])
            text = ids.text_of(anchor)
            start = first - ids.begin[text]
            again = np.flatnonzero(count[group] > 1)
            t, begin, end = _merged(text[again], start[again], start[again] + (last - first)[again] + LENGTH)
            row = np.concatenate((text[one], t)).tolist()
            size = len(t)

            def column(values: np.ndarray, others: np.ndarray) -> np.ndarray:
                return np.concatenate((values[one], others))

            none = pa.nulls(size, pa.int64())
            yield {
                "doc_id": [doc_id[part][i] for i in row],
                "text_key": [text_key[part][i] for i in row],
                "bucket": pa.concat_arrays([pa.array(_signed(bucket[one])), none]),
                "context": pa.concat_arrays([pa.array(_signed(context[one])), none]),
                "start": column(start, begin),
                "offset": column(anchor - first, np.zeros(size, np.int64)),
                "starts": column(last - first + 1, end),
                "n": column(count[group], np.zeros(size, np.int64)),
            }

    schema = "doc_id long, text_key long, bucket long, context long, start long, offset long, starts long, n long"
    return mapped(keyed, step, schema)


def _windows(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number in the row, place identifier and string identifier of all strings of some contexts."""
    ids = Identifiers(rows.column("bytes").to_pylist(), (256,))
    starts = rows.column("starts").to_numpy()
    row = np.repeat(np.arange(len(starts)), starts)
    number = _ranges(np.zeros(len(starts), np.int64), starts)
    offset = rows.column("offset").to_numpy()[row] - number
    place = mixed(rows.column("bucket").to_numpy().view(np.uint64)[row] + offset.astype(np.uint64) * _LEVEL[15])
    return row, number, place, ids.at(ids.begin[row] + number, LENGTH)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated parts of contexts that come sorted by bucket."""

    def result(rows: pa.RecordBatch) -> pa.RecordBatch:
        row, number, place, string = _windows(rows)
        n = rows.column("n").to_numpy()
        _, same = np.unique(mixed(place + string), return_inverse=True)
        repeated = (np.bincount(same, n[row])[same] > 1) & (n[row] == 1)
        row, number = row[repeated], number[repeated]
        row, begin, end = _merged(row, number, number + LENGTH)
        start = rows.column("start").to_numpy()[row]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": rows.column("doc_id").take(pa.array(row)),
                "text_key": rows.column("text_key").take(pa.array(row)),
                "start": start + begin,
                "stop": start + end,
            }
        )

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("bytes").nbytes
        if size >= CHUNK:
            rows = joined(held)
            bucket = rows.column("bucket").to_numpy()
            cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
            if cut:
                yield result(rows.slice(0, cut))
            held, size = [rows.slice(cut)], 0
    if held:
        yield result(joined(held))


def repeats(keyed: DataFrame) -> DataFrame:
    """Byte intervals (doc_id, text_key, start, stop) that together hold all repeated strings."""
    found = written_once(suffixes(keyed), "suffixes")
    key = ["doc_id", "text_key"]
    known = found.where("bucket is null").select(*key, "start", F.col("starts").alias("stop"))
    placed = found.where("bucket is not null")
    stop = (F.col("start") + F.col("starts") + LENGTH - 1).alias("stop")
    buckets = placed.groupBy("bucket").agg(
        F.sum("n").alias("members"), F.min("context").alias("low"), F.max("context").alias("high")
    )
    # Read from a table, so that Spark may split a bucket of many suffixes over several tasks.
    buckets = written_once(buckets.where("members > 1"), "buckets")
    shared = written_once(placed.join(buckets, "bucket"), "suffixes")
    alike = shared.where("low = high").select(*key, "start", stop)
    unlike = shared.where("low <> high").drop("members", "low", "high")
    contexts = unlike.groupBy("bucket", "context").agg(
        F.sum("n").alias("n"), F.min(F.struct(*key, "start", "offset", "starts")).alias("one")
    )
    contexts = written_once(contexts.select("bucket", "context", "n", "one.*"), "contexts")
    twice = contexts.where("n > 1").select("bucket", "context")
    resolved = unlike.join(twice, ["bucket", "context"]).select(*key, "start", stop)
    # One bucket in TOGETHER contexts at most, so that no bucket's contexts have to meet here.
    crowded = contexts.groupBy("bucket").agg(F.count(F.lit(1)).alias("contexts")).where(F.col("contexts") > TOGETHER)
    wanted = contexts.join(F.broadcast(crowded), "bucket", "left").select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "bucket", "n", "start", "offset", "starts", "contexts"
    )
    cut = keyed.join(wanted, keyed.doc_id.eqNullSafe(wanted._doc) & (keyed.text_key == wanted._key)).select(
        *key,
        *("bucket", "n", "start", "offset", "starts", "contexts"),
        F.expr(f"substring(cast(text as binary), cast(start + 1 as int), cast(starts + {LENGTH - 1} as int))").alias("bytes"),
    )
    # A repeated row gives its contexts once more; the first is enough.
    few = cut.where("contexts is null").repartition("bucket").sortWithinPartitions("bucket", *key, "start")
    compared = few.mapInArrow(_compared, "doc_id long, text_key long, start long, stop long")
    return (
        known.unionByName(alike).unionByName(resolved).unionByName(compared).unionByName(_one_by_one(cut, key))
    )


def _one_by_one(cut: DataFrame, key: list[str]) -> DataFrame:
    """Repeated strings of buckets of many contexts, each string a row."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        row, number, place, string = _windows(batch)
        yield {
            **{name: batch.column(name).take(pa.array(row)) for name in (*key, "n")},
            "start": batch.column("start").to_numpy()[row] + number,
            "place": _signed(place),
            "string": _signed(string),
        }

    many = cut.where("contexts is not null").drop("contexts")
    strings = mapped(many, step, "doc_id long, text_key long, n long, start long, place long, string long")
    repeated = strings.groupBy("place", "string").agg(F.sum("n").alias("members")).where("members > 1")
    return (
        strings.where("n = 1")
        .join(repeated, ["place", "string"])
        .select(*key, "start", (F.col("start") + LENGTH).alias("stop"))
    )


_RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "removed", "kept")


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text, removed, kept) of every row.

    ``kept`` are the remaining bytes and ``kept_text`` their text, in which a character
    of which only some bytes remain is U+FFFD; ``removed`` has the maximal runs of
    removed bytes as start:stop, joined with commas.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")
    )
    spans = repeats(keyed).groupBy("doc_id", "text_key")
    # A set: a text that comes many times under one key gives its spans once.
    spans = spans.agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "spans")
    joined = keyed.join(spans, keyed.doc_id.eqNullSafe(spans._doc) & (keyed.text_key == spans._key), "left")

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        rows: dict[str, list] = {name: [] for name in _RESULT}
        for text, spans in zip(_texts(batch.column("text")), batch.column("spans")):
            parts, at, runs, removed = [], 0, 0, ""
            if spans.is_valid and len(spans.values):
                start = spans.values.field("start").to_numpy()
                stop = spans.values.field("stop").to_numpy()
                order = np.argsort(start, kind="stable")
                _, start, stop = _merged(np.zeros(len(order), np.int64), start[order], stop[order])
                runs = len(start)
                removed = ",".join([f"{a}:{b}" for a, b in zip(start.tolist(), stop.tolist())])
                for begin, end in zip(start.tolist(), stop.tolist()):
                    parts.append(text[at:begin])
                    at = end
            kept = b"".join([*parts, text[at:]])
            digest, shown = hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")
            for name, value in zip(rows, (len(text), len(text) - len(kept), runs, digest, shown, removed, kept)):
                rows[name].append(value)
        yield {"doc_id": batch.column("doc_id"), **rows}

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string, removed string, kept binary"
    return mapped(joined.select("doc_id", "text", "spans"), step, schema)


def op8_repeated_bytes(docs: DataFrame) -> DataFrame:
    """What is left of every document without repeated strings of 400 bytes."""
    return without_repeats(docs).drop("kept")
