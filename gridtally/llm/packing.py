"""Packing of token sequences by best fit, planned over counts of lengths.

Every text is encoded once, ends with an end token, and is cut only where it is
longer than a sequence. What is left are pieces of 1 to ``limit`` tokens.

1. The task that encodes a text numbers its pieces among those of their length in
   the task. Pieces are written once, thin: task, length, number, checksum.
2. Counts by task and length give each task's first rank within a length, and
   their sums the histogram of lengths, of at most ``limit`` rows.
3. The driver plans over the histogram: from the longest length down, all pieces
   of a length go where least room is left that still takes one, first into open
   sequences, then into new ones. Sequences with equal room are kept as ranges of
   numbers, and a step fills a range with so many pieces each. So the plan's size
   depends on ``limit``, not on how many pieces there are.
4. A piece finds its step by the rank within its length, and from that its
   sequence and its place there.

Encoding: texts are split at blanks, tabs and line breaks, which the tokenizer drops
before it merges anything, and each different word is encoded once in a while. Words of
ASCII and accented Latin letters are cut by the tokenizer's own rule and go straight to
its merges; all others go through the whole tokenizer. So the ids are those of the whole
text, at a fifth of the time.

Nulls: a null text is empty; it has the end token only, as one piece. A null key
stays null. Repeated rows are packed each. An empty table has no rows. Columns other
than key and text are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.tables import Batches, texts_of
from gridtally.llm.words import SLICE
from gridtally.session import written_once

#: Tokens of a sequence, at most.
LIMIT = 4096
#: The id that ends each text.
END = 1
#: Characters of words whose ids a process keeps.
KEPT = 6_000_000

_BLANK = re.compile("[ \t\r\n]")
#: Words that composing leaves as they are, and that have one lower-case letter for each letter.
_PLAIN = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
# Fixed value: how the vocabulary of the registered query cuts a lower-cased word, for plain words.
_CUTS = "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017f]+"
_CUT = re.compile(_CUTS)
# The rules of that vocabulary, as its file states them.
_NORMAL = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_RULE = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def vocabulary_path() -> str:
    """Where the vocabulary of the registered query lies, on the driver."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _portions(text: str) -> Iterator[str]:
    """The text in portions of about SLICE characters, cut at blanks only."""
    begin = 0
    while len(text) - begin > SLICE:
        blank = _BLANK.search(text, begin + SLICE)
        if blank is None:
            break
        yield text[begin : blank.start()]
        begin = blank.end()
    yield text[begin:]


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next free one."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    others = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + others.index(b)) for b in range(256)]


class Encoder:
    """Ids of texts as little-endian bytes, four for each."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.letters = _byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Plain words are cut here only if the vocabulary is of the kind whose rule is known.
        self.direct = json.loads(vocabulary)["pre_tokenizer"] == _RULE and json.loads(vocabulary)["normalizer"] == _NORMAL
        self.known: dict[str, bytes] = {}
        self.cuts: dict[str, bytes] = {}
        self.held = 0

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self._portion, _portions(text)))

    def _portion(self, text: str) -> bytes:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        new = set(words).difference(self.known)
        if new:
            if self.held > KEPT:
                self.known, self.cuts, self.held, new = {}, {}, 0, set(words)
            odd = [word for word in new if not (self.direct and self._plain(word))]
            for word, coded in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
                self.known[word] = pack_ids(coded.ids)
            self.held += sum(map(len, new))
        return b"".join(map(self.known.__getitem__, words))

    def _plain(self, word: str) -> bool:
        """Whether the word is plain; its ids are then known."""
        if not _PLAIN.fullmatch(word) or any([token in word for token in self.special]):
            return False
        coded = []
        for cut in _CUT.findall(word.lower()):
            ids = self.cuts.get(cut)
            if ids is None:
                spelt = cut if cut.isascii() else "".join([self.letters[b] for b in cut.encode()])
                ids = self.cuts[cut] = pack_ids([token.id for token in self.tokenizer.model.tokenize(spelt)])
            coded.append(ids)
        self.known[word] = b"".join(coded)
        return True


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)
def _encoder(vocabulary: str) -> Encoder:
    """One encoder for all tasks of a process."""
    return Encoder(vocabulary)


def pieces(
    docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, end: int = END, with_ids: bool = False
) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, task, nth), and ``ids`` if asked for.

    ``nth`` counts the task's pieces of a length from 0. ``ids`` are little-endian
    unsigned 32-bit numbers. The vocabulary is read on the driver and sent to the tasks.
    """
    with open(vocabulary or vocabulary_path(), encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    last = pack_ids([end])
    step = 4 * limit

    def run(batches: Batches) -> Batches:
        task, encode = TaskContext.get().partitionId(), _encoder(sent.value)
        seen = np.zeros(limit + 1, np.int64)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                ids = encode(text) + last
                for piece, start in enumerate(range(0, len(ids), step)):
                    part = ids[start : start + step]
                    length = len(part) // 4
                    row = (doc_id, piece, start // 4, length, zlib.crc32(part), task, int(seen[length]))
                    rows.append((*row, part) if with_ids else row)
                    seen[length] += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, schema + ", ids binary" * with_ids
    )


class Step(NamedTuple):
    """Pieces of a length from rank ``first`` on: ``each`` of them to a sequence from ``sequence`` on, at ``offset``."""

    length: int
    first: int
    sequence: int
    each: int
    offset: int


def plan(counts: dict[int, int], limit: int = LIMIT) -> list[Step]:
    """Best fit, longest first, over a histogram of lengths; steps by length and rank."""
    steps: list[Step] = []
    room: list[int] = []  # rooms of which there are sequences, ascending
    ranges: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, how many)
    opened = 0

    def put(left: int, first: int, many: int) -> None:
        if left and many:
            if left not in ranges:
                insort(room, left)
                ranges[left] = []
            ranges[left].append((first, many))

    for length in sorted(counts, reverse=True):
        rank, count = 0, counts[length]
        while count:
            at = bisect_left(room, length)
            if at == len(room):
                new = -(-count // (limit // length))
                put(limit, opened, new)
                opened += new
                continue
            left = room[at]
            first, many = ranges[left].pop()
            each = left // length
            full = min(many, count // each)
            for sequences, held in ((full, each), (int(many > full), min(each, count - full * each))):
                if sequences and held:
                    steps.append(Step(length, rank, first, held, limit - left))
                    put(left - held * length, first, sequences)
                    rank += sequences * held
                    count -= sequences * held
                    first += sequences
                    many -= sequences
            put(left, first, many)
            if not ranges[left]:
                del ranges[left]
                room.remove(left)
    return sorted(steps)


def packed(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Rows with ``sequence_id`` and ``offset`` for those of :func:`pieces`, which are to be a written table."""
    spark = rows.sparkSession
    counts = written_once(rows.groupBy("task", "length").agg(F.count(F.lit(1)).alias("_n")), "lengths")
    # One row for each length, so at most ``limit``.
    histogram = {row.length: row.n for row in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    steps = spark.sparkContext.broadcast(np.asarray(plan(histogram, limit), np.int64).reshape(-1, len(Step._fields)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("task", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    # The firsts grow with the tasks, so they are not for broadcasting.
    ranked = rows.join(firsts.hint("merge"), ["task", "length"]).withColumn("_rank", F.col("_first") + F.col("nth"))
    shift = 62 - limit.bit_length()
    kept = [c for c in rows.columns if c not in ("task", "nth")]

    def seat(batches: Batches) -> Batches:
        length, first, sequence, each, offset = steps.value.T
        keys = (length << shift) + first
        for batch in batches:
            if batch.num_rows:
                long, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
                at = np.searchsorted(keys, (long << shift) + rank, "right") - 1
                turn, place = np.divmod(rank - first[at], each[at])
                own = [batch.column(c) for c in kept]
                places = [pa.array(sequence[at] + turn), pa.array(offset[at] + place * long)]
                yield pa.RecordBatch.from_arrays(own + places, names=[*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in kept)
    return ranked.select(*kept, "_rank").mapInArrow(seat, schema + ", sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, end: int = END, with_ids: bool = False) -> DataFrame:
    """Every piece of every text with its sequence and its place there."""
    return packed(written_once(pieces(docs, vocabulary, limit, end, with_ids), "pieces"), limit)


def sequences(seated: DataFrame) -> DataFrame:
    """The sequences themselves: (sequence_id, ids, doc_ids, offsets), of pieces packed with their ids.

    A group is one sequence, so it holds at most ``limit`` tokens.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return (
        seated.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select("sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"))
    )


def op13_packed_sequences(docs: DataFrame) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    return pack(docs).select(*columns)
