"""How far apart the sources of a language are, from bitmaps of terms by count.

Terms are runs of letters and of what is no ASCII, with A to Z in lower case. A
language keeps the terms that enough of its documents have. A source of a language
gives each kept term p = 1 + floor(10^9 (count + 2) / (N + 2V)), and two values p and
q are f = floor((p - q)^2 / (p + q)) apart. All arithmetic is on whole numbers.

1. A task counts terms and the documents that have them for its groups, and sends
   partial counts. No document is sent.
2. Kept terms are ordered by frequency and dealt into chunks of BITS; a term's place
   in its chunk is its bit. For each group and count, words of 64 bits say which terms
   have that count: one row for a word. Most terms are rare and share few counts, so a
   chunk of them is a few rows for each group. Frequent terms lie together.
3. Pairs of sources meet in each chunk. AND and popcount of their bitsets give the
   cells of the joint table of counts, and a cell adds its terms times f. Cells with a
   zero need no bitset: with z the value of no occurrence, the sum over all V terms is
       sum of cells n (f(p, q) - f(p, zq) - f(zp, q) + f(zp, zq))
     + sum of the first group's counts n (f(p, zq) - f(zp, zq)), the same for the other
     + V f(zp, zq).
   Sources come in blocks, and each pair of blocks in a chunk is a group of its own.
4. The terms that a group has most above its language come from the counts.

The result has each pair of sources of a language, so it grows with their square.

Nulls: null text, language and source are ''. Documents without terms still make
their group occur. Repeated documents count each. An empty table gives no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.tables import Batches, in_groups
from gridtally.session import written_once

#: Documents of a language that a kept term must be in.
LEAST_DOCS = 10
#: Terms of a group that are told.
TOP = 10
UNIT = 1_000_000_000
#: Terms of a chunk.
BITS = 512
#: Sources of a block.
SOURCES = 32
#: Different terms that a task counts before it sends what it has.
HELD = 1_000_000
#: Bytes of a text worked on at once, about.
PORTION = 4_000_000
#: Cells of a joint table worked on at once.
CELLS = 1 << 22

_LETTERS = bytes(
    b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, a portion at a time."""
    begin = 0
    while begin < len(text):
        end = min(begin + PORTION, len(text))
        # A portion ends at an ASCII character that is no letter; there may be none.
        while end < len(text) and _LETTERS[text[end]] != 0x20:
            end += 1
        yield text[begin:end].translate(_LETTERS).split()
        begin = end


def _counted(docs: DataFrame) -> DataFrame:
    """Counts (lang, source, term, n, docs); the empty term has the documents of the group."""

    def run(batches: Batches) -> Batches:
        n: dict[tuple[str, str], Counter] = {}
        seen: dict[tuple[str, str], Counter] = {}

        def flush() -> Batches:
            for (lang, source), counts in n.items():
                terms, having = list(counts), seen[lang, source]
                size = len(terms)
                columns = [
                    pa.array([lang] * size, pa.string()),
                    pa.array([source] * size, pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(counts.values(), pa.int64()),
                    pa.array((having[t] for t in terms), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            n.clear()
            seen.clear()

        grown = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
                key = lang, source
                counts = n.setdefault(key, Counter())
                having: set[bytes] = {b""}
                for terms in terms_of(text):
                    counts.update(terms)
                    having.update(terms)
                counts[b""] += 1
                seen.setdefault(key, Counter()).update(having)
                grown += len(having)
                if grown > HELD:
                    grown = sum(map(len, n.values()))
                    if grown > HELD // 2:
                        yield from flush()
                        grown = 0
        yield from flush()

    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    partial = texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, below: str) -> Column:
    """1 + floor(10^9 (count + 2) / below), exact for counts of any size; NULL if there are no terms."""
    small = f"({UNIT} * ({count} + 2)) div nullif({below}, 0)"
    large = f"(cast({UNIT} as decimal(11,0)) * cast({count} + 2 as decimal(20,0))) div nullif({below}, 0)"
    return F.expr(f"1 + CASE WHEN {count} < 9000000000 THEN {small} ELSE {large} END").cast("long")


def apart(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _placed(kept: DataFrame) -> DataFrame:
    """Kept terms with their chunk and bit, frequent ones together."""
    order = (F.desc("total"), F.asc("term"))
    parts = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = kept.repartitionByRange(parts, F.asc("lang"), *order).withColumn("_part", F.spark_partition_id())
    # Written once: a range partitioning worked out anew could be cut elsewhere.
    ranged = written_once(ranged, "terms")
    nth = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)) - 1
    return ranged.withColumn("_nth", nth).select(
        "lang", "term", "total",
        (F.col("_part") * F.lit(1 << 32) + F.expr(f"_nth div {BITS}")).alias("chunk"),
        (F.col("_nth") % BITS).alias("bit"),
    )


class Counts:
    """Written tables of counts: groups, languages, and the kept terms of each group."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS):
        counts = written_once(_counted(docs), "term-counts")
        found = counts.where("term <> ''")
        kept = found.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
        placed = _placed(kept.where(F.col("docs") >= least_docs).drop("docs"))
        held = written_once(found.select("lang", "source", "term", "n").join(placed, ["lang", "term"]), "kept-terms")
        terms = placed.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))
        sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
        groups = (
            counts.where("term = ''")
            .select("lang", "source")
            .join(sizes, ["lang", "source"], "left")
            .join(terms, "lang", "left")
            .na.fill(0, ["group_n", "terms", "lang_n"])
            .withColumn("below", F.expr("group_n + 2 * terms"))
            .withColumn("zero", share("0L", "below"))
            .withColumn("lang_below", F.expr("lang_n + 2 * terms"))
            .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
            .withColumn("numbers", F.count(F.lit(1)).over(Window.partitionBy("lang")))
        )
        #: (lang, source, terms, below, lang_below, zero, number, numbers), one row for each group.
        self.groups = written_once(groups.drop("group_n", "lang_n"), "groups")
        #: (lang, source, term, n, total, chunk, bit) and the group's columns, for terms that occur there.
        self.held = held.join(self.groups, ["lang", "source"]).withColumn("p", share("n", "below"))


def bitmaps(counts: Counts) -> DataFrame:
    """(lang, chunk, number, n, p, zero, numbers, word, bits): which terms of a chunk a group has n times."""
    return (
        counts.held.withColumn("word", F.expr("bit div 64"))
        .groupBy("lang", "chunk", "number", "n", "p", "zero", "numbers", "word")
        .agg(F.expr("bit_or(shiftleft(1L, bit % 64))").alias("bits"))
    )


def _levels(group: pa.Table) -> tuple[np.ndarray, ...]:
    """Source, p, value of zero and bitset of each count of each source, by source."""
    column = {c: group.column(c).to_numpy() for c in ("number", "n", "p", "zero", "word", "bits")}
    level, first, row = np.unique(
        np.stack((column["number"].astype(np.int64), column["n"]), axis=1), axis=0, return_index=True, return_inverse=True
    )
    bits = np.zeros((len(level), BITS // 64), np.uint64)
    bits[row.reshape(-1), column["word"].astype(np.int64)] = column["bits"].view(np.uint64)
    return level[:, 0], column["p"][first], column["zero"][first], bits


def joint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits the rows of two lists of bitsets share."""
    cells = np.zeros((len(a), len(b)), np.int16)
    for word in range(a.shape[1]):
        i, j = np.flatnonzero(a[:, word]), np.flatnonzero(b[:, word])
        if len(i) and len(j):
            cells[np.ix_(i, j)] += np.bitwise_count(a[i, word][:, None] & b[j, word][None, :])
    return cells


def cell_sums(counts: Counts) -> DataFrame:
    """(lang, a, b, value) of sources a < b: what the joint cells without a zero add."""
    blocks = F.sequence(F.lit(0), F.expr(f"cast((numbers - 1) div {SOURCES} as int)"))
    own = F.expr(f"cast(number div {SOURCES} as int)")
    keys = ["lang", "chunk", "low", "high"]
    rows = (
        bitmaps(counts)
        .withColumn("other", F.explode(blocks))
        .withColumn("low", F.least(own, F.col("other")))
        .withColumn("high", F.greatest(own, F.col("other")))
        .select(*keys, "number", "n", "p", "zero", "word", "bits")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
    )

    def run(batches: Batches) -> Batches:
        for group in in_groups(batches, keys):
            lang, _, low, high = (group.column(k)[0].as_py() for k in keys)
            number, p, zero, bits = _levels(group)
            far = number // SOURCES == high
            found: list[tuple[int, int, int]] = []
            for a in np.unique(number[number // SOURCES == low]).tolist():
                mine, theirs = np.flatnonzero(number == a), np.flatnonzero(far & (number > a))
                for begin in range(0, len(theirs), max(1, CELLS // len(mine))):
                    part = theirs[begin : begin + max(1, CELLS // len(mine))]
                    cells = joint(bits[mine], bits[part])
                    i, j = np.nonzero(cells)
                    i, j, n = mine[i], part[j], cells[i, j].astype(np.int64)
                    value = n * (_apart(p[i], p[j]) - _apart(p[i], zero[j]) - _apart(zero[i], p[j]) + _apart(zero[i], zero[j]))
                    total = np.zeros(SOURCES, np.int64)
                    np.add.at(total, number[j] % SOURCES, value)
                    found += [(a, high * SOURCES + b, int(total[b])) for b in np.flatnonzero(total).tolist()]
            if found:
                a, b, value = zip(*found)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(a), "a": a, "b": b, "value": value})

    return rows.mapInArrow(run, "lang string, a long, b long, value long")


def pairs(counts: Counts) -> DataFrame:
    """(lang, source, item, value) for each source and each other source of its language."""
    groups = counts.groups.where("numbers > 1")
    mine = groups.select("lang", F.col("number").cast("long").alias("a"), "source", "terms", "zero")
    others = groups.select("lang", F.col("number").cast("long").alias("b"), F.col("source").alias("item"), F.col("zero").alias("far_zero"))
    nothing = F.coalesce(F.col("terms") * apart("zero", "far_zero"), F.lit(0))
    base = mine.join(others, "lang").where("a <> b").select("lang", "a", "b", nothing.alias("value"))
    levels = (
        counts.held.where("numbers > 1")
        .groupBy("lang", F.col("number").cast("long").alias("a"), "p", "zero")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    half = (
        levels.join(others, "lang")
        .where("a <> b")
        .groupBy("lang", "a", "b")
        .agg(F.sum(F.col("n") * (apart("p", "far_zero") - apart("zero", "far_zero"))).alias("value"))
    )
    turned = lambda rows: rows.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    half, cells = written_once(half, "margins"), written_once(cell_sums(counts), "cells")
    every = base.unionByName(half).unionByName(turned(half)).unionByName(cells).unionByName(turned(cells))
    return (
        every.groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
        .join(mine.select("lang", "a", "source"), ["lang", "a"])
        .join(others.select("lang", "b", "item"), ["lang", "b"])
        .select("lang", "source", "item", "value")
    )


def excesses(counts: Counts, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the kept terms that a group has most above its language."""
    value = counts.held.withColumn("q", share("total", "lang_below")).where("p > q").withColumn("value", apart("p", "q"))
    return _ranked(value.select("lang", "source", F.col("term").alias("item"), "value")).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) with part ``pair`` or ``term``."""
    counts = Counts(docs, least_docs)
    columns = ("lang", "source", "part", "item", "value", "rank")
    by_pair = _ranked(pairs(counts)).withColumn("part", F.lit("pair")).select(*columns)
    return by_pair.unionByName(excesses(counts, top).withColumn("part", F.lit("term")).select(*columns))


def op11_source_divergence(docs: DataFrame) -> DataFrame:
    """Divergence of all sources within their languages, and the terms that set them apart."""
    return audit(docs)


def oracle() -> str:
    """The same in SQL, term by term."""
    apart = "CAST((p - q) * (p - q) // (p + q) AS BIGINT)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
words AS MATERIALIZED (
  SELECT id, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= {LEAST_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
held AS MATERIALIZED (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY w.lang, w.source, w.term),
groups AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce(sum(h.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs l USING (lang) LEFT JOIN held h USING (lang, source)
  GROUP BY g.lang, g.source, l.v),
shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS c, 1 + {UNIT} * (coalesce(h.n, 0) + 2)::HUGEINT // (g.n + 2 * g.v) AS p,
    1 + {UNIT} * (k.total + 2)::HUGEINT // (l.n + 2 * g.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN held h USING (lang, source, term)),
pair AS (
  SELECT lang, source, item, CAST(sum({apart}) AS BIGINT) AS value FROM (
    SELECT a.lang, a.source, b.source AS item, a.p, b.p AS q FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source)
  GROUP BY lang, source, item),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, {apart} FROM shares WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM rows)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
