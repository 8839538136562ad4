"""Region patterns of any number, met by key instead of being tried one by one.

A pattern mostly begins or ends with plain text. Its literal head is a node of a
prefix trie, whose nodes are rows here: a region meets a pattern only if one of
the region's own prefixes is the pattern's head, which is an equality join. A
pattern without a head is met by its literal tail in the same way. The regular
expression decides on what is left. Alternatives outside of groups (``a.*|b.*``)
hang on nodes of their own. Patterns with neither meet every region, in many tasks.
Each text is tried once, however many patterns give it.

The regions are those of distinct values, so what is shuffled grows with the
regions and patterns, not with usage rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("pue", "wue")

# Characters that stand for themselves wherever they are outside of a class.
_PLAIN = "[A-Za-z0-9_ -]*"

# A character, a dot or a plain class, with its quantifier. Of such parts alone, alternatives can be told apart by "|".
_PART = r"(?:[A-Za-z0-9_ .-]|\[\^?[A-Za-z0-9_ -]+\])(?:(?:[*+?]|\{[0-9]+(?:,[0-9]*)?\})[+?]?)?"
_ALTERNATIVES = rf"^(?:{_PART})*+(?:\|(?:{_PART})*+)++\z"

#: Tasks that share the regions which patterns without head and tail meet.
SPREAD = 64


def literal_head(pattern: Column) -> Column:
    """Text that all matches begin with; a character before a quantifier does not count."""
    run = F.regexp_extract(pattern, f"^{_PLAIN}", 0)
    follows = F.substring(pattern, F.length(run) + 1, F.lit(1))
    sure = F.when(follows.isin("*", "+", "?", "{"), F.substring(run, F.lit(1), F.length(run) - 1)).otherwise(run)
    return F.when(pattern.contains("|"), "").otherwise(sure)


def literal_tail(pattern: Column) -> Column:
    """Text that all matches end with; none where escapes or flags may give it another meaning."""
    doubtful = pattern.contains("|") | pattern.contains("\\") | pattern.contains("(?")
    return F.when(doubtful, "").otherwise(F.regexp_extract(pattern, f"{_PLAIN}$", 0))


def alternatives(pattern: Column) -> Column:
    """Patterns that together cover what this one covers; itself where groups or escapes may change that."""
    return F.when(pattern.rlike(_ALTERNATIVES), F.split(pattern, r"\|", -1)).otherwise(F.array(pattern))


def trie(patterns: DataFrame) -> DataFrame:
    """(side, key, text, pue, wue): each alternative on its node, with the first (ordinal, pattern, value) of each measure."""
    head, tail = literal_head(F.col("text")), literal_tail(F.col("text"))
    by_tail = (head == "") & (tail != "")
    order = ("ordinal", F.col("region").alias("pattern"))
    first = [F.min(F.when(F.col(m).isNotNull(), F.struct(*order, F.col(m).alias("value")))).alias(m) for m in MEASURES]
    texts = patterns.where("region IS NOT NULL").withColumn("text", F.explode(alternatives(F.col("region"))))
    return texts.groupBy("text").agg(*first).select(
        F.when(by_tail, "tail").otherwise("head").alias("side"),
        F.when(by_tail, tail).otherwise(head).alias("key"),
        "text",
        *MEASURES,
    )


def resolve(regions: DataFrame, patterns: DataFrame) -> DataFrame:
    """(region, pue, wue): for each region and measure the first pattern, by ordinal, that covers all of it.

    ``regions`` has distinct regions, without nulls; those that no pattern covers give no row.
    ``patterns`` has the columns of the efficiency table. Patterns that give an
    ordinal twice count in the order of their text.
    """
    region = F.col("region")
    ends = F.transform(F.sequence(F.lit(0), F.length(region)), lambda n: F.substring(region, F.lit(1), n))
    starts = F.transform(
        F.sequence(F.lit(1), F.length(region) + 1), lambda n: F.substring(region, n, F.length(region))
    )
    nodes = F.flatten(
        F.array(
            F.transform(ends, lambda x: F.struct(F.lit("head").alias("side"), x.alias("key"))),
            F.transform(starts, lambda x: F.struct(F.lit("tail").alias("side"), x.alias("key"))),
        )
    )
    texts = trie(patterns)
    kept = ("region", "text", *MEASURES)
    by_node = regions.select("region", F.inline(nodes)).where("key <> ''").join(texts.where("key <> ''"), ["side", "key"])
    # A number of its own, so that few bytes do not become few tasks.
    spread = regions.select("region").repartition(SPREAD, "region")
    by_all = spread.crossJoin(texts.where("key = ''"))
    met = by_node.select(*kept).unionByName(by_all.select(*kept))
    covers = met.where(F.expr("region RLIKE concat('^(?:', text, ')$')"))
    return covers.groupBy("region").agg(*[F.min(m).getField("value").alias(m) for m in MEASURES])
