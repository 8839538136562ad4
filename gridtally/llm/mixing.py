"""Sampling a corpus so that its tokens follow target shares of several margins.

The token totals of all combinations of margin values (cells) are raked: round by
round, and margin by margin, the cells' weights are scaled to the margin's target
shares (iterative proportional fitting), until no share that a round meets is off
its target by TOLERANCE or more; margins that exclude each other end with a warning
after MOST_ROUNDS rounds. A cell's documents are then kept with
the probability min(1, s * weight / tokens), with the scale s such that the
expected tokens are the wanted fraction of all; cells that would need more than
they have are kept whole and the others make up for it. A document is in the
sample if the uniform number that its key's digest gives is below that.

All of it is on the table of cells, which Spark keeps distributed; the driver
sees sums only. Target shares are joined to the cells once, and the cells are
written after each margin, so every step is one sum and one join of a written table.

Nulls: a null margin value is the value ``unknown``; a null key counts as the
empty text in the digest; null tokens count as 0, and such documents follow their
cell. Repeated keys share their fate. Target shares of the values that occur are
scaled to 1; a value without a target has share 0, so its documents get
probability 0. Empty tables give no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.session import written_once

#: Raking ends when a round finds every margin's shares closer to their targets than this.
TOLERANCE = 1e-6
MOST_ROUNDS = 200
FRACTION = 0.7
MARGINS = ("source", "lang", "topic")
#: Exponents of the registered query: its targets are tempered token shares.
TEMPER = {"source": 0.5, "lang": 0.75, "topic": 0.5}


def topic() -> Column:
    """A topic by the form of the text: tables, shouted, marked-up or plain prose."""
    text = F.col("text")
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("!! "), "shouted")
        .when(text.contains("### ") | text.contains("$$$ ") | text.contains("&&& "), "marked")
        .otherwise("prose")
    )


def tokens() -> Column:
    """About four bytes of UTF-8 are a token; every text has one at least."""
    return F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / 4)).cast("long")


def described(docs: DataFrame) -> DataFrame:
    """Key, margins and tokens of each document."""
    value = {name: F.coalesce(F.col(name).cast("string"), F.lit("unknown")) for name in ("source", "lang")}
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(column.alias(name) for name, column in value.items()),
        F.coalesce(topic(), F.lit("prose")).alias("topic"),
        tokens().alias("tokens"),
    )


def tempered(cells: DataFrame, margin: str, exponent: float) -> DataFrame:
    """Target shares (value, share) in proportion to a power of the margin's tokens."""
    totals = cells.groupBy(margin).agg(F.sum("tokens").alias("t"))
    return totals.select(margin, F.pow(F.col("t").cast("double"), F.lit(exponent)).alias("share"))


def raked(
    cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = MOST_ROUNDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """Cells with a ``weight``; the weights add up to 1 and follow the targets."""
    columns = cells.columns
    for name, target in targets.items():
        target = written_once(target.join(cells.select(name).distinct(), name, "left_semi"), "targets")
        whole = target.agg(F.sum("share")).first()[0] or 1.0
        share = target.select(name, (F.col("share") / F.lit(whole)).alias(f"share_{name}"))
        cells = cells.join(share, name, "left").fillna(0.0, subset=[f"share_{name}"])
    error = 1.0
    cells = written_once(cells.withColumns({"weight": F.col("tokens").cast("double"), "error": F.lit(0.0)}), "cells")
    for _ in range(rounds):
        for n, name in enumerate(targets):
            share, found = F.col(f"share_{name}"), F.col("sum_weight")
            off = F.abs(share - found)
            sums = cells.groupBy(name).agg(F.sum("weight").alias("sum_weight"))
            factor = F.coalesce(share / F.nullif(found, F.lit(0.0)), F.lit(0.0))
            cells = cells.join(sums, name).withColumns(
                {"weight": F.col("weight") * factor, "error": F.greatest("error", off) if n else off}
            )
            cells = written_once(cells.drop("sum_weight"), "cells")
        error = cells.agg(F.max("error")).first()[0] or 0.0
        if error < tolerance:
            break
    else:
        warnings.warn(f"margins are missed by up to {error:.2g} after {rounds} rounds", stacklevel=2)
    return cells.select(*columns, "weight")


def calibrated(cells: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Cells with the ``prob`` of keeping each of their documents."""
    all_tokens, all_weight = cells.agg(F.sum("tokens"), F.sum("weight")).first()
    scale, before = 0.0, -1.0
    if all_weight:
        wanted = fraction * all_tokens
        scale = wanted / all_weight
        # Cells that are kept whole only get more, so this ends.
        while scale != before:
            before = scale
            full = F.col("weight") * scale >= F.col("tokens")
            have, rest = cells.agg(
                F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
            ).first()
            scale = max(before, (wanted - have) / rest) if rest else before
    ratio = F.coalesce(F.col("weight") * scale / F.nullif(F.col("tokens"), F.lit(0)), F.lit(0.0))
    return cells.withColumn("prob", F.least(F.lit(1.0), ratio))


def uniform() -> Column:
    """A number in [0, 1) that depends on the key alone."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mixed_sample(
    rows: DataFrame, targets: Mapping[str, float | DataFrame], fraction: float = FRACTION, rounds: int = MOST_ROUNDS
) -> DataFrame:
    """All rows (doc_id, margins, tokens) with ``prob`` and whether they are ``sampled``.

    A target is a frame (margin, share), or an exponent for tempered shares.
    """
    margins = list(targets)
    rows = rows.withColumns({name: F.coalesce(F.col(name).cast("string"), F.lit("unknown")) for name in margins})
    cells = rows.groupBy(*margins).agg(F.sum(F.coalesce("tokens", F.lit(0))).alias("tokens"))
    cells = written_once(cells, "cells")
    frames = {k: tempered(cells, k, v) if isinstance(v, float) else v for k, v in targets.items()}
    probs = written_once(calibrated(raked(cells, frames, rounds), fraction).select(*margins, "prob"), "cells")
    return rows.join(probs, margins).withColumn("sampled", uniform() < F.col("prob"))


def op6_mixed_sample(docs: DataFrame) -> DataFrame:
    """Probability and decision of every document, for tempered shares of source, language and topic."""
    return mixed_sample(described(docs), TEMPER).select(
        "doc_id", *MARGINS, "tokens", F.round("prob", 6).alias("prob"), "sampled"
    )


def oracle() -> str:
    """The registered query in SQL: rounds by recursion, the scale in closed form."""
    step, errors = "raked", []
    for name in MARGINS:
        errors.append(f"off_{name}")
        step = (
            f"(SELECT * EXCLUDE (share, found, off) REPLACE (CASE WHEN found > 0 THEN weight * share / found ELSE 0 END AS weight), "
            f"off AS off_{name} FROM ("
            f"SELECT c.*, t.share, sum(c.weight) OVER m AS found, abs(t.share - sum(c.weight) OVER m) AS off "
            f"FROM {step} c JOIN t_{name} t ON c.{name} = t.{name} WINDOW m AS (PARTITION BY c.{name})))"
        )
    targets = ", ".join(
        f"t_{name} AS (SELECT {name}, pow(sum(tokens), {TEMPER[name]}) / sum(pow(sum(tokens), {TEMPER[name]})) OVER () "
        f"AS share FROM cells GROUP BY {name})"
        for name in MARGINS
    )
    return f"""
WITH RECURSIVE described AS (
  SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang,
    CASE WHEN text LIKE '% | %' THEN 'table'
         WHEN text LIKE '%!! %' THEN 'shouted'
         WHEN text LIKE '%### %' OR text LIKE '%$$$ %' OR text LIKE '%&&& %' THEN 'marked'
         ELSE 'prose' END AS topic,
    CAST(greatest(1, ceil(coalesce(strlen(text), 0) / 4.0)) AS BIGINT) AS tokens
  FROM documents),
cells AS (
  SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens, CAST(sum(tokens) AS DOUBLE) AS weight
  FROM described GROUP BY ALL),
{targets},
raked AS (
  SELECT 0 AS round, source, lang, topic, tokens, weight, CAST(1 AS DOUBLE) AS error FROM cells
  UNION ALL
  SELECT round + 1, source, lang, topic, tokens, weight, max(greatest({", ".join(errors)})) OVER ()
  FROM {step} WHERE error >= {TOLERANCE} AND round < {MOST_ROUNDS}),
ranked AS (
  SELECT *, weight / tokens AS ratio,
    coalesce(sum(tokens) OVER before, 0) AS full_tokens,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest_weight,
    sum(tokens) OVER () AS all_tokens
  FROM (SELECT * FROM raked WHERE round = (SELECT max(round) FROM raked))
  WINDOW before AS (ORDER BY weight / tokens DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
scales AS (
  SELECT max(({FRACTION} * all_tokens - full_tokens) / rest_weight) AS best
  FROM ranked WHERE ratio * ({FRACTION} * all_tokens - full_tokens) / rest_weight < 1),
probs AS (
  SELECT source, lang, topic, least(1.0, weight * best / tokens) AS prob FROM ranked, scales)
SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, round(p.prob, 6) AS prob,
  CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS UBIGINT) / 4294967296.0 < p.prob AS sampled
FROM described d JOIN probs p ON d.source = p.source AND d.lang = p.lang AND d.topic = p.topic
"""
