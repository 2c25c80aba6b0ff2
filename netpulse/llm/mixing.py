"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed into cells (source, language, topic).  Each sweep scales the
cells' sampling probabilities so that the expected tokens of every source, then
language, then topic meet their targets, never above 1.  Documents are then drawn
one by one with their cell's probability.  Only cells take part in the sweeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netpulse.llm.common import WORD, stage, unused

DIMENSIONS = ("source", "lang", "topic")
# Share of all tokens to draw; exponent that evens out the shares; sweeps, and how many of them one plan holds.
TOKEN_SHARE = 0.5
EVENNESS = 0.8
SWEEPS = 12
SWEEPS_PER_PLAN = 4
# The cells are broadcast to the documents only up to this many, and joined by shuffle beyond.
BROADCAST_CELLS = 100_000
NO_TOPIC = -1


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the key's digest: the same in every run and on every cluster."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def described(docs: DataFrame, topics: DataFrame) -> DataFrame:
    """doc_id, key, source, lang, topic and tokens (words) per row; null categories become empty, no topic -1.

    ``topics`` has doc_id and topic; the smallest topic counts where an id repeats.
    """
    named = topics.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("topic").cast("long").alias("topic")).where("doc_id IS NOT NULL")
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("key"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("tokens"),
    )
    return own.join(named.groupBy("doc_id").agg(F.min("topic").alias("topic")), "doc_id", "left").withColumn("topic", F.coalesce("topic", F.lit(NO_TOPIC).cast("long")))


def row_key(doc_id: Column, text: Column) -> Column:
    """What the draw hangs on: the id, or the text's digest where the id is missing."""
    return F.coalesce(doc_id.cast("long").cast("string"), F.md5(F.coalesce(text, F.lit(""))))


def evened_targets(cells: DataFrame, dimension: str, evenness: float = EVENNESS) -> DataFrame:
    """A target share for each value of a dimension: its own share to a power below 1, scaled to sum to 1."""
    tokens = cells.groupBy(dimension).agg(F.sum("tokens").alias("t"))
    return tokens.select(dimension, (F.pow("t", F.lit(evenness)) / F.sum(F.pow("t", F.lit(evenness))).over(Window.partitionBy())).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], token_share: float = TOKEN_SHARE, sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (the dimensions, tokens) with the probability ``p`` of drawing a document.

    A value without a target keeps its own share.  A target beyond what a value
    holds draws all of it: probabilities stop at 1.  Cells without tokens are drawn
    at the plain share.
    """
    total = Window.partitionBy()
    goal = cells
    for d, target in targets.items():
        own_share = F.sum("tokens").over(Window.partitionBy(d)) / F.sum("tokens").over(total)
        goal = goal.join(target.select(d, F.col("share").alias("__share")), d, "left")
        goal = goal.withColumn(f"__goal_{d}", F.coalesce("__share", own_share) * F.sum("tokens").over(total) * token_share).drop("__share")
    state = goal.withColumn("p", F.lit(float(token_share)))
    for sweep in range(sweeps):
        for d in targets:
            held = F.sum(F.col("tokens") * F.col("p")).over(Window.partitionBy(d))
            state = state.withColumn("p", F.when(held > 0, F.least(F.lit(1.0), F.col("p") * F.col(f"__goal_{d}") / held)).otherwise(F.col("p")))
        if (sweep + 1) % SWEEPS_PER_PLAN == 0 or sweep + 1 == sweeps:
            state = stage(state, "raked")
    return state.select(*DIMENSIONS, "tokens", "p")


def calibrated(docs: DataFrame, topics: DataFrame, token_share: float = TOKEN_SHARE, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, key, source, lang, topic, tokens, probability, sampled.

    Null sources and languages are the category '', documents without topic the
    category -1; null and empty texts have no tokens and are drawn at their cell's
    probability.  Repeated rows share one draw.  An empty table gives no rows.
    """
    rows = stage(described(docs, topics), "described")
    cells = stage(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    wanted = targets or {d: evened_targets(cells, d) for d in DIMENSIONS}
    raked = rake(cells, wanted, token_share).drop("tokens")
    if raked.count() <= BROADCAST_CELLS:
        raked = F.broadcast(raked)
    joined = rows.join(raked, list(DIMENSIONS))
    return joined.select("doc_id", "key", *DIMENSIONS, "tokens", F.round("p", 9).alias("probability"), (uniform(F.col("key")) < F.col("p")).alias("sampled"))


def sample_mixture(docs: DataFrame, topics: DataFrame, token_share: float = TOKEN_SHARE) -> DataFrame:
    """The rows of ``docs`` that ``calibrated`` draws, all columns as they were, whatever their names.

    Rows that repeat a doc_id are drawn or left together, and so are rows without one that
    repeat a text; missing texts, sources and languages count as empty ones.
    """
    name = unused(docs, "row_key")
    drawn = calibrated(docs, topics, token_share).where("sampled").select(F.col("key").alias(name)).distinct()
    return docs.withColumn(name, row_key(F.col("doc_id"), F.col("text"))).join(drawn, name, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))


def oracle() -> str:
    """The registered query in DuckDB's SQL: the sweeps written out one after the other."""
    steps, last = [], "p0"
    for sweep in range(SWEEPS):
        for d in DIMENSIONS:
            name = f"p{sweep}_{d}"
            held = f"sum(tokens * p) OVER (PARTITION BY {d})"
            steps.append(f"{name} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN {held} > 0 THEN least(1.0, p * goal_{d} / {held}) ELSE p END AS p) FROM {last})")
            last = name
    goals, joins = [], []
    for d in DIMENSIONS:
        goals.append(f"s_{d}.share * (SELECT sum(tokens) FROM cells) * {TOKEN_SHARE} AS goal_{d}")
        joins.append(f"JOIN (SELECT {d}, pow(sum(tokens), {EVENNESS}) / sum(pow(sum(tokens), {EVENNESS})) OVER () AS share FROM cells GROUP BY {d}) s_{d} USING ({d})")
    keys = ", ".join(DIMENSIONS)
    return rf"""
        WITH topics AS (SELECT vec_id AS doc_id, min(label)::BIGINT AS topic FROM embeddings GROUP BY vec_id),
        described AS (
            SELECT d.doc_id, coalesce(d.doc_id::VARCHAR, md5(coalesce(text, ''))) AS key, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
                   coalesce(topic, {NO_TOPIC})::BIGINT AS topic, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS tokens
            FROM documents d LEFT JOIN topics t ON d.doc_id = t.doc_id),
        cells AS MATERIALIZED (SELECT {keys}, sum(tokens)::DOUBLE AS tokens FROM described GROUP BY ALL),
        p0 AS MATERIALIZED (SELECT cells.*, {", ".join(goals)}, {TOKEN_SHARE}::DOUBLE AS p FROM cells {" ".join(joins)}),
        {", ".join(steps)}
        SELECT doc_id, key, {keys}, r.tokens, round(p, 9) AS probability,
               ('0x' || substr(md5(key), 1, 13))::BIGINT / pow(2, 52) < p AS sampled
        FROM described r JOIN (SELECT {keys}, p FROM {last}) c USING ({keys})"""
