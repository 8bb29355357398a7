"""Mixing of sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic; a cell weighs as many tokens as its documents
have. Rounds of raking scale the weights of the cells to the target shares of each source, then
language, then topic, until no marginal is off by more than `tolerance`; targets that cannot be met together
stop after `rounds` rounds, and the largest error is logged. Each cell's ratio of raked to own tokens, times one
scale for all, is the probability with which its documents stay; the scale is such that the expected tokens are
`fraction` of all, cells that would exceed 1 staying whole with the excess as a weight above 1. A document stays if a
hash of its id, as a number from 0 to 1, is below its cell's probability, so the same documents stay
each time and on every cluster.

A target is a dictionary of weights by value, or a power: the observed share to that power.
Values without a weight get none of that target's mass and leave. Up to FEW_CELLS cells, raking and
calibration run in one task on the table of cells, which Spark aggregates; more cells are raked by joins
with the sums of each marginal, one table a round. Documents are read and filtered by a join with the cells,
never gathered by cell.

The topic is the column `topic` where docs has one, or the expression given; else the form of the text.

Edge cases: null values of a dimension are the value '' ; a null or empty text has no tokens; documents
without tokens stay if their cell does, a cell without any tokens stays whole; repeated rows stay or leave together; a
null doc_id hashes as the empty string; an empty table gives no rows; all columns of docs stay as they are, and a
column of the result whose name docs has already gets an underscore after its name.
"""

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlake.llm.store import dropped, free_name, stored

ROUNDS, TOLERANCE = 200, 1e-12
#: Cells (rows of some 60 bytes) that one task rakes, and that are broadcast.
FEW_CELLS = 100_000
DIMS = ("source", "lang", "topic")
log = logging.getLogger(__name__)


def token_count(text: Column) -> Column:
    # each word becomes one mark: counting matches would make an array of all words of a text
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t-\\r]*+[^ \\t-\\r]++", "x")
    return F.length(F.rtrim(marks, F.lit(" \t\n\x0b\x0c\r"))).cast("long")


def form_of(text: Column, tokens: Column) -> Column:
    """A topic for corpora that carry none: the form of the text."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(t.contains(" | "), "table").when(t.contains("://"), "links").when(tokens < 100, "note").when(tokens < 400, "article").otherwise("essay")
    )


def target_shares(values: np.ndarray, tokens: np.ndarray, target: dict | float) -> np.ndarray:
    """For each cell, the share of all tokens that its value of a dimension is to have."""
    names, of = np.unique(values, return_inverse=True)
    own = np.bincount(of, tokens, len(names))
    if isinstance(target, dict):
        weight = np.array([float(target.get(n, 0.0)) for n in names])
    else:
        weight = np.where(own > 0, own, 1.0) ** float(target) * (own > 0)
    return (weight / weight.sum() if weight.sum() > 0 else weight)[of]


def rake(tokens: np.ndarray, dims: list[np.ndarray], shares: list[np.ndarray], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, float]:
    """(raked, error): tokens of the cells scaled, dimension after dimension, to the shares, and how far off a marginal was last."""
    raked, error = tokens.astype(np.float64), 0.0
    of = [np.unique(d, return_inverse=True)[1] for d in dims]
    for _ in range(rounds):
        error = 0.0
        for place, share in zip(of, shares):
            held = np.bincount(place, raked)[place]
            error = max(error, float(np.abs(held - share).max(initial=0)))
            raked = np.where(held > 0, raked * share / np.where(held > 0, held, 1.0), 0.0)
        if error < tolerance:
            break
    return raked, error


def calibrate(tokens: np.ndarray, raked: np.ndarray, fraction: float) -> tuple[np.ndarray, np.ndarray]:
    """(probability, weight) of each cell: documents stay with the one and count with the other.

    The largest ratios are capped at 1 in turn, until the scale for the others caps no more of them.
    """
    ratio = np.divide(raked, tokens, out=np.zeros(len(tokens)), where=tokens > 0)
    order = np.argsort(-ratio, kind="stable")
    t, r = tokens[order], ratio[order]
    rest = fraction * t.sum() - (np.cumsum(t) - t)
    mass = np.cumsum((t * r)[::-1])[::-1]
    own = np.divide(rest, mass, out=np.zeros(len(t)), where=mass > 0)
    fits = (own > 0) & (own * r <= 1)
    scale = own[fits].max() if fits.any() else None
    wanted = (1e300 if scale is None else scale) * ratio
    whole = tokens <= 0
    return np.where(whole, 1.0, np.minimum(wanted, 1.0)), np.where(whole | (scale is None), 1.0, np.maximum(wanted, 1.0))


PLAN = "p_source string, p_lang string, p_topic string, p double, w double, error double"


def planned(cells: DataFrame, targets: dict[str, dict | float], fraction: float, rounds: int, tolerance: float) -> DataFrame:
    """The probability and weight of each cell (PLAN), worked out in one task from the table of cells."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            rows = pa.Table.from_batches(held)
            tokens = rows.column("tokens").to_numpy()
            values = {d: np.array(rows.column(d).to_pylist(), object) for d in DIMS}
            shares = [target_shares(values[d], tokens, t) for d, t in targets.items()]
            raked, error = rake(tokens, [values[d] for d in targets], shares, rounds, tolerance)
            probability, weight = calibrate(tokens, raked, fraction)
            columns = [*(rows.column(d).combine_chunks() for d in DIMS), pa.array(probability), pa.array(weight), pa.array(np.full(len(tokens), error))]
            yield pa.record_batch(columns, names=[c.split()[0] for c in PLAN.split(", ")])

    # in a fixed order, so that sums come out the same each time
    return cells.coalesce(1).sortWithinPartitions(*DIMS).mapInArrow(plan, PLAN)


def planned_by_joins(cells: DataFrame, targets: dict[str, dict | float], fraction: float, rounds: int, tolerance: float) -> DataFrame:
    """The same of any number of cells: each marginal is an aggregate, joined back to the cells."""
    table = cells.withColumn("raked", F.col("tokens"))
    for d, target in targets.items():
        own = cells.groupBy(d).agg(F.sum("tokens").alias("own"))
        if isinstance(target, dict):
            weights = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in target.items()], f"{d} string, weight double")
            own = own.join(weights, d, "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
        else:
            own = own.withColumn("weight", F.when(F.col("own") > 0, F.pow("own", F.lit(float(target)))).otherwise(0.0))
        own = stored(own, "weights")
        total = own.agg(F.sum("weight")).first()[0] or 1.0
        table = table.join(own.select(d, (F.col("weight") / total).alias(f"t_{d}")), d)
    table, error = stored(table, "raked"), 0.0
    for _ in range(rounds):
        then, sums, error = table, [], 0.0
        for d in targets:
            held = stored(then.groupBy(d).agg(F.sum("raked").alias("held"), F.max(f"t_{d}").alias("share")), "held")
            error = max(error, held.agg(F.max(F.abs(F.col("held") - F.col("share")))).first()[0] or 0.0)
            then = then.join(held.select(d, "held"), d)
            then = then.withColumn("raked", F.when(F.col("held") > 0, F.col("raked") * F.col(f"t_{d}") / F.col("held")).otherwise(0.0)).drop("held")
            sums.append(held)
        then = stored(then, "raked")
        dropped(table, *sums)
        table = then
        if error < tolerance:
            break
    scale, some = scale_of(table, fraction), F.col("tokens") > 0
    wanted = F.col("raked") * F.lit(1e300 if scale is None else scale) / F.col("tokens")
    return table.select(
        *[F.col(d).alias(f"p_{d}") for d in DIMS], F.when(some, F.least(wanted, F.lit(1.0))).otherwise(1.0).alias("p"),
        F.when(some & F.lit(scale is not None), F.greatest(wanted, F.lit(1.0))).otherwise(1.0).alias("w"), F.lit(error).alias("error"),
    )


def scale_of(table: DataFrame, fraction: float, points: int = 64) -> float | None:
    """The scale at which the cells (tokens, raked) keep the fraction of all tokens; None if none does.

    What a scale keeps, the sum of min(tokens, scale * raked), is found for many scales in one aggregate;
    a few such passes narrow the place down until it is linear.
    """
    total, most = table.agg(F.sum("tokens"), F.sum(F.when(F.col("raked") > 0, F.col("tokens")))).first()
    goal = fraction * (total or 0.0)
    if not goal or (most or 0.0) <= goal:
        return None
    scales = np.logspace(-300, 300, points, base=10.0)
    for _ in range(12):
        kept = table.agg(*[F.sum(F.least(F.col("tokens"), F.col("raked") * F.lit(float(x)))).alias(f"k{i}") for i, x in enumerate(scales)]).first()
        above = next((i for i, x in enumerate(kept) if x >= goal), points - 1)
        lo, hi = float(scales[max(above - 1, 0)]), float(scales[above])
        low, high = kept[max(above - 1, 0)], kept[above]
        scales = np.geomspace(lo, hi, points) if hi > 2 * lo else np.linspace(lo, hi, points)
    return lo + (goal - low) * (hi - lo) / (high - low) if high > low else hi


def number_of(doc_id: Column, seed: int) -> Column:
    """A number from 0 to 1 by the hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(
    docs: DataFrame, targets: dict[str, dict | float] | None = None, fraction: float = 0.8, rounds: int = ROUNDS, tolerance: float = TOLERANCE, seed: int = 8,
    text: str = "text", doc_id: str = "doc_id", source: str = "source", lang: str = "lang", topic: Column | None = None,
) -> DataFrame:
    """The rows of docs that stay, with n_tokens (long), probability and weight (double), and topic where docs has none."""
    targets = targets or {"source": 0.5, "lang": 0.5, "topic": 0.5}
    name = lambda n: free_name(n, [*docs.columns, *(c.split()[0] for c in PLAN.split(", "))])
    held = {d: name(f"of_{d}") for d in DIMS}
    size, given = name("n_tokens"), "topic" in docs.columns
    rows = docs.withColumn(size, token_count(F.col(text)))
    value = topic if topic is not None else F.col("topic") if given else form_of(F.col(text), F.col(size))
    rows = rows.withColumns({held[d]: F.coalesce(c.cast("string"), F.lit("")) for d, c in zip(DIMS, (F.col(source), F.col(lang), value))})
    cells = stored(rows.groupBy(*[F.col(c).alias(d) for d, c in held.items()]).agg(F.sum(size).cast("double").alias("tokens")), "cells")
    few = cells.count() <= FEW_CELLS
    plan = stored((planned if few else planned_by_joins)(cells, targets, fraction, rounds, tolerance), "plan")
    error = plan.agg(F.max("error")).first()[0]
    if error is not None and error >= tolerance:
        log.warning("the targets cannot all be met: a marginal share is off by %.3g after %d rounds", error, rounds)
    ours = {c: name(f"plan_{c}") for c in plan.columns}
    plan = plan.withColumnsRenamed(ours)
    joined = rows.join(F.broadcast(plan) if few else plan, [F.col(held[d]) == F.col(ours[f"p_{d}"]) for d in DIMS])
    kept = joined.where(number_of(F.col(doc_id), seed) < F.col(ours["p"]))
    out = {name("probability"): F.col(ours["p"]), name("weight"): F.col(ours["w"])}
    if not given:
        out = {"topic": F.col(held["topic"]), **out}
    return kept.withColumns(out).drop(*held.values(), *ours.values())


def sql(fraction: float = 0.8, rounds: int = ROUNDS, seed: int = 8, power: float = 0.5) -> str:
    """DuckDB SQL for op8: the same rows as mix() of documents with its defaults."""
    targets = "\n".join(
        f", w_{d} AS (SELECT {d}, sum(tokens) ** {power} AS w FROM cells GROUP BY {d} HAVING sum(tokens) > 0)"
        f", t_{d} AS (SELECT {d}, w / (SELECT sum(w) FROM w_{d}) AS t_{d} FROM w_{d})" for d in DIMS
    )
    step = f"SELECT * FROM rounds WHERE i < {rounds}"
    for d in DIMS:
        held = f"sum(raked) OVER (PARTITION BY {d})"
        step = f"SELECT * REPLACE (CASE WHEN {held} > 0 THEN raked * coalesce(t_{d}, 0) / {held} ELSE 0 END AS raked) FROM ({step})"
    dims = ", ".join(DIMS)
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::BIGINT AS n FROM documents)
, docs AS (SELECT doc_id, source, lang, n, CASE WHEN contains(t, ' | ') THEN 'table' WHEN contains(t, '://') THEN 'links'
    WHEN n < 100 THEN 'note' WHEN n < 400 THEN 'article' ELSE 'essay' END AS topic FROM d)
, cells AS (SELECT {dims}, sum(n)::DOUBLE AS tokens FROM docs GROUP BY {dims})
{targets}
, rounds AS (SELECT 0 AS i, cells.*, tokens AS raked, t_source, t_lang, t_topic FROM cells
    LEFT JOIN t_source USING (source) LEFT JOIN t_lang USING (lang) LEFT JOIN t_topic USING (topic)
    UNION ALL SELECT * REPLACE (i + 1 AS i) FROM ({step}))
, ratios AS (SELECT {dims}, tokens, CASE WHEN tokens > 0 THEN raked / tokens ELSE 0 END AS ratio FROM rounds WHERE i = {rounds})
, sums AS (SELECT *, {fraction} * sum(tokens) OVER () - coalesce(sum(tokens) OVER (ORDER BY ratio DESC, {dims} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(tokens * ratio) OVER (ORDER BY ratio DESC, {dims} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS mass FROM ratios)
, owns AS (SELECT *, CASE WHEN mass > 0 THEN rest / mass END AS own FROM sums)
, scaled AS (SELECT *, (SELECT max(own) FROM owns WHERE own > 0 AND own * ratio <= 1) AS scale FROM owns)
, plan AS (SELECT {dims}, CASE WHEN tokens > 0 THEN least(coalesce(scale, 1e300) * ratio, 1.0) ELSE 1.0 END AS p,
    CASE WHEN scale IS NULL OR tokens <= 0 THEN 1.0 ELSE greatest(scale * ratio, 1.0) END AS w FROM scaled)
SELECT doc_id, source, lang, topic, n AS n_tokens, round(p, 6) AS probability, round(w, 6) AS weight FROM docs JOIN plan USING ({dims})
WHERE ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < p
"""
