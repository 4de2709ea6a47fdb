"""Entity-level F-beta, its macro mean, and the search for a decision threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTITY, TARGET = "source1_entity_id", "candidate_entity_id"


def f_beta(predicted: Column, actual: Column, hits: Column, beta: float = 0.5) -> Column:
    """F-beta from counts: 1 when both sets are empty, 0 when one is or when nothing agrees."""
    precision, recall = hits / F.greatest(predicted, F.lit(1)), hits / F.greatest(actual, F.lit(1))
    square = beta * beta
    score = (1 + square) * precision * recall / F.when(hits > 0, square * precision + recall).otherwise(1.0)
    return F.when((predicted == 0) & (actual == 0), 1.0).when(hits == 0, 0.0).otherwise(score)


def entity_scores(entities: DataFrame, truth: DataFrame, predicted: DataFrame, beta: float = 0.5) -> DataFrame:
    """``(source1_entity_id, predicted, actual, hits, score)`` for every entity; predictions for others are ignored."""
    links = truth.select(ENTITY, TARGET).distinct().withColumn("t", F.lit(1))
    guesses = predicted.select(ENTITY, TARGET).distinct().withColumn("p", F.lit(1))
    both = links.join(guesses, [ENTITY, TARGET], "full")
    counts = both.groupBy(ENTITY).agg(
        F.sum(F.coalesce("p", F.lit(0))).alias("predicted"), F.sum(F.coalesce("t", F.lit(0))).alias("actual"), F.sum(F.coalesce(F.col("t") * F.col("p"), F.lit(0))).alias("hits")
    )
    filled = entities.select(ENTITY).distinct().join(counts, ENTITY, "left").na.fill(0, ["predicted", "actual", "hits"])
    return filled.withColumn("score", f_beta(F.col("predicted"), F.col("actual"), F.col("hits"), beta))


def macro_score(entities: DataFrame, truth: DataFrame, predicted: DataFrame, beta: float = 0.5) -> DataFrame:
    """Mean over all entities; null where there is none."""
    return entity_scores(entities, truth, predicted, beta).agg(F.avg("score").alias("macro_score"), F.count(F.lit(1)).alias("entities"))


def thresholds(low: float, high: float, steps: int) -> list[float]:
    return [low + (high - low) * i / (steps - 1) for i in range(steps)]


def threshold_curve(entities: DataFrame, truth: DataFrame, scored: DataFrame, grid: list[float], beta: float = 0.5) -> DataFrame:
    """``(threshold, macro_score, predicted_links)`` in one pass: thresholds are a small array on each scored pair."""
    everyone = entities.select(ENTITY).distinct()
    array = F.array(*[F.lit(float(t)) for t in grid])
    links = truth.select(ENTITY, TARGET).distinct().withColumn("t", F.lit(1))
    known = scored.select(ENTITY, TARGET, "score").join(links, [ENTITY, TARGET], "left").join(everyone, ENTITY, "left_semi")
    # one row per entity and threshold that its score reaches
    hits = known.select(ENTITY, "t", F.explode(F.filter(array, lambda t: F.col("score") >= t)).alias("threshold"))
    counts = hits.groupBy(ENTITY, "threshold").agg(F.count(F.lit(1)).alias("predicted"), F.sum(F.coalesce("t", F.lit(0))).alias("hits"))
    actual = links.groupBy(ENTITY).agg(F.count(F.lit(1)).alias("actual"))
    grid_rows = everyone.join(actual, ENTITY, "left").na.fill(0, ["actual"]).select(ENTITY, "actual", F.explode(array).alias("threshold"))
    full = grid_rows.join(counts, [ENTITY, "threshold"], "left").na.fill(0, ["predicted", "hits"])
    return full.groupBy("threshold").agg(
        F.avg(f_beta(F.col("predicted"), F.col("actual"), F.col("hits"), beta)).alias("macro_score"), F.sum("predicted").alias("predicted_links")
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """The row of the best score; of equal scores the highest threshold."""
    return curve.orderBy(F.col("macro_score").desc(), F.col("threshold").desc()).limit(1)
