"""Gradient-boosted pair classifier: fit, random search, threshold, save and load."""

from __future__ import annotations

import time

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.operators import metrics
from linkwright.operators.features import FEATURES
from linkwright.operators.sampling import sample_query_groups
from linkwright.sources.tables import read_json, write_json

# The base model, and the ranges that random search draws from (log: on a logarithmic scale).
BASE = dict(stepSize=0.08, maxDepth=8, minInstancesPerNode=4, subsamplingRate=0.85, featureSubsetStrategy="0.85", maxBins=256)
SEARCH = dict(stepSize=(0.025, 0.16, "log"), maxDepth=(5, 10, "int"), minInstancesPerNode=(1, 20, "log int"), subsamplingRate=(0.68, 1.0, "real"), featureSubsetStrategy=(0.65, 1.0, "real"))
MOST_DRAWS = 64
LEAST_TRIAL_ROWS = 250_000


def both_classes(frame: DataFrame, name: str) -> None:
    if frame.select("label").distinct().count() < 2:
        raise ValueError(f"{name} rows need both labels")


def draws(trials: int, seed: int) -> list[dict]:
    """The base parameters and up to 64 random ones; more trials than that are cut."""
    rng, out = np.random.default_rng(seed), [dict(BASE)]
    for _ in range(min(trials - 1, MOST_DRAWS)):
        one = dict(BASE)
        for key, (low, high, kind) in SEARCH.items():
            if kind.startswith("log"):
                drawn = float(np.exp(rng.uniform(np.log(low), np.log(high))))
                one[key] = round(drawn) if kind == "log int" else drawn
            elif kind == "int":
                one[key] = int(rng.integers(low, high + 1))
            else:
                one[key] = float(rng.uniform(low, high))
        one["featureSubsetStrategy"] = f"{float(one['featureSubsetStrategy']):.4f}"
        out.append(one)
    return out[:trials]


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """Rounds to keep, and whether boosting is over: none of the ``patience`` rounds after the best one was better."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit(train: DataFrame, validation: DataFrame, params: dict, rounds: int, seed: int, patience: int | None = None, until: float | None = None) -> PipelineModel:
    """Boosted trees on the 29 features, of at most ``rounds`` rounds.

    With ``patience`` the rounds double until the loss on the validation rows has not fallen for so many rounds; the
    model then has the rounds of the least loss. ``until`` (monotonic seconds) ends the doubling.
    """
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector")

    def rows(frame: DataFrame) -> DataFrame:
        return vectors.transform(frame.withColumn("label", F.col("label").cast("double")))

    def trees(size: int):
        own = params | {"maxDepth": min(30, params["maxDepth"])}
        return GBTClassifier(featuresCol="vector", labelCol="label", maxIter=size, seed=seed, **own).fit(known)

    known, checks = rows(train), rows(validation)
    if patience is None:
        return PipelineModel([vectors, trees(rounds)])
    size = min(rounds, 2 * patience)
    while True:
        model = trees(size)
        kept, over = best_round(list(model.evaluateEachIteration(checks)), patience)
        if over or size >= rounds or (until is not None and time.monotonic() >= until):
            break
        size = min(rounds, 2 * size)
    # each round has a seed of its own, so fewer rounds are the first ones of more
    return PipelineModel([vectors, model if kept == size else trees(kept)])


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``score``: the probability of a match."""
    scored = model.transform(rows)
    return scored.withColumn("score", vector_to_array("probability")[1]).drop("vector", "probability", "rawPrediction", "prediction")


def choose_threshold(entities: DataFrame, truth: DataFrame, scored: DataFrame, training: dict) -> tuple[dict, list[dict]]:
    grid = metrics.thresholds(training["threshold_min"], training["threshold_max"], training["threshold_steps"])
    curve = [r.asDict() for r in metrics.threshold_curve(entities, truth, scored, grid).orderBy("threshold").collect()]
    best = max(curve, key=lambda r: (r["macro_score"], r["threshold"]))
    return best, curve


def tune(train: DataFrame, validation: DataFrame, entities: DataFrame, truth: DataFrame, training: dict, seed: int = 42, rounds: int | None = None) -> dict:
    """Random search by macro F-beta on validation queries, then a fit on all rows and the threshold on all validation entities.

    Trials use whole queries up to ``tuning_sample_rows``, and stop at their number or time; the earliest of equals wins.
    """
    both_classes(train, "train")
    both_classes(validation, "validation")
    size = training["tuning_sample_rows"]
    sample = sample_query_groups(train, size, seed).persist()
    checks = sample_query_groups(validation, max(LEAST_TRIAL_ROWS, size // 4), seed).persist()
    seen = checks.select("source1_entity_id").distinct()
    seen_truth = truth.join(seen, "source1_entity_id", "left_semi")
    rounds, patience = rounds or training["max_boost_rounds"], training["early_stopping_rounds"]
    until, trials, best = time.monotonic() + training["tuning_timeout_seconds"], [], None
    for number, params in enumerate(draws(training["tuning_trials"], seed)):
        if number and time.monotonic() > until:
            break
        model = fit(sample, checks, params, rounds, seed, patience, until)
        top, _ = choose_threshold(seen, seen_truth, score(model, checks), training)
        trials.append({"trial": number, "params": params, "score": top["macro_score"], "threshold": top["threshold"]})
        if best is None or top["macro_score"] > best["score"]:
            best = trials[-1]
    model = fit(train, validation, best["params"], rounds, seed, patience)
    top, curve = choose_threshold(entities, truth, score(model, validation), training)
    sample.unpersist()
    checks.unpersist()
    return {"model": model, "threshold": top["threshold"], "validation_score": top["macro_score"], "trials": trials, "curve": curve, "params": best["params"]}


def save(result: dict, folder: str) -> None:
    result["model"].write().overwrite().save(f"{folder}/trees")
    write_json({k: v for k, v in result.items() if k != "model"} | {"features": FEATURES}, f"{folder}/metadata.json")


def load(spark: SparkSession, folder: str) -> dict:
    values = read_json(spark, f"{folder}/metadata.json")
    if values["features"] != FEATURES:
        raise ValueError("the model was trained on other features")
    return values | {"model": PipelineModel.load(f"{folder}/trees")}
