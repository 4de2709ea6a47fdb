"""End to end on a synthetic set, and the streaming ingest."""

import json
import random

import pytest
from pyspark.sql import functions as F

from linkwright.plans import config as configuration
from linkwright.plans import model as M
from linkwright.plans.pipeline import Run
from linkwright.sources.tables import SOURCE_COLUMNS, TRUTH_COLUMNS
from linkwright.streaming import ingest


def dataset(folder, train=60, test=16):
    for split, count in (("train", train), ("test", test)):
        rows = {1: [], 2: [], 3: []}
        truth = []
        for i in range(count):
            rows[1].append((f"S1-{i:05d}", f"Cafe Number {i} Pvt Ltd", f"{100 + i}, Main St, {10000 + i}", "US"))
            single = split == "train" and i % 10 == 0
            same = (f"Unrelated Shop {i}", f"900 Far Road {50000 + i}") if single else (f"Cafe Number {i} Private Limited", f"{100 + i} Main Street {10000 + i}")
            rows[2].append((f"S2-{i:05d}", *same, "US"))
            rows[3].append((f"S3-{i:05d}", f"Warehouse Different {i}", f"{800 + i} Other Avenue {70000 + i}", "US"))
            truth.append((f"S1-{i:05d}", "" if single else f"S2-{i:05d}"))
        path = folder / split
        path.mkdir(parents=True)
        for number, own in rows.items():
            random.Random(0).shuffle(own)
            (path / f"{split}_source{number}.tsv").write_text("\n".join("\t".join(r) for r in [SOURCE_COLUMNS, *own]) + "\n")
        if split == "train":
            (path / "train_ground_truth.tsv").write_text("\n".join("\t".join(r) for r in [TRUTH_COLUMNS, *truth]) + "\n")
    return str(folder)


def test_run_all(spark, tmp_path):
    config = configuration.load(
        profile="smoke",
        candidate_generation={"method": "token_hash", "token_top_k": 5},
        training={"tuning_trials": 1, "max_boost_rounds": 10, "validation_fraction": 0.2, "holdout_fraction": 0.2, "threshold_steps": 11},
    )
    out = tmp_path / "out"
    result = Run(spark, dataset(tmp_path / "data"), str(out), config).run_all()
    assert result["holdout_score"] >= 0.8
    lists = [line.split("\t") for line in (out / "matching_results.tsv").read_text().splitlines()]
    assert lists[0] == TRUTH_COLUMNS and len(lists) == 17 and sum(bool(r[1]) for r in lists[1:]) >= 1
    assert len((out / "candidate_pairs.tsv").read_text().splitlines()) == 17
    run = Run(spark, str(tmp_path / "data"), str(out), config)
    assert run.validate(ids=True) == {}
    extra = (out / "matching_results.tsv").read_text().splitlines()
    (out / "matching_results.tsv").write_text("\n".join([extra[0], extra[1].split("\t")[0] + "\tS2-99999", *extra[2:]]) + "\n")
    (out / ".matching_results.tsv.crc").unlink(missing_ok=True)
    assert set(run.validate(ids=True)) == {"unknown_id", "warning"}
    (out / "candidate_pairs.tsv").unlink()
    assert run.validate() == {"file": [f"{out}/candidate_pairs.tsv is missing"]}
    recall = json.loads((out / "candidates/train/manifest.json").read_text())["recall"]
    assert recall["pair_recall"] >= 0.95
    assert json.loads((out / "run_metadata.json").read_text())["config_hash"] == configuration.config_hash(config)


def test_best_round():
    assert M.best_round([3.0, 2.0, 1.0, 1.5, 1.4], 2) == (3, True)
    assert M.best_round([3.0, 2.0, 1.0, 1.5], 2) == (3, False)
    assert M.best_round([1.0, 1.0, 1.0], 5) == (1, False)


def test_early_stopping_keeps_the_first_rounds(spark):
    rng = random.Random(1)
    rows = [tuple(float(rng.random()) for _ in M.FEATURES) for _ in range(300)]
    frame = spark.createDataFrame([(*r, int(rng.random() < 0.5 + 0.4 * (r[0] > 0.5))) for r in rows], ", ".join(f"{f} double" for f in M.FEATURES) + ", label int")
    train, checks = frame.limit(200), frame.limit(100)
    stopped = M.fit(train, checks, M.BASE | {"maxDepth": 3}, 64, 1, patience=2)
    trees = stopped.stages[-1]
    assert 1 <= trees.getNumTrees <= 64
    whole = M.fit(train, checks, M.BASE | {"maxDepth": 3}, trees.getNumTrees, 1)
    assert [t.toDebugString.split("\n", 1)[1] for t in trees.trees] == [t.toDebugString.split("\n", 1)[1] for t in whole.stages[-1].trees]


def test_draws():
    assert M.draws(3, 1)[0] == M.BASE and M.draws(3, 1) == M.draws(3, 1) and len(M.draws(100, 1)) == 65


def test_both_classes(spark):
    with pytest.raises(ValueError):
        M.both_classes(spark.createDataFrame([(1,)], "label int"), "train")


def test_stream_writes_by_country(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(2):
        (source / f"{i}.tsv").write_text("\t".join(SOURCE_COLUMNS) + f"\nS1-{i}\tＡcme\tx {i}\tIndia\n")
    for _ in range(2):  # the second run finds nothing new
        ingest.write_by_country(ingest.record_stream(spark, str(source), 1), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == 2 and {r[0] for r in rows.select("name_norm").distinct().collect()} == {"acme"}


def test_late_deliveries(spark, tmp_path):
    rows = spark.sql(
        "SELECT * FROM VALUES (1L, 'a', 'f', TIMESTAMP_NTZ'2025-01-01 00:00:00', TIMESTAMP_NTZ'2025-01-01 01:00:00'), (2L, 'a', 'f', TIMESTAMP_NTZ'2025-01-01 00:00:00', TIMESTAMP_NTZ'2025-01-02 01:00:00'), (3L, 'b', NULL, NULL, TIMESTAMP_NTZ'2025-01-01 02:00:00') AS t(delivery_id, entity_id, feed_code, recorded_at, delivered_at)"
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for name, frame, mode in (("firsts", ingest.first_deliveries(stream), "append"), ("windows", ingest.deliveries_per_window(stream), "complete")):
        frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.table("firsts").count() == 1
    assert {(r["feed_code"], r["deliveries"]) for r in spark.table("windows").collect()} == {("f", 1), ("unknown", 1)}
    batch = ingest.deliveries_per_window(rows).where(F.col("feed_code") == "f")
    assert batch.count() == 2
