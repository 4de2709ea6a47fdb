import pandas as pd
import pytest

from linkwright.operators import metrics, profile, sampling, submission

PAIR = "source1_entity_id string, candidate_entity_id string"


def frames(spark, truth, predicted, entities=("S1-1", "S1-2")):
    return (
        spark.createDataFrame([(e,) for e in entities], "source1_entity_id string"),
        spark.createDataFrame(truth, PAIR),
        spark.createDataFrame(predicted, PAIR),
    )


def test_macro_score_counts_singletons(spark):
    assert metrics.macro_score(*frames(spark, [("S1-1", "S2-1")], [("S1-1", "S2-1")])).first()["macro_score"] == 1.0
    wrong = metrics.macro_score(*frames(spark, [("S1-1", "S2-1")], [("S1-1", "S2-1"), ("S1-2", "S2-9"), ("S1-7", "S2-1")]))
    assert wrong.first()["macro_score"] == 0.5


def test_half_right(spark):
    rows = metrics.entity_scores(*frames(spark, [("S1-1", "a"), ("S1-1", "b")], [("S1-1", "a"), ("S1-1", "x")], ["S1-1"])).collect()
    assert rows[0]["score"] == pytest.approx(0.5)


def test_threshold_curve_against_single_thresholds(spark):
    entities, truth, _ = frames(spark, [("S1-1", "a"), ("S1-2", "b")], [], ["S1-1", "S1-2", "S1-3"])
    scored = spark.createDataFrame([("S1-1", "a", 0.9), ("S1-1", "x", 0.5), ("S1-2", "b", 0.4), ("S1-3", "y", 0.3)], PAIR + ", score double")
    grid = metrics.thresholds(0.2, 1.0, 9)
    curve = {r["threshold"]: r["macro_score"] for r in metrics.threshold_curve(entities, truth, scored, grid).collect()}
    assert len(curve) == 9
    for t in grid:
        assert curve[t] == pytest.approx(metrics.macro_score(entities, truth, submission.matches_at(scored, t)).first()["macro_score"])


def test_highest_of_equal_thresholds(spark):
    curve = spark.createDataFrame([(0.2, 1.0, 3), (0.4, 1.0, 3), (0.6, 0.5, 2)], "threshold double, macro_score double, predicted_links long")
    assert metrics.best_threshold(curve).first()["threshold"] == 0.4


def test_output_lists(spark):
    entities, _, _ = frames(spark, [], [], ["S1-1", "S1-2", "S1-3"])
    scored = spark.createDataFrame([("S1-1", "S3-1", 0.9), ("S1-1", "S2-1", 0.8), ("S1-2", "S2-2", 0.7)], PAIR + ", score double")
    rows = submission.id_lists(entities, submission.matches_at(scored, 0.8)).collect()
    assert [tuple(r) for r in rows] == [("S1-1", "S2-1,S3-1"), ("S1-2", ""), ("S1-3", "")]


def test_report_names_every_offence(spark):
    rows = spark.createDataFrame(
        [("S1-1", "S2-1,S2-1"), ("S1-1", ""), ("S1-2", "S1-9,X-1"), ("S1-9", None)], "source1_entity_id string, matched_entity_ids string"
    )
    required = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "source1_entity_id string")
    known = spark.createDataFrame([("S2-1",), ("S1-9",)], "entity_id string")
    found = {r["category"]: (r["offenders"], r["examples"]) for r in submission.report(rows, required, known).collect()}
    assert found == {
        "duplicate_entity": (1, "S1-1"), "duplicate_in_list": (1, "S1-1:S2-1"), "self_match": (1, "S1-2:S1-9"), "bad_prefix": (1, "S1-2:X-1"),
        "missing_entity": (1, "S1-3"), "unexpected_entity": (1, "S1-9"), "unknown_id": (1, "S1-2:X-1"),
    }


def test_relation_and_parts(spark):
    matches = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string")
    pairs = spark.createDataFrame([("S1-1", "S2-1,S2-2"), ("S1-2", "")], "source1_entity_id string, candidate_entity_ids string")
    assert submission.relation(matches, pairs) == {"entities": 2, "matched_links": 1, "candidate_links": 2}
    with pytest.raises(ValueError):
        submission.relation(matches, pairs.where("source1_entity_id = 'S1-1'"))
    with pytest.raises(ValueError):
        submission.combine_parts([matches, matches])
    assert [r[0] for r in submission.combine_parts([matches.where("source1_entity_id = 'S1-2'"), matches.where("source1_entity_id = 'S1-1'")]).collect()] == ["S1-1", "S1-2"]


def test_file_report(spark):
    header = ["source1_entity_id", "matched_entity_ids"]

    def report(*lines):
        return submission.file_report(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), header)

    assert report("source1_entity_id\tmatched_entity_ids", "S1-1\t", "") == []
    assert "empty" in report("")[0] and "comma" in report("a,b")[0] and "header" in report("a\tb")[0]
    assert report("Source1_entity_id\tmatched_entity_ids ", "S1-1") == ["1 rows without a tab", "without a tab: S1-1"]


def test_samples_and_splits(spark):
    frame = spark.createDataFrame([(f"S1-{i}", "a" if i % 3 else "b") for i in range(300)], "source1_entity_id string, country string")
    taken = sampling.sample_per_group(frame, "country", "source1_entity_id", 20, 1)
    assert {r[0]: r[1] for r in taken.groupBy("country").count().collect()} == {"a": 20, "b": 20}
    assert sorted(taken.collect()) == sorted(sampling.sample_per_group(frame.repartition(5), "country", "source1_entity_id", 20, 1).collect())
    split = {r[0]: r["split"] for r in sampling.group_split(frame, parity=True, seed=7).collect()}
    top = float(2**64 - 1)
    for key, name in split.items():
        x = pd.util.hash_array(pd.Series([key]).to_numpy(dtype=object), hash_key=f"{7:016d}"[-16:], categorize=False)[0] / top
        assert name == ("holdout" if x < 0.1 else "validation" if x < 0.2 else "train")
    rows = frame.unionByName(frame)
    part = sampling.sample_query_groups(rows, 100, 3)
    assert part.count() == 100 and part.groupBy("source1_entity_id").count().where("count <> 2").isEmpty()


def test_profiles(spark):
    frame = spark.createDataFrame([("a", None, "US"), ("b", " ", "US"), ("b", "x", "India")], "entity_id string, business_address string, country string")
    assert {r["field"]: r["missing"] for r in profile.missing_profile(frame, ["entity_id", "business_address"]).collect()} == {"entity_id": 0, "business_address": 2}
    assert [tuple(r) for r in profile.duplicate_ids(frame).collect()] == [("b", 2)]
    wide = profile.country_pivot(frame, "entity_id").orderBy("entity_id").collect()
    assert [(r["India"], r["US"]) for r in wide] == [(0, 1), (1, 1)]
    links = spark.createDataFrame([("S1-1", None)] + [("S1-2", f"S2-{i}") for i in range(12)], PAIR)
    assert {r[0]: r[1] for r in profile.match_histogram(links, "source1_entity_id").collect()} == {"0": 1, "10+": 1}
    assert profile.singleton_share(links, "source1_entity_id").first()["share"] == 0.5
