import math

import pytest
from pyspark.sql import functions as F

from linkwright.functions.text import record_views
from linkwright.operators import candidates as C
from linkwright.operators import dense
from linkwright.operators import features as X
from linkwright.plans import config as configuration

COLUMNS = "entity_id string, business_name string, business_address string, country string"


def sides(spark, queries, targets):
    views = record_views(spark.createDataFrame(queries, COLUMNS)), record_views(spark.createDataFrame(targets, COLUMNS))
    return views[0], views[1].withColumn("target_source", F.when(F.col("entity_id").startswith("S2"), "source2").otherwise("source3"))


def pairs_of(frame):
    return {(r[0], r[1]) for r in frame.select(*C.KEYS[:2]).collect()}


def test_several_lanes_find_both_true_pairs(spark):
    q, t = sides(
        spark,
        [("S1-1", "Alpha Bakery", "12 Main Road 282005", "India"), ("S1-2", "लक्ष्मी स्टोर", "44 Lake Street 110001", "India")],
        [("S2-1", "Alfa Bakery", "12 Main Rd 282005", "India"), ("S2-2", "Lakshmi Store", "44 Lake Street 110001", "India"), ("S2-3", "Other", "9 Far Lane 999999", "India")],
    )
    config = configuration.load(candidate_generation={"method": "token_hash", "token_address_top_k": 5})["candidate_generation"]
    found = C.generate(q, t, config)
    assert {("S1-1", "S2-1"), ("S1-2", "S2-2")} <= pairs_of(found)
    row = found.where("source1_entity_id = 'S1-2' and candidate_entity_id = 'S2-2'").first()
    assert row["token_tfidf"] > 0 and row["address_tfidf"] > 0
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-2")], "source1_entity_id string, candidate_entity_id string")
    assert C.candidate_recall(truth, found).first()["pair_recall"] == 1.0


def test_an_exact_hit_does_not_hide_a_near_one(spark):
    q, t = sides(spark, [("S1-1", "Alpha Bakery", "", "US")], [("S2-1", "Alpha Bakery", "", "US"), ("S2-2", "Alpha Bakery House", "", "US")])
    config = configuration.load()["candidate_generation"]
    assert pairs_of(C.generate(q, t, config)) == {("S1-1", "S2-1"), ("S1-1", "S2-2")}


def test_query_side_cap(spark):
    q, t = sides(spark, [(f"S1-{i}", "Same", "", "US") for i in range(3)], [("S2-1", "Same", "", "US")])
    assert C.exact_lane(q, t, "name_norm", "exact_name", 2).isEmpty()
    assert C.exact_lane(q, t, "name_norm", "exact_name", 3).count() == 3


def test_empty_keys_and_other_countries_never_meet(spark):
    q, t = sides(spark, [("S1-1", "", None, "US"), ("S1-2", "A", "", "US")], [("S2-1", None, "", "US"), ("S2-2", "A", "", "France")])
    assert all(lane.isEmpty() for lane in C.exact_lanes(q, t))


def test_tfidf_against_the_formula(spark):
    q, t = sides(spark, [("S1-1", "aa bb", "", "US")], [("S2-1", "aa cc", "", "US"), ("S2-2", "bb aa", "", "US")])
    idf = {w: math.log(3 / (1 + df)) + 1 for w, df in (("aa", 2), ("bb", 1), ("cc", 1))}
    query = math.hypot(idf["aa"], idf["bb"])
    expected = round(idf["aa"] ** 2 / (query * math.hypot(idf["aa"], idf["cc"])), 6)
    rows = {r["candidate_entity_id"]: r["token_tfidf"] for r in C.token_lane(q, t).collect()}
    assert rows["S2-2"] == 1.0 and rows["S2-1"] == pytest.approx(expected, abs=1e-6)


def test_frequent_terms_are_dropped_and_ties_go_to_the_smaller_id(spark):
    q, t = sides(spark, [("S1-1", "aa", "", "US")], [(f"S2-{i}", "aa", "", "US") for i in range(5)])
    assert C.token_lane(q, t, most_df=4).isEmpty()
    assert pairs_of(C.token_lane(q, t, top_k=2)) == {("S1-1", "S2-0"), ("S1-1", "S2-1")}


def test_partitions_do_not_change_the_result(spark):
    q, t = sides(spark, [(f"S1-{i}", f"name {i % 7} shop", f"{i} road", "US") for i in range(40)], [(f"S2-{i}", f"name {i % 5} shop", f"{i} road", "US") for i in range(40)])
    one = C.merge_lanes([C.token_lane(q, t), *C.exact_lanes(q, t)])
    other = C.merge_lanes([C.token_lane(q.repartition(7), t.repartition(3)), *C.exact_lanes(q.repartition(5), t)])
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_features(spark):
    q, t = sides(spark, [("S1-1", "Alpha Bakery", "1 Main 12345", "US")], [("S2-1", "Alpha Bakery", "1 Main 12345", "US"), ("S2-2", "Beta", "", "US")])
    pairs = C.merge_lanes([*C.exact_lanes(q, t), C.token_lane(q, t, least=0.0)])
    pairs = pairs.unionByName(pairs.where("candidate_entity_id = 'S2-1'").withColumn("candidate_entity_id", F.lit("S2-2")).withColumn("retrieval_score", F.lit(0.1)))
    truth = spark.createDataFrame([("S1-1", "S2-1")], "source1_entity_id string, candidate_entity_id string")
    rows = {r["candidate_entity_id"]: r for r in X.label_pairs(X.pair_features(pairs, q, t), truth).collect()}
    assert len(X.FEATURES) == 29
    best = rows["S2-1"]
    assert best["label"] == 1 and rows["S2-2"]["label"] == 0
    assert best["retrieval_rank_score"] == 1.0 and rows["S2-2"]["retrieval_rank_score"] == 0.0
    assert best["name_ratio"] == best["name_jaccard"] == best["postal_exact"] == best["number_jaccard"] == 1.0
    assert rows["S2-2"]["candidate_address_missing"] == 1.0
    X.check_records(pairs, q, t)
    with pytest.raises(ValueError):
        X.check_records(pairs.withColumn("candidate_entity_id", F.lit("S2-9")), q, t)
    with pytest.raises(ValueError):
        X.check_records(pairs, q.unionByName(q), t)


def test_hard_negatives_keep_all_positives(spark):
    rows = [("S1-1", f"S2-{i}", "source2", 1 - i / 10, int(i in (7, 8))) for i in range(10)]
    frame = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, target_source string, retrieval_rank_score double, label int")
    kept = {r["candidate_entity_id"] for r in X.hard_negatives(frame, 2).collect()}
    assert kept == {"S2-0", "S2-1", "S2-7", "S2-8"}


def test_cosine_neighbours(spark):
    q = spark.createDataFrame([("S1-1", [1.0, 0.0]), ("S1-2", [0.0, 2.0])], "id string, v array<float>")
    t = spark.createDataFrame([("S2-1", [3.0, 0.1]), ("S2-2", [0.1, 1.0]), ("S2-3", [-1.0, -1.0]), ("S2-4", None)], "id string, v array<float>")
    assert {(r[0], r[1]) for r in dense.nearest(q, t, "id", "v", 1).collect()} == {("S1-1", "S2-1"), ("S1-2", "S2-2")}
    assert sorted(dense.nearest(q, t, "id", "v", 3, block=1).collect()) == sorted(dense.nearest(q, t, "id", "v", 3).collect())
    assert dense.nearest(q.limit(0), t, "id", "v", 3).isEmpty()


def test_only_cross_script_pairs_are_reranked(spark):
    q, t = sides(spark, [("S1-1", "Lakshmi", "", "India")], [("S2-1", "लक्ष्मी", "", "India"), ("S2-2", "Lakshmi", "", "India")])
    pairs = spark.createDataFrame([("S1-1", "S2-1", "source2", 0.5), ("S1-1", "S2-2", "source2", 0.9)], "source1_entity_id string, candidate_entity_id string, target_source string, retrieval_score double")

    def encode(frame):
        return frame.select("entity_id", F.when(F.col("entity_id") == "S1-1", F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.8), F.lit(0.6))).alias("embedding"))

    rows = dense.semantic_lane(pairs, q, t, encode, 3).collect()
    assert [(r["candidate_entity_id"], round(r["dense_score"], 4)) for r in rows] == [("S2-1", 0.8)]


def test_shards(spark, tmp_path):
    records = spark.createDataFrame(
        [("S2-1", "गोहुको योबिवु", "5 mavutu road", "india", True), ("S2-2", "पुयेमान लुलेकान", "9 other lane", "india", True), ("S2-3", "gohuko", "x", "india", False)],
        "entity_id string, name_norm string, address_norm string, country string, has_non_latin_name boolean",
    )
    queries = spark.createDataFrame([("S1-1", "gohuko yobivu", "5 mavutu road", "india", False)], records.schema)
    encode = dense.ngram_encoder()
    dense.write_shards(records, encode, f"{tmp_path}/t", non_latin_only=True)
    dense.write_shards(queries, encode, f"{tmp_path}/q")
    assert dense.read_shards(spark, f"{tmp_path}/t").count() == 2
    rows = dense.lane_from_shards(spark, f"{tmp_path}/q", f"{tmp_path}/t", "source2", 2).collect()
    assert [r["candidate_entity_id"] for r in sorted(rows, key=lambda r: -r["dense_score"])] == ["S2-1", "S2-2"] and max(r["dense_score"] for r in rows) > 0.8
    assert dense.lane_from_shards(spark, f"{tmp_path}/none", f"{tmp_path}/t", "source2", 2).isEmpty()


def test_nearest_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    vectors = rng.integers(-1, 2, (200, 3)).astype(float)  # many ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "id long, v array<double>").repartition(5)
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    similar = np.round(unit @ unit.T, 6)
    expected = {(q, int(t)) for q in range(40) for t in np.lexsort((np.arange(200), -similar[q]))[:7]}
    for block in (4096, 16):
        got = dense.nearest(frame.where("id < 40"), frame, "id", "v", 7, block=block)
        assert {(r[0], r[1]) for r in got.collect()} == expected


def test_most_frequent_terms(spark):
    import random

    from linkwright.operators.candidates import most_frequent

    rng = random.Random(5)
    rows = [(g, f"t{i:02d}", rng.randrange(1, 5)) for g in "ab" for i in range(40)]
    frame = spark.createDataFrame(rows, "g string, term string, total long")
    for most in (1, 7, 25, 40, 90):
        expected = {(g, t) for g in "ab" for _, t in sorted((-n, t) for h, t, n in rows if h == g)[:most]}
        assert {(r["g"], r["term"]) for r in most_frequent(frame, ["g"], most).collect()} == expected


def test_block_against_brute_force():
    import numpy as np

    from linkwright.operators.candidates import Block

    rng = np.random.default_rng(2)
    terms = [np.unique(rng.zipf(1.3, 12) % 300) for _ in range(400)]
    weights = [(w := rng.random(len(t))) / np.linalg.norm(w) for t in terms]
    dense_ = np.zeros((400, 300))
    for i, (t, w) in enumerate(zip(terms, weights)):
        dense_[i, t] = w
    block = Block(np.arange(400), terms, weights)
    for q in range(60):
        known = np.append(terms[q], 999)
        for least, k in ((0.01, 5), (0.3, 5), (0.6, 400), (0.99, 3)):
            scores = np.round(dense_ @ dense_[q], 6)
            order = np.lexsort((np.arange(400), -scores))
            expected = [(int(i), scores[i]) for i in order if scores[i] >= least][:k]
            places, got = block.best(known, np.append(weights[q], 0.5), k, least, 6)
            assert list(zip(places.tolist(), got)) == expected
