"""Pair features, labels and hard negatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.functions import text as T
from linkwright.functions.similarity import ratio_udf, token_set_ratio_udf
from linkwright.operators.candidates import KEYS

# The features in the order of the model's vector.
FEATURES = [
    "name_retrieval_lane",
    "address_retrieval_lane",
    "token_retrieval_lane",
    "dense_retrieval_lane",
    "retrieval_rank_score",
    "dense_score",
    "exact_name",
    "exact_address",
    "exact_name_core",
    "exact_numbers",
    "name_ratio",
    "name_token_set_ratio",
    "name_jaccard",
    "address_ratio",
    "address_token_set_ratio",
    "address_jaccard",
    "number_jaccard",
    "postal_exact",
    "name_exact_normalized",
    "name_core_exact",
    "address_exact_normalized",
    "country_equal",
    "name_script_equal",
    "cross_script_name",
    "query_address_missing",
    "candidate_address_missing",
    "name_length_ratio",
    "address_length_ratio",
    "target_is_source3",
]
VIEWS = "name_norm name_punct name_core address_norm address_punct address_numbers postal_token name_script country".split()


def retrieval_rank(pairs: DataFrame) -> DataFrame:
    """Adds the rank of each pair within its query and target as a score from 1 (best) down to 0."""
    keys = Window.partitionBy(KEYS[0], "target_source")
    rank = F.row_number().over(keys.orderBy(F.col("retrieval_score").desc(), KEYS[1]))
    size = F.count(F.lit(1)).over(keys)
    return pairs.withColumn("retrieval_rank_score", 1 - (rank - 1) / F.greatest(size - 1, F.lit(1)))


def with_records(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs with the views of both sides as ``q_*`` and ``c_*``; a pair whose record is missing keeps nulls."""
    left = queries.select(F.col("entity_id").alias(KEYS[0]), *[F.col(v).alias(f"q_{v}") for v in VIEWS])
    right = targets.select(F.col("entity_id").alias(KEYS[1]), *[F.col(v).alias(f"c_{v}") for v in VIEWS])
    return pairs.join(left, KEYS[0], "left").join(right, KEYS[1], "left")


def check_records(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> None:
    """Raises ``ValueError`` when a record id repeats or a pair names an unknown record."""
    for frame, side in ((queries, "query"), (targets, "candidate")):
        if not frame.groupBy("entity_id").count().where("count > 1").isEmpty():
            raise ValueError(f"{side} ids repeat")
    for column, frame in ((KEYS[0], queries), (KEYS[1], targets)):
        known = frame.select(F.col("entity_id").alias(column))
        if not pairs.select(column).distinct().join(known, column, "left_anti").isEmpty():
            raise ValueError(f"{column} without a record")


def cross_script(a: str, b: str) -> Column:
    return (F.col(a) != F.col(b)) & (F.col(a) != "NONE") & (F.col(b) != "NONE")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def pair_features(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """The 29 features of each pair, as floats after the three keys."""
    both = with_records(retrieval_rank(pairs), queries, targets)
    both = both.withColumns({"q_tokens": T.tokens("q_name_punct"), "c_tokens": T.tokens("c_name_punct"), "q_words": T.tokens("q_address_punct"), "c_words": T.tokens("c_address_punct")})
    parts = {s: F.filter(F.split(f"{s}_address_numbers", r"\|"), lambda x: x != "") for s in ("q", "c")}

    def same(view: str) -> Column:
        return F.col(f"q_{view}") == F.col(f"c_{view}")

    values = {
        "name_retrieval_lane": _flag(F.col("name_tfidf") > 0),
        "address_retrieval_lane": _flag(F.col("address_tfidf") > 0),
        "token_retrieval_lane": _flag(F.col("token_tfidf") > 0),
        "dense_retrieval_lane": _flag(F.col("dense_score") > 0),
        "name_ratio": ratio_udf("q_name_punct", "c_name_punct"),
        "address_ratio": ratio_udf("q_address_punct", "c_address_punct"),
        "name_token_set_ratio": token_set_ratio_udf("q_name_punct", "c_name_punct"),
        "address_token_set_ratio": token_set_ratio_udf("q_address_punct", "c_address_punct"),
        "name_jaccard": T.jaccard(F.col("q_tokens"), F.col("c_tokens"), 1.0),
        "address_jaccard": T.jaccard(F.col("q_words"), F.col("c_words"), 1.0),
        "number_jaccard": T.jaccard(parts["q"], parts["c"], 0.0),
        "postal_exact": _flag(same("postal_token") & (F.col("q_postal_token") != "")),
        "name_exact_normalized": _flag(same("name_norm")),
        "name_core_exact": _flag(same("name_core") & (F.col("q_name_core") != "")),
        "address_exact_normalized": _flag(same("address_norm") & (F.col("q_address_norm") != "")),
        "country_equal": _flag(same("country")),
        "name_script_equal": _flag(same("name_script")),
        "cross_script_name": _flag(cross_script("q_name_script", "c_name_script")),
        "query_address_missing": _flag(F.col("q_address_norm") == ""),
        "candidate_address_missing": _flag(F.col("c_address_norm") == ""),
        "name_length_ratio": T.length_ratio("q_name_punct", "c_name_punct"),
        "address_length_ratio": T.length_ratio("q_address_punct", "c_address_punct"),
        "target_is_source3": _flag(F.col("target_source") == "source3"),
    }
    chosen = [(values[f] if f in values else F.coalesce(F.col(f), F.lit(0.0))).cast("float").alias(f) for f in FEATURES]
    return both.select(*KEYS, *chosen)


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Adds ``label``: 1 for a pair of the truth, else 0."""
    links = truth.select(*KEYS[:2]).distinct().withColumn("label", F.lit(1))
    return pairs.join(links, KEYS[:2], "left").withColumn("label", F.coalesce("label", F.lit(0)).cast("tinyint"))


def hard_negatives(rows: DataFrame, most: int) -> DataFrame:
    """All positives and the ``most`` best-ranked negatives of each query; source 2 precedes source 3 on ties."""
    order = Window.partitionBy(KEYS[0], "label").orderBy(F.col("retrieval_rank_score").desc(), "target_source", KEYS[1])
    return rows.withColumn("place", F.row_number().over(order)).where((F.col("label") == 1) | (F.col("place") <= most)).drop("place")
