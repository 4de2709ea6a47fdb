"""Queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm import abuse, addresses, groups, leakage, linkage, lookalikes, names, packing, records
from linkwright.llm.tables import read
from linkwright.session import cut


# The states that the tables name, with their short forms. They are data of these tables, not of the operators.
REGIONS = (
    ("tessaly", "ts"), ("norvale", "nv"), ("corrado", "cr"), ("ohoona", "oo"), ("east marlan", "em"), ("wiskern", "wk"),
    ("girigarh", "gg"), ("samudra nadu", "sn"), ("purva pradesh", "pp"), ("uttar desham", "ud"), ("malavati", "mv"),
)
LEXICON = replace(records.GENERAL, regions=REGIONS)


def noisy_records(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["entity_id", "business_name", "business_address"]
    return read(spark, folder, "train_source2").select(columns).unionByName(read(spark, folder, "train_source3").select(columns))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return addresses.same_place_pairs(noisy_records(spark, folder), "entity_id", "business_address", LEXICON)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    tied = groups.tied_entities(read(spark, folder, "train_matches"), "source1_entity_id", "matched_entity_ids")
    members = tied.where((F.col("group_size") > 1) & (F.col("entity") != F.col("group_first")))
    return members.select(F.col("group_first").alias("group_first_id"), F.col("entity").alias("source1_entity_id"))


def p2_split(spark: SparkSession, folder: str) -> DataFrame:
    tied = groups.tied_entities(read(spark, folder, "train_matches"), "source1_entity_id", "matched_entity_ids")
    labelled = groups.split(tied, {"train": 0.8, "validation": 0.1, "test": 0.1})
    return labelled.select(F.col("entity").alias("source1_entity_id"), F.col("group_first").alias("group_first_id"), "split")


def p4_links(spark: SparkSession, folder: str) -> DataFrame:
    """Matches of the entities without a row in train_matches, with the confidence of each."""
    labelled = read(spark, folder, "train_matches").select(F.regexp_replace("source1_entity_id", groups.BLANKS, "").alias("entity_id"))
    open_entities = read(spark, folder, "train_source1").join(labelled, "entity_id", "left_anti")
    found = linkage.linked(open_entities, noisy_records(spark, folder), "entity_id", "business_name", "business_address", LEXICON)
    return found.select(F.col("left_id").alias("source1_entity_id"), F.col("right_id").alias("candidate_entity_id"), "confidence")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_links(spark, folder).select("source1_entity_id", "candidate_entity_id")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    by_name = lookalikes.records_not_consistent(read(spark, folder, "train_source1"), "entity_id", "business_name")
    by_address = lookalikes.records_not_consistent(read(spark, folder, "train_source2"), "entity_id", "business_address")
    return by_name.unionByName(by_address).distinct()


def p5_folded(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of both fields with its consistent form."""
    first = read(spark, folder, "train_source1").select("entity_id", F.lit("business_name").alias("field"), F.col("business_name").alias("text"))
    second = read(spark, folder, "train_source2").select("entity_id", F.lit("business_address").alias("field"), F.col("business_address").alias("text"))
    return lookalikes.fold_columns(first.unionByName(second), ["text"]).select("entity_id", "field", "text_folded")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.variant_pairs(noisy_records(spark, folder), "entity_id", "business_name", LEXICON)


def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    counts = cut(packing.token_counts(read(spark, folder, "documents")))
    return packing.pack(counts, packing.capacities_of(read(spark, folder, "pack_limits")))


def p7_fullness(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fullness(p7_containers(spark, folder), packing.capacities_of(read(spark, folder, "pack_limits")))


def p8_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Leaked passages with their length in words and their offsets in the document."""
    return leakage.leaks(read(spark, folder, "documents"), read(spark, folder, "eval_items"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return p8_spans(spark, folder).select("item_id", "doc_id").distinct()


def p9_scores(spark: SparkSession, folder: str) -> DataFrame:
    return abuse.scores(read(spark, folder, "documents"), read(spark, folder, "review_labels"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    reviewed = read(spark, folder, "review_labels").select("doc_id").distinct()
    harmful = p9_scores(spark, folder).where(F.col("score") >= abuse.THRESHOLD)
    return harmful.join(reviewed, "doc_id", "left_anti").select("doc_id").distinct()


def p9_rates(spark: SparkSession, folder: str) -> DataFrame:
    return abuse.rates(read(spark, folder, "documents"), p9_scores(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p2_found": p2_found, "p2_split": p2_split, "p4_found": p4_found, "p4_links": p4_links, "p5_found": p5_found, "p5_folded": p5_folded, "p6_found": p6_found, "p7_containers": p7_containers, "p7_fullness": p7_fullness, "p8_found": p8_found, "p8_spans": p8_spans, "p9_found": p9_found, "p9_scores": p9_scores, "p9_rates": p9_rates}


_TIED = r"""WITH RECURSIVE claims AS (
  SELECT DISTINCT regexp_replace(source1_entity_id, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS entity, unnest(regexp_extract_all(matched_entity_ids, 'S[23]-\d+')) AS claimed FROM train_matches
), ties AS (SELECT DISTINCT a.entity AS u, b.entity AS v FROM claims a JOIN claims b USING (claimed) WHERE a.entity <> b.entity),
reached(entity, other) AS (SELECT u, v FROM ties UNION SELECT r.entity, t.v FROM reached r JOIN ties t ON r.other = t.u)
SELECT least(min(other), entity) AS group_first_id, entity AS source1_entity_id FROM reached GROUP BY entity HAVING min(other) < entity"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express a query; the others are tested against brute force, round trips and held-out labels."""
    return {"p2_found": _TIED}
