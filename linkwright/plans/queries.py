"""Registered queries over the record tables; the SQL they are checked against is in ``linkwright.plans.sql``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.functions import text as T
from linkwright.functions.similarity import ratio_udf, token_set_ratio_udf
from linkwright.operators import candidates as C
from linkwright.operators import dense, metrics, multivalue, profile, sampling, submission
from linkwright.operators import features as X
from linkwright.plans import sql
from linkwright.session import cut, shared_folder
from linkwright.sources.tables import country_slug
from linkwright.streaming import ingest

SOURCES = {"source1": "train_source1", "source2": "train_source2", "source3": "train_source3"}
ENTITY, TARGET = "source1_entity_id", "candidate_entity_id"
BLANKS = r"^[ \t\n]+|[ \t\n]+$"
SCORE = 0.6


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---------------------------------------------------------------------------------------------- inputs


def records(spark: SparkSession, folder: str) -> DataFrame:
    """The three sources, one row per record (repeated rows once), with all views and the blocking label."""
    parts = [table(spark, folder, name).withColumn("src", F.lit(src)) for src, name in SOURCES.items()]
    union = reduce(DataFrame.unionByName, parts)
    once = union.groupBy("src", "entity_id").agg(
        *[F.min(F.coalesce(c, F.lit(""))).alias(c) for c in ("business_name", "business_address")], F.min(F.trim(F.coalesce("country", F.lit("")))).alias("country")
    )
    return T.record_views(once).withColumn("label", F.col("country")).withColumn("country", country_slug("country"))


def sides(views: DataFrame) -> tuple[DataFrame, DataFrame]:
    targets = views.where("src <> 'source1'").withColumnRenamed("src", "target_source")
    return views.where("src = 'source1'").drop("src"), targets


def truth(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Entities and links of the labelled matches, whatever separates the ids."""
    rows = table(spark, folder, "train_matches").select(F.regexp_replace(ENTITY, BLANKS, "").alias(ENTITY), "matched_entity_ids")
    links = rows.select(ENTITY, F.explode(F.regexp_extract_all("matched_entity_ids", F.lit(r"(S[23]-\d+)"), 1)).alias(TARGET)).distinct()
    return rows.select(ENTITY).distinct(), links


def known_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "train_source2").select("entity_id").unionByName(table(spark, folder, "train_source3").select("entity_id"))


def merged(spark: SparkSession, folder: str) -> DataFrame:
    # every lane reads the views
    queries, targets = sides(cut(records(spark, folder)))
    return C.merge_lanes([*C.exact_lanes(queries, targets), C.token_lane(queries, targets)])


def capped(spark: SparkSession, folder: str) -> DataFrame:
    return cut(C.cap_candidates(C.cap_candidates(merged(spark, folder), sql.MOST, True), sql.MOST, False))


def ranked(spark: SparkSession, folder: str) -> DataFrame:
    return X.retrieval_rank(capped(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return capped(spark, folder).withColumn("score", F.col("retrieval_score"))


def guessed(spark: SparkSession, folder: str) -> DataFrame:
    return submission.matches_at(scored(spark, folder), SCORE)


def linked(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled links with the views of both records."""
    queries, targets = sides(records(spark, folder))
    _, links = truth(spark, folder)
    return X.with_records(links, queries, targets).where(F.col("q_name_norm").isNotNull() & F.col("c_name_norm").isNotNull())


def featured(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = (f.withColumn("country", F.col("label")).drop("label") for f in sides(records(spark, folder)))
    return X.pair_features(capped(spark, folder), queries, targets)


# ---------------------------------------------------------------------------------------------- queries


def view_query(columns: Callable[[], list]) -> Callable[[SparkSession, str], DataFrame]:
    """A query for some views of every record; columns are made when it runs, as they need a session."""
    return lambda spark, folder: records(spark, folder).select("src", "entity_id", *columns())


def rounded(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, 6) for c in columns})


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    matches = table(spark, folder, "train_matches")
    values = multivalue.split_packed(matches, ENTITY, "matched_entity_ids", known_ids(spark, folder), "entity_id")
    several = values.where(F.col("value_count") >= 2)
    return several.select(F.regexp_replace(ENTITY, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "").alias(ENTITY), "value_pos", "matched_value").distinct()


#: Addresses that no rule of free text reads in another way; most hold commas.
LISTED = r"^[A-Za-z0-9][A-Za-z0-9 ,./#-]*[A-Za-z0-9]$"


def packed_addresses(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses of ten neighbouring records packed in one field, and taken apart with the addresses as dictionary."""
    rows = table(spark, folder, "train_source2").select("entity_id", "business_address").distinct().where(F.col("business_address").rlike(LISTED) & F.col("business_address").rlike("[0-9]"))
    rows = rows.withColumn("pack", F.substring("entity_id", 1, 11))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("entity_id", "business_address"))), lambda x: x["business_address"])
    packed = rows.groupBy("pack").agg(F.array_join(ordered, "; ").alias("field"))
    return multivalue.split_packed(packed, "pack", "field", rows, "business_address").select("pack", "value_pos", "matched_value")


def token_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    value = T.jaccard(T.tokens("q_name_punct"), T.tokens("c_name_punct"), 1.0)
    return linked(spark, folder).select(ENTITY, TARGET, F.round(value, 6).alias("name_jaccard"))


def number_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    value = T.jaccard(T.numbers("q_address_norm"), T.numbers("c_address_norm"), 0.0)
    return linked(spark, folder).select(ENTITY, TARGET, F.round(value, 6).alias("number_jaccard"))


def length_ratio(spark: SparkSession, folder: str) -> DataFrame:
    pairs = {f"{x}_length_ratio": F.round(T.length_ratio(f"q_{x}_punct", f"c_{x}_punct"), 6) for x in ("name", "address")}
    return linked(spark, folder).select(ENTITY, TARGET, *[v.alias(k) for k, v in pairs.items()])


def string_ratios(spark: SparkSession, folder: str) -> DataFrame:
    own = {f"{x}_{n}": f(f"q_{x}_punct", f"c_{x}_punct") for x in ("name", "address") for n, f in (("ratio", ratio_udf), ("token_set_ratio", token_set_ratio_udf))}
    return linked(spark, folder).select(ENTITY, TARGET, *[v.alias(k) for k, v in own.items()])


def frequency_cap_skew(spark: SparkSession, folder: str) -> DataFrame:
    keys = records(spark, folder).where("name_norm <> ''").groupBy("src", "country", "name_norm").agg(F.count(F.lit(1)).alias("n"))
    return keys.groupBy("src", "country").agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 5).alias("capped_keys"), F.max("n").alias("largest"))


def exact_block(view: str, signal: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: C.exact_lane(*sides(records(spark, folder)), view, signal, sql.MOST_EXACT)


def document_frequency(spark: SparkSession, folder: str) -> DataFrame:
    _, targets = sides(records(spark, folder))
    return C.document_frequency(targets.select("country", "target_source", F.explode(T.token_document("name_punct", "address_punct")).alias("term")), ["country", "target_source"])


def candidate_recall(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(C.candidate_recall(truth(spark, folder)[1], capped(spark, folder)), "pair_recall", "entity_recall", "mean_candidates")


def exact_features(spark: SparkSession, folder: str) -> DataFrame:
    chosen = """name_retrieval_lane address_retrieval_lane token_retrieval_lane dense_retrieval_lane retrieval_rank_score dense_score
    exact_name exact_address exact_name_core exact_numbers name_script_equal cross_script_name name_jaccard address_jaccard number_jaccard postal_exact name_exact_normalized name_core_exact address_exact_normalized
    country_equal query_address_missing candidate_address_missing name_length_ratio address_length_ratio target_is_source3""".split()
    return featured(spark, folder).select(*C.KEYS, *[F.round(F.col(c).cast("double"), 4).alias(c) for c in chosen])


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return X.label_pairs(ranked(spark, folder), truth(spark, folder)[1])


def label_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return labelled(spark, folder).select(*C.KEYS, F.col("label").cast("int").alias("label"))


def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return X.hard_negatives(labelled(spark, folder), 12).select(*C.KEYS, F.col("label").cast("int").alias("label"))


def entity_fbeta(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.entity_scores(*truth(spark, folder), guessed(spark, folder)), "score")


def macro_fbeta(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.macro_score(*truth(spark, folder), guessed(spark, folder)), "macro_score")


def threshold_curve(spark: SparkSession, folder: str) -> DataFrame:
    curve = metrics.threshold_curve(*truth(spark, folder), scored(spark, folder), metrics.thresholds(0.2, 0.98, 40))
    return rounded(curve, "threshold", "macro_score")


def best_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.best_threshold(threshold_curve(spark, folder))


def group_ids(spark: SparkSession, folder: str) -> DataFrame:
    queries, _ = sides(records(spark, folder))
    return submission.id_lists(queries.select(F.col("entity_id").alias(ENTITY)), guessed(spark, folder))


def subset_violations(spark: SparkSession, folder: str) -> DataFrame:
    return submission.subset_violations(truth(spark, folder)[1], capped(spark, folder))


def validator_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "train_matches").select(F.regexp_replace(ENTITY, BLANKS, "").alias(ENTITY), "matched_entity_ids")
    return submission.report(rows, table(spark, folder, "train_source1").select(F.col("entity_id").alias(ENTITY)))


def all_links(spark: SparkSession, folder: str) -> DataFrame:
    entities, links = truth(spark, folder)
    return entities.join(links, ENTITY, "left")


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [table(spark, folder, name) for name in SOURCES.values()])


def counted(spark: SparkSession, folder: str) -> DataFrame:
    return records(spark, folder).withColumn("country", F.col("label"))


def stage_summary(spark: SparkSession, folder: str) -> DataFrame:
    countries = counted(spark, folder).where("src = 'source1'").select(F.col("entity_id").alias(ENTITY), "country")
    return rounded(profile.stage_summary(scored(spark, folder).join(countries, ENTITY), SCORE), "least", "most")


def dense_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return dense.nearest(vectors.where("vec_id % 20 = 0"), vectors, "vec_id", "embedding", 10, digits=5)


def deliveries_per_day(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "source_deliveries")
    return rows.groupBy(F.date_trunc("day", "delivered_at").cast("timestamp_ntz").alias("window_start"), F.coalesce("feed_code", F.lit("unknown")).alias("feed_code")).agg(
        F.count(F.lit(1)).alias("deliveries")
    )


def unique_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "source_deliveries").where("recorded_at IS NOT NULL")
    return rows.groupBy("entity_id", "recorded_at").agg(F.min("delivered_at").alias("first_delivered_at"))


def first_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of deliveries without repeats, run until no file is left, as ``(entity_id, recorded_at)``."""
    path = f"{folder}/source_deliveries.parquet"
    # a pattern reads the table as one file or as a folder of files
    source = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[t]")
    out = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    unique = ingest.first_deliveries(source).select("entity_id", "recorded_at")
    writer = unique.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state")
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(unique.schema).parquet(f"{out}/rows")


def group_split(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.group_split(truth(spark, folder)[0])


def sampled_queries(spark: SparkSession, folder: str) -> DataFrame:
    queries, _ = sides(records(spark, folder))
    return sampling.sample_per_group(queries.select("entity_id", "country"), "country", "entity_id", 50)


def semantic_pairs(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = sides(records(spark, folder))
    return dense.semantic_lane(capped(spark, folder), queries, targets, dense.ngram_encoder(), 3)


def script_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.script_profile(records(spark, folder), "business_name")


def unicode_forms(spark: SparkSession, folder: str) -> DataFrame:
    forms = [T.unicode_form("business_name", form).alias(form.lower()) for form in ("NFC", "NFD", "NFKC", "NFKD")]
    return records(spark, folder).select("src", "entity_id", *forms, T.strip_punctuation("business_name").alias("no_punctuation"), T.strip_marks("business_name").alias("no_marks"))


def gbt_score(spark: SparkSession, folder: str) -> DataFrame:
    """A classifier fitted on the training split and applied to the holdout split."""
    from linkwright.plans import model as M

    rows = sampling.group_split(X.label_pairs(featured(spark, folder), truth(spark, folder)[1]), seed=42)
    rows = rows.join(truth(spark, folder)[0], ENTITY, "left_semi").persist()
    model = M.fit(X.hard_negatives(rows.where("split = 'train'"), 12), rows.where("split = 'validation'"), M.BASE | {"maxDepth": 5}, 20, 42)
    return M.score(model, rows.where("split = 'holdout'")).select(*C.KEYS, "label", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "p3_found": p3_found,
        "packed_addresses": packed_addresses,
        "normalize_basic": view_query(lambda: ["name_norm", "address_norm"]),
        "normalize_punct": view_query(lambda: ["name_punct", "address_punct"]),
        "tokenize": view_query(lambda: [F.array_join(T.tokens("name_punct"), " ").alias("name_tokens")]),
        "name_core": view_query(lambda: ["name_core"]),
        "number_signature": view_query(lambda: ["address_numbers"]),
        "postal_token": view_query(lambda: ["postal_token"]),
        "token_document": view_query(lambda: [F.array_join(T.token_document("name_punct", "address_punct"), " ").alias("document")]),
        "char_ngrams": view_query(lambda: [F.array_join(F.array_sort(T.char_ngrams("name_punct")), "~").alias("grams")]),
        "country_slug": view_query(lambda: [F.col("country").alias("country_slug")]),
        "fold_accents": view_query(lambda: ["name_ascii"]),
        "script_signature": view_query(lambda: ["name_script", "address_script", "has_non_latin_name"]),
        "embedding_text": view_query(lambda: [T.embedding_text("query", "name_norm", "address_norm", "country").alias("text")]),
        "token_jaccard": token_jaccard,
        "number_jaccard": number_jaccard,
        "length_ratio": length_ratio,
        "string_ratios": string_ratios,
        "frequency_cap_skew": frequency_cap_skew,
        "document_frequency": document_frequency,
        "token_tfidf_topk": lambda s, d: C.token_lane(*sides(records(s, d))),
        "token_hash_topk": lambda s, d: C.token_lane(*sides(records(s, d)), buckets=4_194_304),
        "address_tfidf_topk": lambda s, d: C.address_token_lane(*sides(records(s, d))),
        "char_tfidf_topk": lambda s, d: C.char_lane(*sides(records(s, d)), "name_punct", "name_tfidf", 12, 0.18),
        "merge_lanes": lambda s, d: rounded(merged(s, d), "retrieval_score"),
        "candidate_cap": lambda s, d: rounded(capped(s, d).select(*C.KEYS, "retrieval_score"), "retrieval_score"),
        "candidate_recall": candidate_recall,
        "retrieval_rank": lambda s, d: rounded(ranked(s, d).select(*C.KEYS, "retrieval_rank_score"), "retrieval_rank_score"),
        "exact_features": exact_features,
        "pair_features": featured,
        "label_pairs": label_pairs,
        "hard_negatives": hard_negatives,
        "entity_fbeta": entity_fbeta,
        "macro_fbeta": macro_fbeta,
        "threshold_curve": threshold_curve,
        "best_threshold": best_threshold,
        "group_ids": group_ids,
        "subset_violations": subset_violations,
        "validator_report": validator_report,
        "truth_explode": lambda s, d: truth(s, d)[1],
        "match_histogram": lambda s, d: profile.match_histogram(all_links(s, d), ENTITY),
        "match_sources": lambda s, d: profile.match_sources(all_links(s, d)),
        "singleton_share": lambda s, d: profile.singleton_share(all_links(s, d), ENTITY),
        "missing_profile": lambda s, d: profile.missing_profile(raw_records(s, d), ["entity_id", "business_name", "business_address", "country"]),
        "country_profile": lambda s, d: profile.country_profile(counted(s, d), ["src"]),
        "country_pivot": lambda s, d: profile.country_pivot(counted(s, d), "src", ["France", "India", "US"]),
        "script_counts": script_counts,
        "preprocess_counters": lambda s, d: profile.preprocess_counters(counted(s, d)),
        "duplicate_ids": lambda s, d: profile.duplicate_ids(table(s, d, "train_source2").unionByName(table(s, d, "train_source3"))),
        "stage_summary": stage_summary,
        "dense_topk": dense_topk,
        "semantic_pairs": semantic_pairs,
        "group_split": group_split,
        "sampled_queries": sampled_queries,
        "unicode_forms": unicode_forms,
        "unicode_strips": view_query(lambda: [T.unicode_form("business_name", "NFC").alias("nfc"), T.strip_punctuation("business_name").alias("no_punctuation"), T.strip_marks("business_name").alias("no_marks")]),
        "deliveries_per_day": deliveries_per_day,
        "unique_deliveries": unique_deliveries,
        "first_deliveries": first_deliveries,
        "deliveries_per_window": lambda s, d: rounded(ingest.deliveries_per_window(table(s, d, "source_deliveries")).withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), "mean_delay_seconds"),
        "gbt_score": gbt_score,
    }
    for view, signal in C.EXACT.items():
        out[f"exact_block_{signal.removeprefix('exact_')}"] = exact_block(view, signal)
    return out


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
