"""Counts that describe the sources and the truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.functions import text as T


def missing_profile(frame: DataFrame, fields: list[str]) -> DataFrame:
    """``(field, rows, missing)``; null and blank texts are missing."""
    counts = frame.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.trim(F.coalesce(f, F.lit(""))) == "").alias(f) for f in fields])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("missing")) for f in fields])
    return counts.select("rows", F.explode(pairs).alias("p")).select("p.field", "rows", "p.missing")


def country_profile(frame: DataFrame, by: list[str]) -> DataFrame:
    """Rows and share of each country within the groups of ``by``."""
    counts = frame.groupBy(*by, "country").agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.groupBy(*by).agg(F.sum("rows").alias("total"))
    joined = counts.join(totals, by) if by else counts.crossJoin(totals)
    return joined.select(*by, "country", "rows", F.round(F.col("rows") / F.col("total"), 6).alias("share"))


def country_pivot(frame: DataFrame, row: str, countries: list[str] | None = None) -> DataFrame:
    """Rows of each country as columns, 0 where there is none."""
    grouped = frame.groupBy(row)
    wide = grouped.pivot("country", countries) if countries else grouped.pivot("country")
    return wide.agg(F.count(F.lit(1))).na.fill(0)


def script_profile(frame: DataFrame, field: str, scripts: list[str] | None = None) -> DataFrame:
    found = F.explode(T.scripts_in(field, scripts or T.WIDE_SCRIPTS))
    return frame.select(found.alias("script")).groupBy("script").agg(F.count(F.lit(1)).alias("rows"))


def match_histogram(truth: DataFrame, entity: str, top: int = 10) -> DataFrame:
    """Entities by number of links, ``top`` and more in one class; ``truth`` has a null link for none."""
    sizes = truth.groupBy(entity).agg(F.count("candidate_entity_id").alias("n"))
    label = F.when(F.col("n") >= top, f"{top}+").otherwise(F.col("n").cast("string"))
    return sizes.groupBy(label.alias("matches")).agg(F.count(F.lit(1)).alias("entities"))


def match_sources(truth: DataFrame) -> DataFrame:
    """Links by the source of the matched record."""
    links = truth.where(F.col("candidate_entity_id").isNotNull())
    return links.groupBy(F.substring("candidate_entity_id", 1, 2).alias("source")).agg(F.count(F.lit(1)).alias("links"))


def singleton_share(truth: DataFrame, entity: str) -> DataFrame:
    sizes = truth.groupBy(entity).agg(F.count("candidate_entity_id").alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("entities"), F.count_if(F.col("n") == 0).alias("singletons"), F.round(F.avg(F.when(F.col("n") == 0, 1.0).otherwise(0.0)), 6).alias("share"))


def stage_summary(scored: DataFrame, threshold: float) -> DataFrame:
    """Per country: pairs scored and selected, least and greatest score."""
    return scored.groupBy("country").agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.col("score") >= threshold).alias("selected"), F.min("score").alias("least"), F.max("score").alias("most")
    )


def preprocess_counters(frame: DataFrame) -> DataFrame:
    """Per country: rows and rows without an address."""
    return frame.groupBy("country").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.trim(F.coalesce("business_address", F.lit(""))) == "").alias("empty_addresses"))


def duplicate_ids(frame: DataFrame, key: str = "entity_id") -> DataFrame:
    """Ids that stand on more than one row, with the number of rows. Exact, not by hash."""
    return frame.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
