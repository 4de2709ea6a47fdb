"""Output lists, their checks, and the report on submitted files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTITY, TARGET = "source1_entity_id", "candidate_entity_id"
MATCHED = "matched_entity_ids"
EXAMPLES = 5


def id_lists(entities: DataFrame, pairs: DataFrame, column: str = MATCHED) -> DataFrame:
    """One row per entity, ordered by id: its distinct ids sorted and joined by commas, empty without any."""
    lists = pairs.groupBy(ENTITY).agg(F.array_join(F.array_sort(F.collect_set(TARGET)), ",").alias(column))
    full = entities.select(ENTITY).distinct().join(lists, ENTITY, "left")
    return full.select(ENTITY, F.coalesce(column, F.lit("")).alias(column)).orderBy(ENTITY)


def matches_at(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.where(F.col("score") >= threshold).select(ENTITY, TARGET)


def list_ids(column: str) -> Column:
    return F.filter(F.split(F.coalesce(column, F.lit("")), ","), lambda x: x != "")


def subset_violations(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Links of the matches that the candidates lack."""
    return matches.select(ENTITY, TARGET).distinct().join(candidates.select(ENTITY, TARGET).distinct(), [ENTITY, TARGET], "left_anti")


def links(rows: DataFrame, column: str) -> DataFrame:
    """The listed ids as links."""
    return rows.select(ENTITY, F.explode(list_ids(column)).alias(TARGET))


def relation(matches: DataFrame, candidates: DataFrame) -> dict[str, int]:
    """Totals of two list files; raises ``ValueError`` when their entities differ or a match is no candidate.

    One pass: both lists meet on their entity, and a list of ids is compared as a set.
    """
    a = matches.select(ENTITY, F.array_distinct(list_ids(MATCHED)).alias("matched"))
    b = candidates.select(ENTITY, F.array_distinct(list_ids("candidate_entity_ids")).alias("listed"))
    both = a.join(b, ENTITY, "full_outer")
    r = both.agg(
        F.count_if(F.col("matched").isNull() | F.col("listed").isNull()).alias("apart"),
        F.count_if(F.size(F.array_except("matched", "listed")) > 0).alias("outside"),
        F.countDistinct(ENTITY).alias("entities"),
        F.coalesce(F.sum(F.size("matched")), F.lit(0)).alias("matched_links"),
        F.coalesce(F.sum(F.size("listed")), F.lit(0)).alias("candidate_links"),
    ).first()
    if r["apart"]:
        raise ValueError("the two outputs hold different entities")
    if r["outside"]:
        raise ValueError("a match is no candidate")
    return {k: r[k] for k in ("entities", "matched_links", "candidate_links")}


def combine_parts(parts: list[DataFrame]) -> DataFrame:
    """Union of part files, ordered by id; a repeated entity raises ``ValueError``."""
    out = parts[0]
    for part in parts[1:]:
        if part.columns != out.columns:
            raise ValueError("part headers differ")
        out = out.unionByName(part)
    if not out.groupBy(ENTITY).count().where("count > 1").isEmpty():
        raise ValueError("an entity has two rows")
    return out.orderBy(ENTITY)


def report(rows: DataFrame, required: DataFrame | None = None, known: DataFrame | None = None, column: str = MATCHED, examples: int = EXAMPLES) -> DataFrame:
    """Offenders by category: ``(category, offenders, examples)`` with at most ``examples`` examples, smallest first.

    Categories: duplicate_entity, duplicate_in_list, self_match, bad_prefix, and where the tables are given
    missing_entity, unexpected_entity, unknown_id. Ids in lists are compared as written.
    """
    ids = rows.select(F.col(ENTITY).alias("entity"), F.explode(list_ids(column)).alias("id"))
    parts = [
        rows.groupBy(F.col(ENTITY).alias("entity")).count().where("count > 1").select(F.lit("duplicate_entity").alias("category"), F.col("entity").alias("example")),
        ids.groupBy("entity", "id").count().where("count > 1").select(F.lit("duplicate_in_list"), F.concat_ws(":", "entity", "id")),
        ids.where(F.col("id").startswith("S1-")).select(F.lit("self_match"), F.concat_ws(":", "entity", "id")),
        ids.where(~F.col("id").rlike("^S[123]-")).select(F.lit("bad_prefix"), F.concat_ws(":", "entity", "id")),
    ]
    if required is not None:
        wanted, got = required.select(F.col(ENTITY).alias("entity")).distinct(), rows.select(F.col(ENTITY).alias("entity")).distinct()
        parts.append(wanted.join(got, "entity", "left_anti").select(F.lit("missing_entity"), "entity"))
        parts.append(got.join(wanted, "entity", "left_anti").select(F.lit("unexpected_entity"), "entity"))
    if known is not None:
        parts.append(ids.join(known.select(F.col("entity_id").alias("id")).distinct(), "id", "left_anti").select(F.lit("unknown_id"), F.concat_ws(":", "entity", "id")))
    union = parts[0]
    for part in parts[1:]:
        union = union.union(part)
    distinct = union.distinct()
    # the examples are a top-k, so only they are gathered
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("category").orderBy("example"))
    first = distinct.withColumn("place", place).where(F.col("place") <= examples).groupBy("category").agg(F.array_join(F.array_sort(F.collect_list("example")), ";").alias("examples"))
    return distinct.groupBy("category").agg(F.count(F.lit(1)).alias("offenders")).join(first, "category")


def file_report(lines: DataFrame, header: list[str], examples: int = EXAMPLES) -> list[str]:
    """Errors of the raw lines of a list file (column ``value``): no UTF-8, empty file, commas for tabs, wrong header,
    and rows without a tab with the first of them."""
    numbered = lines.where(F.trim("value") != "")
    if broken := numbered.where(~F.is_valid_utf8("value")).count():
        return [f"{broken} lines are not UTF-8"]
    first = numbered.limit(1).collect()
    if not first:
        return ["the file is empty"]
    head = first[0]["value"].lstrip("\ufeff").rstrip("\r")
    if "\t" not in head and "," in head:
        return ["the file is separated by commas, not tabs"]
    if [c.strip().lower() for c in head.split("\t")] != [h.lower() for h in header]:
        return [f"the header is not {header}"]
    bad = numbered.where(~F.col("value").contains("\t"))
    count = bad.count()
    return [f"{count} rows without a tab", *(f"without a tab: {r[0]}" for r in bad.orderBy("value").limit(examples).collect())] if count else []
