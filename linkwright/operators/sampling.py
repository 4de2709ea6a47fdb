"""Deterministic samples and splits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENTITY = "source1_entity_id"


def digest(key: str, seed: int = 0) -> Column:
    """A hash that any engine can compute: orders and splits made from it can be checked elsewhere."""
    return F.md5(F.concat_ws("|", F.coalesce(key, F.lit("")), F.lit(str(seed))))


def sample_per_group(frame: DataFrame, group: str, key: str, size: int, seed: int = 0) -> DataFrame:
    """Exactly ``size`` rows of each group (all of a smaller one), the same on every run."""
    order = Window.partitionBy(group).orderBy(digest(key, seed), key)
    return frame.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size).drop("place")


def reservoir(frame: DataFrame, key: str, size: int = 1000, seed: int = 0) -> DataFrame:
    return frame.orderBy(digest(key, seed), key).limit(size)


def split_label(position: Column, validation: float, holdout: float) -> Column:
    """Split of a position in [0, 1): holdout first, then validation, the rest train."""
    return F.when(position < holdout, "holdout").when(position < holdout + validation, "validation").otherwise("train")


def hash_position(key: str, seed: int = 0) -> Column:
    """Position by the first 52 bits of the digest."""
    return F.conv(F.substring(digest(key, seed), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def keyed_position(key: str, seed: int = 0) -> Column:
    """Position by the keyed 64-bit hash that pandas uses, for parity with splits made there."""
    salt = f"{seed:016d}"[-16:]

    @F.pandas_udf("double")
    def position(values: pd.Series) -> pd.Series:
        hashed = pd.util.hash_array(values.astype(object).to_numpy(), hash_key=salt, categorize=False)
        return pd.Series(hashed / float(2**64 - 1))

    return position(F.col(key))


def group_split(frame: DataFrame, key: str = ENTITY, validation: float = 0.1, holdout: float = 0.1, seed: int = 0, parity: bool = False) -> DataFrame:
    """Adds ``split``; rows of one key are never apart."""
    position = keyed_position(key, seed) if parity else hash_position(key, seed)
    return frame.withColumn("split", split_label(position, validation, holdout))


def sample_query_groups(rows: DataFrame, most_rows: int, seed: int = 0) -> DataFrame:
    """Whole queries, about ``most_rows`` rows: the number of queries is the bound over the mean rows of a query."""
    sizes = rows.groupBy(ENTITY).agg(F.count(F.lit(1)).alias("n"))
    total, queries = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    if total <= most_rows:
        return rows
    count = max(1, int(most_rows / (total / queries)))
    return rows.join(sizes.select(ENTITY).orderBy(digest(ENTITY, seed), ENTITY).limit(count), ENTITY, "left_semi")
