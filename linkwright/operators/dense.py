"""Dense-vector retrieval and the bounded semantic rerank lane."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkwright.functions import text as T
from linkwright.operators.candidates import KEYS
from linkwright.operators.features import cross_script
from linkwright.session import cut
from linkwright.sources.tables import exists

EPSILON = 1e-12
SHARD = "entity_id string, embedding array<float>"


def unit(column: str) -> Column:
    """The vector at length one."""
    norm = F.sqrt(F.aggregate(column, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.transform(column, lambda x: x.cast("double") / F.greatest(norm, F.lit(EPSILON)))


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def _best(matrix: np.ndarray, ids: list, key: str, vector: str, k: int, digits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            batch = batch.sort_values(key, kind="stable")
            own = np.stack(batch[vector].to_numpy()).astype(np.float64)
            own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), EPSILON)
            similar, names = np.round(matrix @ own.T, digits), batch[key].to_numpy()
            if similar.shape[1] > k:
                # everything down to the k-th value, ties included; ids ascend, so the first of equals has the smaller id
                bar = -np.partition(-similar, k - 1, axis=1)[:, k - 1]
                rows, columns = np.nonzero(similar >= bar[:, None])
            else:
                rows, columns = (x.ravel() for x in np.indices(similar.shape))
            order = np.lexsort((columns, -similar[rows, columns], rows))
            rows, columns = rows[order], columns[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            rows, columns = rows[place < k], columns[place < k]
            yield pd.DataFrame({"query_id": [ids[r] for r in rows], "target_id": names[columns], "similarity": similar[rows, columns]})

    return run


def nearest(queries: DataFrame, targets: DataFrame, key: str, vector: str, k: int, least: float | None = None, block: int = 4096, digits: int = 6) -> DataFrame:
    """``(query_id, target_id, similarity)``: the ``k`` targets of greatest cosine for each query, against all targets.

    Queries are a stated set: they are taken in blocks of at most ``block`` rows and each block meets every batch of
    targets as one matrix product; a batch hands on only its own best ``k`` per query, so the exchange holds
    ``k`` rows per query and batch instead of all pairs. The driver holds one block at a time: with several, the
    result of each is written before the next is read. Ties go to the smaller target id.
    """
    blocks = max(1, -(-queries.count() // block))
    kinds = dict(queries.dtypes)[key], dict(targets.dtypes)[key]
    schema = f"query_id {kinds[0]}, target_id {kinds[1]}, similarity double"
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "target_id"))
    parts = []
    for i in range(blocks):
        rows = queries.where(F.col(vector).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(blocks)) == i)).select(key, vector).collect()
        if not rows:
            continue
        matrix = np.array([r[1] for r in rows], dtype=np.float64)
        matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), EPSILON)
        found = targets.select(key, vector).where(F.col(vector).isNotNull()).mapInPandas(_best(matrix, [r[0] for r in rows], key, vector, k, digits), schema)
        if least is not None:
            found = found.where(F.col("similarity") >= least)
        found = found.withColumn("place", place).where(F.col("place") <= k).drop("place")
        parts.append(cut(found) if blocks > 1 else found)
    if not parts:
        return targets.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def semantic_lane(
    pairs: DataFrame, queries: DataFrame, targets: DataFrame, encode: Callable[[DataFrame], DataFrame], per_query: int, least: float = 0.0, cross_script_only: bool = True
) -> DataFrame:
    """Pairs whose names are in different scripts (or all), the best ``per_query`` of each query and target, scored by ``encode``.

    ``encode`` maps records to ``(entity_id, embedding)`` and sees only records of the chosen pairs.
    """
    scripts = [f.select(F.col("entity_id").alias(k), F.col("name_script").alias(n)) for f, k, n in ((queries, KEYS[0], "a"), (targets, KEYS[1], "b"))]
    crossing = pairs.join(scripts[0], KEYS[0]).join(scripts[1], KEYS[1]).where(cross_script("a", "b") if cross_script_only else F.lit(True))
    order = Window.partitionBy(KEYS[0], "target_source").orderBy(F.col("retrieval_score").desc(), KEYS[1])
    chosen = crossing.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_query).select(*KEYS)
    left = encode(queries.join(chosen.select(F.col(KEYS[0]).alias("entity_id")).distinct(), "entity_id", "left_semi"))
    right = encode(targets.join(chosen.select(F.col(KEYS[1]).alias("entity_id")).distinct(), "entity_id", "left_semi"))
    x = left.select(F.col("entity_id").alias(KEYS[0]), unit("embedding").alias("x"))
    y = right.select(F.col("entity_id").alias(KEYS[1]), unit("embedding").alias("y"))
    scored = chosen.join(x, KEYS[0]).join(y, KEYS[1]).select(*KEYS, dot("x", "y").cast("float").alias("dense_score"))
    return scored.where(F.col("dense_score") >= least)


def ngram_encoder(width: int = 256, low: int = 2, high: int = 3) -> Callable[[DataFrame], DataFrame]:
    """An encoder that needs no weights: hashed character n-grams of name and address, read in Latin letters, so that
    records in different scripts share them."""

    def encode(records: DataFrame) -> DataFrame:
        read = records.select("entity_id", T.romanized("name_norm").alias("name"), T.romanized("address_norm").alias("address"))
        places = read.select("entity_id", F.transform(F.concat(T.char_ngrams("name", low, high), T.char_ngrams("address", low, high)), lambda g: F.pmod(F.hash(g), F.lit(width))).alias("places"))
        counted = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: (F.size("places") - F.size(F.array_remove("places", i))).cast("float"))
        return places.select("entity_id", counted.alias("embedding"))

    return encode


def model_encoder(model: str, most_tokens: int, batch: int, prefix: str = "query") -> Callable[[DataFrame], DataFrame]:
    """An encoder by a sentence model that every worker can load; each task loads it once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from sentence_transformers import SentenceTransformer

        loaded = SentenceTransformer(model)
        loaded.max_seq_length = most_tokens
        for frame in batches:
            made = loaded.encode(list(frame["text"]), batch_size=batch, normalize_embeddings=True)
            yield pd.DataFrame({"entity_id": frame["entity_id"], "embedding": list(np.asarray(made, dtype=np.float32))})

    def encode(records: DataFrame) -> DataFrame:
        texts = records.select("entity_id", T.embedding_text(prefix, "name_norm", "address_norm", "country").alias("text"))
        return texts.mapInPandas(run, "entity_id string, embedding array<float>")

    return encode


def encoder(model: str, most_tokens: int, batch: int) -> Callable[[DataFrame], DataFrame]:
    """The sentence model where its library is installed, else hashed n-grams."""
    if importlib.util.find_spec("sentence_transformers") is not None:
        return model_encoder(model, most_tokens, batch)
    return ngram_encoder()


def write_shards(records: DataFrame, encode: Callable[[DataFrame], DataFrame], path: str, non_latin_only: bool = False) -> None:
    """Embeddings of records as Parquet shards, one per task, ids beside their vectors; all of them or none are seen."""
    chosen = records.where(F.col("has_non_latin_name")) if non_latin_only else records
    encode(chosen).select("entity_id", F.col("embedding").cast("array<float>").alias("embedding")).write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Embeddings of all shards; without such a folder, or without a shard, none."""
    if not exists(spark, path):
        return spark.createDataFrame([], SHARD)
    return spark.read.schema(SHARD).parquet(path)


def lane_from_shards(spark: SparkSession, queries: str, targets: str, source: str, top_k: int, least: float = 0.0) -> DataFrame:
    """Candidates ``(<keys>, dense_score)`` of one target source by cosine of the shards of both sides."""
    found = nearest(read_shards(spark, queries), read_shards(spark, targets), "entity_id", "embedding", top_k, least)
    return found.select(F.col("query_id").alias(KEYS[0]), F.col("target_id").alias(KEYS[1]), F.lit(source).alias(KEYS[2]), F.col("similarity").cast("float").alias("dense_score"))
