"""Filling fixed-capacity containers with documents.

Sizes are tokens of a public tokenizer. A document larger than the capacity is cut into full pieces and a rest; no
other is split. The cost of a container is estimated as linear in its tokens plus quadratic in each piece (attention
within a document); pieces go in descending order to the container of lowest cost that still has room, and a new one
is opened where none has.

Containers are filled in groups of about ``group_tokens`` tokens, or ``PER_GROUP`` containers where these hold more,
chosen by a hash of the piece, so each task holds a bounded group whatever the skew of sizes or sources; a group leaves
at most about one container part empty.

Defined results: null and empty texts have no tokens and take no place; repeated documents are packed each; a document
that appears twice under one id is packed twice; capacities that are null or below one raise ``ValueError``.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokenizer files, the file used, and the pattern that cuts text before byte pairs are merged.
TOKENIZERS = os.environ.get("TOKENIZER_FOLDER", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Cost per token, and per squared token of a piece.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
#: Tokens of a group of pieces, and containers that it fills at least.
GROUP_TOKENS, PER_GROUP = 8_000_000, 200
MOST_CAPACITIES = 100


def encoder(path: str, pattern: str = PATTERN):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``(<key>, tokens)`` of every document; 0 for null and empty texts.

    The vocabulary lies where the driver runs, and is sent to every executor.
    """
    vocabulary = path or f"{TOKENIZERS}/{VOCABULARY}"
    documents.sparkSession.sparkContext.addFile(vocabulary)
    name = os.path.basename(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(SparkFiles.get(name)).encode_ordinary
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "tokens": [len(encode(t)) if t else 0 for t in batch["text"]]})

    kind = dict(documents.dtypes)[key]
    return documents.select(key, F.col(text).alias("text")).mapInPandas(run, f"{key} {kind}, tokens long")


def fill(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container of each piece, given descending sizes of at most ``capacity``."""
    room = np.full(max(1, -(-int(sizes.sum()) // capacity)), capacity, np.int64)
    cost = np.zeros(len(room))
    out = np.zeros(len(sizes), np.int64)
    for i, size in enumerate(sizes):
        at = int(np.where(room >= size, cost, np.inf).argmin())
        if room[at] < size:
            at = len(room)
            room, cost = np.append(room, capacity), np.append(cost, 0.0)
        room[at] -= size
        cost[at] += LINEAR * size + QUADRATIC * float(size) ** 2
        out[i] = at
    return out


def pack(counts: DataFrame, capacities: dict[int, int], key: str = "doc_id", group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece and limit: ``limit_id, <key>, piece, first_token, tokens, container``.

    ``container`` is unique within a limit.
    """
    if len(capacities) > MOST_CAPACITIES or any(c is None or c < 1 for c in capacities.values()):
        raise ValueError("capacities must be positive and few")
    kind = dict(counts.dtypes)[key]
    total = counts.agg(F.sum("tokens")).first()[0] or 0
    limits = F.array(*[F.struct(F.lit(k).cast("long").alias("limit_id"), F.lit(int(c)).cast("long").alias("capacity")) for k, c in sorted(capacities.items())])
    pieces = counts.where(F.col("tokens") > 0).select(key, "tokens", F.explode(limits).alias("limit"))
    pieces = pieces.select(key, "limit.*", F.col("tokens").alias("all"))
    pieces = pieces.withColumn("piece", F.explode(F.sequence(F.lit(0), F.ceil(F.col("all") / F.col("capacity")).cast("int") - 1)))
    first = F.col("piece") * F.col("capacity")
    pieces = pieces.select("limit_id", "capacity", key, "piece", first.alias("first_token"), F.least("capacity", F.col("all") - first).alias("tokens"))
    groups = F.greatest(F.lit(1), F.ceil(F.lit(total) / F.greatest(F.lit(group_tokens), PER_GROUP * F.col("capacity")))).cast("long")
    pieces = pieces.withColumn("groups", groups).withColumn("pack_group", F.pmod(F.xxhash64(key, "piece"), F.col("groups")))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["tokens", key, "piece"], ascending=[False, True, True], kind="stable")
        held = fill(frame["tokens"].to_numpy(), int(frame["capacity"].iloc[0]))
        return frame.assign(container=held * frame["groups"].iloc[0] + frame["pack_group"].iloc[0])[["limit_id", key, "piece", "first_token", "tokens", "container"]]

    schema = f"limit_id long, {key} {kind}, piece int, first_token long, tokens long, container long"
    return pieces.groupBy("limit_id", "pack_group").applyInPandas(run, schema)


def capacities_of(limits: DataFrame) -> dict[int, int]:
    """Capacities by id; the table is small and its size is checked."""
    rows = limits.select("limit_id", "capacity_tokens").limit(MOST_CAPACITIES + 1).collect()
    if len(rows) > MOST_CAPACITIES:
        raise ValueError("too many capacities")
    return {r[0]: r[1] for r in rows}


def fullness(packed: DataFrame, capacities: dict[int, int]) -> DataFrame:
    """Per limit: containers, tokens, and the share of their capacity that is used."""
    size = F.element_at(F.create_map(*[F.lit(x) for k, c in capacities.items() for x in (int(k), int(c))]), F.col("limit_id").cast("int"))
    per = packed.groupBy("limit_id").agg(F.countDistinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    return per.withColumn("used", F.col("tokens") / (F.col("containers") * size))
