"""Candidate generation: exact blocks, sparse similarity lanes, merging and caps.

All countries and both targets go through one plan; country and target are join keys, not loops. Frames of queries and
targets hold ``entity_id``, ``country`` (the blocking label) and the view columns; targets also ``target_source``.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.functions import text as T
from linkwright.session import cut

KEYS = ["source1_entity_id", "candidate_entity_id", "target_source"]
SIGNALS = ["name_tfidf", "address_tfidf", "token_tfidf", "dense_score", "exact_name", "exact_address", "exact_name_core", "exact_numbers"]
EXACT = {"name_norm": "exact_name", "address_punct": "exact_address", "name_core": "exact_name_core", "address_numbers": "exact_numbers"}


def exact_lane(queries: DataFrame, targets: DataFrame, view: str, signal: str, most: int) -> DataFrame:
    """Pairs with an equal non-empty view; values held by more than ``most`` queries or targets of a country are left out."""
    left = queries.select(F.col("entity_id").alias(KEYS[0]), "country", F.col(view).alias("key")).where("key <> ''")
    right = targets.select(F.col("entity_id").alias(KEYS[1]), "target_source", "country", F.col(view).alias("key")).where("key <> ''")
    # the frequency filter is a partial aggregation and a join on its survivors, so a hot key is never gathered
    few_left = left.groupBy("country", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most).drop("n")
    few_right = right.groupBy("country", "target_source", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most).drop("n")
    keys = few_right.join(few_left, ["country", "key"])
    pairs = left.join(keys, ["country", "key"]).join(right, ["country", "target_source", "key"])
    return pairs.select(*KEYS, F.lit(1.0).alias(signal))


def exact_lanes(queries: DataFrame, targets: DataFrame, max_block: int = 200, max_candidates: int = 40) -> list[DataFrame]:
    return [exact_lane(queries, targets, view, signal, min(max_block, max_candidates)) for view, signal in EXACT.items()]


def document_frequency(terms: DataFrame, partition: list[str]) -> DataFrame:
    """Documents per term; ``terms`` has one row per document and distinct term."""
    return terms.groupBy(*partition, "term").agg(F.count(F.lit(1)).alias("df"))


def _postings(frame: DataFrame, document: Column, group: list[str], repeats: bool) -> DataFrame:
    """One row per record and term with the times it occurs; documents whose terms never repeat need no shuffle for it."""
    exploded = frame.select("entity_id", *group, F.explode(document).alias("term"))
    if not repeats:
        return exploded.withColumn("tf", F.lit(1))
    return exploded.groupBy("entity_id", *group, "term").agg(F.count(F.lit(1)).alias("tf"))


def most_frequent(vocabulary: DataFrame, group: list[str], most: int) -> DataFrame:
    """The ``most`` terms of each group by ``total``, ties at the last place in the order of the terms.

    A histogram of totals gives the last total that is kept; only terms of just that total are ordered.
    """
    steps = vocabulary.groupBy(*group, "total").agg(F.count(F.lit(1)).alias("terms"))
    above = F.sum("terms").over(Window.partitionBy(*group).orderBy(F.col("total").desc()).rowsBetween(Window.unboundedPreceding, -1))
    steps = steps.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < most)
    kept = vocabulary.join(steps, [*group, "total"])
    whole = kept.where(F.col("above") + F.col("terms") <= most).drop("above", "terms")
    place = F.row_number().over(Window.partitionBy(*group).orderBy("term"))
    last = kept.where(F.col("above") + F.col("terms") > most).withColumn("place", place).where(F.col("place") <= most - F.col("above"))
    return whole.unionByName(last.drop("above", "terms", "place"))


def tfidf_lane(
    queries: DataFrame,
    targets: DataFrame,
    document: Column,
    signal: str,
    top_k: int,
    least: float,
    most_df: int | None = None,
    max_features: int | None = None,
    count_empty: bool = True,
    digits: int = 6,
    capped_only_above: bool = False,
    repeats: bool = True,
) -> DataFrame:
    """The ``top_k`` most similar targets of each query by cosine of TF-IDF vectors.

    Vectors are fitted on the targets of each country and source: sublinear term frequency, ``ln((1+n)/(1+df)) + 1``,
    unit length after pruning. Terms in more than ``most_df`` targets are dropped on both sides, which bounds the
    targets any query term meets; ``capped_only_above`` drops them only in a corpus larger than the cap.
    ``max_features`` keeps the terms most frequent by total count; ``repeats`` says whether a document may hold a term twice. Ties at the last place go to the smaller id.
    """
    group = ["country", "target_source"]
    q_tf, t_tf = _postings(queries, document, ["country"], repeats), _postings(targets, document, group, repeats)
    if repeats:
        # what is used more than once is written once
        t_tf = cut(t_tf)
    documents = targets if count_empty else targets.where(F.size(document) > 0)
    corpus = documents.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    vocabulary = t_tf.groupBy(*group, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    vocabulary = vocabulary.join(F.broadcast(corpus), group)
    if most_df is not None:
        above = (F.col("n") <= most_df) if capped_only_above else F.lit(False)
        vocabulary = vocabulary.where(above | (F.col("df") <= most_df))
    if max_features is not None:
        vocabulary = most_frequent(cut(vocabulary), group, max_features)
    # a target's length needs all its terms, but only those that a query holds are ever looked up
    asked = q_tf.select("country", "term").distinct().withColumn("asked", F.lit(True))
    vocabulary = vocabulary.join(asked, ["country", "term"], "left")
    vocabulary = cut(vocabulary.select(*group, "term", "asked", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf")))
    weight = (1 + F.log("tf")) * F.col("idf")
    q_raw = q_tf.join(vocabulary, ["country", "term"]).select("entity_id", *group, "term", "asked", weight.alias("w"))
    t_raw = t_tf.join(vocabulary, [*group, "term"]).select("entity_id", *group, "term", "asked", weight.alias("w"))
    left = cut(_vectors(q_raw, ["entity_id", *group]).withColumnRenamed("entity_id", KEYS[0]))
    right = cut(_vectors(t_raw, ["entity_id", *group]).withColumnRenamed("entity_id", KEYS[1]))
    best = _block_product(left, right, group, top_k, least, digits)
    place = F.row_number().over(Window.partitionBy(KEYS[0], "target_source").orderBy(F.col("similarity").desc(), KEYS[1]))
    return best.withColumn("place", place).where(F.col("place") <= top_k).select(*KEYS, F.col("similarity").alias(signal))


def _vectors(weights: DataFrame, document: list[str]) -> DataFrame:
    """One row per document: its asked terms (64-bit hashes) with their weights, at unit length over all its terms."""
    item = F.when(F.col("asked"), F.struct(F.xxhash64("term").alias("term"), "w"))
    gathered = weights.groupBy(*document).agg(F.collect_list(item).alias("items"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    gathered = gathered.where(F.size("items") > 0)
    return gathered.select(*document, F.col("items.term").alias("terms"), F.transform("items", lambda x: x["w"] / F.col("norm")).alias("weights"))


class Block:
    """Targets of one block as postings in flat arrays: by term for finding, by target for scoring."""

    def __init__(self, ids: np.ndarray, terms: list[np.ndarray], weights: list[np.ndarray]) -> None:
        self.ids = ids
        sizes = np.array([len(x) for x in terms])
        flat, self.weights = np.concatenate(terms), np.concatenate(weights)
        self.known, self.numbers = np.unique(flat, return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        order = np.argsort(self.numbers, kind="stable")
        self.owners, self.by_term = np.repeat(np.arange(len(ids)), sizes)[order], self.weights[order]
        self.ends = np.cumsum(np.bincount(self.numbers, minlength=len(self.known)))
        self.most = np.maximum.reduceat(self.by_term, np.concatenate([[0], self.ends[:-1]]))
        self.query = np.zeros(len(self.known))

    def _sums(self, hits: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Targets that hold any of these terms, with the sums of what they share."""
        starts = np.where(hits > 0, self.ends[hits - 1], 0)
        places = np.concatenate([self.owners[s:e] for s, e in zip(starts, self.ends[hits])])
        parts = np.concatenate([self.by_term[s:e] * w for s, e, w in zip(starts, self.ends[hits], weights)])
        if 8 * len(places) < len(self.ids):
            found, inverse = np.unique(places, return_inverse=True)
            return found, np.bincount(inverse, parts)
        sums = np.bincount(places, parts, len(self.ids))
        found = np.flatnonzero(sums)
        return found, sums[found]

    def best(self, terms: np.ndarray, weights: np.ndarray, top_k: int, least: float, digits: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best targets of a query.

        Frequent terms that together cannot lift a target to ``least`` find none; they only add to the scores of
        targets that the other terms have found and that can still be among the best.
        """
        at = np.minimum(np.searchsorted(self.known, terms), len(self.known) - 1)
        own = self.known[at] == terms
        at, weights = at[own], weights[own]
        if not len(at):
            return at, weights
        bounds, half = weights * self.most[at], 0.5 * 10.0**-digits
        order = np.argsort(-bounds, kind="stable")
        rest = np.cumsum(bounds[order][::-1])[::-1]
        finding = int(np.count_nonzero(rest >= least - half - 1e-9))
        if not finding:
            return at[:0], weights[:0]
        found, scores = self._sums(at[order[:finding]], weights[order[:finding]])
        if finding < len(at):
            bar = least if len(found) <= top_k else max(least, -np.partition(-scores, top_k - 1)[top_k - 1])
            found = found[scores >= bar - rest[finding] - half - 1e-9]
            self.query[at] = weights
            sizes = self.starts[found + 1] - self.starts[found]
            first = np.cumsum(sizes) - sizes
            index = np.repeat(self.starts[found] - first, sizes) + np.arange(sizes.sum())
            scores = np.add.reduceat(self.query[self.numbers[index]] * self.weights[index], first) if len(found) else scores[:0]
            self.query[at] = 0
        scores = np.round(scores, digits)
        good = np.flatnonzero((scores >= least) & (scores > 0))
        if len(good) > top_k:
            last = -np.partition(-scores[good], top_k - 1)[top_k - 1]
            good = good[scores[good] >= last]
        # targets stand in the order of their ids, so a stable sort puts the smaller id first
        good = good[np.argsort(-scores[good], kind="stable")[:top_k]]
        return found[good], scores[good]


def _block_product(left: DataFrame, right: DataFrame, group: list[str], top_k: int, least: float, digits: int, q_block: int = 50_000, t_block: int = 200_000) -> DataFrame:
    """The best ``top_k`` targets of each query within each block of targets, by dot product.

    Queries and targets of a partition are cut into blocks of bounded size by hash, and every pair of blocks is one
    task. What crosses the network is a vector per block of the other side, not a row per common term: a target
    ``queries / q_block`` times, a query ``targets / t_block`` times. Inside a task only postings of shared terms are
    touched. Few queries are cut into smaller blocks, so that all cores have work.
    """
    cores = left.sparkSession.sparkContext.defaultParallelism

    def blocked(frame: DataFrame, key: str, size: Column, own: str) -> tuple[DataFrame, DataFrame]:
        counts = frame.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(f"{own}_blocks"))
        placed = frame.join(counts, group).withColumn(own, F.pmod(F.xxhash64(key), F.col(f"{own}_blocks")).cast("int")).drop(f"{own}_blocks")
        return placed, counts

    spread = F.least(F.lit(q_block), F.greatest(F.lit(500), F.ceil(F.count(F.lit(1)) / cores)))
    q, q_counts = blocked(left, KEYS[0], spread, "qb")
    t, t_counts = blocked(right, KEYS[1], F.lit(t_block), "tb")
    q = q.join(t_counts, group).withColumn("tb", F.explode(F.sequence(F.lit(0), F.col("tb_blocks") - 1))).drop("tb_blocks")
    t = t.join(q_counts, group).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qb_blocks") - 1))).drop("qb_blocks")
    columns = [KEYS[0], KEYS[1], "target_source", "similarity"]

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            b = b.sort_values(KEYS[1], kind="stable")
            block = Block(b[KEYS[1]].to_numpy(), list(b["terms"]), list(b["weights"]))
            for key, terms, weights in zip(a[KEYS[0]], a["terms"], a["weights"]):
                places, scores = block.best(terms, weights, top_k, least, digits)
                if len(places):
                    out.append((np.full(len(places), key, object), block.ids[places], scores))
        if not out:
            return pd.DataFrame({c: pd.Series(dtype="float64" if c == "similarity" else "object") for c in columns})
        return pd.DataFrame(dict(zip(columns, (np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out]), b["target_source"].iloc[0], np.concatenate([x[2] for x in out])))))

    keys = [*group, "qb", "tb"]
    # both sides come from one frame; new names for their columns tell them apart
    q, t = (f.select(*[F.col(c).alias(c) for c in f.columns]) for f in (q, t))
    return q.groupBy(*keys).cogroup(t.groupBy(*keys)).applyInPandas(run, f"{KEYS[0]} string, {KEYS[1]} string, target_source string, similarity double")


def token_lane(queries: DataFrame, targets: DataFrame, top_k: int = 12, least: float = 0.01, most_df: int = 5000, buckets: int | None = None) -> DataFrame:
    """Cosine over name words, address words and numbers as one document; ``buckets`` hashes the terms."""
    document = T.token_document("name_punct", "address_punct")
    if buckets:
        # a hash that any engine can compute
        document = F.transform(document, lambda t: (F.conv(F.substring(F.md5(t), 1, 12), 16, 10).cast("long") % buckets).cast("string"))
    return tfidf_lane(queries, targets, document, "token_tfidf", top_k, least, most_df, repeats=buckets is not None)


def address_token_lane(queries: DataFrame, targets: DataFrame, top_k: int = 20, least: float = 0.01, most_df: int = 20000) -> DataFrame:
    return tfidf_lane(queries, targets, T.token_document(F.lit(""), "address_punct"), "address_tfidf", top_k, least, most_df, repeats=False)


def char_lane(
    queries: DataFrame, targets: DataFrame, view: str, signal: str, top_k: int, least: float, most_df: int = 5000, max_features: int | None = 400_000, low: int = 3, high: int = 5
) -> DataFrame:
    """Cosine over character n-grams inside words; only targets with text count."""
    return tfidf_lane(queries, targets, T.char_ngrams(view, low, high), signal, top_k, least, most_df, max_features, count_empty=False, capped_only_above=True)


def merge_lanes(lanes: list[DataFrame]) -> DataFrame:
    """One row per pair with the greatest value of each signal, 0 where no lane gives it, and the retrieval score."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lanes)
    for signal in SIGNALS:
        if signal not in union.columns:
            union = union.withColumn(signal, F.lit(0.0))
    merged = union.groupBy(*KEYS).agg(*[F.max(F.coalesce(s, F.lit(0.0))).alias(s) for s in SIGNALS])
    similar = F.greatest("name_tfidf", "address_tfidf", "token_tfidf", "dense_score")
    exact = F.greatest("exact_name", "exact_address", "exact_name_core", "exact_numbers")
    return merged.withColumn("retrieval_score", similar + 0.35 * exact)


def cap_candidates(pairs: DataFrame, most: int, per_target: bool) -> DataFrame:
    """The best ``most`` candidates of a query, within each target or over both."""
    keys = [KEYS[0], "target_source"] if per_target else [KEYS[0]]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("retrieval_score").desc(), KEYS[1]))
    return pairs.withColumn("place", place).where(F.col("place") <= most).drop("place")


def generate(queries: DataFrame, targets: DataFrame, config: dict) -> DataFrame:
    """All enabled lanes, merged and capped per target and then over both targets.

    ``token_hash_features`` terms are hashed to so many buckets in the token lane; 0 keeps the terms themselves.
    """
    c = config
    lanes = exact_lanes(queries, targets, c["max_exact_block_size"], c["max_candidates_per_query"])
    if c["method"] == "token_hash":
        lanes.append(token_lane(queries, targets, c["token_top_k"], c["token_min_similarity"], c["max_tfidf_document_frequency"], c["token_hash_features"] or None))
        if c["token_address_top_k"] > 0:
            lanes.append(address_token_lane(queries, targets, c["token_address_top_k"], c["token_min_similarity"], c["token_address_max_document_frequency"]))
    elif c["method"] == "char_tfidf":
        for view, signal, k, least in (
            ("name_punct", "name_tfidf", c["name_top_k"], c["min_name_similarity"]),
            ("address_punct", "address_tfidf", c["address_top_k"], c["min_address_similarity"]),
        ):
            if k > 0:
                lanes.append(
                    char_lane(queries, targets, view, signal, k, least, c["max_tfidf_document_frequency"], c["max_tfidf_features"], c["char_ngram_min"], c["char_ngram_max"])
                )
    else:
        raise ValueError(f"unknown method {c['method']}")
    capped = cap_candidates(merge_lanes(lanes), c["max_candidates_per_query"], per_target=True)
    return cap_candidates(capped, c["max_candidates_per_query"], per_target=False)


def candidate_recall(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: links, recovered links, pair recall, share of entities with all links found, pairs, mean candidates.

    ``truth`` has one row per link ``(source1_entity_id, candidate_entity_id)``; entities without a link do not count.
    Without any link both rates are 1.
    """
    found = pairs.select(*KEYS[:2]).distinct().withColumn("hit", F.lit(1))
    links = truth.select(*KEYS[:2]).distinct().join(found, KEYS[:2], "left")
    per = links.groupBy(KEYS[0]).agg(F.count(F.lit(1)).alias("links"), F.sum(F.coalesce("hit", F.lit(0))).alias("hits"))
    totals = per.agg(
        F.coalesce(F.sum("links"), F.lit(0)).alias("total_links"),
        F.coalesce(F.sum("hits"), F.lit(0)).alias("recovered_links"),
        F.count(F.lit(1)).alias("entities"),
        F.coalesce(F.sum(F.when(F.col("links") == F.col("hits"), 1).otherwise(0)), F.lit(0)).alias("complete"),
    )
    sizes = pairs.groupBy(KEYS[0]).agg(F.count(F.lit(1)).alias("n"))
    volume = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("candidate_pairs"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean_candidates"))
    rate = F.when(F.col("total_links") == 0, 1.0).otherwise(F.col("recovered_links") / F.greatest("total_links", F.lit(1)))
    whole = F.when(F.col("entities") == 0, 1.0).otherwise(F.col("complete") / F.greatest("entities", F.lit(1)))
    # both sides are single aggregated rows
    return totals.crossJoin(volume).select(
        "total_links", "recovered_links", rate.alias("pair_recall"), whole.alias("entity_recall"), "candidate_pairs", "mean_candidates"
    )
