"""The whole run as stages that write Parquet and read it again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.operators import candidates as C
from linkwright.operators import features as X
from linkwright.operators import metrics, profile, sampling, submission
from linkwright.operators.dense import encoder, semantic_lane
from linkwright.plans import model as M
from linkwright.plans.runtime import Deadlines, write_metadata
from linkwright.session import cut
from linkwright.sources import tables as S

ENTITY = "source1_entity_id"


class Run:
    """Stages over one dataset and one output folder."""

    def __init__(self, spark: SparkSession, data: str, out: str, config: dict) -> None:
        self.spark, self.layout, self.out, self.config = spark, S.Layout(data), out, config
        p = config["project"]
        self.times = Deadlines(p["time_budget_minutes"], p["output_reserve_minutes"])

    # ------------------------------------------------------------------ inputs

    def records(self, split: str) -> tuple[DataFrame, DataFrame]:
        """Queries (source 1) and targets (sources 2 and 3) of a split, in blocks by country slug."""

        def source(number: int) -> DataFrame:
            views = S.read_partition(self.spark, f"{self.out}/preprocessed/{split}/source{number}")
            return views.withColumn("country_label", F.col("country")).withColumn("country", F.col("country_slug"))

        targets = source(2).withColumn("target_source", F.lit("source2")).unionByName(source(3).withColumn("target_source", F.lit("source3")))
        return source(1), targets

    def truth(self) -> tuple[DataFrame, DataFrame]:
        """Entities and links of the ground truth."""
        rows = S.read_truth(S.read_tsv(self.spark, self.layout.truth(), S.TRUTH_COLUMNS))
        return rows.select(ENTITY), S.truth_links(rows).where(F.col("candidate_entity_id").isNotNull())

    # ------------------------------------------------------------------ stages

    def preprocess(self) -> dict:
        S.inspect(self.spark, self.layout)
        S.reset(self.spark, f"{self.out}/preprocessed", self.out)
        return S.preprocess_dataset(self.spark, self.layout, f"{self.out}/preprocessed", self.config["project"]["sample_rows_per_file"])

    def candidates(self, split: str) -> dict:
        queries, targets = self.records(split)
        p, c = self.config["project"], self.config["candidate_generation"]
        if split == "train" and p["train_queries_per_country"]:
            queries = sampling.sample_per_group(queries, "country", "entity_id", p["train_queries_per_country"], p["seed"])
        path = f"{self.out}/candidates/{split}"
        S.reset(self.spark, path, self.out)
        S.write_parquet(queries.select("entity_id", "country"), f"{path}/queries")
        with self.times.stage(self.spark, "candidates", self.spark.read.parquet(f"{path}/queries").count()):
            pairs = C.generate(queries, targets, c)
            e = self.config["embeddings"]
            if e["enabled"] and c["semantic_pairs_per_query"] > 0:
                pairs = cut(pairs)
                extra = semantic_lane(pairs, queries, targets, encoder(e["model_name"], e["max_length"], e["batch_size_per_gpu"]), c["semantic_pairs_per_query"], cross_script_only=e["cross_script_only"])
                pairs = C.cap_candidates(C.merge_lanes([pairs.drop("retrieval_score"), extra]), c["max_candidates_per_query"], per_target=False)
            S.write_parquet(pairs, f"{path}/pairs")
        manifest: dict = {"pairs": self.spark.read.parquet(f"{path}/pairs").count()}
        if split == "train":
            _, links = self.truth()
            chosen = queries.select(F.col("entity_id").alias(ENTITY))
            recall = C.candidate_recall(links.join(chosen, ENTITY, "left_semi"), self.spark.read.parquet(f"{path}/pairs"))
            manifest["recall"] = recall.first().asDict()
        S.write_json(manifest, f"{path}/manifest.json", self.spark)
        return manifest

    def features(self, split: str) -> dict:
        queries, targets = self.records(split)
        # the country feature compares labels, while blocks use slugs
        queries, targets = (f.withColumn("country", F.col("country_label")) for f in (queries, targets))
        pairs = self.spark.read.parquet(f"{self.out}/candidates/{split}/pairs")
        X.check_records(pairs, queries, targets)
        rows = X.pair_features(pairs, queries, targets)
        slugs = queries.select(F.col("entity_id").alias(ENTITY), F.col("country_slug"))
        rows = rows.join(slugs, ENTITY)
        if split == "train":
            t, (_, links) = self.config["training"], self.truth()
            labelled = X.label_pairs(rows, links)
            labelled = sampling.group_split(labelled, ENTITY, t["validation_fraction"], t["holdout_fraction"], self.config["project"]["seed"])
            rows = X.hard_negatives(labelled, t["max_negatives_per_query"])
        path = f"{self.out}/features/{split}"
        S.reset(self.spark, path, self.out)
        with self.times.stage(self.spark, "features", pairs.count()):
            S.write_parquet(rows, f"{path}/rows", ["country_slug"])
        written = self.spark.read.parquet(f"{path}/rows")
        positives = F.sum("label") if split == "train" else F.lit(0)
        summary = {r[0]: {"rows": r[1], "positives": r[2]} for r in written.groupBy("country_slug").agg(F.count(F.lit(1)), positives).collect()}
        S.write_json(summary, f"{path}/manifest.json", self.spark)
        return summary

    def train(self) -> dict:
        t, seed = self.config["training"], self.config["project"]["seed"]
        rows = self.spark.read.parquet(f"{self.out}/features/train/rows")
        chosen = self.spark.read.parquet(f"{self.out}/candidates/train/queries").select(F.col("entity_id").alias(ENTITY))
        entities, links = self.truth()
        entities = sampling.group_split(entities.join(chosen, ENTITY, "left_semi"), ENTITY, t["validation_fraction"], t["holdout_fraction"], seed)

        def part(name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
            own = entities.where(F.col("split") == name).select(ENTITY)
            return rows.where(F.col("split") == name), own, links.join(own, ENTITY, "left_semi")

        train, _, _ = part("train")
        validation, own, own_links = part("validation")
        with self.times.stage(self.spark, "train", rows.count()):
            result = M.tune(train, validation, own, own_links, t, seed)
        held, own, own_links = part("holdout")
        predicted = submission.matches_at(M.score(result["model"], held), result["threshold"])
        result["holdout_score"] = metrics.macro_score(own, own_links, predicted).first()["macro_score"]
        M.save(result, f"{self.out}/model")
        return {k: result[k] for k in ("threshold", "validation_score", "holdout_score", "params")}

    def infer(self) -> dict:
        model = M.load(self.spark, f"{self.out}/model")
        rows = self.spark.read.parquet(f"{self.out}/features/test/rows")
        scored = M.score(model["model"], rows).persist()
        entities = self.records("test")[0].select(F.col("entity_id").alias(ENTITY))
        matches = submission.id_lists(entities, submission.matches_at(scored, model["threshold"]))
        pairs = submission.id_lists(entities, rows, "candidate_entity_ids")
        S.write_list(matches, f"{self.out}/matching_results.tsv")
        S.write_list(pairs, f"{self.out}/candidate_pairs.tsv")
        totals = submission.relation(matches, pairs)
        by_country = {r["country"]: r.asDict() for r in profile.stage_summary(scored.withColumnRenamed("country_slug", "country"), model["threshold"]).collect()}
        scored.unpersist()
        S.write_json({"totals": totals, "countries": by_country}, f"{self.out}/inference.json", self.spark)
        return totals

    def validate(self, ids: bool = False) -> dict:
        """Offenders by category of the written lists; empty where they are valid. ``warning`` holds what is allowed but odd."""
        path, other = f"{self.out}/matching_results.tsv", f"{self.out}/candidate_pairs.tsv"
        errors: dict = {}
        for name, header in ((path, S.TRUTH_COLUMNS), (other, [ENTITY, "candidate_entity_ids"])):
            if not S.exists(self.spark, name):
                errors.setdefault("file", []).append(f"{name} is missing")
            elif found := submission.file_report(self.spark.read.text(name), header):
                errors.setdefault("file", []).extend(found)
        if errors:
            return errors
        queries, targets = self.records("test")
        required = queries.select(F.col("entity_id").alias(ENTITY))
        matches, candidates = S.read_list(self.spark, path), S.read_list(self.spark, other, [ENTITY, "candidate_entity_ids"])
        found = submission.report(matches, required, targets if ids else None)
        out = {r["category"]: [r["offenders"], r["examples"]] for r in found.collect()}
        outside = submission.subset_violations(submission.links(matches, submission.MATCHED), submission.links(candidates, "candidate_entity_ids"))
        if count := outside.count():
            out["warning"] = [f"{count} matches are no candidates", ";".join(f"{r[0]}:{r[1]}" for r in outside.orderBy(*outside.columns).limit(submission.EXAMPLES).collect())]
        return out

    def run_all(self) -> dict:
        write_metadata(self.spark, self.config, f"{self.out}/run_metadata.json")
        self.preprocess()
        for split in ("train", "test"):
            self.candidates(split)
        for split in ("train", "test"):
            self.features(split)
        result = self.train() | {"outputs": self.infer()}
        problems = self.validate()
        if set(problems) - {"warning"}:
            raise ValueError(f"the output is not valid: {problems}")
        S.write_json(result, f"{self.out}/completed_run.json", self.spark)
        return result
