"""Command line: inspect, preprocess, candidates, features, train, infer, validate, run-all."""

from __future__ import annotations

import argparse
import json

from linkwright.plans import config as configuration
from linkwright.plans.pipeline import Run
from linkwright.session import DEFAULTS
from linkwright.sources import tables


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="linkwright")
    out.add_argument("command", choices=["inspect", "preprocess", "candidates", "features", "train", "infer", "validate", "run-all"])
    out.add_argument("--data", required=True, help="folder of the dataset")
    out.add_argument("--out", required=True, help="folder of the results")
    out.add_argument("--config", help="YAML file over the profile")
    out.add_argument("--profile", default="default", choices=sorted(configuration.PROFILES))
    out.add_argument("--split", choices=["train", "test"])
    out.add_argument("--check-ids", action="store_true")
    return out


def main(arguments: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    options = parser().parse_args(arguments)
    if options.command in ("candidates", "features") and not options.split:
        parser().error(f"{options.command} needs --split")
    config = configuration.load(options.config, options.profile)
    spark = SparkSession.builder.config(map=DEFAULTS).getOrCreate()
    run = Run(spark, options.data, options.out, config)
    actions = {
        "inspect": lambda: tables.inspect(spark, run.layout),
        "preprocess": run.preprocess,
        "candidates": lambda: run.candidates(options.split),
        "features": lambda: run.features(options.split),
        "train": run.train,
        "infer": run.infer,
        "validate": lambda: run.validate(options.check_ids),
        "run-all": run.run_all,
    }
    result = actions[options.command]()
    print(json.dumps(result, indent=2, ensure_ascii=False, default=str))
    return 1 if options.command == "validate" and result else 0


if __name__ == "__main__":
    raise SystemExit(main())
