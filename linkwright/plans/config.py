"""Run configuration: defaults, merging with rejection of unknown keys, validation, hash."""

from __future__ import annotations

import copy
import hashlib
import json
from typing import Any

# The defaults change answers and are part of the contract.
DEFAULTS: dict[str, dict[str, Any]] = {
    "project": dict(
        seed=42, time_budget_minutes=480, output_reserve_minutes=35, chunksize=250_000, feature_chunk_rows=400_000, sample_rows_per_file=None, train_queries_per_country=None
    ),
    "candidate_generation": dict(
        method="char_tfidf", token_top_k=12, token_address_top_k=0, token_address_max_document_frequency=20_000, token_min_similarity=0.01, token_hash_features=4_194_304,
        token_query_chunk_size=10_000, token_threads=4, name_top_k=12, address_top_k=10, semantic_pairs_per_query=3, max_candidates_per_query=40, max_exact_block_size=200,
        char_ngram_min=3, char_ngram_max=5, min_name_similarity=0.18, min_address_similarity=0.16, max_tfidf_features=400_000, tfidf_query_chunk_size=2_000,
        max_tfidf_document_frequency=5_000,
    ),
    "embeddings": dict(enabled=True, model_name="intfloat/multilingual-e5-small", model_path=None, max_length=128, batch_size_per_gpu=192, cross_script_only=True, max_minutes=65),
    "training": dict(
        validation_fraction=0.10, holdout_fraction=0.10, tuning_trials=12, tuning_timeout_seconds=2400, tuning_sample_rows=4_000_000, max_negatives_per_query=12,
        early_stopping_rounds=75, max_boost_rounds=1400, threshold_min=0.20, threshold_max=0.98, threshold_steps=79, device="cpu",
    ),
}

# What each profile changes.
PROFILES: dict[str, dict[str, dict[str, Any]]] = {
    "default": {},
    "kaggle": {
        "project": dict(time_budget_minutes=180, output_reserve_minutes=20, train_queries_per_country=50_000),
        "candidate_generation": dict(method="token_hash", token_top_k=20, token_address_top_k=20, max_tfidf_document_frequency=10_000, semantic_pairs_per_query=0, max_candidates_per_query=32, max_exact_block_size=20),
        "embeddings": dict(enabled=False),
        "training": dict(max_negatives_per_query=8, tuning_trials=4, tuning_timeout_seconds=1200, tuning_sample_rows=1_000_000, max_boost_rounds=800, early_stopping_rounds=50, threshold_steps=40),
    },
    "aws": {
        "candidate_generation": dict(max_tfidf_features=500_000, name_top_k=14, address_top_k=12, min_name_similarity=0.16, min_address_similarity=0.14, semantic_pairs_per_query=4, max_candidates_per_query=35),
        "training": dict(max_negatives_per_query=14, tuning_trials=15, tuning_timeout_seconds=2700, tuning_sample_rows=5_000_000, max_boost_rounds=1600),
    },
    "smoke": {
        "project": dict(time_budget_minutes=30, output_reserve_minutes=5, sample_rows_per_file=10_000),
        "candidate_generation": dict(max_tfidf_features=25_000, name_top_k=5, address_top_k=5, semantic_pairs_per_query=0, max_candidates_per_query=15, max_exact_block_size=30),
        "embeddings": dict(enabled=False),
        "training": dict(max_negatives_per_query=6, tuning_trials=2, tuning_timeout_seconds=120, tuning_sample_rows=50_000, max_boost_rounds=100, early_stopping_rounds=15),
    },
}

#: Numeric bounds by dotted key: least, whether it is itself allowed, most, whether it is itself allowed.
_POSITIVE, _NATURAL, _UNIT = (0, False, None, True), (0, True, None, True), (0, True, 1, True)
BOUNDS: dict[str, tuple] = {
    **{f"project.{k}": _POSITIVE for k in ("time_budget_minutes", "chunksize", "feature_chunk_rows")},
    "project.output_reserve_minutes": _NATURAL,
    **{
        f"candidate_generation.{k}": _POSITIVE
        for k in (
            "token_top_k token_hash_features token_query_chunk_size token_threads token_address_max_document_frequency max_exact_block_size "
            "max_tfidf_features tfidf_query_chunk_size max_tfidf_document_frequency"
        ).split()
    },
    **{f"candidate_generation.{k}": _NATURAL for k in ("token_address_top_k", "name_top_k", "address_top_k", "semantic_pairs_per_query")},
    **{f"candidate_generation.{k}": _UNIT for k in ("token_min_similarity", "min_name_similarity", "min_address_similarity")},
    "candidate_generation.max_candidates_per_query": (1, True, 500, True),
    **{f"embeddings.{k}": _POSITIVE for k in ("max_length", "batch_size_per_gpu", "max_minutes")},
    "training.validation_fraction": (0, False, 0.5, False),
    "training.holdout_fraction": (0, True, 0.5, False),
    **{
        f"training.{k}": _POSITIVE
        for k in "tuning_trials tuning_timeout_seconds tuning_sample_rows max_negatives_per_query max_boost_rounds early_stopping_rounds".split()
    },
    "training.threshold_steps": (2, True, None, True),
}
OPTIONAL = ("project.sample_rows_per_file", "project.train_queries_per_country")


def merge(base: dict, changes: dict, path: str = "") -> dict:
    """Deep merge; a key that the base lacks raises ``ValueError`` with its dotted path."""
    out = copy.deepcopy(base)
    for key, value in changes.items():
        if key.startswith("_"):
            continue
        if key not in base:
            raise ValueError(f"unknown configuration key: {path}{key}")
        if isinstance(base[key], dict):
            if not isinstance(value, dict):
                raise ValueError(f"{path}{key} must be a section")
            out[key] = merge(base[key], value, f"{path}{key}.")
        else:
            out[key] = value
    return out


def _check(name: str, value: Any, bound: tuple) -> None:
    least, least_in, most, most_in = bound
    low = value >= least if least_in else value > least
    high = most is None or (value <= most if most_in else value < most)
    if not (low and high):
        raise ValueError(f"{name} is out of bounds: {value}")


def validate(config: dict) -> dict:
    """The configuration, where every value and combination is allowed; else ``ValueError`` naming the key."""
    for name, bound in BOUNDS.items():
        section, key = name.split(".")
        _check(name, config[section][key], bound)
    for name in OPTIONAL:
        section, key = name.split(".")
        if config[section][key] is not None:
            _check(name, config[section][key], _POSITIVE)
    p, c, t = config["project"], config["candidate_generation"], config["training"]
    share = t["validation_fraction"] + t["holdout_fraction"]
    rules = {
        "project.output_reserve_minutes leaves no time": p["time_budget_minutes"] > p["output_reserve_minutes"],
        "candidate_generation.method is unknown": c["method"] in ("char_tfidf", "token_hash"),
        "candidate_generation has no lane": c["name_top_k"] + c["address_top_k"] > 0,
        "candidate_generation.char_ngram_min and max are out of order": 1 <= c["char_ngram_min"] <= c["char_ngram_max"],
        "training fractions take half of the entities or more": 0 < share < 0.5,
        "training.tuning_timeout_seconds exceeds the run": t["tuning_timeout_seconds"] <= p["time_budget_minutes"] * 60,
        "training.threshold_min and max are out of order": 0 <= t["threshold_min"] <= t["threshold_max"] <= 1,
        "training.device is unknown": str(t["device"]) == "cpu" or str(t["device"]).startswith("cuda"),
    }
    for message, holds in rules.items():
        if not holds:
            raise ValueError(message)
    return config


def load(path: str | None = None, profile: str = "default", **changes: dict) -> dict:
    """Defaults, changed by a profile, a YAML file and keyword sections, in this order; validated."""
    config = merge(DEFAULTS, PROFILES[profile])
    if path:
        import yaml

        with open(path, encoding="utf-8") as file:
            config = merge(config, yaml.safe_load(file) or {})
    return validate(merge(config, changes))


def config_hash(config: dict) -> str:
    """Twelve hex digits of the canonical JSON; keys that begin with an underscore do not count."""
    kept = {k: v for k, v in config.items() if not k.startswith("_")}
    text = json.dumps(kept, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[:12]
