"""Run budget, deadlines and metadata."""

from __future__ import annotations

import os
import platform
import subprocess
import threading
import time
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from linkwright.plans.config import config_hash
from linkwright.sources.tables import write_json


class Deadlines:
    """The two moments that bound a run: ``stop``, when nothing new is computed, and ``end``, when all is written.

    Stages are timed, and the seconds a row took foretell how long the same stage takes on other rows; a stage that has
    not run yet foretells nothing.
    """

    def __init__(self, minutes: float, minutes_for_output: float, now=time.monotonic) -> None:
        self.now = now
        self.end = now() + 60 * minutes
        self.stop = self.end - 60 * minutes_for_output
        self.pace: dict[str, float] = {}

    def seconds_left(self) -> float:
        """Until ``stop``."""
        return max(0.0, self.stop - self.now())

    def forecast(self, stage: str, rows: int) -> float:
        return self.pace.get(stage, 0.0) * rows

    @contextmanager
    def stage(self, spark: SparkSession, name: str, rows: int, to_end: bool = False):
        """Runs a stage over so many rows. One that cannot be done in time raises ``TimeoutError`` before it begins,
        and one that is not done in time is cancelled."""
        began = self.now()
        left = (self.end if to_end else self.stop) - began
        if left <= 0 or self.forecast(name, rows) > left:
            raise TimeoutError(f"{name} would take {self.forecast(name, rows):.0f} s of {max(left, 0):.0f} s")
        with deadline(spark, left, f"stage-{name}"):
            yield
        self.pace[name] = (self.now() - began) / max(1, rows)


@contextmanager
def deadline(spark: SparkSession, seconds: float, tag: str):
    """Cancels the tagged jobs of the block when the time is over, and then raises ``TimeoutError``."""
    over = threading.Event()

    def stop() -> None:
        over.set()
        spark.sparkContext.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    spark.sparkContext.addJobTag(tag)
    timer.start()
    try:
        yield
    except Exception as error:
        if over.is_set():
            raise TimeoutError(f"{tag} passed its deadline") from error
        raise
    finally:
        timer.cancel()
        spark.sparkContext.removeJobTag(tag)
    if over.is_set():
        raise TimeoutError(f"{tag} passed its deadline")


def environment() -> str:
    if os.path.isdir("/kaggle/working"):
        return "kaggle"
    return "aws" if os.environ.get("AWS_EXECUTION_ENV") else "local"


def commit(folder: str) -> str | None:
    try:
        out = subprocess.run(["git", "-C", folder, "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10)
    except (OSError, subprocess.TimeoutExpired):
        return None
    return out.stdout.strip() or None


def write_metadata(spark: SparkSession, config: dict, path: str, folder: str = ".") -> dict:
    values = {
        "started": datetime.now(timezone.utc).isoformat(),
        "environment": environment(),
        "commit": commit(folder),
        "config": config,
        "config_hash": config_hash(config),
        "python": platform.python_version(),
        "spark": spark.version,
        "cores": spark.sparkContext.defaultParallelism,
    }
    write_json(values, path, spark)
    return values
