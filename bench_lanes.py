"""Times the token lanes at the size of the published retrieval run: 5,000 queries against about 2,000,000 targets of
one country, after preparation. The targets are the records of the largest test tables, eight times over with other
letters, as no table here has so many."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from linkwright.functions.text import record_views  # noqa: E402
from linkwright.operators import candidates as C  # noqa: E402
from linkwright.session import cut, local_session  # noqa: E402

FOLDER = os.environ.get("BENCH_LANES_DIR", "/root/testdata/check_l")
CORES = os.environ.get("BENCH_CPUS", "8")
COPIES, QUERIES = 8, 5_000
LETTERS = ["aeioubdgklmnprst", "eiouadgbklmnprst", "iouaebdgmklnprst", "ouaeibdgklmrnpst", "uaeioklmbdgnprst", "eiouabdgklmsnprt", "iouaedgbmklrnpst", "ouaeigbdlmkpnrts"]


def main() -> None:
    folder = "file://" + tempfile.mkdtemp(prefix="bench-")
    spark = local_session(CORES, 4 * int(CORES), **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"), "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": folder})
    spark.sparkContext.setLogLevel("ERROR")

    def source(name: str):
        return spark.read.parquet(f"{FOLDER}/{name}.parquet").dropDuplicates(["entity_id"]).withColumn("country", F.lit("india"))

    began = time.perf_counter()
    queries = cut(record_views(source("train_source1").orderBy("entity_id").limit(QUERIES)))
    both = source("train_source2").withColumn("target_source", F.lit("source2")).unionByName(source("train_source3").withColumn("target_source", F.lit("source2")))
    copies = []
    for i, letters in enumerate(LETTERS[:COPIES]):
        changed = [F.translate(F.lower(c), LETTERS[0], letters).alias(c) for c in ("business_name", "business_address")]
        copies.append(both.select(F.concat("entity_id", F.lit(f"-{i}")).alias("entity_id"), *changed, "country", "target_source"))
    union = copies[0]
    for one in copies[1:]:
        union = union.unionByName(one)
    targets = cut(record_views(union))
    out = {"queries": queries.count(), "targets": targets.count(), "preparation": round(time.perf_counter() - began, 1)}
    for name, lane in (("token", lambda: C.token_lane(queries, targets)), ("address", lambda: C.address_token_lane(queries, targets))):
        began = time.perf_counter()
        out[f"{name}_pairs"] = cut(lane()).count()
        out[f"{name}_seconds"] = round(time.perf_counter() - began, 1)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
