"""Readers and writers: tab-separated sources, ground truth, country partitions, list files, JSON."""

from __future__ import annotations

import json
import os
import posixpath
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from linkwright.functions.text import record_views, squeezed

# The columns of the files.
SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
TRUTH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]
LINKS = StructType([StructField("source1_entity_id", StringType()), StructField("candidate_entity_id", StringType())])


@dataclass(frozen=True)
class Layout:
    """Files of a dataset: ``{split}/{split}_source{1,2,3}.tsv``, and the truth of the training split."""

    root: str

    def source(self, split: str, number: int) -> str:
        return f"{self.root}/{split}/{split}_source{number}.tsv"

    def truth(self) -> str:
        return f"{self.root}/train/train_ground_truth.tsv"

    def files(self) -> dict[str, tuple[str, list[str]]]:
        out = {f"{s}_source{n}": (self.source(s, n), SOURCE_COLUMNS) for s in ("train", "test") for n in (1, 2, 3)}
        return out | {"train_ground_truth": (self.truth(), TRUTH_COLUMNS)}


def inspect(spark: SparkSession, layout: Layout) -> dict[str, dict]:
    """Path, size and columns of each of the seven files; a missing file or another header raises ``ValueError``."""
    out = {}
    for name, (path, columns) in layout.files().items():
        if not exists(spark, path):
            raise ValueError(f"{path} is missing")
        first = spark.read.text(path).limit(1).collect()
        header = first[0][0].lstrip("﻿").rstrip("\r").split("\t") if first else []
        if header != columns:
            raise ValueError(f"{path}: header {header} is not {columns}")
        files, place = _place(spark, path)
        out[name] = {"path": path, "bytes": files.getContentSummary(place).getLength(), "columns": header}
    return out


def read_tsv(spark: SparkSession, path: str, columns: list[str] = SOURCE_COLUMNS, limit: int | None = None, multi_line: bool = False) -> DataFrame:
    """All-text scan of a tab-separated file; nothing is taken for null, quotes are doubled inside quoted fields.

    ``limit`` takes the head of the file and is no random sample. ``multi_line`` allows line breaks inside quoted
    fields; a file is then read by one task, as it cannot be cut at line breaks.
    """
    schema = StructType([StructField(c, StringType()) for c in columns])
    reader = spark.read.schema(schema).option("sep", "\t").option("header", True).option("escape", '"').option("mode", "FAILFAST").option("multiLine", multi_line)
    reader = reader.option("enforceSchema", False).option("encoding", "UTF-8").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    frame = reader.csv(path).na.fill("")
    return frame.limit(limit) if limit else frame


def country_slug(column: Column | str) -> Column:
    """Lower case, other characters as dashes; a country without Latin letters or digits gives ``empty``."""
    value = F.lower(squeezed(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))))
    slug = F.regexp_replace(F.regexp_replace(value, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(slug == "", "empty").otherwise(slug)


def preprocess_source(spark: SparkSession, path: str, prefix: str, out: str, limit: int | None = None) -> dict:
    """Views of one source, written by country; returns the counters of its manifest.

    The file is read once. An id that is empty, lacks the prefix or repeats raises ``ValueError`` and leaves no output.
    """
    frame = read_tsv(spark, path, limit=limit)
    views = record_views(frame).withColumn("country_slug", country_slug("country"))
    seen = Observation()
    views = views.observe(seen, F.count_if(~F.col("entity_id").startswith(prefix)).alias("bad"), F.count(F.lit(1)).alias("rows"))
    write_parquet(views, out, ["country_slug"])
    written = spark.read.parquet(out)
    ids = written.agg(F.countDistinct("entity_id")).first()[0]
    problem = f"{seen.get['bad']} ids without the prefix {prefix}" if seen.get["bad"] else "entity ids repeat" if ids != seen.get["rows"] else ""
    if problem:
        remove(spark, out)
        raise ValueError(problem)
    rows = written.groupBy("country").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("address_norm") == "").alias("empty")).collect()
    return {
        "path": path,
        "rows": sum(r["rows"] for r in rows),
        "empty_addresses": sum(r["empty"] for r in rows),
        "countries": {r["country"]: r["rows"] for r in sorted(rows, key=lambda r: r["country"])},
    }


def preprocess_dataset(spark: SparkSession, layout: Layout, out: str, limit: int | None = None) -> dict:
    """All six sources with the prefix of their number, and a summary manifest."""
    summary = {}
    for split in ("train", "test"):
        for number in (1, 2, 3):
            name = f"{split}_source{number}"
            summary[name] = preprocess_source(spark, layout.source(split, number), f"S{number}-", f"{out}/{split}/source{number}", limit)
    write_json(summary, f"{out}/manifest.json")
    return summary


def read_partition(spark: SparkSession, root: str, slug: str | None = None) -> DataFrame:
    """Views of one country (partition pruning), or of all; without such a folder an empty frame of the four raw columns and the slug."""
    if not exists(spark, root):
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in (*SOURCE_COLUMNS, "country_slug")]))
    frame = spark.read.parquet(root)
    return frame.where(F.col("country_slug") == slug) if slug else frame


def partitions(spark: SparkSession, root: str) -> list[str]:
    return sorted(r[0] for r in spark.read.parquet(root).select("country_slug").distinct().collect())


def write_parquet(frame: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Overwrites through Spark's commit protocol, so readers see all of it or nothing."""
    writer = frame.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path in it; local paths and shared stores alike."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def safe_child(path: str, parent: str) -> str:
    """The path, where it lies below ``parent``; else ``ValueError``. Guards whatever is deleted or overwritten."""
    scheme, other = (re.match(r"(?:(\w+)://)?", x).group(1) or "file" for x in (path, parent))
    child, base = (posixpath.normpath(re.sub(r"^\w+://", "", x)) for x in (path, parent))
    if scheme == "file":
        child, base = os.path.realpath(child), os.path.realpath(base)
    if scheme != other or not child.startswith(base.rstrip("/") + "/"):
        raise ValueError(f"{path} is not inside {parent}")
    return path if "://" in path else child


def reset(spark: SparkSession, path: str, parent: str) -> None:
    """Deletes a stage's folder, which must lie below the run's folder."""
    remove(spark, safe_child(path, parent))


def read_truth(frame: DataFrame) -> DataFrame:
    """Validated truth: one row per entity with its trimmed ids as ``ids``; a broken rule raises ``ValueError``."""
    trim = squeezed(F.coalesce("source1_entity_id", F.lit("")))
    ids = F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    rows = frame.select(trim.alias("source1_entity_id"), ids.alias("ids"))
    bad = rows.agg(
        F.count_if(~F.col("source1_entity_id").startswith("S1-")).alias("entity"),
        F.count_if(F.size("ids") != F.size(F.array_distinct("ids"))).alias("repeated"),
        F.count_if(F.exists("ids", lambda x: ~x.rlike("^S[23]-"))).alias("target"),
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("source1_entity_id").alias("entities"),
    ).first()
    if bad["entity"]:
        raise ValueError("an entity id is empty or not of source 1")
    if bad["rows"] != bad["entities"]:
        raise ValueError("an entity has two rows")
    if bad["repeated"]:
        raise ValueError("a target repeats in a list")
    if bad["target"]:
        raise ValueError("a target is not of source 2 or 3")
    return rows


def truth_links(truth: DataFrame) -> DataFrame:
    """``(source1_entity_id, candidate_entity_id)``; an entity without a link keeps a row with null."""
    return truth.select("source1_entity_id", F.explode_outer("ids").alias("candidate_entity_id"))


def write_list(frame: DataFrame, path: str) -> None:
    """One tab-separated file with a header and line feeds, ordered by its first column; empty lists stay empty.

    Tasks write ordered parts of a range each, on whatever store the path names; the parts are then appended to one
    file beside the target, which is renamed. Only bytes pass through the driver, never rows.
    """
    spark, first = frame.sparkSession, frame.columns[0]
    files, target = _place(spark, path)
    _, staging = _place(spark, f"{path}.parts")
    _, partial = _place(spark, f"{path}.partial")
    line = F.array_join(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in frame.columns]), "\t")
    parts = frame.orderBy(first).select(line.alias("value"))
    parts.write.mode("overwrite").option("lineSep", "\n").text(f"{path}.parts")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = files.create(partial, True)
    out.write(bytearray(("\t".join(frame.columns) + "\n").encode()))
    names = sorted(s.getPath().getName() for s in files.listStatus(staging) if s.getPath().getName().startswith("part-"))
    for name in names:
        part = files.open(jvm.org.apache.hadoop.fs.Path(staging, name))
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
        part.close()
    out.close()
    files.delete(target, True)
    if not files.rename(partial, target):
        raise OSError(f"{path} could not be written")
    files.delete(staging, True)


def read_list(spark: SparkSession, path: str, columns: list[str] = TRUTH_COLUMNS) -> DataFrame:
    return read_tsv(spark, path, columns)


def write_json(value: dict, path: str, spark: SparkSession | None = None) -> None:
    """Sorted keys, indented, written beside and renamed, on whatever store the path names."""
    text = json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False) + "\n"
    spark = spark or SparkSession.active()
    files, target = _place(spark, path)
    _, partial = _place(spark, f"{path}.partial")
    out = files.create(partial, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    files.delete(target, True)
    if not files.rename(partial, target):
        raise OSError(f"{path} could not be written")


def read_json(spark: SparkSession, path: str) -> dict:
    """A small JSON file of whatever store the path names."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def export_clean(frame: DataFrame, path: str) -> None:
    """Tab-separated export of the raw columns with normalised name, address and country beside them."""
    from linkwright.functions.text import normalize_basic

    clean = frame.select(*SOURCE_COLUMNS, *[normalize_basic(c).alias(f"{c}_clean") for c in SOURCE_COLUMNS[1:]])
    clean.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def tsv_to_csv(spark: SparkSession, source: str, target: str, columns: list[str], multi_line: bool = False) -> int:
    """Rewrites tabs as commas with quotes where needed; returns the rows, having compared both ways."""
    frame = read_tsv(spark, source, columns, multi_line=multi_line)
    frame.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(target)
    schema = StructType([StructField(c, StringType()) for c in columns])
    again = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(target).na.fill("")
    if not frame.exceptAll(again).isEmpty() or not again.exceptAll(frame).isEmpty():
        raise ValueError("the converted file differs")
    return again.count()


def slug_of(country: str) -> str:
    """The slug of one label, as :func:`country_slug` makes it."""
    return re.sub("[^a-z0-9]+", "-", country.strip().lower()).strip("-") or "empty"
