"""Continuous ingest of source files and of deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from linkwright.functions.text import record_views
from linkwright.sources.tables import SOURCE_COLUMNS, country_slug


def record_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Views of records from the tab-separated files that appear in a folder."""
    schema = StructType([StructField(c, StringType()) for c in SOURCE_COLUMNS])
    reader = spark.readStream.schema(schema).option("sep", "\t").option("header", True).option("escape", '"').option("maxFilesPerTrigger", files_per_batch)
    return record_views(reader.csv(folder)).withColumn("country_slug", country_slug("country"))


def write_by_country(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends Parquet by country, exactly once; stops when no file is left."""
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return writer.partitionBy("country_slug").outputMode("append").trigger(availableNow=True).start()


def first_deliveries(deliveries: DataFrame, late: str = "30 days") -> DataFrame:
    """Each entity and record time once, however often it is delivered; state older than ``late`` is dropped."""
    timed = deliveries.where(F.col("recorded_at").isNotNull()).withColumn("at", F.col("delivered_at").cast("timestamp"))
    return timed.withWatermark("at", late).dropDuplicatesWithinWatermark(["entity_id", "recorded_at"])


def deliveries_per_window(deliveries: DataFrame, window: str = "1 day", late: str = "30 days") -> DataFrame:
    """Deliveries and mean delay by feed and window of arrival."""
    timed = deliveries.withColumn("at", F.col("delivered_at").cast("timestamp"))
    delay = F.unix_timestamp("at") - F.unix_timestamp(F.col("recorded_at").cast("timestamp"))
    grouped = timed.withWatermark("at", late).groupBy(F.window("at", window).alias("window"), F.coalesce("feed_code", F.lit("unknown")).alias("feed_code"))
    return grouped.agg(F.count(F.lit(1)).alias("deliveries"), F.avg(delay).alias("mean_delay_seconds")).select(F.col("window.start").alias("window_start"), "feed_code", "deliveries", "mean_delay_seconds")
