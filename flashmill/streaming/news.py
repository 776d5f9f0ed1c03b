"""The news pipeline over a stream of JSON records: watermark, deliveries once, events by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flashmill.functions import text as T
from flashmill.operators.events import extract
from flashmill.operators.lexicon import Ontology
from flashmill.sources.files import NEWS


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(NEWS).json(path)


def daily_counts(stream: DataFrame, o: Ontology, late: str = "2 hours") -> DataFrame:
    """Per day and direction: events of records not seen within the watermark."""
    d = stream.withColumn("ts", F.timestamp_seconds(T.local_seconds(F.col("publish_time")))).filter("ts is not null")
    d = d.withColumn("key", T.dedup_key(F.col("title"), F.col("content"), F.col("source"), F.col("publish_time")))
    d = d.withWatermark("ts", late).dropDuplicatesWithinWatermark(["key"])
    e = extract(d, o, "content", "title").select("ts", F.explode("extraction.events").alias("e"))
    return e.groupBy(F.window("ts", "1 day"), F.col("e.direction").alias("direction")).agg(F.count(F.lit(1)).alias("events"))
