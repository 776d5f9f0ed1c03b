"""Queries of the problems in the core: nested records (2), repeated deliveries (3), timestamps (5)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flashmill.operators import messages, nested, timestamps
from flashmill.session import delete_at_exit, materialize, read_table, shared_dir


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    rows = nested.flatten_extractions(read_table(spark, d, "extractions").select("extraction_id", "payload"), "extraction_id", "payload")
    return rows.filter(F.col("child").isin("event", "commodity", "dominant_type")).select("extraction_id", "item_no", "child", "child_no", "child_value")


def p2_events(spark: SparkSession, d: str) -> DataFrame:
    """The flat table of events with all their fields, tied to extraction and place."""
    return nested.flatten_events(read_table(spark, d, "extractions").select("extraction_id", "payload"), "extraction_id", "payload")


def message_key(news_id: str, epoch: str, raw: str) -> Column:
    """Exact identifier of a delivery: news_id as written, with the instant or else the text of its time."""
    when = F.when(F.col(epoch).isNotNull(), F.concat(F.lit("@"), F.col(epoch).cast("string"))).otherwise(F.concat(F.lit("="), F.coalesce(F.col(raw), F.lit(""))))
    return F.when(F.regexp_replace(F.col(news_id), r"(?U)\s+", "") != "", F.concat_ws("\u0000", F.col(news_id), when))


def _news_instants(spark: SparkSession, d: str, *more: str) -> DataFrame:
    news = read_table(spark, d, "news").select("seq", "source", "publish_time", *more)
    return timestamps.resolve(news, "publish_time", "source", read_table(spark, d, "feeds"))


#: p3_found feeds its batches to the store in this many calls, whole batches each.
ROUNDS = 4


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The batches of news go to a new store in order of batch_no, in ROUNDS calls of like size."""
    rows = _news_instants(spark, d, "news_id", "batch_no")
    message = message_key("news_id", "epoch_us", "publish_time").alias("message")
    rows = materialize(rows.select("seq", "batch_no", message).filter("message is not null"), "arrivals")
    batches = rows.groupBy("batch_no").count().orderBy(F.col("batch_no").asc_nulls_first()).collect()
    total, done, calls = sum(r["count"] for r in batches), 0, {}
    for r in batches:
        calls.setdefault(done * ROUNDS // total, []).append(r["batch_no"])
        done += r["count"]
    path = f"{shared_dir(spark)}/seen-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    store = messages.SeenStore(spark, path, max(64, total // 2_000_000))
    dups = None
    for k, some in calls.items():
        # the table is sorted out by whole ranges of batch numbers; null counts as the lowest
        high = F.coalesce(F.col("batch_no"), F.lit(-1 << 63)).between(*((-1 << 63) if x is None else x for x in (some[0], some[-1])))
        one = store.add(rows.filter(high), F.col("message"), "seq", token=str(k))
        dups = one if dups is None else dups.unionByName(one)
    if dups is None:
        return rows.select(F.col("seq").alias("kept_seq"), F.col("seq").alias("dup_seq"))
    return store.kept(dups).select(F.col("kept").alias("kept_seq"), F.col("dup").alias("dup_seq"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    news = read_table(spark, d, "news").select(F.lit("news").alias("rec"), F.col("seq").alias("rec_id"), F.col("publish_time").alias("text"), "source")
    items = read_table(spark, d, "review_items").select(F.lit("review_items").alias("rec"), F.col("review_id").alias("rec_id"), F.col("time").alias("text"), "source")
    out = timestamps.resolve(news.unionByName(items), "text", "source", read_table(spark, d, "feeds"))
    return out.filter(F.col("epoch_us").isNotNull()).select("rec", "rec_id", "epoch_us")


def p5_status(spark: SparkSession, d: str) -> DataFrame:
    """How the time texts of each source came out."""
    news = read_table(spark, d, "news").select("publish_time", "source")
    out = timestamps.resolve(news, "publish_time", "source", read_table(spark, d, "feeds"))
    return out.groupBy("source", "status").agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_events, p3_found, p5_found, p5_status)}
