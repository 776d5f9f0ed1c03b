"""Queries of the problems tagged llm, over the tables of TESTDATA.md."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flashmill.llm import copies, language, leaks, lines, neardup, sql, tokens
from flashmill.session import materialize, read_table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    news = read_table(spark, d, "news").select("seq", "batch_no", "source", "content")
    _, good = lines.repeated_lines(lines.line_table(news, "seq", "source", "content"))
    drop = materialize(good.groupBy("_source").agg(F.sort_array(F.collect_set("_line")).alias("_drop")), "drop")
    return neardup.find_repeats(news, drop)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    news = read_table(spark, d, "news").select("seq", "source", "content")
    hits, _ = lines.repeated_lines(lines.line_table(news, "seq", "source", "content"))
    return hits.select(F.col("_id").alias("seq"), F.col("_no").alias("line_no"))


def p4_stripped(spark: SparkSession, d: str) -> DataFrame:
    """news.content without its source's repeated lines, as a digest and length per row."""
    out = lines.strip_repeated(read_table(spark, d, "news").select("seq", "source", "content"), "seq", "source", "content")
    return out.select("seq", F.md5("content").alias("content_md5"), F.length("content").cast("long").alias("n_chars"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    news = read_table(spark, d, "news").select("seq", "title", "content")
    return copies.form_copies(news, "seq", "title", "content").select(F.col("first").alias("first_seq"), F.col("copy").alias("copy_seq"))


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    news = read_table(spark, d, "news").select("seq", "title", "content")
    return copies.form_groups(news, "seq", "title", "content").select(F.col("first").alias("first_seq"), "copies")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    news = read_table(spark, d, "news").select("seq", "title", "content")
    return copies.look_pairs(news, "seq", "title", "content").select(F.col("id_a").alias("seq_a"), F.col("id_b").alias("seq_b"))


def p7_normalised(spark: SparkSession, d: str) -> DataFrame:
    """title and content of news in canonical form, as digests per row."""
    out = copies.normalise(read_table(spark, d, "news").select("seq", "title", "content"), ["title", "content"])
    return out.select("seq", F.md5("title").alias("title_md5"), F.md5("content").alias("content_md5"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(read_table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return leaks.find_leaks(docs, "doc_id", "text", read_table(spark, d, "eval_items").select("item_id", "passage"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Documents and longest verbatim run by leaked item."""
    return _leaks(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("longest").alias("longest"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id", "text", "lang")
    return language.languages(docs, "doc_id", "text", "lang", everything=False).filter("found").select("doc_id", "seg_no", "lang")


def p10_languages(spark: SparkSession, d: str) -> DataFrame:
    """Language and confidence of every document with letters and every line of mixed ones."""
    docs = read_table(spark, d, "documents").select("doc_id", "text", "lang")
    return language.languages(docs, "doc_id", "text", "lang").select("doc_id", "seg_no", "lang", F.round("confidence", 4).alias("confidence"))


def queries() -> dict:
    own = (p1_found, p4_found, p4_stripped, p6_found, p6_records, p7_found, p7_normalised, p8_ids, p9_found, p9_items, p10_found, p10_languages)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict:
    return sql.oracles()
