"""Adapters of the news sites' raw items (already fetched) to news records; union, order, time range.

Fetching itself is not part of the engine: each adapter takes a DataFrame of
one raw item per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flashmill.functions import text as T

ZONE = "Asia/Shanghai"
TITLE_CHARS = 80


def epoch_time(v: Column, zone: str = ZONE) -> Column:
    """Local ``yyyy-MM-dd HH:mm:ss`` of epoch seconds, or milliseconds above 1e10; null for other values."""
    n = F.when(F.trim(v).rlike(r"^-?\d{1,17}$"), F.trim(v).cast("long"))
    sec = F.when(n > 10_000_000_000, F.floor(n / 1000)).otherwise(n)
    sec = F.when(sec.between(0, 253_402_214_400), sec)
    day = F.timestamp_add("DAY", F.floor(sec / 86400).cast("int"), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
    utc = F.timestamp_add("SECOND", (sec % 86400).cast("int"), day)
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc), "yyyy-MM-dd HH:mm:ss")


def _records(df: DataFrame, prefix: str, ident: Column, title: Column, content: Column, time: Column, source: str) -> DataFrame:
    """Empty content takes the title, empty title the content's start; items with neither, or without time, are out."""
    d = df.select(ident.cast("string").alias("_i"), F.coalesce(title, F.lit("")).alias("_t"), F.coalesce(content, F.lit("")).alias("_c"), time.alias("publish_time"))
    d = d.withColumn("_c", F.when(F.col("_c") == "", F.col("_t")).otherwise(F.col("_c"))).filter("_c <> '' and publish_time is not null")
    ident = F.when(F.coalesce("_i", F.lit("")) != "", F.col("_i")).otherwise(F.translate("publish_time", "- :", ""))
    return d.select(
        F.concat(F.lit(prefix), ident).alias("id"),
        F.when(F.col("_t") != "", F.col("_t")).otherwise(F.substring("_c", 1, TITLE_CHARS)).alias("title"),
        F.col("_c").alias("content"),
        "publish_time",
        F.lit(source).alias("source"),
        F.lit(f"{source}网页接口").alias("data_source"),
        F.lit("7x24实时").alias("data_frequency"),
    )


def cls_items(df: DataFrame) -> DataFrame:
    """Items with ctime (s), title, content, id."""
    c = T.strip_dateline(T.strip_bracket_title(T.strip_html(F.col("content"))), "财联社", "电")
    return _records(df, "cls_", F.col("id"), F.btrim(T.strip_html(F.col("title")), F.lit(T.TITLE_BRACKETS)), c, epoch_time(F.col("ctime").cast("string")), "财联社")


def stcn_items(df: DataFrame) -> DataFrame:
    """Items with time or show_time (s or ms), title, content, id."""
    c = T.strip_dateline(T.strip_bracket_title(T.strip_html(F.col("content"))), "人民财讯", "电")
    when = epoch_time(F.coalesce(F.col("time"), F.col("show_time")).cast("string"))
    return _records(df, "stcn_", F.col("id"), F.btrim(T.strip_html(F.col("title")), F.lit(T.TITLE_BRACKETS)), c, when, "证券时报")


def wallstreetcn_items(df: DataFrame) -> DataFrame:
    """Items with display_time (s), title, content_text, id."""
    t, c = T.split_title(F.col("title"), T.strip_html(F.col("content_text")))
    return _records(df, "wallstreetcn_", F.col("id"), t, c, epoch_time(F.col("display_time").cast("string")), "华尔街见闻")


def jin10_items(df: DataFrame) -> DataFrame:
    """Items with id, time (local text), data{title, content}."""
    t, c = T.split_title(T.strip_promotions(F.col("data.title")), T.strip_promotions(F.col("data.content")))
    infer = r"^(.*?)\s+(金十数据\d{1,2}月\d{1,2}日讯.*)$"
    named = (t == "") & c.rlike(infer)
    t, c = F.when(named, T.clean_title(F.regexp_extract(c, infer, 1))).otherwise(t), F.when(named, T.strip_separator(F.regexp_extract(c, infer, 2))).otherwise(c)
    c = F.btrim(F.regexp_replace(c, r"^金十数据(?:\d{1,2}月\d{1,2}|\d{4}-\d{2}-\d{2})日讯[，,：: ]*", ""))
    when = F.when(T.local_seconds(F.col("time")).isNotNull(), F.col("time"))
    return _records(df, "jin10_", F.col("id"), t, c, when, "金十数据")


def forward_fill(df: DataFrame, group: str, position: str, label: str) -> DataFrame:
    """df with each item's ``label`` filled from the last header before it in its list."""
    w = Window.partitionBy(group).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(label, F.last(label, ignorenulls=True).over(w))


def with_details(items: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """Items whose detail page was fetched."""
    return items.join(pages, url)


def union_sources(*records: DataFrame) -> DataFrame:
    """All records with ``_seq``: the source's place, then the row's own order by id."""
    return reduce(lambda a, b: a.unionByName(b), [r.withColumn("_source_no", F.lit(i)) for i, r in enumerate(records)])


def in_range(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Rows between two local bounds, both included; a bound that is a bare date means its first or last second."""
    full = lambda v, t: v if len(v) > 10 else f"{v} {t}"
    s = T.local_seconds(F.col(time))
    return df.filter(s.between(T.local_seconds(F.lit(full(start, "00:00:00"))), T.local_seconds(F.lit(full(end, "23:59:59")))))


def newest_first(df: DataFrame, time: str, *ties: str) -> DataFrame:
    return df.orderBy(T.local_seconds(F.col(time)).desc_nulls_last(), *ties)
