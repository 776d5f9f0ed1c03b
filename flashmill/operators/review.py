"""Samples for human review, and quality metrics of reviewed items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def draw(id_col: str, seed: int) -> Column:
    """Deterministic draw of a row: the same on every engine and partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def random_sample(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """n rows without replacement; all rows if there are fewer. A top-n, not a full sort."""
    return df.withColumn("_d", draw(id_col, seed)).orderBy("_d", id_col).limit(n).drop("_d")


def by_type_sample(df: DataFrame, n: int, id_col: str, types: str, seed: int = 42) -> DataFrame:
    """About n rows spread over the values of the array column ``types``; a row may be drawn for several. Empty without types.

    Each type keeps its top rows by partial aggregation before the window, so a
    type with most of the rows isn't sorted in one task.
    """
    e = df.select("*", F.explode(types).alias("sample_type")).withColumn("_d", draw(id_col, seed))
    kinds = max(1, e.select("sample_type").distinct().count())
    per = max(1, n // kinds)
    salt = F.pmod(F.xxhash64(id_col), F.lit(64))
    near = Window.partitionBy("sample_type", salt).orderBy("_d", id_col)
    e = e.withColumn("_r", F.row_number().over(near)).filter(F.col("_r") <= per)
    w = Window.partitionBy("sample_type").orderBy("_d", id_col)
    e = e.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per).drop("_r")
    return e.orderBy("_d", "sample_type", id_col).limit(n).drop("_d")


def edge_cases(df: DataFrame) -> DataFrame:
    """Mixed directions, an uncertain event, or five events and more."""
    s = F.col("extraction.summary")
    return df.filter((s["net_direction"] == "mixed") | F.exists("extraction.events", lambda e: e["degree"] == "uncertain") | (s["total_events"] >= 5))


def for_review(sample: DataFrame, id_col: str, text: Column, time: Column, source: Column) -> DataFrame:
    """Review items: the sample's ordinal (by draw order of a bounded sample), the prediction, and empty places for the judgement."""
    w = Window.orderBy(draw(id_col, 42), id_col)
    empty = F.array().cast(sample.schema["extraction"].dataType["events"].dataType)
    return sample.select(
        (F.row_number().over(w) - 1).alias("sample_id"),
        text.alias("text"),
        time.alias("time"),
        source.alias("source"),
        F.col("extraction.events").alias("predicted_events"),
        F.col("extraction.summary").alias("predicted_summary"),
        F.col("extraction.commodities").alias("predicted_commodities"),
        F.lit(False).alias("reviewed"),
        empty.alias("correct_events"),
        empty.alias("missed_events"),
        empty.alias("wrong_events"),
        F.lit(None).cast("string").alias("overall_correct"),
        F.lit("").alias("comment"),
    )


def _size(c: str) -> Column:
    return F.sum(F.coalesce(F.size(F.coalesce(F.col(c), F.array())), F.lit(0)))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def metrics(items: DataFrame) -> DataFrame:
    """One row over the reviewed items; no row if there are none."""
    t = items.filter("reviewed").agg(
        F.count(F.lit(1)).alias("total_reviewed"),
        F.count_if(F.lower("overall_correct") == "true").alias("fully_correct"),
        F.count_if(F.lower("overall_correct") == "partial").alias("partially_correct"),
        F.count_if(F.lower("overall_correct") == "false").alias("wrong"),
        F.coalesce(_size("correct_events"), F.lit(0)).alias("tp"),
        F.coalesce(_size("wrong_events"), F.lit(0)).alias("fp"),
        F.coalesce(_size("missed_events"), F.lit(0)).alias("fn"),
    )
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    p, r = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    t = t.filter("total_reviewed > 0").withColumn("accuracy", (F.col("fully_correct") + F.col("partially_correct") * F.lit(0.5)).cast("double") / F.col("total_reviewed"))
    return t.withColumns({"precision": F.round(p, 4), "recall": F.round(r, 4), "f1": F.round(_ratio(2 * p * r, p + r), 4)})


def type_breakdown(items: DataFrame) -> DataFrame:
    """Predicted, correct, missed and wrong events by type, with precision and recall."""
    kinds = {"predicted": "predicted_events", "correct": "correct_events", "missed": "missed_events", "wrong": "wrong_events"}

    def tagged(kind: str, column: str) -> Column:
        known = F.coalesce(F.col(column), F.array().cast(items.schema[column].dataType))
        return F.transform(known, lambda e: F.struct(F.lit(kind).alias("kind"), F.coalesce(e["event_type"], F.lit("unknown")).alias("event_type")))

    parts = F.concat(*[tagged(k, c) for k, c in kinds.items()])
    e = items.filter("reviewed").select(F.explode(parts).alias("x")).select("x.*")
    t = e.groupBy("event_type").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
    c, w, m = (F.col(x).cast("double") for x in ("correct", "wrong", "missed"))
    return t.withColumns({"precision": F.round(_ratio(c, c + w), 4), "recall": F.round(_ratio(c, c + m), 4)})
