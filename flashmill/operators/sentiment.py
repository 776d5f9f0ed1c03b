"""Lexicon sentiment of texts, and its index by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flashmill.operators.lexicon import SENTIMENT_NEGATIONS, occurring, words_literal

LOOK_BACK = 12
DEAD_BAND = 0.01


def score(text: Column, present: Column, positive: list[str], negative: list[str], negations: list[str] = SENTIMENT_NEGATIONS) -> Column:
    """struct(positive_count, negative_count, score): each word's own non-overlapping matches; one with a negation before it counts for the other side.

    present: numbers of the words that occur, positive ones first.
    """
    t = F.coalesce(text, F.lit(""))
    words = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(s).alias("s")) for s, ws in ((1, positive), (-1, negative)) for w in ws])
    here = F.transform(present, lambda i: F.element_at(words, i + 1))

    def turned(before: Column) -> Column:
        return F.exists(words_literal(negations), lambda n: F.contains(before, n))

    def signs(x: Column) -> Column:
        parts = F.split(t, F.concat(F.lit("\\Q"), x["w"], F.lit("\\E")), -1)
        # the text before the k-th match is all pieces up to it, with the word between them
        return F.transform(
            F.sequence(F.lit(1), F.size(parts) - 1),
            lambda k: F.when(turned(F.substring(F.call_function("array_join", F.slice(parts, 1, k), x["w"]), -LOOK_BACK, LOOK_BACK)), -x["s"]).otherwise(x["s"]),
        )

    all_signs = F.flatten(F.transform(here, signs))
    pos, neg = F.size(F.filter(all_signs, lambda s: s > 0)), F.size(F.filter(all_signs, lambda s: s < 0))
    total = pos + neg
    value = F.when(total > 0, F.round((pos - neg).cast("double") / total, 4)).otherwise(F.lit(0.0))
    return F.struct(pos.alias("positive_count"), neg.alias("negative_count"), value.alias("score"))


def with_score(df: DataFrame, text: Column, positive: list[str], negative: list[str]) -> DataFrame:
    d = df.withColumn("_p", occurring(text, [*positive, *negative]))
    d = d.withColumn("_s", score(text, F.col("_p"), positive, negative))
    return d.select(*df.columns, "_s.positive_count", "_s.negative_count", F.col("_s.score").alias("sentiment_score"), F.length(F.coalesce(text, F.lit(""))).alias("total_words"))


def daily_index(scored: DataFrame, date: Column) -> DataFrame:
    """Counts with a dead band, mean, consistency and sample deviation of the scores of each date."""
    s = F.col("sentiment_score")
    g = scored.withColumn("date", date).filter("date is not null").groupBy("date").agg(
        F.count(F.lit(1)).alias("news_count"),
        F.count_if(s > DEAD_BAND).alias("positive_count"),
        F.count_if(s < -DEAD_BAND).alias("negative_count"),
        F.round(F.avg(s), 6).alias("sentiment_intensity"),
        F.round(F.coalesce(F.stddev_samp(s), F.lit(0.0)), 6).alias("sentiment_volatility"),
    )
    both = F.col("positive_count") + F.col("negative_count")
    return g.withColumn("neutral_count", F.col("news_count") - both).withColumn(
        "sentiment_consistency", F.when(both > 0, F.round(F.greatest("positive_count", "negative_count").cast("double") / both, 4)).otherwise(F.lit(0.5))
    )
