"""Queries of the news pipeline's operators over the tables of TESTDATA.md, each over whole tables, with equivalent SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flashmill.functions import text as T
from flashmill.operators import events, expansion, news_dedup, review, sentiment
from flashmill.operators import lexicon as L
from flashmill.plans import sql
from flashmill.session import materialize, read_table
from flashmill.sources import sites

NEWS = ("seq", "title", "content", "publish_time", "source")


def news(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return read_table(spark, d, "news").select(*(columns or NEWS))


def ontology(spark: SparkSession, d: str) -> L.Ontology:
    """Triggers of the triggers table, then those words of the lexicon table that aren't triggers, by polarity."""
    t = [L.Trigger(w, k, n, x) for _, w, k, n, x in sorted(L.read_words(read_table(spark, d, "triggers"), "trigger_id", "word", "event_type", "event_type_name", "direction"))]
    lex = lexicon_words(spark, d)
    t += [L.Trigger(w, "price_move", "价格变动", "bullish" if p == "positive" else "bearish") for w, p in lex]
    return L.Ontology(t)


def lexicon_words(spark: SparkSession, d: str) -> list[tuple[str, str]]:
    """(word, polarity) of unambiguous lexicon words, in order."""
    return sorted(L.read_words(expansion.merge_seeds(read_table(spark, d, "lexicon")), "word", "polarity"))


def news_normalize(spark, d):
    n = news(spark, d)
    cols = [F.col(c) for c in ("title", "content", "source", "publish_time")]
    t, c = T.normalize_news_text(F.col("title")), T.normalize_news_text(F.col("content"))
    return n.select("seq", F.md5(t).alias("title_md5"), F.md5(c).alias("content_md5"), F.length(T.combined_text(F.col("title"), F.col("content"))).alias("n_chars"), T.dedup_key(*cols).alias("dedup_key"))


def news_sort(spark, d):
    return sites.newest_first(news(spark, d, "seq", "publish_time"), "publish_time", "seq").select("seq", T.local_seconds(F.col("publish_time")).alias("local_s"))


def time_range_scan(spark, d):
    return sites.in_range(news(spark, d, "seq", "publish_time"), "publish_time", "2025-01-01", "2025-06-30").select("seq", "publish_time")


def time_bucket(spark, d):
    return news(spark, d, "seq", "publish_time").groupBy(T.time_bucket(F.col("publish_time")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def epoch_times(spark, d):
    return news(spark, d, "seq", "publish_time").select("seq", sites.epoch_time(F.col("publish_time")).alias("local_time")).filter("local_time is not null")


def html_clean(spark, d):
    page = F.concat(F.lit("<p>"), F.col("title"), F.lit("</p><BR/>"), F.col("content"), F.lit(" <a href='x'>…</a>"))
    return news(spark, d, "seq", "title", "content").select("seq", F.md5(T.strip_html(page)).alias("text_md5"), F.md5(T.clean_corpus_text(page)).alias("corpus_md5"))


def title_split(spark, d):
    raw = F.concat(F.lit("【"), F.col("title"), F.lit("】 — "), F.col("content"))
    t, c = T.split_title(F.lit(""), raw)
    return news(spark, d, "seq", "title", "content").select("seq", t.alias("title"), F.md5(c).alias("body_md5"))


def relevance_filter(spark, d):
    return news(spark, d, "seq", "title", "content").filter(expansion.is_relevant(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit(""))))).select("seq")


def dedup_exact(spark, d):
    return news_dedup.exact_dedup(news(spark, d))


def simhash(spark, d):
    return news(spark, d).select("seq", news_dedup.simhash(T.combined_text(F.col("title"), F.col("content"))).alias("simhash"))


def near_dup_links(spark, d):
    """Number of earlier-processed candidates of each distinct timed text that has any."""
    nd = materialize(news_dedup.nodes(news(spark, d)), "nodes")
    return news_dedup.candidate_pairs(nd).groupBy(F.col("cur").alias("seq")).agg(F.count(F.lit(1)).alias("links"))


def dedup_near(spark, d):
    return news_dedup.deduplicate(news(spark, d))


def removal_ratio(spark, d):
    n = news(spark, d)
    return news_dedup.exact_dedup(n).agg(F.sum("copies").alias("before"), F.count(F.lit(1)).alias("after")).withColumn("removed", F.round((F.col("before") - F.col("after")).cast("double") / F.col("before"), 4))


def _extracted(spark, d, *more: str) -> DataFrame:
    return events.extract(news(spark, d, "seq", "title", "content", *more), ontology(spark, d), "content", "title")


def trigger_match(spark, d):
    n = events.with_events(news(spark, d, "seq", "content"), F.col("content"), ontology(spark, d))
    return n.select("seq", F.explode("_events").alias("e")).select("seq", F.col("e.position").alias("position"), F.col("e.trigger_word").alias("trigger_word"))


def event_extract(spark, d):
    e = _extracted(spark, d).select("seq", F.explode("extraction.events").alias("e"))
    return e.select("seq", *[F.col(f"e.{c}").alias(c) for c in ("event_type", "direction", "degree", "trigger_word", "reversed", "reversal_word", "degree_word", "position")])


def event_summary(spark, d):
    return _extracted(spark, d).select("seq", "event_count", "net_direction", "event_types")


def commodity_detect(spark, d):
    return _extracted(spark, d).select("seq", "commodities")


def batch_stats(spark, d):
    return _extracted(spark, d).groupBy("net_direction").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_count") > 0).alias("with_events"), F.sum("event_count").alias("events"))


def daily_event_index(spark, d):
    return events.daily_event_index(_extracted(spark, d, "publish_time"), T.date_key(F.col("publish_time")))


def _scored(spark, d) -> DataFrame:
    lex = lexicon_words(spark, d)
    n = news(spark, d, "seq", "title", "content", "publish_time")
    return sentiment.with_score(n, T.first_text(F.col("content"), F.col("title")), [w for w, p in lex if p == "positive"], [w for w, p in lex if p == "negative"])


def sentiment_score(spark, d):
    return _scored(spark, d).select("seq", "positive_count", "negative_count", "sentiment_score", "total_words")


def daily_sentiment_index(spark, d):
    return sentiment.daily_index(_scored(spark, d), T.date_key(F.col("publish_time")))


def review_sample_random(spark, d):
    return review.random_sample(news(spark, d, "seq", "source"), 50, "seq")


def review_sample_by_type(spark, d):
    r = read_table(spark, d, "review_items").select("review_id", F.array_distinct(F.transform("predicted_events", lambda e: e["event_type"])).alias("types"))
    return review.by_type_sample(r, 50, "review_id", "types").select("review_id", "sample_type")


def review_edge_cases(spark, d):
    r = read_table(spark, d, "review_items").select("review_id", F.struct(F.col("predicted_summary").alias("summary"), F.col("predicted_events").alias("events")).alias("extraction"))
    return review.edge_cases(r).select("review_id")


def review_prepare(spark, d):
    o = ontology(spark, d)
    s = review.random_sample(news(spark, d), 50, "seq")
    e = events.extract(s, o, "content", "title")
    return review.for_review(e, "seq", F.col("content"), F.col("publish_time"), F.col("source"))


def review_metrics(spark, d):
    return review.metrics(read_table(spark, d, "review_items"))


def review_type_breakdown(spark, d):
    return review.type_breakdown(read_table(spark, d, "review_items"))


def lexicon_merge(spark, d):
    return expansion.merge_seeds(read_table(spark, d, "lexicon"))


def _lexicon_parts(spark, d) -> tuple[DataFrame, DataFrame]:
    x = read_table(spark, d, "lexicon").withColumn("polarity", T.polarity_of(F.col("polarity")))
    return x.filter("similarity is null"), x.filter("similarity is not null")


def lexicon_final(spark, d):
    return expansion.final_lexicon(*_lexicon_parts(spark, d))


def lexicon_counts(spark, d):
    return expansion.final_lexicon(*_lexicon_parts(spark, d)).groupBy("polarity", "source").agg(F.count(F.lit(1)).alias("n"))


def candidate_filter(spark, d):
    seeds, cand = _lexicon_parts(spark, d)
    return expansion.filter_candidates(cand.select("word", F.col("source").alias("source_seed"), "similarity", "polarity"), seeds)


def embedding_topk(spark, d):
    e = read_table(spark, d, "embeddings")
    return expansion.nearest(e, "vec_id", "embedding", e.filter("vec_id % 100 = 0"), least=-1.0)


def _stub(s: Column) -> Column:
    """A fixed classifier: label and confidence by the sentence's digest."""
    h = F.conv(F.substring(F.md5(s), 1, 2), 16, 10).cast("int")
    return F.struct(F.when(h < 120, "positive").when(h < 200, "negative").otherwise("neutral").alias("label"), (F.lit(0.4) + h.cast("double") / 512).alias("confidence"))


def template_vote(spark, d):
    return expansion.votes(expansion.merge_seeds(read_table(spark, d, "lexicon")), _stub)


def corpus_merge(spark, d):
    t = read_table(spark, d, "documents").select("text").unionByName(read_table(spark, d, "news").select(F.col("content").alias("text")))
    return expansion.corpus(t, "text").select(F.md5("text").alias("text_md5"), "len")


def corpus_stats(spark, d):
    return read_table(spark, d, "documents").agg(F.count("text").alias("texts"), F.sum(F.length("text")).alias("chars"))


def date_forward_fill(spark, d):
    n = news(spark, d, "seq", "source", "publish_time").withColumn("date", F.when(F.pmod("seq", F.lit(7)) == 0, T.date_key(F.col("publish_time"))))
    return sites.forward_fill(n, "source", "seq", "date").select("seq", "date")


def list_detail_join(spark, d):
    items = read_table(spark, d, "extractions").select("extraction_id", "news_id").filter("news_id is not null and trim(news_id) <> ''")
    pages = news(spark, d, "seq", "news_id").filter("news_id is not null and trim(news_id) <> ''")
    return sites.with_details(items, pages, "news_id").select("extraction_id", "seq")


def w2v_expand(spark, d):
    seeds = lexicon_merge(spark, d)
    tok = expansion.tokenize(read_table(spark, d, "news").select(F.col("content").alias("text")).filter("text is not null"), "text", seeds)
    model = expansion.train_word2vec(tok)
    if model is None:
        return spark.createDataFrame([], "word string, source_seed string, similarity double, polarity string")
    return expansion.expand(model, seeds)


QUERIES = (
    news_normalize, news_sort, time_range_scan, time_bucket, epoch_times, html_clean, title_split, relevance_filter, dedup_exact, simhash, near_dup_links, dedup_near,
    removal_ratio, trigger_match, event_extract, event_summary, commodity_detect, batch_stats, daily_event_index, sentiment_score, daily_sentiment_index,
    review_sample_random, review_sample_by_type, review_edge_cases, review_prepare, review_metrics, review_type_breakdown, lexicon_merge, lexicon_final, lexicon_counts,
    candidate_filter, embedding_topk, template_vote, corpus_merge, corpus_stats, date_forward_fill, list_detail_join, w2v_expand,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict:
    return sql.oracles()
