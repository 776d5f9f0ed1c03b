"""Lexicon expansion: seeds, candidates near them in a vector space, template votes, final lexicon, corpus assembly."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import RegexTokenizer, Word2Vec
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flashmill.functions.text import polarity_of
from flashmill.operators.lexicon import AMBIGUOUS, FIGURATIVE, RELEVANT, words_literal
from flashmill.operators.news_dedup import first_of_each

TOP_N, LEAST_SIMILAR = 20, 0.6
VOTE_RATIO, VOTE_CONFIDENCE = 0.6, 0.5
QUERY_BLOCK = 4096
#: Sentences a word is tried in.
TEMPLATES = {
    "positive": ["消息面传来{word}信号，黄金价格有望继续上涨。", "市场预期{word}，推动金价走高。", "{word}因素支撑黄金价格，投资者看好后市。", "受{word}影响，黄金价格大幅上涨。", "分析师指出，{word}将对黄金价格构成利多。"],
    "negative": ["消息面传来{word}信号，黄金价格承压下跌。", "市场预期{word}，金价走势承压。", "{word}因素压制黄金价格，投资者谨慎观望。", "受{word}影响，黄金价格大幅下跌。", "分析师指出，{word}将对黄金价格构成利空。"],
}


def is_relevant(text: Column) -> Column:
    """A clear word, or an ambiguous one in a text without any figurative use."""
    has = lambda ws: F.exists(words_literal(ws), lambda w: F.contains(text, w))
    return F.coalesce(has(RELEVANT) | (has(AMBIGUOUS) & ~has(FIGURATIVE)), F.lit(False))


def merge_seeds(words: DataFrame) -> DataFrame:
    """Distinct (word, polarity) with words of both polarities removed from both."""
    d = words.select(F.trim("word").alias("word"), polarity_of(F.col("polarity")).alias("polarity")).filter("word <> '' and polarity is not null").distinct()
    both = d.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return d.join(both, "word", "left_anti")


def filter_candidates(cand: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates (word, source_seed, similarity, polarity) not in existing and of one polarity, the best row of each word."""
    both = cand.groupBy("word").agg(F.countDistinct("polarity").alias("n")).filter("n > 1")
    c = cand.join(both, "word", "left_anti").join(existing.select("word"), "word", "left_anti")
    return first_of_each(c, ["word"], [F.col("similarity").desc(), F.col("source_seed")])


def final_lexicon(seeds: DataFrame, expanded: DataFrame) -> DataFrame:
    """Seeds and expanded words (word, polarity, source, similarity, confidence), one row per word, seeds first; sorted by polarity and similarity."""
    u = seeds.withColumn("_rank", F.lit(0)).unionByName(expanded.withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    u = first_of_each(u, ["word"], [F.col("_rank"), F.col("polarity").desc(), F.col("similarity").desc_nulls_last(), F.col("confidence").desc_nulls_last()])
    return u.drop("_rank").orderBy("polarity", F.col("similarity").desc_nulls_first(), "word")


def _score_batches(ids: np.ndarray, q: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vid = b.column(0).to_numpy(zero_copy_only=False)
            v = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vid), -1)
            norm = np.linalg.norm(v, axis=1)
            sim = np.round((q @ v.T) / np.maximum(norm, 1e-300), 4)
            sim[ids[:, None] == vid[None, :]] = -2
            top = np.lexsort((np.broadcast_to(vid, sim.shape), -sim), axis=1)[:, :k]
            s = np.take_along_axis(sim, top, 1)
            ok = s > -2
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, top.shape[1])[ok.ravel()]), pa.array(vid[top].ravel()[ok.ravel()]), pa.array(s.ravel()[ok.ravel()])], ["query_id", "vec_id", "similarity"])

    return run


def nearest(vectors: DataFrame, id_col: str, vec_col: str, queries: DataFrame, k: int = TOP_N, least: float = LEAST_SIMILAR) -> DataFrame:
    """query_id, vec_id, similarity (cosine, 4 digits), rank: the k nearest other vectors of each query with similarity least.

    The queries go over all vectors in blocks of QUERY_BLOCK: each batch of
    vectors keeps its k best per query, the k best of these are the result.
    Null vectors are out; ties go to the smaller id; no query gives no rows.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("_i"), F.col(vec_col).alias("_v")).filter("_v is not null")
    qs = queries.select(F.col(id_col).cast("long").alias("_i"), F.col(vec_col).alias("_v")).filter("_v is not null")
    n = qs.count()
    out = src.sparkSession.createDataFrame([], "query_id long, vec_id long, similarity double")
    for b in range(-(-n // QUERY_BLOCK)):
        t = qs.filter(F.pmod(F.xxhash64("_i"), F.lit(-(-n // QUERY_BLOCK))) == b).toArrow()
        ids = t.column(0).to_numpy()
        if not len(ids):
            continue
        q = np.array(t.column(1).to_pylist(), np.float64).reshape(len(ids), -1)
        q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
        one = src.mapInArrow(_score_batches(ids, q, k), "query_id long, vec_id long, similarity double")
        out = out.unionByName(one)
    w = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(w)).filter((F.col("rank") <= k) & (F.col("similarity") >= least))


def _any_of(words: list[str]) -> str:
    """Pattern of the longest of words at a place: their common beginnings are written once."""
    end, by = "" in words, {}
    for w in sorted(set(words) - {""}):
        by.setdefault(w[0], []).append(w[1:])
    if not by:
        return ""
    one = "|".join(c + _any_of(rest) for c, rest in by.items())
    return f"(?:{one}){'?' if end else ''}"


def tokenize(df: DataFrame, text: str, words: DataFrame | None = None) -> DataFrame:
    """df with ``tokens``: words of Latin script, pairs of neighbouring ideographs; texts of 5 characters and 2 tokens at least.

    words (word): those of two ideographs at least stay whole, the longest at a
    place from the left; pairs are made of what stands between them.
    """
    d = RegexTokenizer(inputCol="_clean", outputCol="_words", pattern=r"[^\p{L}\p{N}]+", toLowercase=True).transform(df.filter(F.length(text) >= 5).withColumn("_clean", F.regexp_replace(text, r"(\p{IsHan})", " $1 ")))
    # a whole word begins with a mark that is no ideograph
    whole = [] if words is None else [r[0] for r in words.filter(F.col("word").rlike(r"^\p{IsHan}{2,}$")).select("word").distinct().collect()]
    marked = F.regexp_replace(F.translate(text, "\x01", "\x02"), f"({_any_of(whole)})", "\x01$1\x02") if whole else F.translate(text, "\x01", "\x02")
    han = F.regexp_extract_all(marked, F.lit(r"(\x01?\p{IsHan}+)"), 1)
    pairs = F.flatten(F.transform(han, lambda r: F.when(r.startswith("\x01"), F.array(F.substring(r, 2, 1 << 30))).when(F.length(r) > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))), lambda i: F.substring(r, i, F.lit(2)))).otherwise(F.array(r))))
    latin = F.filter("_words", lambda w: ~w.rlike(r"\p{IsHan}"))
    return d.withColumn("tokens", F.concat(latin, pairs)).filter(F.size("tokens") >= 2).drop("_clean", "_words")


def train_word2vec(tokens: DataFrame, size: int = 100, window: int = 5, min_count: int = 3, rounds: int = 10, seed: int = 42):
    """Skip-gram model over ``tokens``; none for fewer than 50 documents."""
    if tokens.limit(50).count() < 50:
        return None
    return Word2Vec(vectorSize=size, windowSize=window, minCount=min_count, maxIter=rounds, seed=seed, numPartitions=1, inputCol="tokens", outputCol="_v").fit(tokens)


def expand(model, seeds: DataFrame, k: int = TOP_N, least: float = LEAST_SIMILAR) -> DataFrame:
    """word, source_seed, similarity, polarity: the words nearest to each seed in the vocabulary."""
    v = model.getVectors().select("word", F.xxhash64("word").alias("vid"), F.col("vector").cast("string").alias("_s"))
    vec = v.select("word", "vid", F.transform(F.split(F.regexp_replace("_s", r"[\[\]]", ""), ","), lambda x: x.cast("double")).alias("vec"))
    q = vec.join(seeds.select("word", "polarity"), "word")
    near = nearest(vec, "vid", "vec", q, k, least)
    a = near.join(q.select(F.col("vid").alias("query_id"), F.col("word").alias("source_seed"), "polarity"), "query_id")
    return a.join(vec.select(F.col("vid").alias("vec_id"), "word"), "vec_id").select("word", "source_seed", F.round("similarity", 4).alias("similarity"), "polarity")


def votes(words: DataFrame, predict: Callable[[Column], Column]) -> DataFrame:
    """word, polarity, valid, predicted, confidence, ratio: the label most templates give a word (ties: the first seen).

    predict: Column of sentences to struct(label, confidence); a pandas UDF of a
    classifier, or an expression.
    """
    t = F.when(F.col("polarity") == "positive", F.array(*map(F.lit, TEMPLATES["positive"]))).otherwise(F.array(*map(F.lit, TEMPLATES["negative"])))
    s = words.select("word", "polarity", F.posexplode(t).alias("no", "template")).withColumn("p", predict(F.replace(F.col("template"), F.lit("{word}"), F.col("word"))))
    by = s.groupBy("word", "polarity", F.col("p.label").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.min("no").alias("first"), F.avg("p.confidence").alias("conf"))
    best = by.groupBy("word", "polarity").agg(F.max_by(F.struct("label", "n", "conf"), F.struct(F.col("n"), -F.col("first"))).alias("b"), F.sum("n").alias("total"))
    ratio = F.col("b.n").cast("double") / F.col("total")
    return best.select(
        "word",
        "polarity",
        ((F.col("b.label") == F.col("polarity")) & (ratio >= VOTE_RATIO) & (F.col("b.conf") >= VOTE_CONFIDENCE)).alias("valid"),
        F.col("b.label").alias("predicted"),
        F.round("b.conf", 4).alias("confidence"),
        F.round(ratio, 4).alias("vote_ratio"),
    )


def corpus(texts: DataFrame, text: str, least: int = 10) -> DataFrame:
    """Distinct trimmed texts longer than ``least`` characters, with their length, sorted by code point."""
    t = texts.select(F.trim(text).alias("text")).filter(F.length("text") > least).distinct()
    return t.select("text", F.length("text").alias("len")).orderBy("text")
