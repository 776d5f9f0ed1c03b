"""Exact and near deduplication of timed news: SimHash blocks, time window, sequence similarity, greedy first-kept rule."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from flashmill.functions import text as T
from flashmill.kernel import to_codes
from flashmill.session import materialize

WINDOW_MINUTES, THRESHOLD, MIN_LENGTH, MAX_HAMMING = 120, 0.9, 16, 12


@lru_cache(1 << 18)
def _gram_hash(g: str) -> int:
    return int.from_bytes(hashlib.md5(g.encode()).digest()[:8], "big")


def simhash_batch(arr: pa.Array) -> np.ndarray:
    """64-bit SimHash over character 2-grams; '' and null give 0. Each distinct 2-gram of a batch is hashed once."""
    codes, off = to_codes(arr)
    n = len(arr)
    size = np.diff(off)
    pair = np.zeros(len(codes), np.int64)
    if len(codes):
        nxt = np.concatenate([codes[1:], [0]]).astype(np.int64)
        last = np.zeros(len(codes), bool)
        last[off[1:][size > 0] - 1] = True
        pair = codes.astype(np.int64) << 21 | np.where(last, 0, nxt)
        alone = np.zeros(len(codes), bool)
        alone[off[:-1][size == 1]] = True
        keep = ~last | alone
        row = np.repeat(np.arange(n), size)[keep]
        u, inv = np.unique(pair[keep], return_inverse=True)
        h = np.array([_gram_hash(chr(x >> 21) + (chr(x & 0x1FFFFF) if x & 0x1FFFFF else "")) for x in u.tolist()], np.uint64)
        out = np.zeros(n, np.uint64)
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        for b in range(64):
            sign = (((h >> np.uint64(b)) & np.uint64(1)).astype(np.int8) * 2 - 1)[inv]
            out[row[first]] |= (np.add.reduceat(sign, first, dtype=np.int32) > 0).astype(np.uint64) << np.uint64(b)
        return out.view(np.int64)
    return np.zeros(n, np.int64)


@F.arrow_udf(LongType())
def simhash(x: pa.Array) -> pa.Array:
    return pa.array(simhash_batch(x))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def text_similarity(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def is_similar(a: str, b: str, threshold: float = THRESHOLD) -> bool:
    """text_similarity(a, b) >= threshold; characters in common bound the ratio from above and are counted first."""
    if not a or not b or 2 * sum((Counter(a) & Counter(b)).values()) < threshold * (len(a) + len(b)):
        return False
    return SequenceMatcher(None, a, b).ratio() >= threshold


def is_near_duplicate(ta: str, tb: str, ha: int, hb: int, max_hamming: int = 10, threshold: float = THRESHOLD) -> bool:
    """Pairwise test of two normalised texts and their SimHashes."""
    return bin((ha ^ hb) & (1 << 64) - 1).count("1") <= max_hamming and min(len(ta), len(tb)) >= MIN_LENGTH and text_similarity(ta, tb) >= threshold


def exact_dedup(df: DataFrame, id_col: str = "seq") -> DataFrame:
    """One row per dedup key: the newest, ties and unreadable times by id. A window per key; copies beyond a key's first are dropped early by partial aggregation."""
    k = df.withColumn("_key", T.dedup_key(F.col("title"), F.col("content"), F.col("source"), F.col("publish_time")))
    order = F.struct((-F.coalesce(T.local_seconds(F.col("publish_time")), F.lit(-(1 << 60)))).alias("a"), F.col(id_col).alias("b"))
    return k.groupBy("_key").agg(F.min(order).alias("_m"), F.count(F.lit(1)).alias("copies")).select(F.col("_m.b").alias(id_col), "copies")


def nodes(df: DataFrame, id_col: str = "seq") -> DataFrame:
    """Rows that can differ in outcome: the first of each (key, time). Equal text at equal time shares its first row's fate."""
    k = df.select(
        F.col(id_col).alias("id"),
        T.dedup_key(F.col("title"), F.col("content"), F.col("source"), F.col("publish_time")).alias("key"),
        T.local_seconds(F.col("publish_time")).alias("sec"),
        T.combined_text(F.col("title"), F.col("content")).alias("text"),
    )
    return k.groupBy("key", "sec").agg(F.min_by("text", "id").alias("text"), F.min("id").alias("id")).withColumn("hash", simhash("text"))


def candidate_pairs(nd: DataFrame, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """cur, kept (ids; kept is processed first): same day (or both untimed), within the window, a segment in common, hamming in bounds.

    Equi-join on day, time bucket and segment; the later-processed side looks in
    its own and both neighbouring buckets, so the join never compares whole days.
    """
    base = nd.filter(F.length("text") >= MIN_LENGTH)
    day, bucket = F.floor(F.col("sec") / 86400), F.floor(F.pmod(F.col("sec"), F.lit(86400)) / (60 * minutes))
    base = base.select("id", "sec", "hash", F.length("text").alias("len"), F.coalesce(day, F.lit(-(1 << 40))).alias("day"), F.coalesce(bucket, F.lit(0)).alias("bucket"))
    seg = base.select(
        "*", F.posexplode(F.array(*[F.shiftrightunsigned("hash", 8 * i).bitwiseAND(F.lit(255)) for i in range(8)])).alias("seg_no", "seg")
    )
    a = seg.select(F.col("id").alias("cur"), F.col("sec").alias("sa"), F.col("hash").alias("ha"), F.col("len").alias("la"), "day", "seg_no", "seg", F.explode(F.sequence(F.col("bucket") - 1, F.col("bucket") + 1)).alias("bucket"))
    b = seg.select(F.col("id").alias("kept"), F.col("sec").alias("sb"), F.col("hash").alias("hb"), F.col("len").alias("lb"), "day", "seg_no", "seg", "bucket")
    j = a.join(b, ["day", "bucket", "seg_no", "seg"])
    earlier = (F.coalesce(F.col("sb"), F.lit(-(1 << 60))) > F.coalesce(F.col("sa"), F.lit(-(1 << 60)))) | (F.col("sa").eqNullSafe(F.col("sb")) & (F.col("kept") < F.col("cur")))
    near = F.coalesce(F.abs(F.col("sa") - F.col("sb")) <= minutes * 60, F.lit(True)) & (hamming(F.col("ha"), F.col("hb")) <= MAX_HAMMING)
    return j.filter(earlier & near).select("cur", "kept", "la", "lb").distinct()


def _trigrams(codes: np.ndarray) -> np.ndarray:
    """The 3-grams of a text as distinct numbers, repeats numbered apart; sorted."""
    g = np.sort((codes[:-2].astype(np.uint64) << np.uint64(42)) | (codes[1:-1].astype(np.uint64) << np.uint64(21)) | codes[2:])
    first = np.concatenate([[True], g[1:] != g[:-1]])
    nth = np.arange(len(g)) - np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
    return np.sort((g * np.uint64(0x9E3779B97F4A7C15)) ^ (nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def _ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        xs, ys = b.column(2).to_pylist(), b.column(3).to_pylist()
        grams: dict[str, np.ndarray] = {}
        for t in {*xs, *ys}:
            grams[t] = _trigrams(np.frombuffer(t.encode("utf-32-le"), np.uint32)) if len(t) > 2 else np.zeros(0, np.uint64)
        ok = []
        for x, y in zip(xs, ys):
            # M matched characters stand in at most la + lb - 2 M + 1 blocks, each of which costs two 3-grams
            both = len(x) + len(y)
            least = THRESHOLD / 2 * both - 2 * ((1 - THRESHOLD) * both + 1)
            p, q = grams[x], grams[y]
            at = np.minimum(np.searchsorted(q, p), max(len(q) - 1, 0))
            shared = int((q[at] == p).sum()) if len(q) else 0
            ok.append(shared >= least - 1e-6 and is_similar(x, y))
        yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))


def near_edges(nd: DataFrame) -> DataFrame:
    """cur, kept pairs whose texts are similar: exact bounds by length and 3-grams in common first, the sequence comparison for what is left."""
    c = candidate_pairs(nd).filter(2 * F.least("la", "lb") >= THRESHOLD * (F.col("la") + F.col("lb"))).select("cur", "kept")
    t = nd.select("id", "text")
    j = c.join(t.select(F.col("id").alias("cur"), F.col("text").alias("x")), "cur").join(t.select(F.col("id").alias("kept"), F.col("text").alias("y")), "kept")
    # the comparisons cost time, not bytes: an explicit number of partitions isn't merged by size
    j = j.repartition(int(nd.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cur", "kept")
    return j.select("cur", "kept", "x", "y").mapInArrow(_ratios, "cur long, kept long")


def deduplicate(df: DataFrame, id_col: str = "seq") -> DataFrame:
    """ids that are kept: newest first, a row goes if an earlier kept row has its key or is near.

    The kept set is the first maximal independent set in processing order. Each
    round keeps rows with no undecided earlier neighbour and drops those with a
    kept one; status tables are written, so a lost executor repeats one round.
    """
    nd = materialize(nodes(df, id_col), "nodes")
    edges = materialize(near_edges(nd), "edges")
    order = F.struct((-F.coalesce(F.col("sec"), F.lit(-(1 << 60)))).alias("a"), F.col("id").alias("b"))
    status = materialize(nd.select("id", "key", order.alias("ord"), F.lit(0).alias("st")), "status")
    while status.filter("st = 0").limit(1).count():
        by_key = status.groupBy("key").agg(F.max(F.when(F.col("st") == 1, 1).otherwise(0)).alias("k1"), F.min(F.when(F.col("st") == 0, F.col("ord"))).alias("k0"))
        near = edges.join(status.select(F.col("id").alias("kept"), F.col("st").alias("ks")), "kept").groupBy(F.col("cur").alias("id")).agg(F.max((F.col("ks") == 1).cast("int")).alias("n1"), F.max((F.col("ks") == 0).cast("int")).alias("n0"))
        j = status.join(by_key, "key").join(near, "id", "left")
        gone = (F.col("k1") == 1) | (F.coalesce("n1", F.lit(0)) == 1)
        free = (F.col("k0") == F.col("ord")) & (F.coalesce("n0", F.lit(0)) == 0)
        status = materialize(j.select("id", "key", "ord", F.when(F.col("st") != 0, F.col("st")).when(gone, 2).when(free, 1).otherwise(0).alias("st")), "status")
    return status.filter("st = 1").select(F.col("id").alias(id_col))


def first_of_each(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in an order; rows with a blank key stay."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
