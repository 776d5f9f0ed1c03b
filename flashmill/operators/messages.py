"""Messages delivered more than once: one row of each is kept (problem 3).

Identifiers are dictionary-encoded exactly: the dictionary has one number per
distinct identifier within its shard (a hash of the identifier), and the
smallest order value it came with. What was seen is a set of bitmaps of 32,768
bits, one per shard and range of numbers. Of a batch, each unseen bit selects
its arrival with the smallest order value; all other arrivals are duplicates.
New numbers and the union of the new bits come into force by one exclusive
creation of a small file.

Rows whose identifier is null or blank can't be known again: they are kept and
take no part. Columns of the batch may have any names; the operator's own begin
with an underscore. Order values are unique by contract; rows that share one
count as one arrival. If a later batch brings a smaller order value, that row is
kept from then on and the one kept before becomes a duplicate.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flashmill.operators.prefilter import bit_is_set, maybe_in
from flashmill.session import Versions, delete_path, materialize

BITS = 32768
#: An identifier with more than a SPREAD-th of all rows is hot; there can be no more than SPREAD such identifiers.
SPREAD = 2048


def encode(rows: DataFrame, shards: int) -> DataFrame:
    """The distinct identifiers of rows (_key, _o): _key, _shard, _first (the smallest order value), _n (rows); _key is exact."""
    d = rows.groupBy("_key").agg(F.min("_o").alias("_first"), F.count(F.lit(1)).alias("_n"))
    return d.withColumn("_shard", F.pmod(F.xxhash64("_key"), F.lit(shards)).cast("int"))


def bitmaps(numbers: DataFrame) -> DataFrame:
    """_shard, _bucket, _bits: the bitmaps that hold the numbers (_shard, _id)."""
    return numbers.groupBy("_shard", F.expr("bitmap_bucket_number(_id)").alias("_bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_id))").alias("_bits"))


def duplicates(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """_shard, _id, dup (order value): each row that its message's kept arrival replaces.

    An identifier that holds a large part of all rows is spread: hot
    identifiers are at most SPREAD many, by count, and are looked up in a
    broadcast of that proven bound; the others go through a shuffle in which no
    key is hot.
    """
    keep = F.when(~F.col("_seen") | (F.col("_first") < F.col("_old")), F.col("_first"))
    many = codes.filter((F.col("_n") > 1) | F.col("_seen")).select("_key", "_shard", "_id", "_n", keep.alias("_keep"))
    total, n_many = codes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count_if((F.col("_n") > 1) | F.col("_seen"))).first()
    some = maybe_in(rows, "_key", many, "_key", n_many)
    bound = max(total // SPREAD, 1000)
    hot = many.filter(F.col("_n") > bound).select(F.col("_key").alias("_k"), "_shard", "_id", "_keep")
    tag = some.join(F.broadcast(hot), F.col("_key") == F.col("_k"), "left")
    of_hot = tag.filter(F.col("_k").isNotNull()).select("_shard", "_id", "_keep", "_o")
    rest = tag.filter(F.col("_k").isNull()).select("_key", "_o")
    of_rest = rest.join(many.filter(F.col("_n") <= bound).drop("_n"), "_key").select("_shard", "_id", "_keep", "_o")
    out = of_hot.unionByName(of_rest).filter(~F.col("_o").eqNullSafe(F.col("_keep"))).select("_shard", "_id", F.col("_o").alias("dup"))
    # what was kept so far and no longer is
    return out.unionByName(codes.filter(F.col("_seen") & (F.col("_first") < F.col("_old"))).select("_shard", "_id", F.col("_old").alias("dup")))


class SeenStore:
    """Dictionary and bitmaps in a folder that all executors share.

    A call of ``add`` writes tables beside those in force: the batch's new
    identifiers with their numbers (and those whose smallest order value fell),
    the bitmaps of the new numbers, how many numbers each shard uses, and the
    answer. The next version of the state names them; it is created exclusively
    after all else, so a run that dies at any step leaves the old state in
    force, and the same batch can be run again. A batch given with a token that
    is already in force gets its stored answer. Only the shards a batch touches
    are read. After MAX_PARTS tables, dictionary and bitmaps are rewritten as one.
    """

    MAX_PARTS = 8
    MAX_TOKENS = 100

    def __init__(self, spark: SparkSession, path: str, shards: int = 64):
        self.spark, self.path, self.shards = spark, path.rstrip("/"), shards
        self.versions = Versions(spark, self.path)

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{n}" for n in names])

    def _write(self, df: DataFrame, kind: str) -> str:
        name = f"{kind}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        return name

    def _by_shard(self, df: DataFrame) -> DataFrame:
        return df.repartition("_shard").sortWithinPartitions("_shard")

    def _touched(self, names: list[str], codes: DataFrame) -> DataFrame:
        """Those rows of the tables whose shard the codes touch; their files are sorted by shard, so that others are skipped."""
        shards = [r[0] for r in codes.select("_shard").distinct().limit(1001).collect()]
        stored = self._read(names)
        return stored.filter(F.col("_shard").isin(shards)) if len(shards) <= 1000 else stored

    def add(self, batch: DataFrame, key: Column, order: str, token: str | None = None) -> DataFrame:
        """_shard, _id, dup: the rows of the batch (order values) that earlier batches or other rows of it replace."""
        number, state = self.versions.latest()
        state = state or {"shards": self.shards, "dictionary": [], "bitmaps": [], "used": None, "answers": []}
        for t, name in state["answers"]:
            if token is not None and t == token:
                return self._read([name])
        rows = batch.select(key.alias("_key"), F.col(order).alias("_o")).filter(F.col("_key").isNotNull())
        codes = materialize(encode(rows, state["shards"]), "codes")
        if state["dictionary"]:
            stored = maybe_in(self._touched(state["dictionary"], codes), "_key", codes, "_key", codes.count())
            old = stored.groupBy("_key").agg(F.min("_id").alias("_id"), F.min("_first").alias("_old"))
            codes = codes.join(old, "_key", "left")
        else:
            codes = codes.withColumns({"_id": F.lit(None).cast("long"), "_old": F.lit(None).cast(codes.schema["_first"].dataType)})
        used = self._read([state["used"]]) if state["used"] else self.spark.createDataFrame([], "_shard int, _used long")
        in_shard = Window.partitionBy("_shard", F.col("_id").isNull()).orderBy("_key")
        codes = codes.withColumn("_r", F.row_number().over(in_shard).cast("long") - 1).join(F.broadcast(used), "_shard", "left")
        codes = codes.withColumn("_new", F.col("_id").isNull()).withColumn("_id", F.coalesce("_id", F.coalesce("_used", F.lit(0)) + F.col("_r")).cast("long"))
        codes = materialize(codes.drop("_r", "_used"), "numbered")
        if state["bitmaps"]:
            maps = self._touched(state["bitmaps"], codes).groupBy("_shard", "_bucket").agg(F.expr("bitmap_or_agg(_bits)").alias("_bits"))
            codes = codes.withColumn("_bucket", F.expr("bitmap_bucket_number(_id)")).join(maps, ["_shard", "_bucket"], "left")
            codes = materialize(codes.withColumn("_seen", bit_is_set(F.col("_bits"), F.expr("bitmap_bit_position(_id)"))).drop("_bits", "_bucket"), "seen")
        else:
            codes = codes.withColumn("_seen", F.lit(False))
        answer = self._write(duplicates(rows, codes), "answer")
        changed = codes.filter(~F.col("_seen") | (F.col("_first") < F.col("_old"))).select("_key", "_shard", "_id", "_first")
        state["dictionary"].append(self._write(self._by_shard(changed), "dictionary"))
        state["bitmaps"].append(self._write(self._by_shard(bitmaps(codes.filter(~F.col("_seen")).select("_shard", "_id"))), "bitmaps"))
        more = codes.filter("_new").groupBy("_shard").agg(F.count(F.lit(1)).alias("_used"))
        gone = [state["used"]] if state["used"] else []
        state["used"] = self._write(used.unionByName(more).groupBy("_shard").agg(F.sum("_used").alias("_used")).coalesce(1), "used")
        state["answers"] = [*state["answers"], [token, answer]][-self.MAX_TOKENS :]
        if len(state["dictionary"]) > self.MAX_PARTS:
            gone += state["dictionary"] + state["bitmaps"]
            state["bitmaps"] = [self._write(self._by_shard(self._read(state["bitmaps"]).groupBy("_shard", "_bucket").agg(F.expr("bitmap_or_agg(_bits)").alias("_bits"))), "bitmaps")]
            state["dictionary"] = [self._write(self._by_shard(self._numbers(state)), "dictionary")]
        self.versions.commit(number + 1, state)
        for g in gone:
            delete_path(self.spark, f"{self.path}/{g}")
        return self._read([answer])

    def _numbers(self, state: dict) -> DataFrame:
        return self._read(state["dictionary"]).groupBy("_key", "_shard", "_id").agg(F.min("_first").alias("_first"))

    def kept(self, dups: DataFrame) -> DataFrame:
        """kept, dup: the answers of calls with the order value that is kept for each message now."""
        first = self._read(self.versions.latest()[1]["dictionary"]).groupBy("_shard", "_id").agg(F.min("_first").alias("kept"))
        return dups.join(first, ["_shard", "_id"]).select("kept", "dup")
