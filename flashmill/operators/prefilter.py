"""Semi-join prefilter by bitmaps of a bounded size.

Before a large table is shuffled for a join with few keys, rows whose key
certainly isn't among them are dropped where they are read. The keys' hashes
set bits of at most MAX_BITS; the bitmaps are broadcast, their size (MAX_BITS /
8 bytes) doesn't depend on the data. Some rows pass wrongly, none is dropped
wrongly, so the join after it decides as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS = 1 << 18, 1 << 27
BITS_PER_KEY = 12


def bit_is_set(bitmap: Column, position: Column) -> Column:
    """Whether a bit of a bitmap of bitmap_construct_agg is set; false for a null bitmap."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("getbit", byte, (position % 8).cast("int")) == 1, F.lit(False))


def maybe_in(rows: DataFrame, column: str, keys: DataFrame, key: str, n_keys: int) -> DataFrame:
    """rows whose column may be among keys; rows with null are dropped. n_keys: about how many keys there are."""
    bits = MIN_BITS
    while bits < min(MAX_BITS, n_keys * BITS_PER_KEY):
        bits *= 2
    place = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit(11)), F.lit(bits))
    maps = keys.select(place(key).alias("_h")).groupBy(F.expr("bitmap_bucket_number(_h)").alias("_bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_h))").alias("_bits"))
    names = rows.columns
    j = rows.filter(F.col(column).isNotNull()).withColumn("_h", place(column))
    j = j.withColumn("_bucket", F.expr("bitmap_bucket_number(_h)")).join(F.broadcast(maps), "_bucket")
    return j.filter(bit_is_set(F.col("_bits"), F.expr("bitmap_bit_position(_h)"))).select(*names)
