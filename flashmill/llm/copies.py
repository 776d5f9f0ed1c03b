"""Grouping of copies: problems 6 (same up to form) and 7 (looks the same) as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flashmill.kernel import pieces, to_codes
from flashmill.llm.forms import digests, record_keys
from flashmill.llm.looks import looks
from flashmill.operators.prefilter import maybe_in
from flashmill.session import materialize

#: A group with more than a SPREAD-th of all rows is hot; there are at most SPREAD of them.
SPREAD = 2048


def _form_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, 2):
            keys = record_keys(part.column(1), part.column(2))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary())], ["_id", "_key"])


def form_copies(df: DataFrame, id_col: str, title: str, content: str) -> DataFrame:
    """first, copy (id values): each row that is a copy up to form of the row with the smallest id of its group.

    Nulls count as ''; rows without a letter or digit in either column are out;
    an empty table gives no rows. A group that holds a large part of all rows
    costs no more than others: the smallest id is found by partial aggregation,
    and hot keys (at most SPREAD, by count) are looked up in a broadcast.
    """
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("_id"), F.col(title).alias("_t"), F.col(content).alias("_c"))
    rows = materialize(src.mapInArrow(_form_batches, f"_id {kind}, _key binary").filter("_key is not null"), "forms")
    groups = materialize(rows.groupBy("_key").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "form-groups")
    return star(rows, groups)


def star(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """first, copy: rows joined with their group's smallest id, hot groups apart."""
    total = rows.count()
    bound = max(total // SPREAD, 1000)
    hot = groups.filter(F.col("_n") > bound)
    rows = maybe_in(rows, "_key", groups, "_key", groups.count())
    tag = rows.join(F.broadcast(hot.select(F.col("_key").alias("_k"), "_first")), F.col("_key") == F.col("_k"), "left")
    a = tag.filter("_k is not null").select("_first", "_id")
    b = tag.filter("_k is null").select("_key", "_id").join(groups.filter(F.col("_n") <= bound).select("_key", "_first"), "_key").select("_first", "_id")
    return a.unionByName(b).filter("_id <> _first").select(F.col("_first").alias("first"), F.col("_id").alias("copy"))


def form_groups(df: DataFrame, id_col: str, title: str, content: str) -> DataFrame:
    """first, copies: one row per record, with the number of rows it stands for."""
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("_id"), F.col(title).alias("_t"), F.col(content).alias("_c"))
    rows = src.mapInArrow(_form_batches, f"_id {kind}, _key binary").filter("_key is not null")
    return rows.groupBy("_key").agg(F.min("_id").alias("first"), F.count(F.lit(1)).alias("copies")).drop("_key")


def _look_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    h = xxhash.xxh3_128_digest
    for batch in batches:
        for part in pieces(batch, 2):
            t, c = pc.fill_null(part.column(1), ""), pc.fill_null(part.column(2), "")
            blank = pc.and_(pc.equal(pc.utf8_trim_whitespace(t), ""), pc.equal(pc.utf8_trim_whitespace(c), "")).to_pylist()
            look = [None if z else h(x.ljust(16, b"\0") + y) for x, y, z in zip(digests(*looks(t)), digests(*looks(c)), blank)]
            raw = [h(x.ljust(16, b"\0") + y) for x, y in zip(digests(*to_codes(t)), digests(*to_codes(c)))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(look, pa.binary()), pa.array(raw, pa.binary())], ["_id", "_look", "_raw"])


def look_pairs(df: DataFrame, id_col: str, title: str, content: str) -> DataFrame:
    """id_a < id_b of rows that look the same but aren't the same strings.

    The number of variants and rows of each look comes from a partial
    aggregation; only rows whose look has two variants at least are joined. The
    result is every pair, by definition; a look with many rows is split: side a
    is dealt out over salted blocks and side b copied to them.
    """
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("_id"), F.col(title).alias("_t"), F.col(content).alias("_c"))
    rows = materialize(src.mapInArrow(_look_batches, f"_id {kind}, _look binary, _raw binary").filter("_look is not null"), "looks")
    sizes = rows.groupBy("_look").agg(F.min("_raw").alias("_lo"), F.max("_raw").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    sizes = sizes.filter("_lo <> _hi").select("_look", F.ceil(F.col("_n") / 1000).cast("int").alias("_blocks"))
    sizes = materialize(sizes, "look-sizes")
    few = maybe_in(rows, "_look", sizes, "_look", sizes.count())
    some = materialize(few.join(sizes, "_look"), "look-variants")
    a = some.select("_look", F.col("_id").alias("_a"), F.col("_raw").alias("_ra"), F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int").alias("_s"))
    b = some.select("_look", F.col("_id").alias("_b"), F.col("_raw").alias("_rb"), F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_s"))
    j = a.join(b, ["_look", "_s"]).filter("_a < _b and _ra <> _rb")
    return j.select(F.col("_a").alias("id_a"), F.col("_b").alias("id_b"))


def normalise(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with the named string columns in canonical form; null stays null."""
    from flashmill.kernel import to_strings

    @F.arrow_udf("string")
    def canon(arr: pa.Array) -> pa.Array:
        out = to_strings(*looks(arr))
        return pc.if_else(pc.is_null(arr), pa.scalar(None, pa.string()), out)

    return df.withColumns({c: canon(F.col(c)) for c in columns})
