"""Lines repeated across one source's documents (problem 4).

Each line becomes an integer identifier (a 64-bit hash of the line without
case, whitespace and digits). The documents of a source are dealt out over
shards of bounded size; each shard concatenates its documents' line identifiers
with unique separators, builds their suffix array and the lengths of common
prefixes, and reports the longest blocks that span many of its documents. A line in a
tenth of a source's documents is in a tenth of those of at least one shard, so
the shards' reports hold every case; exact counts over all shards decide.

A null or blank source takes no part; null and empty contents count as rows of
their source without lines; a line repeated within one document counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flashmill.kernel import category_masks, expand_folds, fold_table, has, keep, lookup, pieces, to_codes
from flashmill.session import materialize

#: Documents of one source in one shard: bounds a task's memory however large the source is.
SHARD_ROWS = 20_000
MIN_ROWS = 5
MIN_SHARE = 0.1


def line_ids(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(identifiers, offsets): one identifier per line of each text, 0 for lines with nothing that counts; null has none."""
    codes, off = to_codes(expand_folds(arr))
    masks = category_masks()
    newline = codes == 10
    mask = newline | ~(has(masks["space"], codes) | has(masks["digit"], codes))
    codes, off = keep(lookup(fold_table(), codes), off, mask)
    newline = codes == 10
    cum = np.concatenate([[0], np.cumsum(newline)])
    filled = np.diff(off) > 0
    had = np.asarray(arr.is_valid())
    count = np.where(filled, cum[off[1:]] - cum[off[:-1]] + 1, had.astype(np.int64))
    out_off = np.concatenate([[0], np.cumsum(count)])
    ids = np.zeros(out_off[-1], np.int64)
    ends = np.flatnonzero(newline)
    # the lines' bounds: texts' starts and the places after newlines, texts' ends and newlines
    rows = np.flatnonzero(filled)
    starts = np.sort(np.concatenate([off[:-1][rows], ends + 1]))
    stops = np.sort(np.concatenate([off[1:][rows], ends]))
    slot = np.concatenate([np.arange(out_off[r], out_off[r + 1]) for r in rows]) if len(rows) else np.zeros(0, np.int64)
    mv = memoryview(np.ascontiguousarray(codes)).cast("B")
    h = xxhash.xxh3_64_intdigest
    got = [h(mv[a:b]) if b > a else 0 for a, b in zip((starts * 4).tolist(), (stops * 4).tolist())]
    ids[slot] = np.array(got, np.uint64).view(np.int64)
    return ids, out_off


def _id_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, 2):
            ids, off = line_ids(part.column(2))
            lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], ["_id", "_source", "_lines"])


def suffix_array(ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, document of each place, suffix array, LCP) over documents joined by unique separators.

    text holds ranks: separators first, all different, then lines. Prefix
    doubling by sorting; the ranks of each round give the common prefixes.
    """
    n_docs = len(off) - 1
    ln = np.diff(off)
    n = len(ids) + n_docs
    doc = np.repeat(np.arange(n_docs), ln + 1)
    is_sep = np.zeros(n, bool)
    is_sep[np.cumsum(ln + 1) - 1] = True
    _, rank = np.unique(ids, return_inverse=True)
    text = np.empty(n, np.int64)
    text[is_sep] = np.arange(n_docs)
    text[~is_sep] = rank + n_docs
    ranks, k, top = [text], 1, int(ln.max(initial=0))
    while k <= top:
        r = ranks[-1]
        nxt = np.full(n, -1)
        nxt[:-k] = r[k:]
        _, new = np.unique(r * (n + 1) + nxt + 1, return_inverse=True)
        ranks.append(new)
        if new.max() == n - 1:
            break
        k *= 2
    sa = np.argsort(ranks[-1], kind="stable")
    lcp = np.zeros(n, np.int64)
    a, b, done = sa[:-1].copy(), sa[1:].copy(), np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        r = ranks[level]
        inb = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[inb] = r[a[inb]] == r[b[inb]]
        step = 1 << max(level, 0)
        done += same * step
        a, b = a + same * step, b + same * step
    lcp[1:] = done
    return text, doc, sa, lcp


def repeated_blocks(ids: np.ndarray, off: np.ndarray, least: int) -> list[tuple[list[int], int]]:
    """(identifiers of its lines, documents) of each block of lines that spans least documents.

    Suffixes with a common prefix of some lines stand together in the suffix
    array; for each suffix the longest such prefix that enough documents hold is
    a block. Separators and lines with nothing in them end a block.
    """
    if not len(ids):
        return []
    text, doc, sa, lcp = suffix_array(ids, off)
    n_docs = len(off) - 1
    flat = np.full(len(text), 0)
    flat[text >= n_docs] = ids
    longest, many = np.zeros(len(sa), np.int64), np.zeros(len(sa), np.int64)
    live = np.ones(len(sa), bool)
    length = 1
    while True:
        last = sa + length - 1  # the block's last line must be one
        live &= (last < len(text)) & (flat[np.minimum(last, len(text) - 1)] != 0)
        group = np.cumsum(np.concatenate([[True], lcp[1:] < length])) - 1
        pair = np.unique(group[live] * n_docs + doc[sa][live])
        docs = np.bincount(pair // n_docs, minlength=group[-1] + 1)
        live &= (docs >= least)[group]
        if not live.any():
            break
        longest[live], many[live] = length, docs[group[live]]
        length += 1
    out: dict[tuple[int, ...], int] = {}
    group = np.cumsum(np.concatenate([[True], (lcp[1:] < longest[1:]) | (longest[1:] != longest[:-1])])) - 1
    head = np.unique(group, return_index=True)[1]
    for i in head[longest[head] > 0].tolist():
        out[tuple(flat[sa[i] : sa[i] + longest[i]].tolist())] = int(many[i])
    return [(list(k), v) for k, v in out.items()]


def _shard(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lists = pa.chunked_array([b.column("_lines") for b in batches]).combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    off = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    least = max(1, int(np.ceil(MIN_SHARE * (len(off) - 1) - 1e-9)))
    found = repeated_blocks(ids, off, least)
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()] * len(found), pa.string()), pa.array([k for k, _ in found], pa.list_(pa.int64())), pa.array([v for _, v in found], pa.int64())], ["_source", "_block", "_docs"]
    )


def line_table(df: DataFrame, id_col: str, source: str, text: str) -> DataFrame:
    """Written table of _id, _source, _lines for all rows with a nonblank source."""
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("_id"), F.col(source).alias("_source"), F.col(text).alias("_text")).filter(F.trim("_source") != "")
    return materialize(src.mapInArrow(_id_batches, f"_id {kind}, _source string, _lines array<long>"), "lines")


def block_candidates(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks: _source, _block, _docs; rows per source): what the shards report."""
    sizes = materialize(lines.groupBy("_source").agg(F.count(F.lit(1)).alias("_rows")), "source-rows")
    shards = F.ceil(F.col("_rows") / SHARD_ROWS).cast("int")
    dealt = lines.join(sizes.select("_source", shards.alias("_shards")), "_source").select("_source", F.pmod(F.xxhash64("_id"), F.col("_shards")).alias("_shard"), "_lines")
    blocks = dealt.groupBy("_source", "_shard").applyInArrow(_shard, "_source string, _block array<long>, _docs long")
    return materialize(blocks, "blocks"), sizes


def repeated_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(occurrences: _id, _source, _no, _line; repeated: _source, _line, _docs): the lines of the shards' blocks, with exact counts over all rows."""
    blocks, sizes = block_candidates(lines)
    # at most ten lines of a document's length for each shard: each stands in a tenth of the shard's documents
    cand = blocks.select("_source", F.explode("_block").alias("_line")).groupBy("_source").agg(F.collect_set("_line").alias("_cand"))
    cand = materialize(cand, "candidates")
    at = F.transform("_lines", lambda x, i: F.struct((i + 1).cast("long").alias("no"), x.alias("line"), (F.array_position("_lines", x) == i + 1).alias("first")))
    hits = lines.join(cand, "_source").filter(F.arrays_overlap("_lines", "_cand")).select("_id", "_source", F.explode(F.filter(at, lambda x: F.array_contains("_cand", x["line"]))).alias("_x"))
    hits = materialize(hits.select("_id", "_source", F.col("_x.no").alias("_no"), F.col("_x.line").alias("_line"), F.col("_x.first").alias("_first")), "hits")
    counts = hits.groupBy("_source", "_line").agg(F.count_if("_first").alias("_docs")).join(sizes, "_source")
    good = materialize(counts.filter((F.col("_docs") >= MIN_ROWS) & (F.col("_docs") >= MIN_SHARE * F.col("_rows"))).select("_source", "_line", "_docs"), "repeated")
    return hits.join(good, ["_source", "_line"], "left_semi").select("_id", "_source", "_no", "_line"), good


def strip_repeated(df: DataFrame, id_col: str, source: str, text: str) -> DataFrame:
    """df with ``text`` free of its source's repeated lines; other columns and rows unchanged."""
    lines = line_table(df, id_col, source, text)
    _, good = repeated_lines(lines)
    drop = good.groupBy("_source").agg(F.collect_set("_line").alias("_drop"))

    @F.arrow_udf("string")
    def strip(t: pa.Array, bad: pa.Array) -> pa.Array:
        ids, off = line_ids(t)
        out = []
        for i, (x, b) in enumerate(zip(t.to_pylist(), bad.to_pylist())):
            if x and b:
                b = set(b)
                x = "\n".join(s for s, k in zip(x.split("\n"), ids[off[i] : off[i + 1]].tolist()) if k not in b)
            out.append(x)
        return pa.array(out, pa.string())

    names = df.columns
    drop = materialize(drop, "drop")
    j = df.withColumn("_src", F.col(source)).join(drop.withColumnRenamed("_source", "_src"), "_src", "left")
    return j.withColumn(text, strip(F.col(text), F.col("_drop"))).select(*names)
