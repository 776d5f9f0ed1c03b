"""Vectorised text kernel: Arrow string columns as arrays of code points.

A batch of texts is one uint32 array of code points and an offset array; a
character mapping is one table lookup over the whole batch. Used inside
mapInArrow / Arrow UDFs where Spark's own string functions work per character
object.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Code points above this map to themselves in every table here (CJK extension G and later, private planes).
TABLE_SIZE = 0x30000
DELETE = 0xFFFFFFFF


def pieces(batch: pa.RecordBatch, column: int, limit: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batch whose texts in column hold about limit bytes at most; one row at least.

    Bounds the memory of a kernel call whatever the batch size setting and the
    lengths of the texts.
    """
    n = batch.num_rows
    if n == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(size) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), n]):
        yield batch.slice(a, b - a)


def to_codes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of a string array; null is ''."""
    arr = pc.fill_null(arr, "")
    n = len(arr)
    off = np.zeros(n + 1, np.int64)
    np.cumsum(pc.utf8_length(arr).to_numpy(zero_copy_only=False), out=off[1:])
    bufs = arr.buffers()
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    at = np.frombuffer(bufs[1], kind)[arr.offset : arr.offset + n + 1]
    data = memoryview(bufs[2])[int(at[0]) : int(at[-1])] if bufs[2] is not None else b""
    codes = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), np.uint32)
    return codes, off


def to_strings(codes: np.ndarray, off: np.ndarray) -> pa.Array:
    """The string array of (code points, offsets)."""
    text = codes.astype("<u4", copy=False).tobytes().decode("utf-32-le").encode("utf-8")
    width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    at = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(width, out=at[1:])
    return pa.Array.from_buffers(pa.string(), len(off) - 1, [None, pa.py_buffer(at[off].astype(np.int32)), pa.py_buffer(text)])


def lookup(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """table[codes], code points beyond the table as they are."""
    if len(codes) and codes.max() >= len(table):
        out = codes.copy()
        low = codes < len(table)
        out[low] = table[codes[low]]
        return out
    return table[codes]


def keep(codes: np.ndarray, off: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points under mask, with their new offsets."""
    at = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(mask, out=at[1:])
    return codes[mask], at[off]


def owner(off: np.ndarray) -> np.ndarray:
    """The row of each code point."""
    return np.repeat(np.arange(len(off) - 1), np.diff(off))


def _all_chars() -> Iterator[tuple[int, str]]:
    for c in range(TABLE_SIZE):
        if not 0xD800 <= c < 0xE000:
            yield c, chr(c)


@lru_cache(1)
def category_masks() -> dict[str, np.ndarray]:
    """Boolean tables: letter, number, alnum (Unicode L and N), space, digit (decimal)."""
    out = {k: np.zeros(TABLE_SIZE + 2, bool) for k in ("letter", "number", "space", "digit")}
    for c, ch in _all_chars():
        k = unicodedata.category(ch)
        out["letter"][c] = k[0] == "L"
        out["number"][c] = k[0] == "N"
        out["digit"][c] = k == "Nd"
        out["space"][c] = ch.isspace()
    out["letter"][TABLE_SIZE] = True  # the third plane: CJK extensions; what lies beyond are tags, selectors and private characters
    out["alnum"] = out["letter"] | out["number"]
    return out


def has(mask: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """mask of each code point; the two places after the table are for the third plane and for all beyond it."""
    if len(codes) and codes.max() >= TABLE_SIZE:
        codes = np.where(codes < TABLE_SIZE, codes, np.where(codes < 0x40000, TABLE_SIZE, TABLE_SIZE + 1))
    return mask[codes]


@lru_cache(1)
def long_folds() -> dict[str, str]:
    """Characters whose case folding is more than one character (such as the sharp s).

    Not ligatures and other compatibility forms: what they differ in from their
    letters is more than case.
    """
    return {ch: ch.casefold() for c, ch in _all_chars() if len(ch.casefold()) > 1 and not unicodedata.decomposition(ch).startswith("<")}


@lru_cache(1)
def fold_table() -> np.ndarray:
    """Case folding of characters that fold to one character."""
    out = np.arange(TABLE_SIZE, dtype=np.uint32)
    for c, ch in _all_chars():
        f = ch.casefold()
        if len(f) == 1:
            out[c] = ord(f)
    return out


def expand_folds(arr: pa.Array) -> pa.Array:
    """arr with the characters of long_folds() written out; only where a batch holds any."""
    codes, _ = to_codes(arr)
    flags = _long_fold_mask()
    hit = np.unique(codes[has(flags, codes)])
    for c in hit.tolist():
        arr = pc.replace_substring(arr, chr(c), long_folds()[chr(c)])
    return arr


@lru_cache(1)
def _long_fold_mask() -> np.ndarray:
    out = np.zeros(TABLE_SIZE + 2, bool)
    for ch in long_folds():
        out[ord(ch)] = True
    return out
