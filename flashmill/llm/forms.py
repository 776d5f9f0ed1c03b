"""Copies hidden by formatting (problem 6): canonical values, integer identifiers, sorted integer tuples.

Each column is dictionary-encoded within a batch, so that each distinct value
is canonicalised once. The identifier of a canonical value is the 128-bit
integer of its hash: equal on every executor without a global dictionary, whose
building would shuffle all texts. A record is the sorted tuple of its (field,
value) identifiers; the fields of a content made up only of ``name: value``
pairs are sorted as single values. The compact tuples are what is grouped.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash

from flashmill.kernel import category_masks, expand_folds, fold_table, has, keep, lookup, owner, to_codes

_SEP = re.compile("[;；|\n\r]")


def form_codes(codes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits only, case folded (expand_folds() before it)."""
    codes, off = keep(codes, off, has(category_masks()["alnum"], codes))
    return lookup(fold_table(), codes), off


def forms(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return form_codes(*to_codes(expand_folds(arr)))


def field_list_rows(codes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which texts are made up only of ``name: value`` fields, two at least."""
    n = len(off) - 1
    if not len(codes):
        return np.zeros(n, bool)
    colon_at = np.flatnonzero((codes == 0x3A) | (codes == 0xFF1A))
    some = np.flatnonzero(np.bincount(np.searchsorted(off, colon_at, "right") - 1, minlength=n) >= 2)
    if len(some) < n // 2:  # the rest can't be lists
        out = np.zeros(n, bool)
        mask = np.zeros(n, bool)
        mask[some] = True
        if len(some):
            out[some] = field_list_rows(codes[np.repeat(mask, np.diff(off))], np.concatenate([[0], np.cumsum(np.diff(off)[some])]))
        return out
    row = owner(off)
    sep = (codes == 0x3B) | (codes == 0xFF1B) | (codes == 0x7C) | (codes == 0x0A) | (codes == 0x0D)
    first = np.zeros(len(codes), bool)
    first[off[:-1][off[:-1] < len(codes)]] = True
    piece = np.cumsum(sep | first)  # the separator opens the next piece
    word = ~sep & ~has(category_masks()["space"], codes)
    m = piece[-1] + 1
    full = np.zeros(m, bool)
    full[piece[word]] = True
    colon = np.zeros(m, bool)
    colon[piece[(codes == 0x3A) | (codes == 0xFF1A)]] = True
    of = np.zeros(m, np.int64)
    of[piece] = row
    good = np.bincount(of, full & colon, n)
    bad = np.bincount(of, full & ~colon, n)
    return (good >= 2) & (bad == 0)


def split_fields(text: str) -> list[str]:
    return [p for p in _SEP.split(text) if p.strip()]


def digests(codes: np.ndarray, off: np.ndarray) -> list[bytes]:
    """128-bit identifier of each text; b'' for an empty one."""
    mv = memoryview(np.ascontiguousarray(codes, np.uint32)).cast("B")
    o = (off * 4).tolist()
    h = xxhash.xxh3_128_digest
    return [h(mv[a:b]) if b > a else b"" for a, b in zip(o[:-1], o[1:])]


def content_ids(arr: pa.Array) -> list[bytes]:
    """Identifier of each content: of its form, or of the sorted identifiers of its fields; b'' without letter or digit."""
    arr = expand_folds(arr)
    codes, off = to_codes(arr)
    out = digests(*form_codes(codes, off))
    rows = np.flatnonzero(field_list_rows(codes, off))
    if len(rows):
        lists = [split_fields(x) for x in arr.take(pa.array(rows)).to_pylist()]
        ids = digests(*forms(pa.array([p for x in lists for p in x], pa.string())))
        at = 0
        for r, x in zip(rows.tolist(), lists):
            own = sorted(ids[at : at + len(x)])
            at += len(x)
            if any(own):
                out[r] = xxhash.xxh3_128_digest(b"F" + b"".join(own))
    return out


def encode_column(arr: pa.Array, ids) -> list[bytes]:
    """ids() of each value, each distinct value of the batch handled once."""
    d = arr.dictionary_encode()
    if len(d.dictionary) > 0.9 * len(arr):
        return ids(arr)
    own = ids(d.dictionary)
    return [b"" if i is None else own[i] for i in d.indices.to_pylist()]


def record_keys(title: pa.Array, content: pa.Array) -> list[bytes | None]:
    """The compact tuple of each record, null where neither value holds a letter or digit."""
    t = encode_column(title, lambda a: digests(*forms(a)))
    c = encode_column(content, content_ids)
    return [None if not x and not y else x.ljust(16, b"\0") + y.ljust(16, b"\0") for x, y in zip(t, c)]
