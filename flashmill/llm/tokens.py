"""Byte-level BPE encoding of a corpus (problem 8).

Texts are cut into pre-tokens by character classes on a whole batch of code
points (the rules of the public pattern), and further at places that no
vocabulary token can span, so that no merge crosses them. Distinct pieces of a
batch are then encoded once, in two tiers: a minimal perfect hash over the
vocabulary resolves pieces that are tokens; for the others a heap of candidate
merges runs over the linked list of their bytes.

Null and empty texts give an empty list; any other text is encoded as it is,
strings of special tokens included as ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flashmill.kernel import TABLE_SIZE, category_masks, pieces, to_codes

VOCABULARY = os.environ.get("FLASHMILL_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
#: Distinct pieces a worker remembers.
MEMO = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id of a file of lines ``base64 id``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PerfectHash:
    """Minimal perfect hash of a fixed set of byte strings by hash and displace; ``get`` gives a key's value or -1."""

    def __init__(self, items: dict[bytes, int]):
        keys = list(items)
        n = self.n = max(len(keys), 1)
        m = self.m = n // 4 + 1
        h = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        order = np.argsort(h % np.uint64(m), kind="stable")
        bucket = (h % np.uint64(m))[order].astype(np.int64)
        cuts = np.searchsorted(bucket, np.arange(m + 1)).tolist()
        taken = bytearray(n)
        self.shift = [0] * m
        self.slot_key: list[bytes] = [b""] * n
        self.slot_val = [-1] * n
        hs = h.tolist()
        free = 0
        for b in sorted(range(m), key=lambda b: cuts[b] - cuts[b + 1]):
            own = order[cuts[b] : cuts[b + 1]].tolist()
            if not own:
                break
            if len(own) == 1:
                while taken[free]:
                    free += 1
                self.shift[b], slots = -1 - free, [free]
            else:
                d = 1
                while True:
                    slots = [self._slot(hs[i], d) for i in own]
                    if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                        break
                    d += 1
                self.shift[b] = d
            for i, s in zip(own, slots):
                taken[s] = 1
                self.slot_key[s], self.slot_val[s] = keys[i], items[keys[i]]

    def _slot(self, h: int, d: int) -> int:
        x = (h ^ (d * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
        return ((x * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF) >> 20) % self.n

    def get(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.m]
        s = -1 - d if d < 0 else self._slot(h, d)
        return self.slot_val[s] if self.slot_key[s] == key else -1


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the mergeable pair of lowest rank, leftmost first, until none is left."""
    n = len(word)
    start, nxt, prv = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1))
    stop = list(range(1, n + 1))
    alive = [True] * n
    heap = []
    for i in range(n - 1):
        r = ranks.get(word[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        r, i, end = heapq.heappop(heap)
        if not alive[i]:
            continue
        j = nxt[i]
        if j >= n or stop[j] != end or stop[i] != start[j]:
            continue
        if ranks.get(word[i:end]) != r:
            continue
        stop[i] = end
        alive[j] = False
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        p, q = prv[i], nxt[i]
        if q < n and (r := ranks.get(word[i : stop[q]])) is not None:
            heapq.heappush(heap, (r, i, stop[q]))
        if p >= 0 and (r := ranks.get(word[p:end])) is not None:
            heapq.heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : stop[i]]])
        i = nxt[i]
    return out


class Encoder:
    """Two-tier encoder of one vocabulary; kept per worker process."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.hash = PerfectHash(self.ranks)
        self.memo: dict[bytes, list[int]] = {}
        self.crossing: dict[tuple[int, int], set[tuple[bytes, bytes]]] = {}
        for t in self.ranks:
            for p in range(1, len(t)):
                if t[p - 1] >= 0x80 and t[p] >= 0xC0:
                    self.crossing.setdefault((t[p - 1], t[p]), set()).add((t[max(0, p - 4) : p], t[p : p + 4]))
        self.pairs = np.zeros(0, np.uint64)
        self.safe = np.zeros(0, bool)

    def piece(self, b: bytes) -> list[int]:
        got = self.memo.get(b)
        if got is None:
            i = self.hash.get(b)
            # a token that merging doesn't reach must not answer for the whole piece; looked at once per token
            got = [i] if i >= 0 and self.reached(b, i) else merge(b, self.ranks)
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[b] = got
        return got

    def reached(self, b: bytes, i: int) -> bool:
        return len(b) == 1 or merge(b, self.ranks) == [i]

    def uncrossed(self, a: str, b: str) -> bool:
        """Whether no token can span the boundary between two neighbouring characters."""
        x, y = a.encode("utf-8", "surrogatepass"), b.encode("utf-8", "surrogatepass")
        for left, right in self.crossing.get((x[-1], y[0]), ()):
            if (x.endswith(left) if len(left) <= len(x) else left.endswith(x)) and (y.startswith(right) if len(right) <= len(y) else right.startswith(y)):
                return False
        return True

    def cuts(self, codes: np.ndarray) -> np.ndarray:
        """Mask of places between two non-ASCII characters (at the second) that no token can span."""
        out = np.zeros(len(codes), bool)
        at = np.flatnonzero((codes[:-1] >= 0x80) & (codes[1:] >= 0x80)) if len(codes) else np.zeros(0, np.int64)
        if not len(at):
            return out
        pair = (codes[at].astype(np.uint64) << np.uint64(21)) | codes[at + 1]
        k = np.searchsorted(self.pairs, pair)
        new = (k >= len(self.pairs)) | (self.pairs[np.minimum(k, max(len(self.pairs) - 1, 0))] != pair) if len(self.pairs) else np.ones(len(pair), bool)
        if new.any():
            fresh = np.unique(pair[new])
            if len(self.pairs) > MEMO:
                self.pairs, self.safe = np.zeros(0, np.uint64), np.zeros(0, bool)
                fresh = np.unique(pair)
            ok = np.array([self.uncrossed(chr(p >> 21), chr(p & 0x1FFFFF)) for p in fresh.tolist()], bool)
            both = np.concatenate([self.pairs, fresh])
            order = np.argsort(both, kind="stable")
            self.pairs, self.safe = both[order], np.concatenate([self.safe, ok])[order]
            k = np.searchsorted(self.pairs, pair)
        out[at + 1] = self.safe[k]
        return out

    def encode(self, arr: pa.Array) -> pa.ListArray:
        codes, off = to_codes(arr)
        n = len(arr)
        if not len(codes):
            return pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.int32()))
        start = pretoken_starts(codes, off) | self.cuts(codes)
        first = np.flatnonzero(start)
        width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        byte = np.concatenate([[0], np.cumsum(width)])
        data = codes.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
        bounds = np.concatenate([byte[first], byte[-1:]]).astype(np.int32)
        toks = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        ids = [self.piece(b) for b in toks.dictionary.to_pylist()]
        size = np.array([len(x) for x in ids], np.int64)
        flat = np.array([i for x in ids for i in x], np.int32)
        base = np.cumsum(size) - size
        which = toks.indices.to_numpy()
        lens = size[which]
        total = np.concatenate([[0], np.cumsum(lens)])
        out = flat[np.repeat(base[which] - total[:-1], lens) + np.arange(total[-1])]
        at = total[np.searchsorted(first, off)]
        return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(out, pa.int32()))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


#: Letters and numbers of Unicode 16, which the public pattern's tables know and Python 3.13's don't.
LATER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389),
    (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
LATER_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
#: Letters of the third plane; all others beyond the kernel's tables are neither letter, number nor space.
THIRD_PLANE = ((0x30000, 0x3134A), (0x31350, 0x323AF))


@lru_cache(1)
def _classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 white space (property White_Space); the last place is for all beyond the table."""
    m = category_masks()
    out = np.zeros(THIRD_PLANE[-1][1] + 2, np.int8)
    for k, v in (("letter", 1), ("number", 2), ("space", 3)):
        out[:TABLE_SIZE][m[k][:TABLE_SIZE]] = v
    out[0x1C:0x20] = 0  # separators that only str.isspace() counts
    for v, ranges in ((1, LATER_LETTERS + THIRD_PLANE), (2, LATER_NUMBERS)):
        for a, b in ranges:
            out[a : b + 1] = v
    return out


def pretoken_starts(codes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Mask of the first characters of pre-tokens.

    The pattern: contractions of an apostrophe; runs of letters, of numbers and
    of other characters, each with one space before it; white space up to the
    last before a word, or to the end.
    """
    n = len(codes)
    table = _classes()
    cls = table[np.minimum(codes, len(table) - 1)]
    text0 = np.zeros(n + 1, bool)
    text0[off] = True
    text0 = text0[:n]
    last = np.zeros(n + 1, bool)
    last[off] = True
    last = last[1:]
    new = text0.copy()
    new[1:] |= cls[1:] != cls[:-1]
    start = new.copy()
    space = cls == 3
    # the last white space before a word stands alone, or with the word if it is a plain blank
    tail = space & ~last
    tail[:-1] &= cls[1:] != 3
    start |= tail
    joins = tail & (codes == 0x20)
    start[1:] &= ~joins[:-1]
    # contractions: an apostrophe that starts a match, then s t m d ll re ve
    ap = np.flatnonzero((codes == 0x27) & start)
    ap = ap[ap + 1 < n]
    ap = ap[(cls[ap + 1] == 1) & ~text0[ap + 1]]
    if len(ap):
        a = codes[ap + 1]
        b = np.where((ap + 2 < n) & ~text0[np.minimum(ap + 2, n - 1)], codes[np.minimum(ap + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("l")) & (b == ord("l"))) | ((b == ord("e")) & ((a == ord("r")) | (a == ord("v"))))
        ln = np.where(one, 1, np.where(two, 2, 0))
        ap, ln = ap[ln > 0], ln[ln > 0]
        start[ap + 1] = False
        end = ap + 1 + ln
        end = end[end < n]
        start[end] |= (cls[end] == 1)
    return start


def _batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for part in pieces(batch, 1, 2 << 20):
                yield pa.RecordBatch.from_arrays([part.column(0), e.encode(part.column(1))], ["_id", "ids"])

    return run


def encode_corpus(df: DataFrame, id_col: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """id and ids (array<int>) of each row; a narrow map without a shuffle. vocabulary: a path every executor can read."""
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_t"))
    return src.mapInArrow(_batches(vocabulary), f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_col)
