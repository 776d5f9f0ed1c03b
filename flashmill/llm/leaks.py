"""Evaluation passages in a corpus (problem 9).

Corpus texts and passages are compared as letters and digits in canonical form.
The passages' suffixes are put into order once; the common prefixes of
neighbours give for each suffix the shortest start (of LENGTHS) that no more
than COMMON passages share. A shard (a batch of texts, concatenated) gets a
sparse suffix array: its suffixes that have the start of some passage suffix,
in lexicographic order. Every passage suffix that has such a start is searched
in it by binary search; the verbatim matches found, with their places, are put
together to runs, and the runs of a document and passage are chained in the
order of both, with as much drift as their distance allows. Along a chain that
has enough of them the stretch is compared: the part of the passage's best half
that stands there verbatim (in runs of VERIFY characters or more), or the words
(in ideographs and kana the characters) that aren't as in the passage.

Passages without letters or digits, and null, empty and blank texts, give no
rows; a document that repeats a passage, or a passage given twice, gives one
row for each item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flashmill.kernel import expand_folds, owner, pieces
from flashmill.llm.forms import form_codes
from flashmill.llm.looks import looks

#: Characters of a suffix's start; the shortest one is for ideographs and kana only.
LENGTHS = (4, 8, 16, 32)
#: Chance of a start of such a length to be free of changes when a tenth is changed, of ideographs and kana, and of others.
FREE = ((0.66, 0.43, 0.18, 0.03), (0.85, 0.77, 0.66, 0.49))
#: Runs that count when a stretch is compared, of ideographs and kana, and of others.
VERIFY = (3, 5)
#: Passages that may share a start.
COMMON = 3
#: Characters by which a match may lie off the line through its chain.
BAND = 40
#: Share of the matches to be expected of a passage's poorest half, when a tenth is changed, that a leak must have.
SEED_SHARE = 0.5
SHARE = 0.5
#: Verbatim share of the best half that is enough by itself; or else the share of its words (characters) that may be changed.
SAME, CHANGED = 0.88, 0.1
FILTER_BITS = 22
#: Letters and digits of the passages searched at once; more are searched in blocks.
BLOCK = 4_000_000

_MUL = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD6E8FEB86659FD93


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MUL
    return x ^ (x >> np.uint64(29))


def _ends(off: np.ndarray) -> np.ndarray:
    return np.repeat(off[1:], np.diff(off))


def starts(codes: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """For each of LENGTHS the hash of each suffix's start, 0 where the text ends before."""
    n = len(codes)
    h = _mix((codes.astype(np.uint64) + np.uint64(1)) * _MUL)
    left = _ends(off) - np.arange(n)
    out, k = [], 1
    while k <= LENGTHS[-1]:
        if k in LENGTHS:
            out.append(np.where(left >= k, _mix(h) | np.uint64(1), np.uint64(0)))
        h = h * np.uint64(pow(_STEP, k, 1 << 64)) + np.concatenate([h[k:], np.zeros(min(k, n), np.uint64)])
        k *= 2
    return out


def start_codes(codes: np.ndarray, off: np.ndarray, lengths: tuple[int, int]) -> np.ndarray:
    """Hash of the first characters of each suffix: ``lengths`` for ideographs and kana, and for others; 0 where the text ends before."""
    n = len(codes)
    c = _mix((codes.astype(np.uint64) + np.uint64(1)) * _MUL)
    wide = codes >= 0x2E80
    end = _ends(off)
    out = np.zeros(n, np.uint64)
    h = np.zeros(n, np.uint64)
    top = max(lengths)
    pad = np.concatenate([c, np.zeros(top, np.uint64)])
    at = np.arange(n)
    for j in range(top):
        h = h * np.uint64(_STEP) + pad[j : j + n]
        for k, is_wide in zip(lengths, (True, False)):
            if j + 1 == k:
                ok = (wide == is_wide) & (at + k <= end)
                out[ok] = _mix(h[ok]) | np.uint64(1)
    return out


class Suffixes:
    """Some suffixes of joined texts in lexicographic order, as far as their first LENGTHS[-1] characters.

    letters: the number of each character, below 1 << bits; as many of them as
    a word holds are one key, so that a comparison takes so many characters at a
    time. Places after a text's end are 0.
    """

    def __init__(self, letters: np.ndarray, off: np.ndarray, at: np.ndarray, bits: int = 16):
        self.bits, self.per = bits, 64 // bits
        self.keys = -(-LENGTHS[-1] // self.per)
        self.end = _ends(off)
        left = self.end - np.arange(len(letters))
        self.packed, width = letters.astype(np.uint64), 1
        while width < self.per:  # twice as many characters at a time
            more = min(width, self.per - width)
            after = np.where(left > width, np.concatenate([self.packed[width:], np.zeros(min(width, len(left)), np.uint64)]), np.uint64(0))
            self.packed = (self.packed << np.uint64(bits * more)) | (after >> np.uint64(bits * (width - more)))
            width += more
        rank = np.zeros(len(at), np.int64)
        order = np.arange(len(at))
        tied = order.copy()
        for k in range(self.keys):  # in each round only what is equal so far is sorted by the next key
            key = self.key(at[order[tied]], k)
            by = np.lexsort((key, rank[tied])) if k else np.argsort(key)
            order[tied] = order[tied][by]
            key, old = key[by], rank[tied]
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (old[1:] != old[:-1])]) if len(key) else np.zeros(0, bool)
            rank[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))] if len(key) else rank[tied]
            same = np.zeros(len(at) + 1, bool)
            same[1:-1] = rank[1:] == rank[:-1]
            tied = np.flatnonzero(same[1:] | same[:-1])
            if not len(tied):
                break
        self.order = order
        self.sa = at[order]

    def key(self, at: np.ndarray, k: int) -> np.ndarray:
        if not k:
            return self.packed[at]
        to = at + self.per * k
        return np.where(to < self.end[at], self.packed[np.minimum(to, len(self.packed) - 1)], np.uint64(0))

    def common_prefixes(self) -> np.ndarray:
        """Characters that each suffix has in common with the one before it, up to LENGTHS[-1]."""
        out = np.zeros(len(self.sa), np.int64)
        go = np.arange(1, len(self.sa))
        for k in range(self.keys):
            a, b = self.key(self.sa[go - 1], k), self.key(self.sa[go], k)
            diff = a ^ b
            whole = diff == 0
            for j in range(self.per):  # characters before the first difference, and before both end
                low = np.uint64(self.bits * (self.per - 1 - j))
                part = ((diff >> low) == 0) & ((a >> low) & np.uint64((1 << self.bits) - 1) != 0)
                out[go[part]] = self.per * k + j + 1
            go = go[whole]
        return np.minimum(out, LENGTHS[-1])

    def find(self, other: Suffixes, q: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, end) in this order of the suffixes that start with the first length characters of the other's suffix at q."""
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(self.sa))
        go = np.arange(len(q))
        for k in range(self.keys):
            go = go[(length[go] > self.per * k) & (lo[go] < hi[go])]
            if not len(go):
                break
            want = other.key(q[go], k)
            # a start may end within the key: what follows is anything
            rest = (np.uint64(1) << (self.bits * np.maximum(self.per * (k + 1) - length[go], 0)).astype(np.uint64)) - np.uint64(1)
            lo[go], hi[go] = self._bisect(want & ~rest, lo[go], hi[go], k, False), self._bisect(want | rest, lo[go], hi[go], k, True)
        return lo, hi

    def _bisect(self, want: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int, right: bool) -> np.ndarray:
        if k == 0:
            if not hasattr(self, "_first"):
                self._first = self.key(self.sa, 0)
            return np.searchsorted(self._first, want, "right" if right else "left")
        lo, hi = lo.copy(), hi.copy()
        go = np.flatnonzero(lo < hi)
        while len(go):
            m = (lo[go] + hi[go]) // 2
            key = self.key(self.sa[m], k)
            below = key <= want[go] if right else key < want[go]
            lo[go], hi[go] = np.where(below, m + 1, lo[go]), np.where(below, hi[go], m)
            go = go[lo[go] < hi[go]]
        return lo


class Passages:
    """The searched passages: their suffixes in order, the length by which each is searched, and filters over the starts."""

    def __init__(self, ids: list, texts: list[str | None]):
        codes, off = canonical_codes(pa.array(texts, pa.string()))
        size = np.diff(off)
        self.ids, self.codes, self.off, self.size = ids, codes, off, size
        item = np.repeat(np.arange(len(ids)), size)
        self.alphabet = np.zeros(0x110000, np.uint16)
        kinds = np.unique(codes)
        self.alphabet[kinds] = np.arange(1, len(kinds) + 1) if len(kinds) < 0xFFFF else 1 + np.arange(len(kinds)) % 0xFFFE
        self.bits = min(16, max(4, (len(kinds) + 1).bit_length()))  # the highest number is for all other characters
        self.suffixes = Suffixes(self.alphabet[codes].astype(np.int64), off, np.arange(len(codes)), self.bits)
        sa, lcp = self.suffixes.sa, self.suffixes.common_prefixes()
        left = _ends(off) - np.arange(len(codes))
        length = np.zeros(len(codes), np.int64)
        wide = codes >= 0x2E80
        for k in reversed(LENGTHS):
            group = np.cumsum(lcp < k)
            pair = np.unique(group * (len(ids) + 1) + item[sa])
            many = np.bincount(pair // (len(ids) + 1), minlength=group.max(initial=0) + 1)[group] > COMMON
            ok = np.zeros(len(codes), bool)
            ok[sa] = ~many | (k == LENGTHS[-1])  # what many passages share is searched by its longest start
            length[ok & (left >= k) & (wide | (k >= 8))] = k
        self.q = sa[length[sa] > 0]  # in order: neighbours are found near each other
        self.length, self.item = length[self.q], item[self.q]
        self.place = self.q - off[:-1][self.item] if len(self.q) else self.q
        self.filters = []
        for k, h in zip(LENGTHS, starts(codes, off)):
            f = np.zeros(1 << FILTER_BITS, bool)
            f[(h[self.q[self.length == k]] >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.filters.append(f)
        # matches that a leak of the poorest half has when a tenth is changed
        weight = np.zeros(len(codes))
        weight[self.q] = np.where(wide[self.q], np.array(FREE[0])[np.searchsorted(LENGTHS, self.length)], np.array(FREE[1])[np.searchsorted(LENGTHS, self.length)])
        self.need = np.ones(len(ids))
        for i in np.flatnonzero(size).tolist():
            cum = np.concatenate([[0], np.cumsum(weight[off[i] : off[i + 1]])])
            half = self.half(i)
            self.need[i] = max(1.0, SEED_SHARE * (cum[half:] - cum[:-half]).min())
        self.verify = start_codes(codes, off, VERIFY)
        self.width = np.where(wide, *VERIFY)
        self.word = _word_numbers(texts, codes, off)

    def half(self, i: int) -> int:
        return max(1, int(np.ceil(SHARE * self.size[i])))


def _word_numbers(texts: list[str | None], codes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The number of each character's word within its passage; an ideograph or kana is a word."""
    out = []
    for i, t in enumerate(texts):
        words = re.findall(r"[\u2e80-\U0010ffff]|[^\W\u2e80-\U0010ffff]+", t or "")
        n = np.diff(canonical_codes(pa.array(words, pa.string()))[1])
        own = np.repeat(np.arange(len(words)), n)
        size = int(off[i + 1] - off[i])
        out.append(own if len(own) == size else np.where(codes[off[i] : off[i + 1]] >= 0x2E80, 1, 0.2).cumsum().astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def canonical_codes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return form_codes(*looks(expand_folds(arr)))


def search(p: Passages, texts: pa.Array) -> list[tuple[int, int, int]]:
    """(row, item, longest verbatim run) of the leaks in one shard of texts."""
    codes, off = canonical_codes(texts)
    if not len(codes) or not len(p.q):
        return []
    hit = np.zeros(len(codes), bool)
    for f, h in zip(p.filters, starts(codes, off)):
        hit |= f[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] & (h != 0)
    letters = p.alphabet[codes]
    letters = np.where(letters == 0, (1 << p.bits) - 1, letters).astype(np.int64)
    shard = Suffixes(letters, off, np.flatnonzero(hit), p.bits)
    lo, hi = shard.find(p.suffixes, p.q, p.length)
    n = hi - lo
    q = np.repeat(np.arange(len(p.q)), n)
    if not len(q):
        return []
    pos = shard.sa[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    doc = owner(off)[pos]
    item, place = p.item[q], p.place[q]
    which = doc * len(p.ids) + item
    diag = pos - off[doc] - place
    # documents and passages with enough matching suffixes, then with enough near one diagonal; drift grows with the passage
    ok = np.flatnonzero(_counts(which) >= p.need[item])
    which, item, place, diag = which[ok], item[ok], place[ok], diag[ok]
    width = BAND + p.size[item] // 4
    most = np.zeros(len(which), np.int64)
    for shift in (0, 1):
        cell = (diag + (1 << 30) + shift * (width // 2)) // width
        most = np.maximum(most, _counts(which << 31 | cell))
    ok = most >= p.need[item]
    which, place, diag = which[ok], place[ok], diag[ok]
    order = np.lexsort((place, diag, which))
    which, place, diag = which[order], place[order], diag[order]
    # runs: matches on one diagonal that stand close together
    new = np.concatenate([[True], (which[1:] != which[:-1]) | (diag[1:] != diag[:-1]) | (place[1:] > place[:-1] + BAND)]) if len(which) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(which)]]) - 1 if len(first) else first
    runs = np.stack([which[first], place[first], place[last], diag[first], last - first + 1], 1) if len(first) else np.zeros((0, 5), np.int64)
    cuts = np.flatnonzero(np.diff(runs[:, 0])) + 1
    out, at, verify = [], -1, None
    for part in np.split(runs, cuts) if len(runs) else []:
        d, i = divmod(int(part[0, 0]), len(p.ids))
        if d != at:
            a, b = int(off[d]), int(off[d + 1])
            verify, own, at = start_codes(codes[a:b], np.array([0, b - a]), VERIFY), codes[a:b], d
        for line in _chains(part[:, 1:], p.need[i]):
            run = _compare(p, i, verify, own, *line)
            if run:
                out.append((d, i, run))
                break
    return out


def _counts(key: np.ndarray) -> np.ndarray:
    """For each element how often its value occurs, or more: values are counted by their hash."""
    cell = (_mix(key.astype(np.uint64) * _MUL) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return np.bincount(cell, minlength=1 << FILTER_BITS)[cell]


def _chains(runs: np.ndarray, need: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, diagonals) of chains of runs (start, end, diagonal, matches) with need matches, heaviest first.

    A run can follow another that starts before it in both texts, if the
    diagonals differ by BAND and a quarter of the places between at most.
    """
    left = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    while len(left) and left[:, 3].sum() >= need:
        a, b, d, w = left.T
        best, prev = w.astype(np.float64), np.full(len(left), -1)
        for j in range(1, len(left)):
            c = np.flatnonzero((b[:j] < b[j]) & (a[:j] + d[:j] < a[j] + d[j]) & (b[:j] + d[:j] < b[j] + d[j]) & (np.abs(d[:j] - d[j]) <= BAND + np.maximum(a[j] - b[:j], 0) // 4))
            if len(c):
                k = c[np.argmax(best[c])]
                best[j], prev[j] = best[k] + w[j], k
        j = int(np.argmax(best))
        if best[j] < need:
            return
        chain = []
        while j >= 0:
            chain.append(j)
            j = int(prev[j])
        chain = chain[::-1]
        x, y = np.stack([a[chain], b[chain]], 1).ravel(), np.repeat(d[chain], 2)
        keep_ = np.concatenate([[True], np.diff(np.maximum.accumulate(x)) > 0])
        yield x[keep_], y[keep_]
        left = np.delete(left, chain, 0)


def _compare(p: Passages, i: int, text: np.ndarray, codes: np.ndarray, places: np.ndarray, diags: np.ndarray) -> int:
    """Longest verbatim run if a half of the passage stands in the text along the line through (places, diagonals), else 0."""
    a, n = int(p.off[i]), int(p.size[i])
    own, width = p.verify[a : a + n], p.width[a : a + n]
    line = np.interp(np.arange(n), places, diags)
    lo, hi = max(0, int(line.min()) - BAND), min(len(text), int(line.max()) + n + BAND + 1)
    seg = text[lo:hi]
    if not len(seg):
        return 0
    order = np.argsort(seg, kind="stable")
    s = seg[order]
    l, r = np.searchsorted(s, own, "left"), np.searchsorted(s, own, "right")
    r[own == 0] = l[own == 0]
    cnt = r - l
    w = np.repeat(np.arange(n), cnt)
    pos = order[np.repeat(l, cnt) + np.arange(cnt.sum()) - np.repeat(np.cumsum(cnt) - cnt, cnt)] + lo
    w = w[np.abs(pos - w - line[w]) <= BAND]
    edge = np.zeros(n + 1, np.int64)
    w = np.unique(w)
    np.add.at(edge, w, 1)
    np.add.at(edge, np.minimum(w + width[w], n), -1)
    covered = np.cumsum(edge)[:n] > 0
    half = p.half(i)
    cum = np.concatenate([[0], np.cumsum(covered)])
    share = cum[half:] - cum[:-half]
    gaps = np.flatnonzero(np.concatenate([[True], ~covered, [True]]))
    longest = int(np.diff(gaps).max() - 1)
    if share.max() >= SAME * half:
        return longest
    if share.max() < (1 - 3 * CHANGED) * half:
        return 0
    x = int(np.argmax(share))
    if (p.codes[a + x : a + x + half] >= 0x2E80).mean() > 0.5:
        t = codes[max(0, x + int(line[x : x + half].min()) - half // 8) : x + half + int(line[x : x + half].max()) + half // 8]
        return longest if _inside(p.codes[a + x : a + x + half], t) <= CHANGED * half else 0
    word = p.word[a + x : a + x + half]
    return longest if len(np.unique(word[~covered[x : x + half]])) <= CHANGED * len(np.unique(word)) else 0


def _inside(pattern: np.ndarray, text: np.ndarray) -> int:
    """The least edit distance of the pattern to a part of the text."""
    n = len(pattern)
    at = np.arange(n + 1)
    row = at.copy()
    best = n
    for c in text.tolist():
        new = np.minimum(row[1:] + 1, row[:-1] + (pattern != c))
        new = np.concatenate([[0], new])
        row = np.minimum.accumulate(new - at) + at
        best = min(best, int(row[-1]))
    return best


def _batches(blocks: list[Passages]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1, 5 << 20):
                rows, items, runs = [], [], []
                for p in blocks:
                    for r, i, n in search(p, part.column(1)):
                        rows.append(r)
                        items.append(p.ids[i])
                        runs.append(n)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), pa.array(items, pa.int64()), pa.array(runs, pa.int64())], ["_id", "item_id", "longest"])

    return run


def find_leaks(docs: DataFrame, id_col: str, text: str, items: DataFrame, item_col: str = "item_id", passage: str = "passage") -> DataFrame:
    """id, item_id, longest (verbatim run, in letters and digits): a narrow map over the corpus.

    The test set goes to all executors; it is small by nature, and its size is
    checked: passages beyond BLOCK characters are searched in further passes.
    """
    size = items.agg(F.sum(F.length(passage))).first()[0] or 0
    count = max(1, -(-size // BLOCK))
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_t"))
    out = None
    for b in range(count):
        part = items.filter(F.pmod(F.xxhash64(item_col), F.lit(count)) == b).select(item_col, passage).orderBy(item_col).toArrow()
        p = Passages(part.column(0).to_pylist(), part.column(1).to_pylist())
        one = src.mapInArrow(_batches([p]), f"_id {kind}, item_id long, longest long")
        out = one if out is None else out.unionByName(one)
    return out.withColumnRenamed("_id", id_col)


def clean(docs: DataFrame, id_col: str, leaks: DataFrame) -> DataFrame:
    """docs without the documents that leak."""
    return docs.join(leaks.select(id_col).distinct(), id_col, "left_anti")
