"""New batches checked against all history for repeats and slightly edited repeats (problem 1).

1. Each content loses its source's repeated lines and is brought to the forms
   of problems 7 and 6 in one pass over code points; equal contents become one
   node with the first batch that holds them.
2. A node gets a sketch of SLOTS half bytes: in each slot the gram with the
   smallest exponential draw over its weight (one-permutation weighted
   min-hash), together with the sixth of the text it stands in. Weights fall
   with a gram's commonness in a bounded sample; grams the sample doesn't hold
   weigh little, as edits make such grams. The rarest known grams among the
   slots', and those of the others with the smallest hashes, are the node's routes.
3. Routes deal the nodes out over shards by gram. In a shard each segment (the
   nodes of a range of batches) is a navigable small-world graph: a node is
   linked to the most similar of the nodes at power-of-two distances in its
   gram's list. A new batch searches every segment, short lists whole and long
   ones by a beam, then becomes a segment; neighbouring segments of like size
   are compacted into one graph. Segments are stored (``HistoryIndex``).
4. What the searches end with is decided exactly, by edit distance: lengths and
   character counts give a lower bound of it, and the bit vectors of many pairs
   go on together until it must exceed the allowed one. Each query's most
   similar node comes first; the others follow where that one wasn't a repeat.

BEAM, ENTRIES and LINKS are widened until the beams find what an exhaustive
search of the same lists finds (``exhaustive``).

Null and blank contents are out; contents without letters or digits equal only
each other's absence and give no rows; lists of fields and contents below
MIN_CHARS repeat only when equal; rows of one batch don't repeat each other.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flashmill.kernel import expand_folds, keep, owner, pieces, to_codes, to_strings
from flashmill.llm.forms import digests, field_list_rows, form_codes, forms, split_fields
from flashmill.llm.lines import line_ids
from flashmill.llm.looks import looks
from flashmill.operators.prefilter import maybe_in
from flashmill.session import Versions, delete_at_exit, delete_path, materialize, shared_dir, shuffles_deleted, written

MIN_CHARS = 100
MAX_EDITS = 0.2
#: Texts the commonness of grams is fitted on, at most about; all rows are indexed.
SAMPLE = 20_000
SAMPLE_BYTES = 200 << 20
TABLE_BITS = 22
#: Characters of a gram: of ideographs and kana, of other scripts.
WIDE, NARROW = 3, 4
SLOTS = 64
#: Routes of a text: its rarest slots' grams, and of the others those of the smallest hash however common they are. The first keep lists
#: short; the second are what variants of a text that fills much of the table still share, where grams of their own edits are the rarest.
RARE, FIXED = 9, 4
ROUTES = RARE + FIXED
#: Weight of a gram that not even two sampled texts hold; the others' is (1 + texts) ** -0.5.
UNKNOWN = 0.02
#: Routes: grams of up to KNOWN sampled texts are alike; an unknown gram ranks as if AS_KNOWN texts held it, after all known ones.
KNOWN, AS_KNOWN = 16, 1 << 30
#: A slot's gram counts with the part of the text it stands in, so that shared phrases elsewhere don't.
PARTS = 6
#: Routed entries in one shard.
SHARD_ENTRIES = 100_000
#: Entries a task holds before it sends them to their shards; texts whose pairs are put together at once, and the least number of such groups.
HELD, BUCKET, MIN_BUCKETS = 1 << 19, 100_000, 12
#: Lists up to SCAN are compared whole, longer ones by beams.
SCAN = 512
BEAM, ENTRIES, LINKS, ROUNDS = 12, 8, 8, 6
#: Pairs whose signatures are compared at a time: what stays in a processor's cache.
AT_ONCE = 1 << 14
#: A query's search of a shard ends with its WIDTH nodes of most slots in common.
WIDTH = 8
#: Slots in common from which a pair is compared exactly in any case; of pairs with fewer, LEAST_SHARED at least, a query's best one is.
ALL_FROM, LEAST_SHARED = 14, 10
#: Cells of a text's 3-grams in the lower bound of a distance.
CELLS = 2048
#: Cells of the anchors in the upper bound.
ANCHOR_CELLS = 1024
#: Pairs whose distances are computed together, and characters of these.
TOGETHER, TOGETHER_CHARS = 2048, 1 << 21
#: Longer texts are compared pair by pair.
LONG = 20_000
#: Slots in common that end a beam: the pair is as good as equal.
SURE = 58

_MUL = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)
_ONES = np.uint64(0x1111111111111111)
_LOW = np.uint64((1 << TABLE_BITS) - 1)


def uniq(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _MUL
    return x ^ (x >> np.uint64(29))


def grams(codes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the gram, document, place) at each place where a gram fits into its document."""
    c = _mix((codes.astype(np.uint64) + np.uint64(1)) * _MUL)
    n = len(c)
    pad = np.concatenate([c, np.zeros(NARROW, np.uint64)])
    h = pad[:n] * _B + pad[1 : n + 1]
    h = h * _B + pad[2 : n + 2]
    wide = codes >= 0x2E80
    h = np.where(wide, h, h * _B + pad[3 : n + 3])
    size = np.diff(off)
    place = np.arange(n) - np.repeat(off[:-1], size)
    ok = np.repeat(size, size) - place >= np.where(wide, WIDE, NARROW)
    return _mix(h[ok]), owner(off)[ok], place[ok]


_CLASS = np.concatenate([[np.log2(AS_KNOWN)], np.maximum(np.log2(np.maximum(np.exp2(np.arange(1, 256) / 8) - 1, 1)), np.log2(KNOWN))]).astype(np.uint8)
_DRAW = np.concatenate([[1 / UNKNOWN], np.exp2(np.arange(1, 256) / 16)]).astype(np.float32)


def sketch(codes: np.ndarray, off: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, SLOTS half bytes in uint64 [n, SLOTS / 16]; routing grams int64 [n, ROUTES], 0 for none) of canonical documents."""
    n = len(off) - 1
    h, doc, place = grams(codes, off)
    best = np.full(n * SLOTS, np.inf, np.float32)
    gram, part = np.zeros(n * SLOTS, np.uint64), np.zeros(n * SLOTS, np.uint64)
    u = ((_mix(h * _MUL) >> np.uint64(40)).astype(np.float32) + np.float32(1)) * np.float32(2.0**-24)
    draw = -np.log(u) * _DRAW[common[(h & _LOW).astype(np.int64)]]
    cell = doc * SLOTS + (h >> np.uint64(58)).astype(np.int64)
    np.minimum.at(best, cell, draw)
    won = np.flatnonzero(best[cell] == draw)[::-1]  # of a gram that stands there twice, the first place
    at = cell[won]
    gram[at] = h[won]
    part[at] = place[won] * PARTS // np.diff(off)[doc[won]]
    gram, part = gram.reshape(n, SLOTS), part.reshape(n, SLOTS)
    half = np.where(gram == 0, np.arange(SLOTS, dtype=np.uint64), _mix((gram + part) * _MUL)) & np.uint64(15)
    sig = np.bitwise_or.reduce(half.reshape(n, SLOTS // 16, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4)), 2)
    rank = np.where(gram == 0, 255, _CLASS[common[(gram & _LOW).astype(np.int64)]]).astype(np.int64) * SLOTS + np.arange(SLOTS)
    order = np.argsort(rank, 1)
    rest = np.take_along_axis(gram, order[:, RARE:], 1)
    by_hash = np.argsort(np.where(rest == 0, ~np.uint64(0), _mix(rest * _B)), 1)[:, :FIXED]
    return sig, np.concatenate([np.take_along_axis(gram, order[:, :RARE], 1), np.take_along_axis(rest, by_hash, 1)], 1).view(np.int64)


def commonness(contents: pa.Array) -> np.ndarray:
    """A byte per gram hash modulo the table size: 0 where not even two texts of a sample hold the gram, else about 8 * log2(1 + texts that do)."""
    out = np.zeros(1 << TABLE_BITS, np.float32)
    for a in range(0, len(contents), 500):  # the driver's memory
        codes, off = form_codes(*looks(expand_folds(contents.slice(a, 500))))
        h, doc, _ = grams(codes, off)
        key = uniq((doc.astype(np.uint64) << np.uint64(TABLE_BITS)) | (h & _LOW))
        np.add.at(out, (key & _LOW).astype(np.int64), 1)
    out[out < 2] = 0  # what only one sampled text holds may be its own edit
    return np.rint(8 * np.log2(1 + out)).astype(np.uint8)


class Packer:
    """Canonical texts packed with a dictionary of sampled texts."""

    def __init__(self, sample: bytes):
        d = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if sample else None
        if d:
            d.precompute_compress(level=6)
        self.out, self.into = zstandard.ZstdDecompressor(dict_data=d), zstandard.ZstdCompressor(dict_data=d) if d else zstandard.ZstdCompressor()

    def pack(self, texts: pa.Array) -> pa.Array:
        return pa.array([None if x is None else self.into.compress(x.encode()) for x in texts.to_pylist()], pa.binary())

    def unpack(self, packed: pa.Array) -> pa.Array:
        return pa.array([None if x is None else self.out.decompress(x).decode() for x in packed.to_pylist()], pa.string())


def _canon_batches(sample: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(sample)
        for batch in batches:
            for part in pieces(batch, 2):
                yield _canon(part, packer)

    return run


def _canon(part: pa.RecordBatch, packer: Packer) -> pa.RecordBatch:
    text, drop = part.column(2), part.column(3).to_pylist()
    if any(drop):
        ids, at = line_ids(text)
        raw = text.to_pylist()
        sets = {}
        for i, d in enumerate(drop):
            if d and raw[i]:
                s = sets.setdefault(tuple(d), frozenset(d))
                own = ids[at[i] : at[i + 1]].tolist()
                if not s.isdisjoint(own):
                    raw[i] = "\n".join(x for x, k in zip(raw[i].split("\n"), own) if k not in s)
        text = pa.array(raw, pa.string())
    text = expand_folds(text)
    seen, off = looks(text)
    listed = field_list_rows(seen, off)
    codes, off2 = form_codes(seen, off)
    keys = digests(codes, off2)
    rows = np.flatnonzero(listed)
    if len(rows):
        lists = [split_fields(x) for x in to_strings(*keep_rows(seen, off, rows)).to_pylist()]
        own = digests(*forms(pa.array([p for x in lists for p in x], pa.string())))
        a = 0
        for r, x in zip(rows.tolist(), lists):
            mine = sorted(own[a : a + len(x)])
            a += len(x)
            if any(mine):
                keys[r] = digests(np.frombuffer(b"F".ljust(4) + b"".join(m.ljust(16, b"\0") for m in mine), np.uint32), np.array([0, 1 + 4 * len(mine)]))[0]
    long = (np.diff(off2) >= MIN_CHARS) & ~listed
    spot = pa.array(np.cumsum(long) - 1, pa.int64(), mask=~long)
    texts = to_strings(*keep_rows(codes, off2, np.flatnonzero(long))).take(spot)
    return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x or None for x in keys], pa.binary()), packer.pack(texts)], ["_id", "_batch", "_key", "_text"])


def keep_rows(codes: np.ndarray, off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of some rows, in order."""
    mask = np.zeros(len(off) - 1, bool)
    mask[rows] = True
    out, _ = keep(codes, off, np.repeat(mask, np.diff(off)))
    return out, np.concatenate([[0], np.cumsum(np.diff(off)[rows])])


def _entry_batches(common: np.ndarray, sample: bytes, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, held = Packer(sample), []
        for batch in batches:
            for part in pieces(batch, 2, 1 << 19):
                codes, off = to_codes(packer.unpack(part.column(2)))
                sig, route = sketch(codes, off, common)
                route = np.sort(route, 1)
                use = route != 0
                use[:, 1:] &= route[:, 1:] != route[:, :-1]
                row, gram = np.nonzero(use)[0], route[use]
                held.append((gram, part.column(0).to_numpy()[row], part.column(1).to_numpy()[row], sig[row], np.diff(off).astype(np.int32)[row]))
                if sum(len(x[0]) for x in held) >= HELD:
                    yield _by_shard(held, shards)
                    held = []
        if held:
            yield _by_shard(held, shards)

    return run


def _by_shard(held: list[tuple], shards: int) -> pa.RecordBatch:
    """_shard, _entries: the entries of each shard, packed."""
    cols = [np.concatenate(x) for x in zip(*held)]
    shard = (_mix(cols[0].view(np.uint64)) % np.uint64(shards)).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in _grouped(shard, *cols)], ["_shard", "_entries"])


def _grouped(key: np.ndarray, *cols: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(each key, its rows of cols packed)."""
    order = np.argsort(key, kind="stable")
    keys, at = np.unique(key[order], return_index=True)
    at = [*at.tolist(), len(order)]
    return keys, [pack_columns(*(c[order[a:b]] for c in cols)) for a, b in zip(at[:-1], at[1:])]


def pack_columns(*cols: np.ndarray) -> bytes:
    """Columns of integers, a row of bytes for each of their bytes, packed."""
    head = np.array([len(cols[0])], np.int64)
    return zstandard.compress(b"".join([head.tobytes(), *(np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T).tobytes() for c in cols)]), 1)


def unpack_columns(blobs: list[bytes], kinds: tuple[np.dtype, ...]) -> list[np.ndarray]:
    """The rows of all blobs; kinds: dtype of each column, with a shape for one of several values."""
    kinds = tuple(np.dtype(k) for k in kinds)
    got = [[np.zeros((0, *k.shape), k.base)] for k in kinds]
    for blob in blobs:
        raw = zstandard.decompress(blob)
        n, at = int(np.frombuffer(raw, np.int64, 1)[0]), 8
        for k, out in zip(kinds, got):
            x = np.frombuffer(raw, np.uint8, n * k.itemsize, at).reshape(k.itemsize, n)
            out.append(np.ascontiguousarray(x.T).view(k.base).reshape(n, *k.shape))
            at += n * k.itemsize
    return [np.concatenate(x) for x in got]


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Half bytes that two signatures have in common."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    x &= _ONES
    n = np.ascontiguousarray(np.bitwise_count(x))
    # the sum of a row's 4 bytes, which is 64 at most, comes to stand in the highest
    return SLOTS - (n.view(np.uint32)[..., 0] * np.uint32(0x01010101) >> np.uint32(24)).astype(np.int16)


def alike(m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether lengths m and n are within MAX_EDITS."""
    return np.abs(m - n) <= MAX_EDITS * np.maximum(m, n) + 1e-9


def _spans(a: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each a, n of them."""
    return np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Segment:
    """The graph over a shard's nodes of batches lo to hi: nodes, links, and the list of nodes of each gram."""

    def __init__(self, lo: int, hi: int, node: np.ndarray, batch: np.ndarray, sig: np.ndarray, size: np.ndarray, gram: np.ndarray, who: np.ndarray, links: np.ndarray | None = None):
        self.lo, self.hi, self.node, self.batch, self.sig, self.size, self.gram, self.who = lo, hi, node, batch, sig, size, gram, who
        self.links = self._build() if links is None else links

    @classmethod
    def of(cls, lo: int, hi: int, gram: np.ndarray, node: np.ndarray, batch: np.ndarray, sig: np.ndarray, size: np.ndarray) -> Segment:
        """From entries, a row for each gram of a node."""
        ids, row, who = np.unique(node, return_index=True, return_inverse=True)
        sig = np.ascontiguousarray(sig[row])
        order = np.lexsort((sig[who, 0], gram))  # like nodes stand together in a list
        return cls(lo, hi, ids, batch[row], sig, size[row], gram[order], who[order].astype(np.int32))

    @classmethod
    def compact(cls, a: Segment, b: Segment) -> Segment:
        at = [np.concatenate(x) for x in zip(*((s.gram, s.node[s.who], s.batch[s.who], s.sig[s.who], s.size[s.who]) for s in (a, b)))]
        return cls.of(min(a.lo, b.lo), max(a.hi, b.hi), *at)

    def _build(self) -> np.ndarray:
        """Links [nodes, LINKS] between nodes of long lists; -1 pads."""
        n = len(self.node)
        links = np.full((n, LINKS), -1, np.int32)
        _, size = np.unique(self.gram, return_counts=True)
        e = np.flatnonzero(np.repeat(size, size) > SCAN)
        gram, who = self.gram[e], self.who[e].astype(np.int64)
        xs, ys, step = [], [], 1
        while step < len(e) and step <= 1 << 14:
            same = np.flatnonzero(gram[:-step] == gram[step:])
            if not len(same):
                break
            xs.append(who[same])
            ys.append(who[same + step])
            step *= 2
        if not xs:
            return links
        x, y = np.concatenate(xs), np.concatenate(ys)
        s = shared(self.sig[x], self.sig[y]).astype(np.int64)
        src, dst, s = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([s, s])
        key = uniq((src * (SLOTS + 1) + SLOTS - s) * n + dst)  # by node, the most similar first
        src, dst = key // n // (SLOTS + 1), key % n
        rank = np.arange(len(src)) - np.searchsorted(src, src)
        ok = rank < LINKS
        links[src[ok], rank[ok]] = dst[ok]
        return links

    def search(self, other: Segment, exhaustive: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node of the other segment, node here, slots in common) of pairs with LEAST_SHARED slots at least and lengths within MAX_EDITS."""
        gram, q, sig = other.gram, other.who.astype(np.int64), other.sig
        a, b = np.searchsorted(self.gram, gram, "left"), np.searchsorted(self.gram, gram, "right")
        size = b - a
        out = [np.zeros((3, 0), np.int64)]
        short = np.flatnonzero((size > 0) & (exhaustive | (size <= SCAN)))
        ends = np.cumsum(size[short])
        for lo, hi in _cuts(ends, 1 << 20):
            i = short[lo:hi]
            out.append(self._pairs(np.repeat(q[i], size[i]), self.who[_spans(a[i], size[i])], other))
        if not exhaustive:
            far = np.flatnonzero(size > SCAN)
            for cut in range(0, len(far), 10_000):
                i = far[cut : cut + 10_000]
                start = a[i][:, None] + ((size[i][:, None] - 1) * np.linspace(0, 1, ENTRIES // 2)).astype(np.int64)
                # and the list's place where the query itself would stand
                x, y, own = a[i].copy(), b[i].copy(), sig[q[i], 0]
                while (x < y).any():
                    m = (x + y) // 2
                    less = (x < y) & (self.sig[self.who[np.minimum(m, len(self.who) - 1)], 0] < own)
                    x, y = np.where(less, m + 1, x), np.where(less | (x >= y), y, m)
                near = np.clip(x[:, None] + np.arange(-(ENTRIES // 4), ENTRIES // 4), a[i][:, None], b[i][:, None] - 1)
                out.append(self._beam(q[i], self.who[np.concatenate([near, start], 1)].astype(np.int64), sig))
        q, p, s = np.concatenate(out, 1)
        ok = alike(other.size[q], self.size[p])
        return q[ok], p[ok], s[ok]

    def _pairs(self, q: np.ndarray, p: np.ndarray, other: Segment) -> np.ndarray:
        out = [np.zeros((3, 0), np.int64)]
        for at in range(0, len(q), AT_ONCE):
            x, y = q[at : at + AT_ONCE], p[at : at + AT_ONCE]
            ok = alike(other.size.take(x), self.size.take(y))
            x, y = x[ok], y[ok]
            s = shared(other.sig.take(x, 0), self.sig.take(y, 0))
            ok = s >= LEAST_SHARED
            out.append(np.stack([x[ok], y[ok], s[ok]]).astype(np.int64))
        return np.concatenate(out, 1)

    def _beam(self, who: np.ndarray, cand: np.ndarray, sig: np.ndarray) -> np.ndarray:
        rows = len(who)
        ids, sims = np.full((rows, BEAM), -1, np.int64), np.full((rows, BEAM), -1, np.int16)
        done = np.ones((rows, BEAM), bool)
        act = np.arange(rows)
        for _ in range(ROUNDS + 1):
            own, n = ids[act], len(act)
            s = shared(sig[who[act]][:, None], self.sig[np.maximum(cand, 0)])
            s[cand < 0] = -1
            # of equal candidates the one that is done comes first
            all_, sim, fin = np.concatenate([own, cand], 1), np.concatenate([sims[act], s], 1), np.concatenate([done[act], np.zeros(cand.shape, bool)], 1)
            top = np.argsort(-(sim.astype(np.int64) << 40 | np.maximum(all_, 0) << 1 | fin), 1, kind="stable")
            all_, sim, fin = (np.take_along_axis(x, top, 1) for x in (all_, sim, fin))
            twice = np.zeros(all_.shape, bool)
            twice[:, 1:] = all_[:, 1:] == all_[:, :-1]
            sim[twice] = -1
            top = np.argsort(-sim, 1, kind="stable")[:, :BEAM]
            own, sim, fin = (np.take_along_axis(x, top, 1) for x in (all_, sim, fin))
            own[sim < 0] = -1
            open_ = ~fin & (own >= 0)
            rank = np.cumsum(open_, 1)
            two = open_ & (rank <= 2)
            fin |= two
            ids[act], sims[act], done[act] = own, sim, fin
            go = open_.any(1) & (sim[:, 0] < SURE)
            if not go.any():
                break
            first = np.argmax(two, 1)
            second = np.where(rank[:, -1] >= 2, two.shape[1] - 1 - np.argmax(two[:, ::-1], 1), first)
            line = np.arange(n)[go]
            cand = np.concatenate([self.links[own[line, first[go]]], self.links[own[line, second[go]]]], 1).astype(np.int64)
            act = act[go]
        ok = sims >= LEAST_SHARED
        return np.stack([np.repeat(who, BEAM)[ok.ravel()], ids[ok], sims[ok].astype(np.int64)])

    def pack(self) -> bytes:
        n, m = len(self.node), len(self.gram)
        linked = np.flatnonzero((self.links >= 0).any(1)).astype(np.int32)
        head = np.array([self.lo, self.hi, n, m, len(linked)], np.int64)
        flat = (head, self.node.astype(np.int64), self.batch.astype(np.int64), self.sig, self.size.astype(np.int32), self.gram, self.who, linked, self.links[linked])
        return zstandard.compress(b"".join(np.ascontiguousarray(x).tobytes() for x in flat), 1)

    @classmethod
    def unpack(cls, blob: bytes) -> Segment:
        raw = zstandard.decompress(blob)
        lo, hi, n, m, k = np.frombuffer(raw, np.int64, 5).tolist()
        at, got = 40, []
        for kind, count in ((np.int64, n), (np.int64, n), (np.uint64, n * SLOTS // 16), (np.int32, n), (np.int64, m), (np.int32, m), (np.int32, k), (np.int32, k * LINKS)):
            got.append(np.frombuffer(raw, kind, count, at))
            at += count * np.dtype(kind).itemsize
        links = np.full((n, LINKS), -1, np.int32)
        links[got[6]] = got[7].reshape(k, LINKS)
        return cls(lo, hi, got[0], got[1], got[2].reshape(n, -1), got[3], got[4], got[5], links)


def _cuts(ends: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of items whose sizes, with these running sums, come to about limit."""
    if not len(ends):
        return []
    at = np.unique(np.searchsorted(ends, np.arange(limit, ends[-1] + limit, limit), "left") + 1).tolist()
    at = [0, *[x for x in at if x < len(ends)], len(ends)]
    return list(zip(at[:-1], at[1:]))


def live(segments: list[Segment]) -> list[Segment]:
    """The segments in force: those no compacted one covers, oldest first."""
    out: list[Segment] = []
    for s in sorted(segments, key=lambda s: (s.lo, -s.hi)):
        if not out or s.hi > out[-1].hi:
            out.append(s)
    return out


def best(q: np.ndarray, p: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Places of the pairs a search ends with: of each query WIDTH with ALL_FROM slots in common, or else its best one."""
    order = np.lexsort((p, -s, q))
    q, p, s = q[order], p[order], s[order]
    new = np.concatenate([[True], (np.diff(q) != 0) | (np.diff(p) != 0)])[: len(q)]  # a pair can come from several grams
    order, q, s = order[new], q[new], s[new]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return order[(rank == 0) | ((rank < WIDTH) & (s >= ALL_FROM))]


def feed(segments: list[Segment], gram: np.ndarray, node: np.ndarray, batch: np.ndarray, sig: np.ndarray, size: np.ndarray, exhaustive: bool = False) -> tuple[np.ndarray, list[Segment]]:
    """(pairs [later node, earlier node, its batch, slots in common], segments) after batch upon batch searched the segments before it and became one.

    Compaction: a new segment takes in the last ones up to twice its size.
    """
    order = np.argsort(batch, kind="stable")
    gram, node, batch, sig, size = gram[order], node[order], batch[order], sig[order], size[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(batch)) + 1, [len(batch)]]).tolist() if len(batch) else []
    segments, pairs = list(segments), [np.zeros((4, 0), np.int64)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        new = Segment.of(int(batch[a]), int(batch[a]) + 1, gram[a:b], node[a:b], batch[a:b], sig[a:b], size[a:b])
        got = [np.zeros((4, 0), np.int64)]
        for s in segments:
            q, p, n = s.search(new, exhaustive)
            got.append(np.stack([new.node[q], s.node[p], s.batch[p], n]))
        got = np.concatenate(got, 1)
        pairs.append(got if exhaustive else got[:, best(got[0], got[1], got[3])])
        while segments and len(segments[-1].gram) <= 2 * len(new.gram):
            new = Segment.compact(segments.pop(), new)
        segments.append(new)
    return np.concatenate(pairs, 1), segments


_ENTRY = (np.int64, np.int64, np.int64, (np.uint64, (SLOTS // 16,)), np.int32)
_PAIR = (np.int64, np.int64, np.int64, np.uint8)
_SHARD_OUT = "_shard int, _bucket int, _pairs binary, _lo long, _hi long, _graph binary"


def _first_feed(buckets: int):
    return lambda key, entries: _feed_shard(key, entries, None, buckets)


def _feed_both(buckets: int):
    return lambda key, entries, stored: _feed_shard(key if key[0] is not None else (entries.column("_shard")[0],), entries, stored, buckets)


def _feed_shard(key: tuple, entries: pa.Table, stored: pa.Table | None, buckets: int) -> pa.Table:
    old = live([Segment.unpack(x) for x in stored.column("_graph").to_pylist()]) if stored is not None else []
    pairs, segments = feed(old, *unpack_columns(entries.column("_entries").to_pylist(), _ENTRY))
    pairs = pairs[:, np.argsort(pairs[0], kind="stable")]
    bucket, blobs = _grouped(bucket_of(pairs[0], buckets), *pairs[:3], pairs[3].astype(np.uint8)) if pairs.shape[1] else ([], [])
    fresh = [s for s in segments if not any(s is o for o in old)]
    k, g = len(blobs), len(fresh)
    rows = [[key[0].as_py()] * (k + g), [*bucket, *[None] * g], [*blobs, *[None] * g], *([None] * k + [f(s) for s in fresh] for f in (lambda s: s.lo, lambda s: s.hi, Segment.pack))]
    return _shard_table(rows)


def _shard_table(rows: list[list]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
    return pa.Table.from_arrays([pa.array(x, kind) for x, kind in zip(rows, kinds)], ["_shard", "_bucket", "_pairs", "_lo", "_hi", "_graph"])


def bucket_of(node: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(node.astype(np.uint64) * _MUL) % np.uint64(buckets)).astype(np.int32)


def _ends(key: tuple, rows: pa.Table) -> pa.Table:
    """_q, _p, _pb, _top: each pair of some queries that is to be compared once; _top: a query's most similar one."""
    q, p, pb, s = unpack_columns(rows.column("_pairs").to_pylist(), _PAIR)
    order = np.lexsort((-p, -s.astype(np.int64), q))
    q, p, pb, s = q[order], p[order], pb[order], s[order]
    first = np.concatenate([[True], q[1:] != q[:-1]])[: len(q)]
    use = first | ((s >= ALL_FROM) & np.concatenate([[True], (q[1:] != q[:-1]) | (p[1:] != p[:-1])])[: len(q)])
    return pa.table({"_q": q[use], "_p": p[use], "_pb": pb[use], "_top": first[use]})


def fit(texts: DataFrame, column: str, id_col: str) -> tuple[np.ndarray, bytes]:
    """(commonness of grams, dictionary for packing) from at most about SAMPLE texts and SAMPLE_BYTES, picked by a hash of their id."""
    total, size = texts.agg(F.count(F.lit(1)), F.sum(F.octet_length(column))).first()
    one_in = max(1, math.ceil(total / SAMPLE), math.ceil((size or 0) / SAMPLE_BYTES))
    part = texts.filter((F.pmod(F.xxhash64(id_col), F.lit(one_in)) == 0) & (F.octet_length(column) <= SAMPLE_BYTES)).select(column).filter(F.col(column).isNotNull())
    got = part.toArrow().column(0).combine_chunks()
    got = pa.concat_arrays(got.chunks) if isinstance(got, pa.ChunkedArray) else got
    if not len(got):
        return np.zeros(1 << TABLE_BITS, np.uint8), b""
    common = commonness(got)
    some = to_strings(*form_codes(*looks(expand_folds(got.slice(0, 2000))))).to_pylist()
    return common, "".join(some).encode()[: 1 << 18]


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance of two texts is k at most: bit vectors, left as soon as the rest can't bring it down to k."""
    m, n = len(a), len(b)
    if abs(m - n) > k:
        return False
    if m == 0 or n == 0:
        return max(m, n) <= k
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, m - 1
    pv, mv, d = full, 0, m
    get, left = at.get, n
    for c in b:
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        left -= 1
        if ph >> top & 1:
            d += 1
            if d - left > k:
                return False
        elif mh >> top & 1:
            d -= 1
        elif d - left > k:
            return False
        ph = (ph << 1 | 1) & full
        pv = (mh << 1) & full | (full & ~(xv | ph))
        mv = ph & xv
    return d <= k


def within_many(codes: np.ndarray, off: np.ndarray, x: np.ndarray, y: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Whether the edit distance of texts x and y is k at most: ``within`` for pairs of like length together, a word of 64 places at a time."""
    size = np.diff(off)
    out = np.zeros(len(x), bool)
    a, b = np.where(size[x] <= size[y], x, y), np.where(size[x] <= size[y], y, x)  # a is the shorter
    m, n = size[a], size[b]
    some = np.flatnonzero((n - m <= k) & (m > 0))
    out[m == 0] = (n <= k)[m == 0]
    some = some[np.lexsort((n[some], m[some]))]
    while len(some):
        # the longest first; as many as hold TOGETHER_CHARS at most
        like = len(some) - int(np.searchsorted(m[some], int(0.8 * m[some[-1]])))
        count = int(max(1, min(TOGETHER, TOGETHER_CHARS // max(1, n[some[-1]]), like)))
        i, some = some[-count:], some[:-count]
        if count == 1 or n[i].max() > LONG:
            for one in i.tolist():
                t, u = (codes[off[r] : off[r + 1]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass") for r in (a[one], b[one]))
                out[one] = within(t, u, int(k[one]))
        else:
            out[i] = _together(codes, off[a[i]], m[i], off[b[i]], n[i], k[i])
    return out


def _together(codes: np.ndarray, a: np.ndarray, m: np.ndarray, b: np.ndarray, n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Whether the texts of length m at a and of length n at b are within k."""
    count, one = len(m), np.uint64(1)
    ai, bi = owner(np.concatenate([[0], np.cumsum(m)])), owner(np.concatenate([[0], np.cumsum(n)]))
    aj, bj = np.arange(len(ai)) - np.repeat(np.cumsum(m) - m, m), np.arange(len(bi)) - np.repeat(np.cumsum(n) - n, n)
    ac, bc = codes[a[ai] + aj], codes[b[bi] + bj]
    alphabet = np.zeros(0x110000, bool)
    alphabet[ac] = alphabet[bc] = True
    kinds = int(alphabet.sum())
    number = np.cumsum(alphabet, dtype=np.int32) - 1
    ac, bc = ai * kinds + number[ac], bi * kinds + number[bc]
    ca, cb = (np.bincount(c, minlength=count * kinds).reshape(count, kinds) for c in (ac, bc))
    # characters without a partner of their kind; the counts bound the distance from below
    out = np.maximum(np.maximum(ca - cb, 0).sum(1), np.maximum(cb - ca, 0).sum(1)) <= k
    act = np.flatnonzero(out)
    if not len(act):
        return out
    # the characters of each shorter text numbered from 1
    own = np.cumsum(ca > 0, 1, dtype=np.int32) * (ca > 0)
    kinds = int(own.max()) + 1
    own = own.ravel()
    words = int(-(-m.max() // 64))
    eq = np.zeros(words * count * kinds, np.uint64)
    np.add.at(eq, ((aj >> 6) * count + ai) * kinds + own[ac], one << (aj & 63).astype(np.uint64))
    eq = eq.reshape(words, -1)
    sym = np.zeros((int(n.max()), count), np.int64)
    sym[bj, bi] = own[bc]
    sym += np.arange(count) * kinds
    pv, mv = np.full((words, len(act)), ~np.uint64(0)), np.zeros((words, len(act)), np.uint64)
    top, bit = (m - 1) >> 6, ((m - 1) & 63).astype(np.uint64)
    d = m.astype(np.int64)[act]
    top, bit, rest, most = top[act], bit[act], n[act], k[act]
    lane = np.arange(len(act))
    # a path of k edits at most stays between these diagonals, as k holds the difference in length and each step aside
    longer = (n - m)[act]
    above, below = int(((most + longer + 1) // 2).max()), int(((most - longer) // 2).max())
    for j in range(int(n.max())):
        # words outside the band stand still: their cells grow by 1 along the row above it and down the column below it, so no cell is less than it should be
        u, v = min(max(0, (j - above) >> 6), words - 1), min(words, ((j + below) >> 6) + 1)
        e, p, q = eq[u:v, sym[j, act]], pv[u:v], mv[u:v]
        xv = e | q
        t = e & p
        t += p
        carry = t < p
        for w in range(1, v - u):
            t[w] += carry[w - 1]
            carry[w] |= carry[w - 1] & (t[w] == 0)
        t ^= p
        t |= e  # where the distance stays or falls along the row
        ph = ~(t | p)
        ph |= q
        mh = p & t
        if v == words:
            last, at = np.maximum(top - u, 0), bit
        else:
            last, at = np.clip(top - u, 0, v - u - 1), np.where(top < v, bit, np.uint64(63))
        d += (ph[last, lane] >> at & one).astype(np.int64) - (mh[last, lane] >> at & one).astype(np.int64)
        up, down = ph << one, mh << one
        up[1:] |= ph[:-1] >> np.uint64(63)
        down[1:] |= mh[:-1] >> np.uint64(63)
        up[0] |= one
        np.bitwise_not(xv | up, out=p)
        p |= down
        np.bitwise_and(up, xv, out=q)
        end = rest == j + 1
        if j & 15 == 15 or end.any():
            far = d - (rest - j - 1) > most
            if j & 31 == 31:
                far |= _column_bound(pv, mv, j + 1, m[act], rest) > most
            out[act[far]] = False
            go = ~(far | end)
            act, pv, mv, d = act[go], pv[:, go], mv[:, go], d[go]
            top, bit, rest, most, lane = top[go], bit[go], rest[go], most[go], lane[: len(act)]
            if not len(act):
                break
    return out


def _column_bound(pv: np.ndarray, mv: np.ndarray, j: int, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What the distances of lanes come to at least after j columns: the least over all runs of 16 rows.

    Within a run between values a and b no cell is below (a + b - 16) / 2; what
    is left of the two texts differs in length by a known number at least.
    """
    words, lanes = pv.shape
    shift = (np.arange(4, dtype=np.uint64) * np.uint64(16))[None, :, None]
    low = np.uint64(0xFFFF)
    step = np.bitwise_count((pv[:, None] >> shift) & low).astype(np.int32) - np.bitwise_count((mv[:, None] >> shift) & low)
    end = j + np.cumsum(step.reshape(words * 4, lanes), 0)
    start = np.concatenate([np.full((1, lanes), j), end[:-1]])
    row = (np.arange(words * 4) * 16)[:, None]
    left = np.maximum(np.abs((m - row - 8) - (n - j)) - 8, 0)
    return np.where(row < m, (start + end - 16 + 1) // 2 + left, 1 << 30).min(0)


def gram_cells(codes: np.ndarray) -> np.ndarray:
    """The cell among CELLS of the 3-gram at each place."""
    n = len(codes)
    pad = np.concatenate([codes, np.zeros(2, codes.dtype)]).astype(np.uint64)
    h = ((pad[:n] * _B + pad[1 : n + 1]) * _B + pad[2 : n + 2]) * _MUL
    return (h >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def spoiled(cells: np.ndarray, off: np.ndarray, x: np.ndarray, y: np.ndarray, k: np.ndarray) -> np.ndarray:
    """3-grams of the longer text x that edits to y spoil at least, for pairs within k: an edit spoils three at most.

    All others stand in y, moved to the left by the half of k and the difference
    in length at most, and to the right by the half of k without it. A cell has
    a bit for each of 64 places or fewer at which y holds a gram of it.
    """
    n, size = len(x), np.diff(off)
    m, less = size[x], size[x] - size[y]
    shift = np.ceil(np.log2(np.maximum(m, 64) / 64)).astype(np.int64)
    mx, my = np.maximum(m - 2, 0), np.maximum(size[y] - 2, 0)
    at, place = _spans(off[y], my), _spans(np.zeros(n, np.int64), my)
    has_ = np.zeros(n * CELLS, np.uint64)
    np.bitwise_or.at(has_, np.repeat(np.arange(n) * CELLS, my) + cells[at], np.uint64(1) << (place >> np.repeat(shift, my)).astype(np.uint64))
    # the bits in reach of each of x's places
    own = np.arange(64)
    lo = np.maximum((own << shift[:, None]) - ((k + less) // 2)[:, None], 0) >> shift[:, None]
    hi = np.clip(((own + 1 << shift[:, None]) - 1 + ((k - less) // 2)[:, None]) >> shift[:, None], 0, 63)
    reach = ((~np.uint64(0) << np.minimum(lo, 63).astype(np.uint64)) & (~np.uint64(0) >> (63 - hi).astype(np.uint64))).ravel()
    at, place = _spans(off[x], mx), _spans(np.zeros(n, np.int64), mx)
    pair = np.repeat(np.arange(n), mx)
    got = has_[pair * CELLS + cells[at]] & reach[(pair << 6) + (place >> shift[pair])]
    return np.bincount(pair[got == 0], minlength=n)


def surely_near(codes: np.ndarray, off: np.ndarray, x: np.ndarray, y: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Pairs that are within k by an alignment at hand.

    Its anchors are 4-grams that both texts hold once (by their cell among
    ANCHOR_CELLS), in the same order; what lies between two anchors is compared
    place by place where it is as long in both texts, else replaced.
    """
    n, size = len(x), np.diff(off)
    ok = np.zeros(n, bool)
    got = []
    for t in (x, y):
        m = np.maximum(size[t] - 3, 0)
        pair, at = np.repeat(np.arange(n), m), _spans(off[t], m)
        h = np.zeros(len(at), np.uint64)
        for j in range(4):
            h = (h + codes[at + j] + np.uint64(1)) * _B
        h = _mix(h)
        cell = pair * ANCHOR_CELLS + (h >> np.uint64(40)).astype(np.int64) % ANCHOR_CELLS
        got.append((pair, at, h, cell, np.bincount(cell, minlength=n * ANCHOR_CELLS)))
    (pair, at, h, cell, cx), (_, at2, h2, cell2, cy) = got
    where = np.zeros(n * ANCHOR_CELLS, np.int64)
    where[cell2] = np.arange(len(cell2))
    use = np.flatnonzero((cx[cell] == 1) & (cy[cell] == 1))
    to = where[cell[use]]
    same = h[use] == h2[to]
    use, to = use[same], to[same]
    pair, i, j = pair[use], at[use], at2[to]  # places in codes
    j = j - off[y][pair] + (pair << 32)  # from here on grows from pair to pair
    for _ in range(3):  # leave out what stands out of order
        bad = (j < np.maximum.accumulate(j)) | (j > np.minimum.accumulate(j[::-1])[::-1])
        if not bad.any():
            break
        d = j - i
        line = np.median(np.stack([np.roll(d, s) for s in (-2, -1, 0, 1, 2)]), 0)
        stray = bad & (d != line)
        keep_ = ~(stray if stray.any() else bad)
        pair, i, j = pair[keep_], i[keep_], j[keep_]
    if not len(pair):
        return ok
    j = (j & 0xFFFFFFFF) + off[y][pair]
    head = np.flatnonzero(np.concatenate([[True], np.diff(pair) != 0]))
    tail = np.concatenate([head[1:], [len(pair)]]) - 1
    which = pair[head]
    inner = np.flatnonzero(pair[1:] == pair[:-1])
    # stretches between anchors: before the first, between two, after the last
    a = np.concatenate([off[x][which], i[inner] + 4, i[tail] + 4])
    b = np.concatenate([off[y][which], j[inner] + 4, j[tail] + 4])
    la = np.concatenate([i[head], i[inner + 1], off[x + 1][which]]) - a
    lb = np.concatenate([j[head], j[inner + 1], off[y + 1][which]]) - b
    of = np.concatenate([which, pair[inner], which])
    even = (la == lb) & (la > 0)
    cost = np.where(even, 0, np.maximum(la, lb) - np.minimum(np.minimum(la, lb), 0))
    total = np.bincount(of, cost, n)
    la, wa, wb, of = la[even], a[even], b[even], of[even]
    total += np.bincount(np.repeat(of, la), codes[_spans(wa, la)] != codes[_spans(wb, la)], n)
    straight = np.bincount(pair[inner], (j[inner + 1] <= j[inner]) | (i[inner + 1] <= i[inner]), n) == 0
    ok[which] = True
    return ok & straight & (total <= k)


def close_pairs(texts: pa.Array, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of the pairs of texts within MAX_EDITS: bounds from both sides first, then the distance."""
    codes, off = to_codes(texts)
    size = np.diff(off)
    x, y = np.where(size[x] >= size[y], x, y), np.where(size[x] >= size[y], y, x)
    k = (MAX_EDITS * size[x] + 1e-9).astype(np.int64)
    yes = [np.zeros(0, np.int64)]
    some = np.flatnonzero((size[x] - size[y] <= k) & (size[x] > 1))
    rest = [np.zeros(0, np.int64)]
    cells = gram_cells(codes)
    for lo, hi in _cuts(np.cumsum(np.maximum(size[x][some], MIN_CHARS)), 1 << 16):
        i = some[lo:hi]
        i = i[spoiled(cells, off, x[i], y[i], k[i]) <= 3 * k[i]]
        near = surely_near(codes, off, x[i], y[i], k[i])
        yes.append(i[near])
        rest.append(i[~near])
    i = np.concatenate(rest)
    yes.append(i[within_many(codes, off, x[i], y[i], k[i])])
    return np.concatenate(yes)


def _compare_batches(sample: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(sample)
        for batch in batches:
            for part in pieces(batch, 2, 1 << 20):
                n = part.num_rows
                texts = packer.unpack(pa.concat_arrays([part.column(2), part.column(3)]))
                ok = close_pairs(texts, np.arange(n), np.arange(n) + n)
                yield part.select([0, 1]).take(pa.array(ok))

    return run


def decide(pairs: DataFrame, texts: DataFrame, n_pairs: int, sample: bytes) -> DataFrame:
    """Written table of _q, _pb: the pairs (_q, _p, _pb) whose texts are within MAX_EDITS."""
    one = lambda side, name: maybe_in(texts, "_node", pairs, side, n_pairs).select(F.col("_node").alias(side), F.col("_text").alias(name))
    j = pairs.join(one("_p", "_tp"), "_p").join(one("_q", "_tq"), "_q")
    return materialize(j.select("_q", "_pb", "_tq", "_tp").mapInArrow(_compare_batches(sample), "_q long, _pb long"), "decided")


def _source_rows(news: DataFrame, drop: DataFrame | None, id_col: str, batch, source: str, text: str) -> DataFrame:
    src = news.select(F.col(id_col).cast("long").alias("_id"), batch.cast("long").alias("_batch"), F.col(text).alias("_c"), F.col(source).alias("_source"))
    src = src.filter(F.col("_c").rlike(r"(?U)\S"))
    # a row per source, whose lines each stand in a tenth of its rows
    return src.withColumn("_drop", F.lit(None).cast("array<long>")) if drop is None else src.join(F.broadcast(drop), "_source", "left")


class HistoryIndex:
    """Index of all accepted batches in a folder all executors share; a batch is checked without reprocessing history.

    ``nodes-*`` hold the distinct texts with their keys, ``graphs-*`` the
    segments of each shard: nodes, signatures, lists and links. ``add`` sends
    the new texts' routes to their shards, opens the stored segments of those
    shards only, searches them, and writes the shards' new segments; graphs are
    rebuilt only where segments are compacted (``feed``). After MAX_PARTS tables
    of graphs, ``vacuum`` rewrites the segments in force, over twice as many
    shards where they have grown too large. A version of the state names the
    tables in force; it comes into force by one exclusive creation after all else
    is written, so a run that dies leaves the index as it was and can be
    repeated. The commonness of grams is fitted on the first call.
    """

    MAX_PARTS = 8

    def __init__(self, spark, path: str, shard_entries: int = SHARD_ENTRIES):
        self.spark, self.path, self.shard_entries = spark, path.rstrip("/"), shard_entries
        self.versions = Versions(spark, self.path)

    def _new(self, kind: str) -> str:
        return f"{kind}-{uuid.uuid4().hex}"

    def _write(self, df: DataFrame, kind: str) -> str:
        name = self._new(kind)
        df.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        return name

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{x}" for x in names])

    def _fitted(self, name: str) -> tuple[np.ndarray, bytes]:
        row = self._read([name]).first()
        return np.frombuffer(bytes(row["common"]), np.uint8), bytes(row["sample"])

    def add(self, news: DataFrame, drop: DataFrame | None = None, id_col: str = "seq", source: str = "source", text: str = "content", batch: str | None = None) -> DataFrame:
        """id of each row that repeats a text of an earlier batch; the other texts become history. Ids are unique over all calls.

        batch: column of batch numbers, all higher than those of earlier calls;
        none: the rows are one batch. drop: _source, _drop (lines to leave out).
        """
        with shuffles_deleted(self.spark):
            return self._add(news, drop, id_col, source, text, batch)

    def _add(self, news: DataFrame, drop: DataFrame | None, id_col: str, source: str, text: str, batch: str | None) -> DataFrame:
        number, state = self.versions.latest()
        state = state or {"fit": None, "shards": 0, "nodes": [], "graphs": [], "last": -1, "entries": 0}
        src = _source_rows(news, drop, id_col, F.lit(state["last"] + 1) if batch is None else F.col(batch), source, text)
        if state["fit"] is None:
            common, sample = fit(src, "_c", "_id")
            fitted = self.spark.createDataFrame([(bytearray(common.tobytes()), bytearray(sample))], "common binary, sample binary")
            state["fit"] = self._write(fitted.coalesce(1), "fit")
        else:
            common, sample = self._fitted(state["fit"])
        rows = src.select("_id", "_batch", "_c", "_drop").mapInArrow(_canon_batches(sample), "_id long, _batch long, _key binary, _text binary")
        rows, canon = written(rows.filter("_key is not null"), "canon")
        total, lo, hi = rows.agg(F.count(F.lit(1)), F.min("_batch"), F.max("_batch")).first()
        if not total:
            return rows.select(F.col("_id").alias(id_col))
        if batch is not None and state["graphs"] and lo <= state["last"]:
            raise ValueError(f"batch {lo} isn't higher than the last one, {state['last']}")
        nodes = rows.groupBy("_key").agg(F.min(F.struct("_batch", "_id")).alias("_m"), F.first("_text").alias("_text"), F.count(F.lit(1)).alias("_n"))
        nodes = nodes.select("_key", F.col("_m._batch").alias("_first"), F.col("_m._id").alias("_node"), "_text", "_n")
        again = None
        if state["nodes"]:
            nodes = materialize(nodes, "batch-nodes")
            old = maybe_in(self._read(state["nodes"]).select("_key"), "_key", nodes, "_key", total).distinct()
            again = nodes.join(old, "_key", "left_semi").select("_key", F.lit(lo - 1).alias("_since"), "_n")
            nodes = nodes.join(old, "_key", "left_anti")
        state["nodes"].append(self._write(nodes, "nodes"))
        nodes = self._read(state["nodes"][-1:])
        keys = materialize(rows.select("_id", "_batch", "_key"), "canon-keys")
        delete_path(self.spark, canon)  # its texts stand in the nodes
        near = self._search(state, nodes, total, common, sample)
        known = nodes.select("_key", "_node", "_first", "_n").join(near, "_node", "left")
        known = known.select("_key", F.least("_first", "_near").alias("_since"), "_first", "_n").filter((F.col("_n") > 1) | (F.col("_since") < F.col("_first")))
        known = known.select("_key", "_since", "_n")
        known = materialize(known if again is None else known.unionByName(again), "known")
        found = materialize(_later(keys, known, total).select(F.col("_id").alias(id_col)), "found")
        state["last"] = hi
        gone = self.vacuum(state) if len(state["graphs"]) > self.MAX_PARTS else []
        self.versions.commit(number + 1, state)
        for g in gone:
            delete_path(self.spark, f"{self.path}/{g}")
        return found

    def _search(self, state: dict, nodes: DataFrame, total: int, common: np.ndarray, sample: bytes) -> DataFrame:
        """_node, _near (a batch): the new nodes that repeat an earlier one; their segments are written."""
        state["shards"] = state["shards"] or max(1, math.ceil(total * ROUTES / self.shard_entries))
        texts = nodes.filter("_text is not null")
        entries = texts.select("_node", "_first", "_text").mapInArrow(_entry_batches(common, sample, state["shards"]), "_shard int, _entries binary")
        buckets = max(MIN_BUCKETS, math.ceil(total / BUCKET))
        if state["graphs"]:
            entries = materialize(entries, "entries")
            stored = self._read(state["graphs"]).filter("_graph is not null").select("_shard", "_graph")
            touched = entries.select("_shard").distinct()
            if state["shards"] <= 10_000:  # so that only those shards' row groups are read
                stored = stored.filter(F.col("_shard").isin([r[0] for r in touched.collect()]))
            else:
                stored = stored.join(touched, "_shard", "left_semi")
            out = entries.groupBy("_shard").cogroup(stored.groupBy("_shard")).applyInArrow(_feed_both(buckets), _SHARD_OUT)
        else:
            out = entries.groupBy("_shard").applyInArrow(_first_feed(buckets), _SHARD_OUT)
        state["graphs"].append(self._write(out, "graphs"))
        state["entries"] += total * ROUTES
        pairs = self._read(state["graphs"][-1:]).filter("_pairs is not null").select("_bucket", "_pairs")
        # of each query the most similar one, and at most WIDTH from each of its shards that are compared in any case
        found = materialize(pairs.groupBy("_bucket").applyInArrow(_ends, "_q long, _p long, _pb long, _top boolean"), "found-near")
        top = found.filter("_top").drop("_top")
        stock = self._read(state["nodes"]).filter("_text is not null").select("_node", "_text")
        yes = decide(top, stock, top.count(), sample)
        rest = materialize(found.filter("not _top").drop("_top").join(yes.select("_q"), "_q", "left_anti"), "rest")
        yes = yes.unionByName(decide(rest, stock, rest.count(), sample))
        return yes.groupBy(F.col("_q").alias("_node")).agg(F.min("_pb").alias("_near"))

    def vacuum(self, state: dict) -> list[str]:
        """One table of the segments in force instead of many; the names of those it replaces."""
        old, factor = state["graphs"], 1
        while state["entries"] > 4 * self.shard_entries * state["shards"] * factor:
            factor *= 2
        state["shards"] *= factor
        kept = self._read(old).filter("_graph is not null").select("_shard", "_graph")
        out = kept.groupBy("_shard").applyInArrow(_rewrite(state["shards"]), _SHARD_OUT)
        state["graphs"] = [self._write(out.repartition("_shard").sortWithinPartitions("_shard"), "graphs")]
        return old


def _rewrite(shards: int):
    def run(key: tuple, stored: pa.Table) -> pa.Table:
        rows = []
        for s in live([Segment.unpack(x) for x in stored.column("_graph").to_pylist()]):
            shard = (_mix(s.gram.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
            for k in np.unique(shard).tolist():
                m = shard == k
                w = s.who[m]
                part = s if m.all() else Segment.of(s.lo, s.hi, s.gram[m], s.node[w], s.batch[w], s.sig[w], s.size[w])
                rows.append((k, s.lo, s.hi, part.pack()))
        shard, lo, hi, graph = zip(*rows) if rows else ((), (), (), ())
        none = [None] * len(rows)
        return _shard_table([shard, none, none, lo, hi, graph])

    return run


def find_repeats(news: DataFrame, drop: DataFrame | None, id_col: str = "seq", batch: str = "batch_no", source: str = "source", text: str = "content") -> DataFrame:
    """id of each row whose text repeats one of a lower batch: all batches fed into a new index."""
    spark = news.sparkSession
    path = f"{shared_dir(spark)}/history-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    return HistoryIndex(spark, path).add(news, drop, id_col, source, text, batch)


def _later(rows: DataFrame, known: DataFrame, total: int) -> DataFrame:
    """Rows of a batch after their text's first one; texts with a large part of all rows (a bounded number) apart."""
    bound = max(total // 2048, 1000)
    hot = known.filter(F.col("_n") > bound).select(F.col("_key").alias("_k"), "_since")
    rows = maybe_in(rows, "_key", known, "_key", known.count())
    tag = rows.join(F.broadcast(hot), F.col("_key") == F.col("_k"), "left")
    a = tag.filter("_k is not null and _batch > _since").select("_id")
    b = tag.filter("_k is null").select("_id", "_batch", "_key").join(known.filter(F.col("_n") <= bound).select("_key", "_since"), "_key").filter("_batch > _since").select("_id")
    return a.unionByName(b)
