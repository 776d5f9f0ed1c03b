"""Visually identical text with different characters brought to one form (problem 7).

Quick check: a table over code points marks the characters that no context can
change (mapped one to one by width, compatibility, space and look-alike rules)
and those that are unstable (combining marks, characters that expand or
compose). Texts without unstable characters are done by one table lookup per
batch. In the others only the unstable segments, each with the character before
it as boundary context, are normalised, and the canonical segments are spliced
into the unchanged text.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

from flashmill.kernel import DELETE, TABLE_SIZE, _all_chars, keep, lookup, owner, to_codes

#: Cyrillic and Greek letters that look like a Latin letter.
LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТХУЅІЈаеорсухѕіј" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧο" + "ԁһԛԝӏ" + "αγικνρυϲϹϳͿ" + "ӀԚԜҮүҒѵѴ",
        "ABEKMHOPCTXYSIJaeopcyxsij" + "ABEZHIKMNOPTYXo" + "dhqwl" + "ayikvpucCjJ" + "IQWYyFvV",
    )
)
#: Ranges of the characters without a glyph of their own (Unicode's default ignorable code points).
IGNORABLE = [
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F),
    (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
]
INVISIBLE = frozenset(chr(c) for a, b in IGNORABLE for c in range(a, b + 1))
UNSTABLE = 0xFFFFFFFE


def canonical(s: str) -> str:
    """The form of a whole string, character by character rules and composition; the reference for segments and tables."""
    d = unicodedata.normalize("NFKD", "".join(c for c in s if c not in INVISIBLE))
    m = "".join(" " if unicodedata.category(c) == "Zs" else LOOKALIKES.get(c, c) for c in d if c not in INVISIBLE)
    return unicodedata.normalize("NFKC", m)


@lru_cache(1)
def looks_table() -> np.ndarray:
    """Canonical code point of each stable character, DELETE for invisible ones, UNSTABLE where context decides."""
    out = np.arange(TABLE_SIZE, dtype=np.uint32)
    norm, comb = unicodedata.is_normalized, unicodedata.combining
    for c, ch in _all_chars():
        if c < 128 or 0x4E00 <= c < 0xA000 or 0xAC00 <= c < 0xD7A4 or 0x20000 <= c < 0x2A6E0:
            continue
        if 0x1160 <= c < 0x1200 or comb(ch):
            out[c] = UNSTABLE
        elif ch in LOOKALIKES or ch in INVISIBLE or not norm("NFKC", ch) or not norm("NFKD", ch) or unicodedata.category(ch) == "Zs":
            r = canonical(ch)
            out[c] = DELETE if not r else ord(r) if len(r) == 1 and not comb(r) else UNSTABLE
    return out


@lru_cache(1)
def _segments() -> re.Pattern:
    t = looks_table()
    bad = np.flatnonzero(t == UNSTABLE)
    cuts = np.flatnonzero(np.diff(bad) > 1)
    runs = zip(bad[np.concatenate([[0], cuts + 1])], bad[np.concatenate([cuts, [len(bad) - 1]])])
    cls = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)
    return re.compile(f"[^{cls}]?[{cls}]+")


_drop_invisible = dict.fromkeys(map(ord, INVISIBLE))


@lru_cache(65536)
def _segment(s: str) -> str:
    return canonical(s)


def splice(s: str) -> str:
    """s with its unstable segments in canonical form; the rest unchanged but for invisible characters."""
    return _segments().sub(lambda m: _segment(m.group()), s.translate(_drop_invisible))


def looks(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of the canonical forms of a string array; null is ''."""
    codes, off = to_codes(arr)
    out = lookup(looks_table(), codes)
    if len(codes) and codes.max() >= 0xE0000:
        out = np.where((codes >= 0xE0000) & (codes <= 0xE0FFF), np.uint32(DELETE), out)
    bad = out == UNSTABLE
    if bad.any():
        rows = np.unique(owner(off)[np.flatnonzero(bad)])
        text = arr.take(pa.array(rows)).to_pylist()
        fixed = pa.array([splice(x) for x in text], pa.string())
        c2, o2 = to_codes(fixed)
        c2 = lookup(looks_table(), c2)
        c2 = np.where(c2 == UNSTABLE, to_codes(fixed)[0], c2)  # what stays a mark after composition is canonical
        pieces, lens = [], np.diff(off).copy()
        at = 0
        for i, r in enumerate(rows.tolist()):
            pieces += [out[off[at] : off[r]], c2[o2[i] : o2[i + 1]]]
            lens[r] = o2[i + 1] - o2[i]
            at = r + 1
        pieces.append(out[off[at] :])
        out = np.concatenate(pieces)
        off = np.concatenate([[0], np.cumsum(lens)])
    return keep(out, off, out != DELETE)
