"""Language of documents and lines by prediction with partial matching (problem 10).

For each language a context tree over bytes of up to ORDER bytes of context is
counted on a bounded sample of labelled documents, with escape probabilities of
method C. The statistics are frozen into one table: for each context and byte
seen in any language the code length in every language, and for each context
its escape cost. A line's code length is then a sum of table rows; the shortest
names the language and the lengths' differences give the confidence. Labels of
the sample may be wrong and its texts mixed: the trees are counted again from
the lines whose code length agrees with their label.

Null, blank and letterless texts have no language and give no rows; a line is a
part between newlines; ties go to the language that comes first in LANGUAGES.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flashmill.kernel import category_masks, expand_folds, fold_table, has, lookup, pieces, to_codes
from flashmill.llm.looks import looks

LANGUAGES = ("zh", "en", "de", "fr", "es", "pt", "ja")
#: Other ways to write the languages' names.
NAMES = {
    "zh": ("zh", "zho", "chi", "chinese"),
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german"),
    "fr": ("fr", "fra", "fre", "french"),
    "es": ("es", "spa", "spanish"),
    "pt": ("pt", "por", "portuguese"),
    "ja": ("ja", "jpn", "japanese"),
}
ORDER = 4
#: Sample: documents read for it, and lines of one language used, at most.
SAMPLE_DOCS = 4000
SAMPLE_LINES = 500
MIN_LETTERS = 20
MIN_DOC_LETTERS = 40

_MUL = np.uint64(0x9E3779B97F4A7C15)


def label_language(label: Column) -> Column:
    """The language a label names, however written; null if it names none of LANGUAGES."""
    name = F.regexp_extract(F.lower(F.trim(label)), r"^([a-z]+)", 1)
    out = F.lit(None).cast("string")
    for lang, names in NAMES.items():
        out = F.when(name.isin(*names), lang).otherwise(out)
    return out


class Lines:
    """The lines of a batch of texts as bytes of lower-case words, one blank between them."""

    def __init__(self, arr: pa.Array):
        masks = category_masks()
        raw, off0 = to_codes(arr)
        n = len(arr)
        nl0 = raw == 10
        per = np.concatenate([[0], np.cumsum(nl0)])
        count = per[off0[1:]] - per[off0[:-1]] + 1
        self.doc = np.repeat(np.arange(n), count)
        base = np.cumsum(count) - count
        self.no = np.arange(len(self.doc)) - np.repeat(base, count) + 1
        line0 = per[:-1] + np.repeat(np.arange(n), np.diff(off0))
        self.letters = np.bincount(line0[has(masks["letter"], raw)], minlength=len(self.doc))
        codes, off = looks(expand_folds(arr))
        nl = codes == 10
        line = np.concatenate([[0], np.cumsum(nl)])[:-1] + np.repeat(np.arange(n), np.diff(off))
        word = has(masks["letter"], codes)
        codes = np.where(word, lookup(fold_table(), codes), np.uint32(32))
        gap = ~word
        again = gap.copy()
        again[1:] &= gap[:-1] & (line[1:] == line[:-1])
        again[:1] = False
        ok = ~nl & ~again
        codes, line = codes[ok], line[ok]
        width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        self.bytes = np.frombuffer(codes.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8"), np.uint8)
        self.line = np.repeat(line, width)
        first = np.searchsorted(self.line, np.arange(len(self.doc)))
        self.at = np.arange(len(self.bytes)) - first[self.line] if len(self.bytes) else np.zeros(0, np.int64)


def gram_keys(b: np.ndarray, order: int) -> np.ndarray:
    """Exact key of the context of ``order`` bytes and the byte at each place."""
    n = len(b)
    key = np.zeros(n, np.uint64)
    for j in range(order, -1, -1):
        key <<= np.uint64(8)
        key[j:] |= b[: n - j].astype(np.uint64)
    return key | np.uint64((order + 1) << 56)


def context_keys(b: np.ndarray, order: int) -> np.ndarray:
    """Exact key of the context of ``order`` bytes before each place; apart from gram keys."""
    return (gram_keys(b, order) >> np.uint64(8)) & np.uint64((1 << 48) - 1) | np.uint64((0x40 + order) << 56)


class Table:
    """Open-addressed table of uint64 keys to row numbers, built and probed as whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(10, int(math.ceil(math.log2(max(len(keys), 1) * 4))))
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        left, probe = np.arange(len(keys)), 0
        while len(left):
            s = self._slot(keys[left], probe)
            free = self.keys[s] == 0
            cand, cs = left[free], s[free]
            u, first = np.unique(cs, return_index=True)
            self.keys[u], self.rows[u] = keys[cand[first]], cand[first]
            put = np.zeros(len(keys), bool)
            put[cand[first]] = True
            left = left[~put[left]]
            probe += 1
        self.probes = probe

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return (((keys * _MUL) >> np.uint64(64 - self.bits)).astype(np.int64) + probe * 7) & ((1 << self.bits) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        s = self._slot(keys, 0)
        at = self.keys[s]
        out = np.where(at == keys, self.rows[s], -1)
        left = np.flatnonzero((at != keys) & (at != 0))
        for probe in range(1, self.probes):
            if not len(left):
                break
            s = self._slot(keys[left], probe)
            at = self.keys[s]
            hit = at == keys[left]
            out[left[hit]] = self.rows[s[hit]]
            left = left[~hit & (at != 0)]
        return out


class Model:
    """Frozen statistics of all languages."""

    def __init__(self, samples: list[Lines], masks: list[np.ndarray] | None = None):
        """samples: the lines of each language; masks: which lines count."""
        n_lang = len(samples)
        stats = []  # per order: gram keys, counts [grams, languages]
        for k in range(ORDER + 1):
            keys, counts = [], []
            for i, s in enumerate(samples):
                ok = s.at >= k
                if masks is not None:
                    ok &= masks[i][s.line]
                u, c = np.unique(gram_keys(s.bytes, k)[ok], return_counts=True)
                keys.append(u)
                counts.append(c)
            every = np.unique(np.concatenate(keys))
            m = np.zeros((len(every), n_lang), np.float64)
            for i in range(n_lang):
                m[np.searchsorted(every, keys[i]), i] = counts[i]
            stats.append((every, m))
        all_keys, all_cost, esc_keys, esc_cost = [], [], [], []
        lower = None
        for k, (every, m) in enumerate(stats):
            ctx = (every >> np.uint64(8)) & np.uint64((1 << 48) - 1) | np.uint64((0x40 + k) << 56)
            uctx, inv = np.unique(ctx, return_inverse=True)
            total = np.zeros((len(uctx), n_lang))
            kinds = np.zeros((len(uctx), n_lang))
            np.add.at(total, inv, m)
            np.add.at(kinds, inv, m > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                esc = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                own = -np.log2(m / (total + kinds)[inv])
            if lower is None:
                below = np.full((len(every), n_lang), 8.0)  # no statistics: all bytes alike
            else:
                lk, lc = lower
                below = lc[np.searchsorted(lk, every & np.uint64((1 << (8 * k)) - 1) | np.uint64(k << 56))]
            cost = np.where(m > 0, own, esc[inv] + below)
            lower = (every, cost)
            all_keys.append(every)
            all_cost.append(cost)
            esc_keys.append(uctx)
            esc_cost.append(esc)
        self.grams, self.cost = Table(np.concatenate(all_keys)), np.concatenate(all_cost).astype(np.float32)
        self.contexts, self.escape = Table(np.concatenate(esc_keys)), np.concatenate(esc_cost).astype(np.float32)

    def lengths(self, x: Lines) -> np.ndarray:
        """Code length in bits of each line in each language."""
        n = len(x.bytes)
        out = np.zeros((len(x.doc), self.cost.shape[1]), np.float64)
        step = 1 << 18
        for a in range(0, n, step):
            b = min(n, a + step)
            lo = max(0, a - ORDER)
            byt, at = x.bytes[lo:b], x.at[a:b]
            cost = np.full((b - a, self.cost.shape[1]), 8.0, np.float32)
            add = None
            left = np.arange(b - a)
            for k in range(ORDER, -1, -1):
                sub = left if k == 0 else left[at[left] >= k]
                if not len(sub):
                    continue
                key = gram_keys(byt, k)[a - lo :]
                row = self.grams.get(key[sub])
                hit = row >= 0
                cost[sub[hit]] = self.cost[row[hit]]
                miss = sub[~hit]
                if len(miss):
                    e = self.contexts.get(context_keys(byt, k)[a - lo :][miss])
                    has_e = e >= 0
                    if has_e.any():
                        if add is None:
                            add = np.zeros((b - a, self.cost.shape[1]), np.float32)
                        add[miss[has_e]] += self.escape[e[has_e]]
                got = np.zeros(b - a, bool)
                got[sub[hit]] = True
                left = left[~got[left]]
            if add is not None:
                cost += add
            line = x.line[a:b]
            first = np.concatenate([[0], np.flatnonzero(np.diff(line)) + 1])
            out[line[first]] += np.add.reduceat(cost, first, axis=0, dtype=np.float64)
        return out


def train(samples: dict[str, list[str]]) -> Model:
    """Model of LANGUAGES from sample texts by label; rounds that drop lines which read better in another language."""
    xs = [Lines(pa.array(samples.get(lang, []), pa.string())) for lang in LANGUAGES]
    masks = []
    for x in xs:
        ok = np.flatnonzero(x.letters >= MIN_LETTERS)[:SAMPLE_LINES]
        m = np.zeros(len(x.doc), bool)
        m[ok] = True
        masks.append(m)
    # a tree knows its own lines by heart, so each half of the documents is judged by the trees of the other half
    for _ in range(2):
        keep = [m.copy() for m in masks]
        for half in (0, 1):
            model = Model(xs, [m & (x.doc % 2 != half) for x, m in zip(xs, masks)])
            for i, (x, m) in enumerate(zip(xs, masks)):
                if m.any():
                    keep[i] &= (x.doc % 2 != half) | (model.lengths(x).argmin(1) == i)
        masks = keep
    return Model(xs, masks)


def fit(docs: DataFrame, id_col: str, text: str, label: str) -> Model:
    """Model from at most about SAMPLE_DOCS labelled documents, picked by a hash of their id."""
    total = docs.count()
    src = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_t"), label_language(F.col(label)).alias("_l"))
    src = src.filter(F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(max(1, math.ceil(total / SAMPLE_DOCS)))) == 0).filter("_l is not null and _t is not null")
    got = src.select("_l", "_t").toArrow()
    by: dict[str, list[str]] = {}
    for lang, t in zip(got.column(0).to_pylist(), got.column(1).to_pylist()):
        by.setdefault(lang, []).append(t)
    return train(by)


def _classify(model_of, all_lines: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of()
        names = np.array(LANGUAGES)
        for batch in batches:
            for part in pieces(batch, 1, 1 << 20):
                x = Lines(part.column(1))
                bits = model.lengths(x)
                best = bits.argmin(1)
                n = part.num_rows
                # documents: letters by language
                share = np.zeros((n, len(LANGUAGES)))
                np.add.at(share, (x.doc, best), x.letters)
                total = share.sum(1)
                main = share.argmax(1)
                label = part.column(2).to_pylist()
                long = x.letters >= MIN_LETTERS
                langs = np.zeros((n, len(LANGUAGES)), bool)
                langs[x.doc[long], best[long]] = True
                mixed = langs.sum(1) >= 2
                wrong = np.array([total[i] >= MIN_DOC_LETTERS and label[i] != LANGUAGES[main[i]] for i in range(n)], bool)
                d = np.flatnonzero(total > 0) if all_lines else np.flatnonzero(wrong)
                s = np.flatnonzero(long & mixed[x.doc])
                diff = bits[s] - bits[s].min(1, keepdims=True) if len(s) else np.zeros((0, len(LANGUAGES)))
                conf = np.concatenate([share[d, main[d]] / np.maximum(total[d], 1), 1 / np.exp2(-np.minimum(diff, 500)).sum(1)])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.concatenate([d, x.doc[s]]).astype(np.int64))),
                        pa.array(np.concatenate([np.zeros(len(d), np.int64), x.no[s]])),
                        pa.array(names[np.concatenate([main[d], best[s]])].tolist(), pa.string()),
                        pa.array(conf),
                        pa.array(np.concatenate([wrong[d], np.ones(len(s), bool)])),
                    ],
                    ["_id", "seg_no", "lang", "confidence", "found"],
                )

    return run


def languages(docs: DataFrame, id_col: str, text: str, label: str, everything: bool = True, model: Model | None = None) -> DataFrame:
    """id, seg_no (0: the document, n: line n of a mixed one), lang, confidence, found.

    everything: all documents with letters; else only those whose label is
    missing or wrong. A narrow map; the model is a broadcast of the fitted,
    bounded size.
    """
    spark = docs.sparkSession
    model = model or fit(docs, id_col, text, label)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_t"), label_language(F.col(label)).alias("_l"))
    out = src.mapInArrow(_classify(lambda: shared.value, everything), f"_id {kind}, seg_no long, lang string, confidence double, found boolean")
    return out.withColumnRenamed("_id", id_col)
