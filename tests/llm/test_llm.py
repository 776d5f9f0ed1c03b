import pathlib
import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flashmill.kernel import to_codes, to_strings
from flashmill.llm import copies, language, leaks, lines, looks, neardup, plans, tokens
from flashmill.session import shared_dir

SYL = ["ba", "ke", "mo", "zor", "lin", "tas", "quo", "fel", "dun", "var"]


def name(rnd):
    return "".join(rnd.choice(SYL) for _ in range(3)).title()


def item(rnd, n=4):
    return " ".join(f"{name(rnd)} Mining said output at its {name(rnd)} site changed by {rnd.randint(100, 99999)} tonnes while buyers stayed away." for _ in range(n))


# problem 7
def test_looks_segments_equal_whole_text():
    rnd = random.Random(1)
    chars = "aeé́̈ｶﾞ゙ﬁ…½ＡＢ​­ 　 вСоo각각中Å"
    xs = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 12))) for _ in range(500)] + [None, ""]
    got = to_strings(*looks.looks(pa.array(xs, pa.string()))).to_pylist()
    assert got == [looks.canonical(x or "") for x in xs]
    assert all(unicodedata.is_normalized("NFKC", g) for g in got)


def test_look_pairs(spark):
    rows = [(1, "A", "Сопs"), (2, "A", "Con​s".replace("n", "п")), (3, "A", "Cons"), (4, None, " "), (5, "", None), (6, "A", "Cons"), (7, "A", "cons"), (8, None, "x y"), (9, "", "x y")]
    df = spark.createDataFrame(rows, "seq long, title string, content string").withColumn("_id", F.lit(0)).withColumn("_look", F.lit(0))
    got = {tuple(r) for r in copies.look_pairs(df, "seq", "title", "content").collect()}
    assert got == {(1, 2), (8, 9)}
    assert copies.look_pairs(df.limit(0), "seq", "title", "content").count() == 0


# problem 6
def test_form_copies(spark):
    rows = [(1, "Gold up", "a: 1; b: 2"), (2, "GOLD-UP!", "B：2｜".replace("｜", "|") + "a：1"), (3, "gold up", "b: 2 a: 1"), (4, None, "..."), (5, "", None), (6, None, "Straße"), (7, "", "STRASSE")]
    df = spark.createDataFrame(rows, "seq long, title string, content string").withColumn("_key", F.lit(1))
    assert {tuple(r) for r in copies.form_copies(df, "seq", "title", "content").collect()} == {(1, 2), (6, 7)}
    assert sorted((r["first"], r["copies"]) for r in copies.form_groups(df, "seq", "title", "content").collect()) == [(1, 2), (3, 1), (6, 2)]
    assert copies.form_copies(df.limit(0), "seq", "title", "content").count() == 0


def test_form_copies_of_a_hot_group(spark):
    df = spark.range(9000).select(F.col("id").alias("seq"), F.lit("t").alias("title"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("content"))
    got = copies.form_copies(df, "seq", "title", "content").collect()
    assert len(got) == 2999 and {r["first"] for r in got} == {0}


# problem 4
def test_suffix_array_is_sorted():
    rnd = np.random.default_rng(3)
    ids = rnd.integers(1, 4, 60)
    off = np.array([0, 20, 20, 45, 60])
    text, doc, sa, lcp = lines.suffix_array(ids, off)
    suffixes = [tuple(text[i:]) for i in sa]
    assert suffixes == sorted(suffixes)
    for i in range(1, len(sa)):
        a, b = suffixes[i - 1], suffixes[i]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert lcp[i] == n


def test_repeated_lines_against_counting(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_ROWS", 40)
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        s = rnd.choice(["a", "a", "b", "c", None, " "])
        own = [f"own {name(rnd)}" for _ in range(rnd.randint(0, 3))]
        if rnd.random() < 0.25:
            own.insert(rnd.randint(0, len(own)), f"Share THIS {rnd.randint(1, 99)} story")
        if rnd.random() < 0.09:
            own.append("rare notice")
        rows.append((i, s, None if rnd.random() < 0.05 else "\n".join(own)))
    df = spark.createDataFrame(rows, "seq long, source string, content string").withColumn("_lines", F.lit(1))
    hits, _ = lines.repeated_lines(lines.line_table(df, "seq", "source", "content"))
    got = {(r._id, r._no) for r in hits.collect()}
    key = lambda x: "".join(c for c in x.casefold() if not c.isspace() and not c.isdecimal())
    want = set()
    for s in "abc":
        mine = [(i, c) for i, t, c in rows if t == s]
        count = {}
        for i, c in mine:
            for k in {key(x) for x in (c or "").split("\n")} - {""}:
                count[k] = count.get(k, 0) + 1
        bad = {k for k, n in count.items() if n >= 5 and n * 10 >= len(mine)}
        want |= {(i, j + 1) for i, c in mine if c for j, x in enumerate(c.split("\n")) if key(x) in bad}
    assert got == want
    out = {r.seq: r.content for r in lines.strip_repeated(df, "seq", "source", "content").collect()}
    for i, _, c in rows:
        assert out[i] == (c if c is None else "\n".join(x for j, x in enumerate(c.split("\n")) if (i, j + 1) not in want))
    assert lines.repeated_lines(lines.line_table(df.limit(0), "seq", "source", "content"))[0].count() == 0


# problem 8
@pytest.fixture(scope="module")
def library():
    tk = pytest.importorskip("tokenizers").Tokenizer.from_file(tokens.VOCABULARY.replace(".tiktoken", ".json"))
    tk.encode_special_tokens = True
    return tk


def test_ids_equal_the_library(spark, library):
    rnd = random.Random(6)
    xs = ["".join(rnd.choice(" '  \n\tsltmdrev.!aé金字本の,12３½ª ’🏭") for _ in range(rnd.randint(0, 40))) for _ in range(800)] + ["<|endoftext|>", "a" * 3000, "x\x1cy\x85z"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*xs, None, ""])], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = {r.doc_id: list(r.ids) for r in tokens.encode_corpus(df, "doc_id", "text").collect()}
    want = [e.ids for e in library.encode_batch(xs, add_special_tokens=False)]
    assert [got[i] for i in range(len(xs))] == want and got[len(xs)] == got[len(xs) + 1] == []


def test_every_plane_has_a_class(library):
    xs = ["a", "a\U00030000b", "\U0003ffffx 1", "\U000e0001", "x\U0010fffd"]
    got = tokens.encoder(tokens.VOCABULARY).encode(pa.array(xs)).to_pylist()
    assert got == [e.ids for e in library.encode_batch(xs, add_special_tokens=False)]


def test_later_letters_are_the_librarys(library):
    xs = [",\ua7da金（A", "\U00010d52,３eA\U00010d5a金（1", "\U0003251a金,\U000330e9\U00032dde，", "1\U00010d40金", "\U00013460金", "\U0003134f金", "\U0003134a金"]
    got = tokens.encoder(tokens.VOCABULARY).encode(pa.array(xs)).to_pylist()
    assert got == [e.ids for e in library.encode_batch(xs, add_special_tokens=False)]
    split = pytest.importorskip("tokenizers").pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    for ranges in (tokens.LATER_LETTERS, tokens.LATER_NUMBERS, tokens.THIRD_PLANE):
        for c in {x for a, b in ranges for x in (a - 1, a, b, b + 1)}:
            codes, off = to_codes(pa.array([f"a{chr(c)}1"]))
            assert int(tokens.pretoken_starts(codes, off).sum()) == len(split(f"a{chr(c)}1")), hex(c)


def test_perfect_hash():
    ranks = tokens.read_ranks(tokens.VOCABULARY)
    some = dict(list(ranks.items())[:5000])
    h = tokens.PerfectHash(some)
    assert all(h.get(k) == v for k, v in some.items()) and h.get(b"not there at all") == -1
    assert sorted(h.slot_val) == sorted(some.values())


# problem 9
def test_leaks(spark):
    rnd = random.Random(8)
    passages = [item(rnd, 3) for _ in range(6)]
    zh = "斯哈库贵金属与特特库莫当地政府就出口许可达成初步安排，多空双方分歧加大。巴维敦冶炼计划9月起调整融资费率的统计口径，预计影响约回落0.30%。"
    items = spark.createDataFrame([(i, p) for i, p in enumerate([*passages, zh, None, ""])], "item_id long, passage string").withColumn("_t", F.lit(1))
    words = passages[1].split()
    for k in range(5, len(words), 12):
        words[k] = "changed"
    half = passages[2][: int(len(passages[2]) * 0.7)]
    docs = [(0, item(rnd) + passages[0].upper() + item(rnd)), (1, item(rnd) + "\n" + "\n".join(words)), (2, half + item(rnd)), (3, item(rnd, 8)), (4, passages[3][:60] + item(rnd) + passages[3][90:140]), (5, "前言" + zh.replace("，", " , ") + "后记"), (6, None), (7, ""), (8, passages[4] + " " + passages[5])]
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", items).collect()}
    assert got == {(0, 0), (1, 1), (2, 2), (5, 6), (8, 4), (8, 5)}


# problem 10
TEXTS = {
    "en": "the smelter managers noted that deliveries had declined and that buyers stayed cautious before the reading",
    "de": "die behörden einigten sich vorläufig über die frachtkosten doch die auftragslage bessert sich weiterhin nicht",
    "fr": "les acheteurs restent prudents parce que les stocks continuent de fondre et les avis sont très partagés",
    "es": "los importadores no dan precios aunque el diferencial se estrecha con rapidez y muchos esperan permisos",
    "pt": "os estoques estão em queda há semanas e a diferença diminui rapidamente devido à manutenção da fundição",
    "zh": "全天成交手数增加投资者等待更多线索冶炼厂检修拖累市场情绪趋于谨慎",
    "ja": "投資家は様子を見ている取引所が証拠金を引き上げたあと受注は少しずつ戻っている",
}


def sample(rnd, lang):
    t = TEXTS[lang]
    if lang in ("zh", "ja"):
        a = rnd.randint(0, 5)
        return t[a:] + t[:a]
    w = t.split()
    a = rnd.randint(0, 4)
    return " ".join(w[a:] + w[:a])


def test_languages(spark):
    rnd = random.Random(9)
    rows, want = [], set()
    for i in range(140):
        lang = language.LANGUAGES[i % 7]
        rows.append((i, "\n".join(sample(rnd, lang) for _ in range(3)), lang))
    rows += [(200, sample(rnd, "en"), "de"), (201, sample(rnd, "fr"), None), (202, sample(rnd, "es"), "Spanish"), (203, sample(rnd, "zh"), "ZH_cn"), (204, sample(rnd, "pt") * 2 + "\n\n" + sample(rnd, "ja"), "pt"), (205, "short", "xx"), (206, None, "en"), (207, " \n", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("seg_no", F.lit(1))
    got = {(r.doc_id, r.seg_no, r.lang) for r in language.languages(df, "doc_id", "text", "lang", everything=False).filter("found").collect()}
    assert got == {(200, 0, "en"), (201, 0, "fr"), (204, 1, "pt"), (204, 3, "ja")}


def test_code_lengths_are_those_of_the_tree():
    m = language.train({k: [v] * 3 for k, v in TEXTS.items()})
    x = language.Lines(pa.array([TEXTS["de"], TEXTS["ja"], "", None]))
    bits = m.lengths(x)
    assert language.LANGUAGES[bits[0].argmin()] == "de" and language.LANGUAGES[bits[1].argmin()] == "ja" and (bits[2:] == 0).all()


# problem 1
def edit(rnd, t, k):
    w = t.split()
    for _ in range(k):
        w[rnd.randrange(len(w))] = rnd.choice(["later", "earlier", str(rnd.randint(1, 999))])
    return " ".join(w)


def distance(a, b):
    """Edit distance by bit vectors."""
    m, full = len(a), (1 << len(a)) - 1
    at = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    pv, mv, d = full, 0, m
    for c in b:
        eq = at.get(c, 0)
        xv, xh = eq | mv, (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (~(xh | pv) & full), pv & xh
        d += (ph >> (m - 1) & 1) - (mh >> (m - 1) & 1)
        ph, mh = (ph << 1 | 1) & full, (mh << 1) & full
        pv, mv = mh | (~(xv | ph) & full), ph & xv
    return d


def repeats(rows):
    """(equal, edited): ids of rows that repeat a row of a lower batch, by comparing all."""
    form = lambda t: "".join(c for c in t if c.isalnum()).casefold()
    keys = [(i, b, ("F", *sorted(form(x) for x in t.replace("\n", ";").split(";"))) if ":" in t else form(t)) for i, b, t in rows if t and t.strip()]
    equal, edited = set(), set()
    for i, b, k in keys:
        for _, c, o in keys:
            if c < b and k == o:
                equal.add(i)
            elif c < b and isinstance(k, str) and isinstance(o, str) and min(len(k), len(o)) >= 100 and i not in edited and distance(k, o) <= 0.2 * max(len(k), len(o)):
                edited.add(i)
    return equal, edited - equal


def corpus(rnd):
    rows, base, planted = [], [item(rnd) for _ in range(150)], set()
    for t in base:
        rows.append((len(rows), 0, t))
    for b in (1, 2):
        for _ in range(60):
            t, kind = rnd.choice(base), rnd.random()
            if 0.3 <= kind < 0.7:
                planted.add(len(rows))
            rows.append((len(rows), b, t.upper().replace(" ", "  ") if kind < 0.3 else edit(rnd, t, 3) if kind < 0.7 else item(rnd)))
    rows += [(len(rows), 2, None), (len(rows) + 1, 2, " "), (len(rows) + 2, 0, "a: 1; b: 2"), (len(rows) + 3, 1, "b:2\na:1"), (len(rows) + 4, 1, "short"), (len(rows) + 5, 2, "short"), (len(rows) + 6, 2, "shorts")]
    equal, edited = repeats(rows)
    # items of one pattern come near each other by chance too; those count as allowed
    return rows, equal, edited, planted & edited


def test_edit_distance_bound():
    rnd = random.Random(13)
    for _ in range(400):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 14))) for _ in range(2))
        d = distance(a, b) if a else len(b)
        for k in range(16):
            assert neardup.within(a, b, k) == (d <= k)


def test_edit_distances_together(monkeypatch):
    monkeypatch.setattr(neardup, "TOGETHER", 50)
    rnd = random.Random(14)
    xs = ["".join(rnd.choice("abcd斯哈") for _ in range(rnd.choice([0, 1, 3, 20, 63, 64, 65, 127, 128, 129, 200]))) for _ in range(60)]
    xs += ["".join(c for c in x if rnd.random() < 0.9) for x in xs]
    codes, off = to_codes(pa.array(xs))
    x, y = (np.array([rnd.randrange(120) for _ in range(1500)]) for _ in range(2))
    x, y = np.concatenate([x, np.arange(60)]), np.concatenate([y, np.arange(60, 120)])
    d = np.array([distance(xs[i], xs[j]) if xs[i] else len(xs[j]) for i, j in zip(x, y)])
    for k in (d, d - 1, d + 1, np.full(len(x), 9)):
        assert (neardup.within_many(codes, off, x, y, k) == (d <= k)).all()


def spread(rnd, t, share, chars):
    t = list(t)
    for i in rnd.sample(range(len(t)), int(share * len(t))):
        t[i] = rnd.choice([c for c in chars if c != t[i]])
    return "".join(t)


def entries(route, sig, node, batch, size, shards=1):
    r = np.sort(route, 1)
    use = r != 0
    use[:, 1:] &= r[:, 1:] != r[:, :-1]
    row = np.nonzero(use)[0]
    return r[use], node[row], batch[row], sig[row], size[row]


def found_pairs(first, later, common=None, exhaustive=False):
    """(later, first) places of the pairs that the search of one shard ends with and that are within the distance."""
    texts = pa.array(first + later)
    codes, off = to_codes(texts)
    sig, route = neardup.sketch(codes, off, np.zeros(1 << neardup.TABLE_BITS, np.uint8) if common is None else common)
    n, node = len(first), np.arange(len(texts))
    pairs, segments = neardup.feed([], *entries(route, sig, node, (node >= n).astype(np.int64), np.diff(off)), exhaustive)
    got = neardup.close_pairs(texts, pairs[0], pairs[1])
    return {(int(pairs[0][i]) - n, int(pairs[1][i])) for i in got}, segments


def evenly(rnd, t, share, chars):
    t = list(t)
    for k in range(int(share * len(t))):
        i = int(k / share)
        t[i] = rnd.choice([c for c in chars if c != t[i]])
    return "".join(t)


LATIN, HAN = "abcdefghijklmnopqrstuvwxyz", [chr(c) for c in range(0x4E00, 0x4E00 + 800)]
SHORT = pytest.mark.xfail(reason="single letters changed at even distance: close to 0.9 or below it, see the README", strict=False)


@pytest.mark.parametrize("edits", [evenly, spread])
@pytest.mark.parametrize(
    "kind, share",
    [(k, s) for k in ("letters", "ideographs") for s in (0.05, 0.1, 0.15)] + [("ideographs", 0.18), pytest.param("letters", 0.18, marks=SHORT), ("pattern", 0.05), ("pattern", 0.1), pytest.param("pattern", 0.15, marks=SHORT), pytest.param("pattern", 0.18, marks=SHORT)],
)
def test_recall_of_spread_edits_against_brute_force(kind, share, edits):
    rnd = random.Random(15)
    form = lambda t: "".join(c for c in t if c.isalnum()).casefold()
    make = {"letters": lambda: "".join(rnd.choice(LATIN) for _ in range(400)), "ideographs": lambda: "".join(rnd.choice(HAN) for _ in range(160)), "pattern": lambda: form(item(rnd, 3))}[kind]
    first = [make() for _ in range(80)]
    got, _ = found_pairs(first, [edits(rnd, t, share, HAN if kind == "ideographs" else LATIN) for t in first])
    assert sum((i, i) in got for i in range(80)) >= 72


def test_a_family_of_a_third():
    rnd = random.Random(16)
    base = item(rnd, 3)
    for share in (0.1, 0.15, 0.19):
        family = []
        for _ in range(300):
            w = base.split()
            for k in rnd.sample(range(len(w)), int(share * len(w))):
                w[k] = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in w[k])
            family.append("".join(w).lower())
        common = neardup.commonness(pa.array(family + [item(rnd, 3) for _ in range(600)]))
        got, _ = found_pairs([base.replace(" ", "").lower(), *family[:150]], family[150:], common)
        near = neardup.close_pairs(pa.array([base.replace(" ", "").lower(), *family[150:]]), np.zeros(150, np.int64), np.arange(1, 151))
        assert len({q for q, _ in got} & set(near.tolist())) >= 0.95 * len(near)


def test_bounds_of_the_distance():
    rnd = random.Random(18)
    xs = [item(rnd, 2) for _ in range(60)] + ["".join(rnd.choice("金银铜铁锡上下左右") for _ in range(150)) for _ in range(20)] + ["", "a", "ab"]
    ys = [edit(rnd, t, rnd.randint(0, 9)) if t else t for t in xs]
    texts, n = pa.array(xs + ys), len(xs)
    x, y = np.concatenate([np.arange(n), np.arange(n)]), np.concatenate([np.arange(n) + n, np.roll(np.arange(n), 1) + n])
    codes, off = to_codes(texts)
    size = np.diff(off)
    k = (neardup.MAX_EDITS * np.maximum(size[x], size[y]) + 1e-9).astype(np.int64)
    want = set(np.flatnonzero(neardup.within_many(codes, off, x, y, k) & (np.maximum(size[x], size[y]) > 1)).tolist())
    assert set(neardup.close_pairs(texts, x, y).tolist()) == want


def test_sentences_in_another_order_need_no_exact_distance(monkeypatch):
    rnd = random.Random(23)
    word = lambda: "".join(rnd.choice(LATIN) for _ in range(rnd.randint(3, 9)))
    texts, exact = [], []
    for _ in range(60):
        s = ["".join(word() for _ in range(8)) for _ in range(8)]
        texts += ["".join(s), "".join(s[4:] + s[:4]), "".join(s).replace("e", "x")]
    texts, at = pa.array(texts), np.arange(60) * 3
    x, y = np.concatenate([at, at]), np.concatenate([at + 1, at + 2])
    codes, off = to_codes(texts)
    k = (neardup.MAX_EDITS * np.maximum(np.diff(off)[x], np.diff(off)[y]) + 1e-9).astype(np.int64)
    want = set(np.flatnonzero(neardup.within_many(codes, off, x, y, k)).tolist())
    within_many = neardup.within_many
    monkeypatch.setattr(neardup, "within_many", lambda codes, off, x, *rest: (exact.extend(x.tolist()), within_many(codes, off, x, *rest))[1])
    assert set(neardup.close_pairs(texts, x, y).tolist()) == want == set(range(60, 120))
    assert len(exact) <= 6


def test_columns_packed():
    rnd = np.random.default_rng(24)
    cols = [rnd.integers(-(1 << 60), 1 << 60, 70), rnd.integers(0, 1 << 63, (70, 4)).astype(np.uint64), rnd.integers(0, 99, 70).astype(np.int32)]
    kinds = (np.int64, (np.uint64, (4,)), np.int32)
    blobs = [neardup.pack_columns(*(c[a:b] for c in cols)) for a, b in ((0, 1), (1, 70))]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(neardup.unpack_columns(blobs, kinds), cols))
    assert [len(x) for x in neardup.unpack_columns([], kinds)] == [0, 0, 0]


def test_an_index_leaves_no_shuffles_and_no_second_copy_of_texts(spark):
    df = spark.createDataFrame([(i, b, t, "s") for i, b, t in corpus(random.Random(25))[0]], "seq long, batch_no long, content string, source string")
    here = pathlib.Path(shared_dir(spark).removeprefix("file://"))
    files = lambda: {f for d in (spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()) for f in pathlib.Path(d).rglob("shuffle_*.data") if f.stat().st_size}
    tables, shuffles = set(here.iterdir()), files()
    neardup.find_repeats(df, None)
    assert not any(p.name.startswith("canon-") and not p.name.startswith("canon-keys") for p in set(here.iterdir()) - tables)
    assert not files() - shuffles


def test_stored_segments_and_beams(monkeypatch):
    monkeypatch.setattr(neardup, "SCAN", 8)
    rnd = random.Random(19)
    first = [item(rnd, 3) for _ in range(250)]
    later = [edit(rnd, rnd.choice(first), 3) for _ in range(60)]
    beams, segments = found_pairs(first, later)
    every, _ = found_pairs(first, later, exhaustive=True)
    assert len({q for q, _ in beams}) >= 0.95 * len({q for q, _ in every})
    for s in segments:
        t = neardup.Segment.unpack(s.pack())
        assert all((getattr(s, c) == getattr(t, c)).all() for c in ("node", "batch", "sig", "size", "gram", "who", "links")) and (s.lo, s.hi) == (t.lo, t.hi)


def test_repeats_of_history(spark):
    rows, equal, edited, planted = corpus(random.Random(10))
    df = spark.createDataFrame([(i, b, t, "s") for i, b, t in rows], "seq long, batch_no long, content string, source string").withColumn("_id", F.lit(1))
    got = [r.seq for r in neardup.find_repeats(df, None).collect()]
    assert len(got) == len(set(got)) and equal <= set(got) <= equal | edited
    assert len(planted & set(got)) >= 0.9 * len(planted)
    assert neardup.find_repeats(df.limit(0), None).count() == 0


def test_index_batch_by_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(neardup.HistoryIndex, "MAX_PARTS", 1)
    rows, equal, edited, planted = corpus(random.Random(11))
    df = spark.createDataFrame([(i, b, t, "s") for i, b, t in rows], "seq long, batch_no long, content string, source string")
    ix, got = neardup.HistoryIndex(spark, f"file://{tmp_path}/ix"), set()
    for b in (0, 1, 2):
        got |= {r.seq for r in ix.add(df.filter(F.col("batch_no") == b)).collect()}
    assert equal <= got <= equal | edited and len(planted & got) >= 0.9 * len(planted)


def test_leaks_in_long_passages_with_words_added():
    rnd = random.Random(20)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9)))
    passages = [" ".join(word() for _ in range(k)) for k in (60, 200, 400, 800)]
    docs = []
    for p in passages:
        w = [x for i, v in enumerate(p.split()) for x in ([v, word()] if i % 10 == 9 else [v])]
        docs.append(" ".join([*(word() for _ in range(40)), *w, *(word() for _ in range(40))]))
    got = leaks.search(leaks.Passages([1, 2, 3, 4], passages), pa.array(docs))
    assert [(d, i) for d, i, _ in got] == [(i, i) for i in range(4)]


def test_suffixes_stand_in_order():
    rnd = random.Random(21)
    texts = ["".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60))) for _ in range(12)]
    codes, off = to_codes(pa.array(texts))
    s = leaks.Suffixes(codes.astype(np.int64), off, np.arange(len(codes)))
    suffix = [t[i:][: leaks.LENGTHS[-1]] for t in texts for i in range(len(t))]
    got = [suffix[i] for i in s.sa]
    assert got == sorted(got)
    common = [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(got, got[1:])]
    assert s.common_prefixes().tolist() == common


@pytest.mark.parametrize("kinds, bits", [(3, 4), (600, 10), (3000, 12)])
def test_starts_are_found_with_keys_of_any_width(kinds, bits):
    rnd = random.Random(26)
    chars = [chr(c) for c in range(0x4E00, 0x4E00 + kinds)]
    base = [rnd.choice(chars[:40]) for _ in range(90)] + chars
    passages = ["".join(base), "".join(base[5:70]), "".join(rnd.choice(chars[:2]) for _ in range(60))]
    texts = ["".join(base[20:60]) + "Ω" + "".join(base[:40]), "".join(rnd.choice(chars[:2] + ["Ω"]) for _ in range(200)), "".join(base[1:20])]
    p = leaks.Passages([1, 2, 3], passages)
    assert p.bits == bits and p.suffixes.keys == -(-32 // (64 // bits))
    codes, off = leaks.canonical_codes(pa.array(texts))
    own = p.alphabet[codes]
    shard = leaks.Suffixes(np.where(own == 0, (1 << bits) - 1, own).astype(np.int64), off, np.arange(len(codes)), bits)
    lo, hi = shard.find(p.suffixes, p.q, p.length)
    whole, ends = "".join(map(chr, codes)), off[1:]
    asked = ["".join(map(chr, p.codes[q : q + n])) for q, n in zip(p.q.tolist(), p.length.tolist())]
    for t, a, b in zip(asked, lo.tolist(), hi.tolist()):
        want = {i for i in range(len(whole)) if whole.startswith(t, i) and i + len(t) <= ends[np.searchsorted(ends, i, "right")]}
        assert set(shard.sa[a:b].tolist()) == want
    assert (hi > lo).any()


def test_registered():
    assert {"p1_found", "p4_found", "p6_found", "p7_found", "p8_ids", "p9_found", "p10_found"} <= set(plans.queries())


def test_blocks_rest_on_the_suffix_array(monkeypatch):
    rnd = random.Random(22)
    docs = [[rnd.randint(1, 40) for _ in range(rnd.randint(0, 6))] + ([101, 102, 103] if rnd.random() < 0.3 else []) + [rnd.randint(1, 40)] for _ in range(300)]
    ids, off = np.array([x for d in docs for x in d]), np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    want = {x for x in set(ids.tolist()) if sum(x in d for d in docs) >= 30}
    blocks = [b for b, _ in lines.repeated_blocks(ids, off, 30)]
    assert [101, 102, 103] in blocks and {x for b in blocks for x in b} == want
    whole = lines.suffix_array

    def broken(*a):
        text, doc, sa, lcp = whole(*a)
        return text, doc, sa[::-1].copy(), lcp

    monkeypatch.setattr(lines, "suffix_array", broken)
    assert {x for b, _ in lines.repeated_blocks(ids, off, 30) for x in b} != want
