import random
from difflib import SequenceMatcher

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flashmill.functions import text as T
from flashmill.operators import events, expansion, news_dedup, review, sentiment
from flashmill.operators import lexicon as L
from flashmill.sources import files, sites


@pytest.fixture(scope="module")
def ontology():
    words = [
        ("加息预期升温", "policy", "bearish"), ("加息", "policy", "bearish"), ("降息", "policy", "bullish"), ("美元走强", "dollar", "bearish"), ("美元下跌", "dollar", "bullish"),
        ("避险情绪升温", "risk", "bullish"), ("央行购金", "bank", "bullish"), ("通胀预期降温", "inflation", "bearish"), ("加息", "other", "bullish"),
    ]
    return L.Ontology([L.Trigger(w, k, k, d) for w, k, d in words])


def run(spark, o, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, content string")
    return [r.extraction for r in events.extract(df, o, "content").orderBy("id").collect()]


def test_events(spark, ontology):
    texts = ["美联储宣布加息25个基点，美元走强，金价承压下跌", "美联储大幅加息", "市场预期美联储加息", "美联储加息超预期", "美联储暂停加息", "美联储不加息", "市场认为加息暂停", "加息预期升温，金价下跌", "通胀预期降温", "非农加息", " ", None, "美联储加息利空金价，但避险情绪升温支撑金价"]
    e = run(spark, ontology, texts)
    short = [[(x.trigger_word, x.direction, x.degree, x.reversal_word) for x in r.events] for r in e]
    assert short[0] == [("加息", "bearish", "moderate", ""), ("美元走强", "bearish", "moderate", "")]
    assert [s[0][1:3] for s in short[1:4]] == [("bearish", "strong"), ("bearish", "uncertain"), ("bearish", "strong")]
    assert [s[0][1] for s in short[4:7]] == ["bullish"] * 3 and [s[0][3] for s in short[4:7]] == ["暂停加息", "不加息", "暂停"]
    assert short[7][0][0] == "加息预期升温" and short[8][0][1] == "bullish" and short[9][0] == ("加息", "bullish", "moderate", "非")
    assert short[10] == short[11] == [] and e[10].summary.net_direction == "neutral"
    assert e[12].summary.net_direction == "mixed" and e[0].commodities == ["gold"] and e[4].commodities == ["precious_metals_general"]


def test_matching_is_longest_first_everywhere(spark):
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))) for _ in range(25)})
    o = L.Ontology([L.Trigger(w, "t", "t", "bullish") for w in words])
    texts = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    for t, r in zip(texts, run(spark, o, texts)):
        left, want = list(t), []
        for w in sorted(words, key=len, reverse=True):
            i = 0
            while i + len(w) <= len(left):
                if "".join(left[i : i + len(w)]) == w:
                    want.append((i, w))
                    left[i : i + len(w)] = "#" * len(w)
                    i += len(w)
                else:
                    i += 1
        assert [(e.position, e.trigger_word) for e in r.events] == sorted(want)


def test_normal_text_and_keys(spark):
    df = spark.createDataFrame([("金十数据 9月15日讯 美联储宣布加息",), ("【快讯】金价上涨！",), (" a\u00a0 b\n",), (None,)], "x string")
    assert [r[0] for r in df.select(T.normalize_news_text(F.col("x"))).collect()] == ["美联储宣布加息", "金价上涨", "ab", ""]


def test_simhash_and_similarity():
    h = news_dedup.simhash_batch(pa.array(["", None, "金价上涨报价", "金价上涨报价", "a"])).tolist()
    assert h[:2] == [0, 0] and h[2] == h[3] != 0 and h[4] != 0
    a, b = "美联储宣布加息25个基点，金价承压下跌", "美联储宣布加息25个基点，金价承压走低"
    assert news_dedup.text_similarity(a, b) == SequenceMatcher(None, a, b).ratio()
    assert news_dedup.is_near_duplicate(a, a, 1, 1) and not news_dedup.is_near_duplicate("ab", "ab", 1, 1)


def test_greedy_dedup_against_a_loop(spark):
    rnd = random.Random(7)
    base = ["美联储宣布加息二十五个基点美元指数走强金价承压下跌市场观望", "央行继续购入黄金储备连续三个月增加市场情绪回暖金价上涨"]
    rows = []
    for i in range(60):
        t = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(len(t))] = rnd.choice("甲乙丙丁")
        rows.append((i, "", "".join(t), f"2026-09-{rnd.choice(['14', '15'])} {rnd.randint(9, 14):02d}:{rnd.randint(0, 59):02d}:00" if rnd.random() < 0.9 else None, "s"))
    df = spark.createDataFrame(rows, "seq long, title string, content string, publish_time string, source string")
    got = {r.seq for r in news_dedup.deduplicate(df).collect()}
    sec = {r.seq: r.s for r in df.select("seq", T.local_seconds(F.col("publish_time")).alias("s")).collect()}
    h = dict(zip(range(60), news_dedup.simhash_batch(pa.array([r[2] for r in rows])).tolist()))
    kept = []
    for r in sorted(rows, key=lambda r: (sec[r[0]] is None, -(sec[r[0]] or 0), r[0])):
        i, t, s = r[0], r[2], sec[r[0]]

        def near(k):
            j, u = k[0], sec[k[0]]
            same = (s is None and u is None) or (s is not None and u is not None and s // 86400 == u // 86400 and abs(s - u) <= 7200)
            x = (h[i] ^ h[j]) & (1 << 64) - 1
            seg = any(x >> 8 * b & 255 == 0 for b in range(8))
            return same and seg and bin(x).count("1") <= 12 and news_dedup.text_similarity(t, k[2]) >= 0.9

        if not any(k[2] == t or near(k) for k in kept):
            kept.append(r)
    assert got == {k[0] for k in kept}


def test_sentiment(spark):
    df = spark.createDataFrame([("金价上涨，未上涨，下跌",), ("",), (None,)], "x string")
    got = sentiment.with_score(df, F.col("x"), ["上涨"], ["下跌"]).collect()
    assert (got[0].positive_count, got[0].negative_count) == (1 + 1, 1) or (got[0].positive_count, got[0].negative_count) == (2, 1)
    assert got[1].sentiment_score == 0.0 and got[2].total_words == 0


def test_review(spark):
    ev = "array<struct<event_type:string>>"
    df = spark.createDataFrame([(True, "true", [("a",)], [("a",)], [], []), (True, "Partial", [("b",)], [], [("a",)], [(None,)]), (False, None, [("a",)], [], [], [])], f"reviewed boolean, overall_correct string, predicted_events {ev}, correct_events {ev}, missed_events {ev}, wrong_events {ev}")
    m = review.metrics(df).first()
    assert (m.total_reviewed, m.wrong, m.accuracy, m.precision, m.recall) == (2, 0, 0.75, 0.5, 0.5)
    assert review.metrics(df.filter("not reviewed")).count() == 0
    assert {r.event_type for r in review.type_breakdown(df).collect()} == {"a", "b", "unknown"}


def test_relevance_and_seeds(spark):
    df = spark.createDataFrame([("黄金窗口期",), ("现货黄金上涨",), ("黄金上涨",), (None,)], "x string")
    assert [r[0] for r in df.select(expansion.is_relevant(F.col("x"))).collect()] == [False, True, True, False]
    w = spark.createDataFrame([("a", "正面"), ("a", "负面"), ("b", "Positive"), ("", "正面"), ("c", None)], "word string, polarity string")
    assert [tuple(r) for r in expansion.merge_seeds(w).collect()] == [("b", "positive")]


def test_sites(spark):
    cls = spark.createDataFrame([("1", "1726365600", "【标题甲乙】", "【标题甲乙】财联社9月15日电，正文<br>续"), ("2", "x", "t", "c"), ("3", "1726365600", "", "")], "id string, ctime string, title string, content string")
    got = sites.cls_items(cls).collect()
    assert len(got) == 1 and got[0].id == "cls_1" and got[0].title == "标题甲乙" and got[0].content == "正文 续" and got[0].publish_time == "2024-09-15 10:00:00"
    j = spark.createDataFrame([("9", "2026-09-15 10:00:00", ("", "【快讯标题】金十数据9月15日讯，内容"))], "id string, time string, data struct<title:string,content:string>")
    assert [(r.title, r.content) for r in sites.jin10_items(j).collect()] == [("快讯标题", "内容")]


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text('[{"id":"1","title":"t"},{"id":"2"}]')
    (tmp_path / "y.json").write_text('{"id":"3"}')
    (tmp_path / "z.json").write_text("{broken")
    assert {r.id for r in files.read_json_tree(spark, str(tmp_path)).collect()} == {"1", "2", "3"}
    (tmp_path / "w.txt").write_text("# c\n好\n\n好 \n坏\n")
    assert {r.word for r in files.read_word_list(spark, str(tmp_path / "w.txt")).collect()} == {"好", "坏"}
    (tmp_path / "o.json.txt").write_text('{"event_types":{"p":{"name":"n","bullish_triggers":["降息"],"bearish_triggers":["加息"]}}}')
    assert [t.word for t in files.read_ontology(spark, str(tmp_path / "o.json.txt")).ranked] == ["降息", "加息"]


def test_stream(spark, tmp_path, ontology):
    from flashmill.streaming import news

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id":"1","title":"","content":"美联储加息","publish_time":"2026-09-15 10:00:00","source":"s"}\n' * 2)
    q = news.daily_counts(news.read_stream(spark, str(tmp_path / "in")), ontology).writeStream.format("memory").queryName("daily").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.direction, r.events) for r in spark.table("daily").collect()] == [("bearish", 1)]


def test_w2v_expand_does_the_operators_job(spark, monkeypatch):
    from flashmill.plans import reference

    used = {}
    monkeypatch.setattr(expansion, "train_word2vec", lambda tokens, **kw: used.update(kw) or "model")
    monkeypatch.setattr(expansion, "expand", lambda model, seeds: seeds)
    d = "/root/testdata/sf0.001"
    got = {tuple(r) for r in reference.w2v_expand(spark, d).select("word", "polarity").collect()}
    assert used == {} and got == {tuple(r) for r in reference.lexicon_merge(spark, d).collect()} and len(got) > 5


def test_seeds_out_of_the_vocabulary_give_no_rows(spark):
    rows = [(i, [float(i), 1.0]) for i in range(5)]
    v = spark.createDataFrame(rows, "id long, v array<double>")
    assert expansion.nearest(v, "id", "v", v.limit(0)).collect() == []
    assert expansion.nearest(v.limit(0), "id", "v", v, least=-1.0).collect() == []
    assert sorted((r.query_id, r.vec_id) for r in expansion.nearest(v, "id", "v", v.filter("id < 2"), 1, -1.0).collect()) == [(0, 1), (1, 2)]


def test_seeds_stay_whole_words(spark):
    words = spark.createDataFrame([("运输成本",), ("运输成本改善",), ("金价",), ("金",), ("A股",)], "word string")
    text = "随着运输成本改善有限，金价Gold up\x01运输成本涨"
    got = expansion.tokenize(spark.createDataFrame([(text,), (None,), ("金价",)], "text string"), "text", words)
    assert [r.tokens for r in got.collect()] == [["gold", "up", "随着", "运输成本改善", "有限", "金价", "运输成本", "涨"]]
    none = expansion.tokenize(spark.createDataFrame([(text,)], "text string"), "text", words.limit(0)).first().tokens
    assert none == expansion.tokenize(spark.createDataFrame([(text,)], "text string"), "text").first().tokens and "运输成本" not in none


def test_w2v_expand_reaches_seeds_of_the_texts(spark, monkeypatch, tmp_path):
    from flashmill.plans import reference

    rnd = random.Random(4)
    texts = ["".join(rnd.sample(["运输成本改善", "矿石品位改善", "金价", "上涨", "白银"], 4)) for _ in range(80)]
    spark.createDataFrame([(t,) for t in texts], "content string").write.parquet(f"{tmp_path}/news.parquet")
    seeds = [("运输成本改善", "正面"), ("不在文中的词", "负面")]
    spark.createDataFrame(seeds, "word string, polarity string").write.parquet(f"{tmp_path}/lexicon.parquet")
    monkeypatch.setattr(expansion.expand, "__defaults__", (expansion.TOP_N, -1.0))
    got = reference.w2v_expand(spark, str(tmp_path)).collect()
    assert {(r.source_seed, r.polarity) for r in got} == {("运输成本改善", "positive")} and "上涨" in {r.word for r in got}
    spark.createDataFrame(seeds[1:], "word string, polarity string").write.mode("overwrite").parquet(f"{tmp_path}/lexicon.parquet")
    spark.catalog.clearCache()
    assert reference.w2v_expand(spark, str(tmp_path)).collect() == []


def test_private_use_characters_are_no_triggers():
    from flashmill.operators.events import Rules
    from flashmill.operators.lexicon import Ontology, Trigger

    rules = Rules(Ontology([Trigger("降息", "rate", "利率", "bullish"), Trigger("降息预期", "rate", "利率", "bullish")]))
    assert rules.events("\ue000\ue5e5") == []
    got = rules.events("\ue000央行降息\ue5e5，降息预期升温")
    assert [(e["trigger_word"], e["position"]) for e in got] == [("降息", 3), ("降息预期", 7)]
