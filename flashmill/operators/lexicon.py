"""Lexicons and ontologies as small ordered word tables.

Word tables are parameters: DataFrames (or an ontology file through
``flashmill.sources``). They are read once on the driver, with a checked bound,
and go into expressions as array literals, so that matching needs no join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

#: Words of one lexicon, at most: they become a literal in the plan.
MAX_WORDS = 5000

#: Degree words by level, before and after a trigger, in the order the levels are tried.
DEGREES = {
    "strong": (
        ["大幅", "超预期", "暴", "剧", "断崖式", "显著", "明显", "强劲", "剧烈", "深度", "严重", "极度", "创纪录", "历史性", "史诗级", "疯狂", "突然", "意外", "超乎预期", "大超预期", "远远超预期", "大幅超预期", "强烈"],
        ["飙升", "暴涨", "暴跌", "一夜之间", "创新高", "创新低", "创历史新高", "创历史新低", "创纪录", "超预期"],
    ),
    "uncertain": (
        ["预期", "可能", "拟", "传闻", "市场预计", "预计", "或将", "有望", "潜在", "如果", "假设", "传言", "消息称", "据称", "据闻", "据悉", "市场预期"],
        ["预期", "可能", "存在...可能", "面临...风险", "的预期", "的可能性", "的风险"],
    ),
    "weakening": (
        ["不及预期", "低于预期", "弱于预期", "小幅低于", "略低于"],
        ["不及预期", "低于预期", "弱于预期", "放缓", "收窄", "降温"],
    ),
    "moderate": (
        ["小幅", "温和", "边际", "略有", "略微", "轻微", "逐步", "稳步", "渐进", "适度", "稍稍", "有限", "基本"],
        ["左右", "附近", "小幅回落", "小幅上涨", "温和回升"],
    ),
}
#: Phrases before and after a trigger that turn its direction, and negations close before it.
REVERSAL_BEFORE = [
    "不加息", "不降息", "未加息", "未降息", "暂停加息", "暂停降息", "停止加息", "停止降息", "结束加息", "结束降息", "加息暂停", "降息暂停", "按兵不动", "维持不变", "维持利率不变",
    "加息预期降温", "降息预期降温", "加息预期回落", "降息预期回落", "放弃加息", "放弃降息", "打消加息", "打消降息", "避免加息", "避免降息", "暂缓加息", "暂缓降息",
]
REVERSAL_AFTER = ["暂停", "停止", "结束", "终止", "落空", "证伪", "未达预期", "预期降温", "预期回落", "预期下降"]
NEGATIONS = ["不", "未", "没", "没有", "并非", "不会", "不考虑", "放弃", "打消", "避免", "暂缓", "无", "非", "难以", "难以实现", "未能", "尚未", "暂未", "不再", "没能", "没实现", "没达到", "难以完成", "无法", "未能实现", "不至于", "未必"]
#: Negations of sentiment words.
SENTIMENT_NEGATIONS = ["不", "未", "没有", "无", "非", "并非", "难以", "难以实现", "未能", "尚未", "暂未", "不再", "不会", "没能", "没实现", "没达到", "难以完成", "无法", "未能实现", "不至于", "未必"]
#: Names of commodities in texts.
COMMODITIES = {
    "gold": ["黄金", "金价", "沪金", "伦敦金", "现货黄金", "COMEX黄金", "COMEX金", "AU", "Au", "黄金期货", "黄金ETF", "金条", "金币", "金饰", "金市", "贵金属"],
    "silver": ["白银", "银价", "沪银", "现货白银", "COMEX白银", "COMEX银", "AG", "Ag", "白银期货", "白银ETF", "银饰", "银市"],
}
#: Words that make a text relevant, ambiguous ones, and uses of the ambiguous ones that don't count.
RELEVANT = ["金价", "银价", "贵金属", "铂金", "钯金", "黄金期货", "白银期货", "沪金", "沪银", "伦敦金", "现货黄金", "COMEX黄金", "COMEX白银", "黄金ETF", "白银ETF", "央行购金", "黄金储备", "黄金价格", "白银价格", "金十数据", "汇通财经"]
AMBIGUOUS = ["黄金", "白银"]
FIGURATIVE = [
    "黄金窗口", "黄金大通道", "黄金时代", "黄金期", "黄金周", "黄金档", "黄金时段", "黄金年龄", "黄金法则", "黄金标准",
    "黄金搭档", "黄金分割", "黄金比例", "黄金水道", "黄金航道", "黄金线路", "黄金航线", "黄金赛道", "黄金发展", "黄金增长",
]


def longest_first(words: list[str]) -> list[str]:
    return sorted(words, key=len, reverse=True)


@dataclass
class Trigger:
    word: str
    event_type: str
    type_name: str
    direction: str


@dataclass
class Ontology:
    """Triggers in insertion order, and the word lists around them."""

    triggers: list[Trigger]
    degrees: dict = field(default_factory=lambda: DEGREES)
    before: list = field(default_factory=lambda: REVERSAL_BEFORE)
    after: list = field(default_factory=lambda: REVERSAL_AFTER)
    negations: list = field(default_factory=lambda: NEGATIONS)
    commodities: dict = field(default_factory=lambda: COMMODITIES)

    def __post_init__(self):
        seen: dict[str, Trigger] = {}
        for t in self.triggers:
            if t.word:
                seen.setdefault(t.word, t)  # the first type a word stands under counts
        #: by length, then insertion
        self.ranked = sorted(seen.values(), key=lambda t: -len(t.word))
        if len(self.ranked) > MAX_WORDS:
            raise ValueError(f"{len(self.ranked)} triggers; {MAX_WORDS} are allowed")

    def degree_words(self) -> list[tuple[str, str, str]]:
        """(level, place, word) in the order they are tried."""
        return [(lv, place, w) for lv, pair in self.degrees.items() for place, ws in zip(("prefix", "suffix"), pair) for w in longest_first(ws)]


def read_words(df: DataFrame, *columns: str) -> list[tuple]:
    """The rows of a small word table; more than MAX_WORDS is an error."""
    rows = df.select(*columns).limit(MAX_WORDS + 1).collect()
    if len(rows) > MAX_WORDS:
        raise ValueError(f"more than {MAX_WORDS} words")
    return [tuple(r) for r in rows]


@lru_cache(16)
def automaton(words: tuple[str, ...]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for i, w in enumerate(words):
        a.add_word(w, i)
    a.make_automaton()
    return a


def occurring(text: Column, words: list[str]) -> Column:
    """Numbers of the words that occur in a text, ascending: one pass of an automaton per text instead of a test per word."""
    known = tuple(words)

    @F.arrow_udf(ArrayType(IntegerType()))
    def find(x: pa.Array) -> pa.Array:
        a = automaton(known)
        return pa.array([sorted({i for _, i in a.iter(t)}) if t else [] for t in x.to_pylist()], pa.list_(pa.int32()))

    return find(text) if known else F.array().cast("array<int>")


def words_literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")
