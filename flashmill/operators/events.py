"""Event extraction with an ontology: longest-first triggers, reversal, degree, commodities, summaries.

Triggers, reversals and degrees of a batch of texts are found in one Arrow
kernel: an automaton tells which triggers occur in a text; those, longest
first, take their places, so that a later, shorter one can't match inside them;
then only the few characters around each match are looked at. Texts may hold
any characters, private-use ones included. A null text is ''.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flashmill.functions.text import first_text
from flashmill.operators.lexicon import Ontology, automaton, longest_first, words_literal

NEAR, GAP, NEGATION, DEGREE = 12, 4, 3, 15
EVENT = (
    "struct<event_type:string,event_type_name:string,direction:string,direction_cn:string,degree:string,degree_cn:string,trigger_word:string,"
    "reversed:boolean,reversal_word:string,degree_word:string,position:int>"
)
_FIELDS = [(c, {"reversed": pa.bool_(), "position": pa.int32()}.get(c, pa.string())) for c in (f.split(":")[0] for f in EVENT[7:-1].split(","))]
DIRECTIONS, LEVELS = {"bullish": "利多", "bearish": "利空"}, {"strong": "强", "uncertain": "不确定", "moderate": "中"}


def stripped(x: Column) -> Column:
    """x without white space of any kind at its ends; null is ''."""
    space = r"[\p{IsWhite_Space}\x1C-\x1F]+"
    return F.regexp_replace(F.coalesce(x, F.lit("")), f"^{space}|{space}$", "")


class Rules:
    """An ontology's word lists in the order they are tried."""

    def __init__(self, o: Ontology):
        self.triggers = o.ranked
        self.words = tuple(t.word for t in o.ranked)
        self.before, self.after = longest_first(o.before), longest_first(o.after)
        self.negations = sorted(set(o.negations), key=lambda w: (-len(w), w))
        self.degrees = o.degree_words()

    def matches(self, text: str) -> list[tuple[int, int]]:
        """(start, number) of the triggers in a text, by start."""
        found = sorted({i for _, i in automaton(self.words).iter(text)})
        out, left = [], text
        for i in found:
            w = self.words[i]
            at = left.find(w)
            while at >= 0:
                out.append((at, i))
                at = left.find(w, at + len(w))
            left = left.replace(w, "\0" * len(w))
        return sorted(out)

    def turn(self, t: str, s: int, e: int) -> str:
        """The word that reverses the trigger at [s, e), '' if none does."""
        a = max(0, s - NEAR)
        back, ahead, close = t[a:e], t[s : e + NEAR], t[max(0, s - NEGATION) : s]
        for p in self.before:
            at = back.rfind(p)
            if at >= 0 and (0 <= s - (a + at + len(p)) <= GAP or a + at <= s <= a + at + len(p)):
                return p
        for p in self.after:
            at = ahead.find(p)
            if at >= 0 and (0 <= s + at - e <= GAP or s + at <= e <= s + at + len(p)):
                return p
        return next((p for p in self.negations if p in close), "")

    def degree(self, t: str, s: int, e: int) -> tuple[str, str]:
        """(level, word) of the first degree word close to the trigger."""
        pre, post = t[max(0, s - DEGREE) : s], t[e : e + DEGREE]
        return next(((level, w) for level, place, w in self.degrees if w in (pre if place == "prefix" else post)), ("moderate", ""))

    def events(self, text: str) -> list[dict]:
        out = []
        for s, i in self.matches(text):
            x, e = self.triggers[i], s + len(self.words[i])
            turn, (level, word) = self.turn(text, s, e), self.degree(text, s, e)
            way = "bullish" if (x.direction == "bullish") != (turn != "") else "bearish"
            level = "moderate" if level == "weakening" else level
            values = (x.event_type, x.type_name, way, DIRECTIONS[way], level, LEVELS[level], x.word, turn != "", turn, word, s)
            out.append(dict(zip((c for c, _ in _FIELDS), values)))
        return out


def with_events(df: DataFrame, text: Column, o: Ontology) -> DataFrame:
    """df with _text (stripped) and _events (array of EVENT, by position)."""
    rules = Rules(o)

    @F.arrow_udf(f"array<{EVENT}>")
    def find(x: pa.Array) -> pa.Array:
        return pa.array([rules.events(t) if t and rules.words else [] for t in x.to_pylist()], pa.list_(pa.struct(_FIELDS)))

    d = df.withColumn("_text", stripped(text))
    return d.withColumn("_events", find("_text"))


def commodities_of(text: Column, o: Ontology) -> Column:
    """Sorted names of the commodities a text mentions; the general one if none."""
    found = F.array_compact(F.array(*[F.when(F.exists(words_literal(ws), lambda w: F.contains(text, w)), F.lit(c)) for c, ws in o.commodities.items()]))
    return F.when(F.size(found) > 0, F.sort_array(found)).otherwise(F.array(F.lit("precious_metals_general")))


def summary_of(events: Column) -> Column:
    """Counts, net direction and dominant types (by count, ties by first appearance)."""
    bull = F.size(F.filter(events, lambda e: e["direction"] == "bullish"))
    bear = F.size(events) - bull
    types = F.array_distinct(F.transform(events, lambda e: e["event_type"]))
    ranked = F.array_sort(F.transform(types, lambda t, i: F.struct((-F.size(F.filter(events, lambda e: e["event_type"] == t))).alias("n"), i.alias("i"), t.alias("t"), F.get(F.filter(events, lambda e: e["event_type"] == t), F.lit(0))["event_type_name"].alias("name"))))
    net = F.when(bull > bear, "bullish").when(bear > bull, "bearish").when(bull > 0, "mixed").otherwise("neutral")
    cn = F.when(bull > bear, "利多").when(bear > bull, "利空").when(bull > 0, "多空交织").otherwise("中性")
    return F.struct(
        F.size(events).alias("total_events"),
        bull.alias("bullish_count"),
        bear.alias("bearish_count"),
        net.alias("net_direction"),
        cn.alias("net_direction_cn"),
        F.transform(ranked, lambda r: r["t"]).alias("dominant_types"),
        F.transform(ranked, lambda r: r["name"]).alias("dominant_type_names"),
    )


def extract(df: DataFrame, o: Ontology, *columns: str) -> DataFrame:
    """df with ``extraction`` and its flattened fields; text: the first of the columns that is not empty."""
    d = with_events(df, first_text(*[F.col(c) for c in columns]), o)
    d = d.withColumn("_sum", summary_of(F.col("_events"))).withColumn("_com", commodities_of(F.col("_text"), o))
    d = d.withColumn("extraction", F.struct(F.col("_text").alias("text"), F.col("_com").alias("commodities"), F.col("_events").alias("events"), F.col("_sum").alias("summary")))
    return d.withColumns(
        {
            "event_count": F.size("_events"),
            "net_direction": F.col("_sum.net_direction"),
            "event_types": F.array_join(F.col("_sum.dominant_types"), ","),
            "commodities": F.array_join("_com", ","),
        }
    ).drop("_text", "_events", "_sum", "_com")


def daily_event_index(ex: DataFrame, date: Column) -> DataFrame:
    """One row per date: news and events, bullish less bearish events per item, and the same by type as JSON maps.

    The map of a date has as many entries as there are event types.
    """
    d = ex.withColumn("date", date).filter("date is not null")
    n = d.groupBy("date").agg(F.count(F.lit(1)).alias("news_count"))
    ev = d.select("date", F.explode("extraction.events").alias("e")).groupBy("date", F.col("e.event_type").alias("t")).agg(F.count_if(F.col("e.direction") == "bullish").alias("bullish"), F.count(F.lit(1)).alias("total"))
    ev = ev.withColumn("bearish", F.col("total") - F.col("bullish"))
    by = ev.groupBy("date").agg(
        F.sum("total").alias("event_count"),
        F.sum("bullish").alias("bullish_events"),
        F.sum("bearish").alias("bearish_events"),
        F.count(F.lit(1)).alias("type_count"),
        F.sort_array(F.collect_list(F.struct("t", F.struct("bullish", "bearish", "total").alias("v")))).alias("m"),
    )
    j = n.join(by, "date", "left").na.fill(0, ["event_count", "bullish_events", "bearish_events", "type_count"])
    per = lambda x: F.round((x["v"]["bullish"] - x["v"]["bearish"]).cast("double") / F.col("news_count"), 6)
    return j.select(
        "date",
        "news_count",
        "event_count",
        "bullish_events",
        "bearish_events",
        F.round((F.col("bullish_events") - F.col("bearish_events")).cast("double") / F.col("news_count"), 6).alias("net_event_index"),
        "type_count",
        F.to_json(F.map_from_entries(F.coalesce("m", F.array().cast(by.schema["m"].dataType)))).alias("type_breakdown"),
        F.to_json(F.map_from_entries(F.transform(F.coalesce("m", F.array().cast(by.schema["m"].dataType)), lambda x: F.struct(x["t"], per(x))))).alias("type_net_index"),
    )
