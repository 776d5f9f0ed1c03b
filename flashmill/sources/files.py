"""File sources and sinks: JSON trees, word lists, ontologies, polarity tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flashmill.functions.text import polarity_of
from flashmill.operators.lexicon import Ontology, Trigger

NEWS = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "title", "content", "publish_time", "source", "data_source", "data_frequency")])


def read_json_tree(spark: SparkSession, path: str, schema: T.StructType = NEWS) -> DataFrame:
    """All ``*.json`` files below a folder, lists and single objects alike; unreadable ones give no rows."""
    bad = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    r = spark.read.schema(bad).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    return r.option("ignoreCorruptFiles", True).json(path).filter("_corrupt is null").drop("_corrupt")


def read_json_file(spark: SparkSession, path: str, schema: T.StructType = NEWS) -> DataFrame:
    """One JSON file; an unreadable one is an error."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def make_record(df: DataFrame) -> DataFrame:
    """The seven fields of a news record as strings, missing ones ''."""
    return df.select(*[F.coalesce(F.col(f.name).cast("string") if f.name in df.columns else F.lit(None).cast("string"), F.lit("")).alias(f.name) for f in NEWS])


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """word: one per line, without comments, blank lines and repeats."""
    w = spark.read.text(path).select(F.trim("value").alias("word"))
    return w.filter("word <> '' and not startswith(word, '#')").distinct()


def read_ontology(spark: SparkSession, path: str, negations: list[str] | None = None) -> Ontology:
    """Ontology of a JSON file with event types, degree modifiers, reversal patterns and entities; missing sections keep the defaults."""
    o = json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    triggers = [
        Trigger(w, kind, t.get("name", kind), d)
        for kind, t in o.get("event_types", {}).items()
        for d in ("bullish", "bearish")
        for w in t.get(f"{d}_triggers", [])
    ]
    more: dict = {}
    if "degree_modifiers" in o:
        g = o["degree_modifiers"]
        more["degrees"] = {lv: (g.get(lv, {}).get("prefix", []), g.get(lv, {}).get("suffix", [])) for lv in ("strong", "uncertain", "weakening", "moderate")}
    if "reversal_patterns" in o:
        r = o["reversal_patterns"]
        more |= {"before": r.get("prefix_reversals", []), "after": r.get("suffix_reversals", []), "negations": [*r.get("negation_words", []), *(negations or [])]}
    if "commodity_entities" in o:
        more["commodities"] = o["commodity_entities"]
    return Ontology(triggers, **more)


def read_polarity_table(df: DataFrame) -> DataFrame:
    """word, polarity of a table of unknown layout: the columns are found by name, the last match counts."""
    word = [c for c in df.columns if "词" in c or "word" in c.lower()]
    pol = [c for c in df.columns if "极" in c or "polar" in c.lower() or "情" in c]
    if not word or not pol:
        raise ValueError("no word or polarity column")
    d = df.select(F.trim(F.col(word[-1]).cast("string")).alias("word"), polarity_of(F.col(pol[-1]).cast("string")).alias("polarity"))
    return d.filter("word <> '' and polarity is not null")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_index(df: DataFrame, path: str) -> None:
    """A daily index as Parquet and as CSV with a header."""
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    df.write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(column).write.mode("overwrite").text(path)
