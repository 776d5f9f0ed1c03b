"""Column functions for news text: cleaning, title splitting, normal forms, keys, time strings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Datelines and phrases as the news sources write them.
DATELINES = [
    r"^金十数据\s*\d{1,2}月\d{1,2}日讯[，,、\s]*",
    r"^金十数据\s*\d{4}-\d{2}-\d{2}日讯[，,、\s]*",
    r"^财联社\s*\d{1,2}月\d{1,2}日电[，,、\s]*",
    r"^财联社\s*\d{4}-\d{2}-\d{2}日电[，,、\s]*",
    r"^人民财讯\s*\d{1,2}月\d{1,2}日电[，,、\s]*",
    r"^人民财讯\s*\d{4}-\d{2}-\d{2}日电[，,、\s]*",
    r"^新华社\s*\d{1,2}月\d{1,2}日电[，,、\s]*",
    r"^新华社\s*\d{4}-\d{2}-\d{2}日电[，,、\s]*",
]
PROMOTIONS = [r"\(?金十数据APP\)?$", r"打开金十数据APP.*$", r"扫码查看.*$", r"^\d+订阅\s*"]
TITLE_BRACKETS = "【】[]"
SEPARATORS = " ：:，,。.-—"


def clean_text(x: Column) -> Column:
    """White space of any kind as one blank, none at the ends."""
    return F.btrim(F.regexp_replace(x, r"(?U)\s+", " "))


def strip_html(x: Column) -> Column:
    """Line breaks and tags as blanks, then clean_text."""
    return clean_text(F.regexp_replace(F.regexp_replace(x, r"(?i)<br\s*/?>", " "), r"<.*?>", " "))


def clean_corpus_text(x: Column) -> Column:
    """White space collapsed first, then tags deleted; blanks around a tag stay."""
    return F.regexp_replace(clean_text(x), r"<[^>]+>", "")


def strip_bracket_title(x: Column) -> Column:
    return F.btrim(F.regexp_replace(x, r"^【[^】]{2,120}】\s*", ""))


def strip_dateline(x: Column, agency: str, word: str) -> Column:
    return F.btrim(F.regexp_replace(x, rf"^{agency}\s*\d{{1,2}}月\d{{1,2}}日{word}[，,：:\s]*", ""))


def clean_title(x: Column) -> Column:
    return F.btrim(clean_text(x), F.lit(TITLE_BRACKETS))


def strip_separator(x: Column) -> Column:
    return F.btrim(F.ltrim(clean_text(x), F.lit(SEPARATORS)))


def strip_promotions(x: Column) -> Column:
    return reduce(lambda c, p: F.btrim(F.regexp_replace(c, p, "")), PROMOTIONS, strip_html(x))


def clean_agency_content(x: Column) -> Column:
    """Content of the source whose items open with its own name and close with a download call."""
    x = F.btrim(F.regexp_replace(clean_text(x), r"^【.*?】", ""))
    x = F.btrim(F.regexp_replace(x, r"下载汇通财经APP，.*?$", ""))
    return F.btrim(F.regexp_replace(x, r"^汇通财经(?:APP)?讯[—\-–\s]*(?:【.*?】)?\s*", ""))


def bracket_title(x: Column) -> Column:
    """Title inside leading brackets, '' if there is none."""
    return clean_title(F.regexp_extract(x, r"^【([^】]{2,120})】(?s)(.*)$", 1))


def bracket_body(x: Column) -> Column:
    """What follows the leading bracket title, the whole text if there is none."""
    body = F.regexp_extract(x, r"^【([^】]{2,120})】(?s)(.*)$", 2)
    return F.when(x.rlike(r"^【[^】]{2,120}】"), strip_separator(body)).otherwise(x)


def split_title(title: Column, content: Column) -> tuple[Column, Column]:
    """(title, content): bracket title of the content, else of the title; a title repeated at the content's start is cut off."""
    t, c = clean_text(F.coalesce(title, F.lit(""))), clean_text(F.coalesce(content, F.lit("")))
    bt, bb = bracket_title(c), bracket_body(c)
    own = F.when(bracket_title(t) != "", bracket_title(t)).otherwise(clean_title(t))
    rest = F.when((own != "") & c.startswith(own), strip_separator(F.substring(c, F.length(own) + 1, F.length(c)))).otherwise(c)
    in_content = (bt != "") & (bb != "") & c.startswith("【")
    return F.when(in_content, bt).otherwise(own), F.when(in_content, bb).otherwise(rest)


def normalize_news_text(x: Column) -> Column:
    """Letters, digits and underscores, without leading dateline and bracket title."""
    x = clean_text(F.coalesce(x, F.lit("")))
    x = reduce(lambda c, p: F.btrim(F.regexp_replace(c, p, "")), DATELINES, x)
    x = F.regexp_replace(x, r"^[【\[][^】\]]{2,120}[】\]]\s*", "")
    return F.regexp_replace(x, r"[^\p{L}\p{N}_]+", "")


def _with(values: dict[str, Column], body) -> Column:
    """body(struct of values), each value evaluated once however often body names it."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body), F.lit(0))


def dedup_key(title: Column, content: Column, source: Column, time: Column) -> Column:
    """SHA-1 of the normalised title and content; of source and time where both are empty."""

    def basis(x: Column) -> Column:
        t, c = x["t"], x["c"]
        other = F.concat(normalize_news_text(source), F.lit("\n"), normalize_news_text(time))
        return F.when((t != "") & (c != ""), F.concat(t, F.lit("\n"), c)).when(t != "", t).when(c != "", c).otherwise(other)

    return F.sha1(_with({"t": normalize_news_text(title), "c": normalize_news_text(content)}, basis))


def combined_text(title: Column, content: Column) -> Column:
    return _with({"t": normalize_news_text(title), "c": normalize_news_text(content)}, lambda x: F.when(x["t"] == x["c"], x["c"]).otherwise(F.concat(x["t"], x["c"])))


def first_text(*columns: Column) -> Column:
    """First value that is neither null nor ''; '' if there is none."""
    return F.coalesce(*[F.when(c != "", c) for c in columns], F.lit(""))


_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}(:\d{2})?$"


def local_seconds(x: Column) -> Column:
    """Seconds since 1970 of a local ``yyyy-MM-dd HH:mm[:ss]``; null for other or impossible texts. Independent of any zone."""
    part = lambda a, n: F.substring(x, a, n).cast("int")
    y, m, d = part(1, 4), part(6, 2), part(9, 2)
    first = F.make_date(F.greatest(y, F.lit(1)), F.least(F.greatest(m, F.lit(1)), F.lit(12)), F.lit(1))
    h, mi, s = part(12, 2), part(15, 2), F.coalesce(F.when(F.length(x) > 16, part(18, 2)), F.lit(0))
    fine = (y >= 1) & m.between(1, 12) & (d >= 1) & (d <= F.dayofmonth(F.last_day(first))) & (h < 24) & (mi < 60) & (s < 60)
    return F.when(x.rlike(_TIME), F.when(fine, (F.unix_date(first) + d - 1).cast("long") * 86400 + h * 3600 + mi * 60 + s))


def time_bucket(x: Column, minutes: int = 120) -> Column:
    """``yyyyMMdd_n`` of a local time text, ``no_time`` if it can't be read."""
    sec = local_seconds(x)
    n = F.floor(F.pmod(sec, F.lit(86400)) / 60 / minutes)
    return F.when(sec.isNull(), "no_time").otherwise(F.concat(F.translate(F.substring(x, 1, 10), "-", ""), F.lit("_"), n.cast("string")))


def date_key(x: Column) -> Column:
    """``yyyy-MM-dd`` of the date a time text starts with (y-M-d, y/M/d, yyyyMMdd); null if there is none."""
    m = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})(?:\D.*)?$"
    y = F.when(x.rlike(m), F.regexp_replace(x, m, "$1")).when(x.rlike(r"^\d{8}(\D.*)?$"), F.substring(x, 1, 4)).cast("int")
    mo = F.when(x.rlike(m), F.regexp_replace(x, m, "$2")).when(x.rlike(r"^\d{8}(\D.*)?$"), F.substring(x, 5, 2)).cast("int")
    d = F.when(x.rlike(m), F.regexp_replace(x, m, "$3")).when(x.rlike(r"^\d{8}(\D.*)?$"), F.substring(x, 7, 2)).cast("int")
    first = F.make_date(F.greatest(y, F.lit(1)), F.least(F.greatest(mo, F.lit(1)), F.lit(12)), F.lit(1))
    fine = (y >= 1) & mo.between(1, 12) & (d >= 1) & (d <= F.dayofmonth(F.last_day(first)))
    return F.when(fine, F.format_string("%04d-%02d-%02d", y, mo, d))


def polarity_of(x: Column) -> Column:
    """positive, negative or null of a freely written polarity."""
    return F.when(x.rlike("(?i)正|积极|pos"), "positive").when(x.rlike("(?i)负|消极|neg"), "negative")
