"""Mixed timestamp notations to one instant in UTC (problem 5).

Every text is taken apart by one regular expression inside the JVM. Where it
allows more than one reading (day and month of an all-numeric date; a row of
digits as compact date or as epoch number), each source is a mixture of formats
(FORMATS): expectation-maximisation over the counts of its values by the
readings that are valid for them gives the weight of each format, the posterior
picks the reading, and a value that stays open is marked ``ambiguous`` and has
no instant. Where the source declares its order, that decides; if the weights
its own values give speak for the other order, the instant's status is
``contested``. A zone abbreviation with several offsets over the years means the
one in force in the feed's zone then.

Results for odd input: null, blank or incomplete times, impossible dates and
local times of unknown zone give null (``status`` says which); local times that
occur twice mean the first occurrence, skipped ones move on by the gap.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flashmill.session import materialize

#: English month names by their first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_DATE = (
    r"(?:(\d{4})([-/.])(\d{1,2})\2(\d{1,2})"  # 1 3 4
    r"|(\d{4})年(\d{1,2})月(\d{1,2})日"  # 5 6 7
    r"|((?:19|20|21)\d{2})(\d{2})(\d{2})(?=[T ]?\d{4}(?:\d{2})?(?:\D|$))"  # 8 9 10
    r"|(\d{1,2})([-/.])(\d{1,2})\12(\d{4})"  # 11 13 14
    r"|(?:[A-Za-z]{3,9}\.?,? )?(\d{1,2}) ([A-Za-z]{3,9})\.?,? (\d{4})"  # 15 16 17
    r"|(?:[A-Za-z]{3,9}\.?, )?([A-Za-z]{3,9})\.? (\d{1,2}),? (\d{4}))"  # 18 19 20
)
_TIME = (
    r"(?:,? *T? *)(上午|下午|[AaPp]\.?[Mm]\.?)? ?"  # 21
    r"(?:(\d{1,2})[:时](\d{2})(?:[:分](\d{2})(?:[.,](\d{1,9}))?)?[分秒]?"  # 22 23 24 25
    r"|(\d{2})(\d{2})(\d{2})?)"  # 26 27 28
    r" ?([AaPp]\.?[Mm]\.?(?![A-Za-z]))?"  # 29
)
PATTERN = "^" + _DATE + _TIME + r" *(.*)$"  # 30
PARTS = "#|$1$5$8$14$17$20|$3$6$9|$4$7$10|$11|$13|$15$19|$16$18|$21$29|$22$26|$23$27|$24$28|$25|$30"

#: Components of a source's mixture of notations whose readings can compete.
FORMATS = ("dmy", "mdy", "compact", "epoch")
EM_ROUNDS = 30
#: A row of digits counts as an epoch number too if that lies between these instants (1990 and 2100), in microseconds.
EPOCH_RANGE = (631_152_000_000_000, 4_102_444_800_000_000)
#: Least posterior that settles a reading.
SETTLED = 0.9

_WIDE = "０１２３４５６７８９：－／．，　"
_NARROW = "0123456789:-/., "


def abbreviations(zones: list[str]) -> dict[tuple[str, str], int | None]:
    """Offset in minutes of each (zone, abbreviation) used between 1990 and 2040; none where it had several."""
    out = {}
    for z in zones:
        try:
            info = ZoneInfo(z)
        except Exception:
            continue
        at = datetime(1990, 1, 1, tzinfo=timezone.utc)
        while at.year < 2040:
            local = at.astimezone(info)
            if local.tzname().isalpha():
                key, minutes = (z, local.tzname()), int(local.utcoffset().total_seconds() // 60)
                out[key] = minutes if out.get(key, minutes) == minutes else None
            at += timedelta(days=60)
    return dict(sorted(out.items()))


def _int(c: Column) -> Column:
    return F.expr("0") if c is None else F.when(c != "", c).otherwise(None).cast("int")


def with_parts(df: DataFrame, raw: str) -> DataFrame:
    """df with the columns _t, _y, _mo, _d, _a, _b, _ap, _h, _mi, _s, _us, _zone, _epoch; null where a part is absent."""
    keep = df.columns
    text = F.col(raw)
    df = df.withColumn("_t", F.trim(F.when(text.rlike("[０-９：－／．　]"), F.translate(text, _WIDE, _NARROW)).otherwise(text)))
    df = df.withColumn("_out", F.regexp_replace("_t", PATTERN, PARTS))
    df = df.withColumn("_f", F.when(F.col("_out").startswith("#|"), F.split("_out", r"\|", 14)))
    f = lambda i: F.get(F.col("_f"), F.lit(i))
    mon = F.lower(F.substring(f(7), 1, 3))
    month = F.when(f(7) != "", F.array_position(F.array(*map(F.lit, MONTHS)), mon).cast("int"))
    frac = F.when(f(12) != "", F.substring(F.rpad(f(12), 6, "0"), 1, 6).cast("int")).otherwise(0)
    digits = F.col("_t").rlike(r"^\d{9,17}$")
    n = F.length("_t")
    epoch = F.when(digits, F.col("_t").cast("long"))
    epoch = F.when(n <= 11, epoch * 1_000_000).when(n.between(12, 14), epoch * 1000).when(n >= 15, epoch)
    return df.select(
        *keep,
        "_t",
        _int(f(1)).alias("_y"),
        F.coalesce(_int(f(2)), month).alias("_mo"),
        F.coalesce(_int(f(3)), _int(f(6))).alias("_d"),
        _int(f(4)).alias("_a"),
        _int(f(5)).alias("_b"),
        F.lower(F.substring(f(8), 1, 2)).alias("_ap"),
        _int(f(9)).alias("_h"),
        _int(f(10)).alias("_mi"),
        F.coalesce(_int(f(11)), F.lit(0)).alias("_s"),
        frac.alias("_us"),
        F.trim(f(13)).alias("_zone"),
        epoch.alias("_epoch"),
        (digits & F.col("_f").isNotNull()).alias("_compact"),
    )


def _month_days(y: Column, m: Column) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(F.greatest(y, F.lit(1)), F.least(F.greatest(m, F.lit(1)), F.lit(12)), F.lit(1))))


def _possible(y: Column, m: Column, d: Column) -> Column:
    return F.coalesce((y >= 1) & m.between(1, 12) & (d >= 1) & (d <= _month_days(y, m)), F.lit(False))


def readings(parts: DataFrame) -> Column:
    """For each of FORMATS 1.0 where it is a valid reading of the parts, else 0.0."""
    y, a, b, e = F.col("_y"), F.col("_a"), F.col("_b"), F.col("_epoch")
    compact = F.coalesce(F.col("_compact"), F.lit(False)) & _possible(y, F.col("_mo"), F.col("_d"))
    epoch = F.coalesce(e.isNotNull() & (~F.col("_compact") | e.between(*EPOCH_RANGE)), F.lit(False))
    return F.array(*[c.cast("double") for c in (_possible(y, b, a), _possible(y, a, b), compact, epoch)])


def format_weights(parts: DataFrame, feeds: DataFrame) -> DataFrame:
    """source, tz, declared order, and ``weights`` of FORMATS in the source's mixture.

    One pass counts each source's values by the readings that are valid for
    them; the EM rounds run inside one expression over these counts (at most one
    per combination of readings). Each component starts with one value's weight.
    """
    n = len(FORMATS)
    counts = parts.select("source", readings(parts).alias("valid")).groupBy("source", "valid").agg(F.count(F.lit(1)).cast("double").alias("n"))
    counts = counts.filter(F.exists("valid", lambda v: v > 0)).groupBy("source").agg(F.collect_list(F.struct("valid", "n")).alias("seen"))
    known = feeds.select("source", "tz", "date_order").dropDuplicates(["source"])
    j = known.join(counts, "source", "full_outer")
    none = F.array().cast("array<struct<valid:array<double>,n:double>>")
    seen = F.coalesce("seen", none)
    total = F.aggregate(seen, F.lit(float(n)), lambda acc, s: acc + s["n"])

    def step(w: Column, _: Column) -> Column:
        def count(c: int):  # the values' part that is of format c
            return lambda acc, s: acc + s["n"] * s["valid"][c] * w[c] / sum(s["valid"][k] * w[k] for k in range(n))

        return F.array(*[F.aggregate(seen, F.lit(1.0), count(c)) / total for c in range(n)])

    weights = F.aggregate(F.sequence(F.lit(1), F.lit(EM_ROUNDS)), F.array(*[F.lit(1.0 / n)] * n), step)
    return j.select("source", "tz", "date_order", weights.alias("weights"))


def resolve(df: DataFrame, raw: str, source: str, feeds: DataFrame) -> DataFrame:
    """df with epoch_us (bigint, null where the text denotes no instant) and status.

    feeds has source, tz and date_order; the weights of its sources are written
    as a table first, so that Spark knows their size when it picks the join.
    """
    spark = df.sparkSession
    keep = df.columns
    src = F.when(F.trim(F.col(source)) != "", F.col(source))
    parts = with_parts(df.select(*[F.col(c).alias(f"_in_{c}") for c in keep], F.col(raw).alias("_raw"), src.alias("source")), "_raw")
    counted = with_parts(df.select(F.col(raw).alias("_raw"), src.alias("source")).filter(F.col(raw).rlike(r"^\s*[0-9０-９]{1,2}[-/.／．－]|^\s*[0-9０-９]{9,17}\s*$")), "_raw")
    weights = materialize(format_weights(counted, feeds), "format-weights")
    zones = [r.tz for r in feeds.select("tz").where("tz is not null").distinct().limit(1000).collect()]
    abbr = abbreviations(zones)
    w = F.col("weights")
    first = lambda i, k: F.coalesce(w[i] / (w[i] + w[k]), F.lit(0.5))
    j = parts.join(weights.select("source", "tz", "date_order", first(0, 1).alias("p_dmy"), first(2, 3).alias("p_compact")), "source", "left")

    y, a, b = F.col("_y"), F.col("_a"), F.col("_b")
    can_dmy, can_mdy = _possible(y, b, a), _possible(y, a, b)
    by_values = F.coalesce("p_dmy", F.lit(0.5))
    declared = F.when(F.col("date_order") == "dmy", 1.0).when(F.col("date_order") == "mdy", 0.0)
    post = F.when(can_dmy & ~can_mdy, 1.0).when(~can_dmy & can_mdy, 0.0).when(can_dmy & can_mdy, F.coalesce(declared, by_values))
    contested = F.coalesce(can_dmy & can_mdy & (F.abs(declared - by_values) > SETTLED), F.lit(False))
    valid = readings(j)
    twice = (valid[2] > 0) & (valid[3] > 0)
    p_compact = F.when(twice, F.coalesce("p_compact", F.lit(0.5))).otherwise(valid[2])
    j = j.withColumn("_epoch", F.when(F.col("_epoch").isNotNull() & (~F.col("_compact") | (p_compact <= 1 - SETTLED)), F.col("_epoch")))
    j = j.withColumn("_open", F.coalesce(twice & (p_compact > 1 - SETTLED) & (p_compact < SETTLED), F.lit(False)))
    j = j.withColumn("_contested", contested)
    numeric = a.isNotNull()
    j = j.withColumn("_post", post)
    open_ = F.col("_open") | (numeric & (F.col("_post") > 1 - SETTLED) & (F.col("_post") < SETTLED))
    is_dmy = F.col("_post") >= SETTLED
    j = j.withColumn("_mo", F.when(numeric, F.when(is_dmy, b).otherwise(a)).otherwise(F.col("_mo")))
    j = j.withColumn("_d", F.when(numeric, F.when(is_dmy, a).otherwise(b)).otherwise(F.col("_d")))
    m, d, h = F.col("_mo"), F.col("_d"), F.col("_h")
    pm, am = F.col("_ap").isin("pm", "p.", "下午"), F.col("_ap").isin("am", "a.", "上午")
    hour = F.when(pm & (h < 12), h + 12).when(am & (h == 12), F.lit(0)).otherwise(h)
    fine = _possible(y, m, d) & hour.between(0, 23) & F.col("_mi").between(0, 59) & F.col("_s").between(0, 59)
    day = F.unix_date(F.make_date(F.greatest(y, F.lit(1)), F.least(F.greatest(m, F.lit(1)), F.lit(12)), F.lit(1))) + d - 1
    local = (day.cast("long") * 86400 + hour.cast("long") * 3600 + F.col("_mi").cast("long") * 60 + F.col("_s")) * 1_000_000 + F.col("_us")

    zone = F.regexp_replace(F.col("_zone"), r"^([+-]\d{1,2}:?\d{2}|Z) ?\[.*\]$", "$1")
    name = F.regexp_extract(zone, r"^\[?([A-Za-z]+(?:/[A-Za-z0-9_+-]+)+)\]?$", 1)
    off = r"^(?:UTC|GMT|utc|gmt)?([+-])(\d{1,2}):?(\d{2})?$"
    minutes = F.when(zone.rlike(off), F.regexp_extract(zone, off, 2).cast("int") * 60 + F.coalesce(_int(F.regexp_extract(zone, off, 3)), F.lit(0))) * F.when(F.regexp_extract(zone, off, 1) == "-", -1).otherwise(1)
    fixed = [x for (z, s), o in abbr.items() if o is not None for x in (f"{z} {s}", o)]
    table = F.create_map(*map(F.lit, fixed)) if fixed else F.create_map().cast("map<string,int>")
    several = [f"{z} {s}" for (z, s), o in abbr.items() if o is None]
    minutes = F.when(F.upper(zone).isin("Z", "UTC", "GMT"), F.lit(0)).when(zone.rlike("^[A-Za-z]{2,5}$"), F.try_element_at(table, F.concat_ws(" ", "tz", F.upper(zone)))).otherwise(minutes)
    known = F.array(*[F.lit(z) for z in _zone_ids()])
    tz = F.when((zone == "") | F.concat_ws(" ", "tz", F.upper(zone)).isin(several), F.col("tz")).when(name != "", F.when(F.array_contains(known, name), name))
    j = j.withColumn("_local", F.when(fine & ~F.coalesce(open_, F.lit(False)), local)).withColumn("_min", minutes).withColumn("_tz", tz)
    by_tz = F.when(F.col("_tz").isNotNull() & F.col("_local").isNotNull(), F.unix_micros(F.to_utc_timestamp(F.timestamp_micros("_local"), F.col("_tz"))))
    instant = F.when(F.col("_epoch").isNotNull(), F.col("_epoch")).when(F.col("_min").isNotNull(), F.col("_local") - F.col("_min").cast("long") * 60_000_000).otherwise(by_tz)
    j = j.withColumn("_instant", instant)
    status = (
        F.when(F.col("_instant").isNotNull() & F.col("_contested"), "contested")
        .when(F.col("_instant").isNotNull(), "instant")
        .when(F.col("_t").isNull() | (F.col("_t") == ""), "blank")
        .when(F.coalesce(open_, F.lit(False)), "ambiguous")
        .when(F.col("_local").isNotNull(), "no zone")
        .otherwise("no instant")
    )
    # the generator keeps a later filter from being pushed into (and repeating) all expressions above
    out = j.select(*[F.col(f"_in_{c}").alias(c) for c in keep], F.explode(F.array(F.struct(F.col("_instant").alias("epoch_us"), status.alias("status")))).alias("_r"))
    return out.select(*keep, "_r.epoch_us", "_r.status")


def _zone_ids() -> list[str]:
    from zoneinfo import available_timezones

    return sorted(z for z in available_timezones() if "/" in z)
