from datetime import datetime, timezone

from flashmill.operators import timestamps

FEEDS = [("cn", "Asia/Shanghai", "ymd"), ("us", "America/New_York", "mdy"), ("ch", "Europe/Zurich", "dmy"), ("free", "Europe/London", None)]


def utc(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1_000_000)


def resolve(spark, rows):
    feeds = spark.createDataFrame(FEEDS, "source string, tz string, date_order string")
    df = spark.createDataFrame([(i, t, s, "k") for i, (t, s) in enumerate(rows)], "id long, t string, source string, status_ string")
    out = {r.id: (r.epoch_us, r.status) for r in timestamps.resolve(df, "t", "source", feeds).collect()}
    return [out[i] for i in range(len(rows))]


def test_notations(spark):
    cases = [
        ("2024-06-01 18:04", "cn", utc(2024, 6, 1, 10, 4)),
        ("２０２４－０６－０１ １８：０４：０５", "cn", utc(2024, 6, 1, 10, 4, 5)),
        ("2024年6月1日 12时05分", "cn", utc(2024, 6, 1, 4, 5)),
        ("2024-06-03 下午2:45", "cn", utc(2024, 6, 3, 6, 45)),
        ("3/4/2024 07:00", "us", utc(2024, 3, 4, 12)),
        ("3/4/2024 07:00", "ch", utc(2024, 4, 3, 5)),
        ("04.06.2024 16:15", "ch", utc(2024, 6, 4, 14, 15)),
        ("Jun 2, 2024 6:37 PM GMT+8", "us", utc(2024, 6, 2, 10, 37)),
        ("Sat, 01 Jun 2024 11:00:16 +0530", None, utc(2024, 6, 1, 5, 30, 16)),
        ("2024-06-01 18:35:43 CEST", "ch", utc(2024, 6, 1, 16, 35, 43)),
        ("2024-06-01T12:00:00.5Z", None, utc(2024, 6, 1, 12) + 500_000),
        ("2024-06-01 12:00:00[America/New_York]", "cn", utc(2024, 6, 1, 16)),
        ("20240601T035159", "cn", utc(2024, 5, 31, 19, 51, 59)),
        ("1717227166", None, 1717227166_000_000),
        ("1717227166123", "cn", 1717227166_123_000),
        ("1717277526946902", "cn", 1717277526946902),
        ("2024-03-31 02:30:00", "ch", utc(2024, 3, 31, 1, 30)),  # skipped: moved on by the gap
        ("2024-10-27 02:30:00", "ch", utc(2024, 10, 27, 0, 30)),  # twice: the first
    ]
    got = resolve(spark, [c[:2] for c in cases])
    assert [g[0] for g in got] == [c[2] for c in cases]


def test_no_instant(spark):
    cases = [(None, "cn"), ("", "cn"), ("  ", "cn"), ("2024-06-02", "cn"), ("10:15", "cn"), ("2024-02-30 10:00", "cn"), ("2024-06-02 24:10", "cn"), ("刚刚", "cn"), ("2024-06-01 18:04", None), ("2024-06-01 18:04", " "), ("2024-06-01 18:04 XYZ", "cn"), ("pending", "cn")]
    assert [g[0] for g in resolve(spark, cases)] == [None] * len(cases)


def test_mixture_settles_an_undeclared_order(spark):
    rows = [(f"{d}/5/2024 10:00", "free") for d in range(13, 29)] + [("3/4/2024 10:00", "free")]
    assert resolve(spark, rows)[-1][0] == utc(2024, 4, 3, 9)
    assert resolve(spark, [("3/4/2024 10:00", "free")])[0] == (None, "ambiguous")


def test_an_abbreviation_with_several_offsets(spark):
    feeds = spark.createDataFrame([("m", "Europe/Moscow", "dmy")], "source string, tz string, date_order string")
    df = spark.createDataFrame([("2013-01-05 10:00 MSK", "m"), ("2025-01-05 10:00 MSK", "m")], "t string, source string")
    got = [r.epoch_us for r in timestamps.resolve(df, "t", "source", feeds).orderBy("t").collect()]
    assert got == [utc(2013, 1, 5, 6), utc(2025, 1, 5, 7)]


def test_values_against_the_declared_order_are_marked(spark):
    rows = [(f"{d}/5/2024 10:00", "us") for d in range(13, 29)] + [("3/4/2024 10:00", "us")]
    assert resolve(spark, rows)[-1] == (utc(2024, 3, 4, 15), "contested")
    assert resolve(spark, [("5/14/2024 10:00", "us"), ("3/4/2024 10:00", "us")])[-1] == (utc(2024, 3, 4, 15), "instant")


def test_rows_of_digits(spark):
    assert [g[0] for g in resolve(spark, [("202601021530", "cn"), ("20260102153000", "cn"), ("1767225600", "cn")])] == [utc(2026, 1, 2, 7, 30), utc(2026, 1, 2, 7, 30), 1767225600_000_000]


def test_empty(spark):
    assert resolve(spark, []) == []
