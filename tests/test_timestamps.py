"""The commonest timestamp forms, which are cast, against Python's datetime."""

import random
from datetime import datetime, timezone

from pyspark.sql import functions as F

from textlake.functions import timestamps

FORMS = [
    "%Y-%m-%d", "%Y/%m/%d", "%Y-%m-%d %H:%M", "%Y/%m/%d %H:%M", "%Y-%m-%dT%H:%M:%S",
    "%Y/%m/%dT%H:%M:%S", "%Y-%m-%d %H:%M:%SZ", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S.%fZ",
    "%Y-%m-%d %H:%MZ",
]


def test_plain_forms_in_any_zone(spark):
    random.seed(8)
    cases = []
    for number in range(400):
        at = datetime.fromtimestamp(random.randrange(-10 ** 9, 4 * 10 ** 9), timezone.utc).replace(
            microsecond=random.randrange(10 ** 6))
        form = FORMS[number % len(FORMS)]
        text = at.strftime(form)
        assert not text[4:5].isdigit()
        cut = {"%f": {}, "%S": {"microsecond": 0}, "%M": {"second": 0, "microsecond": 0},
               "%d": {"hour": 0, "minute": 0, "second": 0, "microsecond": 0}}
        unit = next(u for u in cut if u in form)
        cases.append((text, int(at.replace(**cut[unit]).timestamp() * 10 ** 6 + (
            0.5 if unit == "%f" else 0))))
    bad = ["2018-13-01", "2018-02-30", "2018-01-01 25:00", "2018-01-01 24:00:00", "no digits", "",
           None]
    df = spark.createDataFrame([(t,) for t, _ in cases] + [(t,) for t in bad], "t string")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            rows = df.select("t", F.unix_micros(timestamps.parse_mixed(F.col("t"))).alias("u"))
            found = [(r["t"], r["u"]) for r in rows.collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        for (text, told), (_, want) in zip(found, cases):
            assert told is not None and abs(told - want) <= 1, text
        assert [u for _, u in found[len(cases):]] == [None] * len(bad)


def test_plain_forms_equal_the_general_ones(spark, monkeypatch):
    texts = ["2018-01-25", "2018/01/25", "2018-01-25 10:00", "2018/01/25T10:00:59.5Z",
             "2018-01-25 10:00:60", "2018-01-25T10:00:00.123456789", "2018-02-29", " 2018-01-25 ",
             "2018-01-25 10:00:00 Z", "0001-01-01", "9999-12-31 23:59:59", "2018-01-25Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def parsed():
        return [r[0] for r in df.select(F.unix_micros(timestamps.parse_mixed(F.col("t")))).collect()]

    found = parsed()
    monkeypatch.setattr(timestamps, "PLAIN", "^never$")
    assert parsed() == found
