from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patronlens.functions import month_day_to_date
from patronlens.sources import count_bad_days


def convert(spark, texts, year=2014, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", month_day_to_date(F.col("t"), year, **options).alias("d")).collect()
    return [r.d for r in sorted(rows)]


def rolled(year, month, day):
    years, months = divmod(month - 1, 12)
    return date(year + years, months + 1, 1) + timedelta(days=day - 1)


def test_plain_and_overflowing_days(spark):
    texts = ["0511", "1111", "0229", "0532", "1301", "0001", "0100", "11110930"]
    assert convert(spark, texts) == [
        date(2014, 5, 11), date(2014, 11, 11), date(2014, 3, 1), date(2014, 6, 1),
        date(2015, 1, 1), date(2013, 12, 1), date(2013, 12, 31), date(2014, 11, 11),
    ]


def test_leap_year_keeps_29_february(spark):
    assert convert(spark, ["0229"], year=2016) == [date(2016, 2, 29)]


def test_bad_text_is_null_and_counted(spark):
    texts = ["", "511", None, "ab11", "5.11", "0511"]
    assert convert(spark, texts) == [None] * 5 + [date(2014, 5, 11)]
    log = spark.createDataFrame([(t,) for t in texts], "time_stamp string")
    assert tuple(count_bad_days(log).first()) == (6, 5)


def test_bad_text_can_fail(spark):
    assert convert(spark, ["0511"], on_bad="fail") == [date(2014, 5, 11)]
    with pytest.raises(Exception, match="not an MMdd day: 511"):
        convert(spark, ["511"], on_bad="fail")
    with pytest.raises(ValueError):
        month_day_to_date(F.lit("0511"), 2014, on_bad="ignore")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 99), st.integers(0, 99)), min_size=1, max_size=200))
def test_any_four_digits(spark, days):
    got = convert(spark, [f"{m:02d}{d:02d}" for m, d in days])
    assert got == [rolled(2014, m, d) for m, d in days]
