"""Column functions on hand-made values."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surelake.functions import scalars as S


def one(spark, column, **values):
    types = ", ".join(f"{k} {'string' if isinstance(v, (str, type(None))) else 'double' if isinstance(v, float) else 'bigint'}" for k, v in values.items())
    df = spark.createDataFrame([tuple(values.values()) or (1,)], types or "x int")
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("text,value", [("12.5", 12.5), (".", None), ("#N/A", None), ("", None), ("约100", None), (None, None), (" 7 ", 7.0), ("-3", -3.0)])
def test_clean_amount(spark, text, value):
    got = one(spark, S.clean_amount("t"), t=text)
    assert (None if got is None else float(got)) == value


@pytest.mark.parametrize("final,pre,value", [("5", "9", 5.0), ("", "9", 9.0), (None, "9", 9.0), ("5", "待定", None), ("", "#N/A", None), ("", None, None)])
def test_payable(spark, final, pre, value):
    got = one(spark, S.payable("f", "p"), f=final, p=pre)
    assert (None if got is None else float(got)) == value


CARD = "110101199005101234"


@pytest.mark.parametrize("at,age", [("2020-05-09", 30), ("2020-05-10", 31), ("1980-01-01", 0), (None, 0)])
def test_id_age_counts_the_running_year(spark, at, age):
    assert one(spark, S.id_age("c", "d"), c=CARD, d=at) == age


def test_id_age_needs_18_characters(spark):
    assert one(spark, S.id_age("c", "d"), c="123", d="2020-01-01") == 0
    assert one(spark, S.id_age_by_days("c", "d"), c="123", d="2020-01-01") == -1
    assert one(spark, S.id_age_by_days("c", "d"), c=CARD, d="1990-05-11") == 1


@pytest.mark.parametrize("a,b,years", [("1992-02-29", "2021-02-28", 28), ("1992-02-29", "2021-03-01", 29), ("2000-01-01", "2000-12-31", 0)])
def test_completed_years(spark, a, b, years):
    assert one(spark, S.completed_years("a", "b"), a=a, b=b) == years


@pytest.mark.parametrize("a,b,months", [("2019-01-30", "2019-02-28", 1), ("2019-01-31", "2019-02-27", 0), ("2019-01-15", "2020-01-15", 12), ("2019-01-15", "2020-01-14", 11)])
def test_whole_months(spark, a, b, months):
    assert one(spark, S.whole_months("a", "b"), a=a, b=b) == months


def test_value_score(spark):
    assert one(spark, F.round(S.value_score("p", "m", "g"), 6), p=1000.0, m=100000.0, g=50.0) == 44.0
    assert one(spark, S.value_score("p", "m", "g"), p=60000.0, m=3e6, g=-1.0) == 0.0
    assert one(spark, F.round(S.value_score("p", "m", "g"), 6), p=0.0, m=0.0, g=150.0) == 35.0


@pytest.mark.parametrize("a,b,want", [("abca", "abca", 1.0), ("ab", "cd", 0.0), ("aab", "ab", 3 / (5**0.5 * 2**0.5))])
def test_char_cosine(spark, a, b, want):
    assert one(spark, S.char_cosine("a", "b"), a=a, b=b) == pytest.approx(want)


@pytest.mark.parametrize("a,b,c,want", [(1.0, 2.0, 3.0, 3.0), (3.0, 3.0, 1.0, -1.0), (1.0, 1.0, 3.0, 3.0), (1.0, 3.0, 3.0, -1.0), (2.0, 2.0, 2.0, -1.0)])
def test_max_of_three(spark, a, b, c, want):
    assert one(spark, S.max_of_three("a", "b", "c"), a=a, b=b, c=c) == want


@pytest.mark.parametrize("t,want", [("12.500", "12.5"), ("12.000", "12"), ("100", "100")])
def test_strip_point(spark, t, want):
    assert one(spark, S.strip_point("t"), t=t) == want


def test_time_shift(spark):
    assert one(spark, S.plus_hours_text("t", 8), t="2019-12-31 20:00:00") == "2020-01-01 04:00:00"
    assert one(spark, S.plus_hours_time_of_day("t", 8), t="20:30:00") == "04:30:00"
    assert one(spark, S.plus_day("t"), t="2019-02-28") == dt.date(2019, 3, 1)
    assert one(spark, S.shift_month("t", -2), t="201901") == "201811"
    assert one(spark, S.epoch_millis(F.to_timestamp("t")), t="1970-01-01 00:00:01") == 1000


def test_predicates(spark):
    assert one(spark, S.id_card_valid("c"), c=CARD)
    assert not one(spark, S.id_card_valid("c"), c="010101199005101234")
    assert not one(spark, S.id_card_plausible("c"), c="110101209005101234"[:17])
    assert one(spark, S.is_signed_digits("c"), c="") and not one(spark, S.is_signed_digits("c"), c="1a")
    assert one(spark, S.excluded_or_null("c", "x"), c=None) and not one(spark, S.excluded_or_null("c", "x"), c="x")
    assert one(spark, S.position_of("c", "b"), c="abc") == 1 and one(spark, S.position_of("c", "z"), c="abc") == -1
    assert one(spark, S.slash_day("c"), c="2017/13/40") is None
    assert one(spark, S.null_if_blank("c"), c="null") is None
    assert one(spark, S.keep_chinese("c"), c=None) == "null"


def test_dates_between(spark):
    assert one(spark, F.size(S.days(F.to_date("a"), F.to_date("b"))), a="2020-02-27", b="2020-03-01") == 4
    assert one(spark, F.size(S.months(F.to_date("a"), F.to_date("b"))), a="2019-11-30", b="2020-02-01") == 4
    assert one(spark, S.days(F.to_date("a"), F.to_date("b")), a="2020-03-02", b="2020-03-01") is None


def test_patch_json(spark):
    assert one(spark, S.patch_json_map("j", "Infinity", "0.0000"), j='{"a":"Infinity","b":"1"}') == '{"a":"0.0000","b":"1"}'


def test_registered_functions(spark):
    S.register_udfs(spark)
    row = spark.sql(f"SELECT getAgeFromBirthTime('{CARD}', DATE '2020-05-10') AS a, getNull() AS n, length(getUUID()) AS u").first()
    assert (row.a, row.n, row.u) == (31, "", 32)


@settings(max_examples=15, deadline=None)
@given(born=st.dates(dt.date(1950, 1, 1), dt.date(2000, 12, 31)), at=st.dates(dt.date(2001, 1, 1), dt.date(2030, 12, 31)))
def test_age_property(spark, born, at):
    done = at.year - born.year - ((at.month, at.day) < (born.month, born.day))
    card = f"110101{born:%Y%m%d}1234"
    assert one(spark, S.completed_years("b", "d"), b=born.isoformat(), d=at.isoformat()) == done
    assert one(spark, S.id_age("c", "d"), c=card, d=at.isoformat()) == done + 1
