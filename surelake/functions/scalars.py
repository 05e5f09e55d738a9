"""Column functions shared by the operators. Nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes

Col = Column | str


def col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- predicates


def not_blank(c: Col) -> Column:
    """True for non-empty text; NULL and '' are both dropped by a filter."""
    return F.length(col(c).cast("string")) > 0


def valid_policy(status: Col = "policy_status") -> Column:
    return col(status).isin(*codes.VALID_STATUS)


def in_force(status: Col = "policy_status") -> Column:
    return col(status).isin(*codes.IN_FORCE_STATUS)


def has_chinese(c: Col) -> Column:
    return col(c).rlike(codes.CHINESE)


def has_digit(c: Col) -> Column:
    return col(c).rlike("\\d")


def has_latin(c: Col) -> Column:
    return col(c).rlike("[A-Za-z]")


def is_signed_digits(c: Col) -> Column:
    """Optional sign followed by digits only; the empty text passes."""
    return col(c).rlike("^[-+]?\\d*$")


def excluded_or_null(c: Col, *values: str) -> Column:
    """``not in`` that keeps NULL rows."""
    return ~col(c).isin(*values) | col(c).isNull()


def id_card_valid(c: Col) -> Column:
    return col(c).rlike(codes.ID_CARD_15) | col(c).rlike(codes.ID_CARD_18)


def id_card_plausible(c: Col) -> Column:
    """18 characters, 17 leading digits, born in a 19xx or 20xx year."""
    c = col(c)
    return (F.length(c) == 18) & c.rlike("^[0-9]{17}") & F.substring(c, 7, 2).isin("19", "20")


def position_of(c: Col, pattern: str) -> Column:
    """0-based index of the first occurrence, -1 when absent."""
    return F.instr(col(c), pattern) - 1


# ------------------------------------------------------------------- amounts


def clean_amount(c: Col) -> Column:
    """Amount text to decimal; dirty tokens, Chinese text and NULL give NULL."""
    c = F.trim(col(c).cast("string"))
    return F.when(~c.isin(*codes.DIRTY_AMOUNTS) & ~has_chinese(c), c.try_cast("decimal(20,4)"))


def payable(final: Col = "final_payment", expected: Col = "pre_com") -> Column:
    """Final payment when present, else the expected one, as a clean amount.

    A row whose expected amount holds Chinese text is dropped whatever its final payment.
    """
    chosen = F.coalesce(F.nullif(col(final), F.lit("")), col(expected))
    return F.when(~F.coalesce(has_chinese(expected), F.lit(False)), clean_amount(chosen))


def strip_point(c: Col) -> Column:
    """'12.500' -> '12.5', '12.000' -> '12'; text without a point is unchanged."""
    c = col(c)
    trimmed = F.regexp_replace(F.regexp_replace(c, "0+$", ""), "\\.$", "")
    return F.when(F.instr(c, ".") > 0, trimmed).otherwise(c)


def ratio(n: Col, d: Col) -> Column:
    n, d = col(n).cast("double"), col(d).cast("double")
    return F.when(d != 0, n / F.nullif(d, F.lit(0.0)))


# --------------------------------------------------------------------- dates


def day(c: Col) -> Column:
    """Date part of a date, a timestamp or ISO text; NULL when it is none of these."""
    return col(c).try_cast("date")


def slash_day(c: Col) -> Column:
    """Strict ``yyyy/M/d`` text to date; anything else is NULL."""
    return F.try_to_timestamp(col(c).cast("string"), F.lit("yyyy/M/d")).cast("date")


def day_id(c: Col) -> Column:
    return F.date_format(col(c), "yyyyMMdd")


def month_id(c: Col) -> Column:
    return F.date_format(col(c), "yyyyMM")


def month_start(c: Col) -> Column:
    """``yyyyMM`` text to the first day of that month."""
    return F.try_to_timestamp(F.concat(col(c).cast("string"), F.lit("01")), F.lit("yyyyMMdd")).cast("date")


def month_number(c: Col) -> Column:
    """``yyyyMM`` text as a running month count (for gaps and islands)."""
    c = col(c).cast("string")
    return F.substring(c, 1, 4).try_cast("int") * 12 + F.substring(c, 5, 2).try_cast("int")


def shift_month(c: Col, n: int) -> Column:
    return month_id(F.add_months(month_start(c), n))


def plus_hours(c: Col, hours: int) -> Column:
    return col(c) + F.expr(f"INTERVAL {int(hours)} HOURS")


def plus_hours_text(c: Col, hours: int) -> Column:
    ts = F.try_to_timestamp(col(c), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.date_format(plus_hours(ts, hours), "yyyy-MM-dd HH:mm:ss")


def plus_hours_time_of_day(c: Col, hours: int) -> Column:
    """'HH:mm:ss' moved forward, wrapping at midnight."""
    ts = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), col(c)), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.date_format(plus_hours(ts, hours), "HH:mm:ss")


def plus_day(c: Col) -> Column:
    return F.date_add(day(c), 1)


def days(first: Col, last: Col) -> Column:
    """Every day from first to last, both included; empty when reversed or NULL."""
    first, last = col(first), col(last)
    return F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY")))


def months(first: Col, last: Col) -> Column:
    first, last = F.trunc(col(first), "month"), F.trunc(col(last), "month")
    return F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))


def day_count(first: Col, last: Col) -> Column:
    return F.datediff(col(last), col(first)) + 1


def iso_weekday(c: Col) -> Column:
    return F.weekday(col(c)) + 1


def abs_days(a: Col, b: Col) -> Column:
    return F.abs(F.datediff(col(a), col(b)))


def epoch_millis(c: Col) -> Column:
    return F.unix_millis(col(c).cast("timestamp"))


def from_millis(c: Col) -> Column:
    return F.timestamp_millis(col(c))


def _later_in_year(a: Column, b: Column) -> Column:
    """Month and day of b are on or after those of a."""
    return (F.month(b) * 100 + F.dayofmonth(b)) >= (F.month(a) * 100 + F.dayofmonth(a))


def completed_years(first: Col, last: Col) -> Column:
    a, b = day(first), day(last)
    return F.year(b) - F.year(a) - F.when(_later_in_year(a, b), 0).otherwise(1)


def whole_months(first: Col, last: Col) -> Column:
    """Calendar months from first to last; a month counts once its day is reached,
    with the day clipped to the length of the later month (30 Jan to 28 Feb is one)."""
    a, b = day(first), day(last)
    span = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    return span - F.when(F.dayofmonth(b) >= F.least(F.dayofmonth(a), F.dayofmonth(F.last_day(b))), 0).otherwise(1)


# ------------------------------------------------------------------ id cards


def id_birthday(c: Col) -> Column:
    return F.try_to_timestamp(F.substring(col(c), 7, 8), F.lit("yyyyMMdd")).cast("date")


def id_age(c: Col, at: Col) -> Column:
    """Age in the running year of life at a date; 0 without a usable card or date."""
    born, at = id_birthday(c), day(at)
    age = F.year(at) - F.year(born) + F.when(_later_in_year(born, at), 1).otherwise(0)
    return F.when(F.length(col(c)) == 18, F.greatest(F.coalesce(age, F.lit(0)), F.lit(0))).otherwise(F.lit(0))


def id_age_by_days(c: Col, at: Col) -> Column:
    """Whole 365-day spans plus one; -1 when unknown."""
    span = F.datediff(day(at), id_birthday(c))
    return F.when(F.length(col(c)) == 18, F.coalesce(F.floor(span / 365) + 1, F.lit(-1))).otherwise(F.lit(-1)).cast("int")


def id_age_rounded(c: Col, at: Col) -> Column:
    """Day count over 365, rounded; -1 when unknown."""
    span = F.datediff(day(at), id_birthday(c))
    return F.when(F.length(col(c)) == 18, F.coalesce(F.round(span / 365), F.lit(-1))).otherwise(F.lit(-1)).cast("int")


def id_gender(c: Col) -> Column:
    digit = F.substring(col(c), -2, 1).try_cast("int")
    return F.when(digit % 2 == 0, codes.FEMALE).when(digit % 2 == 1, codes.MALE)


def id_is_male(c: Col) -> Column:
    return F.substring(col(c), -2, 1).try_cast("int") % 2


def id_birth_year(c: Col) -> Column:
    return F.substring(col(c), 7, 4).try_cast("int")


def id_region(c: Col, level: str) -> Column:
    """Six-digit region code at province, city or county level."""
    keep = {"province": 2, "city": 4, "county": 6}[level]
    return F.rpad(F.substring(col(c), 1, keep), 6, "0")


def id_constellation_key(c: Col) -> Column:
    return F.substring(col(c), 11, 4)


# ---------------------------------------------------------------------- text


def keep_chinese(c: Col) -> Column:
    return F.coalesce(F.regexp_replace(col(c), "[^\\u4E00-\\u9FA5]", ""), F.lit("null"))


def keep_digits(c: Col) -> Column:
    return F.regexp_replace(col(c), "[^0-9]", "")


def drop_newlines(c: Col) -> Column:
    return F.regexp_replace(col(c), "\\n", "")


def squeeze_blanks(c: Col) -> Column:
    return F.regexp_replace(col(c), "\\s", "")


def null_if_blank(c: Col) -> Column:
    """The three encodings of missing text ('' , 'null', NULL) made one."""
    t = F.trim(col(c).cast("string"))
    return F.nullif(F.nullif(t, F.lit("")), F.lit("null"))


def count_equal(arr: Col, value) -> Column:
    return F.size(F.filter(col(arr), lambda x: x == value))


def words(c: Col, min_length: int = 2) -> Column:
    """Lower-case runs of Latin or Chinese letters of at least ``min_length``."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(f"([a-z\\u4e00-\\u9fa5]{{{int(min_length)},}})"), F.lit(1))


def patch_json_map(c: Col, bad: str, good: str) -> Column:
    """Replace every field equal to ``bad`` in a flat JSON object."""
    m = F.from_json(col(c), "map<string,string>")
    return F.to_json(F.transform_values(m, lambda _, v: F.when(v == bad, F.lit(good)).otherwise(v)))


# -------------------------------------------------------------------- scores


def banded(x: Col, bands: list[tuple[float, float, float, float]], beyond: Column | None = None) -> Column:
    """Piecewise linear score; a band is (from, to, score_from, score_to), ``to`` excluded."""
    x = col(x).cast("double")
    out = None
    for lo, hi, s_lo, s_hi in bands:
        part = F.round(((s_hi - s_lo) * ((x - lo) / (hi - lo)) + s_lo).cast("decimal(20,8)"), 2).cast("double")  # halves exactly
        cond = (x >= lo) & (x < hi)
        out = F.when(cond, part) if out is None else out.when(cond, part)
    return out.otherwise(F.lit(0.0) if beyond is None else beyond)


# Score bands and weights of the enterprise value score.
PEOPLE_BANDS = [(0, 1000, 0, 30), (1000, 5000, 30, 50), (5000, 10000, 50, 80), (10000, 50000, 80, 100)]
PREMIUM_BANDS = [(0, 1e5, 0, 50), (1e5, 6e5, 50, 80), (6e5, 2e6, 80, 100)]
GROWTH_BANDS = [(0, 50, 0, 50), (50, 100, 50, 100)]
SCORE_WEIGHTS = (0.30, 0.35, 0.35)


def value_score_parts(people: Col, premium: Col, growth: Col) -> tuple[Column, Column, Column]:
    wp, wm, wg = SCORE_WEIGHTS
    g = col(growth).cast("double")
    return (
        banded(people, PEOPLE_BANDS) * wp,
        banded(premium, PREMIUM_BANDS) * wm,
        banded(g, GROWTH_BANDS, F.when(g >= 100, 100.0).otherwise(0.0)) * wg,
    )


def value_score(people: Col, premium: Col, growth: Col) -> Column:
    a, b, c = value_score_parts(people, premium, growth)
    return a + b + c


def max_of_three(a: Col, b: Col, c: Col) -> Column:
    """Largest of three; -1 when the largest value is shared."""
    a, b, c = col(a), col(b), col(c)
    top = F.greatest(a, b, c)
    hits = sum((x == top).cast("int") for x in (a, b, c))
    return F.when(hits > 1, F.lit(-1.0)).otherwise(top)


def char_counts(c: Col) -> Column:
    """Map of character to its number of occurrences."""
    chars = F.split(col(c), "")
    return F.map_from_entries(
        F.transform(F.array_distinct(chars), lambda x: F.struct(x, F.size(F.filter(chars, lambda y: y == x))))
    )


def char_norm(counts: Col) -> Column:
    """Length of a character-count vector."""
    return F.sqrt(F.aggregate(F.map_values(col(counts)), F.lit(0.0), lambda s, v: s + v * v))


def count_cosine(a: Col, norm_a: Col, b: Col, norm_b: Col) -> Column:
    """Cosine of two character-count vectors whose lengths are known, at most 1."""
    ta, tb = col(a), col(b)
    dot = F.aggregate(
        F.map_keys(ta), F.lit(0.0), lambda s, k: s + F.coalesce(F.try_element_at(ta, k) * F.try_element_at(tb, k), F.lit(0))
    )
    return F.least(dot / (col(norm_a) * col(norm_b)), F.lit(1.0))


def char_cosine(a: Col, b: Col) -> Column:
    """Cosine of the character-count vectors of two texts, at most 1."""
    ta, tb = char_counts(a), char_counts(b)
    return count_cosine(ta, char_norm(ta), tb, char_norm(tb))


# Positions inside the five-digit term code.
TERM_PARTS = {"sku_coverage": (1, 2), "sku_append": (3, 1), "sku_charge_type": (4, 1), "sku_ratio": (5, 1)}


def term_part(term_three: Col, part: str, term_one: Col | None = None) -> Column:
    """One field of the term code; coverage falls back to the older term when the code is not five digits."""
    start, length = TERM_PARTS[part]
    t = col(term_three).cast("string")
    out = F.when(F.length(t) == 5, F.substring(t, start, length))
    return out.otherwise(col(term_one).cast("string")) if term_one is not None and part == "sku_coverage" else out


def register_udfs(spark) -> None:
    """SQL names for the helpers the jobs call from SQL text."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION getUUID() RETURNS STRING NOT DETERMINISTIC RETURN replace(uuid(), '-', '')")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION getNull() RETURNS STRING RETURN ''")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION getAgeFromBirthTime(cert STRING, at DATE) RETURNS INT RETURN "
        "CASE WHEN length(cert) = 18 THEN greatest(coalesce(year(at) - cast(substr(cert, 7, 4) AS INT) + "
        "CASE WHEN month(at) * 100 + day(at) >= cast(substr(cert, 11, 4) AS INT) THEN 1 ELSE 0 END, 0), 0) ELSE 0 END"
    )
