"""Scalar expressions of the domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
FREE_THROW_WEIGHT = 0.44
DISTANCE_WEIGHT = 5
SEASON_START_MONTH = 10
NEW_SEASON_MONTH = 8
ID_WIDTH = 10
DAYS_PER_YEAR = 365.25
PROBABILITY_FLOOR = 1e-6
LIVE_CLOCK = r"^\s*([+-]?\d+)\s*:\s*([+-]?\d+)\s*$"
FEET_INCHES = r"^\s*(\d+)\s*-\s*(\d+)\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def true_shooting(points="points", fga="fga", fta="fta") -> Column:
    """Points per two shooting possessions; NULL when there was no attempt."""
    attempts = _col(fga).cast("double") + F.lit(FREE_THROW_WEIGHT) * _col(fta).cast("double")
    return F.when(attempts > 0, _col(points).cast("double") / (2 * attempts))


def load_index(minutes="minutes", distance="distance_miles") -> Column:
    covered = F.coalesce(_col(distance).cast("double"), F.lit(0.0))
    return _col(minutes).cast("double") + covered * DISTANCE_WEIGHT


def safe_ratio(numerator, denominator) -> Column:
    """NULL instead of a division by zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def round_half_up(c, places: int) -> Column:
    """Round as a decimal, half away from zero, so that binary noise does not decide a tie."""
    return F.round(_col(c).cast("decimal(28,9)"), places).cast("double")


def at_scale(c, precision: int, places: int) -> Column:
    """The value as a fixed-scale numeric column of a table would hold it."""
    return F.round(_col(c).cast("decimal(28,9)"), places).cast(f"decimal({precision},{places})")


def pad_id(c) -> Column:
    """Zero-pad to ten characters. Longer ids stay whole (``lpad`` alone would cut them)."""
    text = _col(c).cast("string")
    return F.when(F.length(text) < ID_WIDTH, F.lpad(text, ID_WIDTH, "0")).otherwise(text)


def season_of_year(start_year) -> Column:
    """2023 -> '2023-24', 1999 -> '1999-00'."""
    year = _col(start_year).cast("int")
    return F.concat(year.cast("string"), F.lit("-"),
                    F.lpad(F.pmod(year + 1, F.lit(100)).cast("string"), 2, "0"))


def season_of_date(day) -> Column:
    """August opens a new season."""
    d = _col(day)
    return season_of_year(F.when(F.month(d) >= NEW_SEASON_MONTH, F.year(d)).otherwise(F.year(d) - 1))


def season_start(season) -> Column:
    """October 1 of the season's first year; NULL for a label that does not start with a year."""
    year = F.split_part(_col(season), F.lit("-"), F.lit(1)).try_cast("int")
    return F.when(year.between(1, 9999), F.make_date(year, F.lit(SEASON_START_MONTH), F.lit(1)))


def whole_years(start, end) -> Column:
    """Completed years between two dates, the way an age is counted."""
    return F.floor(F.months_between(_col(end), _col(start)) / 12).cast("int")


def age_in_years(birth, day) -> Column:
    return F.datediff(_col(day), _col(birth)) / F.lit(DAYS_PER_YEAR)


def week_start(day) -> Column:
    """The Monday of the week."""
    return F.date_trunc("week", _col(day)).cast("date")


def clip(c, low: float, high: float) -> Column:
    x = _col(c)
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(high)), F.lit(low)))


def clip_probability(c) -> Column:
    return clip(_col(c).cast("double"), PROBABILITY_FLOOR, 1 - PROBABILITY_FLOOR)


def back_to_back(days_rest) -> Column:
    """1 when at most one day passed. No earlier contest counts as rested."""
    return F.coalesce(_col(days_rest) <= 1, F.lit(False)).cast("int")


def rest_bucket(days_rest, one_day: str) -> Column:
    """Exactly 1 and exactly 2 days have their own bucket; everything else, 0 included, is the third."""
    rest = _col(days_rest)
    return F.when(rest == 1, one_day).when(rest == 2, "2 days rest").otherwise("3+ days rest")


def rest_advantage(days_rest="days_rest", opponent="opponent_days_rest") -> Column:
    return F.coalesce(_col(days_rest), F.lit(0)) - F.coalesce(_col(opponent), F.lit(0))


def numeric_or_zero(c) -> Column:
    """Anything that is not a number becomes 0."""
    return F.coalesce(F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double")), F.lit(0.0))


def parse_minutes(raw, live: bool = False) -> Column:
    """Playing time in minutes.

    Bulk files write ``MM:SS``, ``MM`` or ``MM.000000:SS`` and the minute part is truncated.
    The live feed writes ``MM:SS`` or a plain number that keeps its fraction. Junk is 0.
    """
    text = _col(raw).cast("string")
    if live:
        minutes = F.regexp_extract(text, LIVE_CLOCK, 1).try_cast("int")
        seconds = F.regexp_extract(text, LIVE_CLOCK, 2).try_cast("int")
        clock = F.when(text.rlike(LIVE_CLOCK), F.round(minutes + seconds / 60, 2))
        # as most are written: digits on both sides of the colon, without the patterns, which take far longer
        before, after = (F.substring_index(text, ":", side).try_cast("int") for side in (1, -1))
        plain = F.translate(text, "0123456789", "") == ":"
        return (F.when(plain, F.coalesce(F.round(before + after / 60, 2), F.lit(0.0)))
                .when(text.contains(":"), F.coalesce(clock, F.lit(0.0))).otherwise(numeric_or_zero(text)))
    parts = F.split(F.trim(text), ":")
    minutes, seconds = _unsigned(F.get(parts, F.lit(0)), "double"), _unsigned(F.get(parts, F.lit(1)), "int")
    parsed = (F.when(F.size(parts) == 1, F.floor(minutes).cast("double"))
              .when(F.size(parts) == 2, F.round(F.floor(minutes) + seconds / 60, 2)))
    return F.coalesce(parsed, F.lit(0.0))


def _unsigned(text: Column, type_: str) -> Column:
    """A number written with digits alone, or with one point if the type has fractions; else NULL."""
    signs = "0123456789." if type_ == "double" else "0123456789"
    return F.when(F.translate(text, signs, "") == "", text.try_cast(type_))


def whole(c, type_: str = "long") -> Column:
    """A whole number, also one written with a fraction of zeros as in '1610612740.0'; anything else is NULL."""
    text, value = _col(c).cast("string"), _col(c).try_cast("decimal(38,6)")
    digits = F.when(text.rlike("^[0-9]+$"), text.try_cast(type_))  # as most are written: the decimal takes far longer
    return F.coalesce(digits, F.when(value == F.floor(value), value.try_cast(type_)))


def parse_height(raw) -> Column:
    """'6-9' -> 81 inches; anything else is NULL."""
    text = _col(raw).cast("string")
    feet = F.regexp_extract(text, FEET_INCHES, 1).try_cast("int")
    inches = F.regexp_extract(text, FEET_INCHES, 2).try_cast("int")
    return F.when(text.rlike(FEET_INCHES), feet * 12 + inches)


def parse_weight(raw) -> Column:
    """Digits only."""
    text = _col(raw).cast("string")
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))


def short_position(raw) -> Column:
    return F.substring(_col(raw), 1, 20)


def parse_birth_date(raw) -> Column:
    return F.when(F.length(_col(raw)) > 0, _col(raw)).try_cast("date")
