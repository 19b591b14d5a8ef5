from datetime import date

import pytest
from pyspark.sql import functions as F

from sidelines.functions import scalars as S


def one(spark, schema, values, column):
    return [r[0] for r in spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)
            .select(column).collect()]


@pytest.mark.parametrize("live, expected", [
    (False, [18.1, 19.0, 29.4, 29.0, 0.0, 0.0, 18.1, 0.0, 0.0]),
    (True, [18.1, 19.0, 0.0, 29.5, 0.0, 0.0, 18.1, 0.0, 0.0])])
def test_minutes(spark, live, expected):
    raw = ["18:06", "19", "29.000000:24", "29.5", None, "DNP", " 18:06 ", "a:b", "1:2:3"]
    assert one(spark, "raw string", raw, S.parse_minutes("raw", live)) == expected


def test_height_weight_position_birth(spark):
    assert one(spark, "x string", ["6-9", "5-11", "69", "a-b", None, "6-"], S.parse_height("x")) == [
        81, 71, None, None, None, None]
    assert one(spark, "x string", ["220", "220 lbs", "", None, "-5"], S.parse_weight("x")) == [220, None, None, None, None]
    assert one(spark, "x string", ["Forward-Center-and-more", "G"], S.short_position("x")) == ["Forward-Center-and-m", "G"]
    assert one(spark, "x string", ["1984-12-30T00:00:00", "1984-12-30", "", "soon"], S.parse_birth_date("x")) == [
        date(1984, 12, 30), date(1984, 12, 30), None, None]


def test_ids_keep_their_length(spark):
    assert one(spark, "x string", ["7", "0022300061", "123456789012"], S.pad_id("x")) == [
        "0000000007", "0022300061", "123456789012"]


def test_seasons(spark):
    assert one(spark, "y int", [2023, 1999, 2008], S.season_of_year("y")) == ["2023-24", "1999-00", "2008-09"]
    days = [date(2023, 8, 1), date(2024, 7, 31)]
    assert one(spark, "d date", days, S.season_of_date("d")) == ["2023-24", "2023-24"]
    labels = ["2023-24", "x", None, "0-1"]
    assert one(spark, "s string", labels, S.season_start("s")) == [date(2023, 10, 1), None, None, None]


def test_age_changes_on_the_birthday(spark):
    births = [(date(2000, 10, 1),), (date(2000, 10, 2),), (date(2000, 9, 30),), (date(2000, 2, 29),)]
    column = S.whole_years("b", F.lit(date(2023, 10, 1)))
    assert [r[0] for r in spark.createDataFrame(births, "b date").select(column).collect()] == [23, 22, 23, 23]


def test_true_shooting_and_load(spark):
    df = spark.createDataFrame([(10, 8, 2, 30.0, None), (0, 0, 0, 12.5, 2.0)],
                               "points int, fga int, fta int, minutes double, distance_miles double")
    got = df.select(S.true_shooting(), S.load_index()).collect()
    assert got[0][0] == pytest.approx(10 / (2 * 8.88)) and got[1][0] is None
    assert [r[1] for r in got] == [30.0, 22.5]


def test_rest(spark):
    days = [None, 0, 1, 2, 3]
    assert one(spark, "d int", days, S.back_to_back("d")) == [0, 1, 1, 0, 0]
    assert one(spark, "d int", days[1:], S.rest_bucket("d", "one")) == ["3+ days rest", "one", "2 days rest", "3+ days rest"]


def test_week_starts_on_monday(spark):
    days = [date(2024, 1, 1), date(2024, 1, 7), date(2024, 1, 8)]
    assert one(spark, "d date", days, S.week_start("d")) == [date(2024, 1, 1), date(2024, 1, 1), date(2024, 1, 8)]


def test_numbers_or_zero(spark):
    assert one(spark, "x string", ["12", "1.5", "abc", "", None, "NaN"], S.numeric_or_zero("x")) == [12, 1.5, 0, 0, 0, 0]


def test_rounding_is_half_up(spark):
    assert one(spark, "x double", [0.125, -0.125, 0.3125, None], S.round_half_up("x", 2)) == [0.13, -0.13, 0.31, None]
    assert [str(v) for v in one(spark, "x double", [0.12345, 1.0], S.at_scale("x", 5, 4))] == ["0.1235", "1.0000"]


def test_clip_and_safe_ratio(spark):
    assert one(spark, "p double", [0.0, 1.0, 0.4, None], S.clip_probability("p")) == [1e-6, 1 - 1e-6, 0.4, None]
    df = spark.createDataFrame([(1, 0), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(S.safe_ratio("a", "b")).collect()] == [None, 0.5]
