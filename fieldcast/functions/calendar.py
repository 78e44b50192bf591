"""Calendar parts, season calendars and onset windows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcast.config import CALENDARS, SEASON_RULES, SeasonRule


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Add year, month, day, quarter, ISO week, day of week (Sunday = 1), weekend flag."""
    return df.withColumns({
        "year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date),
        "quarter": F.quarter(date), "week": F.weekofyear(date),
        "day_of_week": F.dayofweek(date),
        "is_weekend": F.dayofweek(date).isin(1, 7).cast("int"),
    })


def year_month(year: str | Column = "year", month: str | Column = "month") -> Column:
    return (_col(year) * 100 + _col(month)).cast("int")


def quarter_of_month(month: str | Column = "month") -> Column:
    return F.ceil(_col(month) / 3).cast("int")


def with_names(df: DataFrame, date: str = "date") -> DataFrame:
    """Add day and month names and the integer ``year_month``."""
    return df.withColumns({
        "day_name": F.date_format(date, "EEEE"),
        "month_name": F.date_format(date, "MMMM"),
        "year_month": year_month(F.year(date), F.month(date)),
    })


def season(month: str | Column = "month", calendar: str = "gold") -> Column:
    """Season name of a month in one of the four calendars."""
    expr = None
    for name, months in CALENDARS[calendar].items():
        test = _col(month).isin(*months)
        expr = F.when(test, name) if expr is None else expr.when(test, name)
    return expr


def season_order(season_col: str | Column, calendar: str) -> Column:
    """Sort position of a season in its calendar."""
    names = F.array(*[F.lit(n) for n in CALENDARS[calendar]])
    return F.array_position(names, _col(season_col)).cast("int")


def season_year(year: str | Column = "year", month: str | Column = "month") -> Column:
    """January and February belong to the season that began the year before."""
    return F.when(_col(month) <= 2, _col(year) - 1).otherwise(_col(year))


def _by_season(season_col: str | Column, pick, rules: Mapping[str, SeasonRule]) -> Column:
    expr = None
    for name, rule in rules.items():
        test = _col(season_col) == name
        expr = F.when(test, pick(rule)) if expr is None else expr.when(test, pick(rule))
    return expr


def season_crop(season_col: str | Column = "season",
                rules: Mapping[str, SeasonRule] = SEASON_RULES) -> Column:
    return _by_season(season_col, lambda r: F.lit(r.crops), rules)


def _month_day(year: Column, md: tuple[int, int]) -> Column:
    return F.make_date(year, F.lit(md[0]), F.lit(md[1]))


def official_start(season_col: str | Column = "season", year: str | Column = "season_year",
                   rules: Mapping[str, SeasonRule] = SEASON_RULES) -> Column:
    return _by_season(season_col, lambda r: _month_day(_col(year), r.official_start), rules)


def date_bounds(rule: SeasonRule, year: str | Column = "season_year") -> tuple[Column, Column]:
    """First and last day of the onset search window of one season."""
    return _month_day(_col(year), rule.window_start), _month_day(_col(year), rule.window_end)


def _onset_test(rule: SeasonRule, year: str) -> Column:
    first, last = date_bounds(rule, year)
    return (F.col("date").between(first, last)
            & F.col("avg_temperature_2m").between(rule.temp_min, rule.temp_max)
            & (F.col("daily_rain") >= rule.rain_min)
            & F.col("avg_humidity").between(rule.humidity_min, rule.humidity_max))


def onset_condition(rules: Mapping[str, SeasonRule] = SEASON_RULES) -> Column:
    """True on days that may start a season, False elsewhere (never NULL).

    A day must lie in the search window and carry the season of its month.
    """
    hit = F.lit(False)
    for name, rule in rules.items():
        hit = hit | ((F.col("season") == name) & _onset_test(rule, "season_year"))
    return F.coalesce(hit, F.lit(False))


def window_season(rules: Mapping[str, SeasonRule] = SEASON_RULES) -> Column:
    """Season whose search window and ranges a day meets, whatever its month; else NULL."""
    expr = None
    for name, rule in rules.items():
        test = _onset_test(rule, "year")
        expr = F.when(test, name) if expr is None else expr.when(test, name)
    return expr


def month_cyclic(month: str | Column = "month") -> tuple[Column, Column]:
    """Sine and cosine of the month on a twelve-month circle, four digits."""
    angle = 2 * F.pi() * _col(month) / 12
    return F.round(F.sin(angle), 4), F.round(F.cos(angle), 4)


def season_flags(month: str | Column = "month") -> tuple[Column, Column]:
    """Monsoon (June to September) and pre-monsoon (March to May) flags."""
    return (_col(month).isin(6, 7, 8, 9).cast("int"), _col(month).isin(3, 4, 5).cast("int"))


def expected_days(first: str | Column, last: str | Column) -> Column:
    return F.datediff(_col(last), _col(first)) + 1


def expected_hours(first: str | Column, last: str | Column) -> Column:
    seconds = F.unix_timestamp(_col(last).cast("timestamp")) - F.unix_timestamp(
        _col(first).cast("timestamp"))
    return F.floor(seconds / 3600) + 1


def coverage_pct(observed: str | Column, expected: str | Column) -> Column:
    return _col(observed) / _col(expected) * 100
