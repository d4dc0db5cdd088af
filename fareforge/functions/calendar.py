"""Calendar parts, labels and the national holiday flag."""
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed


def weekday_number(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts)


def weekday_name(ts: Column, names=fixed.WEEKDAY_PT) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.weekday(ts) + 1)


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def day_period(hour: Column) -> Column:
    """Four periods of six hours."""
    out = F.when(hour.between(0, 5), fixed.DAY_PERIODS[0])
    for i in (1, 2, 3):
        out = out.when(hour.between(6 * i, 6 * i + 5), fixed.DAY_PERIODS[i])
    return out.otherwise(fixed.UNKNOWN_PERIOD)


def easter_sunday(year: int) -> date:
    """Gregorian Easter (the anonymous computus)."""
    golden, century, in_century = year % 19, year // 100, year % 100
    leap_skips = century - century // 4 - (8 * century + 13) // 25
    epact = (19 * golden + leap_skips + 15) % 30
    epact -= (epact // 28) * (1 - (29 // (epact + 1)) * ((21 - golden) // 11))
    sunday = (year + year // 4 + epact + 2 - century + century // 4) % 7
    offset = epact - sunday
    month = 3 + (offset + 40) // 44
    return date(year, month, offset + 28 - 31 * (month // 4))


def holiday_dates(first_year: int = 2020, last_year: int = 2030) -> list[date]:
    days = []
    for year in range(first_year, last_year + 1):
        days += [date(year, m, d) for m, d in fixed.FIXED_HOLIDAYS]
        days.append(easter_sunday(year) - timedelta(days=2))
        if year >= fixed.CONSCIOUSNESS_DAY_FROM:
            days.append(date(year, *fixed.CONSCIOUSNESS_DAY))
    return sorted(days)


def is_holiday(ts: Column, first_year: int = 2020, last_year: int = 2030) -> Column:
    """Membership in a literal set of about ten dates a year: no join."""
    return F.to_date(ts).isin(holiday_dates(first_year, last_year))


def temporal_columns(column: str, first_year: int = 2020, last_year: int = 2030) -> list[Column]:
    ts = F.col(column)
    hour = F.hour(ts)
    parts = {
        "Hour": hour,
        "DayOfWeek": weekday_number(ts),
        "DayOfWeekName": weekday_name(ts),
        "Month": F.month(ts),
        "Quarter": F.quarter(ts),
        "IsHolidayBR": is_holiday(ts, first_year, last_year),
        "DayPeriod": day_period(hour),
    }
    return [expr.alias(column + name) for name, expr in parts.items()]


def add_temporal_features(df: DataFrame, columns=("Schedule", "Create", "Updated"),
                          first_year: int = 2020, last_year: int = 2030) -> DataFrame:
    """Seven calendar columns per timestamp, in one projection; a row without one of the timestamps fails the run."""
    known = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit(f"null {c}")))
    df = df.withColumns({c: known(c) for c in columns})
    added = [c for name in columns for c in temporal_columns(name, first_year, last_year)]
    return df.select("*", *added)
