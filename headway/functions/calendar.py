"""Calendar features of a service date."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONDAY, THURSDAY, FRIDAY = 0, 3, 4

# fixed values: US federal holidays as month * 100 + day
ANY_WEEKDAY = [101, 619, 704, 1111, 1225]
MONDAYS = {
    "Martin Luther King Jr. Day": (115, 121),
    "Washington's Birthday": (215, 221),
    "Memorial Day": (525, 531),
    "Labor Day": (901, 907),
    "Columbus Day": (1008, 1014),
}
THANKSGIVING = (1122, 1128)
OBSERVED_MONDAYS = [102, 620, 705, 1112, 1226]
OBSERVED_FRIDAYS = [618, 703, 1110, 1224, 1231]


def _holiday_keys() -> list[int]:
    """Every (month, day, weekday) that is a holiday, as one number each."""
    keys = [date * 10 + weekday for date in ANY_WEEKDAY for weekday in range(7)]
    for first, last in MONDAYS.values():
        keys += [date * 10 + MONDAY for date in range(first, last + 1)]
    keys += [date * 10 + THURSDAY for date in range(THANKSGIVING[0], THANKSGIVING[1] + 1)]
    keys += [date * 10 + MONDAY for date in OBSERVED_MONDAYS]
    return keys + [date * 10 + FRIDAY for date in OBSERVED_FRIDAYS]


def season(day: Column) -> Column:
    """1 winter (Dec-Feb), 2 spring, 3 summer, 4 autumn."""
    return F.floor((F.month(day) % 12 + 3) / F.lit(3)).cast("int")


def school_flag(day: Column) -> Column:
    """1 on days inside the school terms, 0 outside, null for a null date."""
    # month * 100 + day turns each term into one range; fixed values
    month_day = F.month(day) * 100 + F.dayofmonth(day)
    spring = month_day.between(115, 515)
    autumn = month_day.between(901, 1130)
    december = month_day.between(1201, 1220)
    return (spring | autumn | december).cast("int")


def is_us_holiday(day: Column) -> Column:
    """True on US federal holidays and on their observed weekdays.

    A fixed-date holiday on a Saturday is also observed on the Friday before, one
    on a Sunday on the Monday after. Being a function of the date alone, the test
    needs neither a calendar join nor a pass to find the years in the data.
    """
    date = F.month(day) * 100 + F.dayofmonth(day)
    holiday = (date * 10 + F.weekday(day)).isin(_holiday_keys())
    no_juneteenth = date.between(618, 620) & (F.year(day) < 2021)
    no_king_day = date.between(115, 121) & (F.year(day) < 1986)
    return holiday & ~(no_juneteenth | no_king_day)


def holiday_flag(day: Column) -> Column:
    """1 on a holiday, 0 otherwise and for a null date."""
    return F.coalesce(is_us_holiday(day), F.lit(False)).cast("int")


def holiday_table(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """The holidays of a range of years as a one-column table."""
    days = spark.range(1).select(
        F.explode(
            F.sequence(
                F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
                F.make_date(F.lit(last_year), F.lit(12), F.lit(31)),
            )
        ).alias("holiday_date")
    )
    return days.where(is_us_holiday(F.col("holiday_date")))
