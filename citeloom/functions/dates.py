"""Citation dates as `yyyy-mm-dd` text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.text import as_int

# Month names and season starts of the citation format.
MONTHS = {
    "Jan": 1, "Feb": 2, "Mar": 3, "Apr": 4, "May": 5, "Jun": 6,
    "Jul": 7, "Aug": 8, "Sep": 9, "Oct": 10, "Nov": 11, "Dec": 12,
}
SEASONS = {"Winter": 1, "Spring": 4, "Summer": 7, "Fall": 10}
CONSTANT_MEDLINE_DATE = "2000-01-01"

DATE_FORMAT = "%s-%02d-%02d"


def _decode(key: Column, table: dict[str, int]) -> Column:
    pairs = ", ".join(f"'{name}', {number}" for name, number in table.items())
    return F.element_at(F.expr(f"map({pairs})"), F.coalesce(key, F.lit("")))


def ymd(year: Column, month: Column, day: Column) -> Column:
    """Format the parts; NULL as soon as one part is NULL."""
    complete = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return F.when(complete, F.format_string(DATE_FORMAT, year, month, day))


def date_entry(date: Column) -> Column:
    """Year/Month/Day element to text (completed and revised dates)."""
    return ymd(date["Year"], as_int(date["Month"]), as_int(date["Day"]))


def month_number(month: Column) -> Column:
    """Number or three-letter name; a missing element is January."""
    return F.when(month.isNull(), F.lit(1)).otherwise(
        F.coalesce(as_int(month), _decode(month, MONTHS))
    )


def season_month(season: Column) -> Column:
    return _decode(season, SEASONS)


def structured_date(date: Column) -> Column:
    """PubDate with a Year; NULL when the month, day or season is unknown."""
    day = F.when(date["Day"].isNull(), F.lit(1)).otherwise(as_int(date["Day"]))
    by_season = ymd(date["Year"], season_month(date["Season"]), F.lit(1))
    by_month = ymd(date["Year"], month_number(date["Month"]), day)
    return F.when(date["Season"].isNotNull(), by_season).otherwise(by_month)


def medline_date(text: Column) -> Column:
    """Free text such as `1998 Dec 7-21`, `2018 Oct/Dec` or `2000 Spring`.

    The year is the first run of four digits, the month the name at offset 5
    or the start of a named season, the day the first number after offset 9 if
    it can be one and the text starts with the year; month and day fall back
    to 1.
    """
    year = F.regexp_extract(text, r"(\d{4})", 1)
    season = F.regexp_extract(text, "(" + "|".join(SEASONS) + ")", 1)
    month = F.coalesce(
        _decode(F.substring(text, 6, 3), MONTHS), season_month(season), F.lit(1)
    )
    number = as_int(F.regexp_extract(F.substring(text, 10, 1 << 30), r"(\d+)", 1))
    in_place = text.rlike(r"^\d{4}") & number.between(1, 31)
    day = F.when(in_place, number).otherwise(F.lit(1))
    return ymd(F.when(year != "", year), month, day)


def pub_date(date: Column, free_text: str = "parsed") -> Column:
    """Publication date of a journal issue.

    `free_text="constant"` gives every free-text date one constant value, for
    tables that were loaded that way.
    """
    if free_text == "parsed":
        loose = medline_date(date["MedlineDate"])
    elif free_text == "constant":
        loose = F.when(
            date["MedlineDate"].isNotNull(), F.lit(CONSTANT_MEDLINE_DATE)
        )
    else:
        raise ValueError(f"free_text must be 'parsed' or 'constant', not {free_text!r}")
    return F.when(date["Year"].isNotNull(), structured_date(date)).otherwise(loose)


def pub_date_problem(date: Column) -> Column:
    """Why `pub_date` is NULL, or NULL when it is not."""
    with_year = (
        F.when(
            date["Season"].isNotNull() & season_month(date["Season"]).isNull(),
            F.lit("unknown_season"),
        )
        .when(
            date["Season"].isNull() & month_number(date["Month"]).isNull(),
            F.lit("unknown_month"),
        )
        .when(structured_date(date).isNull(), F.lit("bad_day"))
    )
    without_year = F.when(
        medline_date(date["MedlineDate"]).isNull(), F.lit("missing_pub_date")
    )
    return F.when(date["Year"].isNotNull(), with_year).otherwise(without_year)


def to_calendar_date(text: Column) -> Column:
    """Derived DATE; NULL when the text is no calendar date."""
    return F.try_to_date(text, "yyyy-MM-dd")
