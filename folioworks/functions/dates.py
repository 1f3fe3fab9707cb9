"""Dates arrive as text in a few shapes and stay text; these expressions convert between the shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions.text import col_, strip_ws

# Accepted date shapes and the ISO check.
LONG_DATE = (
    r"(?i)^(?:(?:mon|tues|wednes|thurs|fri|satur|sun)day, +)?"
    r"(january|february|march|april|may|june|july|august|september|october|november|december) +(\d{1,2}), +(\d{4})$"
)
SHORT_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def is_iso_date(c: Column | str) -> Column:
    return col_(c).rlike(ISO_DATE)


def parse_archive_date(c: Column | str) -> Column:
    """``"Weekday, Month d, yyyy at hh:mm"``, ``"Month d, yyyy"`` or ISO to ISO; anything else unchanged."""
    raw = F.coalesce(col_(c), F.lit(""))
    day = strip_ws(F.substring_index(raw, " at ", 1))
    bare = F.regexp_replace(day, LONG_DATE, "$1 $2, $3")
    long_form = F.when(day.rlike(LONG_DATE), F.try_to_date(bare, "MMMM d, yyyy"))
    iso_form = F.when(day.rlike(SHORT_DATE), F.try_to_date(day, "yyyy-M-d"))
    return F.coalesce(F.date_format(F.coalesce(long_form, iso_form), "yyyy-MM-dd"), raw)


def month_label(c: Column | str) -> Column:
    """``YYYY-MM`` to ``Mon YYYY``."""
    return F.date_format(F.try_to_date(F.concat(col_(c), F.lit("-01")), "yyyy-MM-dd"), "MMM yyyy")


def long_date(c: Column | str) -> Column:
    """ISO date to ``Month d, yyyy``; null when it is no ISO date."""
    return F.date_format(F.when(is_iso_date(c), F.try_to_date(col_(c), "yyyy-MM-dd")), "MMMM d, yyyy")


def xml_date(c: Column | str) -> Column:
    """ISO date to an XML schema timestamp at midnight UTC; null when it is no ISO date."""
    return F.when(is_iso_date(c), F.concat(col_(c), F.lit("T00:00:00+00:00")))


def stamp(df: DataFrame, out: str = "extracted_at", text: bool = False) -> DataFrame:
    """Add the time of the run, as a timestamp or as ``yyyy-MM-dd HH:mm:ss`` text."""
    now = F.current_timestamp()
    return df.withColumn(out, F.date_format(now, "yyyy-MM-dd HH:mm:ss") if text else now)
