"""Date strings of the day folders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two-digit years below 50 are 20yy, the rest 19yy.
CENTURY_PIVOT = 50
# Formats a day folder name can take (raw and standardised).
RAW_DAY_FORMAT = "ddMMyy"
STANDARD_DAY_FORMAT = "MM/dd/yyyy"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardize_date(date: Column | str) -> Column:
    """DDMMYY-like text → ``MM/DD/YYYY``.

    Non-digits are removed first; a value that does not leave exactly six digits is
    returned unchanged (so the function is idempotent), null stays null.  No calendar
    check is made.
    """
    date = _col(date)
    digits = F.regexp_replace(date, r"(?U)\D", "")
    yy = F.substring(digits, 5, 2)
    century = F.when(yy.try_cast("int") < CENTURY_PIVOT, F.lit("20")).otherwise(F.lit("19"))
    rewritten = F.concat(F.substring(digits, 3, 2), F.lit("/"), F.substring(digits, 1, 2),
                         F.lit("/"), century, yy)
    return F.when(F.length(digits) == 6, rewritten).otherwise(date)


def parse_day(date: Column | str) -> Column:
    """DateType of a day string in either the raw or the standardised form."""
    date = _col(date)
    return F.coalesce(F.try_to_timestamp(date, F.lit(STANDARD_DAY_FORMAT)),
                      F.try_to_timestamp(date, F.lit(RAW_DAY_FORMAT))).cast("date")


def ordinal_date_text(day: Column | str) -> Column:
    """DateType → ``December 1st, 2026`` (11th, 12th, 13th take ``th``)."""
    day = _col(day)
    dom = F.dayofmonth(day)
    last = F.pmod(dom, F.lit(10))
    suffix = (F.when((dom >= 11) & (dom <= 13), F.lit("th"))
              .when(last == 1, F.lit("st"))
              .when(last == 2, F.lit("nd"))
              .when(last == 3, F.lit("rd"))
              .otherwise(F.lit("th")))
    return F.concat(F.date_format(day, "MMMM"), F.lit(" "), dom.cast("string"), suffix,
                    F.lit(", "), F.year(day).cast("string"))
