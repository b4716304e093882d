"""Readable durations and rounded percentages.

Rounding is done on exact integers (half-up), so the text does not depend on how an
engine rounds or prints a binary double.  Both forms print hundredths of a unit:
``sql`` style drops trailing zeros down to one digit (``10.0 seconds``), ``python``
style keeps two digits (``10.00 seconds``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit sizes in milliseconds; below one minute the text is in seconds,
# below one hour in minutes, else in hours.
SECOND_MS = 1_000
MINUTE_MS = 60_000
HOUR_MS = 3_600_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a: Column, b: Column | int) -> Column:
    """Exact integer division ``a div b`` for non-negative integers (long or decimal)."""
    b = b if isinstance(b, Column) else F.lit(b)
    return F.call_function("div", a, b).cast("long")


def half_up_hundredths(numerator: Column | str, denominator: Column | int) -> Column:
    """round_half_up(100 * numerator / denominator) for non-negative integers.

    The products are decimals, so they are exact beyond the range of a long.
    """
    den = (denominator if isinstance(denominator, Column) else F.lit(denominator)).cast("decimal(24,0)")
    return idiv(_col(numerator).cast("decimal(24,0)") * 200 + den, den * 2)


def hundredths_text(h: Column, style: str = "sql") -> Column:
    """Text of ``h / 100`` for a non-negative long ``h``."""
    whole = idiv(h, 100).cast("string")
    frac = F.pmod(h, F.lit(100))
    if style == "python":
        return F.concat(whole, F.lit("."), F.lpad(frac.cast("string"), 2, "0"))
    short = (F.when(frac == 0, F.lit("0"))
             .when(F.pmod(frac, F.lit(10)) == 0, idiv(frac, 10).cast("string"))
             .otherwise(F.lpad(frac.cast("string"), 2, "0")))
    return F.concat(whole, F.lit("."), short)


def duration_text(ms: Column | str, style: str = "sql") -> Column:
    """``ms`` (non-negative long) → ``<value> seconds|minutes|hours`` at 2 decimals."""
    ms = _col(ms).cast("long")

    def in_unit(unit_ms: int, name: str) -> Column:
        hundredths = half_up_hundredths(ms, unit_ms)
        return F.concat(hundredths_text(hundredths, style), F.lit(" " + name))

    return (F.when(ms < MINUTE_MS, in_unit(SECOND_MS, "seconds"))
            .when(ms < HOUR_MS, in_unit(MINUTE_MS, "minutes"))
            .otherwise(in_unit(HOUR_MS, "hours")))


def percentage(count: Column | str, total: Column | str) -> Column:
    """round(count / total * 100, 2) as a double, rounded half-up on exact integers."""
    hundredths = half_up_hundredths(_col(count).cast("decimal(20,0)") * 100, _col(total))
    return hundredths.cast("double") / 100
