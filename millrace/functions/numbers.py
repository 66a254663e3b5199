"""Number parsing with an explicit policy for bad values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import column


def parse_int(c: Column | str) -> Column:
    """Blanks trimmed, then cast; a malformed number raises (ANSI) and fails the load."""
    return F.trim(column(c)).cast("int")


# Fixed value: decimal text, with an exponent or not, blanks around it.
DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_number(c: Column | str) -> Column:
    """Decimal text ('3', '3.0', '1e3') as double; anything else is NULL, also what only the
    engine's own cast would take ('3d', '0x1p3', 'NaN')."""
    c = column(c)
    return F.when(c.cast("string").rlike(DECIMAL_TEXT), c.try_cast("double"))


def clamp_count(c: Column | str) -> Column:
    """Count repair: unreadable or missing is 0, negative is 0, fractions are cut."""
    c = column(c)
    value = parse_number(c)
    cut = value.try_cast("bigint")
    return F.greatest(F.coalesce(c.try_cast("bigint"), cut, F.lit(0)), F.lit(0)).cast("bigint")


def drop_negative(c: Column | str) -> Column:
    """Negative sentinel to NULL, type kept."""
    c = column(c)
    return F.when(c >= 0, c)


def parse_money(c: Column | str, on_bad_value: str = "fail", symbol: str = "S/") -> Column:
    """'S/ 1,225,889.22' to DECIMAL(12,2).

    Every currency mark and every comma goes, wherever it stands.  ``on_bad_value`` is
    'fail' (the job stops) or 'null'.
    """
    digits = F.replace(
        F.replace(F.trim(column(c)), F.lit(symbol), F.lit("")), F.lit(","), F.lit("")
    )
    return (digits.cast if on_bad_value == "fail" else digits.try_cast)("decimal(12,2)")


def div(a: Column | str, b: Column | str) -> Column:
    """Integer division, as between two integers in T-SQL (``/`` would give a fraction)."""
    return F.call_function("div", column(a), column(b))
