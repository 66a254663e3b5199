"""Dates from parts and from text, with an explicit policy for impossible ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import column

# Month names of the time dimension.
MONTH_NAMES = {
    1: "Enero",
    2: "Febrero",
    3: "Marzo",
    4: "Abril",
    5: "Mayo",
    6: "Junio",
    7: "Julio",
    8: "Agosto",
    9: "Septiembre",
    10: "Octubre",
    11: "Noviembre",
    12: "Diciembre",
}


def date_from_parts(year: Column | str, month: Column | str, day: Column | str, on_bad_date: str = "null") -> Column:
    """A DATE from three numbers.

    'fail' raises on an impossible date; 'null' (and 'drop', whose caller filters) gives
    NULL, also when a part is missing.
    """
    y, m, d = (column(c).cast("int") for c in (year, month, day))
    if on_bad_date == "fail":
        return F.make_date(y, m, d)
    in_range = y.between(1, 9999) & m.between(1, 12) & d.between(1, 31)
    candidate = F.date_add(F.make_date(y, m, F.lit(1)), d - 1)
    return F.when(in_range & (F.month(candidate) == m), candidate)


def date_from_padded(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """A DATE by left-padding the parts to text.  A missing part gives NULL, never day 1."""
    y, m, d = (column(c).cast("string") for c in (year, month, day))
    text = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    whole = y.isNotNull() & m.isNotNull() & d.isNotNull()
    return F.when(whole, F.try_to_date(text, "yyyy-MM-dd"))


def parse_compact(c: Column | str, on_bad_date: str = "fail") -> Column:
    """'20231220' to DATE."""
    return (F.to_date if on_bad_date == "fail" else F.try_to_date)(column(c), "yyyyMMdd")


def parse_day_first(c: Column | str, on_bad_date: str = "fail") -> Column:
    """'31/12/2025' to DATE."""
    return (F.to_date if on_bad_date == "fail" else F.try_to_date)(column(c), "dd/MM/yyyy")


def month_name(month: Column | str) -> Column:
    """Spanish month name; an unknown number gives NULL.  Independent of the locale."""
    names = F.create_map(*[F.lit(x) for pair in MONTH_NAMES.items() for x in pair])
    return F.element_at(names, column(month))


def utc_midnight(c: Column | str) -> Column:
    """'2023-01-01T00:00:00Z'; NULL stays NULL."""
    return F.date_format(column(c), "yyyy-MM-dd'T'00:00:00'Z'")
