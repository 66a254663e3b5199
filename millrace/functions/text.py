"""Text cleaning and composition."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: every character that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
    "\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: Column | str) -> Column:
    """Blanks (0x20) off both ends; tabs and other white space stay."""
    return F.trim(column(c))


def strip(c: Column | str) -> Column:
    """All Unicode white space off both ends; a missing value becomes ''."""
    return F.coalesce(F.btrim(column(c), F.lit(WHITESPACE)), F.lit(""))


def unquote(c: Column | str) -> Column:
    """Drop one pair of literal double quotes around a value, then the padding inside."""
    c = column(c)
    quoted = (F.length(c) >= 2) & c.startswith('"') & c.endswith('"')
    inner = F.substring(c, F.lit(2), F.length(c) - 2)
    return F.when(quoted, F.trim(inner)).otherwise(c)


def missing_words(c: Column | str, words: Sequence[str]) -> Column:
    """Turn the listed words ('NA', 'NULL', ...) into NULL."""
    c = column(c)
    return F.when(~c.isin(*words), c) if words else c


def strip_all(df: DataFrame, na_values: Sequence[str] = (), drop_quotes: bool = False) -> DataFrame:
    """``strip`` for every text column of ``df``.

    A value that holds anything but printable ASCII is searched for every kind of white space;
    for the others a blank trim is enough.  Each column is cleaned by itself, so a reader that
    needs few of them reads few.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df

    def each(frame: DataFrame, clean: Callable[[Column], Column]) -> DataFrame:
        return frame.select(
            *[clean(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns]
        )

    if na_values:
        df = each(df, lambda c: missing_words(c, na_values))

    def clean(c: Column) -> Column:
        whole = F.when(c.rlike("[^ -~]"), F.btrim(c, F.lit(WHITESPACE))).otherwise(F.trim(c))
        return F.coalesce(whole, F.lit(""))

    out = each(df, clean)
    return each(out, lambda c: strip(unquote(c))) if drop_quotes else out


def concat_blank(*parts: Column | str) -> Column:
    """Concatenate, reading NULL as '' (plain ``concat`` would return NULL)."""
    return F.concat(*[F.coalesce(column(p).cast("string"), F.lit("")) for p in parts])


def byte_length(c: Column | str, unicode_text: bool = True) -> Column:
    """Stored length: two bytes per UTF-16 unit for Unicode text, else UTF-8 bytes."""
    c = column(c)
    return F.octet_length(F.encode(c, "UTF-16LE")) if unicode_text else F.octet_length(c)


def equal_ignoring_case(a: Column | str, b: Column | str) -> Column:
    """Equality that ignores case and trailing blanks, for case-insensitive sources."""
    return F.collate(column(a), "UNICODE_CI_RTRIM") == F.collate(column(b), "UNICODE_CI_RTRIM")
