"""String expressions with exact whitespace and emptiness rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters the string strip of the data model removes.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Remove surrounding whitespace of every kind; SQL ``trim`` drops spaces only."""
    return F.btrim(col, F.lit(STRIP_CHARS))


def first_filled(*cols: Column) -> Column:
    """First argument that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in cols], F.lit(""))


def field_or_empty(df, name: str) -> Column:
    """Column ``name`` as a string, or a literal empty string if ``df`` lacks it."""
    if name in df.columns:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.lit("")
