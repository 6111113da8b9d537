"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points with the Unicode White_Space property.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_all(text: Column) -> Column:
    """Strip any Unicode whitespace from both ends (plain ``trim`` strips spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def clean_text(text: Column) -> Column:
    """Trimmed text, with NULL in place of an empty result.

    The input appears once, so an expression passed in is evaluated once per row.
    """
    return F.nullif(trim_all(text), F.lit(""))
