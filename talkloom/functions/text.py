"""Text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blanks.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode blanks (``trim`` alone removes U+0020 only)."""
    return F.trim(text, F.lit(BLANKS))


def normalise(text: Column) -> Column:
    """Lower case, blanks collapsed to one space, ends stripped; null becomes ''."""
    collapsed = F.regexp_replace(F.lower(text), f"[{BLANKS}]+", " ")
    return F.coalesce(F.trim(collapsed), F.lit(""))


def path_id(prefix: str, text: Column) -> Column:
    """``prefix_slug``; the slug keeps ``a-z 0-9 _ -`` only, so titles may collide."""
    slug = F.regexp_replace(F.replace(normalise(text), F.lit(" "), F.lit("_")), "[^a-z0-9_-]", "")
    return F.concat(F.lit(f"{prefix}_"), slug)
