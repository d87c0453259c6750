"""Text normalisation and safe casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns the feed's rules are stated in.
WHITESPACE_RUN = r"\s+"
ISO_DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"
VISIBLE_CHARACTER = r"(?U)[^\s\x1c-\x1f]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str) -> Column:
    """PRJ1: trim spaces, collapse whitespace runs, upper-case (in that order)."""
    return F.upper(F.regexp_replace(F.trim(_col(c)), WHITESPACE_RUN, " "))


def natural_key(c: Column | str) -> Column:
    """PRJ2: the key without surrounding spaces, case kept."""
    return F.trim(_col(c))


def address_full(
    building: Column | str,
    street: Column | str,
    city: Column | str,
    state: Column | str,
    postcode: Column | str,
) -> Column:
    """PRJ3: one normalised address line.

    The street element is dropped when either part is NULL or both are blank; with only
    one part blank its joining space stays, as the feed's rule says.
    """
    street_line = F.concat(F.trim(_col(building)), F.lit(" "), F.trim(_col(street)))
    rest = [F.nullif(F.trim(_col(c)), F.lit("")) for c in (city, state, postcode)]
    return normalize_text(F.concat_ws(", ", F.nullif(street_line, F.lit(" ")), *rest))


def safe_date(c: Column | str) -> Column:
    """PRJ4: the leading ISO date, or NULL when there is none or it is no real day."""
    text = F.trim(_col(c))
    day = F.left(text, F.lit(10)).try_cast("date")
    return F.when(text.rlike(ISO_DATE_PREFIX), day)


def is_blank_key(c: Column | str) -> Column:
    """ING3: NULL, or nothing but (Unicode) whitespace."""
    return ~F.coalesce(_col(c), F.lit("")).rlike(VISIBLE_CHARACTER)
