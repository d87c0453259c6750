"""Change-detection hash and surrogate key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "|"


def attr_hash(columns: Sequence[str]) -> Column:
    """PRJ5: md5 over the tracked attributes; NULL and '' hash alike."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def surrogate_key(key: str, effective: str, hash_column: str) -> Column:
    """PRJ6: md5 of key, version start and attribute hash; NULL if any part is."""
    parts = [F.col(c).cast("string") for c in (key, effective, hash_column)]
    bar = F.lit(SEPARATOR)
    return F.md5(F.concat(parts[0], bar, parts[1], bar, parts[2]))
