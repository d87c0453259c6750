"""Column -> Column building blocks, all JVM-side."""

from .hashing import attr_hash, surrogate_key
from .text import address_full, is_blank_key, natural_key, normalize_text, safe_date

__all__ = [
    "address_full",
    "attr_hash",
    "is_blank_key",
    "natural_key",
    "normalize_text",
    "safe_date",
    "surrogate_key",
]
