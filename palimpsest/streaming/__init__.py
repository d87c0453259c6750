"""Incremental runs over a landing folder."""

from .catchup import catch_up

__all__ = ["catch_up"]
