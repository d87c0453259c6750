"""Versioned dimensions on Spark: dated full snapshots in, queryable history out."""

from .spec import REGISTRY, SnapshotSpec

__all__ = ["REGISTRY", "SnapshotSpec"]
