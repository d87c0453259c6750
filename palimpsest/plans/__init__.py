"""Composed queries: marts, feeds and the end-to-end run."""
