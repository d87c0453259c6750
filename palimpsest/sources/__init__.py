"""Sources: CSV snapshots, paged JSON, files and their checksums."""
