"""File listings, checksums and the newest snapshot file."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1024 * 1024


def canonical(uri: str) -> str:
    """The form of a file URI that ``_metadata.file_path`` has."""
    return re.sub("^file:/+", "file:/", uri)


def readable(uri: str) -> str:
    """A file URI as Spark reports it, in the form its readers accept."""
    return literal(unquote(uri))


def literal(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def list_files(spark: SparkSession, paths: list[str], glob: str = "*") -> DataFrame:
    """Path, size and modification time; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(paths)
        .select(
            F.col("_metadata.file_path").alias("path"), "length", "modificationTime"
        )
    )


def latest_file(spark: SparkSession, path: str, glob: str = "snapshot_*.csv") -> DataFrame:
    """SRC6: the newest matching file, as one row (NULL when there is none)."""
    newest = F.struct("modificationTime", "path")
    return list_files(spark, [path], glob).agg(
        F.max_by("path", newest).alias("path"),
        F.max("modificationTime").alias("modified_at"),
    )


def arrow_location(uri: str):
    """(filesystem, path) for a URI in Spark's spelling, for use inside tasks."""
    from pyarrow import fs

    path = re.sub("^s3[an]:", "s3:", unquote(uri))
    if "://" not in path:
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _open_stream(uri: str):
    filesystem, location = arrow_location(uri)
    return filesystem.open_input_stream(location)


def _stream_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        digests = []
        for uri in batch["path"]:
            digest = hashlib.sha256()
            with _open_stream(uri) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield pd.DataFrame({"path": batch["path"], "checksum": digests})


def file_checksums(spark: SparkSession, paths: list[str], glob: str = "*") -> DataFrame:
    """SRC7: (path, sha256 of the file's bytes).

    Only the listing makes rows; the bytes are hashed as streams, chunk by chunk.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(paths)
        .select(F.col("_metadata.file_path").alias("path"))
    )
    return files.mapInPandas(_stream_digests, "path string, checksum string")


def combined_checksums(checksums: DataFrame, by: str) -> DataFrame:
    """One checksum per ``by``: the file's own for one file, else a hash of hashes.

    Hashes are folded in two levels by their leading digits, so no group grows with the
    number of files.
    """
    leaves = (
        checksums.groupBy(by, F.left("checksum", F.lit(3)).alias("_prefix"))
        .agg(F.sort_array(F.collect_list("checksum")).alias("_leaves"))
        .select(
            by,
            F.size("_leaves").alias("_n"),
            F.struct(
                "_prefix",
                F.when(F.size("_leaves") == 1, F.col("_leaves")[0])
                .otherwise(F.sha2(F.concat_ws("", "_leaves"), 256))
                .alias("digest"),
            ).alias("_node"),
        )
    )
    nodes = leaves.groupBy(by).agg(
        F.sort_array(F.collect_list("_node")).alias("_nodes"), F.sum("_n").alias("_n")
    )
    digests = F.transform("_nodes", lambda n: n["digest"])
    return nodes.select(
        by,
        F.when(F.col("_n") == 1, digests[0])
        .otherwise(F.sha2(F.concat_ws("", digests), 256))
        .alias("checksum"),
    )
