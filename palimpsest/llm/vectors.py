"""Operator 10: near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are scaled to length one, where cosine and distance say the same: a cosine of 0.95
is a distance of 0.316. A table hashes a vector by ``PROJECTIONS`` numbers
``floor((a.x + b) / WIDTH)`` with normally distributed a. Two vectors of cosine 0.95 agree
in a table with probability 0.11, so in one of ``TABLES`` with 0.99; of cosine 0.98 with
0.26 and 0.99999. Unrelated vectors agree in a table with 1e-5; more vectors want more
projections, and more tables with them.

Equal vectors are one node. The members of a bucket are compared block against block in
double precision. A pair counts in the first table it agrees in, so each link counts once,
and a unit of work returns one count per node and a spanning forest, never the pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are their own component; so do vectors of different lengths with
each other. Rows of one vec_id are vectors of their own; a null vec_id is linked like any
other, and a component's id is the least that is not null. Other columns are not looked at.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table
from .links import components, forest, in_blocks, shared

COSINE = 0.95
TABLES = 40
PROJECTIONS = 12
WIDTH = 1.5


@lru_cache(maxsize=8)
def _projections(size: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([20240610, size])
    total = TABLES * PROJECTIONS
    return random.standard_normal((size, total)), random.uniform(0, WIDTH, total)


def unit_vector(values: object) -> np.ndarray | None:
    """The vector at length one, None if it has no direction."""
    if values is None or not len(values):
        return None
    x = np.array([np.nan if v is None else v for v in values], float)
    if not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()  # neither tiny nor huge components lose their square
    return x / np.sqrt((x * x).sum())


def codes(units: np.ndarray) -> np.ndarray:
    """Per vector (row) and table a 32-bit hash of its projections."""
    directions, shifts = _projections(units.shape[1])
    cells = np.floor((units @ directions + shifts) / WIDTH).astype(np.int64)
    cells = cells.reshape(len(units), TABLES, PROJECTIONS).astype(np.uint64)
    mixed = np.zeros(cells.shape[:2], np.uint64)
    for i in range(PROJECTIONS):
        mixed = (mixed ^ cells[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return mixed.astype(np.uint32)


def _hashed(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, row, node, codes, unit); the last three null without a direction."""

    @F.pandas_udf("node binary, codes binary, unit binary")
    def hashed(values: pd.Series) -> pd.DataFrame:
        units = [unit_vector(v) for v in values]
        out: list[tuple] = [(None, None, None)] * len(units)
        for size in {len(u) for u in units if u is not None}:
            at = [i for i, u in enumerate(units) if u is not None and len(u) == size]
            stacked = np.stack([units[i] for i in at])
            for i, unit, code in zip(at, stacked, codes(stacked)):
                # Adding zero makes -0.0 and 0.0 one value.
                raw = (np.array(values.iloc[i], float) + 0.0).tobytes()
                out[i] = (xxhash.xxh3_128_digest(raw), code.tobytes(), unit.tobytes())
        return pd.DataFrame(out, columns=["node", "codes", "unit"])

    rows = vectors.select(
        F.col(vec_id).alias("vec_id"),
        F.monotonically_increasing_id().alias("row"),
        hashed(vectors[embedding].cast("array<double>")).alias("h"),
    )
    return staged(rows.select("vec_id", "row", "h.*"), "vectors")


def _counted(cosine: float):
    """One unit of work: links per node as (a, null, n), a spanning forest as (a, b, 0)."""

    def counted(unit: pd.DataFrame, left: np.ndarray, right: np.ndarray) -> pd.DataFrame | None:
        sizes = unit["unit"].map(len)
        same_size = sizes.to_numpy()[left][:, None] == sizes.to_numpy()[right][None, :]
        width = int(sizes.max())
        padded = [np.frombuffer(u.ljust(width, b"\0")) for u in unit["unit"]]
        x = np.stack(padded)
        code = np.stack([np.frombuffer(c, np.uint32) for c in unit["codes"]])
        found = (x[left] @ x[right].T >= cosine) & same_size
        here = unit["table"].iloc[0]
        # Only the first table that a pair agrees in counts it.
        for i in np.flatnonzero(found.any(axis=1)):
            j = np.flatnonzero(found[i])
            agree = code[left[i]] == code[right[j]]
            found[i, j] = (agree.argmax(axis=1) == here) & agree.any(axis=1)
        if left[0] == right[0]:  # a block with itself: each pair once, no self
            found = np.triu(found, 1)
            found |= found.T
        if not found.any():
            return None
        weight, nodes = unit["weight"].to_numpy(), unit["node"].to_numpy()
        counts = [(nodes[left], found @ weight[right])]
        if left[0] != right[0]:
            counts.append((nodes[right], found.T @ weight[left]))
        rows = [pd.DataFrame({"a": a, "b": None, "n": n})[n > 0] for a, n in counts]
        return pd.concat([*rows, forest(found, left, right, nodes).assign(n=0)])

    return counted


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    rows = _hashed(vectors, vec_id, embedding)
    nodes = staged(
        rows.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("weight"), F.min(F.struct("codes", "unit")).alias("v"))
        .select("node", "weight", "v.*"),
        "nodes",
    )
    tables = F.explode(F.sequence(F.lit(0), F.lit(TABLES - 1))).alias("table")
    code = F.substring(F.col("codes"), F.col("table") * 4 + 1, F.lit(4))
    members = nodes.select("node", "codes", tables).select(
        F.xxhash64("table", code).alias("bucket"), "table", "node"
    )
    met = shared(members).drop("n").join(nodes, "node")
    out = staged(in_blocks(met, "bucket", _counted(cosine), "a binary, b binary, n long"), "links")
    degrees = out.filter("n > 0").groupBy("a").agg(F.sum("n").alias("n"))
    labels = components(out.filter("b is not null").select("a", "b"))
    linked = (
        rows.select("vec_id", "row", "node")
        .join(nodes.select("node", "weight"), "node", "left")
        .join(degrees.withColumnRenamed("a", "node"), "node", "left")
        .join(labels, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = (
        linked.filter("root is not null").groupBy("root").agg(F.min("vec_id").alias("component"))
    )
    component = F.coalesce("component", "vec_id")
    return linked.join(least, "root", "left").select(
        "vec_id",
        (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
