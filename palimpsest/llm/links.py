"""Linking what shares buckets, without ever emitting all pairs of a bucket.

``stars`` pairs each bucket's leader, the node that meets the most others, with its other
members: one pair a member, which joins most of a group of copies. ``apart`` finds the
buckets whose members then still lie in more than one component. Their members are
compared completely, but in ``block_pairs``: a group is dealt into blocks of bounded size,
and each pair of blocks is one unit of work that returns a spanning forest of what it
finds, never more rows than it has nodes.

``components`` finds connected components by alternating large-star and small-star steps.
Each step is a pre-aggregated minimum and a join, which Spark splits for hubs. Links are
thinned before they are joined: each task replaces a bounded number of them by stars, so a
group of n nodes that share many links enters the joins with about n of them. As soon as
no more links are left than one task may thin, thinning them together ends the rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import drop_shuffles, staged

BLOCK = 512
HELD = 1 << 20  # links a task thins at once


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; root is the least node it reaches.

    A round is a large-star and a small-star step; ``links`` are read once. The last round
    moves no edge: no lesser end has a smaller neighbour, and no greater end has two lesser
    ones. ``HELD`` links or fewer need no round: one task makes them stars.
    """
    ends = links.filter(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v"))
    # A node that several leaders are linked with brings its links to one task.
    edges, n = _counted(thinned(ends.repartition("v")))
    moved = n > 0
    while moved and n > HELD:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u")
            .filter(F.col("v") > F.col("u"))
            .select(
                F.col("v").alias("u"),
                F.col("m").alias("v"),
                (F.col("m") != F.col("u")).alias("moved"),
            )
        )
        nearest = large.groupBy("u").agg(F.min("v").alias("m"), F.max("moved").alias("moved"))
        others = large.drop("moved").join(nearest.drop("moved"), "u")
        small = others.filter(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"), F.lit(True).alias("moved")
        ).unionByName(nearest.withColumnRenamed("m", "v"))
        seen = Observation()
        small = small.observe(seen, F.max("moved").alias("moved"))
        edges, n = _counted(thinned(small.select("u", "v")).distinct())
        moved = bool(seen.get["moved"])
    if moved:
        edges = staged(thinned(edges.coalesce(1)), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return staged(leaves.unionByName(roots), "components")


def _counted(edges: DataFrame) -> tuple[DataFrame, int]:
    """The edges as a staged table, and how many there are."""
    seen = Observation()
    found = staged(edges.observe(seen, F.count(F.lit(1)).alias("n")), "edges")
    return found, seen.get["n"]


def thinned(edges: DataFrame) -> DataFrame:
    """(u, v) links that join the same nodes as ``edges``; v is less than u.

    Every run of links a task holds becomes stars around the least node of each part.
    """
    kind = edges.schema["u"].dataType.simpleString()

    def stars_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for frame in frames:
            held.append(frame)
            n += len(frame)
            if n > HELD:
                held = [least_nodes(pd.concat(held))]
                n = len(held[0])
                if n > HELD // 2:
                    yield held.pop()
                    n = 0
        if n:
            yield least_nodes(pd.concat(held))

    return edges.mapInPandas(stars_of, f"u {kind}, v {kind}")


def least_nodes(edges: pd.DataFrame) -> pd.DataFrame:
    """(u, v) of every node u and the least node v < u that these links lead to."""
    n = len(edges)
    names, codes = np.unique(
        np.concatenate([edges["u"].to_numpy(), edges["v"].to_numpy()]), return_inverse=True
    )
    a, b = codes[:n], codes[n:]
    root = np.arange(len(names))
    while (root[a] != root[b]).any():
        low = np.minimum(root[a], root[b])
        for end in (root[a], root[b]):
            np.minimum.at(root, end, low)
        while (root[root] != root).any():
            root = root[root]
    below = np.flatnonzero(root != np.arange(len(names)))
    return pd.DataFrame({"u": names[below], "v": names[root[below]]})


def shared(members: DataFrame) -> DataFrame:
    """(bucket, node, n) of the buckets with n > 1 nodes; ``members`` are distinct."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = staged(sizes, "sizes")
    drop_shuffles(members.sparkSession)
    found = staged(members.join(sizes, "bucket"), "shared")
    drop_shuffles(members.sparkSession)
    return found


def with_roots(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the root of their node's component, the node itself without one."""
    return rows.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))


def stars(members: DataFrame) -> DataFrame:
    """Distinct (a, b) pairs of each bucket's leader a with the other members."""
    weights = members.groupBy("node").agg(F.sum(F.col("n") - 1).alias("weight"))
    rows = members.join(weights, "node").select("bucket", "node", "weight")
    leaders = rows.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("l"))
    pairs = rows.join(leaders, "bucket").filter(F.col("node") != F.col("l.node"))
    found = staged(
        pairs.select(F.col("l.node").alias("a"), F.col("node").alias("b")).distinct(), "pairs"
    )
    drop_shuffles(members.sparkSession)
    return found


def apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, root) of buckets of three or more that lie in several components.

    A bucket of two was compared by its star.
    """
    rows = with_roots(members.filter("n > 2").select("bucket", "node"), labels)
    roots = rows.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    several = roots.filter(F.col("x") != F.col("y")).select("bucket")
    return staged(rows.join(several, "bucket"), "apart")


def in_blocks(
    rows: DataFrame,
    group: str,
    work: Callable[[pd.DataFrame, np.ndarray, np.ndarray], pd.DataFrame | None],
    schema: str,
) -> DataFrame:
    """What ``work`` returns for each pair of blocks of each group.

    ``work(rows, left, right)`` gets the rows of both blocks and the positions of each;
    they are the same positions where a block meets itself.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    blocks = F.ceil(F.col("__n") / BLOCK).cast("int")
    dealt = (
        rows.join(sizes, group)
        .withColumn("__blocks", blocks)
        .withColumn("__own", F.pmod(F.xxhash64("node"), F.col("__blocks")).cast("int"))
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
        .withColumn("__i", F.least("__own", "__other"))
        .withColumn("__j", F.greatest("__own", "__other"))
        .drop("__n", "__blocks", "__other")
    )
    keys = [group, "__i", "__j"]

    def worked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in _units(frames, keys):
            own = unit["__own"].to_numpy()
            left = np.flatnonzero(own == unit["__i"].iloc[0])
            right = np.flatnonzero(own == unit["__j"].iloc[0])
            if len(unit) > 1 and len(left) and len(right):
                out = work(unit, left, right)
                if out is not None:
                    yield out

    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInPandas(worked, schema)


def block_pairs(
    rows: DataFrame,
    group: str,
    payload: list[str],
    links: Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray], np.ndarray],
    ends: str = "node",
) -> DataFrame:
    """(a, b) links between the nodes of each group, found block against block.

    With ``ends`` "root" they are stated as links between the nodes' roots.

    ``rows`` has (group, node, root, payload...). ``links(columns, left, right)`` gets the
    columns of one unit and the positions of its two sides, and returns a boolean matrix
    left x right. Pairs of one root are left out.
    """

    def compared(unit: pd.DataFrame, left: np.ndarray, right: np.ndarray) -> pd.DataFrame | None:
        roots = pd.factorize(unit["root"])[0]
        if not roots.any():
            return None
        found = links({c: unit[c].to_numpy() for c in payload}, left, right)
        found &= roots[left][:, None] != roots[right][None, :]
        return forest(found, left, right, unit[ends].to_numpy())

    kind = rows.schema[ends].dataType.simpleString()
    return in_blocks(rows, group, compared, f"a {kind}, b {kind}")


def _units(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The frames' rows by key; rows of a key stand together."""
    held: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        if not len(frame):
            continue
        codes = frame.groupby(keys, sort=False).ngroup().to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1, [len(frame)]])
        for start, end in zip(cuts, cuts[1:]):
            key = tuple(frame[k].iloc[start] for k in keys)
            if held and key != last:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(frame.iloc[start:end])
            last = key
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def forest(
    found: np.ndarray, left: np.ndarray, right: np.ndarray, nodes: np.ndarray
) -> pd.DataFrame | None:
    """Edges (a, b) of a spanning forest of the links found between two sides."""
    n = len(nodes)
    linked = np.zeros((n, n), bool)
    linked[np.ix_(left, right)] = found
    linked |= linked.T
    edges, new = [], linked.any(axis=1)
    for start in range(n):
        if not new[start]:
            continue
        new[start] = False
        front = [start]
        while front:
            at = front.pop()
            for other in np.flatnonzero(linked[at] & new).tolist():
                new[other] = False
                edges.append((at, other))
                front.append(other)
    if not edges:
        return None
    a, b = np.array(edges).T
    return pd.DataFrame({"a": nodes[a], "b": nodes[b]})
