"""Operator 13: the trie of conversation prefixes, rolled up by centroid decomposition.

A node is a distinct sequence of first turns. Its prefix hash is the exclusive or of
position-wise hashes (128 bits), so it is built by windows over blocks of ``BLOCK`` turns
and no conversation has to fit a task. A node's *owner* is its least member. The nodes a
conversation owns are the end of its path, so (owner, depth) names a node, and only prefixes
that someone else owns need to be looked up.

Rolling up totals to all ancestors costs a pair per node and ancestor, which a conversation
of many turns makes quadratic. Instead the forest of parent edges is split at centroids, all
components of a level at once. A component's nodes carry the turns below them in it, w. The
nodes with at least the highest power of two in the component's total make one path from
its top; the deepest of them is the centroid: what is cut off below it, and what stays
above, is less than that power. So after log2(turns) levels nothing is left. A level
records the total of each centroid's lower part and the path from centroid to top that the
total belongs to; at the end the totals are added along these paths, a row per node and
level at most. All steps are joins and sums over rows; a component, a path or a list of
children is never one task's.

Defined cases: rows without a conversation id belong to no conversation and are left out. A
null role or text is empty. Turns of equal number (null first) are ordered by the hash of
role and text, equal ones as they come. An empty table has no nodes. Other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import local_rows, scratch_path
from .common import numbered, staged, table, whole

# Turns whose prefix hashes one window computes.
BLOCK = 4096
# Ids that one row of a digest's input holds at most: 2 ** CHUNK_BITS.
CHUNK_BITS = 12
# Fixed values of the query: conversations of one family share their first turns.
FAMILY = 5
SHARED = 9


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn_hash, n_bytes): narrow rows, placed from 0 in turn order."""
    role, text = whole("role"), whole("text")
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.unhex(F.sha2(said.cast("binary"), 256)).alias("turn_hash"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    placed = numbered(rows, ["conv_id"], ["turn", "turn_hash"], "turns")
    return placed.select("conv_id", "place", "turn_hash", "n_bytes")


def lengths(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of placed turns."""
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))


def _hashes(depth: Column, turn_hash: Column) -> list[Column]:
    """128 bits of a turn at a position, as two numbers."""
    return [F.xxhash64(F.lit(i), depth, turn_hash) for i in (1, 2)]


def _prefixed(turns: DataFrame) -> DataFrame:
    """Turns with the hash of their prefix (p0, p1) and of the one before (q0, q1)."""
    block = F.shiftright(F.col("depth"), BLOCK.bit_length() - 1)
    h0, h1 = _hashes(F.col("depth"), F.col("turn_hash"))
    rows = turns.select("*", block.alias("block"), h0.alias("h0"), h1.alias("h1"))
    within = (
        Window.partitionBy("conv_id", "block")
        .orderBy("depth")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = rows.where(F.col("length") >= BLOCK).groupBy("conv_id", "block").agg(
        F.bit_xor("h0").alias("x0"), F.bit_xor("h1").alias("x1")
    )
    carried = blocks.select(
        "conv_id",
        "block",
        F.bit_xor("x0").over(earlier).alias("c0"),
        F.bit_xor("x1").over(earlier).alias("c1"),
    )
    rows = rows.withColumns(
        {f"r{i}": F.bit_xor(f"h{i}").over(within) for i in (0, 1)}
    ).join(carried, ["conv_id", "block"], "left")
    prefix = {
        f"p{i}": F.col(f"r{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("long")))
        for i in (0, 1)
    }
    before = {f"q{i}": F.col(f"p{i}").bitwiseXOR(F.col(f"h{i}")) for i in (0, 1)}
    return rows.withColumns(prefix).withColumns(before).select(
        "conv_id", "depth", "length", "n_bytes", "p0", "p1", "q0", "q1"
    )


def _power(weight: Column) -> Column:
    """The position of the highest bit of a number."""
    return F.length(F.bin(weight))


def _split(state: DataFrame, lookups: DataFrame, path: str) -> DataFrame:
    """One level: find every component's centroid, cut there, write what becomes of it.

    ``state`` has the nodes left: (conv_id, depth), w, values, and the top of the component
    (top_conv, top_depth). Written rows keep the values and have the new w and top, the
    centroid (cut_conv, cut_depth) of the component they were in, and whether they lie
    below it or on the path from it to the top (itself both).
    """
    centroids = staged(
        state.groupBy("top_conv", "top_depth")
        .agg(F.max(F.struct(_power(F.col("w")).alias("power"), "depth", "conv_id", "w")).alias("c"))
        .select(
            "top_conv",
            "top_depth",
            F.col("c.conv_id").alias("cut_conv"),
            F.col("c.depth").alias("cut_depth"),
            F.col("c.w").alias("cut_w"),
            F.col("c.power").alias("power"),
        ),
        "centroids",
    )
    met = state.join(centroids, ["top_conv", "top_depth"])
    own = F.col("conv_id") == F.col("cut_conv")
    found = met.join(
        lookups,
        (F.col("conv_id") == F.col("look_conv"))
        & (F.col("cut_depth") + 1 == F.col("look_depth"))
        & ~own,
        "left",
    )
    below = F.when(own, F.col("depth") >= F.col("cut_depth")).otherwise(
        F.coalesce(F.col("look_parent") == F.col("cut_conv"), F.lit(False))
    )
    on_path = _power(F.col("w")) == F.col("power")
    is_cut = own & (F.col("depth") == F.col("cut_depth"))
    child = F.when(own, F.col("conv_id")).otherwise(F.col("look_owner"))
    level = found.select(
        "conv_id",
        "depth",
        F.when(on_path & ~is_cut, F.col("w") - F.col("cut_w")).otherwise(F.col("w")).alias("w"),
        "leaf",
        "saved",
        F.when(below, child).otherwise(F.col("top_conv")).alias("top_conv"),
        F.when(below, F.col("cut_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
        "cut_conv",
        "cut_depth",
        below.alias("below"),
        on_path.alias("on_path"),
        is_cut.alias("is_cut"),
    )
    level.write.option("compression", "zstd").parquet(path)
    return state.sparkSession.read.schema(level.schema).parquet(path)


def rolled_up(nodes: DataFrame, lookups: DataFrame) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens): values summed over each node's subtree.

    ``nodes`` has (conv_id, depth), w (its turns and those below, with multiplicity), its
    own ``leaf`` and ``saved`` and the top of its tree (top_conv, top_depth).
    ``lookups`` tells for prefixes of a conversation that it does not own, and the first
    one it does: who owns them, and who owns their parent.
    """
    spark = nodes.sparkSession
    folder = scratch_path(spark, "llm-trie-levels")
    state, level = nodes, 0
    while not state.isEmpty():
        done = _split(state, lookups, f"{folder}/level={level}")
        state = done.where("not is_cut").drop("cut_conv", "cut_depth", "below", "on_path", "is_cut")
        level += 1
    if not level:
        return nodes.select("conv_id", "depth", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    levels = spark.read.schema(done.schema).parquet(folder)
    totals = levels.where("below").groupBy("cut_conv", "cut_depth").agg(
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    totals = staged(totals, "totals")
    paths = levels.where("on_path").select("conv_id", "depth", "cut_conv", "cut_depth")
    return (
        paths.join(totals, ["cut_conv", "cut_depth"])
        .groupBy("conv_id", "depth")
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    )


def _digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the members that end at a node.

    A row of input holds the ids of one range of numbers, so its size is bounded; a task
    reads a node's rows in order and keeps the state of one digest.
    """
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda m: m.cast("string")), ",")
    chunks = ends.groupBy(
        "conv_id", "depth", F.shiftright("member", CHUNK_BITS).alias("chunk")
    ).agg(ids.alias("ids"))
    dealt = chunks.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "chunk")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
                if node == (conv, depth):
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (conv, depth), hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield _batch(out)
        if node is not None:
            yield _batch([(*node, state.hexdigest())])

    return dealt.select("conv_id", "depth", "ids").mapInArrow(
        digested, "conv_id long, depth long, ends_sha256 string"
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    conv, depth, digest = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(digest, pa.string())],
        ["conv_id", "depth", "ends_sha256"],
    )


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per node of the trie, the textless root included.

    ``convs`` has (conv_id, length), turnless ones too; ``turns`` has (conv_id, depth from
    1, length, turn_hash, n_bytes). Both are read several times: pass written tables.
    """
    spark = convs.sparkSession
    root = convs.agg(
        F.min("conv_id").alias("owner"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("length") + 1).alias("w"),
    ).first()
    if not root["n"]:
        return _empty(spark)
    owner = F.lit(root["owner"]).cast("long")

    prefixed = staged(_prefixed(turns), "prefixes")
    merged = prefixed.groupBy("depth", "p0", "p1").agg(
        F.min("conv_id").alias("owner"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("n_bytes").alias("n_bytes"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("w"),
        F.min("q0").alias("q0"),
        F.min("q1").alias("q1"),
    )
    merged = staged(merged, "merged")
    parents = merged.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("p0").alias("q0"),
        F.col("p1").alias("q1"),
        F.col("owner").alias("parent_owner"),
    )
    nodes = staged(
        merged.join(parents, ["depth", "q0", "q1"], "left").withColumn(
            "parent_owner", F.when(F.col("depth") == 1, owner).otherwise(F.col("parent_owner"))
        ),
        "nodes",
    )
    members = staged(
        prefixed.select("conv_id", "depth", "length", "p0", "p1")
        .join(nodes.select("depth", "p0", "p1", "owner", "parent_owner"), ["depth", "p0", "p1"])
        .where((F.col("parent_owner") != F.col("conv_id")) | (F.col("depth") == F.col("length")))
        .select("conv_id", "depth", "length", "owner", "parent_owner"),
        "members",
    )
    lookups = members.where("parent_owner <> conv_id").select(
        F.col("conv_id").alias("look_conv"),
        F.col("depth").alias("look_depth"),
        F.col("owner").alias("look_owner"),
        F.col("parent_owner").alias("look_parent"),
    )
    top = local_rows(
        spark,
        [(root["owner"], 0, None, root["n"], 0, root["w"])],
        "conv_id long, depth long, parent_conv_id long, n_convs long, n_bytes long, w long",
    )
    named = nodes.select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.col("parent_owner").alias("parent_conv_id"),
        "n_convs",
        "n_bytes",
        "w",
    ).unionByName(top)
    children = nodes.groupBy(
        F.col("parent_owner").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    base = staged(
        named.join(children, ["conv_id", "depth"], "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
        ),
        "base",
    )
    weighed = base.select(
        "conv_id",
        "depth",
        "w",
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
        owner.alias("top_conv"),
        F.lit(0).cast("long").alias("top_depth"),
    )
    turnless = convs.where("length = 0").select(
        owner.alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member")
    )
    ends = members.where("depth = length").select(
        F.col("owner").alias("conv_id"), "depth", F.col("conv_id").alias("member")
    )
    nothing = F.lit(hashlib.sha256().hexdigest())
    return (
        base.join(rolled_up(weighed, lookups), ["conv_id", "depth"])
        .join(_digests(ends.unionByName(turnless)), ["conv_id", "depth"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )


def _empty(spark: SparkSession) -> DataFrame:
    return local_rows(
        spark,
        [],
        "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string",
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    turns = staged(ordered_turns(conversations), "ordered")
    convs = staged(lengths(turns).withColumnRenamed("n_turns", "length"), "lengths")
    deep = turns.withColumn("depth", F.col("place") + 1).drop("place").join(convs, "conv_id")
    return prefix_trie(convs, staged(deep, "deep"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(convs, turns) of families: every conversation begins with the first h turns of its
    family's first one and goes on with its own after its first h."""
    conv = F.col("conv_id")
    h = F.crc32(conv.cast("string").cast("binary")) % SHARED
    held = lengths(turns)
    plan = (
        held.select("conv_id", "n_turns", (conv - conv % FAMILY).alias("base"), h.alias("h"))
        .join(held.select(conv.alias("base"), F.col("n_turns").alias("base_turns")), "base", "left")
        .withColumn("head", F.least("h", F.coalesce("base_turns", F.lit(0).cast("long"))))
        .withColumn("length", F.col("head") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0)))
        .select("conv_id", "base", "h", "head", "length")
    )
    plan = staged(plan, "plan")
    first = turns.where(F.col("place") < SHARED - 1).withColumnRenamed("conv_id", "base")
    heads = (
        first.join(plan, "base")
        .where("place < h")
        .select("conv_id", (F.col("place") + 1).alias("depth"), "length", "turn_hash", "n_bytes")
    )
    own = (
        turns.join(plan, "conv_id")
        .where("place >= h")
        .select(
            "conv_id",
            (F.col("place") + 1 - F.col("h") + F.col("head")).alias("depth"),
            "length",
            "turn_hash",
            "n_bytes",
        )
    )
    return plan.select("conv_id", "length"), staged(heads.unionByName(own), "rebuilt")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = staged(ordered_turns(table(spark, sf_dir, "conversations")), "ordered")
    return prefix_trie(*rebuilt(turns))
