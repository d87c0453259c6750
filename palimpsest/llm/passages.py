"""Operator 6: substring dedup by paragraph MinHash banding.

Two kinds of paragraphs are compared across all documents.

*Lines* of ``LINE_WORDS`` words or more, as sets of word shingles: registers, bands,
exact verification and components are those of ``neardup``. 28 bands of 4 registers miss
a pair of similarity 0.8 with probability 4e-7.

*Windows* of ``WINDOW_WORDS`` words find passages that stand inside longer lines, wherever
they begin. A window starts at each word whose shingle hash is the least of any run of
``RUN`` shingles, that is at a MinHash of the run; equal passages have equal minima. A
passage of ``WINDOW_WORDS + RUN - 1`` words (38) or more that two documents share so has a
window in common, for certain. Windows collide if the hash of all their words, 128 bits
long, is equal, so one band of the whole is enough and there is nothing to verify.

Colliding windows are seeds of passages. ``RUN`` is below ``WINDOW_WORDS``, so the seeds of
a shared passage overlap, and at most ``RUN - 1`` of its words lie before the first and
after the last one. Seeds of a row that touch are one span. Its ends move outward to the
farthest word up to which another holder of the end's seed goes on alike: the hashes of
the next 1, 2, ... ``RUN - 1`` words are counted by class, so no pair of holders is built.

The paragraphs of a component that lies in more than one document are reported; all but
those in the first row of the table are to be removed. Spans to remove have an earlier
holder, spans to keep only later ones; the two are formed apart.

Defined cases: words are split at ASCII white space, A-Z lower-cased; null, empty and
shorter texts have no paragraph; what repeats inside one row alone is not reported; rows
that repeat a doc_id are documents of their own, with a null id as well. Other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_shuffles, drop_staged, staged, table, whole
from .neardup import PERCENT, WORDS, near_duplicates

LINE_WORDS = 20
WINDOW_WORDS = 20
RUN = 19  # below WINDOW_WORDS, so that the windows of a passage overlap
REGISTERS, BANDS = 112, ((4, 28),)
ROWS = 200  # documents whose windows are held at once
_MIX = np.uint64(0x9E3779B97F4A7C15)


def long_lines(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, row, start, end, text) of the lines with enough words."""

    @F.pandas_udf("array<struct<start: int, end: int, text: string>>")
    def long(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            found, start = [], 0
            for line in text.split("\n"):
                end = start + len(line)
                if len(line) >= 2 * least - 1 and len(line.encode("utf-8", "surrogatepass").split()) >= least:
                    found.append({"start": start, "end": end, "text": line})
                start = end + 1
            out.append(found)
        return pd.Series(out, dtype=object)

    lines = docs.select("doc_id", "row", F.explode(long("text")).alias("l"))
    return lines.select("doc_id", "row", "l.*")


def anchors(hashes: np.ndarray, run: int) -> np.ndarray:
    """Places that are the (last) least of some run of values."""
    if len(hashes) <= run:
        return np.array([len(hashes) - 1 - hashes[::-1].argmin()] if len(hashes) else [], np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(hashes, run)[:, ::-1]
    places = np.arange(len(runs)) + run - 1
    out = []
    for start in range(0, len(runs), 1 << 14):
        part = runs[start : start + (1 << 14)]
        out.append(places[start : start + (1 << 14)] - part.argmin(axis=1))
    return np.unique(np.concatenate(out))


def windows(text: str, least: int, run: int, words: int) -> list[tuple[bytes, int, int]]:
    """(hash of the words, start, end) of the windows of a text."""
    nodes, found = _windows(text, least, run, words)
    starts, ends = _word_places(text.encode("utf-8", "surrogatepass"))
    return list(zip(nodes, starts[found].tolist(), ends[found + least - 1].tolist()))


def _hashes(raw: bytes) -> np.ndarray:
    """Hashes of the words of UTF-8 text."""
    tokens = raw.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def _windows(text: str, least: int, run: int, words: int) -> tuple[list[bytes], np.ndarray]:
    """Hashes of the words of a text's windows, and the places of the first ones."""
    hashes = _hashes(text.encode("utf-8", "surrogatepass"))
    if len(hashes) < least:
        return [], np.zeros(0, np.int64)
    n = len(hashes) - words + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(words):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + hashes[i : i + n]
    mixed ^= mixed >> np.uint64(32)
    found = anchors(mixed[: len(hashes) - least + 1], run)
    raw = hashes.tobytes()
    return [xxhash.xxh3_128_digest(raw[8 * a : 8 * (a + least)]) for a in found.tolist()], found


def _inside(data: np.ndarray) -> np.ndarray:
    return (data != 32) & ((data < 9) | (data > 13))


def _word_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code points where the words of UTF-8 text begin and end."""
    data = np.frombuffer(raw, np.uint8)
    edges = np.diff(np.concatenate([[False], _inside(data), [False]]).astype(np.int8))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if len(data) and data.max() < 128:
        return begins, ends
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points[begins], points[ends]


def _repeated_windows(docs: DataFrame, least: int, run: int, words: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                nodes, at, n = [], [], []
                for text in part.column("text").to_pylist():
                    found = _windows(text, least, run, words)
                    nodes += found[0]
                    at.append(found[1])
                    n.append(len(found[1]))
                rows = np.repeat(part.column("row").to_numpy(), n)
                places = np.concatenate(at).astype(np.int32)
                arrays = [pa.array(rows), pa.array(nodes, pa.binary()), pa.array(places)]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "node", "at"])

    texts = docs.select("row", "text")
    units = staged(texts.mapInArrow(cut, "row long, node binary, at int"), "windows")
    classes = units.groupBy("node").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    repeated = classes.filter("first < last").select("node", "first")
    seeds = units.join(repeated, "node").withColumn("kept", F.col("row") == F.col("first"))
    seeds = staged(_spans(seeds.drop("first"), least), "seeds")
    drop_shuffles(units.sparkSession)
    drop_staged(units)
    contexts = staged(_contexts(seeds, docs, least, run - 1), "contexts")
    drop_shuffles(docs.sparkSession)
    drop_staged(seeds)
    found = staged(_extended(contexts, docs), "passages")
    drop_shuffles(docs.sparkSession)
    drop_staged(contexts)
    return found


def _spans(seeds: DataFrame, least: int) -> DataFrame:
    """``seeds`` with the number of their span, and whether they are its head or tail."""
    order = Window.partitionBy("row", "kept").orderBy("at")
    ends = seeds.withColumn(
        "head", F.coalesce(F.col("at") - F.lag("at").over(order) > least, F.lit(True))
    ).withColumn("tail", F.coalesce(F.lead("at").over(order) - F.col("at") > least, F.lit(True)))
    return ends.withColumn("span", F.sum(F.col("head").cast("int")).over(order))


def _contexts(seeds: DataFrame, docs: DataFrame, least: int, most: int) -> DataFrame:
    """What stands around the seeds of classes that some span begins or ends with.

    (row, node, kept, span, side, end, edge, keys, places): keys[i] is a hash of the i + 1
    words before (side -1) or after the seed (side 1), which holds among seeds of one
    class. Where a span begins or ends, ``edge`` is that place and places[i] the one where
    the words of keys[i] do.
    """
    wanted = seeds.groupBy("node").agg(F.max("head").alias("left"), F.max("tail").alias("right"))
    asked = seeds.join(wanted.filter("left or right"), "node")
    named = ("node", "at", "kept", "span", "head", "tail", "left", "right")
    asked = asked.groupBy("row").agg(F.collect_list(F.struct(*named)).alias("seeds"))
    schema = (
        "row long, node binary, kept boolean, span long, side int, end boolean, edge int,"
        " keys array<bigint>, places array<int>"
    )

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                yield from _around(batch.slice(begin, ROWS), least, most)

    texts = docs.select("row", "text").join(asked, "row")
    return texts.select("row", "text", *[F.col(f"seeds.{c}").alias(c) for c in named]).mapInArrow(around, schema)


def _around(batch: pa.RecordBatch, least: int, most: int) -> Iterator[pa.RecordBatch]:
    """The contexts of the seeds of some texts, a batch a side."""
    lists = {c: batch.column(c) for c in ("at", "kept", "span", "head", "tail", "left", "right", "node")}
    rows = batch.column("row").to_numpy()
    of = np.repeat(np.arange(len(rows)), lists["at"].value_lengths().to_numpy())
    flat = {c: values.flatten() for c, values in lists.items()}
    nodes = flat.pop("node")
    flat = {c: values.to_numpy(zero_copy_only=False) for c, values in flat.items()}
    hashes, starts, ends, cuts = _words_of(batch.column("text").to_pylist())
    low, high = cuts[:-1][of][:, None], cuts[1:][of][:, None]
    first = cuts[:-1][of] + flat["at"]
    for side, wanted, border in ((-1, "left", "head"), (1, "right", "tail")):
        picked = np.flatnonzero(flat[wanted])
        if not len(picked):
            continue
        at, end = first[picked], flat[border][picked]
        if side < 0:
            near, points, edge = at[:, None] - 1 - np.arange(most), starts, starts[at]
        else:
            near, points, edge = at[:, None] + least + np.arange(most), ends, ends[at + least - 1]
        there = (near >= low[picked]) & (near < high[picked])
        near = np.clip(near, 0, len(hashes) - 1)
        n = there.sum(axis=1)
        arrays = [
            pa.array(rows[of[picked]]),
            nodes.take(pa.array(picked)),
            pa.array(flat["kept"][picked]),
            pa.array(flat["span"][picked].astype(np.int64)),
            pa.array(np.full(len(picked), side, np.int32)),
            pa.array(end),
            pa.array(edge.astype(np.int32)),
            _listed(_keys(hashes[near])[there].view(np.int64), n),
            _listed(points[near][there & end[:, None]].astype(np.int32), n * end),
        ]
        names = ["row", "node", "kept", "span", "side", "end", "edge", "keys", "places"]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of some texts: hashes, and code points of the text where they begin
    and end; and where the words of each text, and behind the last one, are in these."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = b" ".join(raws)
    sizes = np.array([len(r) + 1 for r in raws])
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(raw, np.uint8)
    edges = np.diff(np.concatenate([[False], _inside(data), [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    cuts = np.append(np.searchsorted(starts, begins), len(starts))
    base = np.repeat(begins, np.diff(cuts))
    if len(data) and data.max() >= 128:
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        starts, ends, base = points[starts], points[ends], points[base]
    return _hashes(raw), starts - base, ends - base, cuts


def _listed(values: np.ndarray, n: np.ndarray) -> pa.ListArray:
    """Lists of the next n[0], n[1], ... values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(values))


def _keys(hashes: np.ndarray) -> np.ndarray:
    """Per row, hashes of the first word, the first two, ..."""
    keys, last = np.empty_like(hashes), np.zeros(len(hashes), np.uint64)
    for i in range(hashes.shape[1]):
        last = (last ^ (last >> np.uint64(29))) * _MIX + hashes[:, i]
        keys[:, i] = last
    return keys


def _extended(contexts: DataFrame, docs: DataFrame) -> DataFrame:
    """The spans, out to the ends of what another row shares with them."""
    ends = contexts.filter("end")
    spans = ends.groupBy("row", "kept", "span").agg(
        F.min(F.when(F.col("side") < 0, F.col("edge"))).alias("start"),
        F.max(F.when(F.col("side") > 0, F.col("edge"))).alias("end"),
    )
    # Copies have equal contexts, so their words are looked at once.
    by = ["node", "side"]
    alone = contexts.groupBy(*by, "keys").agg(
        F.min("row").alias("first"), F.max("row").alias("last"), F.max("end").alias("asked")
    )
    alone = staged(alone, "contexts-once")
    drop_shuffles(docs.sparkSession)
    holders = alone.select(*by, F.explode("keys").alias("key"), "first", "last", "asked").groupBy(*by, "key")
    shared = holders.agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("asked").alias("asked")
    )
    shared = staged(shared.filter("asked and first < last").drop("asked"), "shared-words")
    drop_shuffles(docs.sparkSession)
    drop_staged(alone)
    steps = ends.select(
        "row", "kept", "span", *by, F.explode(F.arrays_zip("keys", "places")).alias("step")
    )
    steps = steps.select("row", "kept", "span", *by, F.col("step.keys").alias("key"), "step.places")
    alike = steps.join(shared, [*by, "key"])
    alike = alike.filter(F.when(F.col("kept"), F.col("last") > F.col("row")).otherwise(F.col("first") < F.col("row")))
    before = F.min(F.when(F.col("side") < 0, F.col("places")))
    after = F.max(F.when(F.col("side") > 0, F.col("places")))
    moved = alike.groupBy("row", "kept", "span").agg(before.alias("before"), after.alias("after"))
    named = spans.join(moved, ["row", "kept", "span"], "left").join(docs.select("row", "doc_id"), "row")
    return named.select(
        "doc_id",
        F.lit("window").alias("kind"),
        F.coalesce("before", "start").alias("start"),
        F.coalesce("after", "end").alias("end"),
        "kept",
    )


def _shared(units: DataFrame, node: str, kind: str) -> DataFrame:
    """The units of classes that lie in more than one row; the first row's are kept."""
    classes = units.groupBy(node).agg(F.min("row").alias("first"), F.max("row").alias("last"))
    repeated = classes.filter("first < last").select(node, "first")
    found = units.join(repeated, node).select(
        "doc_id",
        F.lit(kind).alias("kind"),
        "start",
        "end",
        (F.col("row") == F.col("first")).alias("kept"),
    )
    found = staged(found, "repeated")
    drop_shuffles(units.sparkSession)
    return found


def _repeated_lines(docs: DataFrame, least: int, words: int, percent: int) -> DataFrame:
    lines = long_lines(docs, least).withColumn("unit", F.monotonically_increasing_id())
    lines = staged(lines.withColumn("copy", F.unhex(F.md5(F.col("text").cast("binary")))), "long-lines")
    drop_staged(docs)
    # Equal lines are compared once, under the least of their numbers.
    alone = staged(lines.groupBy("copy", "text").agg(F.min("unit").alias("unit")), "lines-once")
    places = staged(lines.drop("text", "unit"), "places")
    drop_shuffles(docs.sparkSession)
    drop_staged(lines)
    found = near_duplicates(alone, "unit", "text", words, percent, REGISTERS, BANDS, row="unit")
    found = staged(places.join(found.select("copy", "component_id"), "copy").drop("copy"), "lines")
    return _shared(found, "component_id", "line")


def repeated_passages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    line_words: int = LINE_WORDS,
    window_words: int = WINDOW_WORDS,
    run: int = RUN,
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, kind, start, end, kept) of every paragraph that repeats across documents.

    start and end are code points of the text; rows that are not ``kept`` are to be cut.
    """
    plain = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        whole(docs[text]).alias("text"),
    )
    plain = staged(plain, "texts")  # read again for the words around seeds, by row
    found = _repeated_windows(plain, window_words, run, words)
    return found.unionByName(_repeated_lines(plain, line_words, words, percent))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
