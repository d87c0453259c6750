"""Records of CSV files whose quoted fields hold line ends, read in splits.

Whether a line begins inside a quoted field depends on all lines before it in the file. A
line maps the two states at its start (outside, inside a field) to those at its end, and so
does a run of lines; maps of runs compose, in order. So each split's map is found on its
own, the maps of a file's splits are composed in file order, and then every split knows the
state it begins in and finds its records alone. Only a record that goes over the end of a
split is put together from pieces, two a split at most. A quote opens a field only where the
field begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

# Up to this many file splits their states are broadcast (17 bytes each), else joined.
BROADCAST_SPLITS = 8_000_000

WHOLE_FIELD = '(^|,)"(?:[^"]++|"")*+"'
FIELD_OPENS = '(^|,)"'
FIELD_CLOSES = '^(?:[^"]++|"")*+"'

# What a split emits: a whole record, the begin of one that goes on, or the end or the
# middle of one that began before.
WHOLE, HEAD, TAIL, MIDDLE = range(4)


def _ends_inside(line: Column) -> Column:
    """Whether a line that begins outside of fields ends inside of one."""
    return F.regexp_replace(line, WHOLE_FIELD, "$1").rlike(FIELD_OPENS)


def state_maps(lines: DataFrame) -> DataFrame:
    """Lines (column ``value``) with the state at their end for both states at their start."""
    line = F.col("value")
    plain = ~F.contains(line, F.lit('"'))
    rest = F.concat(F.lit("x"), F.regexp_replace(line, FIELD_CLOSES, ""))
    return lines.withColumns(
        {
            "outside_to": F.when(plain, False).otherwise(_ends_inside(line)),
            "inside_to": F.when(plain | ~line.rlike(FIELD_CLOSES), True).otherwise(
                _ends_inside(rest)
            ),
        }
    )


def compose(outside_to: np.ndarray, inside_to: np.ndarray) -> tuple[bool, bool]:
    """The map of a run of lines: the last line that forgets its start, then the switches."""
    fixed = np.flatnonzero(outside_to == inside_to)
    after = fixed[-1] + 1 if len(fixed) else 0
    switched = bool((outside_to[after:] & ~inside_to[after:]).sum() % 2)
    if len(fixed):
        end = bool(outside_to[fixed[-1]]) ^ switched
        return end, end
    return switched, not switched


def _split_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, outside_to, inside_to) of whole splits; a split's lines are adjacent."""
    held, maps = None, (False, True)

    def row():
        columns = zip((*held, *maps), (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))
        arrays = [pa.array([v], t) for v, t in columns]
        return pa.RecordBatch.from_arrays(arrays, ["file", "block", "outside_to", "inside_to"])

    for batch in batches:
        rows = batch.to_pandas()
        starts = (rows[["file", "block"]] != rows[["file", "block"]].shift()).any(axis=1)
        for _, run in rows.groupby(starts.cumsum(), sort=False):
            split = (run["file"].iloc[0], int(run["block"].iloc[0]))
            if split != held:
                if held is not None:
                    yield row()
                held, maps = split, (False, True)
            end = compose(run["outside_to"].to_numpy(bool), run["inside_to"].to_numpy(bool))
            maps = tuple(end[1] if state else end[0] for state in maps)
    if held is not None:
        yield row()


def _begins(splits: pd.DataFrame) -> pd.DataFrame:
    """The state each split of one file begins in; a row per split."""
    ordered = splits.sort_values("block")
    state, states = False, []
    for outside_to, inside_to in zip(ordered["outside_to"], ordered["inside_to"]):
        states.append(state)
        state = bool(inside_to if state else outside_to)
    return pd.DataFrame({"file": ordered["file"], "block": ordered["block"], "inside": states})


RECORDS = "file string, block long, pos long, piece int, text string"


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Records and pieces of every split. The header and empty lines are no records."""
    split, state, goes_on, place, header, lines = None, False, False, 0, False, []

    def piece(kind):
        return (*split, place, kind, "\n".join(lines))

    for batch in batches:
        out = []
        for file, block, inside, outside_to, inside_to, value in zip(
            *(batch.column(i).to_pylist() for i in range(batch.num_columns))
        ):
            if split != (file, block):
                if lines:
                    out.append(piece(MIDDLE if goes_on else HEAD))
                split, state, goes_on, place, lines = (file, block), inside, inside, 0, []
                header = block == 0
            lines.append(value)
            state = inside_to if state else outside_to
            if state:
                continue
            if goes_on:
                out.append(piece(TAIL))
                goes_on = False
            elif lines != [""] and lines != ["\r"]:
                if header:
                    header = False
                else:
                    out.append(piece(WHOLE))
                    place += 1
            lines = []
        yield pd.DataFrame(out, columns=["file", "block", "pos", "piece", "text"])
    if lines:
        yield pd.DataFrame([piece(MIDDLE if goes_on else HEAD)], columns=["file", "block", "pos", "piece", "text"])


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that go over splits: a begin and what follows up to the next begin."""
    begins = F.col("piece") == HEAD
    order = Window.partitionBy("file").orderBy("block", begins)
    numbered = pieces.withColumn("record", F.sum(begins.cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", begins.alias("begins"), "text")))
    return numbered.groupBy("file", "record").agg(
        F.min(F.when(begins, F.col("block"))).alias("block"),
        F.min(F.when(begins, F.col("pos"))).alias("pos"),
        F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"),
    )


def read_records(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """(file, block, pos, text) of the records in ``lines`` (value, file, block).

    ``block`` is the split a record begins in and ``pos`` its place there. Lines must come
    as the scan reads them, those of a split adjacent and in order.
    """
    mapped = state_maps(lines.select("file", "block", "value"))
    narrow = mapped.select("file", "block", "outside_to", "inside_to")
    schema = "file string, block long, outside_to boolean, inside_to boolean"
    splits = materialize(narrow.mapInArrow(_split_maps, schema), "split-maps")
    begins = splits.groupBy("file").applyInPandas(_begins, "file string, block long, inside boolean")
    begins = materialize(begins, "split-begins")
    columns = ["file", "block", "inside", "outside_to", "inside_to", "value"]
    if begins.count() <= BROADCAST_SPLITS:
        known = mapped.join(F.broadcast(begins), ["file", "block"])
    else:
        placed = mapped.withColumn("_at", F.monotonically_increasing_id())
        known = placed.join(begins, ["file", "block"]).repartition("file", "block")
        known = known.sortWithinPartitions("file", "block", "_at")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _found(batches):
            yield pa.RecordBatch.from_pandas(rows, schema=ARROW, preserve_index=False)

    records = materialize(known.select(*columns).mapInArrow(found, RECORDS), "records")
    whole = records.where(F.col("piece") == WHOLE).select("file", "block", "pos", "text")
    return whole.unionByName(_joined(records.where(F.col("piece") != WHOLE)).drop("record"))


ARROW = pa.schema(
    [
        ("file", pa.string()),
        ("block", pa.int64()),
        ("pos", pa.int64()),
        ("piece", pa.int32()),
        ("text", pa.string()),
    ]
)
