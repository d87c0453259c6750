"""Operator 5: benchmark decontamination by pigeonhole edit matching.

A test item of n characters may differ in ``k = floor(rate * n)`` edits. Cut into k + 1
pieces, at least one piece must then occur unchanged. An automaton of all pieces reads
each document once; around each piece hit Myers' bit-parallel algorithm computes the least
edit distance of the whole item. Both sides are compared as lower-case words joined by one
space, so layout and punctuation do not count. A place begins and ends at borders of words,
and its distance is that of the item to all of it, so a short item is not found inside
other words; items of fewer than ``LEAST_WORDS`` words must occur without an edit. Places
of one item do not overlap: each occurrence counts once.

The items are taken in blocks of at most ``BLOCK_CHARS`` characters, one pass over the
documents each, so the automaton's memory is bounded for any number of items. Documents
are never shuffled.

Defined cases: null or empty texts and items (also those without a word) match nothing;
items may be of any length, repeated items are reported under each id, repeated rows each
by themselves; a null id is kept as it is. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .common import staged, table, whole

RATE = 0.06
# Items of fewer words must occur without an edit.
LEAST_WORDS = 4
BLOCK_CHARS = 4_000_000
_WORD = re.compile(r"\w+")


def normal(text: str) -> str:
    return " ".join(_WORD.findall(text)).lower()


def places(text: str) -> tuple[list[int], list[int]]:
    """For each character of ``normal(text)``: where it begins and ends in the text."""
    begins: list[int] = []
    ends: list[int] = []
    for match in _WORD.finditer(text):
        if begins:
            begins.append(ends[-1])
            ends.append(match.start())
        low = match.group().lower()
        for i in range(len(low)):  # some letters grow when lower-cased
            at = match.start() + min(i, len(match.group()) - 1)
            begins.append(at)
            ends.append(at + 1)
        ends[-1] = match.end()
    return begins, ends


def pieces(item: str, rate: float) -> tuple[int, list[tuple[int, str]]]:
    """The error budget and (offset, piece) of its budget + 1 pieces."""
    budget = int(rate * len(item))
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return budget, [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(pattern: str) -> dict[str, int]:
    """For each character the bits of its places in the pattern."""
    out: dict[str, int] = defaultdict(int)
    for i, char in enumerate(pattern):
        out[char] |= 1 << i
    return dict(out)


def best_end(
    masks_: dict[str, int], size: int, text: str, anchored: bool = False
) -> tuple[int, int]:
    """Least distance of the pattern to any substring, and where the first such ends.

    ``anchored``: the distance to the whole text instead.
    """
    full, high = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = size, 0
    for at, char in enumerate(text, 1):
        equal = masks_.get(char, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = ((up << 1) | anchored) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, at
    return (score, len(text)) if anchored else (best, end)


@dataclass(frozen=True)
class Block:
    """Some test items as (id, normal text) and the error rate."""

    items: tuple[tuple[object, str], ...]
    rate: float


def _is_whole(text: str, start: int, end: int) -> bool:
    """Whether a place begins and ends at borders of words."""
    return (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")


def _word_starts(text: str, at: int, room: int) -> list[int]:
    """The last begin of a word up to a place and the first after it, near by."""
    before = text.rfind(" ", max(0, at - room - 1), at)
    after = text.find(" ", at, at + room)
    found = [before + 1] if before >= 0 or at <= room else []
    return found + ([after + 1] if after >= 0 else [])


def _word_ends(text: str, at: int, room: int) -> list[int]:
    """The last end of a word before a place and the first from it on, near by."""
    before = text.rfind(" ", max(0, at - room), at)
    after = text.find(" ", at, at + room + 1)
    found = [before] if before >= 0 else []
    return found + ([after] if after >= 0 else [len(text)] if at + room >= len(text) else [])


class Finder:
    """The automaton of a block's pieces; build it once a task."""

    def __init__(self, block: Block):
        self.items = block.items
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        self.known = []
        for number, (_, item) in enumerate(block.items):
            rate = block.rate if item.count(" ") + 1 >= LEAST_WORDS else 0.0
            budget, parts = pieces(item, rate)
            self.known.append((budget, masks(item), masks(item[::-1])))
            for offset, part in parts:
                found[part].append((number, offset))
        self.machine = ahocorasick.Automaton()
        for part, at in found.items():
            self.machine.add_word(part, (len(part), at))
        if found:
            self.machine.make_automaton()

    def _place(self, number: int, text: str, start: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of an item near a start, from border to border of words."""
        item = self.items[number][1]
        budget, forward, backward = self.known[number]
        size = len(item)
        left, right = max(0, start - budget), min(len(text), start + size + budget)
        at = text.find(item, left, right)
        while at >= 0:
            if _is_whole(text, at, at + size):
                return 0, at, at + size
            at = text.find(item, at + 1, right)
        if not budget:
            return None
        window = text[left:right]
        distance, end = best_end(forward, size, window)
        if distance > budget:
            return None
        _, length = best_end(backward, size, window[:end][::-1])
        begin, end = left + end - length, left + end
        room = budget + 1
        spans = [
            (best_end(forward, size, text[b:e], anchored=True)[0], b, e)
            for b in _word_starts(text, begin, room)
            for e in _word_ends(text, end, room)
            if b < e
        ]
        best = min(spans, default=(budget + 1, 0, 0))
        return best if best[0] <= budget else None

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item number, start, end, distance) of items in ``text``, in normal characters.

        Places of one item do not overlap; of those that would, the nearest one counts.
        """
        if not len(self.machine):
            return
        starts: dict[int, set[int]] = defaultdict(set)
        for last, (size, at) in self.machine.iter(text):
            for number, offset in at:
                starts[number].add(last + 1 - size - offset)
        for number in sorted(starts):
            size, budget = len(self.items[number][1]), self.known[number][0]
            held: tuple[int, int, int] | None = None
            for start in sorted(starts[number]):
                # An exact place is not bettered by starts that lie in it.
                if held and held[0] == 0 and start + size + budget <= held[2]:
                    continue
                place = self._place(number, text, start)
                if place is None or place == held:
                    continue
                if held and place[1] < held[2]:
                    held = min(held, place)
                    continue
                if held:
                    yield number, held[1], held[2], held[0]
                held = place
            if held:
                yield number, held[1], held[2], held[0]


def _blocks(
    benchmark: DataFrame, item_id: str, item_text: str, rate: float
) -> Iterator[Block]:
    """The items with words, in blocks of bounded size."""
    block: list[tuple[object, str]] = []
    chars = 0
    items = benchmark.select(F.col(item_id).cast("string"), whole(benchmark[item_text]))
    for item, value in items.toLocalIterator():
        value = normal(value)
        if block and chars + len(value) > BLOCK_CHARS:
            yield Block(tuple(block), rate)
            block, chars = [], 0
        if value:
            block.append((item, value))
            chars += len(value)
    if block:
        yield Block(tuple(block), rate)


def _scan(docs: DataFrame, block: Block, schema: StructType) -> DataFrame:
    def scanned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(block)
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
                for number, start, end, distance in finder.matches(normal(text)):
                    found[number].append((distance, start, end))
                if found:
                    begins, ends = places(text)
                for number, all_ in found.items():
                    distance, start, end = min(all_)
                    place = (begins[start], ends[end - 1])
                    item = block.items[number][0]
                    rows.append((doc_id, item, len(all_), *place, distance))
            ids = {"doc_id": object, "item_id": object}
            yield pd.DataFrame(rows, columns=schema.names).astype(ids)

    return docs.mapInPandas(scanned, schema)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
) -> DataFrame:
    """One row per document and item in it: how often, and its best place.

    Columns doc_id, item_id, n_places, start, end (code points of the text), distance.
    """
    # Ids travel as text, since numbers beside nulls would become floating-point ones.
    names = docs.select(
        F.col(doc_id).cast("string").alias("doc_id"), whole(docs[text]).alias("text")
    )
    kinds = {"doc_id": docs.schema[doc_id].dataType, "item_id": benchmark.schema[item_id].dataType}
    schema = StructType(
        [StructField(n, StringType()) for n in kinds]
        + [StructField("n_places", LongType())]
        + [StructField(n, IntegerType()) for n in ("start", "end", "distance")]
    )
    done = None
    for block in _blocks(benchmark, item_id, item_text, rate):
        if done is not None:
            done = staged(done, "block")
        found = _scan(names, block, schema)
        done = found if done is None else done.unionByName(found)
    if done is None:
        done = docs.sparkSession.createDataFrame([], schema)
    return done.withColumns({n: F.col(n).cast(t) for n, t in kinds.items()})


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    clean = None
    for block in _blocks(benchmark, item_id, item_text, rate):
        clean = docs if clean is None else staged(clean, "block")
        clean = clean.filter(~_leaks(block)(whole(clean[text])))
    return docs if clean is None else clean


def _leaks(block: Block):
    @F.pandas_udf("boolean")
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(block)
        for texts in batches:
            found = [next(finder.matches(normal(t)), None) is not None for t in texts]
            yield pd.Series(found, dtype=bool)

    return leaks


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
