"""Operator 9: token ids in binary files, small numbers for frequent ids.

1. ``encode`` gives each document its ids. Texts of Latin letters, digits and ASCII signs
   are lower-cased, split at white space and cut into words as the tokenizer's own rules do,
   so that each distinct word of a worker's texts is encoded once, and each string between
   white space cut once; other texts are encoded whole.
2. Ids are counted over all documents; the most frequent one gets rank 0.
3. Documents are range-partitioned and sorted by id, and cut into shards of bounded size.
   A shard is one file: a header that also states the first id, per document its id and
   number of tokens, one control byte for four ranks (two bits each: bytes of the number,
   less one), and the ranks' bytes, little-endian, as many as the control byte says.
4. ``read_back`` reads the files in tasks. A table of the lengths behind each control byte
   gives all places by one cumulative sum, and numpy gathers the bytes.

The files are written and read by Spark, so they may lie in any store Spark reaches; a
line feed ends each. The position of a document among all ids is its place in its shard
plus the ids of the shards before, a running total over ranges of shards.

Defined cases: a null text counts as empty; every document has the end id at least; rows
come in ascending id, a null id first; repeated ids keep the order of their rows in the
staged table. Ids must be integers. An empty table makes no file and no row. Other columns
are not looked at.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from ..session import scratch_path
from .common import drop_shuffles, staged, table, whole

END = 1
SHARD_TOKENS = 1 << 20
SLICE_CHARS = 4_000_000
CACHED_WORDS = 600_000
CACHED_CHARS = 40  # longer words are encoded anew
_MAGIC = b"PTOK1"
# Magic, documents, tokens, bytes of ranks; whether the first document has an id, and the id.
_HEAD = struct.Struct("<5sqqq?q")
_STOP = "\x00"  # stands between words that are encoded together
_TOGETHER = 50

# The tokenizer file's rules for texts of these characters alone. Such texts
# are in normal form C, and lower() changes each of their letters by itself.
_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")

# How many bytes each of the four numbers behind a control byte has.
_LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


class Words:
    """A worker's tokenizer and the ids of words, and of strings of them, it has seen."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        kinds = [n.get("type") for n in (rules["normalizer"] or {}).get("normalizers", [])]
        cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        same = kinds == ["NFC", "Replace", "Lowercase"] and cuts[0].get("pattern") == {"Regex": _SPLIT}
        self.special = [t["content"] for t in rules["added_tokens"]]
        # The same model without the rules that were already applied to a word.
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        stop = self.words.encode(_STOP, add_special_tokens=False).ids
        self.stop = stop[0] if same and len(stop) == 1 else None
        self.known: dict[str, bytes] = {}

    def plain(self, text: str) -> bool:
        """Whether the text may be cut into words here."""
        if self.stop is None or not _PLAIN.fullmatch(text):
            return False
        return not any(token in text for token in self.special)

    def ids(self, runs: list[str]) -> list[bytes]:
        """The ids of distinct strings without white space, as bytes.

        Those of earlier texts are kept, as far as they are short; the others are cut into
        words, and words that are new are encoded. A string of letters is one word.
        """
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known = self.known
        found = list(map(known.get, runs))
        new = [r for r, ids in zip(runs, found) if ids is None]
        mixed = [r for r in new if not r.isalpha()]
        # Tuples of strings, unlike lists, are left alone by the garbage collector.
        pieces = [tuple(_PIECE.findall(r)) for r in mixed]
        words = dict.fromkeys(filter(str.isalpha, new))
        words.update(dict.fromkeys(w for w in chain.from_iterable(pieces) if w not in known))
        made = self._encoded(list(words))
        for run, cut in zip(mixed, pieces):
            if len(cut) != 1:  # else it is the word itself
                made[run] = b"".join([made[w] if w in made else known[w] for w in cut])
        out = [made[r] if ids is None else ids for r, ids in zip(runs, found)]
        known.update(made)
        for word in made:
            if len(word) > CACHED_CHARS:
                del known[word]
        return out

    def _encoded(self, words: list[str]) -> dict[str, bytes]:
        texts = [f" {_STOP} ".join(words[i : i + _TOGETHER]) for i in range(0, len(words), _TOGETHER)]
        out: dict[str, bytes] = {}
        for i, encoding in enumerate(self.words.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(encoding.ids, "<u4")
            cuts = 4 * np.flatnonzero(ids == self.stop)
            raw, starts = ids.tobytes(), [0, *(cuts + 4).tolist()]
            ends = [*cuts.tolist(), len(raw)]
            at = i * _TOGETHER
            for word, a, b in zip(words[at : at + _TOGETHER], starts, ends, strict=True):
                out[word] = raw[a:b]
        return out

    def encode_plain(self, texts: list[str], end: int) -> list[np.ndarray]:
        """Ids of plain texts, each with the end id.

        No piece goes over white space, so texts are split there first, and what stands
        between is cut into pieces once for all places where it occurs.
        """
        runs = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))
        ends = np.cumsum(runs.value_lengths().to_numpy())
        coded = runs.flatten().dictionary_encode()
        # White space at the begin or the end of a text leaves an empty run there.
        codes = coded.indices.to_numpy()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = [*self.ids(distinct), np.array([end], "<u4").tobytes()]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, starts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        codes = np.insert(codes, ends, len(ids) - 1)  # the end id after each text
        n = sizes[codes]
        stops = np.cumsum(n)
        places = np.repeat(starts[codes] - (stops - n), n) + np.arange(stops[-1])
        return np.split(flat[places], stops[ends + np.arange(len(ends))][:-1])


@lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def token_ids(texts: list[str], path: str, end: int = END) -> list[np.ndarray]:
    """The ids of each text and the end id."""
    tokenizer = _words(path)
    out: list[np.ndarray | None] = [None] * len(texts)
    held: list[int] = []
    chars = 0
    for at, text in enumerate(texts):
        if tokenizer.plain(text):
            held.append(at)
            chars += len(text)
        else:
            ids = tokenizer.whole.encode(text, add_special_tokens=False).ids
            out[at] = np.array([*ids, end], "<u4")
        if held and (chars >= SLICE_CHARS or at == len(texts) - 1):
            for i, ids in zip(held, tokenizer.encode_plain([texts[i] for i in held], end)):
                out[i] = ids
            held, chars = [], 0
    return out


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, ids): ids compact, two bytes each where the vocabulary allows."""
    kind = "<u2" if _words(path).whole.get_vocab_size() <= 1 << 16 else "<u4"

    @F.pandas_udf("binary")
    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series([ids.astype(kind).tobytes() for ids in token_ids(texts.tolist(), path)])

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        encoded(whole(docs[text])).alias("ids"),
    )
    return staged(rows.withColumn("kind", F.lit(kind)), "token-ids")


def frequency_order(encoded: DataFrame) -> np.ndarray:
    """All ids that occur, the most frequent first."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for frame in frames:
            for kind, ids in frame.groupby("kind")["ids"]:
                found = np.bincount(np.frombuffer(b"".join(ids), kind))
                if len(found) > len(total):
                    found, total = total, found
                total[: len(found)] += found
        there = np.flatnonzero(total)
        yield pd.DataFrame({"id": there, "n": total[there]})

    counts = encoded.select("kind", "ids").mapInPandas(counted, "id long, n long")
    # One row per id of the vocabulary at most.
    rows = counts.groupBy("id").agg(F.sum("n").alias("n")).collect()
    return np.array([r.id for r in sorted(rows, key=lambda r: (-r.n, r.id))], np.uint32)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, ranks' bytes) of some numbers."""
    padded = np.zeros(-(-len(ranks) // 4) * 4, "<u4")
    padded[: len(ranks)] = ranks
    sizes = 1 + (padded >= 1 << 8).astype(np.uint8) + (padded >= 1 << 16) + (padded >= 1 << 24)
    codes = (sizes - 1).reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    widest = int(sizes.max(initial=1))
    kept = np.arange(widest, dtype=np.uint8)[None, :] < sizes[:, None]
    data = padded.view(np.uint8).reshape(-1, 4)[:, :widest][kept]
    return np.bitwise_or.reduce(codes, axis=1).astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n numbers behind the control bytes."""
    sizes = _LENGTHS[control].ravel()[:n]
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    out = data[starts].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for i in range(1, int(sizes.max(initial=1))):
        there = np.flatnonzero(sizes > i)
        out[there] |= data[starts[there] + i].astype(np.uint32) << np.uint32(8 * i)
    return out


def _shard(rows: list[tuple[int, bool, np.ndarray]], rank_of: np.ndarray) -> bytes:
    ids = np.concatenate([r[2] for r in rows])
    control, data = pack(rank_of[ids])
    doc_ids = np.array([r[0] for r in rows], "<i8").tobytes()
    nulls = np.array([r[1] for r in rows], np.uint8).tobytes()
    sizes = np.array([len(r[2]) for r in rows], "<i8").tobytes()
    head = _HEAD.pack(_MAGIC, len(rows), len(ids), len(data), not rows[0][1], rows[0][0])
    return b"".join([head, doc_ids, nulls, sizes, control, data])


def write_files(encoded: DataFrame, order: np.ndarray, path: str) -> None:
    """The shards of all documents, in ascending id, one file each below ``path``."""
    rank_of = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)

    def shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, tokens = [], 0
        for frame in frames:
            for doc_id, kind, ids in zip(frame["doc_id"], frame["kind"], frame["ids"]):
                null = bool(pd.isna(doc_id))
                rows.append((0 if null else int(doc_id), null, np.frombuffer(ids, kind)))
                tokens += len(rows[-1][2])
                if tokens >= SHARD_TOKENS:
                    yield pd.DataFrame({"file": [_shard(rows, rank_of)]})
                    rows, tokens = [], 0
        if rows:
            yield pd.DataFrame({"file": [_shard(rows, rank_of)]})

    ranged = encoded.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    # Ids beyond 2**53 would lose digits as floating-point numbers, hence the cast.
    named = ranged.select(F.col("doc_id").cast("string").alias("doc_id"), "kind", "ids")
    files = named.mapInPandas(shards, "file binary")
    raw = files.select(F.col("file").cast("string").alias("value"))
    raw.write.option("maxRecordsPerFile", 1).text(path)


def _parse(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, which are null, tokens of each, ranks) of a file."""
    magic, docs, tokens, size, *_ = _HEAD.unpack_from(content)
    if magic != _MAGIC:
        raise ValueError("not a token file")
    at = _HEAD.size
    take = lambda kind, n: np.frombuffer(content, kind, n, at)
    ids = take("<i8", docs)
    at += 8 * docs
    nulls = take(np.uint8, docs).astype(bool)
    at += docs
    sizes = take("<i8", docs)
    at += 8 * docs
    control = take(np.uint8, -(-tokens // 4))
    at += len(control)
    return ids, nulls, sizes, unpack(control, take(np.uint8, size), tokens)


def _first(head: bytes) -> tuple[bool, int, int]:
    """(has the first document an id, the id, tokens) of a file."""
    *_, tokens, _, named, first = _HEAD.unpack(head)
    return named, first, tokens


def read_back(spark: SparkSession, path: str, order: np.ndarray) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""

    def heads(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for file, head in zip(frame["path"], frame["head"]):
                rows.append((file, *_first(head)))
            yield pd.DataFrame(rows, columns=["path", "named", "first", "tokens"])

    def documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"]):
                ids, nulls, sizes, ranks = _parse(content)
                tokens = order[ranks].astype("<u4")
                ends = np.cumsum(sizes)
                sums = [zlib.crc32(tokens[e - n : e].tobytes()) for e, n in zip(ends, sizes)]
                out = {"path": file, "doc_id": pd.Series(ids, dtype="Int64").mask(nulls)}
                yield pd.DataFrame(out | {"at": ends - sizes, "n_tokens": sizes, "ids_crc32": sums})

    # Spark writes an empty file for an empty table.
    files = spark.read.format("binaryFile").load(path).filter("length > 0")
    files = files.select("path", "content")
    begins = files.select("path", F.substring("content", 1, _HEAD.size).alias("head"))
    shards = begins.mapInPandas(heads, "path string, named boolean, first long, tokens long")
    bases = running_total(staged(shards, "shards"), ["named", "first", "path"], "tokens", "base")
    rows = files.mapInPandas(
        documents, "path string, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    return rows.join(bases.select("path", "base"), "path").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def running_total(df: DataFrame, order: list[str], value: str, into: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows before, by ranges of the order."""
    parts = staged(
        df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges"
    )
    # One row per range.
    sums = parts.groupBy("__part").agg(F.sum(value).alias("n")).orderBy("__part").collect()
    rows, before = [], 0
    for row in sums:
        rows.append((row["__part"], before))
        before += row.n
    bases = df.sparkSession.createDataFrame(rows, "__part int, __before long")
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    upto = F.coalesce(F.sum(value).over(inside), F.lit(0))
    total = parts.withColumn("__inside", upto).join(F.broadcast(bases), "__part")
    return total.withColumn(into, F.col("__inside") + F.col("__before")).drop(
        "__part", "__inside", "__before"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    encoded = encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    order = frequency_order(encoded)
    path = scratch_path(spark, "llm-token-files")
    write_files(encoded, order, path)
    drop_shuffles(spark)
    return read_back(spark, path, order)
