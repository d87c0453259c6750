"""Operator 1: byte-level BPE encoding and decoding with Spark's higher-order functions.

A text is cut by the vocabulary's pattern; each piece ("word") is encoded by itself. A
word becomes the array of its bytes' ids, and one fold merges the neighbours of the lowest
rank, leftmost first, until none is left. An id is a rank, so a merge gives the merged
piece's id. The rank map and the other tables are one literal value for Spark: the result
of a scalar subquery over one row, which unlike a written literal is not spelled out in
every description of the plan.

Words are encoded once each where that pays: all words are counted over the whole corpus,
and the ``dictionary`` most frequent ones (a bound on rows, so on memory) are folded as
distinct words. Their ids, and those of words that are tokens themselves, become a
dictionary beside the rank map. A word outside it is folded where it occurs. No rows are shuffled but the
partial counts of words.

Decoding looks up the bytes of each id, joins them as hex and turns the whole into binary,
which takes linear time.

Defined cases: a null text counts as empty; an empty text has no ids and decodes to no
bytes; texts and words may be of any length; bytes that no token spells cannot occur, as
every single byte is a token. Repeated rows are encoded one by one; other columns pass
through untouched, except one that has the result's name. An empty table stays empty.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import local_rows
from .common import sha_hex, staged, table, whole

BUCKETS = 1 << 19
DICTIONARY = 1 << 20
LONGEST_ENTRY = 32  # bytes of a word in the dictionary
ENTRY_BYTES = 16  # bytes of a word on average, which bounds the dictionary's size
_WORD, _IDS = "\x00", "\x01"  # separators inside a bucket
_SHIFT = 1 << 20  # ids and ranks are below it
_NO_RANK = _SHIFT - 1
_BORDER = _SHIFT - 2


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of byte strings and the pattern that cuts texts."""

    pieces: tuple[bytes, ...]  # by id
    pattern: str

    def ranks(self) -> dict[bytes, int]:
        return {piece: i for i, piece in enumerate(self.pieces)}


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str = public_tokenizers.PATTERN) -> Vocabulary:
    """The vocabulary of a file of base64 byte strings and their ranks."""
    with open(path, "rb") as lines:
        ranks = {int(r): base64.b64decode(b) for b, r in map(bytes.split, lines)}
    return Vocabulary(tuple(ranks[i] for i in range(len(ranks))), pattern)


def _is_prime(n: int) -> bool:
    return all(n % d for d in range(2, int(n**0.5) + 1))


@lru_cache(maxsize=4)
def merge_table(vocab: Vocabulary) -> tuple[list[int], int, int]:
    """Each mergeable pair at one of two places: (left << 20 | right) << 20 | rank.

    The places are the key modulo two primes, so a look-up reads two numbers.
    """
    ranks = vocab.ranks()
    pairs = {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                pairs[left * _SHIFT + right] = rank
    size = 9 * len(pairs) // 4 | 1
    while True:
        primes = []
        while len(primes) < 2:
            size += 2
            if _is_prime(size):
                primes.append(size)
        slots: list[int | None] = [None] * primes[1]
        if _place(pairs, slots, primes):
            packed = [-1 if k is None else k * _SHIFT + pairs[k] for k in slots]
            return packed, primes[0], primes[1]


def _place(pairs: dict[int, int], slots: list[int | None], primes: list[int]) -> bool:
    for key in pairs:
        way = 0
        for _ in range(500):
            at = key % primes[way]
            key, slots[at] = slots[at], key
            if key is None:
                break
            way = 1 if key % primes[0] == at else 0
        else:
            return False
    return True


def words(text: Column, vocab: Vocabulary) -> Column:
    """The pieces of a text that are encoded separately."""
    return F.regexp_extract_all(whole(text), F.lit(f"(?U){vocab.pattern}"), F.lit(0))


def _tables(spark: SparkSession, vocab: Vocabulary) -> Column:
    """What folding and decoding need, as one value."""
    packed, first, second = merge_table(vocab)
    ranks = vocab.ranks()
    two = (bytes([a, b]) for a in range(256) for b in range(256))
    row = (
        packed,
        first,
        second,
        [ranks[bytes([b])] for b in range(256)],
        [ranks.get(pair, _NO_RANK) for pair in two],
        [piece.hex() for piece in vocab.pieces],
    )
    schema = (
        "packed array<bigint>, first bigint, second bigint, bytes array<int>,"
        " pairs array<int>, hexes array<string>"
    )
    rows = local_rows(spark, [row], schema)
    return rows.select(F.struct(*rows.columns)).scalar()


def _using(df: DataFrame, tables: Column, into: str, value: Callable[[Column], Column]) -> DataFrame:
    """``df`` with the column ``into``, which ``value`` makes of the tables.

    The optimizer moves the subquery to the one place that refers to it.
    """
    kept = [c for c in df.columns if c != into]
    held = df.withColumn("__tables", tables)
    return held.select(*kept, _bound(F.col("__tables"), value).alias(into))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold(word: Column, tables: Column) -> Column:
    """Ids of a word by ranked merges over its bytes.

    The state is one array: each id below the rank of the pair it begins. Equal ranks
    begin with equal ids, so the first place of the least number is the leftmost merge.
    """
    none, mask = F.lit(_NO_RANK << 20), F.lit(_SHIFT - 1).cast("bigint")

    def ranked(left: Column, right: Column) -> Column:
        key = left * _SHIFT + right
        one = F.get(tables["packed"], (key % tables["first"]).cast("int"))
        two = F.get(tables["packed"], (key % tables["second"]).cast("int"))
        rank = (
            F.when(F.shiftright(one, 20) == key, one.bitwiseAND(mask))
            .when(F.shiftright(two, 20) == key, two.bitwiseAND(mask))
            .otherwise(F.lit(_NO_RANK).cast("bigint"))
        )
        return rank * _SHIFT + left

    def merge(state: Column, at: Column, made: Column) -> Column:
        around = F.array(
            F.struct(F.get(state, at - 2).bitwiseAND(mask).alias("l"), made.alias("r")),
            F.struct(made.alias("l"), F.get(state, at + 1).bitwiseAND(mask).alias("r")),
        )
        return F.concat(
            F.slice(state, F.lit(1), at - 2),
            F.transform(around, lambda p: ranked(p["l"], p["r"])),
            F.slice(state, at + 2, F.lit(_SHIFT)),
        )

    def step(state: Column, _: Column) -> Column:
        def at_least(low: Column) -> Column:
            at = F.array_position(state, low).cast("int")
            merged = _bound(at, lambda at: merge(state, at, F.shiftright(low, 20)))
            return F.when(low >= none, state).otherwise(merged)

        return _bound(F.array_min(state), at_least)

    def start(codes: Column) -> Column:
        def first(code: Column, i: Column) -> Column:
            rank = F.get(tables["pairs"], code * 256 + F.get(codes, i + 1))
            rank = F.coalesce(rank, F.lit(_NO_RANK)).cast("bigint")
            return rank * _SHIFT + F.get(tables["bytes"], code)

        border = F.array(F.lit(_NO_RANK * _SHIFT + _BORDER))
        return F.concat(border, F.transform(codes, first), border)

    chars = F.split(F.decode(word.cast("binary"), "ISO-8859-1"), "")
    started = _bound(F.transform(chars, F.ascii), start)
    steps = F.sequence(F.lit(1), F.greatest(F.octet_length(word) - 1, F.lit(1)))
    return F.aggregate(
        steps,
        started,
        step,
        lambda s: F.transform(
            F.slice(s, F.lit(2), F.size(s) - 2), lambda p: p.bitwiseAND(mask).cast("int")
        ),
    )


def _joined(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), " ")


def frequent_words(docs: DataFrame, text: str, vocab: Vocabulary, most: int) -> DataFrame:
    """(word, ids) of at most ``most`` words, the most frequent of the whole corpus."""
    counts = staged(
        docs.select(F.explode(words(docs[text], vocab)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n")),
        "word-counts",
    ).filter(
        (F.octet_length("word") <= LONGEST_ENTRY) & ~F.col("word").rlike("[\x00-\x01]")
    )
    # How many words occur n times: a few rows, however large the corpus.
    sizes = counts.groupBy("n").agg(
        F.count(F.lit(1)).alias("words"), F.sum(F.octet_length("word")).alias("bytes")
    )
    taken, held, least = 0, 0, None
    for row in sizes.filter("n > 1").orderBy(F.desc("n")).limit(most).collect():
        taken, held = taken + row.words, held + row.bytes
        if taken > most or held > ENTRY_BYTES * most:
            break
        least = row.n
    chosen = counts.filter(F.col("n") >= least) if least else counts.limit(0)
    tables = _tables(docs.sparkSession, vocab)
    return _using(
        chosen.select("word"), tables, "ids", lambda t: _joined(fold(F.col("word"), t))
    )


def dictionary(docs: DataFrame, text: str, vocab: Vocabulary, most: int) -> Column:
    """An array of buckets of words and their ids, as one value.

    It holds all whole tokens and the frequent words, so it is bounded.
    """
    spark = docs.sparkSession
    tokens = []
    for i, piece in enumerate(vocab.pieces):
        word = piece.decode("utf-8", "ignore")
        if word.encode() == piece and not any(c in word for c in (_WORD, _IDS)):
            tokens.append((word, str(i)))
    whole_tokens = local_rows(spark, tokens, "word string, ids string")
    frequent = frequent_words(docs, text, vocab, most)
    entries = (
        whole_tokens.withColumn("order", F.lit(0))
        .unionByName(frequent.withColumn("order", F.lit(1)))
        .groupBy("word")
        .agg(F.min_by("ids", "order").alias("ids"))
    )
    entry = F.concat(F.lit(_WORD), "word", F.lit(_IDS), "ids", F.lit(_WORD))
    texts = entries.groupBy(_bucket(F.col("word")).cast("long").alias("id")).agg(
        F.array_join(F.collect_list(entry), "").alias("entries")
    )
    every = spark.range(BUCKETS).join(texts, "id", "left")
    ordered = F.array_sort(F.collect_list(F.struct("id", F.coalesce("entries", F.lit("")).alias("e"))))
    row = every.agg(F.transform(ordered, lambda b: b["e"]).alias("buckets"))
    return staged(row, "dictionary").scalar()


def _bucket(word: Column) -> Column:
    return F.pmod(F.crc32(word.cast("binary")), F.lit(BUCKETS)).cast("int")


def encode(
    docs: DataFrame, vocab: Vocabulary, text: str = "text", into: str = "ids", most: int = DICTIONARY
) -> DataFrame:
    """``docs`` with the decimal ids of ``text``, joined by one space, in ``into``."""
    tables = F.struct(
        _tables(docs.sparkSession, vocab).alias("merges"),
        dictionary(docs, text, vocab, most).alias("buckets"),
    )

    def ids_of(word: Column, t: Column) -> Column:
        entry = F.concat(F.lit(_WORD), word, F.lit(_IDS))
        return _bound(
            _after(F.get(t["buckets"], _bucket(word)), entry),
            lambda found: F.when(found != "", found).otherwise(_joined(fold(word, t["merges"]))),
        )

    pieces = words(F.col(text), vocab)
    return _using(
        docs,
        tables,
        into,
        lambda t: F.array_join(F.transform(pieces, lambda word: ids_of(word, t)), " "),
    )


def _after(bucket: Column, entry: Column) -> Column:
    """The ids that follow ``entry``; empty if the bucket, which starts so, lacks it."""
    behind = F.call_function("substring_index", bucket, entry, F.lit(-1))
    return F.substring_index(behind, _WORD, 1)


def decode(df: DataFrame, vocab: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes of the ids that ``encode`` made."""

    def spelled(t: Column) -> Column:
        hexes = F.transform(F.split(F.col(ids), " "), lambda i: F.get(t["hexes"], i.cast("int")))
        return F.unhex(F.array_join(hexes, ""))

    tables = _tables(df.sparkSession, vocab)
    empty = F.lit(b"")
    return _using(
        df, tables, into, lambda t: F.when(F.col(ids) == "", empty).otherwise(spelled(t))
    )


def n_ids(ids: Column) -> Column:
    spaces = F.length(ids) - F.length(F.replace(ids, F.lit(" "), F.lit("")))
    return F.when(ids == "", F.lit(0)).otherwise(spaces + 1).cast("long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, vocab).select("doc_id", "ids")
    return decode(encoded, vocab).select(
        "doc_id",
        n_ids(F.col("ids")).alias("n_tokens"),
        sha_hex(F.col("ids")).alias("ids_sha256"),
        sha_hex(F.col("decoded")).alias("decoded_sha256"),
    )
