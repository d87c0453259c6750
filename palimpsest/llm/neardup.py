"""Operator 4: near-duplicate documents by SetSketch registers.

A document is the set of its distinct word shingles. Each shingle draws one exponentially
distributed number per register; a register keeps the least of them on a logarithmic
scale, ``floor(1 - log_b(x))``, truncated to its range. Registers of a union are the
greater ones of its parts, and two sets agree in a register about as often as their
Jaccard similarity.

1. ``sketch`` adds registers, set size and a 128-bit key of the whole set to each row.
   Equal sets are one node from then on, so thousands of exact copies are one row.
2. Bands of register values are buckets, wide bands as well as narrow ones. Each bucket's
   leader is paired with its members (``links.stars``).
3. A pair whose sizes rule the threshold out goes. The counts of registers that are
   greater, less and equal give the joint likelihood of the similarity; pairs for which
   the threshold is hopeless against the best estimate go (error below 1e-5).
4. The sets of the remaining pairs are built from the whole texts and compared exactly.
5. Buckets whose members still lie apart are compared completely: registers block against
   block leave families of plausible pairs, whose sets are compared block against block.
   Links found there are stated between components, which they join.

With 28 bands of 4 registers a pair of similarity 0.8 shares no band with probability
4e-7, and less above.

Defined cases: words are split at ASCII white space, A-Z lower-cased; fewer words than a
shingle are one shingle; null and empty texts have an empty set, no link, and are each
their own component. Rows that repeat a doc_id count as copies if their sets are equal; a
null doc_id is linked like any other, and its component_id is the least id in it that is
not null. Other columns pass through ``near_duplicates`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_shuffles, drop_staged, staged, table, whole
from .links import apart, block_pairs, components, shared, stars, with_roots

WORDS = 5
PERCENT = 80

REGISTERS = 112
BANDS = ((8, 14), (4, 28))  # registers a band, bands
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
HOPELESS = 10.0  # log-likelihood that the threshold may lie below the best estimate

_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xD6E8FEB86659FD93)

RUN_TEXTS, RUN_CHARS = 1000, 400_000  # texts that are sketched together

SKETCH = "n_shingles long, node binary, registers binary"


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(tokens) < words:
        whole_text = xxhash.xxh3_64_intdigest(b" ".join(tokens), seed=len(tokens))
        return np.array([whole_text], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    n = len(hashes) - words + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(words):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + hashes[i : i + n]
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def registers(hashes: np.ndarray, size: int = REGISTERS) -> np.ndarray:
    """SetSketch registers of a set; the greatest uniform draw has the least exponential."""
    greatest = np.zeros(size, np.uint64)
    for start in range(0, len(hashes), 1024):
        draws = hashes[start : start + 1024, None] * _FACTORS[:size]
        draws ^= draws >> np.uint64(32)
        draws *= _MIX
        np.maximum(greatest, draws.max(axis=0), out=greatest)
    least = -np.log((greatest.astype(float) + 1.0) / 2.0**64) / RATE
    scale = np.floor(1.0 - np.log(np.maximum(least, 1e-300)) / np.log(BASE))
    return np.clip(scale, 0, TOP).astype(np.uint16)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """``shingles`` of many texts, computed together."""
    split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    long = [i for i, tokens in enumerate(split) if len(tokens) >= words]
    out = [np.zeros(0, np.uint64)] * len(texts)
    for i, tokens in enumerate(split):
        if 0 < len(tokens) < words:
            out[i] = shingles(texts[i], words)
    if not long:
        return out
    sizes = np.array([len(split[i]) for i in long])
    tokens = chain.from_iterable(split[i] for i in long)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, sizes.sum())
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(long)), sizes - words + 1)
    first = np.arange(len(owner)) + (words - 1) * owner  # each text but the last adds words - 1
    mixed = np.zeros(len(owner), np.uint64)
    for i in range(words):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + hashes[first + i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(29)
    order = np.lexsort((mixed, owner))
    mixed = mixed[order]
    new = np.ones(len(mixed), bool)
    new[1:] = (mixed[1:] != mixed[:-1]) | (owner[1:] != owner[:-1])
    cuts = np.cumsum(np.bincount(owner[new], minlength=len(ends)))
    for i, found in zip(long, np.split(mixed[new], cuts[:-1])):
        out[i] = found
    return out


def registers_of(sets: list[np.ndarray], size: int = REGISTERS) -> np.ndarray:
    """``registers`` of many sets that are not empty, a row each."""
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    greatest = np.zeros((len(sets), size), np.uint64)
    for start in range(0, len(flat), 1024):
        draws = flat[start : start + 1024, None] * _FACTORS[:size]
        draws ^= draws >> np.uint64(32)
        draws *= _MIX
        of = owner[start : start + 1024]
        firsts = np.flatnonzero(np.diff(of, prepend=-1))
        if len(firsts) > 16:
            most = np.maximum.reduceat(draws, firsts, axis=0)
        else:
            most = np.array([part.max(axis=0) for part in np.split(draws, firsts[1:])])
        held = of[firsts]
        greatest[held] = np.maximum(greatest[held], most)
    least = -np.log((greatest.astype(float) + 1.0) / 2.0**64) / RATE
    scale = np.floor(1.0 - np.log(np.maximum(least, 1e-300)) / np.log(BASE))
    return np.clip(scale, 0, TOP).astype(np.uint16)


def hopeless(
    a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float
) -> np.ndarray:
    """Pairs (rows) for which the similarity is surely below the threshold."""
    above, below = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - above - below
    u = (n_a / (n_a + n_b))[:, None]
    v = 1.0 - u
    most = np.minimum(u / v, v / u)

    def likelihood(similarity: np.ndarray) -> np.ndarray:
        share = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)
        more, less = share(u - v * similarity), share(v - u * similarity)
        same = np.maximum(1.0 - more - less, 1e-12)
        logs = [np.log(np.maximum(p, 1e-12)) for p in (more, less, same)]
        return above * logs[0] + below * logs[1] + equal * logs[2]

    grid = most * np.linspace(0, 1, 33)[None, :]
    values = likelihood(grid)
    best = values.argmax(axis=1)
    estimate = grid[np.arange(len(grid)), best]
    needed = likelihood(np.minimum(threshold, most))[:, 0]
    return (estimate < threshold) & (values.max(axis=1) - needed > HOPELESS)


def _runs(texts: list[str]) -> Iterator[list[str]]:
    """The texts in runs of a bounded number and size, but one text at least."""
    held, chars = [], 0
    for text in texts:
        if held and (len(held) >= RUN_TEXTS or chars + len(text) > RUN_CHARS):
            yield held
            held, chars = [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield held


def sketch(docs: DataFrame, text: str, words: int, size: int, into: str) -> DataFrame:
    """``docs`` with the struct of n_shingles, node and registers of ``text``."""

    @F.pandas_udf(SKETCH)
    def sketched(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for part in _runs(texts.tolist()):
            sets = shingle_sets(part, words)
            full = [s for s in sets if len(s)]
            held = iter(registers_of(full, size) if full else ())
            for found in sets:
                key = xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None
                regs = next(held).tobytes() if len(found) else None
                rows.append((len(found), key, regs))
        return pd.DataFrame(rows, columns=["n_shingles", "node", "registers"])

    return docs.withColumn(into, sketched(whole(docs[text])))


def _stacked(values: pd.Series) -> np.ndarray:
    raw = np.frombuffer(b"".join(values), np.uint16)
    return raw.reshape(len(values), -1)


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that sizes and registers do not rule out."""

    @F.pandas_udf("boolean")
    def possible(
        a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series
    ) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        out = hopeless(
            _stacked(a), _stacked(b), n_a.to_numpy(float), n_b.to_numpy(float), percent / 100
        )
        return pd.Series(~out)

    side = lambda s: nodes.select(
        F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}")
    )
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return both.filter(fits).filter(possible("r_a", "r_b", "n_a", "n_b")).select("a", "b")


def _exact(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose whole sets meet the threshold; ``texts`` has (node, text) rows."""

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, left: pd.Series, right: pd.Series) -> pd.Series:
        out, key, first = [], None, None
        for node, x, y in zip(a, left, right):
            if node != key:  # rows come sorted by a
                key, first = node, shingles(x, words)
            second = shingles(y, words)
            common = len(np.intersect1d(first, second, assume_unique=True))
            out.append(100 * common >= percent * (len(first) + len(second) - common))
        return pd.Series(out, dtype=bool)

    side = lambda s: texts.select(F.col("node").alias(s), F.col("text").alias(f"t_{s}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.filter(similar("a", "t_a", "t_b")).select("a", "b")


def _bands(nodes: DataFrame, bands: tuple[tuple[int, int], ...]) -> DataFrame:
    """(bucket, node) of every band of each width."""

    def band(width: int, i: int) -> Column:
        values = F.substring(F.col("registers"), 1 + i * 2 * width, 2 * width)
        return F.xxhash64(F.lit(width), F.lit(i), values)

    buckets = [band(width, i) for width, count in bands for i in range(count)]
    return nodes.select(F.explode(F.array(*buckets)).alias("bucket"), "node")


def _plausible(percent: int):
    """Of one block against another, the pairs that sizes and registers allow."""

    def plausible(columns: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        regs = _stacked(columns["registers"])
        n = columns["n"].astype(float)
        a, b = n[left][:, None], n[right][None, :]
        found = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
        for row, i in enumerate(left):
            at = np.flatnonzero(found[row])
            if len(at):
                j = right[at]
                mine = np.broadcast_to(regs[i], (len(at), regs.shape[1]))
                found[row, at] = ~hopeless(
                    mine, regs[j], np.full(len(at), n[i]), n[j], percent / 100
                )
        return found

    return plausible


def _similar(words: int, percent: int):
    """Of one block against another, the pairs whose whole sets meet the threshold."""

    def similar(columns: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        sets = [shingles(t, words) for t in columns["text"]]
        n = np.array([len(s) for s in sets])
        common = common_counts([sets[i] for i in left], [sets[i] for i in right])
        return 100 * common >= percent * (n[left][:, None] + n[right][None, :] - common)

    return similar


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sets, as a product of 0/1 matrices in slices."""
    kept = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float32)

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values = np.concatenate(sets)
        at = np.minimum(np.searchsorted(kept, values), max(len(kept) - 1, 0))
        there = kept[at] == values if len(kept) else np.zeros(len(values), bool)
        return owner[there], at[there]

    (l_owner, l_at), (r_owner, r_at) = places(left), places(right)
    for start in range(0, len(kept), 4096):
        x = np.zeros((len(left), 4096), np.float32)
        y = np.zeros((len(right), 4096), np.float32)
        l_in = (l_at >= start) & (l_at < start + 4096)
        r_in = (r_at >= start) & (r_at < start + 4096)
        x[l_owner[l_in], l_at[l_in] - start] = 1
        y[r_owner[r_in], r_at[r_in] - start] = 1
        out += x @ y.T
    return out.astype(np.int64)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    size: int = REGISTERS,
    bands: tuple[tuple[int, int], ...] = BANDS,
    row: str | None = None,
) -> DataFrame:
    """``docs`` with n_shingles, component_id, kept and first.

    ``row`` names the column that numbers the rows of ``docs`` where these are a staged
    table; without one they are written and numbered here. ``kept`` marks rows whose id is their component's, ``first`` one row of each
    component. Columns of these names are replaced.
    """
    spark = docs.sparkSession
    rows = docs.withColumn("__nd_row", F.monotonically_increasing_id() if row is None else F.col(row))
    if row is None:
        rows = staged(rows, "rows")
    sketched = staged(
        sketch(rows, text, words, size, "__nd").select(
            F.col(doc_id).alias("id"),
            F.col("__nd_row").alias("row"),
            F.col("__nd.node").alias("digest"),
            F.col("__nd.n_shingles").alias("n"),
            F.col("__nd.registers").alias("registers"),
        ),
        "sketches",
    )
    # Equal sets are one node, named by its first row: numbers are hashed where digests
    # would be sorted. The registers follow from the set, so any row's will do.
    nodes = staged(
        sketched.filter(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min(F.struct(F.col("row").alias("node"), "n", "registers")).alias("s"))
        .select("digest", "s.*"),
        "nodes",
    )
    flat = staged(sketched.drop("registers"), "sets")
    drop_shuffles(spark)
    drop_staged(sketched)

    def texts_of(wanted: DataFrame) -> DataFrame:
        """(node, text) of some nodes."""
        texts = rows.select(F.col("__nd_row").alias("node"), F.col(text).alias("text"))
        found = staged(texts.join(wanted.distinct(), "node"), "texts")
        drop_shuffles(spark)
        return found

    members = shared(_bands(nodes, bands))
    likely = staged(_likely(stars(members), nodes, percent), "likely")
    asked = likely.select(F.col("a").alias("node")).unionByName(
        likely.select(F.col("b").alias("node"))
    )
    labels = components(_exact(likely, texts_of(asked), words, percent))
    rest = apart(members, labels).join(nodes.select("node", "n", "registers"), "node")
    plausible = block_pairs(rest, "bucket", ["n", "registers"], _plausible(percent))
    families = components(plausible).withColumnRenamed("root", "family")
    drop_shuffles(spark)
    compared = with_roots(families.join(texts_of(families.select("node")), "node"), labels)
    # Links found last join components, so their roots alone are linked once more.
    new = block_pairs(compared, "family", ["text"], _similar(words, percent), "root")
    joined = components(new).select(
        F.col("node").alias("root"), F.col("root").alias("least")
    )
    named = (
        with_roots(nodes.select("digest", "node"), labels)
        .join(joined, "root", "left")
        .select("digest", F.coalesce("least", "root").alias("root"))
    )
    rooted = flat.select("id", "row", "digest", "n").join(named, "digest", "left")
    least = (
        rooted.filter(F.col("root").isNotNull())
        .groupBy("root")
        .agg(F.min("id").alias("component"), F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    )
    verdict = rooted.join(least, "root", "left").select(
        F.col("row").alias("__nd_row"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("first"),
    )
    added = ("n_shingles", "component_id", "kept", "first")
    out = rows.join(verdict, "__nd_row")
    kept = rows[doc_id].eqNullSafe(verdict["component_id"])
    return out.select(
        *[rows[c] for c in docs.columns if c not in added],
        verdict["n_shingles"],
        verdict["component_id"],
        kept.alias("kept"),
        verdict["first"],
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, words=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
