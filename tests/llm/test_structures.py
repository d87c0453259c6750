"""Shards, whitened vectors and the prefix trie against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from palimpsest.llm import common, sharding, trie, whitening

from . import brute

SF = "/root/testdata/sf0.001"


# --- numbering ------------------------------------------------------------------


def test_numbered_counts_on_over_ranges(spark):
    random.seed(1)
    rows = [(random.choice([1, 1, 1, 2, 3]), random.randrange(40)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g long, v long").repartition(7)
    found = {}
    for r in common.numbered(df, ["g"], ["v"], "test").collect():
        found.setdefault(r.g, []).append((r.place, r.v))
    for g, placed in found.items():
        assert [v for _, v in sorted(placed)] == sorted(v for h, v in rows if h == g)
        assert sorted(p for p, _ in placed) == list(range(len(placed)))


# --- shards ---------------------------------------------------------------------


def key_of(value):
    text = "" if value is None else str(value)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("shards", [1, 2, 24, 1000])
def test_jump(shards):
    keys = np.array([key_of(i) for i in range(3000)])
    now, more = sharding.jump(keys, shards), sharding.jump(keys, shards + 1)
    assert now.tolist() == [brute.jump(int(k), shards) for k in keys]
    moved = now != more
    assert set(more[moved]) <= {shards}
    assert abs(moved.mean() - 1 / (shards + 1)) < 4 * (1 / (shards + 1) / len(keys)) ** 0.5


def test_shards_of_a_large_set_are_even():
    counts = np.bincount(sharding.jump(np.array([key_of(i) for i in range(240_000)]), 24))
    assert abs(counts - 10_000).max() < 450


def test_odd_rows_are_placed(spark):
    rows = [(None, "x", 5), (None, "x", 5), (7, None, 5), (7, "", 5), (-3, "é" * 200_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    found = sharding.assign(df, "doc_id").collect()
    assert [(r.doc_id, r.text) for r in found] == [r[:2] for r in rows]
    for r in found:
        assert (r.shard, r.grown_shard) == (brute.jump(key_of(r.doc_id), 24), brute.jump(key_of(r.doc_id), 25))
    placed = sharding.slots(sharding.assign(df, "doc_id").select("doc_id", "shard"), ["doc_id"])
    assert sorted((r.shard, r.slot) for r in placed.collect() if r.doc_id is None) == [
        (brute.jump(key_of(None), 24), i) for i in (0, 1)
    ]
    none = df.where("false")
    assert sharding.slots(sharding.assign(none, "doc_id").select("doc_id", "shard"), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(df, "doc_id", 0)


def test_a_hot_key_is_numbered_over_many_tasks(spark):
    df = spark.range(6000).selectExpr("IF(id % 3 = 0, 5, id) AS doc_id")
    placed = sharding.slots(sharding.assign(df, "doc_id", 3).drop("grown_shard"), ["doc_id"])
    for rows in placed.groupBy("shard").agg({"slot": "max", "*": "count"}).collect():
        assert rows["max(slot)"] == rows["count(1)"] - 1


def test_written_shards_and_growth(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sharding.write_shards(docs, f"{tmp_path}/a", "doc_id", 4)
    sharding.append_shards(spark, f"{tmp_path}/a", "doc_id", 4, 6, f"{tmp_path}/b")
    before = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/a").collect()}
    after = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/b").collect()}
    for row in docs.collect():
        assert before[row.doc_id].shard == brute.jump(key_of(row.doc_id), 4)
        assert after[row.doc_id].text == row.text
        assert after[row.doc_id].shard in (before[row.doc_id].shard, 4, 5)
    moved = {r.doc_id for r in sharding.moves(docs, "doc_id", 4, 6).collect()}
    assert moved == {d for d in before if before[d].shard != after[d].shard}


def test_sharding_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = sharding.query(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")


# --- whitening ------------------------------------------------------------------


def brute_whitening(vectors, wanted):
    """(n, deviations, values, whitened, explained) by numpy's own decomposition."""
    dims = max(map(len, vectors))
    padded = np.array([[*v, *[0.0] * (dims - len(v))] for v in vectors])
    x = np.floor(256 * padded).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1][:wanted], basis[:, ::-1][:, :wanted]
    whitened = (x - sums / n) @ basis / np.sqrt(values)
    deviation = [int(((n * row - sums).astype(object) ** 2).sum()) for row in x]
    return n, deviation, values, whitened, values / np.trace(covariance)


def same_whitening(rows, ids, vectors, wanted=4):
    n, deviation, values, whitened, explained = brute_whitening(vectors, wanted)
    assert len(rows) == len(vectors) * wanted
    for k in range(wanted):
        of = {r.vec_id: r for r in rows if r.component == k + 1}
        got = np.array([of[i].whitened for i in ids])
        sign = np.sign(got @ whitened[:, k])
        assert np.allclose(got * sign, whitened[:, k], atol=1e-8)
        for i, d in zip(ids, deviation):
            assert (of[i].n, of[i].deviation) == (n, d)
            assert of[i].explained == pytest.approx(explained[k], rel=1e-10)
            assert 0 <= of[i].identity_error < 1e-10


def test_whitening_query(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = whitening.query(spark, SF).collect()
    same_whitening(rows, [r.vec_id for r in table], [r.embedding for r in table])


def test_whitening_of_odd_vectors(spark):
    r = np.random.default_rng(5)
    good = [r.normal(0, s, 5).tolist() for s in r.uniform(0.1, 3, 60)]
    good += [good[0]] * 40 + [good[1][:3], []]
    odd = [None, [None, 1.0], [float("nan")] * 5, [float("inf")] * 5]
    rows = [(i, v, 1, 2) for i, v in enumerate(good + odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int, n int")
    same_whitening(whitening.whiten(df).collect(), range(len(good)), good)
    assert whitening.whiten(df.where("false")).collect() == []
    one = df.where("vec_id in (0, 60, 61)")
    assert whitening.whiten(one).collect() == []  # one distinct vector has no spread
    two = whitening.whiten(df.where("vec_id in (0, 1)")).collect()
    assert [(r.component, r.n, round(abs(r.whitened), 9)) for r in two] == [(1, 2, 1.0)] * 2
    nameless = df.where("vec_id < 9").selectExpr("CAST(NULL AS STRING) AS vec_id", "embedding")
    assert len(whitening.whiten(nameless).collect()) == 36


def test_leading_eigenpairs_are_certified():
    r = np.random.default_rng(3)
    for _ in range(40):
        size = int(r.integers(1, 30))
        basis, _ = np.linalg.qr(r.standard_normal((size, size)))
        values = r.choice([1, 1, 2, 2 + 1e-9, 3, 0, 1e-3, r.random()], size) * 10.0 ** r.integers(-3, 4)
        values = np.sort(values)[::-1]
        matrix = basis * values @ basis.T
        matrix = (matrix + matrix.T) / 2
        found, vectors = whitening.leading(matrix, 4)
        assert len(found) == min(4, (values > 1e-9 * values[0]).sum())
        assert np.allclose(found, values[: len(found)], rtol=1e-9)
        assert np.allclose(vectors @ vectors.T, np.eye(len(found)), atol=1e-9)
        assert np.allclose(matrix @ vectors.T, vectors.T * found, atol=1e-9 * max(values[0], 1e-300))


def test_inertia_counts():
    r = np.random.default_rng(4)
    for size in (1, 2, 7, 40):
        half = r.standard_normal((size, size))
        matrix = half + half.T
        values = np.linalg.eigvalsh(matrix)
        for shift in r.uniform(-10, 10, 20):
            assert whitening.above(matrix, shift) == (values > shift).sum()
    assert whitening.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert whitening.above(np.zeros((3, 3)), 0.0) == 0


# --- trie -----------------------------------------------------------------------


def nodes_of(rows):
    found = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(found) == len(rows)
    return found


def talk(conv, words):
    return [(conv, i, "user" if i % 2 == 0 else "assistant", w) for i, w in enumerate(words)]


def test_trie_of_random_families(spark):
    random.seed(11)
    rows, turns = [], []
    for conv in range(120):
        words = [random.choice("ab") for _ in range(random.randrange(1, 14))]
        if random.random() < 0.3 and turns:
            words = random.choice(turns)[: random.randrange(1, 14)] + words
        turns.append(words)
        rows += talk(conv * 2, words)
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = trie.prefix_trie(*trie.rebuilt(common.staged(trie.ordered_turns(df), "t"))).collect()
    assert nodes_of(got) == brute.trie(brute.family_paths(rows))
    plain = {}
    for conv, _, role, text in sorted(rows):
        plain.setdefault(conv, []).append((role, text))
    assert nodes_of(trie.conversation_trie(df).collect()) == brute.trie(plain)


def test_trie_of_one_long_conversation(spark, monkeypatch):
    """A path far longer than a block, many copies of it, and branches off it."""
    monkeypatch.setattr(trie, "BLOCK", 16)
    long = [f"w{i % 5}" for i in range(150)]
    rows = talk(0, long)
    for conv in range(1, 40):
        rows += talk(conv, long if conv % 3 else long[: conv * 3] + ["off", "the", "path"])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plain = {}
    for conv, turn, role, text in sorted(rows):
        plain.setdefault(conv, []).append((role, text))
    assert nodes_of(trie.conversation_trie(df).collect()) == brute.trie(plain)


def test_trie_of_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (7, 2, None, None), (7, 1, "user", "é"), (7, None, "system", "")]
    rows += [(7, 1, "user", "é"), (9, 0, "user", "x" * 300_000), (12, 5, "", ""), (5000, 0, "user", "hi")]
    rows += [(13, None, None, "long")] * 3
    schema = "conv_id long, turn long, role string, text string, depth int, owner int"
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], schema)
    got = trie.prefix_trie(*trie.rebuilt(common.staged(trie.ordered_turns(df), "t"))).collect()
    assert nodes_of(got) == brute.trie(brute.family_paths(rows))
    none = df.where("false")
    assert trie.conversation_trie(none).collect() == []
    assert trie.conversation_trie(df.where("conv_id is null")).collect() == []
