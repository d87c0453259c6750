"""Near-duplicate documents, passages and vectors against plain versions."""

import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from palimpsest.llm import links, neardup, passages, vectors

from . import brute


def corpus(n, seed, words=60, changes=6):
    """Texts of which each third one is a changed copy of an earlier one."""
    random.seed(seed)
    out = []
    for i in range(n):
        if i % 3 == 2:
            text = random.choice(out).split()
            for _ in range(random.randint(0, changes)):
                text[random.randrange(len(text))] = f"new{random.randrange(999)}"
        else:
            text = [f"w{random.randrange(300)}" for _ in range(words)]
        out.append(" ".join(text))
    return out


def docs_of(spark, texts, ids=None):
    rows = [(ids[i] if ids else i, t, "mine", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, node int")


def check(spark, texts, k):
    rows = neardup.near_duplicates(docs_of(spark, texts), words=k).collect()
    assert len(rows) == len(texts)
    expected = brute.near_duplicates(texts, k)
    for row in rows:
        assert (row.n_shingles, row.component_id) == expected[row.doc_id], row.doc_id
        assert row.kept == row.first == (row.component_id == row.doc_id)
        assert row.text == texts[row.doc_id] and row.node == 7


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(spark, k):
    odd = [None, None, "", " \n", "a b", "A  B", "a b c", "ä b c d", "Ä b c d", "a b c d e"]
    check(spark, corpus(120, k) + odd, k)


def test_large_group_that_no_leader_covers(spark, monkeypatch):
    """A chain of changes: blocks smaller than the group find the links stars leave."""
    monkeypatch.setattr(links, "BLOCK", 8)
    random.seed(3)
    text = [f"w{i}" for i in range(60)]
    chain = []
    for _ in range(70):
        text = list(text)
        text[random.randrange(60)] = f"x{random.randrange(10**6)}"
        chain.append(" ".join(text))
    check(spark, chain + ["copy " * 30] * 40, 4)


def test_repeated_and_null_ids(spark):
    texts = ["a b c d e f", "a b c d e f", "x y", "a b c d e f", "x y", None]
    ids = [5, 5, None, 3, 9, None]
    rows = neardup.near_duplicates(docs_of(spark, texts, ids)).collect()
    found = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in rows)
    assert found == sorted(
        [(5, 3, False), (5, 3, False), (-1, 9, False), (3, 3, True), (9, 9, True), (-1, -1, True)],
    )
    assert sum(r.first for r in rows) == 3


def test_no_documents(spark):
    assert neardup.near_duplicates(docs_of(spark, [])).count() == 0


def test_registers_estimate_similarity():
    random.seed(8)
    words = [f"w{i}" for i in range(2400)]
    for similar in (0.5, 0.8, 0.95):
        own = round(1000 * (1 - similar) / (1 + similar))
        a = " ".join(words[:1000])
        b = " ".join(words[own : 1000 + own])
        sets = [neardup.shingles(t, 1) for t in (a, b)]
        regs = np.stack([neardup.registers(s) for s in sets])
        real = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        assert abs((regs[0] == regs[1]).mean() - real) < 0.15
        hopeless = neardup.hopeless(regs[:1], regs[1:], np.array([1000.0]), np.array([1000.0]), 0.8)
        assert hopeless[0] == (similar < 0.6)


def test_registers_are_mergeable():
    sets = [neardup.shingles(" ".join(f"{c}{i}" for i in range(50)), 2) for c in "ab"]
    both = np.union1d(*sets)
    parts = np.maximum(neardup.registers(sets[0]), neardup.registers(sets[1]))
    assert (neardup.registers(both) == parts).all()


def test_common_counts():
    random.seed(2)
    left = [np.unique(np.random.default_rng(i).integers(0, 9000, 50, np.uint64)) for i in range(7)]
    right = [np.unique(np.random.default_rng(9 + i).integers(0, 9000, 5000, np.uint64)) for i in range(4)]
    found = neardup.common_counts(left, right)
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]


def test_components(spark):
    random.seed(4)
    edges = [(random.randrange(200), random.randrange(200)) for _ in range(120)]
    edges += [(1000 + i, 1001 + i) for i in range(100)] + [(5000, i) for i in range(5001, 5100)]
    linked = brute.Sets({n for e in edges for n in e})
    for a, b in edges:
        linked.join(a, b)
    found = links.components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.root for r in found} == {n: linked.root(n) for n in nodes}
    assert len(found) == len(nodes)


@pytest.mark.parametrize(
    "edges", [[(3, 1), (3, 2)], [(3, 1), (4, 3), (5, 4), (5, 2)], [(1, 2), (2, 1), (4, 4)], []]
)
def test_components_of_few_links(spark, edges):
    """No node has two roots, also where no lesser end has a smaller neighbour."""
    linked = brute.Sets({n for e in edges for n in e})
    for a, b in edges:
        linked.join(a, b)
    found = links.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {(n, linked.root(n)) for a, b in edges if a != b for n in (a, b)}
    assert sorted(map(tuple, found)) == sorted(expected)


def test_components_of_random_links(spark):
    """Many small components at once, of every shape that five nodes can take."""
    random.seed(11)
    edges = [
        (10 * i + random.randrange(5), 10 * i + random.randrange(5))
        for i in range(400)
        for _ in range(random.randint(1, 5))
    ]
    linked = brute.Sets({n for e in edges for n in e})
    for a, b in edges:
        linked.join(a, b)
    found = links.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {(n, linked.root(n)) for a, b in edges if a != b for n in (a, b)}
    assert sorted(map(tuple, found)) == sorted(expected)


def test_thinned_links_are_no_more_than_nodes(spark, monkeypatch):
    """Forty leaders of the same thousand nodes: a link a node and task, the same components."""
    monkeypatch.setattr(links, "HELD", 3000)
    edges = [(a, b) for a in range(40) for b in range(1, 1001) if a != b]
    edges += [(2000 + i, 2001 + i) for i in range(50)]
    random.seed(12)
    random.shuffle(edges)
    rows = spark.createDataFrame(edges, "u long, v long").repartition(2)
    kept = links.thinned(rows).collect()
    assert len(kept) <= 2 * 2 * 1051 and all(v < u for u, v in kept)
    linked, thin = (brute.Sets({n for e in edges for n in e}) for _ in range(2))
    for sets, pairs in ((linked, edges), (thin, kept)):
        for a, b in pairs:
            sets.join(a, b)
    assert all(linked.root(n) == thin.root(n) for e in edges for n in e)
    few = spark.createDataFrame(edges, "a long, b long").selectExpr("cast(a AS string) a", "cast(b AS string) b")
    found = {r.node: r.root for r in links.components(few).collect()}
    assert found["7"] == found["999"] == "0" and found["2050"] == "2000"


@pytest.mark.parametrize("held", [20, 150, 100_000])
def test_components_end_by_rounds_or_at_once(spark, monkeypatch, held):
    """Links that one task may thin need no round of joins; more of them give the same."""
    monkeypatch.setattr(links, "HELD", held)
    joined, names = [], []
    frame = type(spark.range(1))
    join, written = frame.join, links.staged
    monkeypatch.setattr(frame, "join", lambda *x, **y: joined.append(1) or join(*x, **y))
    monkeypatch.setattr(links, "staged", lambda df, name: names.append(name) or written(df, name))
    random.seed(21)
    edges = [(i, i + 1) for i in range(60)] + [(random.randrange(90, 400), random.randrange(90, 400)) for _ in range(250)]
    linked = brute.Sets({n for e in edges for n in e})
    for a, b in edges:
        linked.join(a, b)
    rows = spark.createDataFrame(edges, "a long, b long").repartition(4)
    found = links.components(rows).collect()
    expected = {(n, linked.root(n)) for a, b in edges if a != b for n in (a, b)}
    assert sorted(map(tuple, found)) == sorted(expected)
    if held > len(edges):
        assert not joined and names == ["edges", "edges", "components"]
    if held == 20:
        assert joined


@pytest.mark.parametrize("seed", range(5))
def test_least_nodes(seed):
    rng = np.random.default_rng(seed)
    edges = pd.DataFrame(rng.integers(0, 60, (45, 2)), columns=["u", "v"])
    linked = brute.Sets(set(range(60)))
    for a, b in edges.itertuples(index=False):
        linked.join(a, b)
    found = dict(links.least_nodes(edges).itertuples(index=False))
    nodes = {n for e in edges.itertuples(index=False) for n in e}
    assert found == {n: linked.root(n) for n in nodes if linked.root(n) != n}


def passage(seed, n):
    random.seed(seed)
    return [f"p{random.randrange(10**6)}" for _ in range(n)]


def test_passages_of_fifty_words(spark):
    """Wherever they stand, in lines of any length; what is shorter or alone stays out."""
    long, short = passage(1, 51), passage(2, 18)
    texts = [None, "", "few words"]
    for i in range(4):
        around = [f"t{i}x{j}" for j in range(200)]
        at = 13 * i
        texts.append(" ".join([*around[:at], *long, *around[at:]]))
        texts.append(" ".join([*around[:70], "\n", *short, "\n"]).replace("t", "u"))
    alone = " ".join(passage(3, 60))
    texts.append(f"{alone}\n{alone}")
    line = passage(4, 60)
    texts += ["head\n" + " ".join(line), " ".join([*line[:30], "changed", *line[31:]]) + "\ntail"]
    found = passages.repeated_passages(docs_of(spark, texts)).collect()
    by_doc = {}
    for row in found:
        by_doc.setdefault(row.doc_id, []).append(row)
    assert set(by_doc) == {3, 5, 7, 9, 12, 13}
    for doc in (3, 5, 7, 9):
        for row in by_doc[doc]:
            words = texts[doc][row.start : row.end].split()
            assert len(words) >= passages.WINDOW_WORDS and set(words) <= set(long)
            assert row.kept == (doc == 3)
    lines = {r.doc_id: r for r in found if r.kind == "line"}
    assert set(lines) == {12, 13} and lines[12].kept and not lines[13].kept
    assert texts[12][lines[12].start : lines[12].end] == " ".join(line)
    assert passages.repeated_passages(docs_of(spark, [])).count() == 0


def test_windows_meet_in_any_passage():
    for seed in range(50):
        shared = passage(seed, 50)
        found = []
        for side in "ab":
            text = " ".join([*passage(f"{seed}{side}", seed * 3), *shared, *passage(f"{side}{seed}", 40)])
            found.append({w[0] for w in passages.windows(text, 20, 27, 5)})
        assert found[0] & found[1]


def test_spans_reach_the_ends_of_a_passage(spark):
    """Every word of a shared passage is reported, and none beside it."""
    shared, part, texts, inside = passage(21, 150), passage(22, 38), [], []
    for i in range(12):
        body = shared[: 150 - 7 * i] if i % 3 else shared
        body = part if i > 9 else body
        around = [f"o{i}x{j}" for j in range(120)]
        texts.append(" ".join([*around[: 9 * i], *body, *around[9 * i :]]))
        inside.append(set(body))
    found = passages.repeated_passages(docs_of(spark, texts)).collect()
    for i, text in enumerate(texts):
        mine = [r for r in found if r.doc_id == i and r.kind == "window"]
        words = {w for r in mine for w in text[r.start : r.end].split()}
        assert words == inside[i], i
        removed = {w for r in mine if not r.kept for w in text[r.start : r.end].split()}
        assert removed == (set() if i in (0, 10) else inside[i]), i


def test_near_copies_of_short_lines(spark):
    """Lines are compared from 20 words on, equal or with a word changed."""
    texts, expected = [], set()
    for n in range(17, 40):
        line = passage(100 + n, n)
        changed = [*line[:-1], "changed"] if n > 22 else line
        texts += ["head\n" + " ".join(line), " ".join(changed) + "\ntail"]
        if n >= 20:
            expected |= {len(texts) - 2, len(texts) - 1}
    found = passages.repeated_passages(docs_of(spark, texts)).collect()
    assert {r.doc_id for r in found if r.kind == "line"} == expected


def test_removal_leaves_the_first_holder_whole(spark):
    """A later row shares less with the first row than with the second one."""
    shared = passage(31, 120)
    bodies = [shared[:60], shared, shared, shared[60:]]
    texts = [" ".join([f"a{i}", *body, f"z{i}"]) for i, body in enumerate(bodies)]
    found = passages.repeated_passages(docs_of(spark, texts)).collect()
    left = []
    for i, text in enumerate(texts):
        gone = [(r.start, r.end) for r in found if r.doc_id == i and r.kind == "window" and not r.kept]
        for start, end in sorted(gone, reverse=True):
            text = text[:start] + text[end:]
        left.append(text.split())
    assert left == [texts[0].split(), ["a1", *shared[60:], "z1"], ["a2", "z2"], ["a3", "z3"]]


def test_steps_of_passages_do_not_stay(spark):
    """Windows, contexts and texts are deleted once nothing reads them."""
    root = Path(spark.conf.get("spark.checkpoint.dir")) / "palimpsest"
    held = set(root.glob("*")) if root.exists() else set()
    line = " ".join(passage(41, 60))
    found = passages.repeated_passages(docs_of(spark, [f"a\n{line}", f"b\n{line}", None])).collect()
    assert {(r.doc_id, r.kind) for r in found} == {(i, k) for i in (0, 1) for k in ("line", "window")}
    left = {p.name.rsplit("-", 1)[0] for p in set(root.glob("*")) - held}
    assert not left & {"llm-windows", "llm-seeds", "llm-contexts", "llm-long-lines", "llm-sketches"}


def test_sketches_of_many_texts():
    """Texts sketched together have the sets and registers each has alone."""
    random.seed(42)
    texts = [" ".join(random.choices("abcdefgh", k=random.randrange(40))) for _ in range(300)]
    texts += ["", "x", "Ää\x0bB c d e f", " ".join(map(str, range(3000)))]
    alone = [neardup.shingles(t, 5) for t in texts]
    together = [s for part in neardup._runs(texts) for s in neardup.shingle_sets(part, 5)]
    assert all(np.array_equal(a, b) for a, b in zip(alone, together, strict=True))
    full = [s for s in alone if len(s)]
    assert np.array_equal(neardup.registers_of(full), [neardup.registers(s) for s in full])


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(links, "BLOCK", 16)
    random_ = np.random.default_rng(11)
    base = random_.standard_normal((30, 24))
    rows = [base[i % 30] + 0.05 * random_.standard_normal(24) for i in range(60)]
    rows += [base[0] + 0.03 * random_.standard_normal(24) for _ in range(40)]
    rows += [rows[0]] * 5 + [3 * rows[1], 1e-300 * rows[1], 1e300 * rows[2]]
    rows = [[float(x) for x in r] for r in rows]
    rows += [None, [], [0.0] * 24, [float("nan")] * 24, [1.0, None], [float("inf"), 1.0], [1.0, 2.0]]
    ids = list(range(len(rows) - 1)) + [None]
    table = spark.createDataFrame(
        [(i, r, 5) for i, r in zip(ids, rows)], "vec_id long, embedding array<double>, n int"
    )
    found = vectors.near_vectors(table).collect()
    assert len(found) == len(rows)
    units = [vectors.unit_vector(r) for r in rows]
    linked, degree = brute.Sets(range(len(rows))), [0] * len(rows)
    for i, a in enumerate(units):
        for j, b in enumerate(units[:i]):
            if a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95:
                linked.join(i, j)
                degree[i] += 1
                degree[j] += 1
    for row in found:
        i = len(rows) - 1 if row.vec_id is None else row.vec_id
        root = linked.root(i) if row.vec_id is not None else None
        assert (row.n_links, row.component_id) == (degree[i], root)
        assert row.kept == (root == row.vec_id)
    assert vectors.near_vectors(table.filter("false")).count() == 0


def test_probability_of_meeting():
    """Pairs at the threshold meet in some table nearly always, strangers hardly ever."""
    random_ = np.random.default_rng(2)
    a = random_.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    other = random_.standard_normal((2000, 64))
    other -= (other * a).sum(axis=1)[:, None] * a
    other /= np.linalg.norm(other, axis=1)[:, None]
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * other
    assert (vectors.codes(a) == vectors.codes(b)).any(axis=1).mean() > 0.97
    assert (vectors.codes(a) == vectors.codes(other)).any(axis=1).mean() < 0.01


def test_float_vectors_and_no_vectors(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [r.n_links for r in vectors.near_vectors(table).collect()] == [1, 1]
