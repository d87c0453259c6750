"""Chat formatting, quality scores and token files."""

import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from palimpsest.llm import chat, quality, tokenfile
from palimpsest.session import scratch_path

from . import brute

# --- chat ------------------------------------------------------------------------

HOSTILE = ["<|im_end|>", r"<\|im_end|> <\\|im_start|><|", "a\\b\nc", "", "é\n\n<|im_start|>user\nx"]


@pytest.mark.parametrize("text", HOSTILE)
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.START not in chat.escape(text) and chat.STOP not in chat.escape(text)
    assert chat._role_in(chat._role_out(text)) == text and "\n" not in chat._role_out(text)


RECORDS = {
    "messages": {"messages": [{"role": "tool", "content": "x"}, {"role": "user"}], "id": 7},
    "shared": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "nested": {"dialog": {"turns": [{"speaker": "bot", "utterance": "hi"}]}},
    "prompt": {"prompt": "p", "completion": "c", "source": {"x": 1}},
    "response": {"system": "s", "prompt": "p", "response": None},
    "instruction": {"instruction": "do", "input": "this", "output": ["l", 1]},
    "empty input": {"instruction": "do", "input": "", "output": "o"},
    "unknown": {"text": "only"},
    "no turns": {"messages": []},
}
TURNS = {
    "messages": [("tool", "x"), ("user", "")],
    "shared": [("user", "q"), ("assistant", "a")],
    "nested": [("assistant", "hi")],
    "prompt": [("user", "p"), ("assistant", "c")],
    "response": [("system", "s"), ("user", "p"), ("assistant", "")],
    "instruction": [("user", "do\n\nthis"), ("assistant", '["l", 1]')],
    "empty input": [("user", "do"), ("assistant", "o")],
}


def test_layouts(spark):
    rows = [(k, 0, json.dumps(r), "extra") for k, r in RECORDS.items()]
    rows += [("null", 0, None, ""), ("broken", 0, "{", ""), ("list", 0, "[1]", "")]
    records = spark.createDataFrame(rows, "c string, p int, record string, conv_id string")
    found = {}
    for row in chat.turns(records, "c", "p").orderBy("conv_id", "place").collect():
        found.setdefault(row.conv_id, []).append((row.role, row.text))
    assert found == TURNS


def test_every_layout_has_one_fingerprint():
    prints = [chat.fingerprint(x) for m in chat.MAPPINGS for x in m.layouts()]
    shared = {chat.fingerprint(x) for x in [("system",), ("prompt",), ("system", "prompt")]}
    assert {p for p in prints if prints.count(p) > 1} == shared


def chats(spark, rows):
    schema = "conv_id long, turn long, role string, text string, place int"
    return spark.createDataFrame([(*r, 9) for r in rows], schema)


@pytest.mark.parametrize("part", [30, 1_000_000])
def test_chats_read_back(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART_CHARS", part)
    rows = [(c, t, r, HOSTILE[(c + t) % 5]) for c in range(8) for t, r in enumerate(
        ["system", "user", "assistant", "odd\nrole", "assistant"])]
    rows += [(3, 9, None, None), (None, 1, "assistant", "lost"), (5, 2, "assistant", "a tie")]
    rows += [rows[0], rows[0]]
    records = chat.as_records(chats(spark, rows))
    formatted = chat.format_chats(chat.turns(records, "conv_id", "turn"))
    assert formatted.count() > (8 if part > 30 else 20)
    total = {r[0]: r[1] for r in formatted.groupBy("conv_id").agg(F.sum(F.length("formatted"))).collect()}
    found = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert len(found) == 9
    for conv, row in found.items():
        turns = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv)
        every = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert tuple(row) == (
            conv, len(turns), brute.sha(every), len(loss), brute.sha(loss), total[conv]
        )


def test_no_chats(spark):
    records = chat.as_records(chats(spark, []))
    formatted = chat.format_chats(chat.turns(records, "conv_id", "turn"))
    assert chat.read_back(formatted).count() == 0


# --- quality ---------------------------------------------------------------------


def labelled(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs, spark.read.parquet(f"{sf}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark, "/root/testdata/sf0.01")
    scored = quality.query(spark, "/root/testdata/sf0.01")
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 60
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_rows_are_not_learned(spark):
    docs, labels = labelled(spark, "/root/testdata/sf0.001")
    flipped = labels.withColumn(
        "quality", F.when(quality.is_held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    models = [quality.train(docs, x) for x in (labels, flipped)]
    assert (models[0].weight == models[1].weight).all()


def test_scores_do_not_depend_on_the_batch(spark, monkeypatch):
    docs, labels = labelled(spark, "/root/testdata/sf0.001")
    model = quality.train(docs, labels)
    texts = [r.text for r in docs.limit(60).collect()] + ["", " ", "one", "two words"]
    together = quality.score_texts(texts, model)
    monkeypatch.setattr(quality, "SLICE_CHARS", 1)
    alone = quality.score_texts(texts, model)
    assert np.allclose(together, alone)
    ids = [quality.count_features(t) for t in texts]
    means = [float(model.weight[i] @ w) if len(i) else 0.0 for i, w in ids]
    assert np.allclose(model.probability(np.array(means)), alone, atol=1e-5)
    assert alone[-4] == alone[-3] == model.probability(np.zeros(1))[0]


def test_a_long_document_does_not_end_the_sample(spark, monkeypatch):
    """Wherever the hash of its id puts it."""
    how, seen = quality.Training(train_chars=800, epochs=1), []
    monkeypatch.setattr(quality, "descend", lambda rows, how: seen.append(rows))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2][:8]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    for long in ids:
        texts = [(i, "good words " * 90 if i == long else f"text {i}") for i in ids]
        quality.train(spark.createDataFrame(texts, "doc_id long, text string"), labels, how=how)
    assert [len(rows) for rows in seen] == [8] * 8


def test_no_training_rows_but_labels(spark):
    docs = spark.createDataFrame([(1, "some words"), (3, "more")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    with pytest.raises(ValueError, match="labelled"):
        quality.train(docs, labels, how=quality.Training(train_docs=0))
    quality.train(docs.filter("false"), labels)


def test_odd_rows_are_scored(spark):
    docs = spark.createDataFrame(
        [(1, None, 5.0), (1, "a b", 5.0), (None, "a b", 5.0), (1, "a b", 5.0)],
        "doc_id long, text string, score double",
    )
    labels = spark.createDataFrame(
        [(1, None), (None, 1), (1, 1), (1, 1), (1, 0)], "doc_id long, quality int"
    )
    model = quality.train(docs, labels)
    rows = quality.classify(docs, model).collect()
    assert len(rows) == 4 and all(0 < r.score < 1 for r in rows)
    assert quality.classify(docs.filter("false"), model).count() == 0
    none = quality.train(docs, labels.filter("false"))
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}


# --- token files -----------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_packing_is_reversible():
    random = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        numbers = (2 ** random.uniform(0, 32, n)).astype(np.uint32)
        control, data = tokenfile.pack(numbers)
        assert len(control) == -(-n // 4)
        back = tokenfile.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
        assert (back == numbers).all()


ODD = [
    (5, "a  b\tc\n\nd   é É don't we'LL 12 x_y ß ÿ"),
    (None, "null id"),
    (3, None),
    (2, ""),
    (2, "<|endoftext|> x<|startoftext|>y \x00 z \x00\x00a"),
    (-7, "ΑΣ Σ İI µ ª ×÷"),
    (2**60 + 1, "日本語 😀 " * 50),
    (9, "word " * 3000),
    (9, "word " * 3000),
]


def test_runs_between_white_space_are_cut_once(monkeypatch):
    """Each distinct run is cut into pieces once, however often it occurs."""
    cut = []

    class Pieces:
        def findall(self, text):
            cut.append(text)
            return PIECE.findall(text)

    PIECE = tokenfile._PIECE
    monkeypatch.setattr(tokenfile, "_PIECE", Pieces())
    texts = ["We're here, at 10:45 -- Ça  va?\r\n" * 50, "at\there, (here)", "", "   ", "it's 'sad' don't''s"] * 3
    found = tokenfile.token_ids(texts, PATH)
    library = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, found):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, tokenfile.END]
    assert len(cut) == len(set(cut)) and sum(map(len, cut)) < 100


def test_runs_of_earlier_texts_are_not_cut_again(monkeypatch):
    """Ids of short runs are kept from text to text, those of long ones are not; all equal the library's."""
    cut = []

    class Pieces:
        def findall(self, text):
            cut.append(text)
            return PIECE.findall(text)

    PIECE = tokenfile._PIECE
    monkeypatch.setattr(tokenfile, "_PIECE", Pieces())
    monkeypatch.setattr(tokenfile, "CACHED_CHARS", 12)
    tokenfile._words.cache_clear()
    library = Tokenizer.from_file(PATH)
    long = "x1" * 40 + " " + "letters" * 9
    for text in ["quay-side (10:45), quay", "Quay-side 'tis (10:45), " + long, long + " quay-side ,", "  ", long]:
        found = tokenfile.token_ids([text], PATH)[0]
        assert found.tolist() == [*library.encode(text, add_special_tokens=False).ids, tokenfile.END]
    short = [run for run in cut if 0 < len(run) <= 12]
    assert len(short) == len(set(short)) == 4
    assert all(len(run) <= 12 for run in tokenfile._words(PATH).known)


@pytest.mark.parametrize("shard", [10, 1 << 20])
def test_files_equal_the_library(spark, monkeypatch, shard):
    monkeypatch.setattr(tokenfile, "SHARD_TOKENS", shard)
    monkeypatch.setattr(tokenfile, "CACHED_WORDS", 5)
    library = Tokenizer.from_file(PATH)
    rows = [(i, t, "x", 1) for i, t in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, row int").coalesce(1)
    encoded = tokenfile.encode(docs, PATH)
    order = tokenfile.frequency_order(encoded)
    path = scratch_path(spark, "token-files")
    tokenfile.write_files(encoded, order, path)
    found = tokenfile.read_back(spark, path, order).orderBy("start").collect()
    at = 0
    for row, (doc_id, text) in zip(found, sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, tokenfile.END]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(row) == (doc_id, at, len(ids), crc), text
        at += len(ids)
    counts = np.bincount(np.concatenate(tokenfile.token_ids([t or "" for _, t in ODD], PATH)))
    assert (np.diff(counts[order]) <= 0).all() and counts[order].sum() == at


def test_no_token_files(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    encoded = tokenfile.encode(docs, PATH)
    order = tokenfile.frequency_order(encoded)
    path = scratch_path(spark, "token-files")
    tokenfile.write_files(encoded, order, path)
    assert tokenfile.read_back(spark, path, order).count() == 0


def test_running_total(spark):
    rows = spark.range(500).selectExpr("id % 50 AS k", "id AS t", "id % 7 AS n")
    found = tokenfile.running_total(rows, ["k", "t"], "n", "before").orderBy("k", "t").collect()
    assert [r.before for r in found] == np.cumsum([0, *[r.n for r in found]])[:-1].tolist()
