"""Operator 3: license scans as an exact set-similarity join, in SQL functions alone.

Blocks are the lines of a text, and of a text with several lines also windows of its words
across line ends, as sets of words; templates are short license statements. With w words
in the longest template, a window of 2w words begins at every w-th word, so any w + 1 words
in a row, however they are wrapped, stand in one.
A block meets a template if it holds at least ``THRESHOLD`` of its words and all of its
required ones (a version number, say). All templates that a block meets give their labels,
except one whose words are among those of another template it meets (cc-by under
cc-by-nc). The score is the greatest share of a template's words.

The join finds every such pair:

* the templates' words are ordered by how many documents of the corpus hold them, rarest
  first;
* prefix filter: with n words of which m are needed, a block must hold one of the n-m+1
  rarest, so only these stand in the index that the blocks' words are joined with;
* length filter: the block has at least m words;
* positional filter: if the first match is the i-th rarest word, at most n-i are common.

The index has at most as many rows as the templates have words, so it is broadcast.
Beside the join, fixed phrases are located word by word.

Defined cases: null and empty texts have no words, no places and score 0; texts and lines
may be of any length; repeated rows are scanned one by one; other columns pass through
untouched, but columns of the results' names are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import local_rows
from .common import staged, table, whole

# What a word is, and the base phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}
# The rarest-looking word of each phrase, which a text must hold to be looked at closely.
ANCHORS = {"mit": "license", "apache-2": "apache", "cc-by-nc": "nc"}

THRESHOLD = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    required: str

    @property
    def words(self) -> tuple[str, ...]:
        return tuple(sorted(set(self.text.split())))

    @property
    def needed(self) -> int:
        return math.ceil(THRESHOLD * len(self.words) - 1e-9)


TEMPLATES = (
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "licensed under the mit license", "mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of"
        " this software",
        "permission granted",
    ),
    Template("apache-2", "licensed under the apache license version 2 0", "apache 2"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general 2"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general 3"),
    Template(
        "lgpl-3", "licensed under the gnu lesser general public license version 3", "lesser 3"
    ),
    Template(
        "agpl-3", "licensed under the gnu affero general public license version 3", "affero 3"
    ),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla 2"),
    Template("bsd", "use of this source code is governed by a bsd style license", "bsd license"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification"
        " are permitted",
        "redistribution permitted",
    ),
    Template("cc-by", "licensed under cc by 4 0", "cc by"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template(
        "cc-by", "licensed under a creative commons attribution 4 0 license", "commons attribution"
    ),
    Template("public-domain", "this work is dedicated to the public domain", "public domain"),
    Template("proprietary", "all rights reserved no part may be reproduced", "rights reserved"),
)


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def words(text: Column) -> Column:
    """Words of a text whose A-Z are in lower case."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _places(found: Column, label: str) -> Column:
    """Where the phrase's words stand consecutively, from 0."""
    phrase = PHRASES[label].split()

    def here(i: Column) -> Column:
        same = [F.get(found, i + k) == word for k, word in enumerate(phrase)]
        return F.coalesce(reduce(lambda a, b: a & b, same), F.lit(False))

    there = F.array_contains(found, ANCHORS[label])
    starts = F.filter(F.sequence(F.lit(0), F.size(found) - 1), here)
    return F.when(there, starts).otherwise(F.array().cast("array<int>"))


def _labelled(starts: Column, label: str) -> Column:
    return F.transform(
        starts, lambda at: F.struct(at.alias("start"), F.lit(label).alias("label"))
    )


def token_order(docs: DataFrame, text: str, templates: tuple[Template, ...]) -> list[str]:
    """The templates' words, those in the fewest documents first."""
    every = sorted({w for t in templates for w in t.words})
    found = words(lower_ascii(whole(docs[text])))
    counts = (
        docs.select(F.explode(F.array_intersect(found, F.lit(every))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = {r.word: r.n for r in counts.collect()}  # as many rows as the templates have words
    return sorted(every, key=lambda w: (n.get(w, 0), w))


def prefix_index(order: list[str], templates: tuple[Template, ...]) -> list[tuple]:
    """(word, template, place in its order) of the prefixes."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for number, template in enumerate(templates):
        ordered = sorted(template.words, key=rank.__getitem__)
        prefix = ordered[: len(ordered) - template.needed + 1]
        rows += [(word, number, i) for i, word in enumerate(prefix)]
    return rows


def _matches(
    blocks: DataFrame, order: list[str], index: list[tuple], templates: tuple[Template, ...]
) -> DataFrame:
    """(row, label, score) of the ``blocks`` (row, block, words) that meet a template.

    Both sides are in the global order. Of a block and a template that share a word at
    places j and i, what they share from there on is at most the shorter rest; for the
    first word they share that is all they share, so no match is lost by the filter.
    """
    spark = blocks.sparkSession
    entries = local_rows(spark, index, "word string, template int, place int")
    known = local_rows(
        spark,
        [
            (i, t.label, list(t.words), t.required.split(), t.needed)
            for i, t in enumerate(templates)
        ],
        "template int, label string, t_words array<string>, required array<string>, needed int",
    )
    rare = F.lit(sorted({word for word, _, _ in index}))
    ranked = blocks.withColumn("known", F.array_intersect(F.lit(order), F.col("words")))
    hits = F.transform("known", lambda w, j: F.struct(w.alias("word"), j.alias("at")))
    probes = ranked.select(
        "row", "block", "known", F.inline(F.filter(hits, lambda h: F.array_contains(rare, h["word"])))
    )
    joined = probes.join(F.broadcast(entries.join(known, "template")), "word")
    rest = F.least(F.size("t_words") - F.col("place"), F.size("known") - F.col("at"))
    common = F.size(F.array_intersect("known", "t_words"))
    met = (
        joined.filter(rest >= F.col("needed"))
        .filter(F.size(F.array_except("required", "known")) == 0)
        .withColumn("common", common)
        .filter(F.col("common") >= F.col("needed"))
    )
    score = (F.col("common") / F.size("t_words")).alias("score")
    met = staged(met.select("row", "block", "template", "label", score).distinct(), "license-met")
    covered = local_rows(spark, covers(templates), "template int, under int")
    # Windows have negative numbers; one may end within what the next one holds whole.
    near = F.when(F.col("block") < 0, F.array(*[F.col("block") + i for i in (-1, 0, 1)]))
    under = met.join(F.broadcast(covered), "template").select(
        "row",
        F.explode(F.coalesce(near, F.array("block"))).alias("block"),
        F.col("under").alias("template"),
    )
    return met.join(under, ["row", "block", "template"], "left_anti").select(
        "row", "label", "score"
    )


def covers(templates: tuple[Template, ...]) -> list[tuple[int, int]]:
    """(template, another whose words are a part of its words)."""
    sets = [set(t.words) for t in templates]
    return [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if b < a]


def _windows(found: str, templates: tuple[Template, ...]) -> Column:
    """Windows of the words as blocks, numbered -2, -3, ..."""
    step = max(len(t.text.split()) for t in templates)
    last = F.greatest(F.size(found) - step - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last, F.lit(step)),
        lambda at, i: F.struct(
            (-2 - i).alias("block"),
            F.array_distinct(F.slice(found, at + 1, F.lit(2 * step))).alias("words"),
        ),
    )


def find_licenses(
    docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES
) -> DataFrame:
    """``docs`` without ``text``, with n_words, places, base_labels, labels and score.

    ``places`` has every (start, label) of a phrase.
    """
    order = token_order(docs, text, templates)
    index = prefix_index(order, templates)
    rare = F.lit(sorted({word for word, _, _ in index}))
    added = ("n_words", "places", "base_labels", "labels", "score")
    kept = [c for c in docs.columns if c != text and c not in added]
    low = lower_ascii(whole(docs[text]))
    base = docs.select(*kept, low.alias("__low")).withColumn("__words", words(F.col("__low")))
    places = [_labelled(_places(F.col("__words"), label), label) for label in PHRASES]
    # Only blocks that hold a word of the index can meet a template.
    holds = lambda b: F.arrays_overlap(b["words"], rare)
    lines = F.transform(
        F.split("__low", "\n"),
        lambda line, i: F.struct(i.alias("block"), F.array_distinct(words(line)).alias("words")),
    )
    wrapped = F.when(F.contains("__low", F.lit("\n")), F.filter(_windows("__words", templates), holds))
    blocks = F.concat(
        F.filter(lines, holds), F.coalesce(wrapped, F.array().cast("array<struct<block:int,words:array<string>>>"))
    )
    rows = staged(
        base.select(
            *kept,
            F.size("__words").cast("long").alias("n_words"),
            F.array_sort(F.concat(*places)).alias("places"),
            F.when(F.arrays_overlap("__words", rare), blocks).alias("__blocks"),
            F.monotonically_increasing_id().alias("__row"),
        ),
        "license-rows",
    )
    each = rows.select(F.col("__row").alias("row"), F.explode("__blocks").alias("b"))
    blocks = each.select("row", "b.block", "b.words")
    found = (
        _matches(blocks, order, index, templates)
        .groupBy(F.col("row").alias("__found_row"))
        .agg(F.collect_set("label").alias("__found"), F.max("score").alias("__best"))
    )
    base_labels = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    none = F.array().cast("array<string>")
    joined = rows.join(found, F.col("__row") == F.col("__found_row"), "left")
    return joined.select(
        *kept,
        "n_words",
        "places",
        base_labels.alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat(base_labels, F.coalesce("__found", none)))).alias(
            "labels"
        ),
        F.when(F.size("places") > 0, F.lit(1.0))
        .otherwise(F.coalesce("__best", F.lit(0.0)))
        .alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    starts = F.transform("places", lambda p: p["start"])
    return find_licenses(docs).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
