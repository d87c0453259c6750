"""Operator 2: secret scans in SQL functions alone.

Three fixed kinds are found by pattern (``BASE``). Beside them, candidate strings (long
runs of key characters) are judged by the Shannon entropy of a sliding window. One fold
over the characters keeps the window and the sum of c*log2(c) of its counts c; a character
that comes or goes changes one count, so each step changes one term. The greatest entropy
of any window is held against the threshold of the string's character class. Parts between
slashes on the allow list (placeholders, runs) are left out first; candidates of which a
UUID, a number or too little is left, and checksums by context, are let go.

Spans are (start, kind, end) in code points, end exclusive, sorted by start and then by
the order of ``KINDS``. Base spans are never suppressed; an entropy span that overlaps one
is left out. Positions come from the lengths of what lies between the matches of a pattern.

Defined cases: null or empty texts have no spans; a text may be of any length and hold any
number of spans; repeated rows are scanned one by one; other columns pass through
untouched, but a column of the result's name is replaced. An empty table stays empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sha_hex, table, whole

# The base kinds, their patterns and least lengths.
BASE = {
    "assign": (
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = (*BASE, "entropy")

WINDOW = 20
# Character class of a candidate -> (pattern of the whole string, least bits a character).
# Text in natural language stays below 3.4 bits in such windows; random strings of these
# alphabets lie around 3.4, 3.8 and 3.9. Without a digit it may be words run together,
# which reach 3.8; random letters go beyond 4 in some window.
CLASSES = {
    "hex": (r"^[0-9A-Fa-f]+$", 3.05),
    "alnum": (r"^(?=.*[0-9])(?=.*[A-Za-z])[0-9A-Za-z]+=*$", 3.45),
    "mixed": (r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z]).+$", 3.65),
    "letters": (r"^[^0-9]+$", 3.9),
    "other": (r"^.+$", 3.7),
}
# A part between slashes that matches is left out before the rest is judged ...
ALLOWED_PART = (
    r"(?i)(example|sample|dummy|placeholder|changeme|redacted|xxxx|your_|lorem)",
    r"(?i)(0123456789|abcdefghij|qwertyuiop|(.)\2{7})",
)
# ... and what is left must not be one of these as a whole.
ALLOWED = (
    r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
    r"^[0-9]+$",
)
ALLOWED_BEFORE = r"(?i)(sha-?(1|256|384|512)|md5|commit|checksum|integrity)[\"':= -]*$"
MARK = "<secret>"

_SPAN = "array<struct<start:int,kind:int,end:int>>"
_TERMS = [c * math.log2(c) if c else 0.0 for c in range(WINDOW + 2)]


def _term(count: Column) -> Column:
    return F.get(F.lit(_TERMS), count)


def _count(window: Column, char: Column) -> Column:
    return F.length(window) - F.length(F.replace(window, char, F.lit("")))


def max_entropy(string: Column) -> Column:
    """Greatest entropy of any window of the string, null if it is shorter than one."""

    def step(state: Column, char: Column) -> Column:
        added = F.struct(
            F.concat(state["window"], char).alias("window"),
            (
                state["total"]
                + _term(_count(state["window"], char) + 1)
                - _term(_count(state["window"], char))
            ).alias("total"),
            state["least"].alias("least"),
        )

        def drop_first(s: Column) -> Column:
            gone = F.substring(s["window"], 1, 1)
            n = _count(s["window"], gone)
            total = s["total"] - _term(n) + _term(n - 1)
            full = F.length(s["window"]) > WINDOW
            return F.struct(
                F.when(full, F.substring(s["window"], 2, WINDOW))
                .otherwise(s["window"])
                .alias("window"),
                F.when(full, total).otherwise(s["total"]).alias("total"),
                s["least"].alias("least"),
            )

        def keep_least(s: Column) -> Column:
            full = F.length(s["window"]) == WINDOW
            return F.struct(
                s["window"].alias("window"),
                s["total"].alias("total"),
                F.when(full, F.least(s["least"], s["total"]))
                .otherwise(s["least"])
                .alias("least"),
            )

        # One-element arrays name the steps, so that none is computed twice.
        dropped = F.transform(F.array(added), drop_first)
        return F.get(F.transform(dropped, keep_least), F.lit(0))

    start = F.struct(
        F.lit("").alias("window"),
        F.lit(0.0).alias("total"),
        F.lit(None).cast("double").alias("least"),
    )
    least = F.aggregate(F.split(string, ""), start, step)["least"]
    return math.log2(WINDOW) - least / WINDOW


def _matches(string: Column, patterns: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | string.rlike(pattern)
    return found


def _is_secret(string: Column, before: Column) -> Column:
    """Whether what the allow list leaves of a candidate is random for its class."""
    parts = F.filter(F.split(string, "/"), lambda part: ~_matches(part, ALLOWED_PART))
    left = F.array_join(parts, "/")

    def judged(rest: Column) -> Column:
        bits = max_entropy(F.rtrim(rest, F.lit("=")))
        random = F.lit(False)
        for pattern, least in reversed(CLASSES.values()):
            enough = F.coalesce(bits >= least, F.lit(False))
            random = F.when(rest.rlike(pattern), enough).otherwise(random)
        return ~_matches(rest, ALLOWED) & random

    # A one-element array names the rest, so that it is not computed twice.
    return ~before.rlike(ALLOWED_BEFORE) & F.get(F.transform(F.array(left), judged), F.lit(0))


def _located(text: Column, found: Column, pattern: str, kind: int, keep) -> Column:
    """Spans of the matches ``found``; ``keep(i, match, gap before)`` selects."""
    gaps = F.split(text, pattern, -1)

    def step(state: Column, i: Column) -> Column:
        match, gap = F.get(found, i), F.get(state["gaps"], i)
        start = state["at"] + F.length(gap)
        end = start + F.length(match)
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(
            end.alias("at"),
            state["gaps"].alias("gaps"),
            F.when(keep(i, match, gap), F.concat(state["out"], F.array(span)))
            .otherwise(state["out"])
            .alias("out"),
        )

    start = F.struct(
        F.lit(0).alias("at"), gaps.alias("gaps"), F.array().cast(_SPAN).alias("out")
    )
    places = F.sequence(F.lit(0), F.size(found) - 1)
    return F.when(F.size(found) > 0, F.aggregate(places, start, step)["out"]).otherwise(
        F.array().cast(_SPAN)
    )


def find_secrets(df: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """``df`` with the spans of all kinds in the column ``into``."""
    names = df.columns
    t = "__secret_text"
    found = df.withColumn(t, whole(df[text]))
    for kind, (pattern, _, _) in BASE.items():
        matches = F.regexp_extract_all(F.col(t), F.lit(pattern), F.lit(0))
        found = found.withColumn(f"__secret_{kind}", matches)
    found = found.withColumn(
        "__secret_run", F.regexp_extract_all(F.col(t), F.lit(CANDIDATE), F.lit(0))
    )
    kept = []
    for number, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        matches = F.col(f"__secret_{kind}")
        if group:
            values = F.regexp_extract_all(F.col(t), F.lit(pattern), F.lit(group))
            found = found.withColumn(
                f"__secret_{kind}_value", F.when(F.size(matches) > 0, values)
            )
            values = F.col(f"__secret_{kind}_value")
        else:
            values = matches
        long = lambda i, match, gap, v=values, n=least: F.length(F.get(v, i)) >= n
        kept.append(_located(F.col(t), matches, pattern, number, long))
    random = _located(
        F.col(t),
        F.col("__secret_run"),
        CANDIDATE,
        len(BASE),
        lambda i, match, gap: _is_secret(match, F.right(gap, F.lit(24))),
    )
    found = found.withColumn("__secret_base", F.array_sort(F.concat(*kept)))
    found = found.withColumn("__secret_random", random)
    free = F.filter(
        "__secret_random",
        lambda r: ~F.exists(
            "__secret_base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])
        ),
    )
    spans = F.when(
        F.size("__secret_random") > 0, F.array_sort(F.concat("__secret_base", free))
    ).otherwise(F.col("__secret_base"))
    return found.select(*[c for c in names if c != into], spans.alias(into))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    kinds = F.lit(list(KINDS))
    one = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def redact(df: DataFrame, text: str = "text", mark: str = MARK) -> DataFrame:
    """``df`` with every span (joined where they overlap) replaced by ``mark``."""
    spans = "__secret_spans"

    def step(state: Column, span: Column) -> Column:
        new = span["start"] >= state["at"]
        between = F.substring(state["text"], state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            state["text"].alias("text"),
            F.when(new, F.concat(state["out"], between, F.lit(mark)))
            .otherwise(state["out"])
            .alias("out"),
        )

    start = F.struct(
        F.lit(0).alias("at"), F.col(text).alias("text"), F.lit("").alias("out")
    )
    done = lambda s: F.concat(s["out"], F.substring(s["text"], s["at"] + 1, F.length(s["text"])))
    clean = F.when(F.size(spans) > 0, F.aggregate(spans, start, step, done)).otherwise(
        F.col(text)
    )
    return find_secrets(df, text, spans).withColumn(text, clean).drop(spans)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs)
    number = {kind: i for i, kind in enumerate(KINDS)}
    of = lambda kind: F.filter("secrets", lambda s: s["kind"] == number[kind])
    base = F.filter("secrets", lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        sha_hex(as_text(base)).alias("base_sha256"),
        as_text(F.col("secrets")).alias("spans"),
    )
