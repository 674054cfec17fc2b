"""Secrets in texts: three patterns, and high-entropy strings by a sliding window.

Built from SQL functions alone: no Python runs on the executors. Places are code points,
ends exclusive. A null text is empty and has no spans; empty tables give empty results;
rows are scanned one by one, so ties and repeated rows need no rule; further columns of
the input are kept by :func:`scan` and :func:`redact` (a column ``spans`` is replaced).

Entropy: a candidate is a run of :data:`RUN` characters. Its class is ``hex`` if all of
them are hex digits, else ``base64``. A window of :data:`WINDOW` characters slides over
it; the counts of its characters change by one in and one out at each step, and with them
the sum of ``c log2 c`` that gives the entropy. Windows at or above the threshold of the
class are joined to spans. Suppressed are candidates that an allow-list pattern covers
and spans that lie within one of a base pattern.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import fresh

# The patterns of the contract.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"  # runs of 20 and more; the run is greedy, so shorter ones never hide longer
HEX = "[0-9a-f]{24,}"
ASSIGN_VALUE = 6

WINDOW = 20
RUN = "[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Least entropy of a window, in bits; between two values that 20 characters can have.
THRESHOLDS = {"hex": 3.2, "base64": 3.87}
#: Whole candidates that are no secrets.
ALLOWED = [
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",  # identifiers of this form are public
    r"[A-Za-z]+",  # a word
    r"[0-9]+",  # a number
    r"(?i).*(example|sample|dummy|placeholder|changeme|your_).*",
    r"(?i).*(0123456789|abcdefghij|qwertyuiop).*",
]
#: Candidates that start with the first and hold the second nowhere are words and numbers in a
#: row. Said as one pattern, a repeated choice, a long row would overflow the matcher's stack.
ROW_START, ROW_BREAK = "[A-Za-z0-9]", "[A-Za-z][0-9]|[0-9][A-Za-z]"
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base64"]
SPANS = "array<struct<start:int,kind:int,end:int>>"


def _empty(kind: str) -> Column:
    return F.array().cast(kind)


def places(text: Column, pattern: str) -> Column:
    """Every match of a pattern as ``struct(start, text)``, leftmost and apart from each other.

    What lies between matches is what splitting at them leaves, so lengths give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(found.alias("hit"), F.split(text, pattern, -1).alias("gap"))
    none = F.array().cast("array<struct<start:int,hit:string>>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["gap"])
        hit = F.struct(start.alias("start"), part["hit"].alias("hit"))
        return F.struct(
            (start + F.coalesce(F.char_length(part["hit"]), F.lit(0))).alias("at"),
            F.when(part["hit"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(hit))).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))
    return F.when(F.rlike(text, F.lit(pattern)), F.aggregate(zipped, zero, step, lambda s: s["out"])).otherwise(none)


def _span(start: Column, kind: int, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"))


def base_spans(text: Column) -> Column:
    assign = F.filter(
        places(text, ASSIGN), lambda m: F.char_length(F.regexp_extract(m["hit"], ASSIGN, 2)) >= ASSIGN_VALUE
    )

    def spans(kind: int, hits: Column) -> Column:
        return F.transform(hits, lambda m: _span(m["start"], kind, m["start"] + F.char_length(m["hit"])))

    found = [assign, places(text, ACCESS), places(text, HEX)]
    return F.array_sort(F.concat(*[spans(k, hits) for k, hits in enumerate(found)]))


def windows(chars: Column, threshold: Column) -> Column:
    """Joined windows of a candidate, given as its characters: ``struct(start, end)``.

    The state holds one count for each character of the alphabet, as the characters of a
    string, and the sum of ``c log2 c``; a step reads and writes two counts.
    """
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    none = F.array().cast("array<struct<start:int,end:int>>")

    def count(counts: Column, place: Column) -> Column:
        return F.ascii(F.substring(counts, place, F.lit(1))) - 1

    def put(counts: Column, place: Column, value: Column) -> Column:
        return F.overlay(counts, F.chr((value + 1).cast("long")), place, F.lit(1))

    def with_one(x: Column, f) -> Column:
        """``f`` of a value that is computed once."""
        return F.element_at(F.transform(F.array(x), f), 1)

    def enter(state: Column, place: Column, now: Column, change: int) -> Column:
        moved = now + change
        return F.struct(
            put(state["counts"], place, moved).alias("counts"),
            (state["sum"] + F.get(weight, moved) - F.get(weight, now)).alias("sum"),
        )

    def move(state: Column, char: Column, change: int) -> Column:
        return with_one(
            F.instr(F.lit(ALPHABET), char),
            lambda place: with_one(count(state["counts"], place), lambda now: enter(state, place, now, change)),
        )

    def step(state: Column, i: Column) -> Column:
        grown = move(state["window"], F.get(chars, i), 1)
        slid = F.when(i >= WINDOW, with_one(grown, lambda g: move(g, F.get(chars, i - WINDOW), -1))).otherwise(grown)

        def judge(window: Column) -> Column:
            high = (i >= WINDOW - 1) & (F.lit(math.log2(WINDOW)) - window["sum"] / WINDOW >= threshold)
            first, end = i - (WINDOW - 1), i + 1
            last = F.try_element_at(state["out"], F.lit(-1))
            joins = F.coalesce(F.try_element_at(state["out"], F.lit(-1))["end"], F.lit(-1)) >= first
            longer = F.concat(
                F.slice(state["out"], F.lit(1), F.size(state["out"]) - 1),
                F.array(F.struct(last["start"].alias("start"), end.alias("end"))),
            )
            fresh = F.concat(state["out"], F.array(F.struct(first.alias("start"), end.alias("end"))))
            out = F.when(~high, state["out"]).when(joins, longer).otherwise(fresh)
            return F.struct(window.alias("window"), out.alias("out"))

        return with_one(slid, judge)

    empty = F.struct(F.lit("\x01" * len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"))
    start = F.struct(empty.alias("window"), none.alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), start, step, lambda s: s["out"])


def entropy_spans(text: Column, base: Column) -> Column:
    """Spans of high entropy that the allow-list lets stand and that no base span holds."""

    def judged(c: Column) -> Column:
        is_hex = F.rlike(c["hit"], F.lit("^[0-9A-Fa-f]+$"))
        threshold = F.when(is_hex, F.lit(THRESHOLDS["hex"])).otherwise(F.lit(THRESHOLDS["base64"]))
        kind = F.when(is_hex, F.lit(3)).otherwise(F.lit(4))
        high = F.element_at(F.transform(F.array(F.split(c["hit"], "")), lambda chars: windows(chars, threshold)), 1)
        return F.transform(
            high,
            lambda w: F.struct(
                (c["start"] + w["start"]).alias("start"), kind.alias("kind"), (c["start"] + w["end"]).alias("end")
            ),
        )

    allowed = "^(?:" + "|".join(f"(?:{p})" for p in ALLOWED) + ")$"

    def stands(c: Column) -> Column:
        row = F.rlike(c["hit"], F.lit("^" + ROW_START)) & ~F.rlike(c["hit"], F.lit(ROW_BREAK))
        return ~F.rlike(c["hit"], F.lit(allowed)) & ~row

    candidates = F.filter(places(text, RUN), stands)
    spans = F.flatten(F.transform(candidates, judged)).cast(SPANS)
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))


def scan(docs: DataFrame, column: str = "spans") -> DataFrame:
    """The rows with their spans: sorted by start, then kind (a place in :data:`KINDS`)."""
    whole, base = fresh(docs, "_text"), fresh(docs, "_base")
    named = docs.withColumn(whole, F.coalesce(F.col("text").cast("string"), F.lit("")))
    based = named.withColumn(base, base_spans(F.col(whole)))
    spans = F.array_sort(F.concat(F.col(base), entropy_spans(F.col(whole), F.col(base))))
    return based.withColumn(column, spans).drop(whole, base)


def written(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(parts, ",")


def digest(scanned: DataFrame) -> DataFrame:
    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return scanned.select(
        "doc_id",
        *[count(k) for k in range(len(KINDS))],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, marker: str = "[SECRET]") -> DataFrame:
    """The rows with each run of overlapping spans in ``text`` replaced by a marker."""

    def step(state: Column, s: Column) -> Column:
        before = F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] < state["at"], state["out"])
            .otherwise(F.concat(state["out"], before, F.lit(marker)))
            .alias("out"),
        )

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, F.char_length("text")))

    spans = fresh(docs, "_spans")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    found = F.aggregate(spans, zero, step, finish)
    text = F.when(F.size(spans) > 0, found).otherwise(F.col("text"))
    return scan(docs, spans).withColumn("text", text).select(*docs.columns)
