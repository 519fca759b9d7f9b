"""Secret scans with DataFrame functions only: three base patterns and sliding-window entropy.

Each maximal run of one character class (hex, upper-case alphanumeric, base64-like) of at least a
window's length is a candidate; the class sets the entropy that a window must reach. The narrower
class is tried first, so a name, path or separator glued to a key does not hide it. The window
slides one character at a time: each step takes one character out of the counts and one in, and
corrects the sum of c * log2(c) by what these two counts contribute, so a step costs the same
whatever the window. Candidates that the allow-list matches are left out. A hex or upper-case run in
which any window reaches the entropy is reported as a whole, so no end of a key is left over; of a
base64-like run the span is from the first window that reaches it to the last.

Positions come from cutting the text at the matches: a match starts where the texts between and
the matches before it end. They are code points, the end exclusive. Running sums over the matches
go in blocks of blocks, and redaction cuts its pieces from blocks of the text, so the time for a
text with many secrets grows with its length.

Defined cases: a null text is an empty one, without spans; equal spans of different kinds are all
reported; redaction joins overlapping spans; a null text stays null in redaction.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.llm.arrow import col, put

# The base patterns. Runs shorter than their minimum length cannot match, so it is
# part of the pattern where a shorter match has no other effect.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LENGTH = 8

SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
WINDOW = 24

@dataclass(frozen=True)
class CharacterClass:
    """A kind of candidate, the pattern it matches whole, and bits per character to be a secret."""

    kind: str
    pattern: str
    bits: float


# Uniform strings have about 3.55, 4.05 and 4.25 bits in a window; words 3.4 at most.
CLASSES = (
    CharacterClass("entropy_hex", r"[0-9A-Fa-f]+", 3.1),
    CharacterClass("entropy_upper", r"[A-Z0-9]+", 3.7),
    CharacterClass("entropy_base64", r"[A-Za-z0-9+/_=-]+", 3.9),
)
KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))

# What is no secret however it looks: words (also joined ones) of at most 20 letters, and runs of
# the alphabet and placeholders, unless enough for a key of its own stands beside them.
ALLOWED = (
    r"^(?:[A-Z]?[a-z]{1,20}|[A-Z]{1,20})(?:[-_/+=]+(?:[A-Z]?[a-z]{1,20}|[A-Z]{1,20}))*[-_/+=]*$",
    r"(?i)^.{0,23}(?:abcdefghijkl|0123456789).{0,23}$",
    r"(?i)^.{0,23}(?:example|placeholder|changeme|your[-_]?(?:key|token|secret)).{0,23}$",
    r"(?i)example(?:key)?$",
)

BLOCK = 64
LEVELS = 3
TEXT_BLOCK = 4096


def run_of(kind: CharacterClass, window: int = WINDOW) -> str:
    """The pattern of a class's runs that have room for a window."""
    return f"{kind.pattern.removesuffix('+')}{{{window},}}"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(numbers: Column, join: Callable[[Column, Column], Column], levels: int = LEVELS) -> Column:
    """Of each number, the sum (or maximum, by ``join``) of those before it, 0 for the first.

    An array that grows by one at a time is copied each time; so it is only done for blocks of
    ``BLOCK``, and for what the blocks come to in the same way.
    """

    def short(xs: Column) -> Column:
        start = F.struct(
            F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out")
        )
        return F.aggregate(
            xs,
            start,
            lambda acc, x: F.struct(
                join(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
            ),
            lambda acc: acc["out"],
        )

    if not levels:
        return short(numbers)

    def long(xs: Column) -> Column:
        n = F.ceil(F.size(xs) / F.lit(BLOCK)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.slice(xs, b * BLOCK + 1, BLOCK))

        def joined(own: Column) -> Column:
            zero = F.lit(0).cast("bigint")
            whole = F.transform(own, lambda block: F.aggregate(block, zero, join))
            spread = lambda block, more: F.transform(short(block), lambda v: join(v, more))
            return F.flatten(F.zip_with(own, _before(whole, join, levels - 1), spread))

        return _let(blocks, joined)

    return _let(numbers, lambda xs: F.when(F.size(xs) <= BLOCK, short(xs)).otherwise(long(xs)))


def _places(text: Column, pattern: str) -> Column:
    """Start and text of each match, as array<struct<start, body>>."""
    bodies = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,body:string>>")

    def placed(cut: Column) -> Column:
        lengths = F.transform(
            cut["bodies"],
            lambda body, i: (F.length(body) + F.length(F.element_at(cut["gaps"], i + 1))).cast("bigint"),
        )

        def started(before: Column) -> Column:
            return F.transform(
                cut["bodies"],
                lambda body, i: F.struct(
                    (F.element_at(before, i + 1) + F.length(F.element_at(cut["gaps"], i + 1)))
                    .cast("int")
                    .alias("start"),
                    body.alias("body"),
                ),
            )

        return _let(_before(lengths, lambda x, y: x + y), started)

    cut = F.struct(bodies.alias("bodies"), gaps.alias("gaps"))
    return F.when(text.rlike(pattern), _let(cut, placed)).otherwise(none)


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        F.lit(KINDS.index(kind)).alias("rank"),
        end.cast("int").alias("end"),
        F.lit(kind).alias("kind"),
    )


def _whole(places: Column, kind: str) -> Column:
    return F.transform(places, lambda p: _span(kind, p["start"], p["start"] + F.length(p["body"])))


def _windows(body: Column, bits: Column, window: int) -> Column:
    """Ends of the first and last window of enough entropy, 0 if there is none."""
    chars = F.split(body, "")
    contribution = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)])
    # Out with the character that leaves, in with the next; "end" marks a full window.
    steps = F.flatten(
        F.transform(
            chars,
            lambda ch, i: F.array(
                F.struct(
                    F.when(i >= window, F.element_at(chars, F.greatest(i - window + 1, F.lit(1)))).alias("ch"),
                    F.lit(-1).alias("by"),
                    F.lit(0).alias("end"),
                ),
                F.struct(
                    ch.alias("ch"),
                    F.lit(1).alias("by"),
                    F.when(i + 1 >= window, i + 1).otherwise(0).alias("end"),
                ),
            ),
        )
    )
    steps = F.transform(
        F.filter(steps, lambda s: s["ch"].isNotNull()),
        lambda s: F.struct(
            F.instr(F.lit(SYMBOLS), s["ch"]).alias("k"), s["by"].alias("by"), s["end"].alias("end")
        ),
    )
    start = F.struct(
        F.array_repeat(F.lit(0), len(SYMBOLS)).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0).alias("first"),
        F.lit(0).alias("last"),
    )

    def step(acc: Column, s: Column) -> Column:
        count = F.element_at(acc["counts"], s["k"])
        total = (
            acc["sum"]
            + F.element_at(contribution, count + s["by"] + 1)
            - F.element_at(contribution, count + 1)
        )
        found = (s["end"] > 0) & (F.lit(math.log2(window)) - total / window >= bits)
        return F.struct(
            F.transform(
                acc["counts"], lambda c, i: F.when(i + 1 == s["k"], c + s["by"]).otherwise(c)
            ).alias("counts"),
            total.alias("sum"),
            F.when(found & (acc["first"] == 0), s["end"]).otherwise(acc["first"]).alias("first"),
            F.when(found, s["end"]).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(
        steps,
        start,
        step,
        lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")),
    )


def scan(
    df: DataFrame,
    text: str = "text",
    allowed: tuple[str, ...] = ALLOWED,
    classes: tuple[CharacterClass, ...] = CLASSES,
    window: int = WINDOW,
) -> DataFrame:
    """``df`` with ``secret_spans``: array<struct<start, rank, end, kind>>, sorted."""
    body = F.coalesce(col(text), F.lit(""))
    value = F.regexp_extract_all(body, F.lit(ASSIGN), F.lit(2))
    assigned = F.when(
        body.rlike(ASSIGN),
        F.filter(
            F.zip_with(
                _places(body, ASSIGN),
                value,
                lambda p, v: F.struct(
                    p["start"].alias("start"), p["body"].alias("body"), F.length(v).alias("n")
                ),
            ),
            lambda p: p["n"] >= ASSIGN_LENGTH,
        ),
    ).otherwise(F.array().cast("array<struct<start:int,body:string,n:int>>"))
    def suspicious(place: Column) -> Column:
        clear = F.lit(True)
        for pattern in allowed:
            clear = clear & ~place["body"].rlike(pattern)
        return clear

    def of_class(i: int) -> Column:
        """Maximal runs of a class that are not wholly of a narrower one."""
        own, whole = classes[i], i + 1 < len(classes)
        places = F.filter(_places(body, run_of(own, window)), suspicious)
        narrower = "|".join(c.pattern for c in classes[:i])
        if narrower:
            places = F.filter(places, lambda p: ~p["body"].rlike(f"^(?:{narrower})$"))
        rated = F.transform(
            places,
            lambda p: F.struct(
                p["start"].alias("start"),
                F.length(p["body"]).alias("n"),
                _windows(p["body"], F.lit(own.bits), window).alias("w"),
            ),
        )
        return F.transform(
            F.filter(rated, lambda r: r["w"]["first"] > 0),
            lambda r: _span(
                own.kind,
                r["start"] + (F.lit(0) if whole else r["w"]["first"] - window),
                r["start"] + (r["n"] if whole else r["w"]["last"]),
            ),
        )

    entropy = F.concat(*[of_class(i) for i in range(len(classes))])
    spans = F.concat(
        _whole(assigned, "assign"), _whole(_places(body, ACCESS), "access"), _whole(_places(body, HEX), "hex"), entropy
    )
    return put(df, secret_spans=F.array_sort(spans))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """``df`` with every secret span of the text replaced by ``mark``; columns stay as they are.

    Spans that overlap are one. What stands between them is cut from blocks of the text, as the
    place of a code point in a text is found by counting from its start.
    """
    names = df.columns
    plain = df.toDF(*[f"d{i}" for i in range(len(names))])
    body = f"d{names.index(text)}"
    found = scan(plain, body, **options)
    source = F.col(body)
    blocks = F.regexp_extract_all(source, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))

    def cut(blocks: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / TEXT_BLOCK).cast("int")
        last = F.floor((end - 1) / TEXT_BLOCK).cast("int")
        near = F.array_join(F.slice(blocks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
        return F.when(end > start, F.substring(near, start - first * TEXT_BLOCK + 1, end - start)).otherwise("")

    def pieces(own: Column) -> Column:
        spans, covered = F.col("secret_spans"), own["covered"]
        kept = F.transform(
            spans,
            lambda s, i: F.when(
                s["start"] >= F.element_at(covered, i + 1),
                F.concat(
                    cut(own["blocks"], F.element_at(covered, i + 1).cast("int"), s["start"]), F.lit(mark)
                ),
            ).otherwise(""),
        )
        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        rest = cut(own["blocks"], end, F.length(source))
        return F.concat(F.array_join(kept, ""), rest)

    ends = F.transform("secret_spans", lambda s: s["end"].cast("bigint"))
    covered = _before(ends, lambda x, y: F.greatest(x, y))
    clean = _let(F.struct(blocks.alias("blocks"), covered.alias("covered")), pieces)
    clean = found.withColumn(body, F.when(F.size("secret_spans") > 0, clean).otherwise(source))
    return clean.select(*plain.columns).toDF(*names)
