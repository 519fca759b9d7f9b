"""Quality rules by distribution divergence, with DataFrame functions only.

A document's histogram of character classes and its histogram of common words are compared with
the mean histograms of its language by Jensen-Shannon distance (base 2, so 0 to 1). The common
words of a language are a fixed list of function words; "none of them" is a bin as well, so word
salad without function words lies far from every reference. References are means over all
documents that pass the base rules and the length guard, one vote per document. Documents whose
language has no list share the reference "other", with the words of all lists: five references
at most, whatever the data.

The text is read once: the counts go to a written table, from which both the references and the
distances come.

Guards: a document of fewer than ``MIN_WORDS`` words has histograms too coarse to judge and is
never rejected by divergence; one without a reference (its language has no document to learn from)
neither.

Defined cases: a null text has no words; a null or unknown language is "other"; repeated rows are
judged one by one; an empty table gives an empty result; added columns replace equal names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.llm.arrow import col, put, without, written

BLANKS = r"[\x20\x09-\x0D]+"
REPEAT_WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
MIN_WORDS = 100
# Distances beyond these reject; documents labelled good stay below them (see the README).
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.30

# Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it with as on by at this be are from or".split(),
    "fr": "le la les de des du et en un une que qui dans par pour sur est pas avec au".split(),
    "de": "der die das und in zu den von mit ist des im für auf nicht ein eine als auch es".split(),
    "es": "el la de que y en a los se del las por un para con no una su al es".split(),
}
OTHER = "other"

# Character classes in the order they are taken out of the text; the rest is the last bin.
CHAR_CLASSES = (
    ("lower", r"[a-z]+"),
    ("upper", r"[A-Z]+"),
    ("blank", BLANKS),
    ("digit", r"[0-9]+"),
    ("point", r"""[.,;:!?'"()-]+"""),
    ("symbol", r"[#*$%&|<>]+"),
    ("letter", r"\p{L}+"),
)


def _word_lists() -> dict[str, list[str]]:
    every = sorted({w for words in COMMON_WORDS.values() for w in words})
    return COMMON_WORDS | {OTHER: every}


def counts(df: DataFrame, text: str, lang: str | None) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ref_lang and the
    counts ``chars`` and ``common`` (array<int>, the last bin holding what is in no other)."""
    body = F.coalesce(col(text), F.lit(""))
    known = F.lower(col(lang)) if lang else F.lit(OTHER)
    rest = [body]
    for i, (_, pattern) in enumerate(CHAR_CLASSES):
        df = put(df, **{f"_r{i}": F.regexp_replace(rest[-1], pattern, "")})
        rest.append(F.col(f"_r{i}"))
    left = [F.length(r) for r in rest]
    taken = {name: left[i] - left[i + 1] for i, (name, _) in enumerate(CHAR_CLASSES)}
    df = put(
        df,
        word_chars=(left[0] - taken["blank"]).cast("long"),
        n_symbols=taken["symbol"].cast("long"),
        chars=F.array(*taken.values(), left[-1]),
    ).drop(*[f"_r{i}" for i in range(len(CHAR_CLASSES))])
    df = put(
        df,
        _words=F.filter(F.split(body, BLANKS), lambda w: w != ""),
        _lines=F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        ref_lang=F.when(known.isin(*COMMON_WORDS), known).otherwise(F.lit(OTHER)),
    )
    every = _word_lists()[OTHER]
    words = F.col("_words")
    df = put(
        df,
        n_words=F.size("_words").cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # Common words between blanks, so that counting one is counting its replacements.
        _common=F.concat(
            F.lit(" "),
            F.array_join(F.filter(F.transform(words, F.lower), lambda w: w.isin(*every)), "  "),
            F.lit(" "),
        ),
        _hashes=F.when(
            F.size("_words") >= REPEAT_WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("_words") - (REPEAT_WINDOW - 1)),
                lambda i: F.xxhash64(F.slice(words, i, REPEAT_WINDOW)),
            ),
        ),
    ).drop("_lines", "_words")
    return _repeats(put(df, common=_common_counts()).drop("_common"))


def _common_counts() -> Column:
    body = F.col("_common")
    chosen = F
    for lang, words in _word_lists().items():
        bins = [
            ((F.length(body) - F.length(F.replace(body, F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)).cast("int")
            for w in words
        ]
        chosen = chosen.when(F.col("ref_lang") == lang, F.array(*bins))
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    return F.concat(chosen, F.array((F.col("n_words") - total(chosen)).cast("int")))


def _repeats(df: DataFrame) -> DataFrame:
    """n_repeat_words of ``_hashes``: sort equal windows together, then add up what they cover."""
    repeated = F.size("_hashes") > F.size(F.array_distinct("_hashes"))
    pairs = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = put(df, _sorted=F.when(repeated, F.array_sort(pairs))).drop("_hashes")
    near = F.col("_sorted")
    own = F.filter(
        near,
        lambda x, j: F.coalesce(F.get(near, j - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(near, j + 1)["h"] == x["h"], F.lit(False)),
    )
    places = F.array_sort(F.transform(own, lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct(
            (acc["n"] + i + REPEAT_WINDOW - F.greatest(acc["end"], i)).alias("n"),
            (i + REPEAT_WINDOW).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    return put(df, n_repeat_words=F.coalesce(covered, F.lit(0)).cast("long")).drop("_sorted")


def _shares(bins: Column) -> Column:
    total = F.aggregate(bins, F.lit(0), lambda x, y: x + y)
    return F.transform(bins, lambda x: x / F.greatest(total, F.lit(1)))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence in bits; empty histograms have distance 0."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    total = F.aggregate(terms, F.lit(0.0), lambda x, y: x + y) / 2
    return F.sqrt(F.when(total < 0, 0.0).otherwise(total))


def references(counted: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Mean shares of each bin by ref_lang, at most one row for each word list."""
    usable = counted.where(~F.col("base_failed") & (F.col("n_words") >= min_words))
    shares = usable.select("ref_lang", _shares(F.col("chars")).alias("c"), _shares(F.col("common")).alias("w"))
    n_chars = len(CHAR_CLASSES) + 1
    n_words = max(map(len, _word_lists().values())) + 1
    means = shares.groupBy("ref_lang").agg(
        F.array(*[F.avg(F.get("c", F.lit(i))) for i in range(n_chars)]).alias("ref_chars"),
        F.filter(
            F.array(*[F.avg(F.get("w", F.lit(i))) for i in range(n_words)]), lambda x: x.isNotNull()
        ).alias("ref_common"),
    )
    return means


def judge(
    df: DataFrame,
    text: str = "text",
    lang: str | None = "lang",
    min_words: int = MIN_WORDS,
    max_char: float = MAX_CHAR_DISTANCE,
    max_word: float = MAX_WORD_DISTANCE,
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` (or ``keep`` of it) with the counts, base_failed, both distances and kept."""
    at = {name: f"d{i}" for i, name in enumerate(df.columns)}
    names = [c for c in without(df, ADDED) if keep is None or c in keep]
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    bins = ["ref_lang", "chars", "common"]
    plain = df.toDF(*at.values())
    counted = put(counts(plain, at[text], lang and at[lang]), base_failed=failed)
    own = [at[c] for c in names]
    counted = written(counted.select(*own, *bins, *ADDED[:6]), "divergence")
    # Five rows at most: the broadcast does not grow with the data.
    joined = counted.join(F.broadcast(references(counted, min_words)), "ref_lang", "left")
    joined = put(
        joined,
        char_distance=js_distance(_shares(F.col("chars")), F.col("ref_chars")),
        word_distance=js_distance(_shares(F.col("common")), F.col("ref_common")),
    )
    far = (F.col("char_distance") > max_char) | (F.col("word_distance") > max_word)
    judged = (F.col("n_words") >= min_words) & F.coalesce(far, F.lit(False))
    out = put(joined, kept=~F.col("base_failed") & ~judged)
    return out.select(*own, *ADDED).toDF(*names, *ADDED)


ADDED = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "char_distance",
    "word_distance",
    "kept",
]
