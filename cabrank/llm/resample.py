"""Quality classifier by importance resampling: hashed n-gram models and Gumbel top-k.

Words and runs of punctuation, lower-cased, give unigrams and bigrams, hashed into ``BUCKETS``.
The raw model counts them in all documents, the target model in documents labelled good (quality 1
and not toxic). A bucket's log ratio compares the target count with what the raw model expects,
both with ``PRIOR`` occurrences added, so buckets seen too rarely to tell are near 0. A document's
importance is the sum of the log ratios of its n-grams over the square root of their number:
sums of chance differences then spread alike in short and long texts.

Sampling without replacement in proportion to exp(importance / NOISE) is taking the k largest
importances after adding independent Gumbel noise times ``NOISE``. At this low temperature the draw
is nearly a cut: only documents within a few ``NOISE`` of it are drawn by chance, which keeps clean
documents well above it for certain. The noise comes from a hash of the doc_id and a seed, so it
is the same on every run. k is the number of documents whose importance reaches what all but
``MISSED`` of the labelled good ones reach. Documents outside the sample are rejected.

A few toxic words among hundreds of plain ones hardly move that sum, so a second model looks for
them: of the labelled documents, those with toxic 1 against all, counted once a document. Buckets
whose toxic count exceeds what is expected by more than chance (``EVIDENCE``, a log-likelihood
ratio) have the log ratio with a prior of ``TOXIC_PRIOR``, all others 0. A document's toxicity is the
largest sum of any ``SPAN`` words in a row. A document above what all but ``SUSPECTED`` of the labelled
good ones stay within has weight 0: its key is below all others, whatever its importance.

The k-th largest key is found by counting keys in bins and splitting the bin it lies in again; no
task or driver sees the keys of all documents.

Only labels are sampled: beyond ``LABELLED`` rows, those with the smallest hashes of doc_id, about
that many. Every document is counted and scored.

Defined cases: a null or blank text has no n-grams and importance 0; rows with a null quality are
no labels, a null toxic is 0; a document with several labels is good if all are; without any good
label every importance is 0 and all documents are kept; without a toxic label every toxicity is 0
and none is rejected for it; ties at the k-th key are all kept; a null
doc_id has the noise of an empty id.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.llm.arrow import LOWER, append, as_bytes, col, put, slices, written
from cabrank.llm.select import kth_largest

BUCKETS = 1 << 18
PRIOR = 20.0
LABELLED = 1_000_000
MISSED = 0.002
TOXIC_PRIOR = 1.0
EVIDENCE = 10.0
SPAN = 200
SUSPECTED = 0.005
REJECTED = -(1 << 60)
NOISE = 0.05
SEED = 17
KEY_SCALE = 1_000_000

_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff\s]+")
_ONE, _TWO, _NEXT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def ngrams(text: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each unigram of a text, then of each bigram."""
    tokens = _TOKEN.findall(text.translate(LOWER))
    code = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    pairs = (code[:-1] * _TWO) ^ ((code[1:] + np.uint64(1)) * _NEXT)
    mixed = np.concatenate([code * _ONE, pairs * _ONE])
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def good_labels(labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """One row for each labelled doc_id, at most about ``bound``, with ``good`` and ``toxic``."""
    usable = labels.where("quality is not null and doc_id is not null")
    one = usable.groupBy("doc_id").agg(
        ((F.min("quality") == 1) & (F.max(F.coalesce("toxic", F.lit(0))) == 0)).alias("good"),
        (F.max(F.coalesce("toxic", F.lit(0))) != 0).alias("toxic"),
    )
    n = one.count()
    if n > bound:
        share = F.lit(bound / n)
        one = one.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    return one


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    raw, target, labelled, toxic = (np.zeros(buckets, np.int64) for _ in range(4))
    n_labelled = n_toxic = 0
    for batch in batches:
        for part in slices(batch, 0):
            rows = zip(as_bytes(part.column(0)), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)
            for text, good, is_toxic in rows:
                grams = ngrams(text, buckets)
                np.add.at(raw, grams, 1)
                if good:
                    np.add.at(target, grams, 1)
                if is_toxic is not None:
                    once = np.unique(grams)
                    labelled[once] += 1
                    n_labelled += 1
                    if is_toxic:
                        toxic[once] += 1
                        n_toxic += 1
    used = np.flatnonzero(raw)
    # Bucket -1 has the numbers of labelled and toxic documents.
    sums = [np.append(x[used], n) for x, n in ((raw, 0), (target, 0), (labelled, n_labelled), (toxic, n_toxic))]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1).astype(np.int32)), *map(pa.array, sums)],
        names=["bucket", *_COUNTS],
    )


_COUNTS = ("raw", "target", "labelled", "toxic")


def log_ratios(
    labelled: DataFrame, text: str, buckets: int = BUCKETS, prior: float = PRIOR
) -> tuple[np.ndarray, np.ndarray]:
    """log (target / raw) and log (toxic / labelled) of each bucket.

    ``labelled`` has nullable ``good`` and ``toxic`` beside the text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _count(batches, buckets)

    rows = labelled.select(col(text).alias("text"), F.col("good"), F.col("toxic")).mapInArrow(
        count, "bucket int, raw long, target long, labelled long, toxic long"
    )
    sums = rows.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    table = sums.toArrow()  # one row for each bucket at most
    at = table["bucket"].to_numpy()
    # Bucket -1 is the last place.
    counts = {c: np.zeros(buckets + 1) for c in _COUNTS}
    for c in _COUNTS:
        counts[c][at] = table[c].to_numpy()
    raw, target = counts["raw"][:-1], counts["target"][:-1]
    wanted = np.zeros(buckets, np.float32)
    if target.sum():
        expected = raw * (target.sum() / raw.sum())
        wanted = np.log((target + prior) / (expected + prior)).astype(np.float32)
    return wanted, toxic_ratios(counts["labelled"], counts["toxic"])


def toxic_ratios(labelled: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket that is toxic beyond chance, else 0; the last count is of documents."""
    if not toxic[-1]:
        return np.zeros(len(toxic) - 1, np.float32)
    expected = labelled[:-1] * (toxic[-1] / labelled[-1])
    seen = toxic[:-1]
    more = seen > expected
    ratio = np.zeros(len(seen))
    ratio[more] = np.log((seen[more] + TOXIC_PRIOR) / (expected[more] + TOXIC_PRIOR))
    evidence = np.zeros(len(seen))
    evidence[more] = 2 * (seen[more] * np.log(seen[more] / expected[more]) - seen[more] + expected[more])
    return np.where(evidence > EVIDENCE, ratio, 0).astype(np.float32)


def _toxicity(grams: np.ndarray, table: np.ndarray, span: int = SPAN) -> float:
    """The largest sum of any ``span`` words in a row, each with the bigram it begins."""
    hits = table[grams]
    if not hits.any():
        return 0.0
    words = (len(grams) + 1) // 2
    each = hits[:words].astype(np.float64)
    each[: words - 1] += hits[words:]
    sums = np.concatenate([[0.0], np.cumsum(each)])
    return float((sums[span:] - sums[:-span]).max()) if words > span else float(sums[-1])


def _scores(texts: list[bytes], table: np.ndarray, toxic: np.ndarray) -> list[pa.Array]:
    importance, toxicity = np.zeros(len(texts)), np.zeros(len(texts))
    for i, text in enumerate(texts):
        grams = ngrams(text, len(table))
        if len(grams):
            importance[i] = table[grams].sum(dtype=np.float64) / np.sqrt(len(grams))
            toxicity[i] = _toxicity(grams, toxic)
    return [pa.array(importance), pa.array(toxicity)]


def gumbel(key: Column, seed: int) -> Column:
    """Standard Gumbel noise from a hash of the key."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    bits = F.shiftrightunsigned(F.xxhash64(text, F.lit(seed)), 12)
    return -F.ln(-F.ln((bits + 0.5) / F.lit(float(1 << 52))))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    missed: float = MISSED,
    suspected: float = SUSPECTED,
    noise: float = NOISE,
    seed: int = SEED,
    keep: list[str] | None = None,
    buckets: int = BUCKETS,
    labelled_rows: int = LABELLED,
) -> DataFrame:
    """``docs`` with importance, toxicity, good (null if unlabelled), gumbel_key and kept."""
    spark = docs.sparkSession
    # At most about ``labelled_rows`` rows of an id and two flags: a bounded broadcast.
    good = written(good_labels(labels, labelled_rows), "labels")
    plain = docs.select(*[c for c in docs.columns if c.lower() not in _ADDED])
    labelled = plain.join(F.broadcast(good), "doc_id", "left").select(*plain.columns, "good", "toxic")
    shared = spark.sparkContext.broadcast(log_ratios(labelled, text, buckets))

    def compute(texts: pa.Array) -> list[pa.Array]:
        return _scores(as_bytes(texts), *shared.value)

    added = T.StructType([T.StructField(c, T.DoubleType()) for c in ("importance", "toxicity")])
    kept = None if keep is None else [*keep, "good"]
    scored = append(labelled.drop("toxic"), [text], compute, added, kept)
    score = F.col("importance") + noise * gumbel(F.col("doc_id"), seed)
    scored = written(put(scored, gumbel_key=F.round(score * KEY_SCALE).cast("long")), "resample")
    reach, within = (
        scored.where("good")
        .agg(
            F.percentile_approx("importance", missed, 10_000),
            F.percentile_approx("toxicity", 1 - suspected, 10_000),
        )
        .head()
    )
    if reach is None:
        return put(scored, kept=F.lit(True))
    clean = F.col("toxicity") <= within
    k = scored.where(clean & (F.col("importance") >= reach)).count()
    least = kth_largest(scored.where(clean), "gumbel_key", k)
    key = F.when(clean, F.col("gumbel_key")).otherwise(F.lit(REJECTED))
    return put(scored, gumbel_key=key, kept=clean & (F.col("gumbel_key") >= least))


_ADDED = {"importance", "toxicity", "gumbel_key", "good", "toxic", "kept"}


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier keeps, with their own columns."""
    names = docs.columns
    ids = names.index("doc_id")
    inner = ["doc_id" if i == ids else f"d{i}" for i in range(len(names))]
    plain = docs.toDF(*inner)
    out = classify(plain, labels, text=f"d{names.index('text')}", **options)
    return out.where("kept").select(*inner).toDF(*names)
