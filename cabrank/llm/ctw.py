"""LM scoring by context-tree weighting over bytes, beside an add-one word model.

A byte is eight binary decisions, each with a context tree of its own over the preceding bytes, of
depths 0 to ``DEPTH``. A node of a tree has a Krichevsky-Trofimov estimate from its counts of zeros
and ones in the training texts; what the node predicts is its own estimate mixed with what its
child, one byte deeper, predicts, by the weight that the training texts gave either. Texts are
lower-cased (A-Z) and end with byte 255, which no UTF-8 has; ``DEPTH`` of them stand before a text
as its first context. So probabilities of all texts sum to 1.

What is counted are grams: a byte with the ``DEPTH`` bytes before it. Grams that share the three
bytes before the last are a subtree of contexts, and go to one task together: at most
256 ** (DEPTH - 2) of them, however long the texts. Such a task goes from the deepest contexts up:
counts by depth, estimates, and weighted probabilities. The sums of these by the contexts of two
bytes (65,536 with 255 decisions each, at most) come to the driver, which finishes the upper
levels; with them the tasks go down again, and give each gram the logarithm of its byte's mixed
probability. The grams of texts that are held out take part with a count of 0.

Neither the grams nor the words of a corpus have a bound. So only the ``HEAVY_GRAMS`` and
``HEAVY_WORDS`` most frequent (words of at most ``HEAVY_BYTES`` bytes) are broadcast; what else a
document has is joined with its probability or count in a shuffle.

Defined cases: a null text is an empty one (its end is scored); a null doc_id counts as the empty
id; rows are scored one by one, repeated ones alike; without training rows every count is 0.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.llm.arrow import LOWER, append, as_bytes, col, put, slices, written
from cabrank.llm.select import kth_largest

DEPTH = 5
HEAVY_GRAMS = 3_000_000
HEAVY_WORDS = 300_000
HEAVY_BYTES = 64
FLUSH_WORDS = 500_000
FLUSH_GRAMS = 3_000_000
END = b""
STOP = 255
# Contexts of so many bytes and less are finished on the driver.
UPPER = 2


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 7 == 2


def grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with the ``depth`` bytes before them, as one number; where texts start.

    Text i is from starts[i] to before its successor's start; its last gram is that of its end.
    """
    gap = bytes([STOP] * depth)
    data = np.frombuffer(gap + gap.join(texts) + bytes([STOP]), np.uint8)
    n = len(data) - depth
    code = np.zeros(n, np.int64)
    for i in range(depth + 1):
        code <<= 8
        code |= data[i : i + n]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths + depth)[:-1]]).astype(np.int64)
    # Between two texts only the first stop byte is predicted: it is the end of the one before.
    predicted = np.ones(n, bool)
    for i in range(1, depth):
        predicted[starts[1:] - i] = False
    return code[predicted], starts - np.arange(len(texts)) * (depth - 1)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _key_bytes(code: np.ndarray) -> pa.Array:
    """Grams as eight bytes each."""
    fixed = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(8), len(code), [None, pa.py_buffer(np.ascontiguousarray(code.astype(">i8")))]
    )
    return fixed.cast(pa.binary())


def _word_rows(words: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([False] * len(words), pa.bool_()), pa.array(words, pa.binary()), pa.array(words.values(), pa.int64())],
        names=["is_gram", "key", "n"],
    )


def _gram_rows(code: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(code), 200_000):
        part = code[at : at + 200_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(part), bool)), _key_bytes(part), pa.array(n[at : at + 200_000], pa.int64())],
            names=["is_gram", "key", "n"],
        )


def _count(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    words: Counter[bytes] = Counter()
    known, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for part in slices(batch, 0):
            texts = [text.translate(LOWER) for text in as_bytes(part.column(0))]
            for held in (False, True):
                own = [t for t, h in zip(texts, part.column(1).to_pylist(), strict=True) if h == held]
                if not own:
                    continue
                if not held:
                    for text in own:
                        words.update(text.split())
                    words[END] += len(own)
                code, n = np.unique(grams(own, depth)[0], return_counts=True)
                n = n * (not held)
                known, counts = _summed(np.concatenate([known, code]), np.concatenate([counts, n]))
            if len(words) > FLUSH_WORDS:
                yield _word_rows(words)
                words = Counter()
            if len(known) > FLUSH_GRAMS:
                yield from _gram_rows(known, counts)
                known, counts = known[:0], counts[:0]
    yield _word_rows(words)
    yield from _gram_rows(known, counts)


def training_counts(docs: DataFrame, text: str = "text", depth: int = DEPTH) -> DataFrame:
    """How often each word and gram stands in the rows that are not held out: (is_gram, key, n), written.

    Grams of rows that are held out are there too, with a count of 0 where no other row has them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _count(batches, depth)

    rows = docs.select(col(text).alias("text"), F.col("held_out")).mapInArrow(
        count, "is_gram boolean, key binary, n long"
    )
    return written(rows.groupBy("is_gram", "key").agg(F.sum("n").alias("n")), "counts")


_SMALL = 4096
_HALVES = np.array([math.lgamma(i + 0.5) for i in range(_SMALL)])
_WHOLES = np.array([math.lgamma(i + 1) for i in range(_SMALL)])


def _stirling(x: np.ndarray) -> np.ndarray:
    """lgamma of large numbers."""
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def _log_gamma(n: np.ndarray, table: np.ndarray, shift: float) -> np.ndarray:
    out = table[np.minimum(n, _SMALL - 1)]
    large = n >= _SMALL
    if large.any():
        out[large] = _stirling(n[large] + shift)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these (whole) counts."""
    halves = _log_gamma(zeros, _HALVES, 0.5) + _log_gamma(ones, _HALVES, 0.5)
    return halves - 2 * _HALVES[0] - _log_gamma(zeros + ones, _WHOLES, 1.0)


class Level:
    """The decisions of all contexts of one depth: ``keys`` are context << 8 | decision, ascending.

    ``own`` is the log of the estimates' probability of the training texts, ``below`` that of the
    children's weighted ones, ``share`` the weight of the own estimate in predictions.
    """

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = log_kt(zeros, ones)
        if below is None:  # the deepest
            self.weighted, self.share = own, np.ones(len(keys))
        else:
            self.weighted = np.logaddexp(own, below) - math.log(2)
            self.share = 1 / (1 + np.exp(np.clip(below - own, -700, 700)))
        self.estimate = (ones + 0.5) / (zeros + ones + 1)

    @classmethod
    def of_grams(cls, code: np.ndarray, n: np.ndarray, deeper: Level | None) -> Level:
        keys = np.concatenate([(code >> 8 << 8) | _decision(code, i) for i in range(8)])
        ones = np.concatenate([np.where(_bit(code, i), n, 0) for i in range(8)])
        zeros = np.tile(n, 8) - ones
        keys, at = np.unique(keys, return_inverse=True)
        total = [np.bincount(at, c, len(keys)).astype(np.int64) for c in (zeros, ones)]
        return cls(keys, *total, None if deeper is None else deeper.of_parents(keys, deeper.weighted))

    def of_parents(self, parents: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sums over the children of each of the parents' keys, of a context one byte shorter."""
        return np.bincount(np.searchsorted(parents, self.parent()), values, len(parents))

    def parent(self) -> np.ndarray:
        """The key of the parent: the context without its oldest byte."""
        depth = self.depth
        return ((self.keys >> 8) & ((1 << 8 * (depth - 1)) - 1)) << 8 | (self.keys & 255)

    depth = 0

    def at(self, depth: int) -> Level:
        self.depth = depth
        return self

    def predict(self, above: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """keys, probability of a one mixed down to this depth, and the weight left for deeper ones."""
        if above is None:
            before, left = 0.0, 1.0
        else:
            at = np.searchsorted(above[0], self.parent())
            before, left = above[1][at], above[2][at]
        return self.keys, before + left * self.share * self.estimate, left * (1 - self.share)


def _decision(code: np.ndarray, i: int) -> np.ndarray:
    """The number of a byte's decision i, from 1: the bits before it behind a one."""
    return 1 << i | (code & 255) >> 8 - i


def _bit(code: np.ndarray, i: int) -> np.ndarray:
    return code >> 7 - i & 1


def _levels(code: np.ndarray, n: np.ndarray, depth: int) -> dict[int, Level]:
    """All levels from ``depth`` up to the one below ``UPPER``."""
    levels: dict[int, Level] = {}
    for d in range(depth, UPPER, -1):
        code, n = _summed(code & ((1 << 8 * (d + 1)) - 1), n)
        levels[d] = Level.of_grams(code, n, levels.get(d + 1)).at(d)
    return levels


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, counts) of whole subtrees, many at a time; batches are sorted by subtree."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]))
        if sum(h.shape[1] for h in held) < FLUSH_GRAMS // 8:
            continue
        rows = np.concatenate(held, axis=1)
        last = int(np.searchsorted(rows[0], rows[0, -1]))  # the last subtree may go on
        if last:
            yield rows[1, :last], rows[2, :last]
        held = [rows[:, last:]]
    if held and sum(h.shape[1] for h in held):
        rows = np.concatenate(held, axis=1)
        yield rows[1], rows[2]


def _by_subtree(counts: DataFrame) -> DataFrame:
    """(subtree, gram, n) of the grams, the subtrees whole in their partitions and in order."""
    code = F.conv(F.hex("key"), 16, 10).cast("long")
    rows = counts.where("is_gram").select(code.alias("gram"), "n")
    tree = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * (UPPER + 1)) - 1))
    return rows.select(tree.alias("subtree"), "gram", "n").repartition("subtree").sortWithinPartitions("subtree")


def _upper(rows: DataFrame, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """keys, mixed probability and weight left of the contexts of ``UPPER`` bytes."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _subtrees(batches):
            lowest = _levels(code, n, depth)[UPPER + 1]
            keys, at = np.unique(lowest.parent(), return_inverse=True)
            sums = [np.bincount(at, v, len(keys)) for v in (lowest.zeros, lowest.ones, lowest.weighted)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), *[pa.array(v.astype(np.int64)) for v in sums[:2]], pa.array(sums[2])],
                names=["key", "zeros", "ones", "below"],
            )

    sent = rows.mapInArrow(up, "key long, zeros long, ones long, below double").groupBy("key")
    summed = sent.agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).toArrow().sort_by("key")
    level = Level(*[summed[c].to_numpy() for c in ("key", "zeros", "ones", "below")]).at(UPPER)
    chain = [level]
    for d in range(UPPER - 1, -1, -1):
        child = chain[-1]
        keys, at = np.unique(child.parent(), return_inverse=True)
        sums = [np.bincount(at, v, len(keys)) for v in (child.zeros, child.ones, child.weighted)]
        chain.append(Level(keys, sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2]).at(d))
    mixed = None
    for level in reversed(chain):
        mixed = level.predict(mixed)
    return mixed


def gram_logs(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, n, log): log10 of the mixed probability of each gram's byte after its context, written."""
    if depth <= UPPER:
        raise ValueError(f"the depth has to be at least {UPPER + 1}")
    rows = _by_subtree(counts)
    above = rows.sparkSession.sparkContext.broadcast(_upper(rows, depth))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _subtrees(batches):
            levels, mixed = _levels(code, n, depth), above.value
            for d in range(UPPER + 1, depth + 1):
                mixed = levels[d].predict(mixed)
            logs = np.zeros(len(code))
            for i in range(8):
                one = mixed[1][np.searchsorted(mixed[0], (code >> 8 << 8) | _decision(code, i))]
                logs += np.log10(np.where(_bit(code, i), one, 1 - one))
            yield pa.RecordBatch.from_arrays(
                [pa.array(code), pa.array(n), pa.array(logs)], names=["gram", "n", "log"]
            )

    return written(rows.mapInArrow(down, "gram long, n long, log double"), "grams")


class GramTable:
    """The logs of the heavy grams at hand, by a hash table that a worker builds at first use."""

    def __init__(self, gram: np.ndarray, log: np.ndarray):
        self.gram, self.log = gram, log.astype(np.float32)
        self.index: pd.Index | None = None

    def scores(self, texts: list[bytes], depth: int) -> tuple[np.ndarray, list[list[dict]]]:
        """Sum of the logs of each lower-cased text's heavy grams, and its other grams, counted."""
        code, starts = grams(texts, depth)
        if self.index is None:
            self.index = pd.Index(self.gram)
        at = self.index.get_indexer(code)
        there = at >= 0
        logs = np.zeros(len(code))
        logs[there] = self.log[at[there]]
        rest: list[list[dict]] = [[] for _ in texts]
        missing = np.flatnonzero(~there)
        if len(missing):
            owner = np.searchsorted(starts, missing, "right") - 1
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
            for i in np.unique(owner).tolist():
                own, n = np.unique(code[missing[bounds[i] : bounds[i + 1]]], return_counts=True)
                rest[i] = [{"gram": g, "n": c} for g, c in zip(own.tolist(), n.tolist())]
        return np.add.reduceat(logs, starts), rest


SCORED = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("heavy_tokens", T.LongType()),
        T.StructField("heavy_logs", T.DoubleType()),
        T.StructField("gram_logs", T.DoubleType()),
        T.StructField(
            "light_grams",
            T.ArrayType(T.StructType([T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])),
        ),
        T.StructField(
            "rest",
            T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.IntegerType())])),
        ),
    ]
)

# The heavy words at hand with log10 (count + 1), kept by a Python worker between its tasks.
_HEAVY: dict[str, dict[bytes, float]] = {}


def _heavy(key: str, shared) -> dict[bytes, float]:
    if key not in _HEAVY:
        _HEAVY.clear()
        words, counts = shared.value
        _HEAVY[key] = dict(zip(words, np.log10(np.array(counts) + 1.0).tolist(), strict=True))
    return _HEAVY[key]


def _score(texts: list[bytes], heavy: dict[bytes, float], table: GramTable, depth: int) -> list[pa.Array]:
    texts = [text.translate(LOWER) for text in texts]
    n_tokens, known, logs, rest = [], [], [], []
    for text in texts:
        words = text.split()
        words.append(END)
        found = list(map(heavy.get, words))
        light = Counter(w for w, x in zip(words, found, strict=True) if x is None)
        n_tokens.append(len(words))
        known.append(len(words) - sum(light.values()))
        logs.append(math.fsum(x for x in found if x is not None))
        rest.append([{"word": w, "n": n} for w, n in light.items()])
    word = pa.struct([("word", pa.binary()), ("n", pa.int32())])
    gram = pa.struct([("gram", pa.int64()), ("n", pa.int64())])
    sums, light_grams = table.scores(texts, depth)
    return [
        pa.array(n_tokens, pa.int64()),
        pa.array(map(len, texts), pa.int64()),
        pa.array(known, pa.int64()),
        pa.array(logs, pa.float64()),
        pa.array(sums),
        pa.array(light_grams, pa.list_(gram)),
        pa.array(rest, pa.list_(word)),
    ]


def score(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    heavy_words: int = HEAVY_WORDS,
    heavy_grams: int = HEAVY_GRAMS,
    depth: int = DEPTH,
) -> DataFrame:
    """``docs`` with held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    split = put(docs, held_out=held_out(F.col("doc_id")))
    counts = training_counts(split, text, depth)
    words = counts.where("not is_gram")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    short = words.where(F.octet_length("key") <= HEAVY_BYTES)
    # More frequent than the word at the bound: fewer words than the bound, each of bounded length.
    least = kth_largest(short, "n", heavy_words) if distinct > heavy_words else 0
    is_heavy = (F.octet_length("key") <= HEAVY_BYTES) & (F.col("n") > least)
    heavy = words.where(is_heavy).select("key", "n").toArrow()
    shared = spark.sparkContext.broadcast((heavy["key"].to_pylist(), heavy["n"].to_pylist()))
    logs = gram_logs(counts, depth)
    common = kth_largest(logs, "n", heavy_grams) if logs.count() > heavy_grams else -1
    taken = logs.where(F.col("n") > common).select("gram", "log").toArrow()
    table = spark.sparkContext.broadcast(GramTable(taken["gram"].to_numpy(), taken["log"].to_numpy()))
    run = uuid.uuid4().hex

    def compute(texts: pa.Array) -> list[pa.Array]:
        return _score(as_bytes(texts), _heavy(run, shared), table.value, depth)

    kept = None if keep is None else [*keep, "held_out"]
    scored = append(split, [text], compute, SCORED, kept)
    scored = written(put(scored, row=F.monotonically_increasing_id()), "scored")
    light = scored.select("row", F.explode("rest").alias("r")).select("row", "r.word", F.col("r.n").alias("n"))
    known = light.join(words.where(~is_heavy).select(F.col("key").alias("word"), F.col("n").alias("c")), "word")
    sums = known.groupBy("row").agg(
        F.sum("n").alias("light_tokens"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("light_logs")
    )
    joined = scored.drop("rest", "light_grams").join(sums, "row", "left")
    if common >= 0:
        seen = scored.select("row", F.explode("light_grams").alias("r")).select("row", "r.gram", F.col("r.n").alias("times"))
        rare = seen.join(logs.where(F.col("n") <= common).select("gram", "log"), "gram")
        rare = rare.groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("rare_logs"))
        joined = joined.join(rare, "row", "left")
    else:
        joined = joined.withColumn("rare_logs", F.lit(0.0))
    none = F.lit(0)
    whole = F.col("gram_logs") + F.coalesce("rare_logs", F.lit(0.0))
    out = put(
        joined,
        n_known=(F.col("heavy_tokens") + F.coalesce("light_tokens", none)).cast("long"),
        train_tokens=F.lit(total).cast("long"),
        base_score=F.col("heavy_logs")
        + F.coalesce("light_logs", F.lit(0.0))
        - F.col("n_tokens") * F.lit(math.log10(total + distinct + 1)),
        score=whole,
        bits_per_byte=-whole / F.lit(math.log10(2)) / (F.col("n_bytes") + 1),
    )
    inner = ["row", "n_bytes", "heavy_tokens", "heavy_logs", "light_tokens", "light_logs", "gram_logs", "rare_logs"]
    return out.drop(*inner)
