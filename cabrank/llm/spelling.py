"""Spelling variants by Bloom-guided neighbourhoods.

Two words are near if they differ by one inserted, deleted or replaced code point. The vocabulary
goes into blocked Bloom filters, sharded by word length: a shard is a run of 64-bit blocks, and a
word sets ``BITS`` bits of one block of its length's shard. The edits of every word are generated
and probed against the filters, a few arithmetic operations an edit: the hash of a word is a
polynomial of its code points, so the hash of an edit follows from the word's own. Only edits that
the filters know are spelled out and shuffled to an exact join with the vocabulary, which removes
the false positives.

A deletion of one word is an insertion into the other, and a replacement works both ways, so
deletions and replacements by a greater letter find each pair of near words exactly once.

Bounds: the filters of all lengths share one address space of ``BLOCK_SHARE`` blocks a word, of
which ``TABLE_BLOCKS`` are broadcast at a time (16 MB). A larger vocabulary takes several passes
over its words, none over the texts; each pass probes the edits that fall into its part, so the
result is the same. Edits are generated ``EDITS`` at a time, however long a word is.

Defined cases: a null or empty text has no words; a null doc_id is written as nothing; repeated
rows count as often as they occur; words are compared as they are, by code points; ties between
forms go to the smallest word. Other columns are ignored. Letters that no edit inserts (those not
in ``LETTERS``) may stand in words, but a word is then not found by replacing with them: the
vocabulary has to be made of LETTERS.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.llm.arrow import written

# The letters of a word, A-Z already lowered.
RUN = r"[a-zÀ-ÿ]+"
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)

BITS = 4
BLOCK_SHARE = 0.25  # 64-bit blocks a word: 16 bits a word
LEAST_BLOCKS = 64
TABLE_BLOCKS = 2 * 1024 * 1024
EDITS = 1_000_000
WORDS = 4096

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_S32, _S33, _ONE, _SIX = np.uint64(32), np.uint64(33), np.uint64(1), np.uint64(63)


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, run) of every maximal run of letters, A-Z lowered."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWERED)
    found = F.regexp_extract_all(low, F.lit(RUN), F.lit(0))
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("run"))


def vocabulary(words: DataFrame, word: Column, least: int = 3, letters: int = 5) -> DataFrame:
    """(word, n) of the words of at least ``letters`` code points that occur ``least`` times."""
    counted = words.select(word.alias("word")).where(F.char_length("word") >= letters)
    return counted.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


class Shards:
    """Where the blocks of each word length lie in the address space."""

    def __init__(self, words_of_length: dict[int, int]):
        self.start: dict[int, int] = {}
        self.size: dict[int, int] = {}
        self.total = 0
        for length in sorted(words_of_length):
            self.start[length] = self.total
            self.size[length] = max(LEAST_BLOCKS, round(words_of_length[length] * BLOCK_SHARE))
            self.total += self.size[length]

    def places(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Block address and bit mask of words of a length, by their polynomial hashes."""
        z = hashes ^ np.uint64(length * BASE & (1 << 64) - 1)
        for mix in _MIX:
            z = (z ^ (z >> _S33)) * mix
        z ^= z >> _S33
        # Blocks beyond 2^32 of one length would need more hash bits than are left for the place.
        at = (z >> _S32) * np.uint64(self.size[length]) >> _S32
        mask = np.zeros(len(z), np.uint64)
        for i in range(BITS):
            mask |= _ONE << (z >> np.uint64(6 * i) & _SIX)
        return at.astype(np.int64) + self.start[length], mask


def code_points(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(BASE)
    return np.multiply.accumulate(out)


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of the words of each length, in groups of bounded size."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        own = np.flatnonzero(lengths == length)
        step = max(1, min(WORDS, EDITS // int(length) // len(LETTERS)))
        for at in range(0, len(own), step):
            yield int(length), own[at : at + step]


def edits(words: list[str], shards: Shards, table: np.ndarray, first: int) -> Iterator[tuple[int, str]]:
    """(position of the word, edit) for the edits that the filter's part from ``first`` on knows."""

    def known(hashes: np.ndarray, length: int) -> np.ndarray:
        at, mask = shards.places(hashes, length)
        at -= first
        inside = np.flatnonzero((at >= 0) & (at < len(table)))
        hit = (table[at[inside]] & mask[inside]) == mask[inside]
        return inside[hit]

    for length, own in by_length(words):
        points = code_points([words[i] for i in own])
        power = powers(length + 1)
        terms = points * power[:-1]
        prefix = np.zeros((len(own), length + 1), np.uint64)
        np.cumsum(terms, axis=1, out=prefix[:, 1:])
        if length - 1 in shards.size:
            cut = prefix[:, :-1] + np.uint64(INVERSE) * (prefix[:, -1:] - prefix[:, 1:])
            # Of a run of one letter, the deletion of any gives the same word.
            new = np.ones_like(points, bool)
            new[:, 1:] = points[:, 1:] != points[:, :-1]
            rows, places = np.nonzero(new)
            for k in known(cut[rows, places], length - 1):
                word = words[own[rows[k]]]
                yield int(own[rows[k]]), word[: places[k]] + word[places[k] + 1 :]
        if length in shards.size:
            step = max(1, EDITS // len(own) // len(LETTERS))
            for start in range(0, length, step):  # a very long word goes in stretches
                part = points[:, start : start + step, None]
                greater = LETTERS > part
                hashes = prefix[:, -1, None, None] + (LETTERS - part) * power[start : start + part.shape[1], None]
                rows, places, letters = np.nonzero(greater)
                for k in known(hashes[greater], length):
                    word, at = words[own[rows[k]]], int(places[k]) + start
                    yield int(own[rows[k]]), word[:at] + chr(int(LETTERS[letters[k]])) + word[at + 1 :]


def filters(vocab: DataFrame, shards: Shards) -> DataFrame:
    """(address, mask) of the blocks that any word sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, own in by_length(words):
                points = code_points([words[i] for i in own])
                at, mask = shards.places((points * powers(length)).sum(1, dtype=np.uint64), length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(mask.view(np.int64))], names=["address", "mask"]
                )

    bits = vocab.select("word").mapInArrow(run, "address long, mask long")
    return bits.groupBy("address").agg(F.bit_or("mask").alias("mask"))


def near_pairs(vocab: DataFrame, table_blocks: int = TABLE_BLOCKS) -> DataFrame:
    """(a, n_a, b, n_b): each pair of near words once. ``vocab`` (word, n) is read several times."""
    spark = vocab.sparkSession
    lengths = vocab.groupBy(F.char_length("word").alias("length")).count().collect()
    shards = Shards({row["length"]: row["count"] for row in lengths})
    blocks = written(filters(vocab, shards), "bloom")
    passes = []
    for first in range(0, max(1, shards.total), table_blocks):
        table = np.zeros(min(table_blocks, shards.total - first), np.uint64)
        part = blocks.where((F.col("address") >= first) & (F.col("address") < first + len(table))).toArrow()
        table[part["address"].to_numpy() - first] = part["mask"].to_numpy().view(np.uint64)
        sent = spark.sparkContext.broadcast(table)

        def probe(batches: Iterator[pa.RecordBatch], sent=sent, first=first) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words, counts = batch.column(0).to_pylist(), batch.column(1)
                at, found, size = [], [], 0

                def made() -> pa.RecordBatch:
                    picked = pa.array(at, pa.int64())
                    return pa.RecordBatch.from_arrays(
                        [pa.array(found), batch.column(0).take(picked), counts.take(picked)],
                        names=["b", "a", "n_a"],
                    )

                for i, edit in edits(words, shards, sent.value, first):
                    at.append(i)
                    found.append(edit)
                    size += 2 * len(edit)
                    if size > 4_000_000:
                        yield made()
                        at, found, size = [], [], 0
                if at:
                    yield made()

        passes.append(vocab.select("word", "n").mapInArrow(probe, "b string, a string, n_a long"))
    positives = passes[0]
    for more in passes[1:]:
        positives = positives.union(more)
    exact = vocab.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    return positives.join(exact, "b").select("a", "n_a", "b", "n_b")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to the last, by pointer jumping.

    A form occurs at least twice as often as its word, so a chain is no longer than the logarithm
    of the largest count, and the number of rounds the logarithm of that.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("above"))
        jumped = now.join(up, "root", "left").select("word", F.coalesce("above", "root").alias("root"), "above")
        jumped = written(jumped, "roots")
        now = jumped.select("word", "root")
        if jumped.where("above is not null").isEmpty():
            return now


def variants(vocab: DataFrame, factor: int = 2, table_blocks: int = TABLE_BLOCKS) -> DataFrame:
    """``vocab`` (word, n) with form, root, n_near and form_n.

    The form of a word is the near word that occurs most often, if that is ``factor`` times as
    often as the word itself; the root is the last form on the way from the word.
    """
    vocab = written(vocab.select("word", "n"), "vocabulary")
    pairs = near_pairs(vocab, table_blocks)
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n")),
    )
    both = pairs.select(F.inline(ends))
    # The most frequent near word, the smallest of equals.
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), "near")).alias("best")
    )
    enough = -F.col("best.minus") >= factor * F.col("n")
    judged = vocab.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.minus")).alias("form_n"),
    )
    judged = written(judged, "variants")
    last = roots(judged.where("form is not null"))
    return judged.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
