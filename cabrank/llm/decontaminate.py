"""Benchmark decontamination: a broadcast hash set of test n-grams against all token windows.

The windows of the benchmark become sorted arrays of hashes on the driver, once for a block of
items: hash, place of the window's words in the block's text, and item. A slice of documents
becomes one array of word hashes, whose window hashes are rolled up with a few vector operations
and looked up in a bit table that has ``BITS`` bits a window, then in the sorted hashes; what is
left is verified on the words themselves. So the scan is linear in the text and independent of the
number of items, and a worker only loads arrays.

The benchmark is broadcast in blocks of at most ``BLOCK_BYTES`` of text. A benchmark of more
blocks takes one pass for each, and a pass carries on the spans found before.

Defined cases: a null or wordless text has no windows and no hits; a null or wordless item has no
window; an item shorter than a window is one window; an item with null id counts under the empty
id; equal windows count for each of their items; repeated rows are handled one by one.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.llm.arrow import ALNUM_WORDS, append, as_bytes, put, written

WINDOW = 10
BLOCK_BYTES = 16 * 1024 * 1024
BITS = 16

SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", SPANS),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
)
_FACTOR, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_HALF, _BYTE, _LOW = np.uint64(32), np.uint64(3), np.uint64(7)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM_WORDS).split()


def _hashes(words: list[bytes]) -> np.ndarray:
    """Hashes that are the same in every process."""
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def _rolled(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for each window of so many words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    rolled = hashes[:n].copy()
    for j in range(1, length):
        rolled *= _FACTOR
        rolled += hashes[j : n + j]
    for _ in range(2):
        rolled ^= rolled >> _HALF
        rolled *= _SPREAD
    return rolled ^ rolled >> _HALF


class Windows:
    """All windows of one length: hashes in order, where their words stand, and their items."""

    def __init__(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, items: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.starts, self.ends, self.items = (x[order].astype(np.int32) for x in (starts, ends, items))
        bits = max(10, int(BITS * len(hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits - 3, np.uint8)
        place = hashes >> self.shift
        np.bitwise_or.at(self.table, (place >> _BYTE).astype(np.int64), np.uint8(1) << (place & _LOW).astype(np.uint8))

    def candidates(self, rolled: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Places of hashes that are there, with the range of the windows that have them."""
        place = rolled >> self.shift
        set_bits = self.table[(place >> _BYTE).astype(np.int64)] >> (place & _LOW).astype(np.uint8) & 1
        at = np.flatnonzero(set_bits)
        low = np.searchsorted(self.hashes, rolled[at], "left")
        high = np.searchsorted(self.hashes, rolled[at], "right")
        there = high > low
        yield from zip(at[there].tolist(), low[there].tolist(), high[there].tolist(), strict=True)


class WindowIndex:
    """The windows of some items by length, and the items' words as one text."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.names = [item_id for item_id, _ in items]
        split = [words_of(text) for _, text in items]
        words = [word for part in split for word in part]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        first = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(split)), counts)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.text = b" ".join(words)
        place = np.cumsum(lengths + 1) - lengths - 1
        hashes = _hashes(words)
        self.windows: dict[int, Windows] = {}
        for length in np.unique(np.minimum(counts, window)).tolist():
            if not length:
                continue
            if length < window:  # an item that is one window
                at = first[counts == length]
            else:
                at = np.arange(max(0, len(words) - length + 1))
                at = at[owner[at] == owner[at + length - 1]]
            last = at + length - 1
            ends = place[last] + lengths[last]
            self.windows[length] = Windows(_rolled(hashes, length)[at], place[at], ends, owner[at])

    def scan(self, texts: list[bytes], before: list) -> tuple[np.ndarray, list, list]:
        """For each text its number of words, its merged hit spans and the items that hit it."""
        split = [words_of(text) for text in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.cumsum(counts)
        words = [word for part in split for word in part]
        hashes = _hashes(words)
        cover = np.zeros(len(words) + 1, np.int32)
        items: dict[int, set[str]] = {}
        for length, windows in self.windows.items():
            for at, low, high in windows.candidates(_rolled(hashes, length)):
                doc = int(np.searchsorted(ends, at, "right"))
                if at + length > ends[doc]:
                    continue
                said = b" ".join(words[at : at + length])
                found = {
                    self.names[windows.items[k]]
                    for k in range(low, high)
                    if self.text[windows.starts[k] : windows.ends[k]] == said
                }
                if found:
                    cover[at] += 1
                    cover[at + length] -= 1
                    items.setdefault(doc, set()).update(found)
        spans = []
        for doc, (old_spans, _) in enumerate(before):
            for span in old_spans or []:
                start = int(ends[doc] - counts[doc])
                cover[start + span["start"]] += 1
                cover[start + span["end"]] -= 1
        hit = np.cumsum(cover[:-1]) > 0
        all_items = []
        for doc, (old_spans, old_items) in enumerate(before):
            if doc not in items and not old_spans:
                spans.append([])
                all_items.append([])
                continue
            own = hit[ends[doc] - counts[doc] : ends[doc]]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
            spans.append(
                [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]
            )
            all_items.append(sorted(items.get(doc, set()) | set(old_items or [])))
        return counts, spans, all_items


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with n_words, hit_spans (word ranges, end exclusive, merged) and hit_items."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col("text"), F.lit("")).alias("body"),
    )
    size = items.agg(F.sum(F.octet_length("body") + F.octet_length("item"))).head()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    found = put(
        docs,
        n_words=F.lit(0).cast("long"),
        hit_spans=F.array().cast(SPANS),
        hit_items=F.array().cast("array<string>"),
    )
    kept = None if keep is None else [*keep, *([text] if blocks > 1 else [])]
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == block)
        index = WindowIndex([(row[0], row[1].encode()) for row in part.collect()], window)
        shared = spark.sparkContext.broadcast(index)
        found = append(
            found, [text, "hit_spans", "hit_items"], _scanner(shared), FOUND, keep=kept
        )
        if block + 1 < blocks:
            found = written(found, "decontaminate")
    return found


def _arrays(counts: np.ndarray, spans: list, items: list) -> list[pa.Array]:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    return [
        pa.array(counts),
        pa.array(spans, pa.list_(span)),
        pa.array(items, pa.list_(pa.string())),
    ]


def _scanner(shared):
    def compute(texts: pa.Array, spans: pa.Array, items: pa.Array) -> list[pa.Array]:
        before = list(zip(spans.to_pylist(), items.to_pylist(), strict=True))
        counts, hit, by = shared.value.scan(as_bytes(texts), before)
        return _arrays(counts, hit, by)

    return compute


def n_hit(spans: str = "hit_spans"):
    """How many words the spans cover."""
    return F.aggregate(spans, F.lit(0), lambda acc, s: acc + s["end"] - s["start"]).cast("long")


def _cut(text: bytes, spans: list) -> bytes:
    places = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : places[span["start"]][0]])
        at = places[span["end"] - 1][1]
    return b"".join([*kept, text[at:]])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, remove: str = "documents"
) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without the hit spans."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove!r}")
    names = docs.columns
    if remove == "documents":
        plain = docs.toDF(*[f"d{i}" for i in range(len(names))])
        found = find_hits(plain, benchmark, window, text=f"d{names.index('text')}")
        clean = found.where(F.size("hit_spans") == 0)
        return clean.select(*plain.columns).toDF(*names)
    plain = docs.toDF(*[f"d{i}" for i in range(len(names))])
    body = f"d{names.index('text')}"
    found = find_hits(plain, benchmark, window, text=body)

    def compute(texts: pa.Array, spans: pa.Array) -> list[pa.Array]:
        pairs = zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist(), strict=True)
        cut = [t if t is None or not s else _cut(t, s) for t, s in pairs]
        return [pa.array(cut, pa.binary()).cast(pa.string())]

    added = T.StructType([T.StructField(body, T.StringType())])
    return append(found, [body, "hit_spans"], compute, added).select(*plain.columns).toDF(*names)
