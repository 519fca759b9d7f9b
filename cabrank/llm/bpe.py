"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

Each pre-token starts as single bytes. The leaves of the tree are the ranks of adjacent pairs,
ordered by rank and then position, so the root is the leftmost pair of lowest rank. A merge
changes at most three leaves (the pair itself, the pairs to its left and right), each updated in
logarithmic time, and merging ends when the root says that no pair can merge. A pre-token of n
bytes takes O(n log n), however long.

Decoding maps ids to their bytes and reads all of them as UTF-8, broken sequences becoming
replacement characters.

Defined cases: a null text is an empty one, with no ids; special tokens written out in a text are
that special id, as in the library; an id beyond the vocabulary is skipped in decoding.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cabrank.llm.arrow import append
from cabrank.llm.units import UnitTable

# How byte-level tokenizers split text, and the bytes they print as themselves.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]

TABLE_PIECES = 200_000
_NONE = 1 << 62


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file; the rest count up from 256."""
    rest = [b for b in range(256) if b not in set(PRINTED)]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(rest)}


class SegmentTree:
    """Minimum of an array under point updates; the leaf count is a power of two."""

    def __init__(self, values: list[int]):
        self.leaves = 1 << max(0, (len(values) - 1).bit_length())
        nodes = [_NONE] * self.leaves + values + [_NONE] * (self.leaves - len(values))
        for i in range(self.leaves - 1, 0, -1):
            left, right = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = left if left <= right else right
        self.nodes = nodes

    def root(self) -> int:
        return self.nodes[1]

    def set(self, at: int, value: int) -> None:
        nodes = self.nodes
        at += self.leaves
        nodes[at] = value
        while at > 1:
            other = nodes[at ^ 1]
            at >>= 1
            least = value if value <= other else other
            if nodes[at] == least:
                return
            nodes[at] = value = least


class ByteBPE:
    """A vocabulary with its merges, read from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * (max([*vocab.values(), *self.specials.values()]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.specials.items():
            self.bytes_of[i] = token.encode()
        self.byte_id = [0] * 256
        for token, i in vocab.items():
            if len(token) == 1:
                self.byte_id[letters[token]] = i
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        self.pre_tokens = regex.compile(PRE_TOKENS)
        self.special = (
            regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")
            if self.specials
            else None
        )
        self.pieces: dict[str, bytes] = {}
        self.table = UnitTable(self.encode_all)
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token."""
        ids = [self.byte_id[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        merges, width = self.merges, n.bit_length()
        low = (1 << width) - 1
        ranks = [merges.get(pair) for pair in zip(ids, ids[1:])]
        tree = SegmentTree([_NONE if r is None else r[0] << width | i for i, r in enumerate(ranks)])
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while (best := tree.root()) != _NONE:
            i = best & low
            j = after[i]
            ids[i] = merges[ids[i], ids[j]][1]
            ids[j] = -1
            k = after[i] = after[j]
            if j < n - 1:
                tree.set(j, _NONE)
            if k < n:
                before[k] = i
                pair = merges.get((ids[i], ids[k]))
                tree.set(i, _NONE if pair is None else pair[0] << width | i)
            else:
                tree.set(i, _NONE)
            if (h := before[i]) >= 0:
                pair = merges.get((ids[h], ids[i]))
                tree.set(h, _NONE if pair is None else pair[0] << width | h)
        return [i for i in ids if i >= 0]

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            found = np.array(self.merge(piece.encode()), "<u4").tobytes()
            if len(self.pieces) < TABLE_PIECES and len(piece) <= 64:
                self.pieces[piece] = found
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Id bytes of each text, pre-token by pre-token."""
        done = []
        for text in texts:
            out = []
            parts = self.special.split(text) if self.special else [text]
            for part in parts:
                if part in self.specials:
                    out.append(self.specials[part].to_bytes(4, "little"))
                else:
                    out.extend(map(self._piece, self.pre_tokens.findall(part)))
            done.append(b"".join(out))
        return done

    def decode(self, ids: bytes) -> str:
        known = self.bytes_of
        numbers = np.frombuffer(ids, "<u4")
        if len(numbers) and int(numbers.max()) >= len(known):
            numbers = numbers[numbers < len(known)]
        return b"".join(map(known.__getitem__, numbers.tolist())).decode("utf-8", "replace")


_LOADED: dict[str, ByteBPE] = {}


def loaded(path: str) -> ByteBPE:
    """The vocabulary, read once by a Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]


def encode(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``ids``, the text's ids as little-endian unsigned 32-bit integers."""

    def compute(texts: pa.Array) -> list[pa.Array]:
        table = loaded(path).table
        return [pa.array(table.ids([t or "" for t in texts.to_pylist()]), pa.binary())]

    return append(df, [text], compute, T.StructType([T.StructField("ids", T.BinaryType())]), keep)


def round_trip(
    df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``df`` with ``ids`` and ``decoded``, as ``decode(encode(df))``, in one pass over Python."""

    def compute(texts: pa.Array) -> list[pa.Array]:
        bpe = loaded(path)
        ids = bpe.table.ids([t or "" for t in texts.to_pylist()])
        return [pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.string())]

    added = T.StructType(
        [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    )
    return append(df, [text], compute, added, keep)


def decode(df: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``decoded``, the text of its ids; null ids decode to an empty text."""

    def compute(column: pa.Array) -> list[pa.Array]:
        bpe = loaded(path)
        return [pa.array([bpe.decode(i or b"") for i in column.to_pylist()], pa.string())]

    added = T.StructType([T.StructField("decoded", T.StringType())])
    return append(df, [ids], compute, added, keep)
