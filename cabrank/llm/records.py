"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

A record file holds documents in ascending order of doc_id; file numbers follow that order too.
A record is framed as

    length   unsigned 64-bit   bytes of the payload
    check    unsigned 32-bit   masked crc32 of the length field
    payload  1 byte, 1 if there is a doc_id; 1 byte, the bytes of an id (2 if all ids of the
             document are below 65536, else 4); signed 64-bit doc_id; the ids, unsigned
    check    unsigned 32-bit   masked crc32 of the payload

all little-endian. Masking (rotate right by 15 bits, add a constant) keeps the checksum of data
that itself holds checksums from degenerating. Beside the record files stands the index, a
Parquet table of (doc_id, file, first, offset, length, n_tokens) by which a reader takes records
in any order without scanning; ``first`` counts the ids of the file before the record.

A task writes a file under a name of its own and renames it when complete, so a lost or repeated
task leaves no partial file, and the index names only files of tasks that ended.

Defined cases: a null text is an empty one, and an empty one a record with the end id alone; a
null doc_id comes first in order; rows with one doc_id are in order of text hash, then text;
an empty table has an empty index and no file.
"""

from __future__ import annotations

import json
import os
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.llm.arrow import slices
from cabrank.llm.bpe import byte_letters
from cabrank.llm.units import LONGEST_KEPT, UnitTable
from cabrank.sources.files import arrow_store

END_ID = 2
# Words whose ids a worker keeps: units that differ in the point behind share them.
TABLE_WORDS = 300_000
MASK_DELTA = 0xA282EAD8
INDEX = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("file", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)
READ = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("file", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
# Letters of the Latin blocks, \p{L} in every version of Unicode; a unit is a word after a blank,
# and maybe, on the next line, another.
_L = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_PLAIN_UNIT = re.compile(f"( ?[{_L}]+)([.,]?)(?:\n([{_L}]+)([.,]?))?")
_HEAD = struct.Struct("<QI")
_PAYLOAD = struct.Struct("<BBq")
_CHECK = struct.Struct("<I")
_BATCH_BYTES = 8 * 1024 * 1024


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """The record of a document, of its ids as little-endian unsigned 32-bit integers."""
    numbers = np.frombuffer(ids, "<u4")
    width = 2 if not len(numbers) or int(numbers.max()) < 1 << 16 else 4
    packed = numbers.astype("<u2").tobytes() if width == 2 else ids
    payload = _PAYLOAD.pack(doc_id is not None, width, doc_id or 0) + packed
    length = len(payload).to_bytes(8, "little")
    return b"".join([length, _CHECK.pack(masked(length)), payload, _CHECK.pack(masked(payload))])


def parse(record: bytes) -> tuple[int | None, bytes]:
    """doc_id and ids (as in ``frame``) of one whole record; a damaged one raises."""
    length, check = _HEAD.unpack_from(record)
    payload = record[_HEAD.size : _HEAD.size + length]
    if check != masked(record[:8]) or len(record) != _HEAD.size + length + _CHECK.size:
        raise ValueError("damaged record length")
    if _CHECK.unpack_from(record, _HEAD.size + length)[0] != masked(payload):
        raise ValueError("damaged record")
    has_id, width, doc_id = _PAYLOAD.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=_PAYLOAD.size).astype("<u4").tobytes()
    return (doc_id if has_id else None), ids


class LibraryUnits:
    """Ids of short texts by the tokenizers library, for a plain byte-level tokenizer.

    A blank and letters are one pre-token, so the library's BPE model can take them directly; a
    point or comma behind and a line break before the next word are others. Everything else goes
    through the whole tokenizer.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.model = tokenizer.model
        self.letter = {byte: letter for letter, byte in byte_letters().items()}
        self.after = {"": b""} | {c: self.whole([c])[0] for c in ".,\n"}
        self.blank = self.letter[32]
        self.words: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return whole_ids(self.tokenizer, texts)

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if word.isascii():
                letters = word.replace(" ", self.blank)
            else:
                letters = "".join(map(self.letter.__getitem__, word.encode()))
            ids = [token.id for token in self.model.tokenize(letters)]
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.words) < TABLE_WORDS and len(word) <= LONGEST_KEPT:
                self.words[word] = found
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        done: list[bytes | None] = []
        rest = []
        for text in texts:
            plain = _PLAIN_UNIT.fullmatch(text)
            if plain is None:
                rest.append(text)
                done.append(None)
                continue
            word, point, second, last = plain.groups()
            ids = self.word(word) + self.after[point]
            if second:
                ids += self.after["\n"] + self.word(second) + self.after[last]
            done.append(ids)
        others = iter(self.whole(rest))
        return [next(others) if x is None else x for x in done]


class WholeTexts:
    """Ids of whole texts, for tokenizers of which it is not known where a text can be cut."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def ids(self, texts: list[str]) -> list[bytes]:
        return whole_ids(self.tokenizer, texts)


def whole_ids(tokenizer, texts: list[str]) -> list[bytes]:
    done = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return [np.array(x.ids, "<u4").tobytes() for x in done]


def plain_byte_level(tokenizer) -> bool:
    """Whether a tokenizer cuts texts by the byte-level pattern and does nothing else to them.

    Only then a blank before a word starts a pre-token, and no token goes over it: no normaliser,
    no blank put before the text, no other pattern, a plain BPE model, and no added token with a
    blank in it or one that takes the blanks around it.
    """
    told = json.loads(tokenizer.to_str())
    pre, model = told["pre_tokenizer"] or {}, told["model"]
    return (
        told["normalizer"] is None
        and pre.get("type") == "ByteLevel"
        and not pre.get("add_prefix_space")
        and pre.get("use_regex", True)
        and model["type"] == "BPE"
        and not model.get("dropout")
        and not model.get("continuing_subword_prefix")
        and not model.get("end_of_word_suffix")
        and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in told["added_tokens"])
    )


_TABLES: dict[str, UnitTable | WholeTexts] = {}


def library_table(tokenizer_path: str) -> UnitTable | WholeTexts:
    """The encoder of this Python worker over the tokenizers library."""
    if tokenizer_path not in _TABLES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        plain = plain_byte_level(tokenizer)
        _TABLES[tokenizer_path] = UnitTable(LibraryUnits(tokenizer)) if plain else WholeTexts(tokenizer)
    return _TABLES[tokenizer_path]


def _file(root: str, number: int) -> str:
    return posixpath.join(root, f"records-{number:07d}.bin")


def write_records(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, text: str = "text"
) -> DataFrame:
    """Write the records of (doc_id, text) below ``path`` and return their index, read back.

    Range partitions of doc_id become files; AQE merges small ones. Rows of one doc_id can be
    spread over files, as the text hash is part of the range key.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("salt"),
    )
    ordered = base.repartitionByRange(F.asc_nulls_first("doc_id"), "salt").sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "salt", "text"
    )
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (part for batch in batches for part in slices(batch, 1, _BATCH_BYTES))
        yield from _write_file(rows, path, library_table(tokenizer_path), end)

    index = ordered.select("doc_id", "text").mapInArrow(write, INDEX)
    arrow_store(path)  # a folder that tasks cannot write to fails here
    index.write.mode("overwrite").parquet(f"{path}/index")
    return read_index(spark, path)


def _write_file(
    parts: Iterator[pa.RecordBatch], path: str, table: UnitTable, end: bytes
) -> Iterator[pa.RecordBatch]:
    """Write the rows of this task to one file; yields their index."""
    number = TaskContext.get().partitionId()
    fs, root = arrow_store(path)
    own = posixpath.join(root, f".{number}-{uuid.uuid4().hex}")
    out, offset, first = None, 0, 0
    for part in parts:
        if out is None:
            fs.create_dir(root, recursive=True)
            out = fs.open_output_stream(own)
        rows = []
        encoded = table.ids(part.column(1).to_pylist())
        for doc_id, ids in zip(part.column(0).to_pylist(), encoded, strict=True):
            ids += end
            record = frame(doc_id, ids)
            rows.append((doc_id, number, first, offset, len(record), len(ids) // 4))
            first += len(ids) // 4
            offset += len(record)
            out.write(record)
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=INDEX.fieldNames())
    if out is not None:
        out.close()
        _rename(fs, own, _file(root, number))


def _rename(fs: pafs.FileSystem, own: str, final: str) -> None:
    """Give a complete file its name; where another attempt of the task has, the bytes are equal."""
    try:
        fs.move(own, final)
    except OSError:
        if fs.get_file_info(final).type != pafs.FileType.File:
            raise
        fs.delete_file(own)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def read_files(index: DataFrame, path: str) -> DataFrame:
    """Every record of the files, in file order; each file is read by a task of its own.

    Only the numbers of the files are taken from the index, as many as the writing stage had
    tasks; lengths and ids come from the files.
    """
    spark = index.sparkSession
    numbers = sorted(row["file"] for row in index.select("file").distinct().collect())
    # A range has the partitions that it is given; a shuffle of the numbers could be merged.
    files = spark.range(0, len(numbers), 1, max(1, len(numbers)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = arrow_store(path)
        for batch in batches:
            for at in batch.column(0).to_pylist():
                number = numbers[at]
                with fs.open_input_stream(_file(root, number), buffer_size=1 << 20) as stream:
                    yield from _batches(stream_records(stream, number))

    return files.mapInArrow(read, READ)


def read_shuffled(index: DataFrame, path: str, seed: int) -> DataFrame:
    """Every record, in a random order of the whole table, each fetched by its offset."""
    order = index.withColumn("at", F.rand(seed)).sort("at").select("file", "first", "offset", "length")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = arrow_store(path)
        for batch in batches:
            yield from _batches(fetch_records(fs, root, batch.to_pylist()))

    return order.mapInArrow(read, READ)


def stream_records(stream, number: int) -> Iterator[tuple]:
    """The records of an open file from start to end."""
    first = 0
    while head := stream.read(_HEAD.size):
        length, check = _HEAD.unpack(head)
        if check != masked(head[:8]):
            raise ValueError(f"damaged record length in file {number}")
        doc_id, ids = parse(head + stream.read(length + _CHECK.size))
        yield doc_id, number, first, ids
        first += len(ids) // 4


def fetch_records(fs: pafs.FileSystem, root: str, places: list[dict]) -> Iterator[tuple]:
    """The records at some places of the index."""
    for place in places:
        with fs.open_input_file(_file(root, place["file"])) as source:
            doc_id, ids = parse(source.read_at(place["length"], place["offset"]))
        yield doc_id, place["file"], place["first"], ids


def _batches(records: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for record in records:
        rows.append(record)
        size += len(record[-1])
        if size >= _BATCH_BYTES:
            yield _read_batch(rows)
            rows, size = [], 0
    if rows:
        yield _read_batch(rows)


def _read_batch(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=READ.fieldNames()
    )


def with_starts(records: DataFrame, index: DataFrame) -> DataFrame:
    """``records`` with ``start``, the ids of all documents before each.

    The running total is over one row per file, the rows inside a file have theirs already.
    """
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("file_tokens"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "file", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("file_start")
    )
    # A file is a range partition, so there are at most spark.sql.shuffle.partitions rows.
    return records.join(F.broadcast(starts), "file").withColumn("start", F.col("file_start") + F.col("first"))
