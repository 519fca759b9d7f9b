import json
import random
import struct
import zlib

import public_tokenizers
import pytest
from cabrank.llm import queries, records
from cabrank.llm.units import UnitTable
from conftest import TESTDATA
from frames import awkward, empty, save
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_query_matches_one_pass_over_sorted_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").orderBy("doc_id").collect()
    start, want = 0, set()
    for row in docs:
        ids = ids_of(tokenizer, row["text"])
        want.add((row["doc_id"], start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    got = queries.op3_length_delimited_records(spark, f"{TESTDATA}/sf0.01").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_awkward_rows_and_all_ways_of_reading(spark, tokenizer, tmp_path):
    df = awkward(spark, ("file", "offset"))
    index = records.write_records(df, f"{tmp_path}/r", PATH)
    want = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, ids_of(tokenizer, r["text"])) for r in df.collect()))
    for read in (records.read_files(index, f"{tmp_path}/r"), records.read_shuffled(index, f"{tmp_path}/r", 7)):
        rows = records.with_starts(read, index).collect()
        got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, [*struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"])]) for r in rows)
        assert got == want
        rows.sort(key=lambda r: r["start"])
        keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows]
        assert keys == sorted(keys)
        at = 0
        for r in rows:
            assert r["start"] == at
            at += len(r["ids"]) // 4


def test_empty_table(spark, tmp_path):
    index = records.write_records(empty(spark), f"{tmp_path}/r", PATH)
    assert records.with_starts(records.read_files(index, f"{tmp_path}/r"), index).count() == 0
    assert records.read_shuffled(index, f"{tmp_path}/r", 7).count() == 0
    assert queries.op3_length_delimited_records(spark, save(empty(spark), tmp_path)).count() == 0


def test_damage_is_noticed():
    record = records.frame(5, b"\x01\0\0\0")
    assert records.parse(record) == (5, b"\x01\0\0\0")
    for at in range(len(record)):
        broken = bytearray(record)
        broken[at] ^= 4
        with pytest.raises((ValueError, struct.error)):
            records.parse(bytes(broken))


@pytest.mark.parametrize("partitions", [8, 16])
def test_each_file_is_read_by_a_task_of_its_own(spark, tmp_path, partitions):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set(key, "false")  # files as many as partitions, although small
        docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
        index = records.write_records(docs, f"{tmp_path}/r", PATH)
    finally:
        spark.conf.unset(key)
    try:
        tasks = records.read_files(index, f"{tmp_path}/r").selectExpr("file", "spark_partition_id() AS task").distinct().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(tasks) == len({r["file"] for r in tasks}) == len({r["task"] for r in tasks}) == partitions


def variant(tmp_path, name, change):
    told = json.loads(open(PATH, encoding="utf-8").read())
    change(told)
    path = tmp_path / f"{name}.json"
    path.write_text(json.dumps(told), encoding="utf-8")
    return str(path)


def test_other_tokenizers_take_whole_texts(spark, tmp_path):
    def prefix(told):
        told["pre_tokenizer"]["add_prefix_space"] = True

    def lower(told):
        told["normalizer"] = {"type": "Lowercase"}

    def loose(told):
        told["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

    assert records.plain_byte_level(Tokenizer.from_file(PATH))
    texts = ["hello world", "Hello  World again and again.\nAnd", " x", "", "the the the"]
    for name, change in (("prefix", prefix), ("lower", lower), ("loose", loose)):
        path = variant(tmp_path, name, change)
        own = Tokenizer.from_file(path)
        assert not records.plain_byte_level(own)
        got = records.library_table(path).ids(texts)
        assert got == [struct.pack(f"<{len(i)}I", *i) for i in (own.encode(t, add_special_tokens=False).ids for t in texts)]


def test_a_folder_that_tasks_cannot_write_to_fails_early(spark):
    with pytest.raises(ValueError, match="unknown"):
        records.write_records(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "unknown://store/r", PATH)


class Counting(dict):
    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return dict.get(self, key, default)

    def __getitem__(self, key):
        self.asked += 1
        return dict.__getitem__(self, key)


def test_units_and_words_are_looked_up_once_a_call(tokenizer):
    table = UnitTable(records.LibraryUnits(tokenizer))
    table.after_blank = Counting()
    texts = ["a" + " river, and" * 1000, "a" + " river. river" * 1000]
    assert table.ids(texts) == records.whole_ids(tokenizer, texts)
    assert table.after_blank.asked < 10  # 4,000 units

    library, asked = tokenizer.model, []

    class Model:
        def tokenize(self, word):
            asked.append(word)
            return library.tokenize(word)

    units = records.LibraryUnits(tokenizer)
    units.model = Model()
    forms = [" river", " river,", " river.", " river.\nriver", " river\nriver,"]
    assert units(forms) == records.whole_ids(tokenizer, forms)
    assert len(asked) == 2  # with and without the blank


@pytest.mark.parametrize("limit", [0, 3, 1000])
def test_units_of_texts_with_odd_blanks(tokenizer, limit):
    pieces = ["a", "bé", "中", "x.", "y,\nz", "\n", "\t", "", "", " ", "　w", "don't", "9", "é" * 70, "<|endoftext|>", "\r\n"]
    draw = random.Random(5)
    texts = [" ".join(draw.choices(pieces, k=draw.randrange(9))) for _ in range(600)]
    table = UnitTable(records.LibraryUnits(tokenizer), limit)
    for at in (0, 200, 400):
        batch = texts[at : at + 200]
        assert table.ids(batch) == records.whole_ids(tokenizer, batch)
        assert len(table.after_blank) <= limit
    assert table.ids([]) == [] and table.ids([""]) == [b""]
