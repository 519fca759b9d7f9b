import hashlib
import random
import struct

import public_tokenizers
import pytest
from cabrank.llm import bpe, queries, records
from cabrank.llm.units import UnitTable
from conftest import TESTDATA
from frames import awkward, empty, save
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
BPE = bpe.loaded(PATH)


def library(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


def ours(text, table=BPE.table):
    data = table.ids([text])[0]
    return [*struct.unpack(f"<{len(data) // 4}I", data)]


@pytest.mark.parametrize(
    "text",
    ["", " ", "  ", "a  b", "a\n \n b", " a", "a ", "x<|endoftext|> y<|endoftext|>", "it's  'll \u2003 b",
     "\x1c a", "a\u00a0 b", "½ ² Ⅷ 12", "\U0001f600 \u0301", "aaaa" * 50, "\t\tif  x:\n\n\n    y"],
)
def test_ids_and_text_equal_the_library(text):
    assert ours(text) == library(text)
    assert BPE.decode(BPE.table.ids([text])[0]) == TOKENIZER.decode(library(text), skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\t'sé\u00a0\u2003\x1c1½.<|>_Z\U0001f600"), max_size=40))
def test_random_texts_equal_the_library(text):
    small = UnitTable(BPE.encode_all, limit=3)
    for table in (BPE.table, small, records.library_table(PATH)):
        assert ours(text, table) == library(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abEé.,'s \u0130\u00d7"), max_size=12), max_size=6))
def test_words_equal_the_library(parts):
    text = " ".join(parts)
    for table in (BPE.table, records.library_table(PATH)):
        assert ours(text, table) == library(text)


def test_broken_sequences_decode_as_in_the_library():
    rng = random.Random(3)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        data = struct.pack(f"<{len(ids)}I", *ids)
        assert BPE.decode(data) == TOKENIZER.decode(ids, skip_special_tokens=False)


def test_segment_tree_finds_the_leftmost_lowest():
    rng = random.Random(1)
    for n in (1, 2, 3, 7, 16, 33):
        values = [rng.randrange(5) * 64 + i for i in range(n)]
        tree = bpe.SegmentTree(values[:])
        for _ in range(60):
            assert tree.root() == min(values)
            at = rng.randrange(n)
            values[at] = rng.randrange(5) * 64 + at
            tree.set(at, values[at])


def digest(data):
    return hashlib.sha256(data).hexdigest()


def check(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = []
    for row in docs:
        ids = library(row["text"] or "")
        text = TOKENIZER.decode(ids, skip_special_tokens=False)
        want.append((row["doc_id"], len(ids), digest(struct.pack(f"<{len(ids)}I", *ids)), digest(text.encode())))
    got = [tuple(r) for r in queries.op4_segment_tree_bpe(spark, folder).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query_equals_the_library(spark):
    check(spark, f"{TESTDATA}/sf0.01")


def test_awkward_rows_and_clashing_names(spark, tmp_path):
    check(spark, save(awkward(spark), tmp_path))
    out = bpe.decode(bpe.encode(awkward(spark, ("IDS", "decoded")), PATH), PATH)
    assert [c.lower() for c in out.columns].count("ids") == 1
    assert all(r["decoded"] == (r["text"] or "") for r in out.collect())
    assert bpe.decode(bpe.encode(empty(spark), PATH), PATH).count() == 0
    both = bpe.round_trip(awkward(spark, ("IDS", "decoded")), PATH)
    assert sorted(map(repr, both.collect())) == sorted(map(repr, out.select(both.columns).collect()))
