import hashlib
import pickle
import re
import time

import numpy as np
import pytest
from cabrank.llm import decontaminate, queries
from conftest import TESTDATA
from frames import awkward, empty, prose, save

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    grams = []
    for item_id, text in items:
        w = words(text)
        size = min(window, len(w))
        grams += [("" if item_id is None else str(item_id), tuple(w[i : i + size])) for i in range(len(w) - size + 1) if size]
    index = {}
    for item_id, gram in grams:
        index.setdefault(gram, set()).add(item_id)
    sizes = {len(g) for g in index}
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                ids = index.get(tuple(w[i : i + size]))
                if ids:
                    hit.update(range(i, i + size))
                    found |= ids
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return out


def check(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = [tuple(r) for r in queries.op9_decontaminate_windows(spark, folder).collect()]
    want = brute(docs, items)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return want


def test_query_equals_brute_force(spark):
    want = check(spark, f"{TESTDATA}/sf0.01")
    assert any(row[-1] for row in want)


@pytest.fixture
def odd(spark, tmp_path):
    items = [(1, prose(14, 1).upper()), (2, "one"), (3, None), (None, "Élan vital"), (5, "... !"), (6, "one"), (7, prose(300, 5))]
    save(spark.createDataFrame(items, "item_id long, text string"), tmp_path, "benchmark")
    return save(awkward(spark), tmp_path)


def test_awkward_rows(spark, odd):
    want = {row[0]: row for row in check(spark, odd)}
    assert want[-3][3] == 2 and want[6][2] == 2 and want[1][5] and not want[2][5]


def test_blocks_of_the_benchmark_give_the_same(spark, odd):
    docs, items = spark.read.parquet(f"{odd}/documents.parquet"), spark.read.parquet(f"{odd}/benchmark.parquet")
    one = decontaminate.find_hits(docs, items)
    many = decontaminate.find_hits(docs, items, block_bytes=400)
    key = lambda df: sorted(map(repr, df.select("doc_id", "n_words", "hit_spans", "hit_items").collect()))
    assert key(one) == key(many)
    narrow = decontaminate.find_hits(docs, items, keep=["doc_id"], block_bytes=400)
    assert key(one) == key(narrow)


def test_removal(spark, odd):
    docs, items = awkward(spark, ("n_words", "hit_spans")), spark.read.parquet(f"{odd}/benchmark.parquet")
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [2, 3, 4, 7, 9]
    cut = decontaminate.decontaminate(docs, items, remove="spans")
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert cut.columns == docs.columns and len(texts) == 11
    assert texts[-3] == "" and texts[2] is None and texts[6].startswith(", naïve\u2003")
    assert not any(r[-1] for r in brute(list(texts.items()), [(r["item_id"], r["text"]) for r in items.collect()]))


def test_empty_tables(spark, odd):
    items = spark.read.parquet(f"{odd}/benchmark.parquet")
    assert decontaminate.find_hits(empty(spark), items).count() == 0
    none = items.limit(0)
    assert decontaminate.decontaminate(awkward(spark), none).count() == 13


def test_a_full_block_is_compact(spark):
    """Windows of 16 MB of items: built once, loaded by workers as arrays, few false lookups."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i:05d}" for i in range(50_000)]
    items = [(str(i), " ".join(vocabulary[j] for j in rng.integers(0, 50_000, 2000)).encode()) for i in range(1200)]
    index = decontaminate.WindowIndex(items, 10)
    data = pickle.dumps(index)
    assert sum(len(t) for _, t in items) > 16e6 and len(data) < 200e6
    start = time.process_time()
    loaded = pickle.loads(data)
    assert time.process_time() - start < 3
    windows = loaded.windows[10]
    assert len(windows.hashes) == 1200 * 1991
    assert np.unpackbits(windows.table).mean() < 0.07
    foreign = " ".join(vocabulary[j] for j in rng.integers(0, 50_000, 200_000)).encode()
    assert list(windows.candidates(decontaminate._rolled(decontaminate._hashes(decontaminate.words_of(foreign)), 10))) == []
    own = b" ".join([b"before", *decontaminate.words_of(items[7][1])[100:130], b"after"])
    assert loaded.scan([own], [([], [])])[1:] == ([[{"start": 1, "end": 31}]], [["7"]])


def test_equal_hashes_are_told_apart_by_their_words(monkeypatch):
    monkeypatch.setattr(decontaminate, "_hashes", lambda words: np.full(len(words), 7, np.uint64))
    index = decontaminate.WindowIndex([("a", b"one two three"), ("b", b"four five six"), ("c", b"one two three")], 3)
    _, spans, items = index.scan([b"x one two three y", b"four five seven six"], [([], []), ([], [])])
    assert spans == [[{"start": 1, "end": 4}], []] and items == [["a", "c"], []]
