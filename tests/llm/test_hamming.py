import collections
import itertools
import random

import numpy as np
import pytest
from cabrank.llm import hamming, queries
from cabrank.llm.components import components
from conftest import TESTDATA
from frames import DOCS, awkward, empty, prose, save


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()


def shingles(text):
    w = lower(text).split()
    return {tuple(w)} if len(w) == 1 else set(zip(w, w[1:]))


def brute(rows, percent=80):
    """Every pair that shares a shingle, on the full sets."""
    sets = [shingles(t) for _, t in rows]
    where = collections.defaultdict(list)
    for i, own in enumerate(sets):
        if rows[i][0] is not None:
            for s in own:
                where[s].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    shared = collections.Counter()
    for own in where.values():
        shared.update(itertools.combinations(own, 2))
    for (i, j), both in shared.items():
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(d, len(sets[i]), None if d is None else least[find(i)], d is None or d == least[find(i)]) for i, (d, _) in enumerate(rows)]


def check(spark, folder, df=None):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op8_multi_index_hamming(spark, folder) if df is None else df
    got = sorted([tuple(r) for r in out.select("doc_id", "n_shingles", "component_id", "kept").collect()], key=repr)
    want = sorted(brute(rows), key=repr)
    assert got == want
    return want


def test_query_equals_brute_force(spark):
    want = check(spark, f"{TESTDATA}/sf0.01")
    assert sum(not r[3] for r in want) > 20


def edited(rng, text, share):
    w = text.split()
    for i in range(len(w)):
        if rng.random() < share:
            w[i] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def chains(spark, tmp_path_factory):
    """A large loose group around the threshold, chains of ever further edits, and copies."""
    rng = random.Random(2)
    texts = [edited(rng, prose(120, 3), 0.05) for _ in range(150)]
    for seed in range(6):
        text = prose(80, 50 + seed)
        for _ in range(12):
            texts.append(text)
            text = edited(rng, text, 0.04)
    texts += [prose(50, 90)] * 40 + ["two words", "Two  words", "word", "WORD", "other"]
    rng.shuffle(texts)
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    return save(spark.createDataFrame(rows, DOCS), tmp_path_factory.mktemp("chains"))


def test_groups_at_the_threshold_equal_brute_force(spark, chains):
    check(spark, chains)


def test_the_way_without_broadcasts_gives_the_same(spark, chains):
    docs = spark.read.parquet(f"{chains}/documents.parquet")
    check(spark, chains, hamming.near_duplicates(docs, bound=0))


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(4)
    one = rng.integers(0, 2**14, hamming.SYMBOLS)
    for _ in range(500):
        two = one.copy()
        at = rng.choice(hamming.SYMBOLS, 2 * hamming.CHUNKS - 1, replace=False)
        two[at] ^= 1
        keys = hamming.chunk_keys(np.array([one, two]))
        assert set(keys[0]) & set(keys[1])


def test_signatures_estimate_similarity():
    texts = [" ".join(f"w{i}" for i in range(a, a + 400)).encode() for a in (0, 44)]
    sets = hamming.shingle_sets(texts)
    exact = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    by = np.random.default_rng(1).integers(1, 2**63, 2000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    one, two = (hamming.symbols(s, by) for s in sets)
    assert (one == two).mean() == pytest.approx(exact, abs=0.04)


def test_distances(spark):
    rng = np.random.default_rng(8)
    one = rng.integers(0, 2**14, (50, hamming.SYMBOLS))
    two = np.where(rng.random(one.shape) < 0.4, one, rng.integers(0, 2**14, one.shape))
    two[0], two[1] = one[0], one[1] ^ 0x3FFF
    assert (hamming.unpacked(hamming.packed(one)) == one).all()
    rows = [(i, hamming.packed(a).tolist(), hamming.packed(b).tolist()) for i, (a, b) in enumerate(zip(one, two))]
    df = spark.createDataFrame(rows, "i int, x array<long>, y array<long>")
    got = dict(map(tuple, df.select("i", hamming.distance("x", "y")).collect()))
    assert got == {i: int((a != b).sum()) for i, (a, b) in enumerate(zip(one, two))}


@pytest.mark.parametrize("small, block", [(2, 7), (2, 1000), (10**6, 5)])
def test_tiles_and_joins_give_the_same(spark, chains, monkeypatch, small, block):
    monkeypatch.setattr(hamming, "SMALL", small)
    monkeypatch.setattr(hamming, "BLOCK", block)
    check(spark, chains)


def test_awkward_rows(spark, tmp_path):
    check(spark, save(awkward(spark), tmp_path))
    assert queries.op8_multi_index_hamming(spark, save(empty(spark), tmp_path)).count() == 0
    df = awkward(spark, ("kept", "Signature", "component_id"))
    kept = hamming.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [-3, 1, 2, 3, 4, 5, 6, 7, 9]


def test_components(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    root = {x: x for p in links if None not in p for x in p}
    for _ in range(len(links)):
        for a, b in links:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    text, other = prose(60, 70), prose(60, 71)
    rows = [(1, text), (1, text), (2, text), (None, text), (None, text), (None, other), (None, other), (7, "of its own"), (None, None), (None, ""), (4, " ")]
    df = spark.createDataFrame([(i, t, "en", "a", n) for n, (i, t) in enumerate(rows)], DOCS).repartition(4)
    kept = hamming.deduplicated(df)
    assert kept.columns == df.columns
    got = sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=repr)
    assert got == sorted([(1, text), (None, other), (7, "of its own"), (None, None), (None, ""), (4, " ")], key=repr)
