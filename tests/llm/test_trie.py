import hashlib
import random
import re
import zlib

import pytest
from cabrank.llm import queries, trie
from cabrank.llm.oracle import ORACLE
from compare import connect, differences
from conftest import TESTDATA

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(convs):
    """Every prefix of every sequence, by dictionaries."""
    members, kids = {}, {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    saved, leaves, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids.get(p, []))
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
    for p, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(p))
        above = min(members[p[:-1]]) if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(own), len(p), above, len(own), len(kids.get(p, [])), leaves[p], saved[p], sha))
    return sorted(out, key=repr)


def originals(rows):
    convs = {}
    for r in rows:
        if r["conv_id"] is not None:
            convs.setdefault(r["conv_id"], []).append(r)
    for c, own in convs.items():
        key = lambda r: hashlib.md5((hashlib.md5((r["role"] or "").encode()).hexdigest() + (r["text"] or "")).encode()).hexdigest()
        own.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0, key(r)))
        convs[c] = [(r["role"] or "", r["text"] or "") for r in own]
    return convs


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        base, h = c - (abs(c) % 20) * (1 if c >= 0 else -1), zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def collected(nodes):
    assert nodes.columns == COLUMNS
    return sorted([tuple(r) for r in nodes.collect()], key=repr)


@pytest.fixture
def apart(spark):
    """Small inputs over many partitions."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    yield
    spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_query_equals_brute_force_and_sql(spark):
    folder = f"{TESTDATA}/sf0.01"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    got = queries.op11_prefix_trie(spark, folder)
    assert collected(got) == brute(rebuilt(originals(rows)))
    assert differences(got, connect(folder), ORACLE["op11_prefix_trie"]) is None


@pytest.mark.parametrize("kinds, deep, block", [(2, 6, 10**6), (3, 9, 64), (1, 7, 10**6)])
def test_merges_across_blocks_and_partitions(spark, apart, kinds, deep, block):
    rng = random.Random(kinds)
    convs = {}
    for c in range(300):
        convs[3 * c - 40] = [(rng.choice("ab"), f"x {rng.randrange(kinds)}  y\n") for _ in range(rng.randrange(1, deep))]
    convs |= {c: [("a", "hot one"), ("b", "x")] for c in range(2000, 2200)}
    rows = [(c, t, r, x) for c, own in convs.items() for t, (r, x) in enumerate(own)]
    rng.shuffle(rows)
    seqs = trie.sequences(trie.turns_of(spark.createDataFrame(rows, SCHEMA)))
    assert collected(trie.trie(seqs, block_bytes=block, block_rows=50)) == brute(convs)


def test_a_very_long_conversation(spark, apart):
    long = [("user", f"w{i}") for i in range(3000)]
    convs = {1: long, 2: long[:2500], 3: long[:2500] + [("user", "other")], 4: [("user", "w0 ")], 5: [("user", "word " * 100_000)]}
    rows = [(c, t, r, x) for c, own in convs.items() for t, (r, x) in enumerate(own)]
    seqs = trie.sequences(trie.turns_of(spark.createDataFrame(rows, SCHEMA)))
    assert collected(trie.trie(seqs, block_rows=2)) == brute(convs)


def awkward(spark):
    rows = [
        (20, None, "system", "zero"),
        (20, 1, None, "one"),
        (20, 1, "user", None),
        (20, 1, None, "one"),
        (23, 0, None, None),
        (23, 0, None, ""),
        (24, 5, "", "\t two  words \r\n"),
        (None, 0, "user", "lost"),
        (None, None, None, None),
        (-3, 0, "user", "élan vital"),
        (40, 7, "a", "b"),
        (41, 7, "ab", ""),
        (57, 2, "x", "y"),
    ]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_awkward_rows(spark, tmp_path):
    rows, df = awkward(spark)
    clashing = df.selectExpr("*", "1 AS depth", "'x' AS digest", "2 AS `steps`", "3 AS `a b`")
    clashing.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    want = originals([dict(zip(("conv_id", "turn", "role", "text"), r)) for r in rows])
    got = queries.op11_prefix_trie(spark, str(tmp_path))
    assert collected(got) == brute(rebuilt(want))
    plain = trie.trie(trie.sequences(trie.turns_of(clashing)))
    assert collected(plain) == brute(want)
    said = {(r["conv_id"], r["depth"]): (r["role"], r["text"]) for r in trie.member_texts(plain, df).collect()}
    assert said == {(c, d): want[c][d - 1] if d else (None, None) for c, d in said}


def test_a_table_without_conversations_has_no_nodes(spark, tmp_path):
    for n, rows in enumerate(([], [(None, 0, "user", "lost")])):
        df = spark.createDataFrame(rows, SCHEMA)
        df.coalesce(1).write.parquet(f"{tmp_path}/{n}/conversations.parquet")
        assert collected(queries.op11_prefix_trie(spark, f"{tmp_path}/{n}")) == []


def test_turnless_conversations_end_in_the_root(spark, tmp_path):
    # No base conversation; all turns of these are replaced by none.
    ids = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][:5]
    df = spark.createDataFrame([(c, 0, "user", "a b") for c in ids], SCHEMA)
    df.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = collected(queries.op11_prefix_trie(spark, str(tmp_path)))
    assert got == brute({c: [] for c in ids}) and len(got) == 1
