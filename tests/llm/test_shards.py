import collections
import zlib

from cabrank.llm import queries, shards
from conftest import TESTDATA
from frames import awkward, empty, save


def gapless(rows):
    slots = collections.defaultdict(list)
    for row in rows:
        slots[row["shard"]].append(row["slot"])
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query_places_every_row_and_growth_moves_only_into_the_new_shard(spark):
    rows = queries.op1_weighted_hash_tree(spark, f"{TESTDATA}/sf0.01").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts) and gapless(rows)
    assert {r["shard"] for r in rows} == set(range(24))
    assert {r["law"] for r in rows} == {"key"}
    moved = [r for r in rows if r["grown_shard"] != r["shard"]]
    assert moved and {r["grown_shard"] for r in moved} == {24}
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))


def test_weights_decide_the_shares_and_confine_movement(spark):
    def tree(weight):
        racks = [
            shards.Node(f"r{k}", tuple(shards.Node(f"s{k}{i}", shard=2 * k + i, own_weight=weight if (k, i) == (0, 0) else 1.0) for i in range(2)))
            for k in range(4)
        ]
        return shards.Node("root", (shards.Node("g0", tuple(racks[:2])), shards.Node("g1", tuple(racks[2:]))))

    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    one = {r["doc_id"]: r for r in shards.place(ids, "doc_id", tree(1.0)).collect()}
    two = {r["doc_id"]: r for r in shards.place(ids, "doc_id", tree(3.0)).collect()}
    share = collections.Counter(r["shard"] for r in two.values())
    assert abs(share[0] / 20_000 - 0.3) < 0.02 and abs(share[7] / 20_000 - 0.1) < 0.02
    for key, before in one.items():
        after = two[key]
        if after["region"] != before["region"]:
            assert after["region"] == "g0"
        elif after["rack"] != before["rack"]:
            assert after["rack"] == "r0"
        elif after["shard"] != before["shard"]:
            assert after["shard"] == 0
    assert all(one[k]["shard"] == two[k]["shard"] for k in one if two[k]["region"] == "g1")


def test_every_growth_step_keeps_the_law(spark):
    ids = spark.range(2_000).withColumnRenamed("id", "doc_id")
    for n in (1, 5, 12, 24, 25, 30):
        if n >= 24:
            old = {r["doc_id"]: r["shard"] for r in shards.place(ids, "doc_id", shards.tree_of(n)).collect()}
            new = {r["doc_id"]: r["shard"] for r in shards.place(ids, "doc_id", shards.tree_of(n + 1)).collect()}
            assert all(new[k] in (old[k], n) for k in old)
        else:
            got = {r["shard"] for r in shards.place(ids, "doc_id", shards.tree_of(n)).collect()}
            assert got == set(range(n))


def test_awkward_rows_and_clashing_names(spark, tmp_path):
    df = awkward(spark, ("Shard", "slot", "region", "bucket"))
    out = shards.assign(df, "doc_id", 24, ["doc_id", "text"])
    rows = out.collect()
    assert len(rows) == 13 and gapless(rows)
    assert sorted(c.lower() for c in out.columns).count("shard") == 1
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert shards.assign(empty(spark), "doc_id", 24, ["doc_id"]).count() == 0
    rows = queries.op1_weighted_hash_tree(spark, save(awkward(spark), tmp_path)).collect()
    assert [(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] == 2] == [(8, 0)]


def test_written_shards_hold_all_rows(spark, tmp_path):
    out = shards.assign(awkward(spark), "doc_id", 24, ["doc_id", "text"])
    shards.write_shards(out, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 13


def test_written_shards_are_read_back_also_without_rows(spark, tmp_path):
    for df in (awkward(spark), empty(spark)):
        placed = shards.assign(df, "doc_id", 24, ["doc_id", "text"])
        shards.write_shards(placed, f"{tmp_path}/shards")
        back = spark.read.parquet(f"{tmp_path}/shards")
        assert set(back.columns) == set(placed.columns)
        order = [c for c in placed.columns if c != "shard"]
        same = lambda d: sorted(map(repr, map(tuple, d.select("shard", *order).collect())))
        assert same(back) == same(placed)
