"""MinHash near-duplicates by a multi-index Hamming join.

A text's set of shingles becomes a signature of ``SYMBOLS`` MinHash symbols of 14 bits. Two sets of
Jaccard similarity s agree in each symbol with probability s, so similar sets have signatures at a
small distance (number of symbols that differ). The signature is split into ``CHUNKS`` chunks. By
the pigeonhole principle two signatures at a distance below 2 * CHUNKS have a chunk with at most
one error, so each chunk is indexed under all of its symbols but one, for each one: signatures
that agree in such a key are candidates. All pairs at a distance of at most 23 are candidates for
certain; at a similarity of 0.8 a pair is missed with a probability below 3e-6.

Equal sets are joined first and go on as one node, the smallest doc_id. Of a bucket (the nodes of
one key) only links that can join components matter:

1. each node against a leader, which each bucket picks by its own hash, the closest one first;
2. the other pairs of node and leader, as far as they are still in different components (of a
   node's buckets with more than ``SMALL`` nodes, only one counts here);
3. every pair that is still in different components: in a bucket of up to ``SMALL`` nodes as a
   join whose condition includes the signature distance; larger buckets are put together, with
   all that share nodes, and their nodes compared in tiles, which return links only.

A candidate pair is confirmed on the full sets. What is left out are pairs already known to be in
one component, and candidates at a signature distance beyond ``MAX_DISTANCE``, which a pair of
similarity 0.8 exceeds with a probability below 1e-9. Up to this and the candidates' own chance of
3e-6, no link between components is lost.

The rows that are made grow with the nodes but for families of large mixed buckets: a family of n
nodes is compared in tiles of two blocks of ``BLOCK``, and each node is sent, with its set, to one
tile for each block, n * n / ``BLOCK`` rows in all. A tile holds the sets of two blocks; they are
bounded by number, not by the length of the texts.

Lists of keys and nodes are broadcast as arrays up to ``BROADCAST`` entries of 8 or 16 bytes, and
joined by shuffles beyond that.

Defined cases: a null or blank text has no set, is linked with nothing and kept; a text of one
word has that word as its only shingle; a null doc_id takes no part, is its own (null) component
and kept; repeated rows have one component, kept alike; rows of one doc_id with different texts
are judged text by text, and together where that doc_id is the smallest of both sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.llm.arrow import LOWER, append, as_bytes, col, put, slices, written
from cabrank.llm.components import components

SYMBOLS, CHUNKS = 72, 12
WIDTH = SYMBOLS // CHUNKS
# A bucket of more nodes is compared in tiles, of up to about twice BLOCK nodes.
SMALL = 64
BLOCK = 512
# Beyond this distance a pair of similarity 0.8 (mean 14.4, deviation 3.4) is out of the question.
MAX_DISTANCE = 36
SHINGLE = 2
PERCENT = 80
BROADCAST = 2_000_000
SEED = 20_111

_A, _B, _C, _D = (
    np.uint64(x)
    for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0x165667B19E3779F9)
)
_MASK = (1 << 63) - 1
# Four symbols share 60 bits of a long, in lanes of 15 with the highest bit free.
LANES = 4
_ONES = sum(0x3FFF << 15 * i for i in range(LANES))
_HIGH = sum(0x4000 << 15 * i for i in range(LANES))

SIGNED = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_digest", T.BinaryType()),
        T.StructField("signature", T.ArrayType(T.LongType())),
    ]
)


def multipliers() -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _C
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """Distinct 64-bit shingle hashes of each text, sorted."""
    split = [text.translate(LOWER).split() for text in texts]
    words = np.empty(sum(map(len, split)), object)
    words[:] = [word for own in split for word in own]
    hashes = pd.util.hash_array(words, categorize=False)
    sets, at = [], 0
    for own in split:
        part = hashes[at : at + len(own)]
        at += len(own)
        size = min(width, len(part))
        if not size:
            sets.append(part)
            continue
        rolled = np.full(len(part) - size + 1, size, np.uint64)
        for j in range(size):
            rolled = (rolled * _A) ^ (_mixed(part[j : len(part) - size + 1 + j]) * _B)
        sets.append(np.unique(_mixed(rolled)))
    return sets


def symbols(hashes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """14 bits of the least product for each multiplier, from a set that is not empty."""
    least = np.full(len(by), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 2048):
        least = np.minimum(least, (by[:, None] * hashes[None, start : start + 2048]).min(axis=1))
    return ((least >> np.uint64(20)) & np.uint64(0x3FFF)).astype(np.int64)


def packed(signature: np.ndarray) -> np.ndarray:
    """Symbols (in the last axis) in lanes of longs."""
    lanes = signature.reshape(*signature.shape[:-1], -1, LANES)
    return (lanes << (15 * np.arange(LANES))).sum(axis=-1)


def unpacked(longs: np.ndarray) -> np.ndarray:
    lanes = longs[..., None] >> (15 * np.arange(LANES)) & 0x3FFF
    return lanes.reshape(*longs.shape[:-1], -1)


def distance(one: str, two: str) -> Column:
    """How many symbols of two packed signatures differ, as a Spark expression.

    A lane of the xor plus 0x3FFF has its highest bit set unless it is 0.
    """
    total = F.lit(0)
    for i in range(SYMBOLS // LANES):
        x = F.get(F.col(one), F.lit(i)).bitwiseXOR(F.get(F.col(two), F.lit(i)))
        total = total + F.bit_count((x + F.lit(_ONES)).bitwiseAND(F.lit(_HIGH)))
    return total


def _signed(texts: list[bytes], width: int) -> list[pa.Array]:
    by = multipliers()
    sets = shingle_sets(texts, width)
    return [
        pa.array(map(len, sets), pa.int64()),
        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
        pa.array([packed(symbols(s, by)) if len(s) else [] for s in sets], pa.list_(pa.int64())),
    ]


def signed(docs: DataFrame, text: str, width: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_shingles, set_digest and signature."""

    def compute(texts: pa.Array) -> list[pa.Array]:
        return _signed(as_bytes(texts), width)

    return append(docs, [text], compute, SIGNED, keep)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """A row of keys for each row of symbols: each chunk under all its symbols but one."""
    chunks = signatures.astype(np.uint64).reshape(len(signatures), CHUNKS, WIDTH)
    keys = np.empty((len(signatures), CHUNKS, WIDTH), np.uint64)
    chunk = np.arange(CHUNKS, dtype=np.uint64)[None, :]
    for left_out in range(WIDTH):
        key = (chunk * np.uint64(WIDTH) + np.uint64(left_out + 1)) * _D
        for j in range(WIDTH):
            if j != left_out:
                key = _mixed(key * _A + chunks[:, :, j] * _B)
        keys[:, :, left_out] = key
    return keys.reshape(len(signatures), CHUNKS * WIDTH).view(np.int64)


def _key_batch(batch: pa.RecordBatch, among: np.ndarray | None) -> pa.RecordBatch:
    """(key, node) of a batch of (node, signature), all or those ``among`` some sorted keys."""
    longs = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, SYMBOLS // LANES)
    keys = chunk_keys(unpacked(longs)).ravel()
    nodes = np.repeat(batch.column(0).to_numpy(), CHUNKS * WIDTH)
    if among is not None:
        at = np.searchsorted(among, keys)
        found = among[np.minimum(at, len(among) - 1)] == keys if len(among) else np.zeros(len(keys), bool)
        keys, nodes = keys[found], nodes[found]
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], names=["key", "node"])


def index_keys(nodes: DataFrame, among=None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                yield _key_batch(batch.slice(start, 2000), None if among is None else among.value)

    return nodes.select("node", "signature").mapInArrow(run, "key long, node long")


def buckets_of(nodes: DataFrame, bound: int = BROADCAST) -> DataFrame:
    """(key, node, leader, n) of every key that at least two nodes share, written; n is how many."""
    spark = nodes.sparkSession
    code = F.col("node").bitwiseXOR(F.col("key").bitwiseAND(F.lit(_MASK)))
    shared = (
        index_keys(nodes)
        .select("key", code.alias("code"))
        .groupBy("key")
        .agg(F.min("code").alias("low"), F.max("code").alias("high"), F.count("*").alias("n"))
        .where("low != high")
    )
    leader = F.col("low").bitwiseXOR(F.col("key").bitwiseAND(F.lit(_MASK)))
    shared = written(shared.select("key", leader.alias("leader"), "n"), "shared-keys")
    if shared.count() <= bound:
        among = np.sort(shared.select("key").toArrow()["key"].to_numpy())
        own = index_keys(nodes, spark.sparkContext.broadcast(among))
    else:
        own = index_keys(nodes)
    return written(own.join(shared, "key"), "buckets")


def full_sets(docs: DataFrame, wanted: DataFrame, text: str, width: int, bound: int = BROADCAST) -> DataFrame:
    """(node, shingles) of the documents whose doc_id is among the wanted nodes, written."""
    rows = docs.select(F.col("doc_id").cast("long").alias("node"), col(text).alias("text"))
    rows = rows.where("node is not null")
    if wanted.count() <= bound:
        ids = np.sort(wanted.toArrow()["node"].to_numpy())
        among = docs.sparkSession.sparkContext.broadcast(ids)
    else:
        rows, among = rows.join(wanted, "node", "left_semi"), None

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if among is not None:
                batch = batch.filter(pa.array(_among(batch.column(0), among.value)))
            for part in slices(batch, 1):
                yield _set_batch(part, width)
            pa.default_memory_pool().release_unused()

    return written(rows.mapInArrow(sets, "node long, shingles array<long>"), "sets")


def _among(column: pa.Array, ids: np.ndarray) -> np.ndarray:
    own = column.to_numpy()
    if not len(ids):
        return np.zeros(len(own), bool)
    return ids[np.minimum(np.searchsorted(ids, own), len(ids) - 1)] == own


def _set_batch(part: pa.RecordBatch, width: int) -> pa.RecordBatch:
    sets = [s.view(np.int64) for s in shingle_sets(as_bytes(part.column(1)), width)]
    columns = [part.column(0), pa.array(sets, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=["node", "shingles"])


def close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures are near enough, with their distance."""
    one = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sig_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sig_b"))
    both = pairs.join(one, "a").join(two, "b")
    rated = both.select("a", "b", distance("sig_a", "sig_b").alias("distance"))
    return rated.where(F.col("distance") <= MAX_DISTANCE)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, written."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    similar = pairs.select("a", "b").join(one, "a").join(two, "b").where(100 * both >= percent * union)
    return written(similar.select("a", "b"), "links")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    one = labels.select(F.col("node").alias("a"), F.col("component").alias("label_a"))
    two = labels.select(F.col("node").alias("b"), F.col("component").alias("label_b"))
    known = pairs.join(one, "a", "left").join(two, "b", "left")
    label = lambda x: F.coalesce(f"label_{x}", x)
    return known.where(label("a") != label("b")).drop("label_a", "label_b")


def _mixed_buckets(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, leader, n, component) of the buckets with nodes of several components."""
    own = buckets.join(labels, "node", "left").select(
        "key", "node", "leader", "n", F.coalesce("component", "node").alias("component")
    )
    mixed = own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return written(own.join(mixed.where("low != high").select("key"), "key", "left_semi"), "mixed")


def _small_pairs(own: DataFrame, nodes: DataFrame) -> DataFrame:
    """Near pairs of different components in one bucket, for buckets of few nodes."""
    signed = written(own.join(nodes.select("node", "signature"), "node"), "small")
    one = signed.select("key", *[F.col(c).alias(f"{c}_x") for c in ("node", "component", "signature")])
    two = signed.select("key", *[F.col(c).alias(f"{c}_y") for c in ("node", "component", "signature")])
    near = (
        (one.key == two.key)
        & (F.col("component_x") < F.col("component_y"))
        & (distance("signature_x", "signature_y") <= MAX_DISTANCE)
    )
    pairs = one.join(two, near)
    a, b = F.least("node_x", "node_y"), F.greatest("node_x", "node_y")
    return pairs.select(a.alias("a"), b.alias("b")).distinct()


def _tile_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that join components, between the nodes of two blocks (or inside one)."""
    first, last = rows["low"].iloc[0], rows["high"].iloc[0]
    left = rows[rows["block"] == first].reset_index(drop=True)
    right = left if first == last else rows[rows["block"] == last].reset_index(drop=True)
    root = {c: c for c in rows["component"]}

    def top(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    links = []
    if len(left) and len(right) and len(root) > 1:
        sets = [np.asarray(s, np.int64) for s in right["shingles"]]
        sizes = np.array([len(s) for s in sets])
        hashes = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        for node, component, shingles in zip(left["node"], left["component"], left["shingles"], strict=True):
            own = np.asarray(shingles, np.int64)
            start, end = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
            n = end - start
            at = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            for i in np.flatnonzero(100 * both >= percent * (len(own) + sizes - both)):
                other = top(right["component"].iloc[i])
                if other != top(component):
                    root[other] = top(component)
                    links.append((int(node), int(right["node"].iloc[i])))
    return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)


def _large_links(own: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join components, among the nodes of large buckets."""
    # A node ties the leaders of its buckets together, so only leaders have to be connected.
    tied = written(
        own.groupBy("node", "component").agg(F.collect_set("leader").alias("leaders")), "tied"
    ).withColumn("hub", F.array_min("leaders"))
    edges = tied.select(F.col("hub").alias("a"), F.explode("leaders").alias("b")).distinct()
    families = components(edges).select(F.col("node").alias("hub"), F.col("component").alias("family"))
    members = tied.drop("leaders").join(families, "hub")
    sizes = members.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "family").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "family",
        "node",
        "component",
        "block",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    )

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        return _tile_links(rows, percent)

    grouped = tiles.join(sets, "node").groupBy("family", "low", "high")
    return written(grouped.applyInPandas(links, "a long, b long"), "links")


def near_links(nodes: DataFrame, docs: DataFrame, text: str, width: int, percent: int, bound: int) -> DataFrame:
    """Links (a, b) of nodes that join all that similar pairs join."""
    buckets = buckets_of(nodes, bound)
    wanted = buckets.select("node").distinct()
    sets = full_sets(docs, wanted, text, width, bound)
    stars = buckets.where("node != leader")
    small = stars.where(F.col("n") <= SMALL).select("node", "leader")
    large = stars.where(F.col("n") > SMALL).groupBy("node").agg(F.min_by("leader", "key").alias("leader"))
    stars = small.union(large).select(
        F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")
    )
    stars = written(close(stars.distinct(), nodes), "stars")
    nearest = lambda x, y: stars.groupBy(x).agg(F.min_by(y, F.struct("distance", y)).alias(y))
    first = nearest("a", "b").select("a", "b").union(nearest("b", "a").select("a", "b")).distinct()
    links = confirmed(first, sets, percent)
    labels = components(links)
    second = confirmed(_apart(stars, labels), sets, percent)
    links = links.union(second)
    mixed = _mixed_buckets(buckets, components(links))
    rest = _small_pairs(mixed.where(F.col("n") <= SMALL), nodes).join(stars, ["a", "b"], "left_anti")
    third = confirmed(rest, sets, percent)
    fourth = _large_links(mixed.where(F.col("n") > SMALL), sets, percent)
    return links.union(third).union(fourth)


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    width: int = SHINGLE,
    percent: int = PERCENT,
    bound: int = BROADCAST,
) -> DataFrame:
    """``docs`` with n_shingles, component_id and kept (doc_id is the smallest of its component)."""
    rows = written(signed(docs, text, width, keep), "signatures")
    usable = rows.where("n_shingles > 0 and doc_id is not null")
    nodes = written(
        usable.groupBy("set_digest").agg(
            F.min("doc_id").alias("node"), F.first("signature").alias("signature")
        ),
        "nodes",
    )
    labels = components(near_links(nodes, docs, text, width, percent, bound))
    of_set = nodes.join(labels, "node", "left").select(
        "set_digest", F.coalesce("component", "node").alias("component_id")
    )
    own = [c for c in rows.columns if c.lower() not in ("set_digest", "signature", "component_id", "kept")]
    joined = rows.join(of_set, "set_digest", "left").select(
        *[col(c) for c in own],
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )
    return put(joined, kept=F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id, with its columns.

    Rows that share a doc_id, or have none, are documents of their own: the rows are numbered, and
    one row of each group stays. A row without doc_id stays only where no other row of its group
    has one. Rows without words are no duplicates of anything.
    """
    names = docs.columns
    ids = names.index("doc_id")
    inner = ["doc_id" if i == ids else f"d{i}" for i in range(len(names))]
    plain, text = docs.toDF(*inner), f"d{names.index('text')}"
    if plain.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return near_duplicates(plain, text, **options).where("kept").select(*inner).toDF(*names)
    given = [c if c != "doc_id" else "given" for c in inner]
    numbered = plain.toDF(*given).withColumn("doc_id", F.monotonically_increasing_id())
    numbered = written(numbered, "numbered")
    groups = near_duplicates(numbered.select("doc_id", "given", text), text, ["doc_id", "given"], **options)
    order = F.struct(F.col("given").isNull(), "given", "doc_id")
    kept = groups.groupBy("component_id").agg(F.min_by("doc_id", order).alias("doc_id"))
    return numbered.join(kept, "doc_id", "left_semi").select(*given).toDF(*names)
