"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level a row draws a number for every child of the node it stands in, -ln(u) / weight with
u from a hash of the row's key and the child's name, and goes to the child with the lowest. A
draw depends on nothing but key, child and the child's weight, so a changed weight moves rows
only into or out of the subtrees whose weights changed; all others keep their order.

``tree_of`` builds the tree for a number of shards: a base of equal regions, and every shard
beyond the base as a region of its own. So a further shard changes no other weight and takes rows
only into itself, by its share of the total weight.

Slots number the rows of a shard from 0 without gaps. A shard is cut into buckets by hash, rows
are numbered inside buckets, and a bucket starts where those before it end; no task holds a whole
shard.

Defined cases: rows with a null key all draw alike and share a shard, their buckets still differ
by text; repeated rows have one shard and slots next to each other; an empty table gives an empty
result; input columns with the names of added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from cabrank.llm.arrow import put, written

BASE_REGIONS, BASE_RACKS, BASE_SHARDS = 2, 3, 4
BUCKETS = 1024
_UNIT = float(1 << 52)


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; only shards have a number and a weight of their own."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int = -1
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree_of(
    shards: int, regions: int = BASE_REGIONS, racks: int = BASE_RACKS, per_rack: int = BASE_SHARDS
) -> Node:
    """The tree of 0 .. shards - 1: base regions filled in order, then one region per shard."""
    per_region = racks * per_rack

    def leaf(i: int) -> Node:
        return Node(f"s{i}", shard=i)

    tops = []
    for g in range(regions):
        mine = range(g * per_region, min(shards, (g + 1) * per_region))
        groups = [[i for i in mine if i // per_rack % racks == r] for r in range(racks)]
        kids = [Node(f"g{g}r{r}", tuple(map(leaf, x))) for r, x in enumerate(groups) if x]
        if kids:
            tops.append(Node(f"g{g}", tuple(kids)))
    for i in range(regions * per_region, shards):
        tops.append(Node(f"x{i}", (Node(f"x{i}r", (leaf(i),)),)))
    return Node("root", tuple(tops))


def _uniform(key: Column, name: str) -> Column:
    """In (0, 1), from the first 52 bits of an md5: the same on every engine."""
    digits = F.substring(F.md5(F.concat_ws("|", key, F.lit(name))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(_UNIT)


def _draw(key: Column, node: Node) -> Column:
    """The name of the child that the key goes to."""
    if len(node.children) == 1:
        return F.lit(node.children[0].name)
    draws = [
        F.struct((-F.ln(_uniform(key, c.name)) / F.lit(c.weight)).alias("d"), F.lit(c.name).alias("n"))
        for c in node.children
    ]
    return F.array_min(F.array(*draws))["n"]


def _level(key: Column, at: Column, nodes: list[Node]) -> Column:
    """Draw inside the one of ``nodes`` that ``at`` names; only its branch is evaluated."""
    drawn = F
    for node in nodes:
        drawn = drawn.when(at == node.name, _draw(key, node))
    return drawn


def place(df: DataFrame, key: str, tree: Node) -> DataFrame:
    """``df`` with region, rack and shard."""
    text_key = F.coalesce(F.col(key).cast("string"), F.lit(""))
    racks = [rack for region in tree.children for rack in region.children]
    numbers = {leaf.name: leaf.shard for rack in racks for leaf in rack.children}
    down = put(df, region=_draw(text_key, tree))
    down = put(down, rack=_level(text_key, F.col("region"), list(tree.children)))
    down = put(down, shard=_level(text_key, F.col("rack"), racks))
    pairs = [F.lit(x) for item in numbers.items() for x in item]
    return put(down, shard=F.create_map(*pairs)[F.col("shard")].cast("int"))


def number_slots(df: DataFrame, shard: str, order: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``slot``: rows of a shard from 0, ordered by bucket and then ``order``.

    The placed rows are written once; their counts and numbers are both taken from there.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]
    spread = F.conv(F.substring(F.md5(F.concat_ws("|", *names)), 1, 8), 16, 10).cast("long")
    rows = written(put(df, bucket=(spread % buckets).cast("int")), "shards")
    counts = rows.groupBy(shard, "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy(shard).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        shard, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("bucket_start")
    )
    inside = Window.partitionBy(shard, "bucket").orderBy(*[F.asc_nulls_first(c) for c in order])
    numbered = rows.withColumn("row_in_bucket", F.row_number().over(inside) - 1)
    # At most shards * buckets rows of three numbers: the broadcast does not grow with the data.
    joined = numbered.join(F.broadcast(starts), [shard, "bucket"])
    slot = F.col("bucket_start") + F.col("row_in_bucket")
    return put(joined, slot=slot.cast("long")).drop("bucket", "bucket_start", "row_in_bucket")


def assign(
    df: DataFrame, key: str, shards: int, order: list[str], buckets: int = BUCKETS
) -> DataFrame:
    """``df`` with region, rack, shard, slot and grown_shard (the shard if there were one more)."""
    grown = place(df, key, tree_of(shards + 1)).withColumnRenamed("shard", "grown_shard")
    placed = place(grown, key, tree_of(shards))
    return number_slots(placed, "shard", order, buckets)


def write_shards(assigned: DataFrame, path: str) -> None:
    """Write rows with their shard and slot as one directory per shard; AQE splits the files.

    Without rows there is no directory, but one empty file that keeps the columns.
    """
    seen = Observation()
    rows = assigned.observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(path)
    if not seen.get["rows"]:
        assigned.limit(0).write.mode("overwrite").parquet(path)
