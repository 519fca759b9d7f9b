"""Prefix trie of conversations, by union-find over the LCP edges of sorted neighbours.

A turn is the 16-byte digest of its role and text, a conversation the row of its digests. The
conversations are sorted by these rows, so all that share a first part lie side by side, and the
longest common prefix (LCP) of two neighbours is an edge between them. Inside a block of sorted
conversations the edges are taken in descending depth: an edge unites two components, and the
union is a branching node at its depth, whose children are what the components had on top. The
turns between a node and its parent are nodes with one child.

Of a block all nodes are final but the prefixes of its first and of its last conversation, which
neighbouring blocks may share. Block forests are contracted to these two paths, and neighbouring
paths are merged: first the blocks of a partition, as they come, then ``FAN`` partitions at a time
until one is left. A path holds what is already known of its nodes, never their members.

Bounds: a task holds one block (``BLOCK_BYTES`` of digests or ``BLOCK_ROWS`` conversations) and
the paths of ``FAN`` partitions; a conversation's own digests, 16 bytes a turn, are one row.
Conversations that end in one node go through as lists of a block's ids, and are hashed as they
come in: the digest of one node's list is by nature one sequential pass.

Defined cases: rows without conv_id are no conversation; a null role or text is empty; turns are
in the order of ``turn``, null first, and by digest where equal; repeated rows are turns of their
own; a table without conversations has no nodes, not even the root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.llm.arrow import written

KEY = 16
FAN = 16
BLOCK_BYTES = 8 * 1024 * 1024
BLOCK_ROWS = 50_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

# kind 0: a final node; its parent's digest is given where the parent was open.
# kind 1: a node of a first (side 0) or last (side 1) path, or of both (side 2), still open.
# kind 2: ids, ascending, that end in an open node.
FOREST = (
    "kind int, part long, block long, side int, digest binary, parent binary, conv_id long, "
    "depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, words long, ends_sha256 string, ids string"
)
NAMES = [field.split()[0] for field in FOREST.split(", ")]


def turn_key(role: Column | str = "role", text: Column | str = "text") -> Column:
    """The digest of a turn, in hex; null as empty."""
    role, text = (F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (role, text))
    return F.md5(F.concat(F.md5(role.cast("binary")), text).cast("binary"))


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id and its steps (turn, key, words) in order; texts are digested where they are read."""
    text = F.coalesce(F.col("text"), F.lit(""))
    step = F.struct(
        F.col("turn"),
        turn_key().alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), step.alias("step")
    )
    # sort_array puts a null first inside the structs as well.
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("step")).alias("steps"))


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, the digests of its turns one after another, and the words of each turn."""
    joined = F.array_join(F.transform("steps", lambda s: s["key"]), "")
    return turns.select(
        "conv_id",
        F.unhex(joined).alias("keys"),
        F.transform("steps", lambda s: s["words"]).alias("words"),
    )


class Step:
    """An open node: what is known of it and of its closed children."""

    __slots__ = ("depth", "digest", "n", "low", "words", "children", "leaves", "saved")

    def __init__(self, depth, digest, n, low, words, children=0, leaves=0, saved=0):
        self.depth, self.digest, self.n, self.low, self.words = depth, digest, n, low, words
        self.children, self.leaves, self.saved = children, leaves, saved


class Paths(NamedTuple):
    """A contracted forest: the nodes of its first and last conversation, by depth.

    Up to ``stem`` both paths have the same nodes.
    """

    first: list[Step]
    last: list[Step]
    stem: int


def _row(kind: int, **values) -> tuple:
    return (kind, *[values.get(name) for name in NAMES[1:]])


def _close(path: list[Step], down_to: int, out: list[tuple]) -> None:
    """Finish the nodes of a path below ``down_to``, the deepest first; their parents learn of it."""
    while len(path) > down_to + 1:
        node = path.pop()
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.n - 1) * node.words
        above = path[-1] if path else None
        out.append(
            _row(
                0, digest=node.digest, parent=above.digest if above else None, conv_id=node.low,
                depth=node.depth, n_convs=node.n, n_children=node.children, n_leaves=leaves,
                saved_tokens=saved,
            )
        )
        if above:
            above.children += 1
            above.leaves += leaves
            above.saved += saved


def merged(left: Paths, right: Paths, out: list[tuple]) -> Paths:
    """Two neighbouring forests as one; nodes on neither outer path are finished.

    The edge between them is the LCP of the left one's last and the right one's first path.
    """
    depth = 0
    for a, b in zip(left.last[1:], right.first[1:]):
        if a.digest != b.digest:
            break
        depth += 1
    _close(left.last, max(depth, left.stem), out)
    _close(right.first, max(depth, right.stem), out)
    for a, b in zip(left.last[: depth + 1], right.first[: depth + 1], strict=True):
        a.n += b.n
        a.low = min(a.low, b.low)
        a.children += b.children
        a.leaves += b.leaves
        a.saved += b.saved
    stem = min(left.stem, depth, right.stem)
    shared = min(depth, right.stem)
    last = left.last[: shared + 1] + right.last[shared + 1 :]
    # The left path's own end: what is neither on the first path nor on the new last one.
    _close(left.last, max(left.stem, shared), out)
    return Paths(left.first, last, stem)


def finish(paths: Paths, out: list[tuple]) -> None:
    _close(paths.last, paths.stem, out)
    _close(paths.first, -1, out)


def _digests(keys: bytes) -> list[bytes]:
    """The digest of every prefix, the empty one first."""
    state = hashlib.md5(usedforsecurity=False)
    out = [state.digest()]
    for at in range(0, len(keys), KEY):
        state.update(keys[at : at + KEY])
        out.append(state.digest())
    return out


def common_turns(one: bytes, two: bytes) -> int:
    n = min(len(one), len(two))
    if one[:n] == two[:n]:
        return n // KEY
    differ = np.frombuffer(one, np.uint8, n) != np.frombuffer(two, np.uint8, n)
    return int(differ.argmax()) // KEY


class Block:
    """The compact trie of sorted conversations: branching nodes and ends."""

    def __init__(self, convs: list[int], keys: list[bytes]):
        n = len(convs)
        lcp = np.array([common_turns(a, b) for a, b in zip(keys, keys[1:])], np.int64)
        self.depth = [len(k) // KEY for k in keys]
        self.n = [1] * n
        self.low, self.first, self.last = list(convs), list(range(n)), list(range(n))
        self.ends: list[list[int]] = [[c] for c in convs]
        self.parent: list[int | None] = [None] * n
        self.gone: set[int] = set()
        above = list(range(n))  # union-find over rows; a root's node is the top of its component
        node = list(range(n))

        def find(i: int) -> int:
            while above[i] != i:
                above[i] = above[above[i]]
                i = above[i]
            return i

        for e in np.argsort(-lcp, kind="stable").tolist():
            d = int(lcp[e])
            a, b = find(e), find(e + 1)
            x, y = node[a], node[b]
            if self.depth[x] > d and self.depth[y] > d:
                top = self._add(d, x)
                self._take(top, y)
                self.parent[x] = self.parent[y] = top
            elif self.depth[x] > d:
                top = y
                self._take(top, x)
                self.parent[x] = top
            else:
                top = x
                self._take(top, y)
                if self.depth[y] > d:
                    self.parent[y] = top
                else:  # equal sequences: one node
                    self.ends[top] += self.ends[y]
                    self.gone.add(y)
            above[b] = a
            node[a] = top
        top = node[find(0)]
        if self.depth[top]:
            self.parent[top] = self._add(0, top)

    def _add(self, depth: int, child: int) -> int:
        self.depth.append(depth)
        for known in (self.n, self.low, self.first, self.last):
            known.append(known[child])
        self.ends.append([])
        self.parent.append(None)
        return len(self.depth) - 1

    def _take(self, top: int, other: int) -> None:
        self.n[top] += self.n[other]
        self.low[top] = min(self.low[top], self.low[other])
        self.first[top] = min(self.first[top], self.first[other])
        self.last[top] = max(self.last[top], self.last[other])


def block_forest(convs: list[int], keys: list[bytes], words: list, part: int, number: int, out: list[tuple]) -> Paths:
    """The final nodes of a block go to ``out``; its two open paths are returned."""
    tree = Block(convs, keys)
    size, end = len(tree.depth), len(convs) - 1
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    digests = _digests(keys[0]), _digests(keys[end])
    paths: tuple[list, list] = ([None] * len(digests[0]), [None] * len(digests[1]))
    for v in sorted(range(size), key=lambda i: -tree.depth[i]):
        if v in tree.gone:
            continue
        up, deep, n, low = tree.parent[v], tree.depth[v], tree.n[v], tree.low[v]
        shallow = -1 if up is None else tree.depth[up]
        row = words[tree.first[v]]
        on = tree.first[v] == 0, tree.last[v] == end
        if any(on):
            names = digests[0] if on[0] else digests[1]
            for k in range(deep, shallow, -1):
                step = Step(k, names[k], n, low, row[k - 1] if k else 0)
                if k == deep:
                    step.children, step.leaves, step.saved = children[v], leaves[v], saved[v]
                for path in (p for p, there in zip(paths, on) if there):
                    path[k] = step
            if tree.ends[v]:
                ids = ",".join(map(str, sorted(tree.ends[v])))
                out.append(_row(2, part=part, block=number, digest=names[deep], ids=ids))
            continue
        total, below = saved[v], leaves[v] if children[v] else 1
        open_up = tree.first[up] == 0 or tree.last[up] == end
        for k in range(deep, shallow, -1):
            total += (n - 1) * row[k - 1]
            top = k == shallow + 1
            ends = NO_ENDS
            if k == deep and tree.ends[v]:
                ids = ",".join(map(str, sorted(tree.ends[v])))
                ends = hashlib.sha256(ids.encode()).hexdigest()
            known = digests[0] if tree.first[up] == 0 else digests[1]
            out.append(
                _row(
                    0, conv_id=low, depth=k, n_convs=n, n_leaves=below, saved_tokens=total,
                    n_children=children[v] if k == deep else 1, ends_sha256=ends,
                    parent=known[shallow] if top and open_up else None,
                    parent_conv_id=low if not top else None if open_up else tree.low[up],
                )
            )
        children[up] += 1
        leaves[up] += below
        saved[up] += total
    stem = common_turns(keys[0], keys[end])
    return Paths(paths[0], paths[1], stem)


def _open_rows(paths: Paths, part: int) -> Iterator[tuple]:
    steps = [(2 if s.depth <= paths.stem else 0, s) for s in paths.first]
    steps += [(1, s) for s in paths.last[paths.stem + 1 :]]
    for side, s in steps:
        yield _row(
            1, part=part, side=side, digest=s.digest, conv_id=s.low, depth=s.depth, n_convs=s.n,
            n_children=s.children, n_leaves=s.leaves, saved_tokens=s.saved, words=s.words,
        )


def _paths_of(rows: pd.DataFrame) -> Paths:
    rows = rows.sort_values("depth")
    sides: dict[int, list[Step]] = {0: [], 1: [], 2: []}
    for r in rows.itertuples(index=False):
        sides[int(r.side)].append(
            Step(
                int(r.depth), bytes(r.digest), int(r.n_convs), int(r.conv_id), int(r.words),
                int(r.n_children), int(r.n_leaves), int(r.saved_tokens),
            )
        )
    stem = sides[2]
    return Paths(stem + sides[0], stem + sides[1], len(stem) - 1)


def _blocks(batches: Iterable[pa.RecordBatch], limit: int, rows: int) -> Iterator[tuple[list, list, list]]:
    convs, keys, words, size = [], [], [], 0
    for batch in batches:
        for conv, key, own in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            if convs and (size + len(key) > limit or len(convs) >= rows):
                yield convs, keys, words
                convs, keys, words, size = [], [], [], 0
            convs.append(conv)
            keys.append(key)
            words.append(own)
            size += len(key)
    if convs:
        yield convs, keys, words


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
_SCHEMA = pa.schema([(f.split()[0], _ARROW[f.split()[1]]) for f in FOREST.split(", ")])


def partition_forests(seqs: DataFrame, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of ``FOREST``: the forests of sorted partitions, numbered in the order of the sort.

    The conversation itself is the last sort key, so copies spread over partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        running, out = None, []
        for number, block in enumerate(_blocks(batches, block_bytes, block_rows)):
            paths = block_forest(*block, part, number, out)
            running = paths if running is None else merged(running, paths, out)
            for at in range(0, len(out), 20_000):
                yield _batch(out[at : at + 20_000], _SCHEMA)
            out = []
        if running is not None:
            yield _batch(list(_open_rows(running, part)), _SCHEMA)

    ranged = seqs.select("conv_id", "keys", "words").repartitionByRange("keys", "conv_id")
    return ranged.sortWithinPartitions("keys", "conv_id").mapInArrow(run, FOREST)


def _level(opened: DataFrame, last: bool) -> DataFrame:
    """``FAN`` neighbouring forests at a time as one."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        running = None
        for _, own in rows.groupby("part", sort=True):
            paths = _paths_of(own)
            running = paths if running is None else merged(running, paths, out)
        if last:
            finish(running, out)
        else:
            out += _open_rows(running, int(rows["part"].iloc[0]) // FAN)
        made = pd.DataFrame(out, columns=NAMES)
        numbers = [f.split()[0] for f in FOREST.split(", ") if f.split()[1] in ("int", "long")]
        return made.astype(dict.fromkeys(numbers, "Int64"))

    return opened.groupBy((F.col("part") / FAN).cast("long").alias("group")).applyInPandas(join, FOREST)


def _hashed(pieces: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of all pieces of each open node, in order, one piece at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.binary()), pa.array([state.hexdigest()])],
                names=["digest", "ends_sha256"],
            )

        for batch in batches:
            for digest, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if digest == now:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    yield done()
                now, state = digest, hashlib.sha256(ids.encode())
        if state is not None:
            yield done()

    laid = pieces.repartition("digest").sortWithinPartitions("digest", "part", "block")
    return laid.select("digest", "ids").mapInArrow(run, "digest binary, ends_sha256 string")


def trie(seqs: DataFrame, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The nodes of the prefix trie of ``sequences``.

    One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves and saved_tokens of its subtree, and ends_sha256 of the members that end in it. The
    node's turns are the first ``depth`` turns of conversation conv_id.
    """
    forests = written(partition_forests(seqs, block_bytes, block_rows), "forests")
    opened = forests.where("kind = 1")
    top = opened.agg(F.max("part")).head()[0]
    final = forests.where("kind = 0")
    while top is not None:
        top //= FAN
        level = written(_level(opened, last=top == 0), "level")
        final = final.union(level.where("kind = 0"))
        if top == 0:
            break
        opened = level.where("kind = 1")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    was_open = final.where("digest is not null").drop("ends_sha256")
    root = was_open.where("depth = 0").agg(F.min("conv_id")).head()[0]
    ended = was_open.join(_hashed(forests.where("kind = 2")), "digest", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))
    )
    own = [*columns, "parent", "ends_sha256"]
    # Rows are joined only by keys they have: null keys would all meet in one task.
    whole = final.where("digest is null and parent is null").select(*own)
    rest = final.where("digest is null and parent is not null").select(*own).union(ended.select(*own))
    known = was_open.select(F.col("digest").alias("parent"), F.col("conv_id").alias("above"))
    below = rest.where("depth > 1").join(known, "parent")
    parts = [
        whole,
        rest.where("depth = 0").select(*own),
        rest.where("depth = 1").withColumn("parent_conv_id", F.lit(root).cast("long")).select(*own),
        below.withColumn("parent_conv_id", F.col("above")).select(*own),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.select(*columns, "ends_sha256")


def member_texts(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` with role and text of their last turn; the root has none.

    For conversations as they are, not rebuilt ones.
    """
    ranked = turns_of(conversations).select("conv_id", F.posexplode("steps").alias("at", "step"))
    at = ranked.select("conv_id", (F.col("at") + 1).cast("long").alias("depth"), F.col("step.key").alias("key"))
    said = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        turn_key().alias("key"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return nodes.join(at, ["conv_id", "depth"], "left").join(
        said.dropDuplicates(["conv_id", "key"]), ["conv_id", "key"], "left"
    ).drop("key")
