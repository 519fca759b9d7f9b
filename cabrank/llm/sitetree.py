"""Main text of web pages by the style tree of their site.

The block trees of all pages of a host are merged: elements at the same place below the same
styles (the labels of their siblings) are one node. A node's presentation importance is the entropy
of the styles that the host's pages have there, to the base of the number of pages; where it has no
more elements, its content importance is the entropy of the texts. So what is the same on all pages
has importance 0, and what differs on each has 1. The composite importance of an inner node weighs
its own by 1 - GAMMA^l, l being its number of styles, and the mean of its children by GAMMA^l, from
the deepest level up. A branch all of whose nodes stay below ``THRESHOLD`` is removed from the
pages.

Entropy needs pages: nodes with fewer than ``LEAST_PAGES`` count as important. What elements say
about themselves works as a prior in every site, however small: importance is at most 1, so
elements that declare themselves menus, footers, adverts, forms, comments and the like
(``dom``) are below any threshold and are never looked up, and the paragraphs of a declared article
are above it; the tree decides on all other branches. Pages with the same longest block are copies
and count once, so copied articles do not look like boilerplate.

The work on pages is one pass over their text; tree and lookups are joins and aggregations. All
sums are pre-aggregated, so a host may hold any share of the pages. ``MAX_DEPTH`` bounds the tree,
not the text: deeper elements belong to the branch they are in.

Defined cases: null or empty html gives an empty text; a null url is a host of its own; repeated
rows are copies; text outside of any block is a block; pages without a declared article keep all
that neither declares itself nor is of low importance. White space is Unicode's. All input columns
but the added ones pass through.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.llm.arrow import append, col, put, without, written
from cabrank.llm.dom import branches, digest, parse

THRESHOLD = 0.5
GAMMA = 0.9
LEAST_PAGES = 10
MAX_DEPTH = 12
HOST = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"

_NODE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("parent", T.LongType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("siblings", T.IntegerType()),
        T.StructField("value", T.LongType()),
        T.StructField("leaf", T.BooleanType()),
    ]
)
_BLOCK = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("path", T.ArrayType(T.LongType()))]
)
PARSED = T.StructType(
    [
        T.StructField("page_sig", T.LongType()),
        T.StructField("nodes", T.ArrayType(_NODE)),
        T.StructField("blocks", T.ArrayType(_BLOCK)),
    ]
)
_NODES = pa.list_(
    pa.struct(
        [("id", pa.int64()), ("parent", pa.int64()), ("depth", pa.int32()), ("siblings", pa.int32()), ("value", pa.int64()), ("leaf", pa.bool_())]
    )
)
_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("path", pa.list_(pa.int64()))]))


def parsed(pages: DataFrame, html: str = "html", max_depth: int = MAX_DEPTH, hints: bool = True) -> DataFrame:
    """``pages`` without the html, with page_sig, nodes and blocks."""
    names = [f.name for f in _NODE.fields]

    def compute(texts: pa.Array) -> list[pa.Array]:
        sigs, nodes, blocks = [], [], []
        for text in texts.to_pylist():
            rows, kept = branches(parse(text or "", hints), max_depth)
            sigs.append(digest("p", max((b for b, _ in kept), key=len, default="")))
            nodes.append([dict(zip(names, row)) for row in rows])
            blocks.append([{"text": b, "path": path} for b, path in kept])
        return [pa.array(sigs, pa.int64()), pa.array(nodes, _NODES), pa.array(blocks, _BLOCKS)]

    rest = [c for c in pages.columns if c != html]
    return append(pages, [html], compute, PARSED, keep=rest)


def style_tree(pages: DataFrame) -> DataFrame:
    """Nodes (site, id, parent, depth, siblings, pages, styles, leaf, own) of ``LEAST_PAGES`` and more."""
    rows = pages.select("site", "page_sig", F.inline("nodes")).distinct()
    values = rows.groupBy("site", "id", "parent", "depth", "siblings", "leaf", "value").agg(
        F.count("*").alias("n")
    )
    entropy = F.log("pages") - F.col("spread") / F.col("pages")
    return (
        values.groupBy("site", "id", "parent", "depth", "siblings")
        .agg(
            F.sum("n").alias("pages"),
            F.count("*").alias("styles"),
            F.sum(F.col("n") * F.log("n")).alias("spread"),
            F.every("leaf").alias("leaf"),
        )
        .where(F.col("pages") >= LEAST_PAGES)
        .withColumn("own", F.greatest(F.lit(0.0), F.least(F.lit(1.0), entropy / F.log("pages"))))
        .drop("spread")
    )


def importance(tree: DataFrame) -> DataFrame:
    """``tree`` with composite importance and peak, the largest one in the branch.

    One level at a time from the deepest one up; children that are not in the tree count as 1.
    """
    tree = written(tree, "style-tree")
    deepest = tree.agg(F.max("depth")).head()[0]
    if deepest is None:
        return tree.selectExpr("*", "own AS composite", "own AS peak")
    done, below = None, None
    for depth in range(deepest, 0, -1):
        level = tree.where(F.col("depth") == depth)
        if below is None:
            level = level.selectExpr("*", "CAST(NULL AS double) AS lost", "0.0D AS present", "0.0D AS top")
        else:
            share = F.col("pages") / F.col("siblings")
            children = below.groupBy("site", F.col("parent").alias("id")).agg(
                F.sum(share * (1 - F.col("composite"))).alias("lost"),
                F.sum(share).alias("present"),
                F.max("peak").alias("top"),
            )
            level = level.join(children, ["site", "id"], "left").fillna({"present": 0.0, "top": 0.0})
        weight = F.pow(F.lit(GAMMA), F.col("styles"))
        inner = F.greatest(F.lit(0.0), 1 - F.coalesce("lost", F.lit(0.0)) / F.col("pages"))
        composite = F.when(F.col("leaf"), F.col("own")).otherwise((1 - weight) * F.col("own") + weight * inner)
        all_there = F.col("present") >= F.col("pages") * (1 - 1e-9)
        peak = (
            F.when(F.col("leaf"), F.col("composite"))
            .when(all_there, F.greatest("composite", "top"))
            .otherwise(F.lit(1.0))
        )
        level = level.withColumn("composite", composite).withColumn("peak", peak).drop("lost", "present", "top")
        below = written(level.select(*tree.columns, "composite", "peak"), "importance")
        done = below if done is None else done.union(below)
    return done


def extract(pages: DataFrame, html: str = "html", url: str = "url", hints: bool = True, threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` without the html, with text and n_chars."""
    names = without(pages.select(*[col(c) for c in pages.columns if c != html]), ["text", "n_chars"])
    plain = [f"c{i}" for i in range(len(names))]
    host = F.lower(F.regexp_extract(F.coalesce(col(url), F.lit("")), HOST, 1))
    narrow = pages.select(
        *[col(c).alias(p) for c, p in zip(names, plain)],
        host.alias("site"),
        F.monotonically_increasing_id().alias("row"),
        col(html).alias("html"),
    )
    rows = written(parsed(narrow, hints=hints), "parsed")
    noise = importance(style_tree(rows)).where(F.col("peak") < threshold).select("site", "id")
    branches_of = F.array_distinct(F.flatten(F.transform("blocks", lambda b: b["path"])))
    asked = rows.select("row", "site", F.explode(branches_of).alias("id"))
    hits = asked.join(noise, ["site", "id"]).groupBy("row").agg(F.collect_set("id").alias("noise"))
    # Pages that have no branch to ask about stay out of the join, and of its shuffle.
    sure = F.forall("blocks", lambda b: F.size(b["path"]) == 0)
    kept = F.when(F.col("noise").isNull(), F.col("blocks")).otherwise(
        F.filter("blocks", lambda b: ~F.arrays_overlap(b["path"], F.col("noise")))
    )

    def text(blocks: Column) -> Column:
        return F.array_join(F.transform(blocks, lambda b: b["text"]), "\n\n").alias("text")

    whole = rows.where(sure).select(*plain, text(F.col("blocks")))
    pruned = rows.where(~sure).join(hits, "row", "left").select(*plain, text(kept))
    out = whole.union(pruned).toDF(*names, "text")
    return put(out, text=F.col("text"), n_chars=F.char_length("text").cast("long"))
