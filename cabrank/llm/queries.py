"""The operators over the whole test tables, reduced to the columns their contracts name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabrank.llm import (
    bpe,
    ctw,
    decontaminate,
    divergence,
    hamming,
    licenses,
    records,
    resample,
    secrets,
    shards,
    sitetree,
    spelling,
    trie,
)
from cabrank.llm.arrow import written
from cabrank.session import fresh_dir

SHARDS = 24
TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_weighted_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = shards.assign(docs, "doc_id", SHARDS, ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
        "region",
        "rack",
    )


def op2_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secret_spans")

    def number(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        number("assign"),
        number("access"),
        number("hex"),
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(spans).alias("spans"),
    )


def op3_length_delimited_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "records")
    docs = table(spark, sf_dir, "documents")
    index = records.write_records(docs, path, public_tokenizers.path(TOKENIZER))
    read = records.read_files(index, path).select(
        "doc_id",
        "file",
        "first",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return records.with_starts(read, index).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path, keep=["doc_id"]).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ctw.score(docs, keep=["doc_id"]).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "bits_per_byte",
    )


def op6_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = divergence.judge(docs, keep=["doc_id"])
    rounded = {c: F.round(c, 6) for c in ("char_distance", "word_distance")}
    return judged.withColumns(rounded)


def op7_license_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, keep=["doc_id"])
    base = F.transform("base_places", lambda p: p["label"])
    own = F.transform("license_blocks", lambda b: b["label"])
    at = F.transform("base_places", lambda p: p["at"])

    def said(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        said(base).alias("base_labels"),
        said(F.concat(base, own)).alias("labels"),
        F.coalesce(
            F.array_max(F.transform("license_blocks", lambda b: b["share"])), F.lit(0.0)
        ).alias("score"),
    )


def op8_multi_index_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = hamming.near_duplicates(docs, keep=["doc_id"])
    return done.select("doc_id", "n_shingles", "component_id", "kept")


def op9_decontaminate_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_hits(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = resample.classify(docs, table(spark, sf_dir, "labels"), keep=["doc_id"])
    return done.select("doc_id", "importance", "gumbel_key", "kept")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Each conversation c after the first h turns of conversation c - c % 20, in place of its own."""
    base = F.col("conv_id") - F.col("conv_id") % 20
    named = F.col("conv_id").cast("string").cast("binary")
    heads = turns.where("conv_id % 20 = 0").select(
        F.col("conv_id").alias("base"), F.slice("steps", 1, 3).alias("head")
    )
    own = turns.withColumns({"base": base, "h": (F.crc32(named) % 4).cast("int")})
    head = F.slice(F.coalesce("head", F.array().cast(turns.schema["steps"].dataType)), F.lit(1), F.col("h"))
    rest = F.slice("steps", F.col("h") + 1, F.greatest(F.size("steps") - F.col("h"), F.lit(0)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("steps"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.turns_of(table(spark, sf_dir, "conversations"))
    # Both sides of the join with the base conversations read these, so they are made once.
    return trie.trie(trie.sequences(rebuilt(written(turns, "turns"))))


def noisy() -> Column:
    """``run`` of ``doc_id``, of which the contract's noise may have deleted a letter."""
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("run"))
    h = F.crc32(name.cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return F.when(h % 97 == 0, cut).otherwise(F.col("run"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.vocabulary(spelling.runs(docs), noisy()))


def op13_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return sitetree.extract(pages).select("page_id", "url", "text", "n_chars")


QUERIES = {
    "op1_weighted_hash_tree": op1_weighted_hash_tree,
    "op2_entropy_secrets": op2_entropy_secrets,
    "op3_length_delimited_records": op3_length_delimited_records,
    "op4_segment_tree_bpe": op4_segment_tree_bpe,
    "op5_context_tree_weighting": op5_context_tree_weighting,
    "op6_distribution_divergence": op6_distribution_divergence,
    "op7_license_containment": op7_license_containment,
    "op8_multi_index_hamming": op8_multi_index_hamming,
    "op9_decontaminate_windows": op9_decontaminate_windows,
    "op10_importance_resampling": op10_importance_resampling,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_site_style_tree": op13_site_style_tree,
}
