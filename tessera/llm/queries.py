"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat, decontaminate, hard_negatives, html_extract, licenses, line_dedup, mixing, packing, phrase_dedup, quality_rules, simhash, simple8b, trie
from tessera.llm.common import c, scratch_path, ship_code, written
from tessera.llm.tokens import default_tokenizer

#: Fixed value: the id that ends each document.
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "simple8b")
    simple8b.write_ids(table(spark, sf_dir, "documents"), path, default_tokenizer(), END_ID)
    return simple8b.read_documents(spark, path)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op5_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), default_tokenizer(), END_ID)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, names = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", c(names["n_lines"]).alias("n_lines"), c(names["n_dropped"]).alias("n_dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = phrase_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: Fixed value: the text of both turns of conversation -7.
MARKED_TEXT = "\\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKED_TEXT).alias("text"))
    return chat.read_back(written(chat.format_conversations(turns.unionByName(marked)), "chat"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(table(spark, sf_dir, "documents")).withColumn("matches", F.concat("matches", "spans"))
    best = F.reduce("matches", F.lit(0.0), lambda a, m: F.greatest(a, m["dice"]))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return out.select("doc_id", "n_words", F.size("matches").cast("long").alias("n_matches"), F.array_join(names, ",").alias("licenses"), best.alias("best_dice"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, names = quality_rules.apply_rules(table(spark, sf_dir, "documents"), features=quality_rules.BASE)
    base = {x: c(names[x]) for x in quality_rules.BASE}
    failed = quality_rules.base_failed(base)
    return out.select("doc_id", *[v.alias(k) for k, v in base.items()], failed.alias("base_failed"), (~failed & c(names["rejected_by"]).isNull()).alias("kept"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = hard_negatives.whole_rows(table(spark, sf_dir, "embeddings"), new_label=shifted)
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(trie.rebuilt(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_html_text, op2_simple8b_ids, op3_decontaminate, op4_simhash_dedup, op5_bm25_packing, op6_line_dedup, op7_phrase_dedup, op8_chat_format,
        op9_license_scan, op10_quality_rules, op11_source_mixing, op12_hard_negatives,
        op13_prefix_trie,
    )
}
