"""A corpus pipeline of five stages; each calls one training-data operator.

Each stage takes (spark, docs, sf_dir) and works on all rows it gets.  All but
the last return the columns of ``documents``; the last returns the packed
pieces.  ``run`` writes each stage's result as Parquet in the shared folder and
rereads it as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from tessera.llm.common import c, ship_code, written
from tessera.llm.queries import END_ID
from tessera.llm.tokens import default_tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that 10 documents or more hold go; ``n_chars`` is that of the new text."""
    out, _ = line_dedup.drop_frequent_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[c(x) for x in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays: the smallest doc_id."""
    ship_code(spark)
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark text go, by the contract's contamination rule."""
    ship_code(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    ship_code(spark)
    return packing.pack(docs, default_tokenizer(), END_ID)


STAGES = [("quality rules", quality), ("line dedup", lines), ("SimHash near-dedup", near_copies), ("benchmark decontamination", benchmark_leaks), ("packing", pack)]

#: The fingerprints (XXH64) and the tokenizer have no SQL form; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
