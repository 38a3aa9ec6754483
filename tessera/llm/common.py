"""Helpers shared by the operators: column names, row keys, scratch tables, code shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

ROOT = Path(__file__).resolve().parents[2]


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken, name = {c.lower() for c in df.columns}, f"_llm_{base}"
    while name.lower() in taken:
        name += "_"
    return name


def c(name: str) -> Column:
    """The column of exactly this name; dots and back-ticks in it are no syntax."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_hash(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart; null and '' are one text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` as a table in the shared scratch folder: later stages read files, not lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Let the Python workers import this package.

    Does nothing where they can already (the repository is the working folder
    or on PYTHONPATH); else the package goes to the executors like --py-files.
    """
    there = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if any(p and Path(p).resolve() == ROOT for p in there) or (Path.cwd() / "tessera").exists():
        return
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="run-")) / "tessera_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((ROOT / "tessera").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    sc.addPyFile(str(target))
    sc._tessera_shipped = True
