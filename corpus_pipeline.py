"""A training-data pipeline over ``documents``: quality rules, line dedup,
near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it to the shared folder and reads it back as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import decontam, linededup, neardup, packing, quality
from kerbside.llm.common import table, written


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return quality.apply_policy(docs)


def _lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines go; so do documents left without a word."""
    d = linededup.dedup_lines(docs, lines_col="__lines", removed_col="__removed")
    left = (F.col("__removed") == 0) | (F.btrim(F.col("text"), F.lit(" \t\r\n")) != "")
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)) \
            .otherwise(F.col("n_chars"))
    return d.where(left).select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return neardup.keep_one(docs)


def _benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, packed into sequences."""
    return packing.pack(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", _quality),
    ("line dedup", _lines),
    ("near duplicates", _near),
    ("benchmark decontamination", _benchmark),
    ("best-fit packing", _packing),
]

#: Consistent sampling and packing have no SQL twin; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
