"""The corpus pipeline: stages over ``documents``, each calling one operator of keyfold.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keyfold.llm import decontam, langid, mixing, packing, simhash
from keyfold.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (4-word shingles, 4 bits)."""
    return simhash.keep_one(docs, width=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in training order."""
    return mixing.mixed(docs)


def token_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids, range-sorted by their position in training order."""
    return packing.pack(mixing.with_position(docs, "__kf_position"), position_col="__kf_position")


STAGES = [("language_id", language_id), ("simhash_near_dedup", near_duplicates), ("decontamination", decontamination),
          ("source_mix", source_mix), ("token_rows", token_rows)]

#: The model-based stages cannot be written in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written as Parquet in the
    shared folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
