"""Registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.llm import brown, decontam, embed, exact, langid, mixing, packing, pages, repair, secrets, simhash, spans, trie
from keyfold.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn
    return deco


@register("op4_simhash_popcount")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op2_metric_range_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"))


@register("op7_curriculum_mix", mixing.SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.curriculum(table(spark, sf_dir, "documents"))
    return (placed.withColumn("position", F.try_element_at("positions", F.lit(1)))
            .select("doc_id", "size", "source_size", "target", "taken", "copies", "position"))


@register("op9_blob_ledger_scan", secrets.SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_fresh(spark, table(spark, sf_dir, "documents"))


@register("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op3_marginal_unigrams")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@register("op1_latent_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op8_brown_classes")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(table(spark, sf_dir, "documents"))


@register("op6_sentence_spans")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.remove_repeats(table(spark, sf_dir, "documents"))


@register("op5_nearest_url_differencing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


@register("op11_four_russians_repair", repair.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")), gone_col="gone")


@register("op12_radix_prefix_trie", trie.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(trie.grafted(table(spark, sf_dir, "conversations")))


@register("op13_heavy_hitter_dedup", exact.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(table(spark, sf_dir, "documents"))
