"""The corpus pipeline: toxic documents go, near duplicates go, repeated passages go, documents with benchmark passages go, and
what is left is packed. Each stage takes all that its predecessor kept; between stages the rows are a Parquet table in the
shared checkpoint folder, so a lost executor costs no earlier stage.

All stages but the last return the columns of `documents`; the last returns one row for each piece of a document in a bin.
Cases are those of the operators: null and empty texts pass every filter and take no bin, repeated rows count as one group of
near duplicates, clean documents stay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from detlake.llm import decontaminate, jaccard_join, packing, suffix_dedup, toxicity
from detlake.session import work_folder


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_group(docs, 5, 80, 100)


def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [("toxicity", toxic_out), ("near_duplicates", near_duplicates_out), ("suffix_dedup", repeats_out), ("decontamination", benchmark_out), ("packing", bins)]

#: trained models, connected components and packing steps have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
