"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewarden.llm.binary_output import pack_ids
from linewarden.llm.collocations import collocations
from linewarden.llm.cutting_stock import pack_documents
from linewarden.llm.decontamination import contamination_report, find_contamination
from linewarden.llm.encoding import public_path
from linewarden.llm.exact_dedup import exact_duplicates
from linewarden.llm.language_model import train_and_score
from linewarden.llm.line_dedup import drop_repeated_lines
from linewarden.llm.sharding import shard_by_bytes
from linewarden.llm.simhash import near_duplicates
from linewarden.llm.substring_dedup import remove_repeated_windows
from linewarden.llm.token_counts import context_limits, length_histogram
from linewarden.llm.toxicity import score_documents, train
from linewarden.llm.whitening import whiten
from linewarden.llm.words import utf8

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_sampled_splitters(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    records = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(utf8("text")) + 1).cast("long").alias("size"),
        F.crc32(utf8("text")).alias("text_crc32"),
        F.xxhash64(utf8("text")).alias("text_key"),
    )
    sharded = shard_by_bytes(records, F.col("text_key"), F.col("size"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_digest_run_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query
def op10_bk_tree_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query
def op6_level_doubling(spark, sf_dir):
    return remove_repeated_windows(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


@query
def op8_suffix_array_search(spark, sf_dir):
    found = find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return contamination_report(found).drop("longest_match")


@query
def op1_length_histogram(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return context_limits(length_histogram(documents, public_path()))


@query
def op2_best_fit_matrices(spark, sf_dir):
    return pack_ids(table(spark, sf_dir, "documents"), public_path())


@query
def op7_cutting_stock(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_path())


@query
def op4_counterfactual_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = train(documents, table(spark, sf_dir, "labels"))
    return score_documents(documents, model)


@query
def op3_class_maxent_lm(spark, sf_dir):
    return train_and_score(table(spark, sf_dir, "documents"))


@query
def op12_two_bloom_lines(spark, sf_dir):
    return drop_repeated_lines(table(spark, sf_dir, "documents"), min_documents=10).drop("dropped")


@query
def op13_quotient_filters(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


@query
def op11_jacobi_davidson(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"), components=16)
