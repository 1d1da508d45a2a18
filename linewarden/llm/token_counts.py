"""An exact histogram of encoded lengths, and what it answers for any context limit."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linewarden.llm.encoding import encoder_of, vocabulary_of
from linewarden.llm.words import rows_of, utf8
from linewarden.session import materialize


def _length_counts(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, counts = encoder_of(vocabulary), Counter()
        for (text,) in rows_of(batches, "text"):
            counts[len(encoder.encode(text)) // 4] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
            ["n_tokens", "n"],
        )

    return run


def length_histogram(
    documents: DataFrame, vocabulary_path: str, text_column: str = "text"
) -> DataFrame:
    """n_tokens, n_documents: how many documents encode to each length.

    Null and empty texts have length 0. Tasks count before anything is shuffled, so a length
    shared by most documents is one row per task. An empty table gives an empty result.
    """
    vocabulary = vocabulary_of(documents.sparkSession, vocabulary_path)
    counts = documents.select(utf8(text_column).alias("text")).mapInArrow(
        _length_counts(vocabulary), "n_tokens long, n long"
    )
    return counts.groupBy("n_tokens").agg(F.sum("n").alias("n_documents"))


def context_limits(histogram: DataFrame, block: int = 1024) -> DataFrame:
    """One row per length in the histogram, with the answers for a context limit of it.

    documents_longer, tokens_longer: suffix sums over the lengths above the limit;
    tokens_within: what truncating every document to the limit leaves; tokens_cut: what it
    removes; share_within: the share of documents that fit whole, so the smallest length with
    ``share_within >= q`` is the q-quantile. For a limit between two lengths take the row of
    the next smaller length: its suffix sums hold, and ``tokens_within`` grows by
    ``documents_longer`` for every further token.

    Sums run over blocks of lengths first and then within each block, so no task sorts all
    lengths.
    """
    stored = materialize(histogram, "length_histogram").withColumn(
        "block", F.floor(F.col("n_tokens") / block)
    )
    stored = stored.withColumn("tokens", F.col("n_tokens") * F.col("n_documents"))
    blocks = stored.groupBy("block").agg(
        F.sum("n_documents").alias("documents"), F.sum("tokens").alias("tokens")
    )
    # One row per block; everything above a block is summed once for all its lengths.
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("documents").over(above), F.lit(0)).alias("documents_above"),
        F.coalesce(F.sum("tokens").over(above), F.lit(0)).alias("tokens_above"),
    )
    inside = (
        Window.partitionBy("block")
        .orderBy(F.col("n_tokens").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # Two numbers, known once the histogram is written.
    documents, tokens = stored.agg(F.sum("n_documents"), F.sum("tokens")).first()
    return (
        stored.withColumns(
            {
                "documents_inside": F.coalesce(F.sum("n_documents").over(inside), F.lit(0)),
                "tokens_inside": F.coalesce(F.sum("tokens").over(inside), F.lit(0)),
            }
        )
        .join(blocks, "block")
        .select(
            "n_tokens",
            "n_documents",
            (F.col("documents_inside") + F.col("documents_above")).alias("documents_longer"),
            (F.col("tokens_inside") + F.col("tokens_above")).alias("tokens_longer"),
        )
        .select(
            "n_tokens",
            "n_documents",
            "documents_longer",
            "tokens_longer",
            (
                F.lit(tokens).cast("long")
                - F.col("tokens_longer")
                + F.col("documents_longer") * F.col("n_tokens")
            ).alias("tokens_within"),
            (F.col("tokens_longer") - F.col("documents_longer") * F.col("n_tokens")).alias(
                "tokens_cut"
            ),
            (1 - F.col("documents_longer") / F.lit(documents).cast("long")).alias("share_within"),
        )
    )
