"""Collocations, counted in quotient filters of packed word numbers.

The texts are read once. A task writes them down as streams of word numbers of its own, cut
into chunks of a bounded size, beside the chunk's words and their counts. Words that are too
rare for any phrase drop out; the others get dense numbers of ``w`` bits over all languages.
A chunk learns the numbers of its words and counts its phrases: up to three numbers are packed
into 3w bits and permuted by a Feistel network, which spreads them evenly and can be undone.
The top bits of the permuted value choose a shard, the next are the quotient, and all the rest
is kept as the remainder, so a counting filter holds exact counts of exact phrases in a few
bytes each. A shard merges the sorted filters of the chunks, keeps what is frequent and undoes
the permutation. A phrase in every document is one counter per chunk.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewarden.llm.words import mix, rows_of, utf8
from linewarden.operators.numbering import number_rows
from linewarden.session import materialize

BREAK = b"."
# The bytes that end a piece.
_TO_BREAK = bytes.maketrans(b".,;:!?\n\v\f\r", BREAK * 10)
ROUND_KEYS = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
MOST_BITS = 32  # of a word's number
TOP_COUNT = 255  # counts from here on are kept apart


# --- permutation and filters --------------------------------------------------------------


def permute(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A one-to-one spread of (2 * bits, bits) wide values."""
    masks = np.uint64((1 << 2 * bits) - 1), np.uint64((1 << bits) - 1)
    for turn, key in enumerate(ROUND_KEYS):
        if turn % 2:
            low = low ^ (mix(high + np.uint64(key)) & masks[1])
        else:
            high = high ^ (mix(low + np.uint64(key)) & masks[0])
    return high, low


def restore(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that ``permute`` made these of."""
    masks = np.uint64((1 << 2 * bits) - 1), np.uint64((1 << bits) - 1)
    for turn, key in reversed(list(enumerate(ROUND_KEYS))):
        if turn % 2:
            low = low ^ (mix(high + np.uint64(key)) & masks[1])
        else:
            high = high ^ (mix(low + np.uint64(key)) & masks[0])
    return high, low


def counted(
    high: np.ndarray, low: np.ndarray, counts: np.ndarray | None, bits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values in order, and the sum of the counts of each (of ones if none)."""
    if 3 * bits <= 64:
        # Runs that are sorted already are merged, not sorted anew, by the stable sort.
        by = np.argsort((high << np.uint64(bits)) | low, kind="stable")
    else:
        by = np.lexsort((low, high))
    high, low = high[by], low[by]
    new = np.ones(len(by), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    starts = np.flatnonzero(new)
    if counts is None:
        sums = np.diff(starts, append=len(by))
    else:
        sums = np.add.reduceat(counts[by], starts) if len(by) else counts
    return high[starts], low[starts], sums


def _bytes(values: np.ndarray, width: int) -> bytes:
    """Fixed width numbers, one plane per byte: planes of like bytes compress well."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return planes.T.tobytes()


def _values(data: bytes, at: int, count: int, width: int) -> np.ndarray:
    planes = np.zeros((count, 8), np.uint8)
    used = np.frombuffer(data, np.uint8, count * width, at).reshape(width, count)
    planes[:, :width] = used.T
    return planes.reshape(-1).view("<u8").astype(np.uint64)


def _width(bits: int) -> int:
    return (bits + 7) // 8


HEADER = struct.Struct("<BBxxxxxxqq")


def filter_bytes(
    high: np.ndarray, low: np.ndarray, counts: np.ndarray, high_bits: int, low_bits: int
) -> bytes:
    """A counting quotient filter of sorted distinct values.

    The top bits of ``high`` are the quotient, about as many quotients as values. For each
    value there is a one among the quotients, which stand as zeros: the place of a one less
    its number is the quotient, so runs need two bits per value. The remainder keeps all
    other bits. Counts take a byte; larger ones follow behind.
    """
    n = len(high)
    quotient_bits = min(high_bits, max(1, n.bit_length()))
    rest_bits = high_bits - quotient_bits
    quotients = (high >> np.uint64(rest_bits)).astype(np.int64)
    runs = np.zeros(n + (1 << quotient_bits), np.uint8)
    runs[quotients + np.arange(n)] = 1
    large = counts[counts >= TOP_COUNT]
    small = np.minimum(counts, TOP_COUNT).astype(np.uint8)
    return b"".join(
        (
            HEADER.pack(quotient_bits, high_bits, n, len(large)),
            np.packbits(runs).tobytes(),
            _bytes(high & np.uint64((1 << rest_bits) - 1), _width(rest_bits)),
            _bytes(low, _width(low_bits)),
            small.tobytes(),
            large.astype("<i8").tobytes(),
        )
    )


def filter_content(data: bytes, low_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values and counts of a filter."""
    quotient_bits, high_bits, n, n_large = HEADER.unpack_from(data)
    at = HEADER.size
    run_bytes = (n + (1 << quotient_bits) + 7) // 8
    runs = np.unpackbits(np.frombuffer(data, np.uint8, run_bytes, at))
    at += run_bytes
    quotients = (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64)
    rest_bits = high_bits - quotient_bits
    rest = _values(data, at, n, _width(rest_bits))
    at += n * _width(rest_bits)
    low = _values(data, at, n, _width(low_bits))
    at += n * _width(low_bits)
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    counts[counts == TOP_COUNT] = np.frombuffer(data, "<i8", n_large, at + n)
    return (quotients << np.uint64(rest_bits)) | rest, low, counts


# --- streams of word numbers --------------------------------------------------------------

CODED = "chunk long, local int, lang string, word binary, n long, stream binary"
_CODED = pa.schema(
    [
        ("chunk", pa.int64()),
        ("local", pa.int32()),
        ("lang", pa.string()),
        ("word", pa.binary()),
        ("n", pa.int64()),
        ("stream", pa.binary()),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    """The words in order, with a break between two pieces."""
    return text.lower().translate(_TO_BREAK).replace(BREAK, b" . ").split()


class _Numbers(dict):
    """Numbers of words, given out as they are asked for."""

    def __init__(self, fresh: Iterator[int]):
        self.fresh = fresh
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = next(self.fresh)
        return number


def _coded(chunk_words: int):
    """Chunks of texts: a row with the stream, and a row for each word. Number 0 is a break.

    Texts are cut between pieces only, so a long one may lie in several chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only one attempt of a task is kept, so its number makes its chunks unique.
        chunk = TaskContext.get().partitionId() << 32
        fresh, by_lang = count(1), {}
        streams: list[np.ndarray] = []
        length = 0

        def flushed() -> pa.RecordBatch:
            stream = np.concatenate(streams)
            n = np.bincount(stream)
            words = [(i, lang, word) for lang, of in by_lang.items() for word, i in of.items() if i]
            local, langs, texts = zip(*words) if words else ((), (), ())
            rows = len(words) + 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(rows, chunk, np.int64)),
                    pa.array([None, *local], pa.int32()),
                    pa.array([None, *langs], pa.string()),
                    pa.array([None, *texts], pa.binary()),
                    pa.array([None, *n[list(local)].tolist()], pa.int64()),
                    pa.array([_bytes(stream, 4)] + [None] * (rows - 1), pa.binary()),
                ],
                schema=_CODED,
            )

        for lang, text in rows_of(batches, "lang", "text"):
            words = words_of(text)
            start = 0
            while start < len(words):
                end = start + chunk_words - length
                try:
                    end = words.index(BREAK, end) + 1
                except ValueError:
                    end = len(words)
                part = words[start:end]
                start = end
                of = by_lang.setdefault(lang, _Numbers(fresh))
                streams.append(np.fromiter(map(of.__getitem__, part), np.uint32, len(part)))
                streams.append(np.zeros(1, np.uint32))
                length += len(part)
                if length >= chunk_words:
                    yield flushed()
                    fresh, by_lang, streams, length = count(1), {}, [], 0
                    chunk += 1
        if streams:
            yield flushed()

    return run


# --- counting -----------------------------------------------------------------------------


def _chunk_filters(bits: int, shard_bits: int):
    """The filters of a chunk, one for each shard that gets something."""

    def run(key: tuple, stream: pa.Table, known: pa.Table) -> pa.Table:
        shards, filters = [], []
        for data in stream.column("stream").to_pylist():
            local = _values(data, 0, len(data) // 4, 4).astype(np.int64)
            number = np.zeros(int(local.max(initial=0)) + 1, np.uint64)
            at = known.column("local").to_numpy().astype(np.int64)
            number[at] = known.column("number").to_numpy().astype(np.uint64)
            words = np.concatenate([number[local], np.zeros(2, np.uint64)])
            first, second, third = words[:-2], words[1:-1], words[2:]
            pairs = np.flatnonzero((first > 0) & (second > 0))
            triples = pairs[third[pairs] > 0]
            low = np.concatenate([first[pairs], first[triples]])
            high = np.concatenate([second[pairs], second[triples]]) << np.uint64(bits)
            high[len(pairs) :] |= third[triples]
            high, low, counts = counted(*permute(high, low, bits), None, bits)
            high_bits = 2 * bits - shard_bits
            shard = (high >> np.uint64(high_bits)).astype(np.int64)
            high = high & np.uint64((1 << high_bits) - 1)
            starts = np.flatnonzero(np.diff(shard, prepend=-1))
            for a, z in zip(starts, [*starts[1:], len(shard)]):
                shards.append(int(shard[a]))
                filters.append(
                    filter_bytes(high[a:z], low[a:z], counts[a:z], high_bits, bits)
                )
        return pa.table(
            {"shard": pa.array(shards, pa.int64()), "filter": pa.array(filters, pa.binary())}
        )

    return run


def _merged_filters(bits: int, shard_bits: int, least: int):
    """The frequent phrases of a shard, as the numbers of their words; 0 for no third word."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [filter_content(f.as_py(), bits) for f in table.column("filter")]
        high, low, counts = (np.concatenate(c) for c in zip(*parts))
        high, low, counts = counted(high, low, counts, bits)
        kept = counts >= least
        high_bits = 2 * bits - shard_bits
        high = high[kept] | np.uint64(key[0].as_py() << high_bits)
        high, low = restore(high, low[kept], bits)
        second, third = high >> np.uint64(bits), high & np.uint64((1 << bits) - 1)
        arrays = [x.astype(np.int64) for x in (low, second, third, counts[kept])]
        return pa.table([pa.array(x) for x in arrays], ["first", "second", "third", "a"])

    return run


def frequent_phrases(
    documents: DataFrame,
    min_count: int = 10,
    lang_column: str = "lang",
    text_column: str = "text",
    chunk_words: int = 1_500_000,
    shard_entries: int = 3_000_000,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases of two and three words, words and languages.

    Phrases: first, second, third (numbers of words; third is 0 in a phrase of two) and
    ``a``, the count, of all with ``min_count`` or more. Words: number, lang, word, f, of all
    with as many. Languages: lang, n, the count of all words.
    """
    lang = F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("und"))
    texts = documents.select(lang.alias("lang"), utf8(text_column).alias("text"))
    coded = materialize(texts.mapInArrow(_coded(chunk_words), CODED), "coded")
    words = coded.filter(F.col("local").isNotNull())
    totals = words.groupBy("lang", "word").agg(F.sum("n").alias("f"))
    languages = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    known, distinct = number_rows(totals.filter(F.col("f") >= min_count), ["lang", "word"])
    known = materialize(known, "words")
    bits = distinct.bit_length()
    if bits > MOST_BITS:
        raise ValueError(f"{distinct} frequent words need more than {MOST_BITS} bits")
    if not distinct:
        nothing = coded.limit(0).selectExpr(
            "chunk AS first", "chunk AS second", "chunk AS third", "chunk AS a"
        )
        return nothing, known, languages
    entries = 2 * (words.agg(F.sum("n")).first()[0] or 0)
    shard_bits = min(2 * bits, max(0, math.ceil(math.log2(max(1, entries / shard_entries)))))
    numbers = (
        words.select(F.col("chunk").alias("holder"), "local", "lang", "word")
        .join(known.select("lang", "word", "number"), ["lang", "word"])
        .select("holder", "local", "number")
    )
    filters = (
        coded.filter(F.col("local").isNull())
        .select("chunk", "stream")
        .groupBy("chunk")
        .cogroup(numbers.groupBy("holder"))
        .applyInArrow(_chunk_filters(bits, shard_bits), "shard long, filter binary")
    )
    merged = filters.groupBy("shard").applyInArrow(
        _merged_filters(bits, shard_bits, min_count), "first long, second long, third long, a long"
    )
    return materialize(merged, "phrases"), known, languages


# --- scores -------------------------------------------------------------------------------


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact."""
    wide = [x.cast("decimal(19,0)") for x in (a, left, right)]
    product = F.lit(1_000_000).cast("decimal(7,0)") * wide[0] * wide[0]
    return F.call_function("div", product, wide[1] * wide[2])


def collocations(
    documents: DataFrame,
    min_count: int = 10,
    top: int = 2000,
    share: int = 50,
    lang_column: str = "lang",
    text_column: str = "text",
    salts: int = 32,
    **sizes: int,
) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Texts, A-Z lower-cased, are split at ``[.,;:!?\x0A-\x0D]`` into pieces and those into words
    at spaces and tabs. A candidate is a phrase of two or three words in a row of a piece with
    a count ``a`` of ``min_count`` or more. Cut behind a word it has the parts' counts l and r
    and a score floor(10**6 * a * a / (l * r)); the cut of the lowest score counts, the earlier
    of equals. A candidate goes if it lies within a longer one that has at least ``share``
    percent of its count, whether that one goes or not. The others are ranked by score, count
    (both falling) and phrase (UTF-8 bytes). n is the language's count of words.

    A null language is ``und``, null and empty texts have no words. Repeated rows count as
    often as they occur; ids and other columns are not read. An empty table gives an empty
    result. ``sizes`` are those of ``frequent_phrases``.
    """
    phrases, words, languages = frequent_phrases(
        documents, min_count, lang_column, text_column, **sizes
    )
    pairs = phrases.filter("third = 0").select("first", "second", "a")
    triples = phrases.filter("third > 0")

    def with_word(rows: DataFrame, column: str) -> DataFrame:
        side = words.select(
            F.col("number").alias(column),
            F.col("word").alias(f"{column}_word"),
            F.col("f").alias(f"{column}_f"),
            F.col("lang").alias(f"{column}_lang"),
        )
        return rows.join(side, column)

    def text(*columns: str) -> Column:
        return F.concat_ws(" ", *[F.col(f"{c}_word").cast("string") for c in columns])

    a = F.col("a")
    longer = [
        triples.select(F.col(x).alias("first"), F.col(y).alias("second"), "a")
        for x, y in (("first", "second"), ("second", "third"))
    ]
    longest = longer[0].unionByName(longer[1]).groupBy("first", "second")
    longest = longest.agg(F.max("a").alias("longer"))
    whole = pairs.join(longest, ["first", "second"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < a * share)
    )
    whole = with_word(with_word(whole, "first"), "second")
    two = whole.select(
        F.col("first_lang").alias("lang"),
        text("first", "second").alias("phrase"),
        "a",
        F.col("first_f").alias("l"),
        F.col("second_f").alias("r"),
        _score(a, F.col("first_f"), F.col("second_f")).alias("score"),
    )

    front = pairs.withColumnRenamed("a", "front")
    back = pairs.select(
        F.col("first").alias("second"), F.col("second").alias("third"), F.col("a").alias("back")
    )
    cut = triples.join(front, ["first", "second"]).join(back, ["second", "third"])
    for column in ("first", "second", "third"):
        cut = with_word(cut, column)
    early = _score(a, F.col("first_f"), F.col("back"))
    late = _score(a, F.col("front"), F.col("third_f"))
    is_early = early <= late
    three = cut.select(
        F.col("first_lang").alias("lang"),
        text("first", "second", "third").alias("phrase"),
        "a",
        F.when(is_early, F.col("first_f")).otherwise(F.col("front")).alias("l"),
        F.when(is_early, F.col("back")).otherwise(F.col("third_f")).alias("r"),
        F.least(early, late).alias("score"),
    )

    # The best of parts of a language first, so that no task ranks a whole language.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
    best = two.unionByName(three).withColumn("rank", F.row_number().over(part))
    best = best.filter(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(languages, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
