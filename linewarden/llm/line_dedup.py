"""Lines that many documents hold, found with two Bloom filters.

Documents are dealt into chunks, and a chunk sends the hash of each of its lines once. Hashes
are dealt over shards. A shard keeps two Bloom filters: a hash that comes for the first time
goes into the once-seen filter, one that the once-seen filter already holds goes into the
twice-seen filter. A filter never misses what was put in, so each line that two documents share
is in the twice-seen filter of its shard, and almost none of the others. Only those suspects go
on: their chunks send the SHA-256 of the lines, with the number of documents and the first
place, and these are summed exactly. What is confirmed goes back to the chunks that hold it.

A line in a third of all documents is one row per chunk in each shuffle, and its sum reads them
as a stream. No filter, line or count passes through the driver, and nothing is broadcast. All
passes over the text read the same shuffle.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden.llm.words import mix, utf8

PROBES = 3
BITS_PER_HASH = 8
PROBE_STEP = 0x9E3779B97F4A7C15

HASH_SCHEMA = "hash long, chunk long, many boolean"
SUSPECT_SCHEMA = "hash long, chunk long"
_LINES = pa.schema(
    [
        ("digest", pa.binary()),
        ("hash", pa.int64()),
        ("chunk", pa.int64()),
        ("documents", pa.int64()),
        ("doc_id", pa.int64()),
        ("row", pa.int64()),
        ("line", pa.int64()),
    ]
)
LINE_SCHEMA = (
    "digest binary, hash long, chunk long, documents long, doc_id long, row long, line long"
)
RESULT_SCHEMA = (
    "doc_id long, n_lines long, n_dropped long, kept_sha256 string, dropped array<long>"
)
_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_lines", pa.int64()),
        ("n_dropped", pa.int64()),
        ("kept_sha256", pa.string()),
        ("dropped", pa.list_(pa.int64())),
    ]
)


class BloomFilter:
    """Hashes that were put in, and a few others; sized for ``expected`` of them."""

    def __init__(self, expected: int):
        size = 1 << max(10, (BITS_PER_HASH * expected - 1).bit_length())
        self.bits = np.zeros(size, bool)
        self.mask = np.uint64(size - 1)

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        for probe in range(1, PROBES + 1):
            step = np.uint64(probe * PROBE_STEP % (1 << 64))
            yield (mix(hashes ^ step) & self.mask).astype(np.int64)

    def add(self, hashes: np.ndarray) -> None:
        for places in self._places(hashes):
            self.bits[places] = True

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        held = np.ones(len(hashes), bool)
        for places in self._places(hashes):
            held &= self.bits[places]
        return held


def line_key(line: bytes) -> bytes:
    """A line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased."""
    return line.strip().lower()


def _keys(text: bytes, shortest: int) -> list[bytes]:
    """The key of each line; empty in place of one with fewer than ``shortest`` code points."""
    keys = [line_key(line) for line in text.split(b"\n")]
    if shortest <= 1:
        return keys
    return [k if sum(b & 0xC0 != 0x80 for b in k) >= shortest else b"" for k in keys]


def _hash(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key)


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _chunk_hashes(shortest: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        hashes: list[int] = []
        for text in table.column("text"):
            distinct = set(_keys(text.as_py(), shortest))
            distinct.discard(b"")
            hashes.extend(map(_hash, distinct))
        found, counts = np.unique(np.array(hashes, np.uint64), return_counts=True)
        return pa.table(
            {
                "hash": _signed(found),
                "chunk": pa.array(np.full(len(found), key[0].as_py(), np.int64)),
                "many": pa.array(counts > 1),
            }
        )

    return run


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a shard whose hash its twice-seen filter holds."""
    held = [b for b in batches if b.num_rows]
    rows = sum(b.num_rows for b in held)
    once, twice = BloomFilter(rows), BloomFilter(rows)
    columns = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(3)] for b in held]
    for signed, _, many in columns:
        hashes = signed.view(np.uint64)
        distinct, counts = np.unique(hashes, return_counts=True)
        twice.add(distinct[counts > 1])
        twice.add(hashes[many | once.holds(hashes)])
        once.add(distinct)
    for signed, chunk, _ in columns:
        kept = twice.holds(signed.view(np.uint64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed[kept]), pa.array(chunk[kept])], ["hash", "chunk"]
        )


def _suspected_lines(shortest: int):
    def run(key: tuple, texts: pa.Table, suspects: pa.Table) -> pa.Table:
        wanted = set(suspects.column("hash").to_numpy().view(np.uint64).tolist())
        # By line: its hash, how many documents hold it and its first place.
        lines: dict[bytes, list] = {}
        rows = zip(*(texts.column(n).to_pylist() for n in ("doc_id", "row", "text")))
        for doc_id, row, text in rows if wanted else ():
            here: dict[bytes, int] = {}
            for number, line in enumerate(_keys(text, shortest)):
                if line:
                    here.setdefault(line, number)
            for line, number in here.items():
                hashed = _hash(line)
                if hashed not in wanted:
                    continue
                place = (doc_id is None, doc_id or 0, row, number)
                entry = lines.setdefault(line, [hashed, 0, place])
                entry[1] += 1
                entry[2] = min(entry[2], place)
        found = list(lines.values())
        places = [place for _, _, place in found]
        return pa.table(
            [
                pa.array([hashlib.sha256(line).digest() for line in lines], pa.binary()),
                _signed(np.array([hashed for hashed, _, _ in found], np.uint64)),
                pa.array(np.full(len(found), key[0].as_py(), np.int64)),
                pa.array([documents for _, documents, _ in found], pa.int64()),
                pa.array([None if p[0] else p[1] for p in places], pa.int64()),
                pa.array([p[2] for p in places], pa.int64()),
                pa.array([p[3] for p in places], pa.int64()),
            ],
            schema=_LINES,
        )

    return run


def _drop(shortest: int, keep_first: bool):
    def run(key: tuple, texts: pa.Table, confirmed: pa.Table) -> pa.Table:
        gone: dict[int, dict[bytes, tuple]] = {}
        for hashed, digest, first in zip(
            confirmed.column("hash").to_numpy().view(np.uint64).tolist(),
            *(confirmed.column(n).to_pylist() for n in ("digest", "first")),
        ):
            gone.setdefault(hashed, {})[digest] = (first["row"], first["line"])

        def goes(line: bytes, row: int, number: int) -> bool:
            digests = gone.get(_hash(line)) if line else None
            if not digests:
                return False
            first = digests.get(hashlib.sha256(line).digest())
            return first is not None and not (keep_first and first == (row, number))

        out = []
        rows = zip(*(texts.column(n).to_pylist() for n in ("doc_id", "row", "text")))
        for doc_id, row, text in rows:
            lines, dropped = text.split(b"\n"), []
            if gone:
                keys = _keys(text, shortest)
                dropped = [i for i, line in enumerate(keys) if goes(line, row, i)]
                drop = set(dropped)
                kept = [line for i, line in enumerate(lines) if i not in drop]
                text = b"\n".join(kept)
            out.append(
                {
                    "doc_id": doc_id,
                    "n_lines": len(lines),
                    "n_dropped": len(dropped),
                    "kept_sha256": hashlib.sha256(text).hexdigest(),
                    "dropped": dropped,
                }
            )
        return pa.Table.from_pylist(out, schema=_RESULT)

    return run


def drop_repeated_lines(
    documents: DataFrame,
    min_documents: int = 10,
    shortest: int = 1,
    keep_first: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_bytes: int = 16 << 20,
    shard_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256 and ``dropped``.

    Texts are split at line feeds. A line's key is the line without ``[\\x20\\x09-\\x0D]`` at
    both ends, A-Z lower-cased; equality is that of the keys' SHA-256. Lines whose key has at
    least ``shortest`` code points and is found in at least ``min_documents`` documents are
    dropped everywhere; with ``keep_first`` the first of them stays, that of the smallest id
    (rows of one id in the order of the table, a null id last). ``dropped`` holds the numbers
    of the dropped lines from 0, ``kept_sha256`` is of the other lines joined by line feeds.

    Each row is a document, also one that repeats another row or its id. Null and empty texts
    are one empty line, which is never dropped. An empty table gives an empty result. Other
    columns are not read. Rows are dealt into chunks by their place in the table, so that equal
    rows spread; the rows of a partition must come in the same order when they are read again,
    as those of a file do.
    """
    if min_documents < 2:
        raise ValueError("a repeated line is in two documents at least")
    total = documents.agg(F.sum(F.octet_length(F.col(f"`{text_column}`")).cast("long"))).first()[0]
    chunks = max(1, math.ceil((total or 0) / chunk_bytes))
    shards = max(1, math.ceil((total or 0) / shard_bytes))
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        utf8(text_column).alias("text"),
    )
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)))
    hashes = chunked.groupBy("chunk").applyInArrow(_chunk_hashes(shortest), HASH_SCHEMA)
    suspects = hashes.repartition(shards, "hash").mapInArrow(_suspects, SUSPECT_SCHEMA)
    # Both readings of the lines share one shuffle by digest, as both take all its columns.
    lines = (
        chunked.groupBy("chunk")
        .cogroup(suspects.groupBy("chunk"))
        .applyInArrow(_suspected_lines(shortest), LINE_SCHEMA)
        .repartition(shards, "digest")
    )
    no_id = F.col("doc_id").isNull().alias("no_id")
    place = F.struct(no_id, "doc_id", "row", "line", "hash", "chunk")
    repeated = (
        lines.groupBy("digest")
        .agg(F.sum("documents").alias("documents"), F.min(place).alias("first"))
        .filter(F.col("documents") >= min_documents)
        .select("digest", "first")
    )
    confirmed = lines.join(repeated.hint("merge"), "digest")
    return (
        chunked.groupBy("chunk")
        .cogroup(confirmed.groupBy("chunk"))
        .applyInArrow(_drop(shortest, keep_first), RESULT_SCHEMA)
    )
