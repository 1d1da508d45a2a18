"""Token ids packed into matrices: best fit decreasing with a segment tree of capacities.

A map-only job: every task encodes its documents, collects blocks of a bounded number of
tokens, packs each block and writes its sequences. Blocks follow the partitions as they are;
a task that runs again on the same input packs the same sequences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden.llm.encoding import check_vocabulary, encoder_of, vocabulary_of
from linewarden.llm.words import rows_of, utf8

SCHEMA = (
    "block long, sequence int, ids binary, n_tokens int, segment_ends array<int>, "
    "position_resets array<int>, segments array<struct<doc_id:long,start:long,length:int>>"
)
_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("sequence", pa.int32()),
        ("ids", pa.binary()),
        ("n_tokens", pa.int32()),
        ("segment_ends", pa.list_(pa.int32())),
        ("position_resets", pa.list_(pa.int32())),
        (
            "segments",
            pa.list_(
                pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32())])
            ),
        ),
    ]
)


class CapacityTree:
    """Open sequences by free capacity; finds the smallest capacity that is enough.

    Leaf c of the segment tree counts the sequences with c free places; an inner node sums
    its leaves.
    """

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, capacity: int, change: int) -> None:
        node = capacity + self.size
        while node:
            self.counts[node] += change
            node >>= 1

    def put(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """A sequence with the smallest capacity of at least ``least``, taken out."""
        node = least + self.size
        if not self.counts[node]:
            # Up to the first ancestor with something to the right, then down its left edge.
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """The numbers of the pieces in each sequence; every length is 1 .. capacity."""
    tree, sequences = CapacityTree(capacity), []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        free, number = tree.take(lengths[piece]) or (capacity, len(sequences))
        if number == len(sequences):
            sequences.append([])
        sequences[number].append(piece)
        if free > lengths[piece]:
            tree.put(free - lengths[piece], number)
    return sequences


def _sequences(pieces: list[tuple], capacity: int, pad: bytes, kind: str, block: int):
    """Rows of one packed block."""
    for number, members in enumerate(
        best_fit_decreasing([len(ids) // 4 for _, _, ids in pieces], capacity)
    ):
        ids = b"".join(pieces[m][2] for m in members)
        lengths = [len(pieces[m][2]) // 4 for m in members]
        ends = np.cumsum(lengths).tolist()
        full = ids + pad * (capacity - ends[-1])
        yield {
            "block": block,
            "sequence": number,
            "ids": np.frombuffer(full, "<u4").astype(kind).tobytes(),
            "n_tokens": ends[-1],
            "segment_ends": ends,
            "position_resets": [0, *ends[:-1]],
            "segments": [
                {"doc_id": pieces[m][0], "start": pieces[m][1], "length": n}
                for m, n in zip(members, lengths)
            ],
        }


def _packed(vocabulary, capacity: int, end_id: int, pad_id: int, kind: str, block_tokens: int):
    end, pad = end_id.to_bytes(4, "little"), pad_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        block = TaskContext.get().partitionId() << 32
        pieces, held = [], 0
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            ids = encoder.encode(text) + end
            for at in range(0, len(ids), 4 * capacity):
                pieces.append((doc_id, at // 4, ids[at : at + 4 * capacity]))
                held += len(pieces[-1][2]) // 4
                if held >= block_tokens:
                    yield from written(pieces, block)
                    pieces, held, block = [], 0, block + 1
        if pieces:
            yield from written(pieces, block)

    def written(pieces: list[tuple], block: int) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in _sequences(pieces, capacity, pad, kind, block):
            rows.append(row)
            if len(rows) == 256:
                yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return run


def pack_ids(
    documents: DataFrame,
    vocabulary_path: str,
    capacity: int = 4096,
    end_id: int = 2,
    pad_id: int = 0,
    wide: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_tokens: int = 2_000_000,
) -> DataFrame:
    """One row per sequence of ``capacity`` ids: a row of its block's id matrix.

    ids: little-endian 16-bit ids (32-bit if ``wide``), padded with ``pad_id`` behind
    ``n_tokens``; segment_ends: cumulative lengths of the segments; position_resets: where
    positions restart at 0; segments: document, first id within it and length, in order.
    A document's ids are those of its whole text and ``end_id``; one longer than a sequence is
    cut into pieces that ``start`` puts together again. A tokenizer with ids beyond 16 bits is
    refused unless ``wide``. Null and empty texts are one end id.
    Repeated rows are packed as often as they occur; a null id stays null. An empty table
    gives an empty result. Other columns are not read.
    """
    if not 0 < capacity:
        raise ValueError("a sequence holds one id at least")
    vocabulary = vocabulary_of(documents.sparkSession, vocabulary_path)
    largest = max(check_vocabulary(vocabulary.value) - 1, end_id, pad_id)
    if not wide and largest > 0xFFFF:
        raise ValueError(f"ids up to {largest} need 32 bits: wide=True")
    rows = documents.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text")
    )
    kind = "<u4" if wide else "<u2"
    packed = _packed(vocabulary, capacity, end_id, pad_id, kind, block_tokens)
    return rows.mapInArrow(packed, SCHEMA)


def write_matrices(packed: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Write the packed sequences as Parquet; matrix rows of a block stay in order."""
    packed.write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(path)


def positions(n_tokens: int, resets: list[int]) -> np.ndarray:
    """The position of each id within its segment."""
    at = np.arange(n_tokens)
    starts = np.asarray(resets)
    return at - starts[np.searchsorted(starts, at, side="right") - 1]


def segment_ids(ids: bytes, segment_ends: list[int], wide: bool = False) -> list[np.ndarray]:
    """The ids of each segment of a sequence."""
    row = np.frombuffer(ids, "<u4" if wide else "<u2")
    return np.split(row[: segment_ends[-1]], segment_ends[:-1])
