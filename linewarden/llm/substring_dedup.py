"""Repeated word windows by level-wise doubling.

Windows of half the wanted length are looked at first, and only where one of them is
repeated are they extended to the double length, which the next level settles. At the
first level not every position is needed: a window of the full length holds several half
windows, and the one with the smallest hash (the leftmost of equals) depends on the window's
words alone. So equal windows agree on it wherever they stand, and only these chosen half
windows are shuffled. No window is lost: if a full window is repeated, its chosen half window
is repeated as well.

Documents are dealt into chunks by id and text, so that rows without an id or of a frequent
one are spread, and windows into buckets by hash. A chunk sends each
distinct hash once, and a bucket answers per chunk, so a passage in a third of all documents
costs one entry per chunk and not one per document. All three passes over the text read the
same shuffle.
"""

from __future__ import annotations

import hashlib
import math
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden.llm.words import ROLL_A, ROLL_B, buckets_of, utf8, window_hashes, word_hashes

HALF_SCHEMA = "bucket long, chunk long, hashes binary"
FULL_SCHEMA = (
    "bucket long, chunk long, hashes binary, checks binary, ids binary, starts binary, "
    "places binary"
)
RESULT_SCHEMA = (
    "doc_id long, n_words long, n_removed long, kept_sha256 string, "
    "removed array<struct<start:long,end:long>>"
)


class Chunk:
    """The documents of one chunk, ordered by id and text, as one array of word hashes."""

    def __init__(self, table: pa.Table, window: int):
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i]))
        self.ids = [ids[i] for i in order]
        self.words = [texts[i].split() for i in order]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.begins = self.ends - self.lengths
        self.hashes = word_hashes([w for words in self.words for w in words])
        self.window, self.half = window, window // 2
        self.row = np.repeat(np.arange(len(order)), self.lengths)
        # Places where a full window starts that stays inside its document.
        last = np.repeat(self.ends, self.lengths) - window
        self.places = np.flatnonzero(np.arange(len(self.hashes)) <= last)

    def half_windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of the chosen half windows, whether the chunk repeats them, and for
        each full window the number of its chosen one."""
        if not len(self.places):
            nothing = np.empty(0, np.int64)
            return np.empty(0, np.uint64), np.empty(0, bool), nothing
        all_halves = window_hashes(self.hashes, self.half, ROLL_A)
        span = self.window - self.half + 1
        view = np.lib.stride_tricks.sliding_window_view(all_halves, span)
        least = np.empty(len(self.places), np.int64)
        for start in range(0, len(least), 1 << 16):
            part = self.places[start : start + (1 << 16)]
            least[start : start + len(part)] = part + view[part].argmin(axis=1)
        chosen, of_window = np.unique(least, return_inverse=True)
        distinct, number, counts = np.unique(
            all_halves[chosen], return_inverse=True, return_counts=True
        )
        return distinct, counts > 1, number[of_window]

    def full_windows(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of the full windows at these places: 64 and 32 bits."""
        first = window_hashes(self.hashes, self.window, ROLL_A)[places]
        second = window_hashes(self.hashes, self.window, ROLL_B)[places]
        return first, (second >> np.uint64(32)).astype(np.uint32)

    def order(self, places: np.ndarray) -> np.ndarray:
        """Order of (id, start); rows that share an id share its rank."""
        rank = np.zeros(len(self.ids), np.int64)
        rank[1:] = np.cumsum([a != b for a, b in zip(self.ids[1:], self.ids)])
        row = self.row[places]
        return (rank[row] << 40) + places - self.begins[row]


def _has_earlier(first: np.ndarray, check: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Which windows have an equal window of a smaller order."""
    by = np.argsort(first)
    same = first[by][1:] == first[by][:-1]
    repeated = np.zeros(len(by), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    by = by[repeated]
    by = by[np.lexsort((order[by], check[by], first[by]))]
    new = np.ones(len(by), bool)
    new[1:] = (first[by][1:] != first[by][:-1]) | (check[by][1:] != check[by][:-1])
    starts = np.flatnonzero(new)
    earlier = np.zeros(len(first), bool)
    if len(by):
        earlier[by] = order[by] > order[by[starts[np.cumsum(new) - 1]]]
    return earlier


def _by_bucket(chunk: int, buckets: int, hashes: np.ndarray, *more: np.ndarray) -> list[tuple]:
    """One row per bucket that gets something; the order within a bucket is kept."""
    number = buckets_of(hashes, buckets)
    by = np.argsort(number, kind="stable")
    full, starts = np.unique(number[by], return_index=True)
    bounds = [*starts.tolist(), len(by)]
    arrays = [a[by] for a in (hashes, *more)]
    return [
        (b, chunk, *(a[start:end].tobytes() for a in arrays))
        for b, start, end in zip(full.tolist(), bounds, bounds[1:])
    ]


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    types = [pa.int64() if n in ("bucket", "chunk") else pa.binary() for n in names]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names)


def _half_level(window: int, buckets: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        distinct, _, _ = Chunk(table, window).half_windows()
        rows = _by_bucket(key[0].as_py(), buckets, distinct)
        return _table(rows, ["bucket", "chunk", "hashes"])

    return run


def _loaded(table: pa.Table, *columns: tuple[str, type]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The chunk number of each entry and the entries' arrays, over all rows of a bucket."""
    arrays = [
        np.concatenate([np.frombuffer(b, kind) for b in table.column(name).to_pylist()])
        for name, kind in columns
    ]
    width = np.dtype(columns[0][1]).itemsize
    sizes = [len(b) // width for b in table.column(columns[0][0]).to_pylist()]
    return np.repeat(table.column("chunk").to_numpy(), sizes), arrays


def _answers(chunks: np.ndarray, values: np.ndarray) -> pa.Table:
    by = np.argsort(chunks, kind="stable")
    chunks, values = chunks[by], values[by]
    distinct, starts = np.unique(chunks, return_index=True)
    bounds = [*starts.tolist(), len(chunks)]
    rows = [
        (int(c), values[a:z].tobytes()) for c, a, z in zip(distinct, bounds, bounds[1:])
    ]
    return _table(rows, ["chunk", "found"])


def _repeated_halves(table: pa.Table) -> pa.Table:
    """Per chunk the half windows that another chunk has too."""
    chunks, (hashes,) = _loaded(table, ("hashes", np.uint64))
    by = np.argsort(hashes, kind="stable")
    same = hashes[by][1:] == hashes[by][:-1]
    repeated = np.zeros(len(by), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    return _answers(chunks[by][repeated], hashes[by][repeated])


def _found(table: pa.Table, kind: type) -> np.ndarray:
    parts = [np.frombuffer(b, kind) for b in table.column("found").to_pylist()]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _full_level(window: int, buckets: int):
    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["bucket", "chunk", "hashes", "checks", "ids", "starts", "places"]
        if not table.num_rows:
            return _table([], names)
        chunk = Chunk(table, window)
        distinct, repeated, half_of = chunk.half_windows()
        repeated = repeated | np.isin(distinct, _found(answers, np.uint64))
        places = chunk.places[repeated[half_of]] if len(distinct) else chunk.places
        first, check = chunk.full_windows(places)
        own = np.flatnonzero(~_has_earlier(first, check, chunk.order(places)))
        places = places[own]
        no_id = np.iinfo(np.int64).min
        ids = np.array([no_id if i is None else i for i in chunk.ids], np.int64)
        row = chunk.row[places]
        starts = (places - chunk.begins[row]).astype(np.uint32)
        rows = _by_bucket(
            key[0].as_py(),
            buckets,
            first[own],
            check[own],
            ids[row],
            starts,
            places.astype(np.uint32),
        )
        return _table(rows, names)

    return run


def _later_windows(table: pa.Table) -> pa.Table:
    """Per chunk the places of its first windows that start earlier in another chunk."""
    chunks, (first, check, ids, starts, places) = _loaded(
        table,
        ("hashes", np.uint64),
        ("checks", np.uint32),
        ("ids", np.int64),
        ("starts", np.uint32),
        ("places", np.uint32),
    )
    rank = np.unique(ids, return_inverse=True)[1]
    later = np.flatnonzero(_has_earlier(first, check, (rank << 32) + starts))
    return _answers(chunks[later], places[later])


def _removal(window: int):
    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_pylist([], schema=_RESULT)
        chunk = Chunk(table, window)
        places = chunk.places
        first, check = chunk.full_windows(places)
        removed = _has_earlier(first, check, chunk.order(places))
        removed |= np.isin(places, _found(answers, np.uint32).astype(np.int64))
        # A word is covered if more removed windows began than ended at or before it.
        change = np.zeros(len(chunk.hashes) + window + 1, np.int64)
        np.add.at(change, places[removed], 1)
        np.add.at(change, places[removed] + window, -1)
        covered = np.cumsum(change)[: len(chunk.hashes)] > 0
        return pa.Table.from_pylist(
            [
                _document(doc_id, words, covered[a:z])
                for doc_id, words, a, z in zip(chunk.ids, chunk.words, chunk.begins, chunk.ends)
            ],
            schema=_RESULT,
        )

    return run


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)


def _document(doc_id: int | None, words: list[bytes], covered: np.ndarray) -> dict:
    edges = np.flatnonzero(np.diff(covered, prepend=False, append=False))
    kept = compress(words, (~covered).tolist()) if len(edges) else words
    return {
        "doc_id": doc_id,
        "n_words": len(words),
        "n_removed": int(covered.sum()),
        "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(),
        "removed": [
            {"start": int(a), "end": int(z)} for a, z in zip(edges[::2], edges[1::2])
        ],
    }


def remove_repeated_windows(
    documents: DataFrame,
    window: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_bytes: int = 4 << 20,
    bucket_bytes: int = 32 << 20,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and ``removed`` spans.

    Words are runs of bytes other than ``[\\x20\\x09-\\x0D]``. A window is ``window`` words in a
    row within a document. Each word is removed that lies in a window whose words also start
    earlier: in a document of a smaller id, or at an earlier word of the same id. All windows
    are judged on the input. ``removed`` holds half-open ranges of word numbers;
    ``kept_sha256`` is of the other words joined by single spaces.

    Null texts have no words, texts shorter than a window lose none. Rows that share an id
    are one document for the order and separate rows otherwise: of two equal rows neither
    is earlier. A null id is the smallest. An empty table gives an empty result. Other columns
    are not read. Equality of windows is decided on 96 hash bits.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    total = documents.agg(F.sum(F.octet_length(F.col(f"`{text_column}`")).cast("long"))).first()[0]
    chunks = max(1, math.ceil((total or 0) / chunk_bytes))
    buckets = max(1, math.ceil((total or 0) / bucket_bytes))
    doc_id = F.col(f"`{id_column}`").cast("long")
    chunked = documents.select(
        F.pmod(F.xxhash64(doc_id, utf8(text_column)), F.lit(chunks)).alias("chunk"),
        doc_id.alias("doc_id"),
        utf8(text_column).alias("text"),
    )
    answer = "chunk long, found binary"
    halves = chunked.groupBy("chunk").applyInArrow(_half_level(window, buckets), HALF_SCHEMA)
    repeated = halves.groupBy("bucket").applyInArrow(_repeated_halves, answer)
    full = (
        chunked.groupBy("chunk")
        .cogroup(repeated.groupBy("chunk"))
        .applyInArrow(_full_level(window, buckets), FULL_SCHEMA)
    )
    later = full.groupBy("bucket").applyInArrow(_later_windows, answer)
    return (
        chunked.groupBy("chunk")
        .cogroup(later.groupBy("chunk"))
        .applyInArrow(_removal(window), RESULT_SCHEMA)
    )
