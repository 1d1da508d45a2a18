"""Benchmark passages in training documents, found in suffix arrays of the documents.

Each task builds suffix arrays over shards of its documents and looks up every suffix of the
benchmark by binary search, which gives all places where a window of it stands verbatim. The
longest match is then read off a suffix automaton of the benchmark's runs of such windows, in
time that grows with their places in the benchmark plus those in the documents. Words outside the benchmark cannot be part of a match,
so the arrays hold only suffixes that start with enough benchmark words in a row. The
benchmark is sent to the tasks in blocks of bounded size, one pass over the shards per block,
and the rows are written down between passes: the documents are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden.llm.words import rows_of, utf8
from linewarden.session import materialize

# Bytes 0-9, a-z and those of non-ASCII characters make words; A-Z count as a-z.
WORD_BYTES = bytes(
    ord(chr(b).lower()) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(0x80)
) + bytes(range(0x80, 0x100))


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(WORD_BYTES).split()


class Passages:
    """The windows of a block of benchmark items, as keys of word numbers.

    Word 0 stands for every other word. A key is the big-endian numbers of a window's words,
    so that keys compare like word sequences.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        by_length: dict[int, list[tuple[list[int], int, int]]] = {}
        for item, (_, text) in enumerate(items):
            words = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            length = min(window, len(words))
            for start in range(len(words) - length + 1 if length else 0):
                by_length.setdefault(length, []).append(
                    (words[start : start + length], item, start)
                )
        # Per window length: the sorted distinct windows, and for each its items and starts.
        self.lengths = []
        for length, found in sorted(by_length.items()):
            keys = _keys(np.array([words for words, _, _ in found], np.int64))
            distinct, number = np.unique(keys, return_inverse=True)
            by = np.argsort(number, kind="stable")
            bounds = np.searchsorted(number[by], np.arange(len(distinct) + 1))
            items_of = np.array([item for _, item, _ in found], np.int64)[by]
            starts = np.array([start for _, _, start in found], np.int64)[by]
            self.lengths.append((length, distinct, bounds, items_of, starts))
        self.shortest = min(by_length, default=0)


def _keys(numbers: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings in the same order."""
    width = numbers.shape[1]
    return np.ascontiguousarray(numbers.astype(">u4")).view(f"S{4 * width}").ravel()


def suffix_array(numbers: np.ndarray, length: np.ndarray, least: int, depth: int):
    """Places of the suffixes with ``least`` benchmark words or more, sorted by their first
    ``depth`` words, and these words as keys. ``length`` says how many such words follow."""
    places = np.flatnonzero(length >= least)
    padded = np.concatenate([numbers, np.zeros(depth, numbers.dtype)])
    words = padded[places[:, None] + np.arange(depth)]
    # A suffix ends with its run of benchmark words: what follows cannot match.
    words[np.arange(depth) >= length[places][:, None]] = 0
    keys = _keys(words)
    by = np.argsort(keys, kind="stable")
    return places[by], keys[by]


def benchmark_runs(numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many benchmark words of the same document follow from each place on."""
    if not len(numbers):
        return np.zeros(0, np.int64)
    stops = np.unique(np.concatenate([np.flatnonzero(numbers == 0), ends]))
    at = np.arange(len(numbers))
    following = stops[np.searchsorted(stops, at, side="right").clip(max=len(stops) - 1)]
    return np.where(numbers > 0, following - at, 0)


def _prefix_end(windows: np.ndarray, size: int, depth: int) -> np.ndarray:
    """The largest keys of ``depth`` words that start with these windows of ``size`` words."""
    filled = [w.ljust(4 * size, b"\0") + b"\xff" * 4 * (depth - size) for w in windows.tolist()]
    return np.array(filled, f"S{4 * depth}")


class SuffixAutomaton:
    """The runs of windows added so far: which sequences stand in one of them."""

    def __init__(self):
        # By state: the next states, the state of the longest suffix elsewhere, the length.
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, following: dict[int, int], link: int, length: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _redirect(self, state: int, symbol: int, old: int, new: int) -> None:
        while state >= 0 and self.next[state].get(symbol) == old:
            self.next[state][symbol] = new
            state = self.link[state]

    def _exact(self, state: int, symbol: int) -> int:
        """The state of this state's longest sequence and the symbol, split off if needed."""
        old = self.next[state][symbol]
        if self.length[old] == self.length[state] + 1:
            return old
        new = self._state(dict(self.next[old]), self.link[old], self.length[state] + 1)
        self.link[old] = new
        self._redirect(state, symbol, old, new)
        return new

    def add(self, run: tuple[int, ...]) -> None:
        last = 0
        for symbol in run:
            if symbol in self.next[last]:
                last = self._exact(last, symbol)
                continue
            new, state = self._state({}, 0, self.length[last] + 1), last
            while state >= 0 and symbol not in self.next[state]:
                self.next[state][symbol] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._exact(state, symbol)
            last = new

    def longest(self, sequence: list[int]) -> int:
        """The length of the longest part of the sequence that stands in a run."""
        state = length = longest = 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if symbol in self.next[state]:
                state, length = self.next[state][symbol], length + 1
            longest = max(longest, length)
        return longest


class ShardMatches:
    """All occurrences of a block's windows in one shard of documents."""

    def __init__(self, passages: Passages, texts: list[list[bytes]]):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        get = passages.number.get
        numbers = np.fromiter((get(w, 0) for t in texts for w in t), np.int64, self.sizes.sum())
        self.change = np.zeros(len(numbers) + 1, np.int64)
        self.items: list[set[str]] = [set() for _ in texts]
        self.passages = passages
        self.found: list[tuple[int, np.ndarray, list]] = []
        if not passages.lengths:
            return
        runs = benchmark_runs(numbers, self.ends)
        places, keys = suffix_array(numbers, runs, passages.shortest, passages.window)
        for size, windows, bounds, items, starts in passages.lengths:
            # The suffixes that start with a window lie between two places of the array.
            low = np.searchsorted(keys, windows, side="left")
            high = np.searchsorted(
                keys, _prefix_end(windows, size, passages.window), side="right"
            )
            windows_found = np.flatnonzero(high > low)
            for w in windows_found:
                own = items[bounds[w] : bounds[w + 1]]
                self._add(places[low[w] : high[w]], size, {passages.names[i] for i in own})
            self.found += [(size, w, places[low[w] : high[w]]) for w in windows_found]

    def _add(self, at: np.ndarray, size: int, names: set[str]) -> None:
        np.add.at(self.change, at, 1)
        np.add.at(self.change, at + size, -1)
        for document in np.unique(np.searchsorted(self.ends, at, side="right")):
            self.items[document] |= names

    def longest(self) -> np.ndarray:
        """Per document the words of its longest match: windows of one item that follow each
        other in the document as they do in the item form one match."""
        longest = np.zeros(len(self.sizes), np.int64)
        for size, _, at in self.found:
            document = np.searchsorted(self.ends, at, side="right")
            longest[document] = np.maximum(longest[document], size)
        whole = [(w, at) for size, w, at in self.found if size == self.passages.window]
        if not whole:
            return longest
        automaton = SuffixAutomaton()
        for run in self._benchmark_runs([w for w, _ in whole]):
            automaton.add(run)
        at = np.concatenate([at for _, at in whole])
        window = np.concatenate([np.full(len(at), w) for w, at in whole])
        by = np.argsort(at)
        at, window = at[by], window[by]
        document = np.searchsorted(self.ends, at, side="right")
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (document[1:] != document[:-1])
        bounds = [*np.flatnonzero(new).tolist(), len(at)]
        for start, end in zip(bounds, bounds[1:]):
            words = automaton.longest(window[start:end].tolist()) + self.passages.window - 1
            longest[document[start]] = max(longest[document[start]], words)
        return longest

    def _benchmark_runs(self, windows: list[int]) -> set[tuple[int, ...]]:
        """The distinct runs of these windows, whose places follow each other in an item."""
        _, _, bounds, items, starts = self.passages.lengths[-1]
        own = np.concatenate([np.arange(bounds[w], bounds[w + 1]) for w in windows])
        window = np.repeat(windows, [bounds[w + 1] - bounds[w] for w in windows])
        by = np.lexsort((starts[own], items[own]))
        items, starts, window = items[own][by], starts[own][by], window[by]
        new = np.ones(len(by), bool)
        new[1:] = (items[1:] != items[:-1]) | (starts[1:] != starts[:-1] + 1)
        cuts = [*np.flatnonzero(new).tolist(), len(by)]
        return {tuple(window[start:end].tolist()) for start, end in zip(cuts, cuts[1:])}

    def hits(self) -> list[list[dict]]:
        """Per document the half-open word ranges that windows cover."""
        covered = np.cumsum(self.change)[:-1] > 0
        found = []
        for a, z in zip(self.ends - self.sizes, self.ends):
            edges = np.flatnonzero(np.diff(covered[a:z], prepend=False, append=False)).tolist()
            found.append([{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2])])
        return found


def _union(ranges: list[dict]) -> list[dict]:
    merged: list[dict] = []
    for r in sorted(ranges, key=lambda r: r["start"]):
        if merged and r["start"] <= merged[-1]["end"]:
            merged[-1]["end"] = max(merged[-1]["end"], r["end"])
        else:
            merged.append(dict(r))
    return merged


_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text", pa.binary()),
        ("n_words", pa.int64()),
        ("hits", _RANGES),
        ("items", pa.list_(pa.string())),
        ("longest_match", pa.int64()),
    ]
)
SCHEMA = (
    "doc_id long, text binary, n_words long, hits array<struct<start:long,end:long>>, "
    "items array<string>, longest_match long"
)


def _search(block, shard_words: int, last: bool):
    """One pass: look a block of the benchmark up in shards of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = Passages(*block.value)
        held, words = [], 0
        for row in rows_of(batches, *_SCHEMA.names):
            tokens = words_of(row[1])
            held.append((row, tokens))
            words += len(tokens)
            if words >= shard_words or len(held) >= 5000:
                yield matched(passages, held)
                held, words = [], 0
        if held:
            yield matched(passages, held)

    def matched(passages: Passages, held: list) -> pa.RecordBatch:
        shard = ShardMatches(passages, [tokens for _, tokens in held])
        rows = [
            {
                "doc_id": row[0],
                "text": b"" if last else row[1],
                "n_words": len(tokens),
                "hits": _union(row[3] + hits) if row[3] else hits,
                "items": sorted(items.union(row[4])),
                "longest_match": max(row[5], longest),
            }
            for (row, tokens), hits, items, longest in zip(
                held, shard.hits(), shard.items, shard.longest().tolist()
            )
        ]
        return pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return run


def benchmark_blocks(benchmark: DataFrame, id_column: str, text_column: str, block_bytes: int):
    """The items in blocks of about ``block_bytes`` and whether a block is the last: the driver
    holds one block at a time."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("item"),
        utf8(text_column).alias("text"),
    )
    total = items.agg(F.sum(F.octet_length("text")).cast("long")).first()[0] or 0
    blocks = 1 + total // block_bytes
    for number in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
        yield [(r["item"], bytes(r["text"])) for r in block.collect()], number == blocks - 1


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    block_bytes: int = 32 << 20,
    shard_words: int = 400_000,
) -> DataFrame:
    """One row per document: doc_id, n_words, hits, items, longest_match.

    A window is ``window`` words in a row of a benchmark item; an item of fewer words is one
    window. ``hits`` are the half-open ranges of document words inside any occurrence of a
    window, ``items`` the ids (as sorted strings) of the items whose windows occur, and
    ``longest_match`` the words of the longest passage shared with one item, from one window
    up. Null and empty texts have no words; items without words have no window. A null item id
    reads as "". Repeated rows are separate documents, repeated item ids one item. Without
    items nothing is hit; an empty table gives an empty result. Other columns are not read.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        utf8(text_column).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() AS array<struct<start:bigint,end:bigint>>)").alias("hits"),
        F.expr("cast(array() AS array<string>)").alias("items"),
        F.lit(0).cast("long").alias("longest_match"),
    )
    for items, last in benchmark_blocks(benchmark, item_column, text_column, block_bytes):
        block = spark.sparkContext.broadcast((items, window))
        rows = rows.mapInArrow(_search(block, shard_words, last), SCHEMA)
        if not last:
            rows = materialize(rows, "contamination")
            block.destroy()
    return rows.drop("text")


def contamination_report(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of ``find_contamination``."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        "longest_match",
    )


def _clean(block, shard_words: int, text_at: int):
    """The rows of each batch without a word that the block's windows hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = Passages(*block.value)
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary())
            keep: list[bool] = []
            for shard in shards_of(texts, shard_words):
                keep += [not hits for hits in ShardMatches(passages, shard).hits()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def shards_of(texts: pa.Array, shard_words: int) -> Iterator[list[list[bytes]]]:
    """The words of the texts, in lists of at most ``shard_words`` words and one text more."""
    held, words = [], 0
    for start in range(0, len(texts), 512):
        for text in texts.slice(start, 512).to_pylist():
            held.append(words_of(text or b""))
            words += len(held[-1])
            if words >= shard_words:
                yield held
                held, words = [], 0
    if held:
        yield held


def drop_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text_column: str = "text",
    item_column: str = "item_id",
    block_bytes: int = 32 << 20,
    shard_words: int = 400_000,
) -> DataFrame:
    """The documents without a benchmark passage, all columns unchanged.

    The search runs where the rows are, so nothing is joined back or shuffled. What a block of
    the benchmark leaves is written down before the next one is sent.
    """
    context = documents.sparkSession.sparkContext
    rows, text_at = documents, documents.columns.index(text_column)
    for items, last in benchmark_blocks(benchmark, item_column, text_column, block_bytes):
        block = context.broadcast((items, window))
        rows = rows.mapInArrow(_clean(block, shard_words, text_at), documents.schema)
        if not last:
            rows = materialize(rows, "decontaminated")
            block.destroy()
    return rows
