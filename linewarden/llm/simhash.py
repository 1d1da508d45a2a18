"""SimHash near duplicates, searched in BK-trees.

Fingerprints within ``radius`` bits agree on at least one of ``radius + 1`` bit blocks, so
distinct fingerprints are dealt into shards by block and block value, and a BK-tree is built
and queried per shard, in the task the shuffle brings the shard to. The trees together grow
with the data; that is why none of them is sent to all tasks. A shard that is still large is
dealt again by blocks of its remaining bits, where the same rule holds. Only a spanning set
of links leaves a shard, so a large group of near copies costs no more links than it has
members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.llm.components import components
from linewarden.llm.words import rows_of, utf8
from linewarden.session import materialize

BITS = 64
SEED = 42


# --- fingerprints -------------------------------------------------------------------------


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words joined by a space, repeats included.

    A text of fewer words is one shingle; a text without words has none.
    """
    if len(words) <= size:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    digest = partial(xxhash.xxh64_digest, seed=SEED)
    return np.frombuffer(b"".join(map(digest, shingles)), ">u8")


def fingerprint(hashes: np.ndarray) -> int:
    """Bit b is 1 if it is set in over half of the hashes; 0 without hashes."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 14):
        part = hashes[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">u8")[0])


def _fingerprints(size: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(
                (
                    fingerprint(shingle_hashes(text.lower().split(), size))
                    for (text,) in rows_of(iter([batch]), "text")
                ),
                np.uint64,
                batch.num_rows,
            )
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array(prints.view(np.int64))], [*kept, "print"]
            )

    return build


def fingerprints(
    documents: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and print (the 64 bits as a signed long) of every row, in the rows' order."""
    rows = documents.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text")
    )
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, print long")


# --- BK-trees -----------------------------------------------------------------------------


def bk_forest(prints: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """BK-trees over distinct fingerprints: child[node, distance] or -1.

    ``roots[i]`` is the item that is the root of item i's tree. All items walk down at once;
    where several meet at one missing edge, the first becomes the child, the others go on
    below it.
    """
    n = len(prints)
    child = np.full((n, BITS + 1), -1, np.int32)
    items = np.flatnonzero(roots != np.arange(n))
    at = roots[items]
    while len(items):
        distance = np.bitwise_count(prints[items] ^ prints[at])
        edges = at.astype(np.int64) * (BITS + 1) + distance
        missing = np.flatnonzero(child.ravel()[edges] < 0)
        if len(missing):
            new, first = np.unique(edges[missing], return_index=True)
            child.ravel()[new] = items[missing[first]]
        at = child.ravel()[edges]
        going = at != items
        items, at = items[going], at[going]
    return child


def bk_search(
    prints: np.ndarray, roots: np.ndarray, child: np.ndarray, queries: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, smaller item) within the radius, along edges within the radius only."""
    found_a, found_b = [], []
    steps = np.arange(-radius, radius + 1)
    query, node = queries, roots[queries]
    while len(query):
        distance = np.bitwise_count(prints[query] ^ prints[node]).astype(np.int64)
        hit = (distance <= radius) & (node < query)
        found_a.append(query[hit])
        found_b.append(node[hit])
        edges = distance[:, None] + steps
        below = child[node[:, None], np.clip(edges, 0, BITS)]
        keep = (below >= 0) & (edges >= 0) & (edges <= BITS)
        query, node = np.repeat(query, keep.sum(1)), below[keep]
    return np.concatenate(found_a or [queries]), np.concatenate(found_b or [queries])


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]; a label is the smallest item of its group."""
    while True:
        least = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, labels[a], least)
        np.minimum.at(new, labels[b], least)
        while not np.array_equal(new, again := new[new]):
            new = again
        if np.array_equal(new, labels):
            return labels
        labels = new


def spanning_links(
    prints: np.ndarray, shard: np.ndarray, radius: int, visits: int = 2_000_000
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the items of each shard that lie within the radius of another.

    ``shard`` is sorted. Queries run in blocks whose visited nodes stay below ``visits``.
    """
    n = len(prints)
    starts = np.searchsorted(shard, shard, side="left")
    sizes = np.searchsorted(shard, shard, side="right") - starts
    child = bk_forest(prints, starts)
    labels = np.arange(n)
    alone = sizes > 1
    queries = np.flatnonzero(alone)
    block = np.cumsum(sizes[queries]) // visits
    for number in np.unique(block):
        part = queries[block == number]
        labels = _joined(labels, *bk_search(prints, starts, child, part, radius))
    linked = np.flatnonzero(labels != np.arange(n))
    return prints[linked], prints[labels[linked]]


# --- shards -------------------------------------------------------------------------------


def block_masks(free: int, blocks: int) -> list[int]:
    """The set bits of ``free`` cut into ``blocks`` runs of nearly equal length, as masks."""
    bits = [b for b in range(BITS) if free >> b & 1]
    cuts = [len(bits) * i // blocks for i in range(blocks + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _dealt(rows: DataFrame, masks: list[int], blocks: int) -> tuple[DataFrame, list[int]]:
    """Each row once per further block of the bits its mask leaves free.

    ``masks[path]`` holds the bits that the shards of a path agree on.
    """
    below = [
        [mask | part for part in block_masks(~mask & ((1 << BITS) - 1), blocks)] for mask in masks
    ]
    children = F.array(*[
        F.array(*[
            F.struct(
                F.lit(path * blocks + i).alias("path"), F.lit(_signed(mask)).cast("long").alias("m")
            )
            for i, mask in enumerate(own)
        ])
        for path, own in enumerate(below)
    ])
    dealt = rows.select("print", F.explode(F.element_at(children, F.col("path") + 1)).alias("s"))
    return (
        dealt.select("print", F.col("s.path").alias("path"), _bits(F.col("s.m")).alias("value")),
        [mask for own in below for mask in own],
    )


def _bits(mask: Column) -> Column:
    return F.col("print").bitwiseAND(mask)


def shards(prints: DataFrame, radius: int, shard_rows: int, depth: int) -> DataFrame:
    """level, path, value, pair, print: every distinct fingerprint in its shards.

    Shards of more than ``shard_rows`` are dealt again, ``depth`` times at most; any two
    fingerprints within the radius still share a shard at every depth. One that is larger even
    then is cut into blocks, and every two blocks make a shard: no task holds more than about
    twice ``shard_rows`` of one shard.
    """
    blocks = radius + 1
    rows, masks = _dealt(prints.select("print", F.lit(0).alias("path")), [0], blocks)
    done, columns = None, ("level", "path", "value", "pair", "print")
    for number in range(depth):
        rows = materialize(rows, "simhash_shards")
        large = materialize(
            rows.groupBy("path", "value").count().filter(F.col("count") > shard_rows),
            "simhash_large",
        )
        # A path number is unique within its depth; the level keeps depths apart.
        level, whole = F.lit(len(masks)).alias("level"), F.lit(0).cast("long").alias("pair")
        if large.isEmpty():
            rows = rows.select("*", level, whole).select(*columns)
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, ["path", "value"], "left_anti")
        small = small.select("*", level, whole).select(*columns)
        done = small if done is None else done.unionByName(small)
        rest = rows.join(large, ["path", "value"])
        if number < depth - 1:
            rows, masks = _dealt(rest.drop("count"), masks, blocks)
    return done.unionByName(_block_pairs(rest, shard_rows).select("*", level).select(*columns))


def _block_pairs(rows: DataFrame, shard_rows: int) -> DataFrame:
    """Each row of a shard of ``count`` rows once per other block of it, with the pair's number."""
    blocks = F.ceil(F.col("count") / shard_rows)
    rows = rows.withColumn("blocks", blocks)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("print"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    first, second = F.least("own", "other"), F.greatest("own", "other")
    return rows.filter(F.col("own") != F.col("other")).select(
        "path", "value", "print", (first * F.col("blocks") + second).alias("pair")
    )


def _links_of(radius: int, block_rows: int):
    """Links within each shard of a partition that is sorted by shard."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 5), np.int64)
        for batch in batches:
            new = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            held = np.concatenate([held, new.astype(np.int64)])
            if len(held) < block_rows:
                continue
            last = np.flatnonzero((held[1:, :4] != held[:-1, :4]).any(axis=1))
            if len(last):
                yield links(held[: last[-1] + 1])
                held = held[last[-1] + 1 :]
        yield links(held)

    def links(rows: np.ndarray) -> pa.RecordBatch:
        new = np.zeros(len(rows), np.int64)
        new[1:] = (rows[1:, :4] != rows[:-1, :4]).any(axis=1)
        a, b = spanning_links(
            np.ascontiguousarray(rows[:, 4]).view(np.uint64), np.cumsum(new), radius
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"]
        )

    return build


def near_links(
    prints: DataFrame, radius: int = 3, shard_rows: int = 4096, depth: int = 3
) -> DataFrame:
    """u, v: links that connect distinct fingerprints within ``radius`` bits of each other."""
    dealt = shards(prints, radius, shard_rows, depth)
    key = ("level", "path", "value", "pair")
    sorted_shards = dealt.repartition(*key).sortWithinPartitions(*key, "print")
    return sorted_shards.mapInArrow(_links_of(radius, 100_000), "u long, v long")


def near_duplicates(
    documents: DataFrame,
    shingle: int = 3,
    radius: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, print, component_id.

    Words are cut at white space after lower-casing A-Z. Null and blank texts have the
    fingerprint zero, which links like any other. ``component_id`` is the smallest id
    reachable over links of at most ``radius`` bits, the row's own included; rows without an
    id are linked too, but their id is never the smallest unless the group has no other.
    Repeated rows share their component. An empty table gives an empty result. Other columns
    are not read.
    """
    rows = materialize(fingerprints(documents, shingle, id_column, text_column), "prints")
    prints = materialize(
        rows.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct_prints"
    )
    roots = materialize(components(near_links(prints, radius)), "components")
    linked = prints.join(roots, prints["print"] == roots["node"])
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(smallest, "root").select("print", "component_id")
    single = prints.join(roots, prints["print"] == roots["node"], "left_anti").select(
        "print", F.col("first_id").alias("component_id")
    )
    return rows.join(linked.unionByName(single), "print", "left").select(
        "doc_id", "print", "component_id"
    )


def drop_near_duplicates(
    documents: DataFrame,
    shingle: int = 3,
    radius: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One document of each linked group, columns unchanged.

    It is that of the smallest id; a row without an id stays only if the group has no other.
    Of rows that share this id the one of the smallest text hash stays, and of rows that
    repeat both id and text exactly one. Rows are told apart by id and text, so a row whose id
    also belongs to a near copy of something else is judged by its own text.
    """
    own_id = F.col(f"`{id_column}`").cast("long")
    own_hash = F.xxhash64(utf8(text_column))
    texts = documents.select(
        own_id.alias("doc_id"), own_hash.alias("text_hash"), utf8(text_column).alias("text")
    )
    schema = "doc_id long, text_hash long, print long"
    rows = materialize(texts.mapInArrow(_fingerprints(shingle), schema), "prints")
    prints = materialize(rows.select("print").distinct(), "distinct_prints")
    roots = materialize(components(near_links(prints, radius)), "components")
    linked = rows.join(roots, rows["print"] == roots["node"], "left").select(
        "doc_id", "text_hash", F.coalesce("root", "print").alias("group")
    )
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    groups = linked.groupBy("group").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (
        F.col("text_hash") == F.col("first.text_hash")
    )
    # One entry per document and text of groups of two rows or more.
    marked = materialize(
        linked.join(groups.filter(F.col("n") > 1), "group")
        .groupBy(F.col("doc_id").alias("_near_id"), F.col("text_hash").alias("_near_hash"))
        .agg(F.first(is_first).alias("_near_stays"), F.count("*").alias("_near_rows")),
        "near_marked",
    )
    keyed = documents.select("*", own_id.alias("_near_own_id"), own_hash.alias("_near_own_hash"))
    same = F.col("_near_own_id").eqNullSafe(F.col("_near_id")) & (
        F.col("_near_own_hash") == F.col("_near_hash")
    )
    again = marked.filter(F.col("_near_stays") & (F.col("_near_rows") > 1))
    gone = marked.filter(~F.col("_near_stays") | (F.col("_near_rows") > 1))
    rest = keyed.join(gone, same, "left_anti")
    if not again.isEmpty():
        once = keyed.join(again, same, "left_semi")
        rest = rest.unionByName(once.dropDuplicates(["_near_own_id", "_near_own_hash"]))
    return rest.select(*[F.col(f"`{c}`") for c in documents.columns])
