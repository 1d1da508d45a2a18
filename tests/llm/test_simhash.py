from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from linewarden.llm import simhash
from linewarden.llm.components import components


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    if len(words) < 3:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def plain_components(prints, radius=3):
    """Smallest id per group of (id, fingerprint) pairs, by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = defaultdict(lambda: float("inf"))
    for i, (doc_id, _) in enumerate(prints):
        least[find(i)] = min(least[find(i)], doc_id)
    return {doc_id: least[find(i)] for i, (doc_id, _) in enumerate(prints)}


def test_against_brute_force(documents, texts):
    prints = [(i, plain_fingerprint(t)) for i, t in texts.items()]
    roots = plain_components(prints)
    expected = {(i, p, roots[i]) for i, p in prints}
    rows = simhash.near_duplicates(documents).collect()
    assert len(rows) == len(prints)
    assert {(r[0], r[1] & (1 << 64) - 1, r[2]) for r in rows} == expected


def clustered(seed, n):
    """Fingerprints with chains and tight clusters."""
    draw = random.Random(seed)
    prints = {draw.getrandbits(64) for _ in range(n // 3)}
    for base in list(prints)[: n // 30]:
        at = base
        for _ in range(20):
            for bit in draw.sample(range(64), draw.randint(1, 5)):
                at ^= 1 << bit
            prints.add(at)
    return sorted(prints)


@pytest.mark.parametrize("seed", range(4))
def test_trees_find_every_link(seed):
    prints = np.array(clustered(seed, 900), np.uint64)
    n = len(prints)
    roots = np.zeros(n, np.int64)
    a, b = simhash.bk_search(prints, roots, simhash.bk_forest(prints, roots), np.arange(n), 3)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    expected = {(i, j) for i, j in zip(*np.nonzero(near)) if j < i}
    assert set(zip(a.tolist(), b.tolist())) == expected


@pytest.mark.parametrize("shard_rows,depth", [(10**6, 1), (4, 1), (4, 2), (4, 3), (50, 1)])
def test_shards_lose_no_link(spark, shard_rows, depth):
    prints = clustered(11, 1500)
    signed = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    frame = spark.createDataFrame(signed, "print long, id int")
    links = simhash.near_links(frame, 3, shard_rows, depth)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    ids = dict(signed)
    least = defaultdict(lambda: 10**9)
    for p, i in signed:
        root = roots.get(p, p)
        least[root] = min(least[root], i)
    expected = plain_components([(i, p & (1 << 64) - 1) for p, i in signed])
    assert {i: least[roots.get(p, p)] for p, i in ids.items()} == expected


def test_dense_shard_is_cut_into_blocks(spark):
    """Fingerprints that agree on all blocks but one stay together at every depth."""
    frame = spark.range(900).selectExpr("id * 8 AS print")
    rows = simhash.shards(frame, 3, 100, 2)
    sizes = rows.groupBy("level", "path", "value", "pair").count().agg({"count": "max"}).first()[0]
    assert sizes < 300
    links = simhash.near_links(frame, 3, 100, 2)
    assert {r["root"] for r in components(links).collect()} == {0}


def test_long_chain_is_one_component(spark):
    links = spark.range(400).selectExpr("id AS u", "id + 1 AS v").repartition(5)
    rows = components(links).collect()
    assert {r["node"] for r in rows} == set(range(401)) and {r["root"] for r in rows} == {0}
    assert components(links.filter("u < 0")).count() == 0


def test_odd_rows(odd, make):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    blank = {r["component_id"] for r in rows if r["doc_id"] in (1, 2, 3)}
    assert blank == {1} and {r["print"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert {r["component_id"] for r in rows if r["doc_id"] in (6, 7)} == {6}
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert not {2, 3, 5, 7} & {r["doc_id"] for r in kept.collect()}
    assert simhash.near_duplicates(make([])).count() == 0
    assert simhash.drop_near_duplicates(make([])).count() == 0


def test_rows_are_judged_by_their_own_text(make):
    base = " ".join(f"word{i}" for i in range(400))
    near = base + " more"
    other = " ".join(f"else{i}" for i in range(300))
    rows = [(3, base), (4, near), (4, other), (None, near + " a"), (None, other + " b")]
    rows += [(None, "alone and without an id"), (None, "alone and without an id")]
    kept = [(r["doc_id"], r["text"]) for r in simhash.drop_near_duplicates(make(rows)).collect()]
    assert sorted(kept, key=repr) == sorted(
        [(3, base), (4, other), (None, "alone and without an id")], key=repr
    )


def test_near_copies_without_ids_leave_one(make):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(None, base), (None, base + " x"), (None, base + " y"), (None, base)]
    assert simhash.drop_near_duplicates(make(rows)).count() == 1
