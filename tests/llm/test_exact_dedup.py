from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np

from linewarden.llm.exact_dedup import (
    KEY,
    _ranges,
    _run_rows,
    digest_groups,
    drop_exact_duplicates,
    exact_duplicates,
    text_digests,
)
from linewarden.session import materialize


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def test_against_brute_force(documents, texts):
    groups = defaultdict(list)
    for doc_id, text in texts.items():
        groups[normal(text)].append(doc_id)
    expected = {
        (i, min(ids), len(ids), i == min(ids), hashlib.sha256(text.encode()).digest())
        for text, ids in groups.items()
        for i in ids
    }
    rows = exact_duplicates(documents).select(
        "doc_id", "keep_id", "group_size", "kept", "digest"
    )
    assert {(*r[:4], bytes(r[4])) for r in rows.collect()} == expected


def test_many_runs_merge_to_the_same_groups(documents):
    """Several ranges and a tree of more than two levels."""
    digests = text_digests(documents, "doc_id", "text").repartition(19)
    digests.write.mode("overwrite").parquet(path := materialize_path(documents))
    stored = documents.sparkSession.read.parquet(path)
    stored = stored.repartition(19)
    few = {tuple(r) for r in digest_groups(stored, rows_per_range=10**9).collect()}
    many = digest_groups(stored, rows_per_range=100, fan_in=2).collect()
    assert len(many) == len(few) and {tuple(r) for r in many} == few


def test_ranges_grow_with_the_rounds():
    """A first run is cut by its own size, whatever the size of the table."""
    assert _ranges(0, 100, 4) == _ranges(100, 100, 4) == 1
    assert _ranges(101, 100, 4) == 4 and _ranges(10**6, 100, 4) == 4**7
    keys = np.sort(np.frombuffer(random.Random(1).randbytes(4000), KEY))
    arrays = (keys, np.arange(100), np.zeros(100, bool), np.ones(100, int), np.ones(100, int))
    coarse, fine = _run_rows(4, 0, arrays), _run_rows(16, 0, arrays)
    parts = zip(fine.column(0).to_pylist(), fine.column(2).to_pylist())
    below = defaultdict(bytes)
    for number, held in parts:
        below[number // 4] += held
    assert dict(below) == dict(zip(coarse.column(0).to_pylist(), coarse.column(2).to_pylist()))


def materialize_path(frame):
    from linewarden.session import scratch_path

    return scratch_path(frame.sparkSession, "digests_test")


def test_odd_rows(odd):
    rows = exact_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add((r["keep_id"], r["group_size"], r["kept"]))
    assert by_id[1] == {(1, 3, True)} and by_id[2] == {(1, 3, False)}
    assert by_id[3] == {(3, 1, True)}
    assert by_id[None] == {(1, 3, False), (None, 1, True)}
    assert by_id[4] == {(4, 3, True), (4, 1, True)} and by_id[5] == {(4, 3, False)}
    assert by_id[7] == {(6, 2, False)}


def test_one_row_of_each_group_stays(odd):
    kept = drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    texts = [normal(r["text"]) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({normal(r["text"]) for r in odd.collect()})


def test_empty_table(make):
    empty = make([])
    assert exact_duplicates(empty).count() == 0
    assert drop_exact_duplicates(empty).count() == 0


def test_materialized_copy_is_read_back(documents):
    assert materialize(documents.limit(3), "copy").count() == 3
