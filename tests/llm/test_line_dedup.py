from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np

from linewarden.llm.line_dedup import BloomFilter, drop_repeated_lines


def brute(rows, least, shortest=1):
    """(doc_id, n_lines, n_dropped, kept_sha256) of each row."""
    split = [(i, (t or "").split("\n")) for i, t in rows]
    white = " \t\n\v\f\r"
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = Counter(
        key
        for _, lines in split
        for key in {line.strip(white).translate(upper) for line in lines}
        if len(key) >= shortest
    )
    out = []
    for doc_id, lines in split:
        kept = [x for x in lines if held[x.strip(white).translate(upper)] < least]
        text = "\n".join(kept).encode()
        out.append(
            (doc_id, len(lines), len(lines) - len(kept), hashlib.sha256(text).hexdigest())
        )
    return sorted(out, key=repr)


def found(frame):
    columns = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_filters_hold_all_that_was_put_in():
    hashes = np.random.default_rng(3).integers(0, 1 << 63, 20_000).astype(np.uint64)
    bloom = BloomFilter(10_000)
    bloom.add(hashes[:10_000])
    assert bloom.holds(hashes[:10_000]).all()
    assert bloom.holds(hashes[10_000:]).mean() < 0.1


def test_equals_brute_force_in_many_chunks(documents, texts):
    rows = list(texts.items())
    result = drop_repeated_lines(documents, 3, chunk_bytes=1 << 17, shard_bytes=1 << 19)
    assert found(result) == brute(rows, 3)


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(drop_repeated_lines(odd, 2)) == brute(rows, 2)
    assert drop_repeated_lines(odd.limit(0), 2).count() == 0


def test_keys_ignore_case_and_outer_white_space_only(make):
    rows = [(1, "Share this\nown"), (2, " \tSHARE THIS\v\r\nother"), (3, "share  this\nÉ")]
    rows += [(4, "é"), (5, None), (6, "\n\n"), (7, "share this"), (7, "share this")]
    assert found(drop_repeated_lines(make(rows), 2)) == brute(rows, 2)


def test_short_keys_stay(make):
    rows = [(i, f"ééé\nabcd\nown {i}") for i in range(4)]
    result = drop_repeated_lines(make(rows), 4, shortest=4)
    assert {tuple(r["dropped"]) for r in result.collect()} == {(1,)}


def test_a_line_counts_once_per_document(make):
    rows = [(1, "x\nx\nx"), (2, "y")]
    assert found(drop_repeated_lines(make(rows), 2)) == brute(rows, 2)


def test_first_occurrence_can_stay(make):
    rows = [(9, "head\nown 9"), (5, "own 5\nhead\nhead"), (7, "head"), (None, "head")]
    result = drop_repeated_lines(make(rows), 2, keep_first=True, chunk_bytes=16)
    dropped = {r["doc_id"]: list(r["dropped"]) for r in result.collect()}
    assert dropped == {9: [0], 5: [2], 7: [0], None: [0]}


def test_text_is_shuffled_once(documents):
    plan = drop_repeated_lines(documents)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "CartesianProduct" not in plan
