from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from linewarden.llm.substring_dedup import remove_repeated_windows


def brute(rows, window):
    """Per row: words, removed, digest of the kept words; rows are (id, text)."""
    words = [(t or "").encode().split() for _, t in rows]
    order = [(i is not None, i or 0) for i, _ in rows]
    first = {}
    for row, own in enumerate(words):
        for start in range(len(own) - window + 1):
            key = tuple(own[start : start + window])
            first[key] = min(first.get(key, (order[row], start)), (order[row], start))
    result = []
    for row, own in enumerate(words):
        gone = set()
        for start in range(len(own) - window + 1):
            if first[tuple(own[start : start + window])] < (order[row], start):
                gone.update(range(start, start + window))
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone)
        result.append((rows[row][0], len(own), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=repr)


def found(frame, window, **sizes):
    rows = remove_repeated_windows(frame, window, **sizes).collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
    return sorted((tuple(r)[:4] for r in rows), key=repr)


def test_documents(documents, texts):
    assert found(documents, 20) == brute(list(texts.items()), 20)


@pytest.mark.parametrize("window,seed", [(2, 1), (5, 2), (8, 3), (20, 4)])
def test_passages_that_repeat(make, window, seed):
    """Passages shared across and within documents, over many chunks and buckets."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12 if window < 8 else 400)]
    passages = [draw.choices(vocabulary, k=draw.randint(window, 4 * window)) for _ in range(6)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(draw.randint(0, 5)):
            words += draw.choices(vocabulary, k=draw.randint(0, window))
            words += draw.choice(passages)[draw.randint(0, 3) :]
        rows.append((draw.randint(0, 120), "  ".join(words)))
    assert found(make(rows), window, chunk_bytes=300, bucket_bytes=3000) == brute(rows, window)


def test_frequent_id_is_spread_over_chunks(make):
    """Rows of one id, or of none, with different texts: all in order of their starts."""
    draw = random.Random(7)
    passages = [[f"p{k}x{i}" for i in range(9)] for k in range(4)]
    rows = []
    for i in range(120):
        words = draw.choices(["a", "b", "c", "d", "e", "f"], k=draw.randint(0, 6))
        words += draw.choice(passages) + [f"own{i}"]
        rows.append((None if i % 3 == 0 else 5 if i % 3 == 1 else i, " ".join(words)))
    assert found(make(rows), 6, chunk_bytes=400, bucket_bytes=2000) == brute(rows, 6)


def test_one_word_over_and_over(make):
    rows = [(i, "same " * n) for i, n in enumerate([0, 5, 19, 20, 21, 60, 300])]
    assert found(make(rows), 20) == brute(rows, 20)


def test_odd_rows(odd, make):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    expected = brute(rows, 20)
    assert found(odd, 20) == expected
    assert max(n for *_, n, _ in expected) == 30_000
    assert found(make([]), 20) == []


def test_hashes_tell_windows_apart():
    from linewarden.llm.words import ROLL_A, window_hashes, word_hashes

    words = [str(i % 7).encode() for i in range(500)]
    hashes = window_hashes(word_hashes(words), 6, ROLL_A)
    keys = [tuple(words[i : i + 6]) for i in range(495)]
    assert len(np.unique(hashes)) == len(set(keys))
