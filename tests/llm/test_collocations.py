from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from linewarden.llm.collocations import (
    collocations,
    counted,
    filter_bytes,
    filter_content,
    permute,
    restore,
)


def values(rng, bits, n):
    high = rng.integers(0, 1 << (2 * bits), n, np.uint64, endpoint=False) if bits < 32 else (
        rng.integers(0, (1 << 64) - 1, n, np.uint64, endpoint=True)
    )
    return high, rng.integers(0, 1 << bits, n, np.uint64)


@pytest.mark.parametrize("bits", [1, 2, 7, 17, 21, 22, 31, 32])
def test_permutation_can_be_undone(bits):
    high, low = values(np.random.default_rng(bits), bits, 4000)
    there = permute(high, low, bits)
    assert there[0].max() <= np.uint64((1 << 2 * bits) - 1)
    assert there[1].max() <= np.uint64((1 << bits) - 1)
    back = restore(*there, bits)
    assert (back[0] == high).all() and (back[1] == low).all()
    assert len(set(zip(*there))) == len(set(zip(high, low)))


@pytest.mark.parametrize("bits", [1, 5, 17, 21, 22, 32])
def test_filters_lose_nothing(bits):
    rng = np.random.default_rng(bits)
    high, low = values(rng, bits, 3000)
    high, low = np.concatenate([high, high[:500]]), np.concatenate([low, low[:500]])
    counts = rng.integers(1, 400, len(high))
    expected = Counter()
    for h, x, c in zip(high.tolist(), low.tolist(), counts.tolist()):
        expected[h, x] += c
    high, low, sums = counted(high, low, counts, bits)
    data = filter_bytes(high, low, sums, 2 * bits, bits)
    got = filter_content(data, bits)
    assert dict(zip(zip(got[0].tolist(), got[1].tolist()), got[2].tolist())) == expected
    assert (np.lexsort((got[1], got[0])) == np.arange(len(got[0]))).all()
    # Two bits of place, the remainder's bytes and a byte of count, large ones apart.
    plain = len(high) * 24
    assert bits < 5 or len(data) < plain


def brute(rows, least=10, top=2000, share=50):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count: dict[str, Counter] = {}
    for lang, text in rows:
        f = count.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(upper)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    f[tuple(words[i : i + size])] += 1
    out = []
    for lang, f in count.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found, longer = [], {}
        for phrase, a in f.items():
            if len(phrase) == 3 and a >= least:
                for part in (phrase[:2], phrase[1:]):
                    longer[part] = max(a, longer.get(part, 0))
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least or 100 * longer.get(phrase, -1) >= share * a:
                continue
            score, k = min(
                (10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k)
                for k in range(1, len(phrase))
            )
            text = " ".join(phrase)
            found.append((-score, -a, text.encode(), text, a, f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, _, _, text, a, left, right) in enumerate(sorted(found)[:top], start=1):
            out.append((lang, rank, text, a, left, right, n, -score))
    return sorted(out)


def found(frame):
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("sizes", [{}, {"chunk_words": 997, "shard_entries": 2000}])
def test_equals_brute_force(documents, sizes):
    part = documents.filter("doc_id % 5 = 0")
    rows = [(r["lang"], r["text"]) for r in part.select("lang", "text").collect()]
    expected = brute(rows, least=3)
    assert expected
    assert found(collocations(part, 3, **sizes)) == expected


def test_odd_rows(spark, odd):
    rows = [
        (None, "New York, new york; NEW YORK a\tb a b a b"),
        ("", "a b c a b c. a b c"),
        ("und", "new york"),
        ("x", None),
        ("x", ""),
        ("y", "É é É é É é\x0bÉ é \x00 \x00 \x00 \x00"),
    ]
    frame = spark.createDataFrame([(lang, t, 1, 2) for lang, t in rows],
                                  "lang string, text string, number int, chunk int")
    assert found(collocations(frame, 2)) == brute(rows, 2)
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    assert found(collocations(odd, 2, chunk_words=500)) == brute(rows, 2)


def test_empty_and_rare(spark, odd):
    assert collocations(odd.limit(0)).count() == 0
    assert collocations(odd, 10**9).count() == 0


def test_ties_and_limit(spark):
    text = ". ".join(["b c", "a d", "é f", "c c c"] * 4)
    frame = spark.createDataFrame([("en", text)], "lang string, text string")
    for top in (1, 2, 3, 9):
        expected = brute([("en", text)], 4, top)
        assert found(collocations(frame, 4, top, salts=2)) == expected


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    from linewarden.llm.collocations import _score

    a, left, right = 10**13, 10**14 + 3, 10**13 + 7
    frame = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    row = frame.select(_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()
    assert row["s"] == 10**6 * a * a // (left * right)
