from __future__ import annotations

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest

from linewarden.llm.decontamination import (
    Passages,
    ShardMatches,
    contamination_report,
    drop_contaminated,
    find_contamination,
    suffix_array,
    words_of,
)

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, window):
    windows = {}
    for name, text in items:
        words = split(text)
        size = min(window, len(words))
        for start in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[start : start + size]), set()).add(str(name))
    sizes = {len(w) for w in windows}
    result = []
    for doc_id, text in rows:
        words, hit, names = split(text), set(), set()
        for size in sizes:
            for start in range(len(words) - size + 1):
                found = windows.get(tuple(words[start : start + size]))
                if found:
                    hit.update(range(start, start + size))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        result.append((doc_id, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(result, key=repr)


def found(frame, items, window, **sizes):
    report = contamination_report(find_contamination(frame, items, window, **sizes))
    return sorted((tuple(r)[:6] for r in report.collect()), key=repr)


@pytest.fixture()
def items_of(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def test_words():
    text = "Don't stop_É x 3.5 \x7fz ÀB"
    assert [w.decode() for w in words_of(text.encode())] == split(text)


def test_documents(spark, sf_dir, documents, texts):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    expected = brute(list(texts.items()), items, 10)
    assert found(documents, benchmark, 10) == expected
    clean = {r["doc_id"] for r in drop_contaminated(documents, benchmark).collect()}
    assert clean == {r[0] for r in expected if not r[5]} and len(clean) < len(expected)


@pytest.mark.parametrize("window,block_bytes,seed", [(3, 1 << 20, 1), (4, 200, 2), (10, 400, 3)])
def test_passages_of_all_lengths(make, items_of, window, block_bytes, seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 25)))) for i in range(25)]
    rows = []
    for i in range(80):
        words = draw.choices(vocabulary, k=draw.randint(0, 40))
        for _ in range(draw.randint(0, 2)):
            words += split(draw.choice(items)[1])[draw.randint(0, 5) :] + ["other"]
        rows.append((i, " ".join(words)))
    sizes = {"block_bytes": block_bytes, "shard_words": 200}
    assert found(make(rows), items_of(items), window, **sizes) == brute(rows, items, window)


def test_longest_match_and_locations():
    passages = Passages([("a", b"one two three four five six"), ("b", b"x y")], 3)
    texts = [words_of(t) for t in (b"q two three four five q", b"", b"y x y x", b"six one two")]
    shard = ShardMatches(passages, texts)
    assert shard.longest().tolist() == [4, 0, 2, 0]
    assert shard.hits() == [[{"start": 1, "end": 5}], [], [{"start": 1, "end": 3}], []]
    assert [sorted(s) for s in shard.items] == [["a"], [], ["b"], []]


def test_longest_match_against_brute_force():
    draw = random.Random(9)
    for window in (2, 3, 5):
        items = [("".join(draw.choices("ab", k=draw.randint(0, 14)))) for _ in range(6)]
        texts = ["".join(draw.choices("abc", weights=(6, 6, 1), k=draw.randint(0, 30))) for _ in range(60)]
        passages = Passages([(str(i), " ".join(t).encode()) for i, t in enumerate(items)], window)
        shard = ShardMatches(passages, [[w.encode() for w in t] for t in texts])
        for text, longest in zip(texts, shard.longest().tolist()):
            expected = 0
            for item in items:
                least = min(window, len(item))
                for size in range(least, len(item) + 1) if least else ():
                    if any(item[s : s + size] in text for s in range(len(item) - size + 1)):
                        expected = max(expected, size)
            assert longest == expected


def test_passage_repeated_in_benchmark_and_documents():
    """Places in the benchmark and in the documents add up; they are not paired."""
    passage = " ".join(f"w{i}" for i in range(200)).encode()
    passages = Passages([(str(i), passage + b" end%d" % i) for i in range(300)], 10)
    shard = ShardMatches(passages, [words_of(passage)] * 300)
    tracemalloc.start()
    assert set(shard.longest().tolist()) == {200}
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_suffixes_are_sorted():
    numbers = np.array([3, 1, 2, 0, 1, 2, 2, 0], np.int64)
    runs = np.array([3, 2, 1, 0, 3, 2, 1, 0])
    places, _ = suffix_array(numbers, runs, 1, 3)
    assert places.tolist() == [1, 4, 2, 6, 5, 0]


def test_odd_rows(odd, make, items_of):
    items = items_of([(1, None), (2, ""), (3, "A text, WITHOUT an id!"), (3, "e"), (None, "b")])
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    plain = [(i, t) for i, t in [(3, "A text, WITHOUT an id!"), (3, "e"), ("", "b")]]
    assert found(odd, items, 10) == brute(rows, plain, 10)
    clean = drop_contaminated(odd, items)
    assert clean.columns == odd.columns and clean.count() == 9
    nothing = items_of([])
    assert found(odd, nothing, 10) == brute(rows, [], 10)
    assert found(make([]), items, 10) == [] and drop_contaminated(make([]), items).count() == 0
