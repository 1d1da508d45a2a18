from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import pytest
import xxhash

from linewarden.llm import toxicity


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_held_out_documents(documents, labels):
    model = toxicity.train(documents, labels)
    rows = toxicity.score_documents(documents, model).collect()
    assert len(rows) == documents.count()
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    right = {True: [], False: []}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        if r["held_out"] and r["doc_id"] in known:
            right[bool(known[r["doc_id"]])].append(r["predicted"] == known[r["doc_id"]])
    assert sum(right[False]) >= 0.98 * len(right[False])
    assert sum(right[True]) >= 0.7 * len(right[True])
    scores = {r["doc_id"]: r["score"] for r in rows}
    kept = toxicity.drop_toxic(documents, model)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scores.items() if s < 0.3}


def biased_corpus():
    """Toxic texts often name one group; neutral texts name the others."""
    draw = random.Random(8)
    filler = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(1200):
        words = draw.choices(filler, k=12)
        toxic = i % 4 == 0
        if toxic and draw.random() < 0.7:
            words.insert(draw.randrange(12), "awful")
        if draw.random() < (0.9 if toxic else 0.05):
            words.insert(draw.randrange(12), "muslim")
        elif draw.random() < 0.3:
            words.insert(draw.randrange(12), draw.choice(["christian", "jewish", "hindu"]))
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return rows, labels


def test_penalty_lowers_false_positives_on_group_mentions(make, spark, monkeypatch):
    rows, labels = biased_corpus()
    docs = make(rows)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = [(10_000 + i, f"the muslim family word{i} word{i + 1}.") for i in range(50)]
    neutral += [(20_000 + i, f"an awful muslim word{i}.") for i in range(50)]

    def flagged(model):
        scored = toxicity.score_documents(make(neutral), model).collect()
        return (
            sum(r["predicted"] for r in scored if r["doc_id"] < 20_000),
            sum(r["predicted"] for r in scored if r["doc_id"] >= 20_000),
        )

    held_to_it = flagged(toxicity.train(docs, marks))
    plain = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda f, t, p, w: plain(f, t, [], w))
    without = flagged(toxicity.train(docs, marks))
    assert without[0] == 50 and held_to_it[0] == 0
    assert held_to_it[1] == 50


def test_counterfactuals_swap_within_a_kind():
    swaps = toxicity.counterfactuals({b"a", b"deaf", b"man"})
    assert (b"deaf", b"blind") in swaps and (b"man", b"woman") in swaps
    assert (b"deaf", None) in swaps and (b"man", None) in swaps
    assert (b"deaf", b"woman") not in swaps
    assert toxicity.counterfactuals({b"no", b"group"}) == []
    assert toxicity.sentences(b"One two. Three! four") == [[b"one", b"two"], [b"three"], [b"four"]]


def features(word):
    return set(toxicity.word_features(word))


def copied_changes(sentence):
    """The same from whole copies of the sentence."""
    def of(words):
        return set().union(*map(features, words))

    found = Counter()
    for term in {w for w in sentence if w in toxicity.SWAPS}:
        copies = [[other if w == term else w for w in sentence] for other in toxicity.SWAPS[term]]
        for copy in [*copies, [w for w in sentence if w != term]]:
            gone, come = of(sentence) - of(copy), of(copy) - of(sentence)
            if gone or come:
                found[tuple(sorted(gone)), tuple(sorted(come))] += 1
    return found


def test_changes_equal_those_of_copies():
    draw = random.Random(5)
    words = [b"muslim", b"muslims", b"hindu", b"man", b"woman", b"mango", b"old", b"a", b"oldest"]
    for size in range(9):
        sentence = draw.choices(words, k=size)
        assert toxicity.score_changes(sentence, features) == copied_changes(sentence)


def test_long_sentence_full_of_terms():
    draw, terms = random.Random(6), sorted(toxicity.SWAPS)
    sentence = [draw.choice(terms) if i % 10 == 0 else b"w%d" % i for i in range(20_000)]
    swaps = sum(len(toxicity.SWAPS[t]) + 1 for t in terms)
    tracemalloc.start()
    changes = toxicity.score_changes(sentence, features)
    assert sum(changes.values()) <= swaps and tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_scores_recomputed(documents, labels, texts):
    model = toxicity.train(documents, labels)
    rows = toxicity.score_documents(documents, model).collect()
    for r in rows[:200]:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), texts[r["doc_id"]])
        names = set()
        for word in re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered):
            names |= {"w" + word} | {"s" + word[:n] for n in (3, 4, 5, 6) if len(word) > n}
        hashed = [int.from_bytes(xxhash.xxh3_64_digest(n.encode()), "little", signed=True) for n in names]
        total = model.bias + sum(model.weights.get(h, 0.0) for h in hashed)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-9)


def test_rare_toxic_documents_are_all_drawn(make, spark, monkeypatch):
    docs = make([(i, "an awful text" if i % 100 == 0 else "a fine text") for i in range(4000)])
    marks = spark.range(4000).selectExpr("id AS doc_id", "int(id % 100 = 0) AS toxic")
    toxic = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(0, 4000, 100))
    seen = []
    plain = toxicity.fit
    monkeypatch.setattr(
        toxicity, "fit", lambda f, t, p, w: seen.append((sum(t), len(t))) or plain(f, t, p, w)
    )
    model = toxicity.train(docs, marks, sample=200)
    assert seen[0][0] == toxic and toxic + 100 < seen[0][1] < 300
    rows = toxicity.score_documents(docs, model).collect()
    assert all(r["predicted"] == (r["doc_id"] % 100 == 0) for r in rows)


def test_odd_rows(odd, make, spark):
    labels = spark.createDataFrame(
        [(1, 0), (4, 1), (4, 0), (None, 1), (6, None), (99, 1)], "doc_id long, toxic int"
    )
    model = toxicity.train(odd, labels)
    rows = toxicity.score_documents(odd, model).collect()
    assert len(rows) == odd.count()
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    nothing = toxicity.train(make([]), spark.createDataFrame([], labels.schema))
    assert {r["predicted"] for r in toxicity.score_documents(odd, nothing).collect()} == {0}
    assert toxicity.score_documents(make([]), model).count() == 0
    assert toxicity.drop_toxic(odd, nothing).columns == odd.columns


def test_sample_size_is_bounded(documents, labels):
    model = toxicity.train(documents, labels, sample=100)
    assert len(model.weights) < 4096 + len(toxicity.SWAPS)
