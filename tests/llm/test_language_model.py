from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from linewarden.llm import language_model as lm


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def base_scores(rows):
    counts = Counter()
    for i, text in rows:
        if not is_held_out(i):
            counts.update(tokens_of(text))
    total = sum(counts.values())
    bottom = total + 0.5 * (len(counts) + 1)
    return total, {
        i: (
            len(tokens_of(t)),
            sum(counts[w] > 0 for w in tokens_of(t)),
            sum(np.log10((counts[w] + 0.5) / bottom) for w in tokens_of(t)),
        )
        for i, t in rows
    }


@pytest.fixture(scope="module")
def scored(documents):
    return lm.train_and_score(documents, dictionary=2000).collect()


def test_counts_and_base(scored, texts):
    """With a dictionary far smaller than the vocabulary most words come from the join."""
    total, expected = base_scores(list(texts.items()))
    assert len(scored) == len(texts)
    for r in scored:
        n_tokens, n_known, base = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, total)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base)
        assert r["held_out"] == is_held_out(r["doc_id"])


def test_model_beats_its_base_on_held_out_texts(scored):
    held = [r for r in scored if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.99 * sum(r["base_score"] for r in held)
    assert np.mean([r["score"] > r["base_score"] for r in held]) > 0.6


def small_model(rng, words=1500):
    names = [f"w{i}".encode() for i in range(words)]
    counts = np.sort(rng.integers(1, 500, words))[::-1].astype(float)
    mass = np.full(lm.CLASSES, 0.5)
    for own in range(lm.WORD_CLASSES):
        part = counts[own * lm.CLASS_WORDS : (own + 1) * lm.CLASS_WORDS]
        mass[own] = (part + 0.5).sum()
    for name, n in list(zip(names, counts))[lm.MODEL_WORDS :]:
        mass[lm.WORD_CLASSES + lm.ending(name) % lm.ENDING_CLASSES] += n + 0.5
    return lm.Model(
        b" ".join(names),
        counts,
        int(counts.sum()),
        words,
        mass,
        rng.normal(0, 0.5, (lm.CLASS_ROWS, lm.CLASSES)).astype(np.float32),
        rng.normal(0, 0.5, (lm.WORD_ROWS, lm.CLASS_WORDS)).astype(np.float32),
    )


def test_probabilities_sum_to_one():
    """Over every dictionary word and, per ending class, one unknown word."""
    model = small_model(np.random.default_rng(5))
    lexicon = lm.Lexicon(model)
    unknown = {}
    for i in range(5000):
        word = f"x{i}z{i * 7919}".encode()
        unknown.setdefault(lm.ending(word) % lm.ENDING_CLASSES, word)
    assert len(unknown) == lm.ENDING_CLASSES
    history = [b"w3", b"w1400", b"never"]
    total = 0.0
    for word in [*model.words.split(b" "), *unknown.values()]:
        tokens = [*history, word]
        codes = np.array([lexicon[t] for t in tokens])
        score = lm.log10_probabilities(model, lexicon, codes, np.arange(4))[-1]
        if codes[-1] >= lexicon.size:
            score += np.log10(0.5)
        total += 10**score
    assert abs(total - 1) < 1e-3


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(3)
    weights = rng.normal(0, 1, (20, 6)).astype(np.float32)
    rows, bias = [rng.integers(0, 20, 9), rng.integers(0, 20, 9)], np.zeros(6, np.float32)
    target = rng.integers(0, 6, 9)

    def loss(w):
        return -lm._log_softmax_at(lm._logits(w.astype(float), bias, rows), target).sum()

    moved = weights.copy()
    squares, touched = np.full(20, 1e12, np.float32), np.zeros(20, np.int64)
    lm._step(moved, squares, touched, rows, bias, target, rate=1e6)
    for r, c in ((rows[0][0], 1), (rows[1][3], 4)):
        up, down = weights.astype(float), weights.astype(float)
        up[r, c] += 1e-3
        down[r, c] -= 1e-3
        assert abs((loss(up) - loss(down)) / 2e-3 + (moved - weights)[r, c]) < 2e-2
    assert touched.sum() == 18


def test_odd_rows(odd, make):
    rows = lm.train_and_score(odd, dictionary=50, rounds=1).collect()
    assert len(rows) == odd.count()
    blank = {(r["n_tokens"], r["base_score"], r["score"]) for r in rows if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1 and next(iter(blank))[0] == 1
    twins = [tuple(r) for r in rows if r["doc_id"] == 4 and r["n_tokens"] == 3]
    assert len(twins) == 2 and twins[0] == twins[1]
    assert all(np.isfinite([r["score"], r["base_score"]]).all() for r in rows)
    assert lm.train_and_score(make([])).count() == 0


def test_nothing_to_learn_from(make):
    held = next(i for i in range(100) if is_held_out(i))
    row = lm.train_and_score(make([(held, "some words")])).first()
    assert (row["train_tokens"], row["n_known"], row["n_tokens"]) == (0, 0, 3)
    assert np.isfinite(row["score"])


def test_every_token_is_an_example(make):
    """Each text is four tokens, so that a stride of four would reach the first place alone."""
    rows = [(i, f"a{i * 7919 % 11} b{i * 7919 % 11} c{i * 7919 % 11}") for i in range(4000)]
    scored = lm.train_and_score(make(rows)).filter("held_out").collect()
    gain = np.mean([r["score"] - r["base_score"] for r in scored])
    # The first word is one of eleven, the others and the end follow from it.
    sure = 3 * np.log10(44) + np.log10(4) - np.log10(11)
    assert gain > 0.5 * sure


def test_words_of_an_ending_class_are_told_apart():
    """Weights of the rows a history has move a word beyond the most frequent ones."""
    model = small_model(np.random.default_rng(7))
    lexicon = lm.Lexicon(model)
    own = lexicon.classes[: lexicon.size]
    first, second = np.flatnonzero(own == own[-1])[:2]
    assert first >= lm.MODEL_WORDS
    odds = set()
    for before in (3, 70, 500):
        scores = [
            lm.log10_probabilities(model, lexicon, np.array([before, code]), np.arange(2))[-1]
            for code in (first, second)
        ]
        odds.add(round(scores[0] - scores[1], 6))
    assert len(odds) == 3


def test_large_ending_classes():
    """Every word has one way, and zero weights give the smoothed unigram model."""
    rng = np.random.default_rng(11)
    names = [f"w{i}{'abcd'[i % 4] * 3}".encode() for i in range(30_000)]
    counts = np.sort(rng.integers(1, 500, len(names)))[::-1].astype(float)
    model = small_model(rng)
    mass = np.full(lm.CLASSES, 0.5)
    for own in range(lm.WORD_CLASSES):
        mass[own] = (counts[own * lm.CLASS_WORDS : (own + 1) * lm.CLASS_WORDS] + 0.5).sum()
    for name, n in list(zip(names, counts))[lm.MODEL_WORDS :]:
        mass[lm.WORD_CLASSES + lm.ending(name) % lm.ENDING_CLASSES] += n + 0.5
    model = lm.replace(
        model,
        words=b" ".join(names),
        counts=counts,
        class_mass=mass,
        class_weights=model.class_weights * 0,
        word_weights=model.word_weights * 0,
    )
    lexicon, codes = lm.Lexicon(model), np.arange(len(names))
    ways = np.stack([a for path in lexicon.paths for a in path], axis=1)[: len(names)]
    assert len(np.unique(ways, axis=0)) == len(names)
    scores = lm.log10_probabilities(model, lexicon, codes, codes)
    assert np.abs(scores - np.log10((counts + 0.5) / mass.sum())).max() < 1e-4


def test_scoring_fills_its_parts(monkeypatch):
    """The tokens of a depth are scored in full parts, not in what each part of the text has."""
    rng = np.random.default_rng(13)
    model = small_model(rng)
    lexicon, codes = lm.Lexicon(model), rng.integers(0, 1500, 1000)
    sizes, real = [], lm._log_softmax_at
    monkeypatch.setattr(lm, "_log_softmax_at", lambda x, at: sizes.append(len(at)) or real(x, at))
    parts = lm.log10_probabilities(model, lexicon, codes, np.arange(1000), batch=100)
    depths = [int((nodes[codes] >= 0).sum()) for nodes, _ in lexicon.paths]
    assert len(sizes) == sum(-(-n // 100) for n in [1000, *depths])
    whole = lm.log10_probabilities(model, lexicon, codes, np.arange(1000), batch=1000)
    assert np.abs(parts - whole).max() < 1e-4


def test_sums_of_runs_of_any_length():
    rng = np.random.default_rng(17)
    rows = np.sort(np.concatenate([np.full(700, 3), np.full(33, 5), rng.integers(6, 60, 200)]))
    values, by = rng.normal(size=(len(rows), 4)), rng.permutation(len(rows))
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    sizes = np.diff(np.append(starts, len(rows)))
    largest = np.argsort(-sizes)
    found = lm._sums(values, by, starts[largest], sizes[largest])
    for total, start, size in zip(found, starts[largest], sizes[largest]):
        assert np.allclose(total, values[by[start : start + size]].sum(axis=0))


def test_exponentials_of_any_range():
    rng = np.random.default_rng(19)
    for shift in (0, 85, 1000, -200):
        logits = rng.normal(shift, 3, (50, 64)).astype(np.float32)
        own = logits.astype(float)
        top = own.max(axis=1)
        exact = own[:, 7] - top - np.log(np.exp(own - top[:, None]).sum(axis=1))
        found = lm._log_softmax_at(logits.copy(), np.full(50, 7))
        assert np.abs(found - exact).max() < 1e-3


def batches_of(texts, rows=7):
    for start in range(0, len(texts), rows):
        own = pa.array(texts[start : start + rows], pa.binary())
        yield pa.RecordBatch.from_arrays([own], ["text"])


def odd_texts(rng, n=60):
    every = [b"A" + bytes([b]) + b"z" + bytes([b, b]) + b"Q" for b in range(256)]
    blank = [b"", b" ", b"\t\n ", b" lead", b"trail ", b"\x0b both \x1c\x85\r"]
    long = [b" ".join(b"w%d" % i for i in rng.integers(0, 99, size)) for size in (1, 400, n)]
    return [*every, *blank, *long, *(b"%d X%d" % (i % 5, i) for i in range(n))]


def test_tokens_are_found_for_many_texts_at_once():
    """Any byte, and white space at either end; slices of an array as well."""
    texts = odd_texts(np.random.default_rng(23))
    for part in (pa.array(texts, pa.binary()), pa.array([b"x", *texts], pa.binary())[1:]):
        words, sizes = lm.tokens_of(part)
        assert words.to_pylist() == [w for t in texts for w in t.lower().split()]
        assert sizes.tolist() == [len(t.split()) + 1 for t in texts]


def test_groups_and_counts_do_not_depend_on_slices(monkeypatch):
    texts = odd_texts(np.random.default_rng(29))
    lexicon = lm.Lexicon(small_model(np.random.default_rng(31)))
    expected, held = [], []
    for t in texts:
        held.append([*(lexicon[w] for w in t.lower().split()), lexicon[b"\n"]])
        if sum(map(len, held)) >= 50:
            expected.append((sum(held, []), [len(h) for h in held]))
            held = []
    expected += [(sum(held, []), [len(h) for h in held])] if held else []
    counts = Counter(w for t in texts for w in [*t.lower().split(), b"\n"])
    monkeypatch.setattr(lm, "COUNTED", 40)
    for limit in (1, 64, 1 << 20):
        monkeypatch.setattr(lm, "TEXT_BYTES", limit)
        groups = lm._batches_of_tokens(batches_of(texts), lexicon, 50)
        assert [(c.tolist(), s.tolist()) for c, s in groups] == expected
        found = Counter()
        for batch in lm._token_counts(batches_of(texts)):
            for r in batch.to_pylist():
                found[r["word"]] += r["n"]
        assert found == counts
    assert list(lm._batches_of_tokens(iter([]), lexicon, 50)) == []
    assert list(lm._token_counts(batches_of([b""], 1)))[0].to_pylist() == [{"word": b"\n", "n": 1}]


def test_rare_words_of_each_text():
    """Repeats are counted, the order is the text's, and an end may be rare as well."""
    rng = np.random.default_rng(37)
    texts = [rng.integers(0, 300, n).tolist() for n in (0, 1, 5000, 0, 40_000, 3)]
    words = pa.array([b"w%d" % w for t in texts for w in t], pa.binary())
    tokens = [[*(b"w%d" % w for w in t), b"\n"] for t in texts]
    flat = [w for t in tokens for w in t]
    sizes = np.array([len(t) for t in tokens])
    for rare in ({b"\n"}, {b"w%d" % w for w in range(0, 300, 3)}, set(flat), set()):
        at = np.flatnonzero([w in rare for w in flat])
        found = lm._rare_words(words, sizes, at).to_pylist()
        expected = [list(Counter(w for w in t if w in rare).items()) for t in tokens]
        assert [[(r["word"], r["n"]) for r in f] for f in found] == expected


def test_a_step_writes_to_memory_it_has():
    """Gathered rows, errors and sums go to the same memory in each step, whatever its size."""
    rng = np.random.default_rng(41)
    weights = rng.normal(0, 1, (500, 64)).astype(np.float32)
    bias = rng.normal(0, 1, (9, 64)).astype(np.float32)

    def step(n):
        rows, nodes = [rng.integers(0, 500, n) for _ in range(2)], rng.integers(0, 9, n)
        target = rng.integers(0, 64, n)
        logits = lm._logits(weights, bias, rows, nodes)
        exact = weights[rows[0]] + weights[rows[1]] + bias[nodes]
        assert np.array_equal(logits, exact)
        error = lm._error(weights, bias, rows, target, nodes)
        odds = np.exp(exact) / np.exp(exact).sum(axis=1)[:, None]
        assert np.abs(error - (odds - np.eye(64)[target])).max() < 1e-5
        by = np.argsort(rows[0], kind="stable")
        starts = np.flatnonzero(np.diff(rows[0][by], prepend=-1))
        sums = lm._sums(error, by, starts[:1], np.array([1]))
        return logits, error, sums

    for first, second in zip(step(3000), step(2500)):
        assert np.shares_memory(first, second)
    large = step(lm.KEPT_ROWS + 1)
    assert not np.shares_memory(large[1], step(10)[1])
