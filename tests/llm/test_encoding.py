from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linewarden.llm import binary_output, cutting_stock, encoding, token_counts
from linewarden.llm.cutting_stock import best_fit, class_tops, column_generation, knapsack, layout


@pytest.fixture(scope="module")
def tokenizer():
    plain = Tokenizer.from_file(encoding.public_path())
    plain.encode_special_tokens = True
    return plain


@pytest.fixture(scope="module")
def encoder():
    with open(encoding.public_path(), encoding="utf-8") as file:
        return encoding.WordEncoder(file.read(), kept=500)


@pytest.fixture(scope="module")
def lengths(tokenizer, texts):
    return {
        i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts.items()
    }


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text.encode()), "<u4").tolist()


def test_whole_documents(tokenizer, encoder, texts):
    for text in texts.values():
        assert ids_of(encoder, text) == tokenizer.encode(text, add_special_tokens=False).ids


LETTERS = st.sampled_from(" \t\n.,'’-sStT09aAéÉßẞΣσİıǅ́  中<|endoftext|>ﬁÅİẞ")


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.one_of(st.text(LETTERS, max_size=30), st.text(max_size=30)))
def test_any_text(tokenizer, encoder, text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids_of(encoder, text) == tokenizer.encode(text, add_special_tokens=False).ids


# --- length histogram ---------------------------------------------------------------------


def test_histogram_and_limits(documents, lengths):
    histogram = token_counts.length_histogram(documents, encoding.public_path())
    assert {tuple(r) for r in histogram.collect()} == set(Counter(lengths.values()).items())
    rows = token_counts.context_limits(histogram, block=64).collect()
    for r in rows:
        limit, all_lengths = r["n_tokens"], lengths.values()
        assert r["documents_longer"] == sum(n > limit for n in all_lengths)
        assert r["tokens_longer"] == sum(n for n in all_lengths if n > limit)
        assert r["tokens_within"] == sum(min(n, limit) for n in all_lengths)
        assert r["tokens_cut"] == sum(max(n - limit, 0) for n in all_lengths)
        assert abs(r["share_within"] - np.mean([n <= limit for n in all_lengths])) < 1e-12


def test_histogram_of_odd_rows(odd, make):
    histogram = token_counts.length_histogram(odd, encoding.public_path())
    assert dict(map(tuple, histogram.collect()))[0] == 4
    empty = token_counts.length_histogram(make([]), encoding.public_path())
    assert empty.count() == 0 and token_counts.context_limits(empty).count() == 0


# --- id matrices --------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_decreasing(lengths):
    packed = binary_output.best_fit_decreasing(lengths, 50)
    assert sorted(p for s in packed for p in s) == list(range(len(lengths)))
    free = []
    expected = 0
    for n in sorted(lengths, reverse=True):
        rooms = [r for r in free if r >= n]
        if rooms:
            free.remove(min(rooms))
            free.append(min(rooms) - n)
        else:
            free.append(50 - n)
            expected += 1
    assert len(packed) == expected
    assert all(sum(lengths[p] for p in s) <= 50 for s in packed)


@pytest.mark.parametrize("capacity,wide", [(4096, False), (100, True)])
def test_matrices_give_the_documents_back(documents, tokenizer, texts, capacity, wide):
    packed = binary_output.pack_ids(
        documents, encoding.public_path(), capacity, wide=wide, block_tokens=50_000
    )
    pieces, used, rows = defaultdict(dict), 0, packed.collect()
    for r in rows:
        row = np.frombuffer(r["ids"], "<u4" if wide else "<u2")
        assert len(row) == capacity and not row[r["n_tokens"] :].any()
        assert r["segment_ends"][-1] == r["n_tokens"]
        assert r["position_resets"] == [0, *r["segment_ends"][:-1]]
        at = binary_output.positions(r["n_tokens"], r["position_resets"])
        parts = binary_output.segment_ids(r["ids"], r["segment_ends"], wide)
        for part, segment in zip(parts, r["segments"], strict=True):
            assert len(part) == segment["length"]
            pieces[segment["doc_id"]][segment["start"]] = part.tolist()
        assert at.tolist() == [i for p in parts for i in range(len(p))]
        used += r["n_tokens"]
    assert used > 0.95 * capacity * len(rows)
    for i, text in texts.items():
        ids = [x for _, part in sorted(pieces[i].items()) for x in part]
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_matrices_of_odd_rows(odd, make, spark, tmp_path):
    packed = binary_output.pack_ids(odd, encoding.public_path())
    binary_output.write_matrices(packed, str(tmp_path / "ids"))
    rows = spark.read.parquet(str(tmp_path / "ids")).collect()
    segments = Counter(s["doc_id"] for r in rows for s in r["segments"] if s["start"] == 0)
    assert segments == Counter(r["doc_id"] for r in odd.collect())
    assert binary_output.pack_ids(make([]), encoding.public_path()).count() == 0


# --- cutting stock ------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.floats(0, 1)), min_size=1, max_size=8))
def test_knapsack(items):
    sizes = np.array([s for s, _ in items])
    values = np.array([v for _, v in items])
    value, pattern = knapsack(sizes, values, 30)
    best = [0.0] * 31
    for room in range(1, 31):
        best[room] = max([best[room - 1], *(v + best[room - s] for s, v in items if s <= room)])
    assert abs(value - best[30]) < 1e-9
    assert abs(pattern @ values - value) < 1e-9 and pattern @ sizes <= 30


def test_program_reaches_the_known_optimum():
    """Pieces of 1/2, 1/3 and 1/6 in equal numbers fill their sequences."""
    basis, amounts = column_generation(np.array([2, 4, 6]), np.array([60.0, 60, 60]), 12)
    assert abs(amounts.sum() - 60) < 1e-6
    assert (basis @ amounts >= 60 - 1e-6).all()


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), min_size=1, max_size=30))
def test_layout_places_every_piece(counts):
    entries, used = layout(counts, 64), defaultdict(int)
    for size, n in counts.items():
        own = sorted(e[1:] for e in entries if e[0] == size)
        for rank in range(n):
            first, sequence, per = max(e for e in own if e[0] <= rank)
            used[sequence + (rank - first) // per] += size
    assert max(used.values()) <= 64
    assert sum(used.values()) == sum(s * n for s, n in counts.items())


def test_best_fit_of_left_overs():
    patterns = best_fit(np.array([3, 5, 7]), np.array([2, 1, 1]), 10)
    assert [p.tolist() for p in patterns] == [[1, 0, 1], [1, 1, 0]]


def test_lengths_of_many_pieces_are_classes_of_their_own():
    assert class_tops({65: 1000, 100: 1, 101: 1}, 16, 64).tolist() == [65, 112]
    assert class_tops({1: 9, 17: 9, 33: 9}, 16, 2).tolist() == [1, 17, 48]
    assert class_tops({}, 16, 64).tolist() == []


def test_short_texts_are_packed_with_little_padding(make):
    """Texts of one id and of a few: rounding up to 16 would leave most places empty."""
    rows = make([(i, "" if i % 2 else "w " * (i % 5)) for i in range(3000)])
    rows = cutting_stock.pack_documents(rows, encoding.public_path(), capacity=256).collect()
    parts, sequences = check_packing(rows, 256)
    assert len(parts) == 3000
    assert sequences <= 1.02 * sum(r["length"] for r in rows) / 256 + 1


def check_packing(rows, capacity):
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return documents, len(sequences)


def test_packing(documents, tokenizer, texts, lengths):
    rows = cutting_stock.pack_documents(
        documents, encoding.public_path(), rows_per_group=100
    ).collect()
    parts, sequences = check_packing(rows, 4096)
    for i, own in parts.items():
        assert sum(n for _, n, _ in own) == lengths[i] + 1 == own[0][2]
        assert [s for s, _, _ in sorted(own)] == list(range(0, lengths[i] + 1, 4096))
    total = sum(n + 1 for n in lengths.values())
    assert set(parts) == set(lengths) and sequences * 4096 < 1.03 * total


def test_packing_odd_rows(odd, make):
    path = encoding.public_path()
    rows = cutting_stock.pack_documents(odd, path).collect()
    parts, _ = check_packing(rows, 4096)
    assert Counter(r["doc_id"] for r in rows if r["start"] == 0) == Counter(
        r["doc_id"] for r in odd.collect()
    )
    assert {r["doc_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    empty = cutting_stock.pack_documents(make([]), path)
    assert empty.count() == 0
    assert empty.columns == cutting_stock.pack_documents(odd, path).columns


def test_ids_beyond_16_bits_are_refused(make):
    documents, path = make([(1, "a b")]), encoding.public_path()
    with pytest.raises(ValueError, match="32 bits"):
        binary_output.pack_ids(documents, path, pad_id=70_000)
    assert binary_output.pack_ids(documents, path, pad_id=70_000, wide=True).count() == 1


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_tokenizers_that_look_beyond_words_are_refused(make, name):
    with pytest.raises(ValueError, match="word by word"):
        binary_output.pack_ids(make([(1, "a b")]), encoding.public_path(name))
