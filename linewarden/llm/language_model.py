"""A hashed maximum-entropy language model with a class-factored softmax.

The probability of a token is that of its class given the history times that of the token
within its class. Features of the history are the last word, the words two and three places
back (skips) and the last two words together; each is hashed to a row of a weight table. The
most frequent words form classes with a softmax of their own; every other word belongs to a
class by its ending. The dictionary's words of such a class hang in a tree of softmaxes, the
frequent ones near its root; words outside the dictionary are one leaf together, within which
they have their share of the training counts. With weights of zero the model is the smoothed unigram model; training moves it from there.

Counts cover every training token. Weights are trained in rounds over disjoint slices of the
training documents: each task makes gradient updates on its part from the same weights, and
the changes are averaged row by row, in a tree, weighted by the updates behind them. Texts
are scored in batches of numpy rows. Words outside the dictionary of frequent words, whose
size is bounded, get their counts from a shuffle join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.llm.words import rows_of, utf8
from linewarden.session import materialize

END = b"\n"

# Sizes of the model, the same for every input.
CLASS_WORDS = 64
WORD_CLASSES = 16
ENDING_CLASSES = 48
CLASSES = WORD_CLASSES + ENDING_CLASSES
MODEL_WORDS = CLASS_WORDS * WORD_CLASSES
ENDINGS = 1024
HISTORY = MODEL_WORDS + ENDINGS + 1
START = HISTORY - 1
SKIPS = 3
PAIR_ROWS = 1 << 12
CLASS_ROWS = SKIPS * HISTORY + PAIR_ROWS
WORD_ROWS = 1 << 15
BLOCK_ROWS = 1024
TASK_TOKENS = 4_000_000  # of all rounds; smaller parts of a table are trained together
AVERAGED = 64  # changes of a block that one group averages
LARGE, SMALL = 1e35, 1e-20  # sums of exponentials, well within the range of float32
RUN = 16  # values of a run that are summed place by place
CACHED = 1024  # rows of 64 numbers that stay in the cache
KEPT_ROWS = 1 << 14  # rows of the largest arrays whose memory is used again
TEXT_BYTES = 1 << 22  # of texts whose tokens are looked up at once
COUNTED = 500_000  # counts that a task holds before it passes them on


def held_out(id_column: Column, parts: int = 5, part: int = 1) -> Column:
    crc = F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary"))
    return crc % parts == part


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in turn after lower-casing A-Z; each text's number of tokens,
    which are its words and one end.

    Arrow's functions for ASCII read bytes: they change A-Z and cut at ``[\\x20\\x09-\\x0D]``.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(_as(texts, pa.string())))
    offsets = parts.offsets.to_numpy().astype(np.int64)
    words = _as(parts.flatten(), pa.binary())
    offsets -= offsets[0]
    # White space at either end of a text leaves an empty part there.
    full = pc.binary_length(words).to_numpy() > 0
    if not full.all():
        words = words.filter(pa.array(full))
        offsets = np.append(0, np.cumsum(full))[offsets]
    return words, np.diff(offsets) + 1


def _as(texts: pa.Array, kind: pa.DataType) -> pa.Array:
    """The same bytes as strings or as binary values."""
    return pa.Array.from_buffers(kind, len(texts), texts.buffers(), offset=texts.offset)


def _text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose texts have about ``TEXT_BYTES`` bytes, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + TEXT_BYTES)) + 1
            yield batch.slice(start, stop - start)
            start = stop


def ending(word: bytes) -> int:
    """The hashed last letters of a word, marks behind it left aside."""
    return xxhash.xxh3_64_intdigest(word.rstrip(b".,;:!?")[-3:]) % ENDINGS


# --- counts -------------------------------------------------------------------------------


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0

    def summed() -> list[pa.RecordBatch]:
        table = pa.concat_tables(held).group_by("word", use_threads=False)
        table = table.aggregate([("n", "sum")]).select(["word", "n_sum"])
        return table.rename_columns(["word", "n"]).combine_chunks().to_batches()

    for part in _text_slices(batches):
        words, sizes = tokens_of(part.column("text"))
        counts = pc.value_counts(words)
        held.append(pa.table([counts.field(0), counts.field(1)], ["word", "n"]))
        ends = [pa.array([END], pa.binary()), pa.array([len(sizes)], pa.int64())]
        held.append(pa.table(ends, ["word", "n"]))
        rows += len(counts) + 1
        if rows > 2 * COUNTED:
            held = [pa.Table.from_batches(summed())]
            rows = held[0].num_rows
            if rows > COUNTED:
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from summed()


def token_counts(texts: DataFrame) -> DataFrame:
    """word, n: the count of every token; tasks count before the shuffle."""
    counts = texts.mapInArrow(_token_counts, "word binary, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words above a count, most frequent first; the count is the least that leaves at
    most ``most`` words. Counts are looked at in steps of an eighth of a doubling."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).count().collect()
    least, words = None, 0
    for r in sorted(sizes, key=lambda r: -r["step"]):
        words += r["count"]
        if words > most:
            break
        least = r["step"]
    if least is None:
        return []
    chosen = counts.filter(step >= least).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in chosen), key=lambda x: (-x[1], x[0]))


def _ending_totals(model_words: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for word, n in rows_of(batches, "word", "n"):
            if word not in model_words:
                own = WORD_CLASSES + ending(word) % ENDING_CLASSES
                tokens[own] += n
                words[own] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(CLASSES), pa.int32()), pa.array(tokens), pa.array(words)],
            ["class", "tokens", "words"],
        )

    return run


# --- the model ----------------------------------------------------------------------------


@dataclass
class Model:
    """Dictionary, class masses and weights. Everything has a size that is fixed beforehand."""

    words: bytes  # the dictionary, one word per line, most frequent first
    counts: np.ndarray
    tokens: int  # N
    distinct: int  # V
    class_mass: np.ndarray  # smoothed counts per class
    class_weights: np.ndarray  # CLASS_ROWS x CLASSES
    word_weights: np.ndarray  # WORD_ROWS x CLASS_WORDS


@dataclass
class Places:
    """Where each code is in the model: found once, and sent to the tasks in small numbers."""

    history: np.ndarray  # the word's place among the model's words or its ending behind them
    classes: np.ndarray
    paths: list[tuple[np.ndarray, np.ndarray]]
    bias: np.ndarray
    log_rest: np.ndarray


def places_of(model: Model) -> Places:
    words = model.words.split(b" ") if model.words else []
    endings = np.fromiter(map(ending, words), np.int64, len(words))
    history = np.concatenate([MODEL_WORDS + endings, MODEL_WORDS + np.arange(ENDINGS)])
    classes = WORD_CLASSES + (history - MODEL_WORDS) % ENDING_CLASSES
    head = np.arange(min(len(words), MODEL_WORDS))
    history[head] = head
    classes[head] = head // CLASS_WORDS
    paths, bias, log_rest = _trees(model, classes)
    paths = [(node.astype(np.int32), choice.astype(np.int8)) for node, choice in paths]
    return Places(history.astype(np.int16), classes.astype(np.int8), paths, bias, log_rest)


class Lexicon:
    """Word to code: its place in the dictionary, or the dictionary's size and its ending."""

    def __init__(self, model: Model, places: Places | None = None):
        self.words = pa.array(model.words.split(b" ") if model.words else [], pa.binary())
        self.size = len(self.words)
        places = places or places_of(model)
        self.history, self.classes, self.paths = places.history, places.classes, places.paths
        self.bias, self.log_rest = places.bias, places.log_rest
        counts = np.concatenate([model.counts, np.zeros(ENDINGS)])
        self.log_count = np.log10(counts + 0.5)
        self.log_count[self.size :] = 0  # added by the join
        self.end = self[END]

    def __getitem__(self, word: bytes) -> int:
        return int(self.codes(pa.array([word], pa.binary()))[0])

    def codes(self, words: pa.Array) -> np.ndarray:
        """The codes of many words; Arrow hashes the dictionary anew for each call."""
        found = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy()
        codes = found.astype(np.int64)
        unknown = np.flatnonzero(codes < 0)
        others = words.take(pa.array(unknown)).to_pylist()
        codes[unknown] = self.size + np.fromiter(map(ending, others), np.int64, len(others))
        return codes


def _starting_class_bias(model: Model) -> np.ndarray:
    return np.log(model.class_mass).astype(np.float32)


def _trees(model: Model, classes: np.ndarray):
    """The way to each code below its class, as (node, choice) by depth, -1 behind its end; log
    masses of each node's choices; log10 masses of the words outside the dictionary by class.

    Nodes 0 .. WORD_CLASSES - 1 are the classes of frequent words. In a larger set the most
    frequent words are choices of the node itself and equal parts of the others go below it.
    """
    size, total = len(model.counts), len(classes)
    masses = np.concatenate([model.counts + 0.5, np.zeros(ENDINGS)])
    head = np.arange(min(size, MODEL_WORDS))
    paths = [(np.full(total, -1), np.full(total, -1))]
    paths[0][0][head], paths[0][1][head] = head // CLASS_WORDS, head % CLASS_WORDS
    # Places without a word can't be chosen.
    biases = list(np.full((WORD_CLASSES, CLASS_WORDS), -1e9, np.float32))
    for code in head.tolist():
        biases[code // CLASS_WORDS][code % CLASS_WORDS] = np.log(masses[code])

    def grow(members: np.ndarray, depth: int) -> None:
        if depth == len(paths):
            paths.append((np.full(total, -1), np.full(total, -1)))
        more = max(0, len(members) - CLASS_WORDS)
        below = min(CLASS_WORDS // 2, -(-more // (CLASS_WORDS - 1)))
        own = members[: CLASS_WORDS - below]
        node, bias = len(biases), np.full(CLASS_WORDS, -1e9, np.float32)
        biases.append(bias)
        paths[depth][0][members] = node
        paths[depth][1][own] = np.arange(len(own))
        bias[: len(own)] = np.log(masses[own])
        for at, part in enumerate(np.array_split(members[len(own) :], below) if below else ()):
            paths[depth][1][part] = len(own) + at
            bias[len(own) + at] = np.log(masses[part].sum())
            grow(part, depth + 1)

    others = np.arange(len(head), size)
    others = others[np.argsort(classes[others], kind="stable")]
    starts = np.searchsorted(classes[others], np.arange(WORD_CLASSES, CLASSES + 1))
    rest = model.class_mass.copy()
    for number in range(ENDING_CLASSES):
        members = others[starts[number] : starts[number + 1]]
        rest[WORD_CLASSES + number] -= masses[members].sum()
        if len(members):
            masses[size + number] = rest[WORD_CLASSES + number]
            grow(np.append(size + number, members), 0)
    for node, choice in paths:
        for found in (node, choice):
            found[size:] = found[size + np.arange(ENDINGS) % ENDING_CLASSES]
    return paths, np.array(biases), np.log10(rest)


def _histories(history: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """The words 1 .. SKIPS places back in the same text, START before its first word."""
    found = []
    for back in range(1, SKIPS + 1):
        shifted = np.full(len(history), START)
        shifted[back:] = history[:-back]
        shifted[place < back] = START
        found.append(shifted)
    return found


def _class_rows(back: list[np.ndarray]) -> list[np.ndarray]:
    pair = (back[0] * 1_000_003 + back[1] * 7919) & (PAIR_ROWS - 1)
    return [*(skip * HISTORY + h for skip, h in enumerate(back)), SKIPS * HISTORY + pair]


def _word_rows(back: list[np.ndarray], nodes: np.ndarray) -> list[np.ndarray]:
    return [
        (((h * 1_000_003 + nodes) * 2_654_435_761 + skip * 40_503) >> 16) & (WORD_ROWS - 1)
        for skip, h in enumerate(back[:2])
    ]


_kept: dict[str, np.ndarray] = {}


def _space(name: str, rows: int, like: np.ndarray) -> np.ndarray:
    """Rows to write to, of the memory that the last call of this name wrote to: new memory
    costs more than what is done with it."""
    if rows > KEPT_ROWS:
        return np.empty((rows, like.shape[1]), like.dtype)
    kept = _kept.get(name)
    if kept is None or kept.shape[1] != like.shape[1] or kept.dtype != like.dtype:
        kept = _kept[name] = np.empty((KEPT_ROWS, like.shape[1]), like.dtype)
    return kept[:rows]


def _rows(name: str, table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of a table, valid until the next call of this name; the places are all in it."""
    return table.take(at, axis=0, out=_space(name, len(at), table), mode="clip")


def _logits(weights, bias, rows: list[np.ndarray], nodes: np.ndarray | None = None) -> np.ndarray:
    """The sums of the rows' weights and the bias, which is a row per node if these are given."""
    total = _rows("logits", weights, rows[0])
    for r in rows[1:]:
        total += _rows("term", weights, r)
    total += bias if nodes is None else _rows("term", bias, nodes)
    return total


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """Exponentials of the logits less a shift by row; their sums by row; the shifts.

    Rows are shifted, by their largest value, only where the values' range asks for it.
    """
    with np.errstate(over="ignore"):
        found = np.exp(logits, out=_space("exponentials", len(logits), logits))
    spread = np.einsum("ij->i", found)
    if spread.min(initial=1.0) > SMALL and spread.max(initial=1.0) < LARGE:
        return found, spread, 0.0
    top = logits.max(axis=1)
    logits -= top[:, None]
    np.exp(logits, out=logits)
    return logits, np.einsum("ij->i", logits), top


def _error(weights, bias, rows: list[np.ndarray], target: np.ndarray, nodes=None) -> np.ndarray:
    """Probabilities less the targets, in parts that stay in the cache."""
    error = _space("error", len(target), weights)
    for start in range(0, len(target), CACHED):
        part = slice(start, start + CACHED)
        own = None if nodes is None else nodes[part]
        own, spread, _ = _exponentials(_logits(weights, bias, [r[part] for r in rows], own))
        np.multiply(own, (1 / spread)[:, None], out=error[part])
    error.reshape(-1)[np.arange(len(target)) * error.shape[1] + target] -= 1
    return error


def _log_softmax_at(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    chosen = logits[np.arange(len(at)), at]
    _, spread, top = _exponentials(logits)
    return chosen - top - np.log(spread)


def _coded(
    batches: Iterator[pa.RecordBatch], lexicon: Lexicon
) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray, np.ndarray]]:
    """Rows, their words, the codes of their tokens and each text's number of tokens."""
    for part in _text_slices(batches):
        words, sizes = tokens_of(part.column("text"))
        codes = np.full(sizes.sum(), lexicon.end)
        own = np.ones(len(codes), bool)
        own[np.cumsum(sizes) - 1] = False
        codes[own] = lexicon.codes(words)
        yield part, words, codes, sizes


def _places(sizes: np.ndarray) -> np.ndarray:
    """The place of each token in its text."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _batches_of_tokens(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, size: int):
    """Codes and lengths of texts in turn, in groups that end with the first text that brings
    them to ``size`` tokens."""
    codes, sizes = np.empty(0, np.int64), np.empty(0, np.int64)
    for _, _, more_codes, more_sizes in _coded(batches, lexicon):
        codes, sizes = np.append(codes, more_codes), np.append(sizes, more_sizes)
        ends, first, start = np.cumsum(sizes), 0, 0
        while len(codes) - start >= size:
            behind = int(np.searchsorted(ends, start + size)) + 1
            stop = _before(ends, behind)
            yield codes[start:stop], sizes[first:behind]
            first, start = behind, stop
        codes, sizes = codes[start:], sizes[first:]
    if len(sizes):
        yield codes, sizes


def _before(ends: np.ndarray, text: int) -> int:
    """The tokens before a text, or all of them where there is no such text."""
    return int(ends[min(text, len(ends)) - 1]) if text else 0


# --- training -----------------------------------------------------------------------------


def _sums(values, by: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sums of values[by] over runs, those beyond ``RUN`` first, then largest first; first
    the runs' first values, then their second and so on, what is behind of long runs at once."""
    total = _rows("sums", values, by[starts])
    runs, smallest = len(starts), -sizes
    for place in range(1, RUN):
        runs = np.searchsorted(smallest[:runs], -place)
        if not runs:
            return total
        total[:runs] += _rows("term", values, by[starts[:runs] + place])
    runs = np.searchsorted(smallest[:runs], -RUN)
    if not runs:
        return total
    starts, rests = starts[:runs], sizes[:runs] - RUN
    ends = np.cumsum(rests)
    behind = np.arange(ends[-1]) + np.repeat(starts + RUN - (ends - rests), rests)
    behind = _rows("term", values, by[behind])
    rest = np.empty((runs, values.shape[1]), values.dtype)
    for own, start, end in zip(rest, (ends - rests).tolist(), ends.tolist()):
        np.add.reduce(behind[start:end], axis=0, out=own)
    total[:runs] += rest
    return total


def _whole_rows(table: np.ndarray) -> np.ndarray:
    """A table's rows as single values, which are put in place faster than rows of numbers."""
    return table.view(np.dtype((np.void, table.strides[0]))).reshape(-1)


def _row_updates(weights, squares, touched, rows, error, rate) -> None:
    """One step on the rows: gradients of a row are summed, its rate falls with their size."""
    rows = rows.astype(np.uint16)
    by = np.argsort(rows, kind="stable")
    rows = rows[by]
    starts = np.append(0, np.flatnonzero(rows[1:] != rows[:-1]) + 1)
    sizes = np.diff(starts, append=len(rows))
    # Small integers are sorted by radix.
    largest = np.argsort(RUN + 1 - np.minimum(sizes, RUN + 1).astype(np.int8), kind="stable")
    starts, sizes = starts[largest], sizes[largest]
    own = rows[starts]
    slope = _sums(error, by, starts, sizes)
    seen = squares[own] + np.einsum("ij,ij->i", slope, slope) / slope.shape[1]
    squares[own] = seen
    slope *= (rate / np.sqrt(seen + 1e-3))[:, None]
    np.subtract(_rows("term", weights, own), slope, out=slope)
    _whole_rows(weights)[own] = _whole_rows(slope)
    touched[own] += sizes


def _gradient_pass(sent, rate: float, batch: int):
    """Updates on one slice: every token is an example."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, places = sent.value
        lexicon = Lexicon(model, places)
        tables = (model.class_weights.copy(), model.word_weights.copy())
        squares = [np.zeros(len(t), np.float32) for t in tables]
        touched = [np.zeros(len(t), np.int64) for t in tables]
        class_bias = _starting_class_bias(model)
        for codes, sizes in _batches_of_tokens(batches, lexicon, batch):
            history, classes = lexicon.history[codes], lexicon.classes[codes]
            back = _histories(history, _places(sizes))
            _step(tables[0], squares[0], touched[0], _class_rows(back), class_bias, classes, rate)
            for nodes, choices in lexicon.paths:
                at = np.flatnonzero(nodes[codes] >= 0)
                if len(at):
                    own = nodes[codes[at]]
                    rows = _word_rows([h[at] for h in back], own)
                    within = choices[codes[at]]
                    table = (tables[1], squares[1], touched[1])
                    _step(*table, rows, lexicon.bias, within, rate, own)
        task = TaskContext.get().partitionId()
        rows_out = []
        for number, (new, old, n) in enumerate(
            zip(tables, (model.class_weights, model.word_weights), touched)
        ):
            for start in range(0, len(new), BLOCK_ROWS):
                part = slice(start, start + BLOCK_ROWS)
                if n[part].any():
                    change = (new[part] - old[part]).astype(np.float16)
                    rows_out.append(
                        (task, (number << 16) + start // BLOCK_ROWS, change.tobytes(),
                         n[part].tobytes())
                    )
        yield _update_batch(rows_out)

    return run


def _step(weights, squares, touched, rows, bias, target, rate, nodes=None) -> None:
    error = _error(weights, bias, rows, target, nodes)
    for r in rows:
        _row_updates(weights, squares, touched, r, error, rate)


UPDATE = "task long, block int, change binary, touched binary"


def _update_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], ["task", "block", "change", "touched"]
    )


def _averaged(table: pa.Table) -> pa.Table:
    """The changes of a block's rows, averaged by the updates behind them."""
    total, weight = None, None
    for change, touched in zip(
        table.column("change").to_pylist(), table.column("touched").to_pylist()
    ):
        n = np.frombuffer(touched, np.int64)
        own = np.frombuffer(change, np.float16).reshape(len(n), -1).astype(np.float64)
        total = own * n[:, None] if total is None else total + own * n[:, None]
        weight = n if weight is None else weight + n
    mean = (total / np.maximum(weight, 1)[:, None]).astype(np.float16)
    first = (table.column("task")[0].as_py(), table.column("block")[0].as_py())
    return pa.Table.from_batches([_update_batch([(*first, mean.tobytes(), weight.tobytes())])])


def _trained(
    model: Model, places: Places, texts: DataFrame, tasks: int, rate: float, batch: int
) -> Model:
    """The model after one round on these texts, which have at most ``tasks`` partitions.

    Each step of the averaging takes ``AVERAGED`` changes of a block into one, down to one.
    """
    sent = texts.sparkSession.sparkContext.broadcast((model, places))
    updates = texts.mapInArrow(_gradient_pass(sent, rate, batch), UPDATE)
    while tasks > 1:
        updates = updates.withColumn("task", F.floor(F.col("task") / AVERAGED))
        updates = updates.groupBy("task", "block").applyInArrow(_averaged, UPDATE)
        tasks = -(-tasks // AVERAGED)
    tables = [model.class_weights.copy(), model.word_weights.copy()]
    # One row per block of the weight tables, whose size is fixed.
    for r in updates.select("block", "change").collect():
        table, start = tables[r["block"] >> 16], (r["block"] & 0xFFFF) * BLOCK_ROWS
        change = np.frombuffer(bytes(r["change"]), np.float16).reshape(-1, table.shape[1])
        table[start : start + len(change)] += change.astype(np.float32)
    return replace(model, class_weights=tables[0], word_weights=tables[1])


def untrained(counts: DataFrame, dictionary: int) -> Model:
    """Dictionary and class masses from a stored table of counts, weights zero."""
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    words = frequent_words(counts, dictionary)
    head = frozenset(w for w, _ in words[:MODEL_WORDS])
    sums = counts.mapInArrow(_ending_totals(head), "class int, tokens long, words long")
    sums = sums.groupBy("class").agg(F.sum("tokens").alias("n"), F.sum("words").alias("v"))
    mass = np.full(CLASSES, 0.5)
    for r in sums.collect():
        if r["class"] >= WORD_CLASSES:
            mass[r["class"]] = r["n"] + 0.5 * (r["v"] + 1)
    numbers = np.array([n for _, n in words], float)
    for own in range(WORD_CLASSES):
        part = numbers[own * CLASS_WORDS : (own + 1) * CLASS_WORDS]
        mass[own] = (part + 0.5).sum() if own * CLASS_WORDS < len(words) else 1e-9
    return Model(
        b" ".join(w for w, _ in words),
        numbers,
        int(totals["n"] or 0),
        int(totals["v"]),
        mass,
        np.zeros((CLASS_ROWS, CLASSES), np.float32),
        np.zeros((WORD_ROWS, CLASS_WORDS), np.float32),
    )


def train(
    texts: DataFrame,
    counts: DataFrame,
    dictionary: int = 1 << 18,
    rounds: int = 3,
    rate: float = 0.1,
    batch: int = 8192,
) -> Model:
    """A model of the training texts (id, text); ``counts`` are theirs, as a stored table.

    Every text is in one round and every token of it is an example, so the examples grow with
    the corpus. The dictionary has at most ``dictionary`` words.
    """
    model = untrained(counts, dictionary)
    places = places_of(model)
    # Each task sends its changed weights, so their number follows the tokens.
    tasks = max(
        texts.sparkSession.sparkContext.defaultParallelism, -(-model.tokens // TASK_TOKENS)
    )
    for number in range(rounds if model.tokens else 0):
        part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(rounds)) == number
        own = texts.filter(part).select("text").coalesce(tasks)
        model = _trained(model, places, own, tasks, rate, batch)
    return model


# --- scoring ------------------------------------------------------------------------------

_PARTIAL = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base", pa.float64()),
        ("model", pa.float64()),
        ("rare", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
    ]
)
PARTIAL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, "
    "rare array<struct<word:binary,n:bigint>>"
)


def log10_probabilities(model: Model, lexicon: Lexicon, codes, place, batch: int = CACHED):
    """log10 of the model's probability of each token, without the count of words outside the
    dictionary."""
    class_bias = _starting_class_bias(model)
    history, classes = lexicon.history[codes], lexicon.classes[codes]
    back = _histories(history, place)
    scores = np.empty(len(codes))
    rows = _class_rows(back)
    for start in range(0, len(codes), batch):
        part = slice(start, start + batch)
        logits = _logits(model.class_weights, class_bias, [r[part] for r in rows])
        scores[part] = _log_softmax_at(logits, classes[part]) / np.log(10)
    # Each depth's tokens are gathered first, so that the parts are full.
    for nodes, choices in lexicon.paths:
        own = nodes[codes]
        at = np.flatnonzero(own >= 0)
        own, within = own[at], choices[codes[at]]
        rows = _word_rows([h[at] for h in back[:2]], own)
        for start in range(0, len(at), batch):
            part = slice(start, start + batch)
            logits = _logits(model.word_weights, lexicon.bias, [r[part] for r in rows], own[part])
            scores[at[part]] += _log_softmax_at(logits, within[part]) / np.log(10)
    unknown = codes >= lexicon.size
    scores[unknown] -= lexicon.log_rest[classes[unknown]]
    return scores


def _partial_scores(sent, batch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, places = sent.value
        lexicon = Lexicon(model, places)
        log_all = np.log10(model.tokens + 0.5 * (model.distinct + 1))
        for rows, words, codes, sizes in _coded(batches, lexicon):
            ends = np.cumsum(sizes)
            scores = np.empty(len(codes))
            first = 0
            # Whole texts of about 100,000 tokens at a time.
            while first < len(ends):
                start = _before(ends, first)
                behind = int(np.searchsorted(ends, start + 100_000)) + 1
                own, place = codes[start : _before(ends, behind)], _places(sizes[first:behind])
                scores[start : start + len(own)] = log10_probabilities(
                    model, lexicon, own, place, batch
                )
                first = behind
            known = codes < lexicon.size
            base = lexicon.log_count[codes] - log_all
            starts = ends - sizes
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("held_out"),
                    pa.array(sizes),
                    pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(scores, starts)),
                    _rare_words(words, sizes, np.flatnonzero(~known)),
                ],
                schema=_PARTIAL,
            )

    return run


def _rare_words(words: pa.Array, sizes: np.ndarray, at: np.ndarray) -> pa.Array:
    """Per text, the words of the tokens at these places and how often each is there."""
    ends = np.cumsum(sizes)
    text = np.searchsorted(ends, at, side="right")
    # The words have no ends among them.
    is_end = at == ends[text] - 1
    found = words.take(pa.array(at - text, mask=is_end)).fill_null(END)
    table = pa.table({"text": text, "word": found, "at": at})
    table = table.group_by(["text", "word"], use_threads=False)
    table = table.aggregate([("at", "min"), ([], "count_all")])
    # In the order of the tokens, so by text.
    table = table.take(pa.array(np.argsort(table.column("at_min").to_numpy())))
    offsets = np.searchsorted(table.column("text").to_numpy(), np.arange(len(sizes) + 1))
    word, n = (table.column(c).combine_chunks() for c in ("word", "count_all"))
    pairs = pa.StructArray.from_arrays([word, n], ["word", "n"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


def score_documents(
    documents: DataFrame,
    model: Model,
    counts: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    batch: int = CACHED,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``base_score`` sums log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens, words and one end;
    ``score`` is the model's log10 probability of the text. Null and empty texts are the end
    alone. A null id reads as the empty text for ``held_out``. Repeated rows score alike and
    stay separate. An empty table gives an empty result. Other columns are not read.
    """
    sent = documents.sparkSession.sparkContext.broadcast((model, places_of(model)))
    own = F.col(f"`{id_column}`").cast("long")
    rows = documents.select(
        own.alias("doc_id"), held_out(own).alias("held_out"), utf8(text_column).alias("text")
    )
    partial = materialize(
        rows.mapInArrow(_partial_scores(sent, batch), PARTIAL).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "partial_scores",
    )
    rare = partial.select("row", F.explode("rare").alias("r")).select(
        "row", F.col("r.word").alias("word"), F.col("r.n").alias("times")
    )
    found = F.coalesce(F.col("n"), F.lit(0))
    joined = (
        rare.join(counts.select("word", "n"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(found + 0.5)).alias("rare_score"),
            F.sum(F.when(found > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    rare_score = F.coalesce("rare_score", F.lit(0.0))
    return partial.drop("rare").join(joined, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rare_score).alias("base_score"),
        (F.col("model") + rare_score).alias("score"),
    )


def train_and_score(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """Count and train on the documents that are not held out, then score all of them."""
    own = F.col(f"`{id_column}`").cast("long")
    texts = documents.filter(~held_out(own)).select(
        own.alias("doc_id"), utf8(text_column).alias("text")
    )
    counts = materialize(token_counts(texts), "token_counts")
    model = train(texts, counts, **options)
    return score_documents(documents, model, counts, id_column, text_column)
