"""A toxicity classifier that is held to the same score when identity terms are swapped.

A logistic regression over the words of a document and their beginnings. In labelled sentences
that name a group the term is swapped for others of its kind, and left out; training penalises
the squared change of the sentence's score, so naming a group neutrally does not raise a score.
A swap is kept as the features that it takes away and brings, and equal ones are counted, so a
sentence costs no copies however long it is. The model is fitted on a bounded sample of labelled
documents, drawn by label, and then scores every document in a map-only pass.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.llm.decontamination import words_of
from linewarden.llm.words import rows_of, utf8
from linewarden.session import materialize

# Terms that name groups of people, by kind. A term is swapped within its kind.
IDENTITY_TERMS = {
    "religion": (
        "atheist", "buddhist", "catholic", "christian", "hindu", "jewish", "muslim", "protestant",
        "sikh",
    ),
    "religions": (
        "atheists", "buddhists", "catholics", "christians", "hindus", "jews", "muslims", "sikhs",
    ),
    "gender": ("female", "male", "nonbinary", "transgender"),
    "person": ("boy", "girl", "man", "woman"),
    "persons": ("boys", "girls", "men", "women"),
    "orientation": ("bisexual", "gay", "heterosexual", "homosexual", "lesbian", "queer", "straight"),
    "origin": (
        "african", "american", "arab", "asian", "black", "chinese", "english", "european",
        "french", "german", "hispanic", "indian", "japanese", "latino", "mexican", "spanish",
        "white",
    ),
    "status": ("foreigner", "immigrant", "migrant", "refugee"),
    "statuses": ("foreigners", "immigrants", "migrants", "refugees"),
    "ability": ("blind", "deaf", "disabled", "paralyzed"),
    "age": ("elderly", "old", "teenage", "young"),
    "german_persons": ("frauen", "jungen", "mädchen", "männer"),
    "german_religions": ("christen", "hindus", "juden", "muslime"),
    "french_persons": ("femmes", "filles", "garçons", "hommes"),
    "french_religions": ("chrétiens", "hindous", "juifs", "musulmans"),
    "spanish_persons": ("chicas", "chicos", "hombres", "mujeres"),
    "spanish_religions": ("cristianos", "hindúes", "judíos", "musulmanes"),
}
SWAPS = {
    term.encode(): tuple(other.encode() for other in terms if other != term)
    for terms in IDENTITY_TERMS.values()
    for term in terms
}
SENTENCE_ENDS = (b".", b"!", b"?")
STEMS = (3, 4, 5, 6)


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashes of a word and of its first letters, as signed 64-bit numbers."""
    text = word.decode()
    names = [b"w" + word, *(b"s" + text[:n].encode() for n in STEMS if len(text) > n)]
    digests = b"".join(xxhash.xxh3_64_digest(name) for name in names)
    return tuple(np.frombuffer(digests, np.int64).tolist())


@lru_cache(maxsize=20_000)
def known_features(word: bytes) -> tuple[int, ...]:
    """``word_features`` for learning, which meets a word in many documents of a small sample.

    Workers live on after a task, so what they keep stays small.
    """
    return word_features(word)


def held_out(id_column: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo ``parts``."""
    crc = F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary"))
    return crc % parts == part


# --- learning -----------------------------------------------------------------------------


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other documents each feature occurs."""
    toxic, other = Counter(), Counter()

    def counts() -> pa.RecordBatch:
        features = list(toxic.keys() | other.keys())
        columns = [features, [toxic[f] for f in features], [other[f] for f in features]]
        toxic.clear()
        other.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["feature", "toxic", "other"]
        )

    for text, label in rows_of(batches, "text", "toxic"):
        features = {f for word in set(words_of(text)) for f in known_features(word)}
        (toxic if label else other).update(features)
        if len(toxic) + len(other) > 500_000:
            yield counts()
    yield counts()


def sentences(text: bytes) -> list[list[bytes]]:
    """The words of each sentence: a sentence ends with a word that ends with . ! or ?"""
    found, current = [], []
    for part in text.split():
        current += words_of(part)
        if part.endswith(SENTENCE_ENDS):
            found.append(current)
            current = []
    return [s for s in (*found, current) if s]


def counterfactuals(words: set[bytes]) -> list[tuple[bytes, bytes | None]]:
    """Each identity term among the words with every other of its kind, and with None for
    leaving it out; empty for words that name no group."""
    return [
        (term, other) for term in sorted(words & SWAPS.keys()) for other in (*SWAPS[term], None)
    ]


def score_changes(
    sentence: list[bytes], features: Callable[[bytes], set[int]]
) -> Counter[tuple[tuple[int, ...], tuple[int, ...]]]:
    """The features that each swap of a term, wherever the sentence has it, takes away and
    brings, and how many swaps do so; a swap that changes nothing is left out."""
    words, changes = set(sentence), Counter()
    if words.isdisjoint(SWAPS):
        return changes
    holders = Counter(f for word in words for f in features(word))
    for term, other in counterfactuals(words):
        new = features(other) if other else set()
        gone = sorted(f for f in features(term) - new if holders[f] == 1)
        come = sorted(f for f in new if f not in holders)
        if gone or come:
            changes[tuple(gone), tuple(come)] += 1
    return changes


def _examples(numbers):
    """Per labelled document the numbers of its features, and the score changes of its
    sentences' swaps, equal ones together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value

        def of(word: bytes) -> set[int]:
            return {known[f] for f in known_features(word) if f in known}

        for batch in batches:
            rows = []
            for text, label in rows_of(iter([batch]), "text", "toxic"):
                words, pairs = set(words_of(text)), Counter()
                if not words.isdisjoint(SWAPS):
                    for sentence in sentences(text):
                        pairs.update(score_changes(sentence, of))
                rows.append(
                    {
                        "features": sorted({f for word in words for f in of(word)}),
                        "toxic": int(label != 0),
                        "pairs": [
                            {"gone": gone, "come": come, "n": n}
                            for (gone, come), n in pairs.items()
                        ],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_EXAMPLES)

    return run


_NUMBERS = pa.list_(pa.int32())
_EXAMPLES = pa.schema(
    [
        ("features", _NUMBERS),
        ("toxic", pa.int32()),
        ("pairs", pa.list_(pa.struct([("gone", _NUMBERS), ("come", _NUMBERS), ("n", pa.int64())]))),
    ]
)
EXAMPLES = (
    "features array<int>, toxic int, pairs array<struct<gone:array<int>,come:array<int>,n:bigint>>"
)


def _rows(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The row and the number of every entry of the lists."""
    sizes = np.array([len(x) for x in lists], np.int64)
    flat = np.array([n for x in lists for n in x], np.int64)
    return np.repeat(np.arange(len(lists)), sizes), flat


def fit(
    features: list[list[int]],
    toxic: list[int],
    pairs: list[tuple[list[int], list[int], int]],
    width: int,
    penalty: float = 5.0,
    ridge: float = 1e-4,
    steps: int = 400,
) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the mean log loss, the mean squared score change over the
    counterfactual pairs (features gone, features come, how often), and a ridge."""
    row, at = _rows(features)
    labels = np.array(toxic, float)
    n = max(len(labels), 1)
    share = (labels.sum() + 0.5) / (n + 1)
    theta = np.zeros(width + 1)
    theta[-1] = np.log(share / (1 - share))
    if not len(labels):
        return theta[:-1], -4.0
    gone_row, gone = _rows([g for g, _, _ in pairs])
    come_row, come = _rows([c for _, c, _ in pairs])
    times = np.array([n for _, _, n in pairs], float)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        score = np.bincount(row, theta[at], minlength=len(labels)) + theta[-1]
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels) / n
        slope = np.append(np.bincount(at, error[row], minlength=width), error.sum())
        slope[:-1] += ridge * theta[:-1]
        if pairs:
            change = np.bincount(come_row, theta[come], minlength=len(pairs)) - np.bincount(
                gone_row, theta[gone], minlength=len(pairs)
            )
            change *= 2 * penalty * times / times.sum()
            slope[:-1] += np.bincount(come, change[come_row], minlength=width)
            slope[:-1] -= np.bincount(gone, change[gone_row], minlength=width)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


@dataclass
class Model:
    """Weights by feature; every other feature weighs nothing."""

    weights: dict[int, float]
    bias: float


def train(
    documents: DataFrame,
    labels: DataFrame,
    sample: int = 20_000,
    max_features: int = 4096,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Model:
    """Fit on about ``sample`` labelled documents that are not held out, or all if fewer.

    Labels are drawn by a hash of the id, toxic ones up to half of the sample and others up to
    the rest, so the expected number is bounded however many there are and rare toxic ones are
    not lost among the others; the bias is set back to the shares of all labels. Null labels and
    ids are skipped and a document labelled twice is toxic if any label says so. The sample's
    features are counted in tasks; at most ``max_features`` that occur in three toxic documents
    or more, and there ``e`` times as often as elsewhere, get weights, along with the identity
    terms. This choice of features is part of the model, and the same at every size. Without
    usable labels the model scores all the same, low.
    """
    spark = documents.sparkSession
    usable = (
        labels.select(
            F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic")
        )
        .filter(F.col("label_id").isNotNull() & F.col("toxic").isNotNull())
        .filter(~held_out(F.col("label_id")))
        .groupBy("label_id")
        .agg((F.max("toxic") != 0).cast("int").alias("toxic"))
    )
    known = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    toxic_share = min(1.0, sample / 2 / max(known.get(1, 0), 1))
    other_share = min(1.0, (sample - toxic_share * known.get(1, 0)) / max(known.get(0, 0), 1))
    draw = F.pmod(F.xxhash64("label_id", F.lit(4)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, toxic_share).otherwise(other_share)
    # About ``sample`` rows of two numbers.
    drawn = F.broadcast(usable.filter(draw < share))
    own = F.col(f"`{id_column}`").cast("long")
    rows = materialize(
        documents.select(own.alias("label_id"), utf8(text_column).alias("text"))
        .join(drawn, "label_id")
        .select("text", "toxic"),
        "toxicity_sample",
    )
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_other = totals.get(1, 0), totals.get(0, 0)
    counts = rows.mapInArrow(_feature_counts, "feature long, toxic long, other long")
    counts = counts.groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")
    )
    lift = F.log(
        ((F.col("toxic") + 0.1) / (n_toxic + 1)) / ((F.col("other") + 0.1) / (n_other + 1))
    )
    terms = [f for term in SWAPS for f in word_features(term)[:1]]
    chosen = (
        counts.filter((F.col("toxic") >= 3) & (lift > 1.0))
        .orderBy((F.col("toxic") * lift).desc(), "feature")
        .limit(max_features)
        .select("feature")
        .union(counts.filter(F.col("feature").isin(terms)).select("feature"))
    )
    numbers = {f: i for i, f in enumerate(sorted({r["feature"] for r in chosen.collect()}))}
    sent = spark.sparkContext.broadcast(numbers)
    stored = materialize(rows.mapInArrow(_examples(sent), EXAMPLES), "toxicity_examples")
    examples = stored.select("features", "toxic").collect()
    # Distinct changes are features of two terms of a kind, so their number is bounded.
    pairs = stored.select(F.inline("pairs")).groupBy("gone", "come").agg(F.sum("n").alias("n"))
    weights, bias = fit(
        [r["features"] for r in examples],
        [r["toxic"] for r in examples],
        sorted((r["gone"], r["come"], r["n"]) for r in pairs.collect()),
        len(numbers),
    )
    bias += float(np.log(other_share / toxic_share))
    return Model({f: float(weights[i]) for f, i in numbers.items()}, bias)


# --- scoring ------------------------------------------------------------------------------


class WordScores(dict):
    """The weighted features of each word met; most words have none."""

    def __init__(self, weights: dict[int, float], kept: int = 200_000):
        super().__init__()
        self.weights, self.kept = weights, kept

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.kept:
            self.clear()
        found = tuple(f for f in word_features(word) if f in self.weights)
        self[word] = found
        return found


class Scorer:
    def __init__(self, model: Model):
        self.words, self.model = WordScores(model.weights), model

    def score(self, text: bytes) -> float:
        found = {f for x in map(self.words.__getitem__, set(words_of(text))) if x for f in x}
        total = self.model.bias + sum(self.model.weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def score_documents(
    documents: DataFrame,
    model: Model,
    threshold: float = 0.3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    Null texts score as empty ones: what the bias alone says. Texts are scored whole. A null
    id reads as the empty text for ``held_out``. Repeated rows score alike. An empty table
    gives an empty result. Nothing but the text enters the score.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            scores = [scorer.score(text) for (text,) in rows_of(iter([batch]), "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "score"],
            )

    own = F.col(f"`{id_column}`").cast("long")
    rows = documents.select(
        own.alias("doc_id"), held_out(own).alias("held_out"), utf8(text_column).alias("text")
    )
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(
    documents: DataFrame, model: Model, threshold: float = 0.3, text_column: str = "text"
) -> DataFrame:
    """The documents that score below the threshold, all columns unchanged; nothing is joined."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    text_at = documents.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary())
            keep = [
                scorer.score(text or b"") < threshold
                for start in range(0, len(texts), 512)
                for text in texts.slice(start, 512).to_pylist()
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
