"""Token ids of whole texts by a public tokenizer, word by word.

The tokenizer drops white space and treats what lies between as independent, so a text's ids
are those of its words in a row. Words repeat a lot, so each worker keeps the ids of the words
it met last. The vocabulary file is read on the driver and sent along (its size is fixed).
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer, pre_tokenizers

WORD_BPE = "word_bpe_49k.json"
# Lower-case Latin letters: words of these alone are one piece for the tokenizer.
PLAIN = re.compile("[a-zß-öø-ſ]+")


class WordEncoder(dict):
    """Maps a word's UTF-8 bytes, A-Z lower-cased, to its ids as little-endian 32-bit bytes.

    At most twice ``kept`` words are held: when the dictionary is full it becomes the old
    one, from which words in use are taken over.
    """

    def __init__(self, vocabulary: str, kept: int = 600_000):
        super().__init__()
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.model, self.normalize = self.tokenizer.model, self.tokenizer.normalizer.normalize_str
        self.kept, self.old = kept, {}
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [*range(0x61, 0x7B), *range(0xDF, 0x180)]
        self.bytes_of = {c: to_bytes.pre_tokenize_str(chr(c))[0][0] for c in letters}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(self) >= self.kept:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _ids(self, word: bytes) -> bytes:
        if word.isalpha():  # a-z alone: one piece as it stands
            pieces = word.decode()
        elif word[-1:] in (b".", b",") and word[-2:-1].isalpha():
            # Letters and the mark behind them are separate pieces.
            return self[word[:-1]] + self[word[-1:]]
        else:
            text = self.normalize(word.decode())
            if not PLAIN.fullmatch(text):
                if text[-1:] in (".", ",") and PLAIN.fullmatch(text[:-1]):
                    return self[word[:-1]] + self[word[-1:]]
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                return np.array(ids, "<u4").tobytes()
            pieces = text.translate(self.bytes_of)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(pieces)])

    def encode(self, text: bytes) -> bytes:
        """The ids of a whole text, four bytes each."""
        return b"".join(map(self.__getitem__, text.lower().split()))


@lru_cache(maxsize=1)
def _encoder(vocabulary: str) -> WordEncoder:
    return WordEncoder(vocabulary)


def encoder_of(vocabulary: Broadcast) -> WordEncoder:
    """This worker's encoder, kept between tasks."""
    return _encoder(vocabulary.value)


# Texts on which a tokenizer that looks beyond words, or at case or white space, differs.
PROBES = (
    "Some words, one after another; and MORE of them.",
    "  white\tspace \n\n of  every\x0bkind ",
    "Ünïcödé ÀÉ ß ﬁ e\u0301 日本語 \U0001f600",
    "x1 22 3.14 a-b don't (it) e.g. ... ,., <s> </s> [UNK] a/b@c.d",
)


@lru_cache(maxsize=4)
def check_vocabulary(vocabulary: str) -> int:
    """The number of ids, after raising if the word by word ids are not the tokenizer's own."""
    if Tokenizer.from_str(vocabulary).normalizer is None:
        raise ValueError("this tokenizer does not work word by word: it has no normalizer")
    encoder = WordEncoder(vocabulary)
    for text in PROBES:
        own = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        if np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() != own:
            raise ValueError(f"this tokenizer does not work word by word: {text!r}")
    return encoder.tokenizer.get_vocab_size()


def vocabulary_of(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file's text, for ``encoder_of`` in tasks.

    A tokenizer that this encoder is not right for is refused.
    """
    with open(path, encoding="utf-8") as file:
        vocabulary = file.read()
    check_vocabulary(vocabulary)
    return spark.sparkContext.broadcast(vocabulary)


def public_path(name: str = WORD_BPE) -> str:
    """Where the public tokenizers keep a file."""
    import public_tokenizers

    return public_tokenizers.path(name)
