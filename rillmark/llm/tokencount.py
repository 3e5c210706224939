"""Token counts (operator 8): count-only Viterbi over the vocabulary matches that an Aho-Corasick automaton enumerates."""

from __future__ import annotations

import math
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rillmark.llm.bytebpe import serialised_model

REMEMBERED = 200_000  # words whose counts a task keeps at once
SPACE = "▁"  # stands for the space before a word
UNKNOWN_PENALTY = 10.0  # fixed value of the tokenizer
_UNIGRAM = 1


def unigram_vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Ordinary pieces of a sentencepiece model with a unigram log-probability from their rank, -ln(rank + 2) as float32.

    The public model holds merge ranks; nothing is trained, the ranks are only read as a Zipf distribution.
    """
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = [sp.id_to_piece(k) for k in range(sp.get_piece_size())
              if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k) or sp.is_byte(k))]
    return [(p, float(np.float32(-math.log(k + 2)))) for k, p in enumerate(pieces)]


def unigram_model(vocabulary: list[tuple[str, float]]) -> bytes:
    """The same vocabulary as a unigram model of the library, to compare with."""
    return serialised_model(vocabulary, _UNIGRAM)


class Counter:
    """Pieces of the best segmentation of a word: best score and piece count are carried, no path is kept.

    Scores are added as the tokenizer adds them, in single precision; only a greater sum replaces the best one, earlier
    starts first. A character that no single-character piece
    matches may be taken alone at ``UNKNOWN_PENALTY`` below the least score; it counts as its UTF-8 bytes.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary:
            self.automaton.make_automaton()
        self.unknown = float(np.float32(min((s for _, s in vocabulary), default=0.0)) - np.float32(UNKNOWN_PENALTY))
        self.known: dict[str, tuple[int, int]] = {}

    def word(self, word: str) -> tuple[int, int]:
        """(pieces, bytes of unknown characters among them)."""
        n = len(word)
        best, count, lost = array("f", [0.0]) * (n + 2), [0] * (n + 1), [0] * (n + 1)  # one place more, to round in
        matches = self.automaton.iter(word) if len(self.automaton) else iter(())
        pending = next(matches, None)
        for end in range(1, n + 1):
            found = single = False
            while pending is not None and pending[0] == end - 1:  # longest first
                size, score = pending[1]
                single |= size == 1
                best[-1] = score + best[end - size]
                total = best[-1]
                if not found or total > best[end]:
                    best[end], count[end], lost[end], found = total, count[end - size] + 1, lost[end - size], True
                pending = next(matches, None)
            if not single:
                best[-1] = self.unknown + best[end - 1]
                total = best[-1]
                if not found or total > best[end]:
                    size = len(word[end - 1].encode())
                    best[end], count[end], lost[end] = total, count[end - 1] + size, lost[end - 1] + size
        return count[n], lost[n]

    def text(self, text: str) -> tuple[int, int, int]:
        """(words, pieces, unknown bytes) of a whole text."""
        words = text.translate(_BLANKS).split(" ")
        known, pieces, lost, n = self.known, 0, 0, 0
        for w in words:
            if w:
                got = known.get(w)
                if got is None:
                    if len(known) > REMEMBERED:
                        known.clear()
                    got = known[w] = self.word(SPACE + w)
                n += 1
                pieces += got[0]
                lost += got[1]
        return n, pieces, lost


_BLANKS = {k: " " for k in range(9, 14)}


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], text: str = "text") -> DataFrame:
    """Add n_words, n_tokens and n_unknown_bytes of the whole text to every row; columns of those names are replaced.

    The tokenizer splits at ASCII white space, puts the space mark before each word and segments each word by itself.
    Null, empty and blank texts count 0; with an empty vocabulary every byte is unknown.
    """
    docs = docs.drop("n_words", "n_tokens", "n_unknown_bytes")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the vocabulary file

    def run(batches):
        counter = Counter(shared.value)
        for batch in batches:
            got = [counter.text(t) if t else (0, 0, 0) for t in batch.column(text).to_pylist()]
            for k, name in enumerate(("n_words", "n_tokens", "n_unknown_bytes")):
                batch = batch.append_column(name, pa.array([g[k] for g in got], pa.int64()))
            yield batch

    extra = [T.StructField(c, T.LongType()) for c in ("n_words", "n_tokens", "n_unknown_bytes")]
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + extra))
