"""Ids of whole texts by a tokenizer file whose words are independent: the library's results with each word encoded once."""

from __future__ import annotations

import dataclasses
import functools
import json
import os
import re
import struct

import numpy as np
from tokenizers import Tokenizer

from rillmark.llm.common import mix, powers

PIECES, WORDS = 1 << 20, 20_000  # pieces (some 30 bytes each) and words of other characters that a worker remembers
RUN = 1 << 19  # bytes of text cut and hashed at once

# The normaliser under which ASCII white space cuts a text into independent words, the pattern that cuts these into
# pieces, the characters that are only lower-cased, and the character the vocabulary has for each byte.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile(r"[\t-\r -~\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f]*")
_SPACE = re.compile(r"[\t-\r ]+")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = dict(zip(_SHOWN, _SHOWN)) | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


# classes of bytes of plain text: white space, letters (and all bytes of longer characters), digits, signs
_CLASS = np.full(256, 1, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58] = 2
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 3


def cut_pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of lower-case plain text (bytes) begin and end, as the pattern cuts them."""
    kind = _CLASS[data]
    begins = kind != 0
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    # an apostrophe that begins a piece takes a short form with it
    quotes = np.flatnonzero((data == 39) & begins)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    one, two = padded[quotes + 1], padded[quotes + 2]
    size = np.where(np.isin(one, np.frombuffer(b"stmd", np.uint8)), 2, 0)
    size[((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)] = 3
    quotes, size = quotes[size > 0], size[size > 0]
    begins[quotes + 1] = False
    after = quotes + size
    after = after[after < len(data)]
    begins[after] |= kind[after] == 1
    ends = kind != 0
    ends[:-1] &= begins[1:] | (kind[1:] == 0)
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


class PieceTable:
    """Ids of pieces by their 64-bit hash, in sorted arrays; emptied when it is full."""

    def __init__(self, function, most: int = PIECES):
        self.function, self.most = function, most
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def places(self, hashes: np.ndarray, piece) -> np.ndarray:
        """Row of every hash; ``piece(k)`` is the text of the k-th, asked for where it is not known yet."""
        for _ in range(2):
            row = np.searchsorted(self.keys, hashes)
            known = row < len(self.keys)
            known[known] = self.keys[row[known]] == hashes[known]
            if known.all():
                return row
            new, first = np.unique(hashes[~known], return_index=True)
            if len(self.keys) + len(new) > self.most and len(self.keys):
                self.clear()  # the next round asks for all that this call needs
                new, first, known = *np.unique(hashes, return_index=True), np.zeros(len(hashes), bool)
            found = [self.function(piece(k)) for k in np.flatnonzero(~known)[first].tolist()]
            size = np.array([len(x) // 4 for x in found], np.int64)
            where = np.searchsorted(self.keys, new)
            self.keys = np.insert(self.keys, where, new)
            self.at = np.insert(self.at, where, len(self.ids) + np.cumsum(size) - size)
            self.size = np.insert(self.size, where, size)
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), "<i4")])
        return np.searchsorted(self.keys, hashes)


class _Memory(dict):
    """Results of a function; when full, what is still asked for moves on to a new memory and the rest is forgotten."""

    def __init__(self, function, most: int):
        self.function, self.most, self.old = function, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        found = self.old.get(key)
        found = self[key] = self.function(key) if found is None else found
        return found


@dataclasses.dataclass(frozen=True)
class Rules:
    """A tokenizer file, and what a task must know of it besides: read once, by the driver.

    ``by_words``: words are independent and are cut by the pattern that this module knows. ``marks`` are the strings of special tokens.
    """

    spec: str
    by_words: bool
    marks: tuple[str, ...]
    tokens: int


def read_rules(path: str) -> Rules:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    normalizer, cut, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
    added = spec.get("added_tokens", [])
    steps = cut.get("pretokenizers") or [{}]
    split = steps[0]
    known = (
        normalizer.get("type") == "Sequence" and normalizer.get("normalizers") == _NORMALIZER
        and cut.get("type") == "Sequence" and len(steps) == 2
        and split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
        and split.get("pattern") == {"Regex": _PATTERN}
        and steps[1].get("type") == "ByteLevel" and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex")
        and model.get("type") == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added))
    highest = max([*model.get("vocab", {}).values(), *(t["id"] for t in added)], default=-1) if model.get("type") == "BPE" else 1 << 31
    return Rules(text, known, tuple(t["content"] for t in added), highest + 1)


class WordEncoder:
    """Ids as the library gives them for whole texts, without added special tokens, truncation or padding.

    If the tokenizer file says that words are independent, texts of Latin letters, digits and ASCII signs are cut into pieces by
    their bytes' classes, a run of texts at once, and each new piece goes straight to the library's model. Other texts, and those that
    hold the string of a special token, go through the whole library word by word. With any other file, so does every whole text.
    """

    def __init__(self, rules: Rules):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.library = Tokenizer.from_str(rules.spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.by_words = rules.by_words
        self.marks = rules.marks
        self._low_marks = [m.lower() for m in self.marks]
        self.pieces, self.words = PieceTable(self._piece), _Memory(self._word, WORDS)

    def whole(self, text: str):
        """The library's own encoding, with the place of each token in the text."""
        return self.library.encode(text, add_special_tokens=False)

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(BYTE_CHARS)
        tokens = self.model.tokenize(piece)
        return struct.pack(f"<{len(tokens)}i", *[t.id for t in tokens])

    def _plain(self, text: str) -> bytes | None:
        """A lower-cased text of plain characters without a special token, or None of any other."""
        if not _PLAIN.fullmatch(text):
            return None
        low = text.lower()
        return None if any(m in low for m in self._low_marks) else low.encode()

    def _runs(self, texts: list[bytes]):
        """Ids of plain texts, run after run of about RUN bytes: (ids, where each text's end)."""
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and (end == at or held + len(texts[end]) <= RUN):
                held += len(texts[end]) + 1
                end += 1
            data = b"\n".join(texts[at:end]) + b"\n"
            raw = np.frombuffer(data, np.uint8)
            begins, ends = cut_pieces(raw)
            up, down = powers(max(RUN, len(raw)))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)])])
            hashes = mix((total[ends] - total[begins]) * down[begins])
            table = self.pieces
            row = table.places(hashes, lambda k: data[begins[k]:ends[k]].decode())  # noqa: B023
            size, start = table.size[row], table.at[row]
            before = np.cumsum(size) - size
            ids = table.ids[np.repeat(start - before, size) + np.arange(int(size.sum()))]
            bounds = np.cumsum([len(t) + 1 for t in texts[at:end]])
            yield ids, np.append(before, len(ids))[np.searchsorted(begins, bounds)]
            at = end

    def _word(self, word: str) -> bytes:
        return np.array(self.whole(word).ids, "<i4").tobytes()

    def batch(self, texts: list[str | bytes | None]) -> list[np.ndarray]:
        """Ids of every text (32-bit integers); null is an empty text."""
        own = [t.decode() if isinstance(t, bytes) else t or "" for t in texts]
        if not self.by_words:
            return [np.array(self.whole(t).ids, np.int32) for t in own]
        plain = [self._plain(t) for t in own]
        done = []
        for ids, ends in self._runs([p for p in plain if p is not None]):
            done += np.split(ids, ends[:-1])
        found = iter(done)
        return [next(found) if p is not None else np.frombuffer(b"".join(map(self.words.__getitem__, _SPACE.split(t))), "<i4")
                for t, p in zip(own, plain, strict=True)]


@functools.lru_cache(maxsize=1)
def word_encoder(rules: Rules) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    return WordEncoder(rules)
