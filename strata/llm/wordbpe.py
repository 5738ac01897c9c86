"""Token ids of ``word_bpe_49k.json`` for whole texts, one cached word at a time.

The tokenizer lower-cases, drops white space and never merges across it, so the ids of a text
are the ids of its blank-separated words, one after the other.  Arrow lower-cases ASCII letters, splits
and numbers the distinct words of a slice of texts; only these are looked up in the worker's bounded cache, and
only words that it lacks go through the ``tokenizers`` library.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words of a generation of the cache; a worker keeps two (memory, not results).
CACHE_WORDS = 350_000
#: Bytes of text that are encoded at a time; a longer text goes alone.
SLICE_BYTES = 2_000_000

_SIGNS = "^[" + re.escape(string.punctuation) + "]+$"


def values(column: pa.Array) -> list:
    """The column's values as Python objects, made in one step."""
    return column.to_numpy(zero_copy_only=False).tolist()


def default_path() -> str:
    """Place of the public vocabulary; every operator takes another as a parameter."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordBpe:
    """Whole-text encoder over a word cache."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        vocab = self.tok.get_vocab()
        self.size = max(vocab.values()) + 1
        self.ends = np.zeros(self.size, dtype=bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True

    def _plain(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Encode unseen words.  Those of letters alone are one word of the pre-tokenizer each; they go
        together in one call that is split again at the ids that end a word."""
        cache = self.cache
        letters = [w for w in words if w.isalpha()]
        other = [w for w in words if not w.isalpha()]
        for i in range(0, len(letters), 8192):
            part = letters[i:i + 8192]
            ids = np.asarray(self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids,
                             dtype="<u4")
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) == len(part):
                data = ids.tobytes()
                cache.update(zip(part, [data[a:b] for a, b in zip([0, *stops], stops)]))
            else:  # a letter that isn't one letter in lower case
                other += part
        for i in range(0, len(other), 8192):
            part = other[i:i + 8192]
            cache.update((w, array("I", e.ids).tobytes()) for w, e in zip(
                part, self.tok.encode_batch_fast(part, add_special_tokens=False)))

    def _ids(self, words: list[str]) -> list[bytes]:
        cache, old = self.cache, self.old
        new = [w for w in words if w not in cache]
        if new:
            if len(cache) + len(new) > CACHE_WORDS:
                self.old, self.cache = cache, {}
                cache, old, new = self.cache, self.old, words
            cache.update([(w, old[w]) for w in new if w in old])
            if unseen := [w for w in new if w not in cache]:
                self._learn(unseen)
        return [cache[w] for w in words]

    def split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Words of texts in lower case (ASCII letters): where each text's begin (one more at the end), the number of each
        word, and the distinct words; one of them may be empty."""
        words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = pc.dictionary_encode(words.values)
        return words.offsets.to_numpy(), coded.indices.to_numpy(zero_copy_only=False), coded.dictionary

    def join(self, bounds: np.ndarray, index: np.ndarray, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of what ``split`` gives, and where each text's begin (one more at the end)."""
        # letters and the signs after them (up to three here) are two words of the pre-tokenizer
        core, sign = distinct, pa.nulls(len(distinct), distinct.type).fill_null("")
        for n in (1, 2, 3):
            front, back = pc.utf8_slice_codeunits(distinct, 0, -n), pc.utf8_slice_codeunits(distinct, -n)
            cut = pc.and_(pc.utf8_is_alpha(front), pc.match_substring_regex(back, _SIGNS))
            core, sign = pc.if_else(cut, front, core), pc.if_else(cut, back, sign)
        heads, tails = pc.dictionary_encode(core), pc.dictionary_encode(sign)
        head, tail = self._ids(values(heads.dictionary)), self._ids(values(tails.dictionary))
        pairs = zip(values(heads.indices), values(tails.indices))
        data = [head[a] + tail[b] for a, b in pairs]
        size = np.fromiter(map(len, data), dtype=np.int64, count=len(data)) // 4
        flat = np.frombuffer(b"".join(data), dtype="<u4")
        begin = (np.cumsum(size) - size).astype(np.int32)
        length = size.astype(np.int32)[index]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(begin[index] - (ends - length).astype(np.int32), length) + np.arange(total, dtype=np.int32)
        return flat[at], np.concatenate([[0], ends])[bounds]

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(ids, bounds)`` for consecutive slices of whole texts; null is an empty text."""
        column = pc.fill_null(column, "")
        if len(column) == 0:
            return
        size = np.cumsum(pc.binary_length(column).to_numpy())
        # a special token is matched before lower-casing: texts that may hold one go to the library
        odd = pc.match_substring(column, "<|").to_numpy(zero_copy_only=False)
        at = 0
        while at < len(column):
            done = size[at - 1] if at else 0
            to = at + 1 if odd[at] else max(at + 1, int(np.searchsorted(size, done + SLICE_BYTES, side="right")))
            if odd[at]:
                ids = np.frombuffer(self._plain(column[at].as_py()), dtype="<u4")
                yield ids, np.array([0, len(ids)])
            else:
                if odd[at:to].any():
                    to = at + int(np.argmax(odd[at:to]))
                part = column.take(pa.array(np.arange(at, to)))
                yield self.join(*self.split(part))
            at = to


_encoders: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """The worker's encoder of a vocabulary file (kept between tasks)."""
    if path not in _encoders:
        _encoders[path] = WordBpe(path)
    return _encoders[path]
