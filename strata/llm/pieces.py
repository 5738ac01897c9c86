"""SentencePiece encoding and decoding by best-scoring segmentation.

A text is normalised as the vocabulary file's rules for white space say (a blank in front, every blank
written as U+2581) and cut into the pieces whose scores add up highest.  An Aho-Corasick automaton over all
pieces reads a word once; at each position it follows its output links through every piece that ends there, and each
of them relaxes the best score at this position (Viterbi).  Of segmentations with equal scores the one whose
last piece is longest wins, at every position.  A character that is no piece becomes the pieces of its UTF-8 bytes,
each below every other score.

No piece of the file holds U+2581 behind another character, so words are cut apart without changing
the best segmentation, and a worker keeps a bounded cache of words.  The file's scores are ranks of merges;
this operator maximises their sum and doesn't replay the merges.

Decoding puts the pieces' bytes together, reads them as UTF-8 and drops the blank in front.  The decoded text
is the encoded one, except that U+2581 in a text reads as a blank.

Defined cases: null text is empty; an empty text has no pieces, score 0 and decodes to an empty text; equal texts
get equal results; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_udf, tokenizer_file
from strata.llm.toxicity import _parts

BLANK = "▁"
#: Words of a generation of the cache; a worker keeps two (memory, not results).
CACHE_WORDS = 300_000
_RUNS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")

RESULT = "struct<ids:array<int>,score:double,decoded_sha256:string,round_trip:boolean>"


class Pieces:
    """Vocabulary, automaton and word cache."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        byte = [model.is_byte(i) for i in range(size)]
        plain = [i for i in range(size) if not (byte[i] or model.is_control(i) or model.is_unknown(i)
                                                or model.is_unused(i))]
        self.score = {names[i]: model.get_score(i) for i in plain}
        self.number = {names[i]: i for i in plain}
        self.bytes = {int(names[i][3:-1], 16): i for i in range(size) if byte[i]}
        self.byte_score = min(self.score.values()) - 1.0
        self.cut_words = not any(BLANK in n.lstrip(BLANK) for n in self.score)
        self.lines = not any("\n" in n for n in self.score)
        self.text_of = [bytes([int(n[3:-1], 16)]) if b else n.encode() if n in self.score else b""
                        for n, b in zip(names, byte)]
        self.single = {n for n in self.score if len(n) == 1}
        inside = "".join(sorted(re.escape(c) for c in self.single))
        self.cut = re.compile(f"[{inside}]+|[^{inside}]+")
        self.automaton = ahocorasick.Automaton()
        for name, i in self.number.items():
            self.automaton.add_word(name, (len(name), self.score[name], i))
        self.automaton.make_automaton()
        self.cache: dict[str, tuple[bytes, float]] = {}
        self.old: dict[str, tuple[bytes, float]] = {}

    def segment(self, word: str) -> tuple[bytes, float]:
        """Ids (32-bit) and score of the best segmentation of a normalised word."""
        if not self.single.issuperset(word):  # characters that are no piece cut the word
            found = [self._bytes(part) if self.outside(part) else self._best(part)
                     for part in self.cut.findall(word)]
            return b"".join([d for d, _ in found]), sum(x for _, x in found)
        return self._best(word)

    def outside(self, part: str) -> bool:
        return part[0] not in self.single

    def _bytes(self, part: str) -> tuple[bytes, float]:
        data = part.encode("utf-8", "replace")
        return array("I", [self.bytes[b] for b in data]).tobytes(), self.byte_score * len(data)

    def _best(self, word: str) -> tuple[bytes, float]:
        best = [0.0] + [-math.inf] * len(word)
        back: list[tuple] = [()] * len(best)
        for end, piece in self.automaton.iter(word):  # by end, the longest piece first
            total = best[end + 1 - piece[0]] + piece[1]
            if total > best[end + 1]:
                best[end + 1], back[end + 1] = total, piece
        ids, at = [], len(word)
        while at:
            size, _, i = back[at]
            ids.append(i)
            at -= size
        ids.reverse()
        return array("I", ids).tobytes(), best[-1]

    def _cached(self, words: list[str]) -> list[tuple[bytes, float]]:
        cache, old = self.cache, self.old
        new = [w for w in words if w not in cache]
        if len(cache) + len(new) > CACHE_WORDS:
            self.old, self.cache = cache, {}
            cache, old, new = self.cache, self.old, words
        for w in new:
            if w in old:
                cache[w] = old[w]
            elif "\n" in w and self.lines and "\0" not in w:  # no piece holds a line break: its parts are words of other lines
                parts = [self._part(p) for p in w.replace("\n", "\0\n\0").split("\0") if p]
                cache[w] = b"".join([d for d, _ in parts]), sum(x for _, x in parts)
            else:
                cache[w] = self.segment(w)
        return [cache[w] for w in words]

    def _part(self, part: str) -> tuple[bytes, float]:
        if part not in self.cache:
            self.cache[part] = self.old.get(part) or self.segment(part)
        return self.cache[part]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of a slice of texts, where each text's begin (one more at the end), and the scores."""
        split = pc.split_pattern(texts, " ")
        runs = pc.match_substring_regex(texts, f"^ |  |{BLANK}").to_numpy(zero_copy_only=False)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        odd = (runs if self.cut_words else np.ones(len(texts), bool)) & ~empty
        coded = pc.dictionary_encode(split.values)
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names = [BLANK + w for w in coded.dictionary.to_pylist()]
        bounds = split.offsets.to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        use = ~(odd | empty)
        index, owner = index[use[owner]], owner[use[owner]]
        if odd.any():  # blanks in a row stay together
            number = {w: k for k, w in enumerate(names)}
            more, more_of = [], []
            for t in np.flatnonzero(odd).tolist():
                line = BLANK + texts[t].as_py().replace(" ", BLANK)
                for w in (_RUNS.findall(line) if self.cut_words else [line]):
                    more.append(number.setdefault(w, len(number)))
                    more_of.append(t)
            names = list(number)
            owner = np.concatenate([owner, np.array(more_of, dtype=owner.dtype)])
            index = np.concatenate([index, np.array(more, dtype=np.int64)])
            order = np.argsort(owner, kind="stable")
            owner, index = owner[order], index[order]
        wanted = np.unique(index)
        place = np.zeros(len(names) + 1, dtype=np.int64)
        place[wanted] = np.arange(len(wanted))
        found = self._cached([names[k] for k in wanted.tolist()])
        index = place[index]
        size = np.fromiter((len(d) // 4 for d, _ in found), dtype=np.int64, count=len(found))
        score = np.fromiter((s for _, s in found), dtype=np.float64, count=len(found))
        flat = np.frombuffer(b"".join([d for d, _ in found]), dtype="<u4")
        begin = np.cumsum(size) - size
        length = size[index]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.repeat(begin[index] - (ends - length), length) + np.arange(total)]
        words = np.bincount(owner, minlength=len(texts))
        stops = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(words)])]
        return ids, stops, np.bincount(owner, score[index] if len(index) else None, len(texts))

    def decode(self, ids: list[int]) -> str:
        """The text of pieces."""
        table = self.text_of
        text = b"".join([table[i] for i in ids]).decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if text[:1] == " " else text


_loaded: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    """The worker's vocabulary of a file (kept between tasks)."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encoder(path: str):
    """Column function: whole text to ids, score and the check of their decoding."""

    def make():
        pieces = loaded(path)

        def work(batch: pa.Array) -> pa.Array:
            ids, scores, digests, same, sizes = [], [], [], [], []
            for part in _parts(batch):
                flat, stops, score = pieces.encode(part)
                every = flat.tolist()
                for text, a, b in zip(part.to_pylist(), stops[:-1].tolist(), stops[1:].tolist()):
                    back = pieces.decode(every[a:b])
                    digests.append(hashlib.sha256(back.encode("utf-8", "replace")).hexdigest())
                    same.append(back == text.replace(BLANK, " "))
                ids.append(flat.astype(np.int32))
                sizes.append(np.diff(stops))
                scores.append(score)
            ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes or [np.zeros(0, int)]))]).astype(np.int32)
            return pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids or [np.zeros(0, np.int32)]))),
                 pa.array(np.concatenate(scores or [np.zeros(0)])), pa.array(digests, pa.string()),
                 pa.array(same, pa.bool_())], names=["ids", "score", "decoded_sha256", "round_trip"])
        return work
    return text_udf(make, RESULT)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """One row a document: ``doc_id, n_pieces, ids, score, decoded_sha256, round_trip``."""
    path = model or tokenizer_file("piece_bpe_32k.model")
    return df.select(df[id_col].alias("doc_id"), encoder(path)(df[text_col]).alias("p")).select(
        "doc_id", F.size("p.ids").cast("long").alias("n_pieces"), "p.*")
