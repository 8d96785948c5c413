"""Subword ids of words, looked up in a bounded cache.

The tokenizers used here split at white space and between letters and other
characters, so the ids of a text are the ids of its words one after another,
and a letter followed by closing punctuation may be split there too, unless
normalising turns the letter's end into something else (a dotted capital I
ends in a combining dot): the tokenizer itself is asked, once per letter.  A worker
keeps the ids of recent words and word stems; only unseen stems go through the
tokenizer, many in one call, and the offsets that it returns say which ids
belong to which stem.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from creditlens.llm.common import column_words, keep

#: Entries in each of the two generations of a worker's cache.
CACHE_WORDS = 400_000
_CALL_WORDS = 128
#: Closing punctuation that the tokenizer never joins to a letter before it.
_CLOSING = b".,;:!?*$&%#"


class Recent:
    """Bounded map: when the young generation of ``limit`` entries is full it becomes the old one."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, words: Iterable[bytes], age: bool = True) -> list[bytes]:
        """The ``words`` that are not kept; the others are in ``young`` afterwards.
        With ``age`` a full young generation is put away first."""
        if age and len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        out = []
        for w in (words if isinstance(words, set) else set(words)).difference(self.young):
            ids = self.old.get(w)
            if ids is None:
                out.append(w)
            else:
                self.young[w] = ids
        return out


class WordIds:
    """Word (UTF-8 bytes without ASCII white space) -> its ids as packed uint32."""

    def __init__(self, name: str):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.words = Recent(CACHE_WORDS)  # words, and the stems and tails of those that are split
        self.closed: dict[str, bool] = {}
        self.letters: dict[str, bool] = {}
        # a byte-level piece is written in the symbols of its bytes
        alphabet = self.tokenizer.pre_tokenizer.pre_tokenize_str("é")[0][0] if self.tokenizer.pre_tokenizer else ""
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        self.symbols = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in own)}
        self.direct = alphabet == "é".encode().decode("latin-1").translate(self.symbols)

    def _encode(self, stems: list[bytes]) -> None:
        """Ids of ``stems``.  A word of letters alone is one piece of the
        tokenizer's model, which takes it directly; others go through the whole
        tokenizer, many in one call, and its offsets tell them apart."""
        mixed, model, known = [], self.tokenizer.model, self.words.young
        for i in range(0, len(stems), _CALL_WORDS):
            part = stems[i:i + _CALL_WORDS]
            text = b" ".join(part).decode()
            plain = (self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text).split(" ")
            if not self.direct or len(plain) != len(part):
                mixed += part
                continue
            found, ends, ids = [], [0], []
            for w, word in zip(part, plain):
                if word.isascii():
                    direct, piece = word.isalpha(), word
                else:
                    direct, piece = self._is_letters(word), word.encode().decode("latin-1").translate(self.symbols)
                if direct:
                    found.append(w)
                    ids += [t.id for t in model.tokenize(piece)]
                    ends.append(len(ids))
                else:
                    mixed.append(w)
            packed = np.array(ids, np.uint32).tobytes()
            for w, a, b in zip(found, ends, ends[1:]):
                known[w] = packed[4 * a:4 * b]
        for i in range(0, len(mixed), _CALL_WORDS):
            part = mixed[i:i + _CALL_WORDS]
            texts = [w.decode() for w in part]
            enc = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            lens = np.fromiter(map(len, texts), np.int64, len(texts))
            starts = np.cumsum(lens + 1) - lens - 1
            first = np.array([s for s, _ in enc.offsets], np.int64)
            edges = np.searchsorted(first, np.append(starts, 2**62)).tolist()
            packed = np.array(enc.ids, np.uint32).tobytes()
            for w, a, b in zip(part, edges, edges[1:]):
                known[w] = packed[4 * a:4 * b]

    def _is_letters(self, word: str) -> bool:
        """Whether every character joins its neighbours as a letter does, as the tokenizer has it."""
        for c in set(word).difference(self.letters):
            self.letters[c] = len(self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{c}b")) == 1
        return all(map(self.letters.__getitem__, word))

    def _closes(self, letter: str) -> bool:
        """Whether the tokenizer splits between ``letter`` and punctuation after it."""
        if letter not in self.closed:
            t, text = self.tokenizer, f"a{letter}."
            text = t.normalizer.normalize_str(text) if t.normalizer else text
            self.closed[letter] = letter.isalpha() and t.pre_tokenizer.pre_tokenize_str(text)[-1][0][:1] == "."
        return self.closed[letter]

    def _split(self, word: bytes) -> tuple[bytes, bytes]:
        stem = word.rstrip(_CLOSING)
        if len(stem) == len(word) or not stem or not (97 <= stem[-1] <= 122 or self._closes(stem[-4:].decode(errors="ignore")[-1:])):
            return word, b""
        return stem, word[len(stem):]

    def learn(self, words: set[bytes]) -> None:
        """Make every one of ``words`` present in ``words.young``."""
        new = self.words.missing(words)
        if new:
            halves = {w: pair for w in new if (pair := self._split(w))[1]}
            parts = self.words.missing((x for pair in halves.values() for x in pair), age=False)
            self._encode(list({w for w in new if w not in halves}.union(parts)))
            known = self.words.young
            for w, (stem, tail) in halves.items():
                known[w] = known[stem] + known[tail]

    def of_texts(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Ids of each text, given as its words."""
        self.learn(set().union(*texts))
        get = self.words.young.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), np.uint32) for words in texts]

    def of_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts`` one after another and where each text's ids
        begin and end.  Only the distinct words become Python objects."""
        flat, edges = split_words(texts)
        coded = flat.dictionary_encode()
        joined, at = coded.dictionary.cast(pa.string()), coded.indices.to_numpy()
        cuts = np.append(0, np.cumsum(pc.binary_length(joined).to_numpy())).tolist()
        text = b"".join(pc.binary_join(pa.ListArray.from_arrays([0, len(joined)], joined), "").cast(pa.binary()).to_pylist())
        distinct = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        packed = list(map(self.words.young.get, distinct))
        unseen = [i for i, x in enumerate(packed) if x is None]
        if unseen:
            self.learn({distinct[i] for i in unseen})
            for i in unseen:
                packed[i] = self.words.young[distinct[i]]
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        lens = size[at]
        ends = np.append(0, np.cumsum(lens))
        first = (np.cumsum(size) - size)[at]
        ids = np.frombuffer(b"".join(packed), np.uint32)
        return ids[np.repeat(first - ends[:-1], lens) + np.arange(ends[-1])], ends[edges]


def lowered_words(text: bytes | None) -> list[bytes]:
    """Words with A-Z lowered, which the lower-casing tokenizer does anyway
    (but never where a special token's string might be)."""
    text = text or b""
    return (text if b"<|" in text else text.lower()).split()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """:func:`lowered_words` of a string column, without nulls and empty words: all
    words one after another and where each text's words begin and end."""
    texts = pc.fill_null(texts, "")
    return column_words(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))


def word_ids(name: str) -> WordIds:
    """The worker's cache for a tokenizer file."""
    return keep(("words", name), lambda: WordIds(name))
