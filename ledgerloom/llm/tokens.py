"""Ids of whole texts from a vocabulary file of the tokenizers library, each piece encoded once.

The vocabulary's pre-tokenizer drops white space, parts letters from other characters, and lower
case is folded; its merges never cross such a border. So a text's ids are those of its parts in a
row, if it is cut at blanks and line feeds and between a letter of ASCII or Latin-1 and an ASCII
sign other than the apostrophe (which may begin a piece with letters). Tests compare this with the
encoding of whole texts. Texts that hold the string of an added token are encoded whole. A part met again is looked up by its 64-bit hash; the table of known parts
starts anew when it has grown to its bound, which costs time and never changes results.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerloom.llm.words import span_hashes, text_bytes

KNOWN_PARTS, KNOWN_IDS = 2_000_000, 12_000_000
_LEARN_AT_ONCE = 20_000

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A"): ord("Z") + 1] += 32
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"): ord("z") + 1] = True
_SIGN = np.zeros(256, bool)
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum() and c != ord("'")]] = True
_LATIN, _NO_LETTERS = 0xC3, (0x97, 0xB7)  # the lead byte of the Latin-1 letters; of these two are no letters


def parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes of all texts, begin and end of each part, and the n + 1 first parts of the texts."""
    data, offsets = text_bytes(texts)
    data = _FOLDED[data]
    inside = (data != 32) & (data != 10)
    begins, letter, sign = inside.copy(), _LETTER[data], _SIGN[data]
    latin = (data[:-1] == _LATIN) & (data[1:] != _NO_LETTERS[0]) & (data[1:] != _NO_LETTERS[1])
    letter_ends, letter_begins = letter, letter.copy()
    letter_ends = letter.copy()
    letter_ends[1:] |= latin
    letter_begins[:-1] |= latin
    begins[1:] &= ~inside[:-1] | (letter_ends[:-1] & sign[1:]) | (sign[:-1] & letter_begins[1:])
    filled = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[filled] = inside[filled]
    start = np.flatnonzero(begins)
    stops = begins.copy()  # a part ends where the next one begins or white space follows
    stops[1:] |= inside[:-1] & ~inside[1:]
    stops[filled] = True
    stop = np.append(np.flatnonzero(stops), len(data))
    end = stop[np.searchsorted(stop, start, side="right")]
    return data, start, end, np.searchsorted(start, offsets)


class PartEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends_piece = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_piece[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes, with where their ids begin and how many there are
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint16 if len(self.ends_piece) <= 1 << 16 else np.uint32), 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32) and the n + 1 offsets of the texts."""
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.fill_null(pc.match_substring(texts, token, ignore_case=True), False).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_parts(texts)
        ids, offsets = self._by_parts(pc.if_else(pa.array(whole), pa.scalar("", texts.type), texts))
        own = [self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids if whole[i] else ids[offsets[i]: offsets[i + 1]]
               for i in range(len(texts))]
        return np.concatenate(own).astype(np.uint32), np.cumsum([0, *map(len, own)])

    def _by_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, start, end, begins = parts(texts)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        distinct, sample, inverse = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        at, found = self._looked_up(distinct)
        if not found.all():
            if len(self.known) + len(distinct) > KNOWN_PARTS or self.used > KNOWN_IDS:
                self._reset()
                found[:] = False
            new = np.flatnonzero(~found)
            view = data.tobytes()
            self._learn(distinct[new], [view[a:b].decode() for a, b in zip(start[sample[new]].tolist(), end[sample[new]].tolist())])
            at, _ = self._looked_up(distinct)
        where = at[inverse]
        lengths = self.length[where].astype(np.int64)
        ends = np.cumsum(lengths)
        ids = self.pool[np.repeat(self.first[where] - ends + lengths, lengths) + np.arange(ends[-1])]
        return ids.astype(np.uint32), np.concatenate([[0], ends])[begins]

    def _looked_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        return at, self.known[at] == hashes if len(self.known) else np.zeros(len(hashes), bool)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Add parts that are not known, given with their ascending hashes."""
        first, length = np.zeros(len(words), np.int64), np.zeros(len(words), np.int32)
        plain = np.array([w.isalpha() for w in words], bool)
        for which, encoded in ((np.flatnonzero(plain), self._letters), (np.flatnonzero(~plain), self._mixed)):
            for some in (which[i: i + _LEARN_AT_ONCE] for i in range(0, len(which), _LEARN_AT_ONCE)):
                ids, lengths = encoded([words[i] for i in some.tolist()])
                while len(self.pool) < self.used + len(ids):
                    self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
                self.pool[self.used: self.used + len(ids)] = ids
                length[some], first[some] = lengths, self.used + np.cumsum(lengths) - lengths
                self.used += len(ids)
        at = np.searchsorted(self.known, hashes)
        self.known, self.first, self.length = (np.insert(x, at, y) for x, y in (
            (self.known, hashes), (self.first, first), (self.length, length)))

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per word of letters: one piece each, so the ends of pieces part them."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int64)
        ends = np.flatnonzero(self.ends_piece[ids]) + 1
        if len(ends) != len(words):  # some letter's lower case is more than a letter
            return self._mixed(words)
        return ids, np.diff(ends, prepend=0)

    def _mixed(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoding = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.array(encoding.ids, np.int64), np.bincount(np.array(encoding.word_ids, np.int64), minlength=len(words))


@cache
def encoder(path: str) -> PartEncoder:
    """One encoder per vocabulary file and Python process, kept between tasks."""
    return PartEncoder(path)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
