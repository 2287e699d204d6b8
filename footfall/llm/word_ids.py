"""Token ids of texts with the word-level BPE tokenizer, word by word from a cache.

The tokenizer drops white space and never looks across it, so a text's ids are its words' ids
one after another. Most words of a corpus are few: each worker keeps those it has met."""

from __future__ import annotations

import gc
import os
import re

import numpy as np

#: Words kept by a worker, about 200 bytes each: 40 MB.
CACHED_WORDS = 200_000
#: Until so many are kept, all are; later only those that come again.
KEPT_AT_ONCE = 50_000
#: Bits that note which words were met.
MET_BITS = 1 << 25
#: Words joined into one call of the tokenizer.
WORDS_PER_CALL = 4_096

#: Latin letters that normal forms turn into nothing else, and lower-casing into one other, then
#: ASCII marks but the apostrophe: after letters they are a run of their own.
_LETTERS = rb"[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF]|\xC4[\x80-\xAF\xB1-\xBF]|[\xC5-\xC8][\x80-\xBF]|\xC9[\x80-\x8F]"
_MARKS = re.escape(bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"))
_WORD = re.compile(b"((?:" + _LETTERS + b")+)([" + _MARKS + b"]*)")

#: What byte-level tokenizers write for a byte; blanks stay.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTES = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _SHOWN)} | {0x20: 0x20}

_workers: dict[str, WordIds] = {}


def worker_ids(path: str) -> WordIds:
    """The cache of this worker process for a tokenizer file."""
    if path not in _workers:
        _workers[path] = WordIds(path)
    return _workers[path]


class WordIds:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model for runs of letters: there is nothing to normalise or to cut but at blanks.
        self.runs = Tokenizer(self.tokenizer.model)
        self.runs.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.met = np.zeros(MET_BITS // 8, np.uint8)
        self.marks: dict[bytes, bytes] = {}

    def _one(self, word: str) -> bytes:
        return np.asarray(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words of letters only: each is one run for the tokenizer, whose last id
        alone carries the mark of a word's end, so many words go through one call."""
        found, words = {}, sorted(words, key=bytes.isascii)
        for at in range(0, len(words), WORDS_PER_CALL):
            part = words[at : at + WORDS_PER_CALL]
            text = b" ".join(part).decode().lower()
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(_BYTES)
            (encoded,) = self.runs.encode_batch_fast([text], add_special_tokens=False)
            ids = np.asarray(encoded.ids, "<u4")
            ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
            if len(ends) != len(part):
                raise RuntimeError("the tokenizer cut a word of letters")
            data, starts = ids.tobytes(), [0, *ends[:-1].tolist()]
            found.update(zip(part, [data[i:j] for i, j in zip(starts, ends.tolist())]))
        return found

    def _came_before(self, words: list[bytes]) -> np.ndarray:
        """Which of some different words were asked for already. It may say so of a few new ones."""
        places = np.fromiter(map(hash, words), np.int64, len(words)) % MET_BITS
        at, bit = places >> 3, np.left_shift(1, places & 7).astype(np.uint8)
        before = self.met[at] & bit != 0
        np.bitwise_or.at(self.met, at, bit)
        return before

    def _new(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not known, and of stems found in them."""
        plain: list[bytes] = []
        marked: list[tuple[bytes, bytes, bytes]] = []
        odd: list[bytes] = []
        for word in words:
            match = _WORD.fullmatch(word)
            if not match:
                odd.append(word)
                continue
            stem, marks = match.groups()
            if not stem.isascii():
                stem = stem.decode().lower().encode()
            if marks or stem != word:
                marked.append((word, stem, marks))
            else:
                plain.append(word)
        known = self.known
        found = self._letters({*plain, *(stem for _, stem, _ in marked if stem not in known)})
        for word, stem, marks in marked:
            ids = found[stem] if stem in found else known[stem]
            found[word] = ids + self._marks(marks) if marks else ids
        for word in odd:
            found[word] = self._one(word.decode())
        return found

    def _forget(self, found: dict[bytes, bytes]) -> None:
        """Most words of a corpus never come again, so after a while only those are kept that
        have come before."""
        known = self.known
        if len(known) > KEPT_AT_ONCE:
            words = list(found)
            room = CACHED_WORDS - (len(known) - len(words))
            keep = self._came_before(words)
            if keep.sum() > room:
                keep &= keep.cumsum() <= max(0, room)
            for i in np.flatnonzero(~keep).tolist():
                del known[words[i]]

    def _marks(self, marks: bytes) -> bytes:
        if marks not in self.marks:
            if len(self.marks) > 10_000:
                self.marks.clear()
            self.marks[marks] = self._one(marks.decode())
        return self.marks[marks]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text."""
        collecting = gc.isenabled()
        gc.disable()  # a million cached words hold no cycles, but each collection would visit what is built here
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        # Lower-casing first makes fewer words; a special token's name must stay as it is.
        lists = [(text if b"<|" in text else text.lower()).split() for text in texts]
        known = self.known
        found = self._new(set().union(*lists).difference(known))
        known.update(found)
        ids = [b"".join(map(known.__getitem__, words)) for words in lists]
        self._forget(found)
        return ids
