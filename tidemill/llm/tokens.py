"""Whole texts to token ids, word by word, with one bounded memory of words per worker.

The tokenizer splits at white space before anything else, so the ids of a text are the ids of
its words one after the other. Words are told apart by their names (``words``, 64 bits); a new
one is given to the tokenizers library once and its ids are kept, so that texts are put together
in numpy and no word but a new one becomes an object. Where the tokenizer lowers letters, parts
them from punctuation and spells them in bytes, a Latin word is looked up in these two parts,
and its letters go straight to the tokenizer's model.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np

from tidemill.llm.words import spelled

WORDS_KEPT = 1_000_000  # then the memory starts anew; a word takes about 200 bytes
WORDS_LEFT = 100_000  # that an idle worker may keep from one task to the next
TAIL = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
LATIN = 0x180  # letters below have one composed form and, but for two, one lower-case letter
LAST = chr(LATIN)
ODD = frozenset("\u0130\u0149")
_ENCODERS: dict[str, WordEncoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@contextmanager
def encoder(path: str, left: int = WORDS_LEFT) -> Iterator[WordEncoder]:
    """One encoder per worker process and file. A worker lives longer than a task and may do
    other work next, so a task does not leave a memory of more than ``left`` words behind."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    try:
        yield _ENCODERS[path]
    finally:
        if len(_ENCODERS[path].names) > left:
            _ENCODERS[path]._forget()


def _number(index: dict, words) -> list:
    """Give every word that is not in ``index`` the next number; the new ones in order."""
    new = list(set(words).difference(index))
    index.update(zip(new, range(len(index), len(index) + len(new))))
    return new


def _numbers(index: dict, words: list) -> np.ndarray:
    return np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))


class _Pieces:
    """Lists of ids that grow at the end; list n is ``ids[start[n] : start[n] + count[n]]``."""

    def __init__(self):
        self.ids = np.zeros(1 << 20, dtype=np.uint32)
        self.start = np.zeros(1 << 18, dtype=np.int64)
        self.count = np.zeros(1 << 18, dtype=np.int64)
        self.used = 0

    def add(self, numbers: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        last = int(numbers[-1]) + 1 if len(numbers) else 0
        self.ids = _room(self.ids, self.used + len(ids))
        self.start = _room(self.start, last)
        self.count = _room(self.count, last)
        self.ids[self.used : self.used + len(ids)] = ids
        self.count[numbers] = count
        self.start[numbers] = self.used + np.cumsum(count) - count
        self.used += len(ids)

    def join(self, numbers: np.ndarray, out: np.ndarray, at: np.ndarray) -> None:
        """Write list ``numbers[i]`` into ``out`` from ``at[i]`` on."""
        count = self.count[numbers]
        step = np.arange(int(count.sum()), dtype=np.int64)
        step -= np.repeat(np.cumsum(count) - count, count)
        out[np.repeat(at, count) + step] = self.ids[np.repeat(self.start[numbers], count) + step]


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = Tokenizer(self.library.model)  # the merges alone
        self.in_parts = False
        self._forget()
        self.in_parts = self._may_part()
        self._forget()

    def _may_part(self) -> bool:
        """Whether the two ways agree on words that show all that the short way relies on."""
        lower, split = self.library.normalizer, self.library.pre_tokenizer
        if not lower or not split or lower.normalize_str("AÉ") != "aé":
            return False
        if [piece for piece, _ in split.pre_tokenize_str("ab.,!")] != ["ab", ".,!"]:
            return False
        spelt = {c: split.pre_tokenize_str(chr(c)) for c in range(LATIN) if chr(c).isalpha()}
        if any(len(pieces) != 1 for pieces in spelt.values()):
            return False
        self.spelling = {c: pieces[0][0] for c, pieces in spelt.items()}
        probe = [b"Ab.,", "École!!".encode(), "ßüß%%%".encode(), b"the", "ÇÀ".encode()]
        whole = self.encode(probe, 0)[0].tolist()
        self.in_parts = True
        self._forget()
        return self.encode(probe, 0)[0].tolist() == whole

    def _forget(self) -> None:
        self.names = np.zeros(0, dtype=np.uint64)  # of all words that are kept, ascending
        self.numbers = np.zeros(0, dtype=np.int64)
        self.letters: dict[str, int] = {}  # parts that go to the model alone
        self.others: dict[bytes, int] = {b"": 0}  # parts that go to the whole tokenizer
        self.words, self.letter_ids, self.other_ids = _Pieces(), _Pieces(), _Pieces()
        none = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.other_ids.add(np.zeros(1, np.int64), *none)

    def _parted(self, word: bytes) -> tuple[str, bytes]:
        """A word's letters as the model spells them, and the rest, which may be all."""
        core = word.rstrip(TAIL)
        letters = core.decode()
        if letters.isalpha() and max(letters) < LAST and not ODD.intersection(letters):
            return letters.lower().translate(self.spelling), word[len(core) :]
        return "", word

    def _learn(self, words: list[bytes]) -> None:
        """Have the library encode the parts of the words, which are new."""
        if self.in_parts:
            cores = [word.rstrip(TAIL) for word in words]
            first = [core.decode() if core.isalpha() else None for core in cores]  # ASCII alone
            second = [word[len(core) :] for word, core in zip(words, cores)]
            for n in [n for n, core in enumerate(first) if core is None]:
                first[n], second[n] = self._parted(words[n])
            self._encode_parts(self.model, self.letters, self.letter_ids, first)
            one = _numbers(self.letters, first)
        else:
            second, one = words, None
        self._encode_parts(self.library, self.others, self.other_ids, second)
        two = _numbers(self.others, second)
        count = self.other_ids.count[two]
        if one is not None:
            count = count + self.letter_ids.count[one]
        at = np.cumsum(count) - count
        ids = np.zeros(int(count.sum()), dtype=np.uint32)
        if one is not None:
            self.letter_ids.join(one, ids, at)
            at = at + self.letter_ids.count[one]
        self.other_ids.join(two, ids, at)
        total = len(self.names)
        self.words.add(np.arange(total, total + len(words)), ids, count)

    def _encode_parts(self, tokenizer, index: dict, pieces: _Pieces, parts: list) -> None:
        known = len(index)
        new = _number(index, parts)
        if new:
            texts = [part if type(part) is str else part.decode() for part in new]
            found = tokenizer.encode(texts, is_pretokenized=True, add_special_tokens=False)
            of = np.array(found.word_ids, dtype=np.int64)
            count = np.bincount(of, minlength=len(new))
            pieces.add(np.arange(known, len(index)), np.array(found.ids, dtype=np.uint32), count)

    def _known(self, joined: bytes, names, low, high) -> np.ndarray:
        """The numbers of all words; those that are new are learned."""
        kinds, where, again = np.unique(names, return_index=True, return_inverse=True)
        at = np.searchsorted(self.names, kinds)
        new = np.ones(len(kinds), dtype=bool)
        inside = at < len(self.names)
        new[inside] = self.names[at[inside]] != kinds[inside]
        numbers = np.empty(len(kinds), dtype=np.int64)
        numbers[~new] = self.numbers[at[~new]]
        if new.any():
            bounds = zip(low[where[new]].tolist(), high[where[new]].tolist())
            self._learn([joined[a:b] for a, b in bounds])
            numbers[new] = len(self.names) + np.arange(int(new.sum()))
            self.numbers = np.insert(self.numbers, at[new], numbers[new])
            self.names = np.insert(self.names, at[new], kinds[new])
        return numbers[again]

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (UTF-8) in one array, each text's followed by ``end``, and the
        bounds of the texts in it, one more than there are texts."""
        if len(self.names) > WORDS_KEPT:
            self._forget()
        joined = b"\n".join([*texts, b""])
        if self.in_parts:  # a tokenizer that lowers letters may as well get them so
            joined = joined.lower()
        names, low, high = spelled(joined)
        until = np.cumsum([len(text) + 1 for text in texts])
        sizes = np.diff(np.searchsorted(low, until), prepend=0)  # words of each text
        numbers = self._known(joined, names, low, high)
        ends = np.concatenate(([0], np.cumsum(self.words.count[numbers])))
        text_ends = ends[np.cumsum(sizes)]
        bounds = np.concatenate(([0], text_ends + np.arange(1, len(sizes) + 1)))
        out = np.full(int(bounds[-1]), end, dtype=np.uint32)
        shift = np.repeat(np.arange(len(sizes)), sizes)  # end ids before the word
        self.words.join(numbers, out, ends[:-1] + shift)
        return out, bounds


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    grown = np.zeros(max(size, 2 * len(array)), dtype=array.dtype)
    grown[: len(array)] = array
    return grown
