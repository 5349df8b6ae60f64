"""Word-cached encoding with a public BPE tokenizer."""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


#: A word of Latin letters with ASCII punctuation after it: two parts at most, whatever stands around it. Their lower
#: case is one letter for one, and they are composed already.
PLAIN = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[!-/:-@\[-`{-~]*$"
LOWER = re.compile("[a-zß-öø-ÿ]+")
LETTERS = "".join(c for c in map(chr, range(256)) if LOWER.fullmatch(c))
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after the other."""
    upto = np.cumsum(size)
    return flat[np.repeat(start - upto + size, size) + np.arange(size.sum())]


class _Parts:
    """Distinct parts with their ids, as arrays."""

    def __init__(self, parts: pa.Array, flat: np.ndarray, size: np.ndarray):
        self.parts, self.flat, self.size = parts, flat, size
        self.start = np.cumsum(size) - size

    def __len__(self) -> int:
        return len(self.parts)

    def places(self, parts: pa.Array) -> np.ndarray:
        """Where the parts are, -1 for those that are not."""
        return pc.index_in(parts, value_set=self.parts).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def take(self, at: np.ndarray) -> _Parts:
        return _Parts(self.parts.take(pa.array(at)), _gather(self.flat, self.start[at], self.size[at]), self.size[at])

    def plus(self, other: _Parts) -> _Parts:
        return _Parts(pa.concat_arrays([self.parts, other.parts]), np.append(self.flat, other.flat), np.append(self.size, other.size))


class _Known(_Parts):
    """The parts met so far; one not met yet passes the tokenizer.

    Two generations of at most ``most`` parts: a full one becomes the older one, and what is asked for again
    comes back from there, so that frequent parts are kept however many rare ones pass. Those longer than
    ``longest`` are not kept."""

    def __init__(self, make, most: int, longest: int, dtype):
        super().__init__(pa.array([], pa.large_string()), np.zeros(0, dtype), np.zeros(0, np.int64))
        self.make, self.most, self.longest = make, most, longest
        self.older = _Parts(self.parts, self.flat, self.size)

    def _made(self, parts: pa.Array) -> _Parts:
        ids = list(map(self.make, parts.to_pylist()))
        return _Parts(parts, np.fromiter(chain.from_iterable(ids), self.flat.dtype), np.fromiter(map(len, ids), np.int64, len(ids)))

    def find(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each of the distinct ``parts`` start and how many they are."""
        at = self.places(parts)
        lost = np.flatnonzero(at < 0)
        before = self.older.places(parts.take(pa.array(lost)))
        back, new = lost[before >= 0], lost[before < 0]
        more = self.older.take(before[before >= 0]).plus(self._made(parts.take(pa.array(new))))
        at[np.append(back, new)] = len(self) + np.arange(len(more))
        both = self.plus(more)
        short = np.flatnonzero(pc.utf8_length(more.parts).to_numpy() <= self.longest)
        kept = more if len(short) == len(more) else more.take(short)
        if len(self) + len(kept) > self.most:
            self.older = _Parts(self.parts, self.flat, self.size)
            kept = kept.take(np.arange(min(len(kept), self.most)))
        else:
            kept = both if kept is more else self.plus(kept)
        self.parts, self.flat, self.size, self.start = kept.parts, kept.flat, kept.size, kept.start
        return both.flat, both.start[at], both.size[at]


class WordEncoder:
    """Encodes texts exactly as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    The tokenizer lower-cases, drops white space, splits words into runs of letters, single digits and runs of other
    characters, and merges within those alone; so a text's ids are the concatenation of its parts' ids. Each distinct
    part passes the tokenizer library once while it is known; what is known is bounded.
    """

    def __init__(self, path: str, max_words: int = 500_000, longest: int = 64):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.vocab = self.tok.get_vocab_size()
        self.dtype = np.uint16 if self.vocab <= 1 << 16 else np.uint32
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.spelled = {ord(c): self._spelled(c) for c in LETTERS if not c.isascii()}
        self.words = _Known(self._word, max_words, longest, self.dtype)

    def _spelled(self, text: str) -> str:
        """The pre-tokenizer spells bytes as the vocabulary does."""
        return "".join(p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(text))

    def _model(self, part: str) -> list[int]:
        return [t.id for t in self.model.tokenize(part)]

    def _word(self, word: str) -> list[int]:
        """The ids of a run of lower-case Latin letters, or of any other word."""
        if LOWER.fullmatch(word):
            return self._model(word if word.isascii() else word.translate(self.spelled))
        if any(s in word for s in self.special):
            return self.tok.encode(word, add_special_tokens=False).ids
        return [i for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(word)) for i in self._model(p)]

    def encode(self, text: str) -> bytes:
        """Little-endian ids of ``dtype``."""
        return b"".join(ids.tobytes() for ids in self.encode_all([text]))

    def encode_all(self, texts: list[str] | pa.Array, most_bytes: int = 1 << 23):
        """The ids of each text (null: empty) as an array. Texts are split and their words numbered by Arrow, about
        ``most_bytes`` at a time; each distinct part of the words among them is looked up once and its ids are gathered."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        texts = texts.fill_null("")
        upto, at = np.cumsum(pc.binary_length(texts).to_numpy()), 0
        while at < len(texts):
            until = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most_bytes, "right")))
            yield from self._encode_some(texts.slice(at, until - at))
            at = until

    def _encode_some(self, texts: pa.Array):
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        numbered = split.flatten().dictionary_encode()
        words, which = numbered.dictionary, numbered.indices.to_numpy()
        # a plain word is the part of its letters and the one of the marks after them, any other is one part
        plain, lower = pc.match_substring_regex(words, PLAIN), pc.utf8_lower(words)
        first = pc.if_else(plain, pc.utf8_rtrim(lower, MARKS), words)
        second = pc.if_else(plain, pc.utf8_ltrim(lower, LETTERS), "")
        parts = pa.concat_arrays([first, second.cast(pa.large_string())]).dictionary_encode()
        flat, start, size = self.words.find(parts.dictionary)
        pairs = parts.indices.to_numpy().reshape(2, -1).T
        flat, size = _gather(flat, start[pairs].ravel(), size[pairs].ravel()), size[pairs].sum(1)
        ids = _gather(flat, (np.cumsum(size) - size)[which], size[which])
        border = np.append(0, np.cumsum(size[which]))[split.offsets.to_numpy()]
        yield from np.split(ids, border[1:-1])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
