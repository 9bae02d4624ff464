"""Tokenising whole texts with a file of the ``tokenizers`` library, quickly and in bounded memory."""

from __future__ import annotations

import json
import os
import re
import string
from collections.abc import Iterator

import numpy as np

#: A single blank between two characters that are not white space always starts a new pre-token of
#: a byte-level BPE, so a text may be encoded word by word.
_BLANK = re.compile(r"(?<=\S) (?=\S)")
_LONGEST_CACHED = 64
_LATIN_END = "\u0250"
#: Up to this many ASCII marks behind letters are remembered; together they are one pre-token.
_LONGEST_MARKS = 3
#: Texts are learned from together up to so many characters.
_TOGETHER = 1 << 20


class _Unclean(Exception):
    """A word of the plain split begins or ends with white space: the blank there is no border."""


_encoders: dict[str, "Encoder"] = {}


def _byte_characters() -> dict[int, str]:
    """The character that a byte-level BPE writes for each byte: its own if it can be seen."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in seen]
    return {byte: chr(byte) for byte in seen} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


_BYTES = _byte_characters()


def _merges_only(path: str):
    """A tokenizer with the model of a byte-level BPE's file whose pre-tokens are lines of bytes, written as characters.

    It spares the regular expression, where it is known what that does, and the library's cache.  None
    if the file has rules beyond the merges.
    """
    from tokenizers import Tokenizer, models, pre_tokenizers

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, cut = described["model"], described["pre_tokenizer"] or {}
    more = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    if not plain or described["normalizer"] or model.get("type") != "BPE" or any(model.get(rule) for rule in more):
        return None
    merges = [tuple(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
    found = Tokenizer(models.BPE(model["vocab"], merges, cache_capacity=0))
    found.pre_tokenizer = pre_tokenizers.Split(_BYTES[ord("\n")], "isolated")
    return found


class Encoder:
    """Ids of texts, remembering the ids of words.

    The memory holds ``limit`` words at most; when it is full, only words seen in every eighth chunk of
    texts since the last time are kept.

    With ``special_tokens``, the ids are the library's own: a special token's content in a text gets the
    token's id.  Without, it is read like other text.
    """

    def __init__(self, path: str, limit: int = 800_000, special_tokens: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not special_tokens
        self.vocabulary_size = self._tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.vocabulary_size <= 1 << 16 else "<u4")
        # The library cuts texts at added tokens first, and each part then has pre-tokens of its own.
        added = self._tokenizer.get_added_tokens_decoder().items()
        added = [(token, i) for i, token in added if special_tokens or not token.special]
        self._added = {token.content: np.array([i], self.dtype).tobytes() for token, i in added}
        longest_first = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(longest_first) + ")")
        plain = not any(token.lstrip or token.rstrip or token.single_word for token, _ in added)
        self._cuttable = plain and self._tokenizer.normalizer is None
        self._limit = limit
        self._words: dict[str, bytes] = {}

        self._firsts: dict[str, bytes] = {}
        self._marks = {"\n": self._ids("\n")}
        self._merges = _merges_only(path)
        self._seen: set[str] = set()
        self._chunks = 0

    def _ids(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _lines(self, words: list[str], before: str, letters: bool = False) -> list[bytes]:
        """Ids of words without line ends: encoded as lines of one text, cut at the ids of the line ends.

        Words of letters are pre-tokens as they are, with the blank before them.
        """
        if not words:
            return []
        together = "\n" + "\n".join([before + word for word in words]) + "\n"
        tokenizer = self._tokenizer
        if letters and self._merges:
            tokenizer, together = self._merges, together.encode().decode("latin-1").translate(_BYTES)
        ids = tokenizer.encode_batch_fast([together], add_special_tokens=False)[0].ids
        ids = np.array(ids, self.dtype)
        cuts = np.flatnonzero(ids == np.frombuffer(self._marks["\n"], self.dtype)[0]) * self.dtype.itemsize
        coded, skip, cuts = ids.tobytes(), self.dtype.itemsize, cuts.tolist()
        return [coded[a + skip : b] for a, b in zip(cuts, cuts[1:])]

    def _remember(self, known: dict[str, bytes], words: set[str], before: str) -> None:
        """Add words to ``known``; letters, and the marks after them, are pre-tokens of their own."""
        letters, others = set(), []
        # Side by side, as a tuple for each word would keep the garbage collector busy.
        marked, heads, marks = [], [], []
        for word in words:
            if len(word) > _LONGEST_CACHED:
                continue
            head = word.rstrip(string.punctuation)
            n = len(word) - len(head)
            if n <= _LONGEST_MARKS and head.isalpha() and (head.isascii() or max(head) < _LATIN_END):
                letters.add(head)
                if n:
                    marked.append(word)
                    heads.append(head)
                    marks.append(word[-n:])
            else:
                others.append(word)
        letters = list(letters.difference(known))
        known.update(zip(letters, self._lines(letters, before, letters=True)))
        known.update(zip(others, self._lines(others, before)))
        self._marks.update([(new, self._ids(new)) for new in set(marks).difference(self._marks)])
        ids = map(bytes.__add__, map(known.__getitem__, heads), map(self._marks.__getitem__, marks))
        known.update(zip(marked, ids))

    def _learn(self, words: set[str], bordered: bool) -> None:
        """Remember words that follow a blank."""
        spaced = words.intersection(" ".join(words).split())  # those without white space
        firsts, broken = set(), []
        for word in words - spaced:
            if not word or word[0].isspace() or word[-1].isspace():
                if bordered:  # the end of the text
                    continue
                raise _Unclean
            if len(word) > _LONGEST_CACHED:
                continue
            if "\n" not in word:
                spaced.add(word)
                continue
            head, _, rest = word.partition("\n")
            if "\n" in rest or rest[0].isspace() or head[-1].isspace():
                self._words[word] = self._ids(" " + word)
            else:  # a single line end is a pre-token of its own
                broken.append((word, head, rest))
                spaced.add(head)
                firsts.add(rest)
        self._remember(self._words, spaced.difference(self._words), " ")
        self._remember(self._firsts, firsts.difference(self._firsts), "")
        end = self._marks["\n"]
        self._words.update([(word, self._words[head] + end + self._firsts[rest]) for word, head, rest in broken])

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of one text; a missing text is taken as empty."""
        return self._coded([text or ""])[0]

    def encode_many(self, texts: list[str | None], together: int = 64) -> Iterator[np.ndarray]:
        """The ids of each text; new words of ``together`` texts at most are learned at once."""
        held, characters = [], 0
        for text in texts:
            held.append(text or "")
            characters += len(held[-1])
            if len(held) == together or characters > _TOGETHER:
                yield from self._coded(held)
                held, characters = [], 0
        yield from self._coded(held)

    def _halves(self, texts: list[str]) -> list[np.ndarray]:
        return self._coded(texts[: len(texts) // 2]) + self._coded(texts[len(texts) // 2 :])

    def _coded(self, texts: list[str]) -> list[np.ndarray]:
        if any(content in text for content in self._added for text in texts):
            if len(texts) > 1:
                return self._halves(texts)
            return [np.frombuffer(self._with_added(texts[0]), self.dtype)]
        try:
            coded = self._joined([text.split(" ") for text in texts])
        except _Unclean:
            if len(texts) > 1:
                return self._halves(texts)
            coded = self._joined([_BLANK.split(texts[0])], bordered=True)
        return [np.frombuffer(one, self.dtype) for one in coded]

    def _with_added(self, text: str) -> bytes:
        """Ids of a text that holds added tokens."""
        if not self._cuttable:
            return self._ids(text)
        parts = self._cut.split(text)
        coded = iter(self._coded([part for part in parts[::2] if part]))
        return b"".join(
            self._added[part] if i % 2 else next(coded).tobytes() if part else b"" for i, part in enumerate(parts)
        )

    def _first(self, word: str) -> bytes:
        return self._firsts[word] if word in self._firsts else self._ids(word)

    def _joined(self, texts: list[list[str]], bordered: bool = False) -> list[bytes]:
        firsts = [parts[0] for parts in texts]
        rests = [parts[1:] for parts in texts]
        if any(rest and (not first or first[-1].isspace()) for first, rest in zip(firsts, rests)):
            raise _Unclean
        words, distinct = self._words, set().union(*rests)
        missing = distinct.difference(words)
        self._chunks += 1
        if self._chunks % 8 == 0:
            self._seen |= distinct
        if len(words) + len(missing) > self._limit or len(self._firsts) > self._limit:
            frequent = self._seen if 2 * len(self._seen) < self._limit else set()
            kept = {word: words[word] for word in frequent if word in words}
            words.clear()
            words.update(kept)
            self._firsts.clear()
            self._seen = set()
            missing = distinct.difference(words)
        if missing:
            self._learn(missing, bordered)
        short = {w for w in firsts if w and len(w) <= _LONGEST_CACHED and not any(map(str.isspace, w))}
        self._remember(self._firsts, short.difference(self._firsts), "")
        try:
            return [self._first(first) + b"".join(map(words.__getitem__, rest)) for first, rest in zip(firsts, rests)]
        except KeyError:  # words that are not remembered
            return [
                self._first(first) + b"".join([words[w] if w in words else self._ids(" " + w) for w in rest])
                for first, rest in zip(firsts, rests)
            ]


def encoder(path: str) -> Encoder:
    """The encoder of this process for a tokenizer file; it must be on every executor."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, special_tokens=True)
    return _encoders[path]
