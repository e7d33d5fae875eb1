"""Token ids of whole texts by the tokenizers library, inside Arrow batches.

Most of a corpus is the same few words over and over, so a worker remembers the ids of words, alone and behind a
space. A cut before a single space, around a single line break or between a letter and a comma or full stop, each
between two characters that are no white space, never lies inside a pre-token of a byte-level BPE whose pre-tokens
start with at most one space; so the words' ids, joined, are the ids of the whole text. A text with any other white
space is encoded as a whole, and so is one that holds a token which the tokenizer's file adds to the vocabulary
(``<|endoftext|>``): the library gives it its own id, as in a plain call. A word of letters alone is one pre-token, so
the library's BPE model takes it directly.
"""

from __future__ import annotations

from array import array
from sys import byteorder

#: Words in a generation, about 200 bytes each; a worker remembers two, and what it meets again moves to the newer one.
GENERATION = 350_000
_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class _Letters(dict):
    """Character -> how the tokenizer's byte-level alphabet writes it."""

    def __init__(self, alphabet) -> None:
        self.alphabet = alphabet

    def __missing__(self, code: int) -> str:
        found = self[code] = "".join(x for x, _ in self.alphabet.pre_tokenize_str(chr(code)))
        return found


class _NotPlain(Exception):
    """White space where the cut would not be safe."""


class Encoder:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, generation: int):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.alone, self.spaced = _Words(self, "", generation), _Words(self, " ", generation)
        self.line_break = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(x in text for x in self.added):
            return self.whole(text)
        try:
            return self.line_break.join([self._line(x) for x in text.split("\n")])
        except _NotPlain:
            return self.whole(text)

    def _line(self, line: str) -> bytes:
        first, *others = line.split(" ")
        return self.alone[first] + b"".join(map(self.spaced.__getitem__, others))


class _Words(dict):
    """word -> its ids behind ``before``."""

    def __init__(self, encoder: Encoder, before: str, generation: int):
        self.encoder, self.before, self.generation = encoder, before, generation
        self.model, self.letters = encoder.tokenizer.model, _Letters(encoder.tokenizer.pre_tokenizer)
        self.start = before.translate(self.letters)
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            if word.isalpha():  # one pre-token
                letters = word if word.isascii() else word.translate(self.letters)
                found = _packed([x.id for x in self.model.tokenize(self.start + letters)])
            elif word[-1:] in ",." and word[-2:-1].isalpha():
                found = self[word[:-1]] + self.encoder.alone[word[-1]]
            elif word.split() != [word]:
                raise _NotPlain
            else:
                found = self.encoder.whole(self.before + word)
        if len(self) >= self.generation:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


def encoder(path: str, generation: int = GENERATION) -> Encoder:
    """The worker's encoder for the tokenizer file at ``path``; ``generation`` bounds the words it remembers."""
    key = (path, generation)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, generation)
    return _ENCODERS[key]
