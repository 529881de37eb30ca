"""Token ids of whole texts by a public tokenizer, with a memory for words.

Both tokenizers split a text into pieces before they merge bytes, and no piece holds a character other
than white space followed by white space. So a text may be cut before every space that follows another
character, and the cuts' ids, joined, are the text's ids. Words recur, and their ids are remembered up
to a bound per Python worker: a full memory becomes the old one, of which words in use are taken over.
"""

from __future__ import annotations

import re
from array import array
from functools import cache
from unicodedata import is_normalized

import public_tokenizers
from tokenizers import Tokenizer

#: Words in the memory of one Python worker, about 250 bytes each; as many are in the old memory.
REMEMBERED = 600_000
#: Characters that make a piece of their own behind a letter, without those of special tokens and the apostrophe.
ENDS = ".,!?;:#$%&*"
# From the space on, which is found faster than any white space.
_SPACE_AFTER_SPACE = re.compile(r" (?<=\s\s)")
_CUT = re.compile(r"(?<=\S)(?= )")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level models read for each byte: itself where it prints, else one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


class _Words(dict):
    """Word -> ids of the word after ``before``, as little-endian 32-bit integers."""

    def __init__(self, tokenizer: Tokenizer, before: str, folds_case: bool) -> None:
        self.tokenizer, self.model, self.before, self.folds_case = tokenizer, tokenizer.model, before, folds_case
        self.old: dict[str, bytes] = {}
        self.letter_before = "" if folds_case else before.translate({ord(" "): _LETTERS[ord(" ")]})
        self.newline = self.ids("\n")
        self.starts: _Words = self

    def ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids_of_letters(self, word: str) -> bytes:
        """As ``ids``, for a word of Latin letters: it is one piece, so the model can be asked directly."""
        text = word.lower() if self.folds_case else self.before + word
        return self.ids_of_piece(text.encode().decode("latin-1").translate(_LETTERS))

    def ids_of_piece(self, letters: str) -> bytes:
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        if "\n" in word:
            first, *rest = lines = word.split("\n")
            if word.split() == lines:  # single line ends between words, no other white space
                return self[first] + b"".join(self.newline + self.starts[w] for w in rest)
            return self.ids(self.before + word)
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        if (found := self.old.get(word)) is not None:
            pass
        elif (body := word.rstrip(ENDS)) != word and body[-1:].lower().isalpha():
            found = self[body] + self.starts[word[len(body) :]]
        elif self.folds_case and word.isascii() and "<|" not in word and (lower := word.lower()) != word:
            found = self[lower]
        elif word.isascii() and word.isalpha():
            found = self.ids_of_piece(self.letter_before + word)
        elif word.isalpha() and max(word) < "\u0250" and word.lower().isalpha() and is_normalized("NFC", word):
            found = self.ids_of_letters(word)
        else:
            found = self.ids(self.before + word)
        self[word] = found
        return found


class Encoder:
    """``encode`` gives a text's ids as bytes, four for each id, little-endian."""

    def __init__(self, name: str) -> None:
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        folds_case = tokenizer.normalizer is not None
        self.first = _Words(tokenizer, "", folds_case)
        self.rest = _Words(tokenizer, " ", folds_case)
        self.rest.starts = self.first

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if _SPACE_AFTER_SPACE.search(text):
            first, *rest = _CUT.split(text)
            rest = [piece[1:] for piece in rest]
        else:
            first, *rest = text.split(" ")
        head = self.first[first] if first else b""
        return head + b"".join(map(self.rest.__getitem__, rest))


@cache
def encoder(name: str) -> Encoder:
    """The tokenizer of this name, loaded once in a Python worker."""
    return Encoder(name)
