"""Encoding single pre-tokens with the library's model, so that each is encoded once for each worker."""

from __future__ import annotations

from array import array

import regex

from .common import CACHE_KEY

#: Characters whose classes and case no Unicode version has changed; parts with others go to the library whole.
SAFE = regex.compile(r"[\t\n\r\x20-\x7e\xa0-įı-ɏ]*+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones are their own, the others follow from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}


LETTERS = byte_letters()


class PreTokens:
    """Encodes texts that the library's pre-tokenizer would see alone.

    pattern: the pre-tokenizer's; lower: whether the normaliser lower-cases (and composes, which SAFE text is already).
    code: array type code of the ids that ``ids`` packs; empty if only lengths are wanted.
    """

    def __init__(self, path: str, pattern: str, lower: bool, entries: int, code: str = ""):
        from tokenizers import Tokenizer

        self.whole, self.lower, self.entries, self.code = Tokenizer.from_file(path), lower, entries, code
        self.tokenize, self.find = self.whole.model.tokenize, regex.compile(pattern).findall
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        #: Packed bytes or ints, which the garbage collector need not visit.
        self.known: dict = {}

    def keep(self, ids: list[int]) -> bytes | int:
        return array(self.code, ids).tobytes() if self.code else len(ids)

    def one(self, token: str) -> bytes | int:
        """A single pre-token's ids or length."""
        if (out := self.known.get(token)) is None:
            if len(self.known) >= self.entries:
                self.known.clear()
            letters = token.replace(" ", "Ġ") if token.isascii() and token.isprintable() else token.encode().decode("latin-1").translate(LETTERS)
            out = self.keep([t.id for t in self.tokenize(letters)])
            if len(token) <= CACHE_KEY:
                self.known[token] = out
        return out

    def split(self, part: str) -> list[str] | None:
        """Its pre-tokens; None if the library has to see it whole."""
        if part.isascii() and part.lstrip(" ").isalpha() and part.count(" ") < 2:
            return [part.lower() if self.lower else part]
        if SAFE.fullmatch(part) is None or any(s in part for s in self.special):
            return None
        return self.find(part.lower() if self.lower else part)

    def all(self, part: str) -> list:
        """What ``one`` gives for each pre-token of the part."""
        if part.isascii() and (part[-1:] == "." or part[-1:] == ",") and part[:-1].isalpha():
            return [self.one(part[:-1].lower() if self.lower else part[:-1]), self.one(part[-1])]
        if (tokens := self.split(part)) is None:
            return [self.keep(self.whole.encode(part, add_special_tokens=False).ids)]
        return list(map(self.one, tokens))
