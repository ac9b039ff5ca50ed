"""Byte-level BPE ids by the tokenizers library, with chunks of text remembered per worker.

The byte-level splitter looks neither back nor across a space that follows a visible character, so a text may be
cut before every such space and the parts encoded alone; the ids put together are those of the whole text. Most
parts are words that came before, so the library is asked once for each.
"""

from __future__ import annotations

import re
import struct

import numpy as np

# Parts remembered per worker, about 180 bytes each. Later parts are encoded every time they come.
REMEMBERED = 1_000_000

# A space after white space: the splitter treats it differently, so no cut there.
_SPACED = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")
# The byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for those from U+0100 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ALPHABET = {b: b for b in _VISIBLE} | {b: 0x100 + n for n, b in enumerate(sorted(set(range(256)) - set(_VISIBLE)))}


def _is_word(text: str) -> bool:
    """Latin letters only, on which all Unicode versions agree: the splitter makes one token of them."""
    return text.isalpha() and (text.isascii() or max(text) < "\u0250")


class _Parts(dict):
    """Ids of a part, with what stands before it (``lead``); asks the library for parts that are new."""

    def __init__(self, tokenizer, lead: str):
        self.tokenizer, self.lead, self.line = tokenizer, lead, self
        self.model = tokenizer.model
        self.marks = {c: self.ask(c) for c in (".", ",", "\n")}

    def ask(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ask_word(self, word: str) -> bytes:
        """One token of the splitter goes straight to the merge model."""
        plain = (self.lead + word).encode().decode("latin-1").translate(_ALPHABET)
        ids = [token.id for token in self.model.tokenize(plain)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, part: str) -> bytes:
        if _is_word(part):
            found = self.ask_word(part)
        elif part[-1:] in (".", ",") and _is_word(part[:-1]):
            word = part[:-1]
            known = word in self
            found = self[word] + self.marks[part[-1]]
            if not known:
                return found  # perhaps a word that never comes again
        else:
            before, line_end, after = part.partition("\n")
            # One line end between visible characters is a token of its own.
            if line_end and before and after and not before[-1].isspace() and not after[0].isspace():
                return self[before] + self.marks["\n"] + self.line[after]
            found = self.ask(self.lead + part)
        if len(self) < REMEMBERED:
            self[part] = found
        return found


_workers: dict[int, "tuple[_Parts, _Parts]"] = {}


class BpeEncoder:
    """A tokenizer file's text as encoder; travels to the executors as that text.

    With ``marks_as_text`` strings of special tokens in a text are ordinary text, so a document cannot forge an end
    mark. Without it they are the added tokens' ids, as in the library's default.
    """

    def __init__(self, definition: str, marks_as_text: bool = True):
        self.definition, self.marks_as_text = definition, marks_as_text

    @classmethod
    def load(cls, path: str, marks_as_text: bool = True) -> "BpeEncoder":
        with open(path, encoding="utf-8") as file:
            return cls(file.read(), marks_as_text)

    def _parts(self) -> tuple[_Parts, _Parts]:
        key = hash((self.definition, self.marks_as_text))
        if key not in _workers:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(self.definition)
            tokenizer.encode_special_tokens = self.marks_as_text
            first, rest = _Parts(tokenizer, ""), _Parts(tokenizer, " ")
            rest.line = first
            first.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()
                           if not (self.marks_as_text and t.special)]
            _workers[key] = first, rest
        return _workers[key]

    def vocabulary(self) -> int:
        return self._parts()[0].tokenizer.get_vocab_size(with_added_tokens=True)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        first, rest = self._parts()
        if any(mark in text for mark in first.added):
            return first.ask(text)  # an added token may take spaces with it or hold some, so the whole text at once
        parts = _CUT.split(text) if _SPACED.search(text) else text.split(" ")
        return first[parts[0]] + b"".join(map(rest.__getitem__, parts[1:]))
