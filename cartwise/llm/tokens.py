"""Token ids of a public BPE tokenizer, cached by chunk.

White space never joins two tokens, so a text's ids are the ids of its
white-space chunks one after the other. A bounded cache keeps the ids of chunks
seen; a chunk of plain Latin letters, digits and signs that is not in it is
cut into the tokenizer's own words, whose ids come from a second bounded cache
or from the tokenizer's merge model. Every other chunk, and every text with
rarer white space, goes through the tokenizer whole, so ids always equal those
of ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import json
import os
from array import array

import regex

#: White space that only one of Python's split and the tokenizer parts at.
ODD_SPACE = [*map(chr, [0x1c, 0x1d, 0x1e, 0x1f, 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b),
                         0x2028, 0x2029, 0x202f, 0x205f, 0x3000])]
#: Entries a cache holds before it starts anew.
CHUNKS, WORDS = 400_000, 400_000
LONGEST = 64

_LOADED: dict[str, WordIds] = {}


def byte_symbols() -> dict[int, str]:
    """Byte-level BPE's printable stand-in of each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Cache(dict):
    def __init__(self, make, size):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= self.size:
                self.clear()
            self[key] = value
        return value


class WordIds:
    """Ids as little-endian unsigned 32-bit bytes, for the tokenizer file ``path``
    (lower-casing BPE with word ends, white space dropped)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            text = f.read()
        pattern = json.loads(text)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.tokenizer = Tokenizer.from_str(text)
        self.model = self.tokenizer.model
        self.split = regex.compile(pattern).findall
        self.plain = regex.compile("[!-~\\u00a1-\\u012f\\u0131-\\u017f]+").fullmatch
        self.symbols = byte_symbols()
        self.words = _Cache(self._word, WORDS)
        self.chunks = _Cache(self._chunk, CHUNKS)

    def _word(self, word: str) -> bytes:
        mapped = word.encode().decode("latin-1").translate(self.symbols)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if "<|" in chunk or not self.plain(chunk):
            return self._whole(chunk)
        low = chunk.lower()
        if low.isalpha():
            return self.words[low]
        words = self.words
        return b"".join([words[w] for w in self.split(low)])

    def __call__(self, text: str) -> bytes:
        if any(c in text for c in ODD_SPACE):
            return self._whole(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))


def word_ids(path: str) -> WordIds:
    """The process's tokenizer for ``path``: tasks of one worker share its caches."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
