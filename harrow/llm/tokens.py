"""Token ids of a public tokenizer, worked out once per word.

The tokenizer drops white space and never joins words, so a text's ids are those of its
words one after another.  Words of plain letters and marks are cut as the tokenizer's
own file says and only their parts are merged; everything else goes to the tokenizer.
"""

from __future__ import annotations

import re
from functools import cache

CACHED_WORDS = 300_000  # words a worker remembers

# How the tokenizer cuts a lower-cased word of ASCII or Latin-1 characters.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-Þß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokenizer:
    """Ids as little-endian 32-bit numbers, for texts given whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            shown = part if part.isascii() else (
                "".join(map(self.letters.__getitem__, part.encode("utf-8"))))
            found = b"".join([self.id_bytes[t.id] for t in self.merge(shown)])
            self.parts[part] = found
        return found

    def _word(self, word: str) -> bytes:
        if "<|" not in word and _PLAIN.fullmatch(word):
            return b"".join(map(self._part, _PARTS.findall(word.lower())))
        return b"".join([self.id_bytes[i] for i in
                         self.tokenizer.encode(word, add_special_tokens=False).ids])

    def encode(self, text: str) -> bytes:
        """The ids of the text, without special tokens added."""
        known = self.words
        if len(known) > CACHED_WORDS:
            self.words = known = {"": b""}
        if len(self.parts) > CACHED_WORDS:
            self.parts = {}
        words = text.replace("\n", " ").split(" ")
        for word in words:
            if word not in known:
                known[word] = self._word(word)
        return b"".join(map(known.__getitem__, words))


@cache
def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker and file."""
    return WordTokenizer(path)
