"""Token ids of a byte-level tokenizer file, by the quickest library that gives the same.

A file whose ids rise in the order of its merges holds the same vocabulary as a table of
ranks, which one of the libraries works through several times as fast.  Whether that holds is
read from the file; where it does not, and for texts with characters on whose class the
libraries might not agree or with the text of an added token, the file's own library encodes.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cache

# Fixed value: how byte-level tokenizers cut a text before merging.
_CUTS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# ASCII, Latin letters and common punctuation: classes that no version of Unicode changed.
_SETTLED = re.compile("[\t\n\r -~¡-ɏ‐-…€]*")


def byte_letters() -> dict[str, int]:
    """The byte for which each printable stand-in of byte-level vocabularies stands."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ranks_of(spec: dict) -> dict[bytes, int] | None:
    """The file's vocabulary as ranks, or nothing where these would not tell the same."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model["type"] == "BPE" and not spec.get("normalizer")
             and not any(model.get(k) for k in ("dropout", "unk_token", "fuse_unk", "byte_fallback",
                                                "ignore_merges", "continuing_subword_prefix",
                                                "end_of_word_suffix"))
             and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
             and not cut.get("add_prefix_space", True) and not spec.get("post_processor"))
    if not plain:
        return None
    letters, vocabulary = byte_letters(), model["vocab"]
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [vocabulary[m] for m in merged]
    added = {t["content"] for t in spec.get("added_tokens", [])}
    if ids != sorted(set(ids)) or set(vocabulary) - added != {*letters, *merged}:
        return None
    return {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items() if t not in added}


class ByteTokenizer:
    """Ids as little-endian 32-bit numbers, for texts given whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        ranks, self.quick = ranks_of(spec), None
        if ranks is not None:
            import tiktoken

            self.quick = tiktoken.Encoding("from-file", pat_str=_CUTS, mergeable_ranks=ranks,
                                           special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        """The ids of the text, without special tokens added."""
        if self.quick and _SETTLED.fullmatch(text) and not any(a in text for a in self.added):
            return array("I", self.quick(text)).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@cache
def byte_tokenizer(path: str) -> ByteTokenizer:
    """One tokenizer per worker and file."""
    return ByteTokenizer(path)
