"""Public tokenizers inside tasks, with a bounded cache of the words seen."""

from __future__ import annotations

import base64
import functools
import importlib
import re

import numpy as np

# Fixed value: the string of the byte-level vocabulary's one special token.
END_OF_TEXT = "<|endoftext|>"

# A space between two characters that are not white space: the byte-level
# tokenizer always starts a new word there, with the space as its first byte.
_BREAK = re.compile(r"(?<=\S) (?=\S)")
_LOOSE = re.compile(r" \s|\s |^ | $")


def vocabulary_path(name: str) -> str:
    """Where a public tokenizer file lies on this machine."""
    return importlib.import_module("public_tokenizers").path(name)


class WordCache(dict):
    """word -> value, computed when first asked for; emptied when `limit` words are in it."""

    def __init__(self, compute, limit: int = 400_000, longest: int = 64) -> None:
        super().__init__()
        self.compute, self.limit, self.longest = compute, limit, longest

    def __missing__(self, word):
        value = self.compute(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value


class ByteLevelIds:
    """Ids of a text under the byte-level vocabulary, as little-endian 32-bit bytes.

    Equal to the `tokenizers` library on the .json file without added special
    tokens (its special string inside a text becomes the special id). Words are
    encoded by `tiktoken` from the same vocabulary, which is faster; a word
    that holds the special string is left to `tokenizers`.
    """

    def __init__(self, json_name: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken"):
        import tiktoken

        with open(vocabulary_path(ranks), "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pattern = importlib.import_module("public_tokenizers").PATTERN
        self.fast = tiktoken.Encoding(
            "byte-level", pat_str=pattern, mergeable_ranks=merges, special_tokens={}
        )
        self.json_name, self.exact = json_name, None
        self.first, self.rest = WordCache(self._ids), WordCache(lambda word: self._ids(" " + word))

    def _ids(self, text: str) -> bytes:
        if END_OF_TEXT in text:
            if self.exact is None:
                from tokenizers import Tokenizer

                self.exact = Tokenizer.from_file(vocabulary_path(self.json_name))
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        words = text.split(" ") if _LOOSE.search(text) is None else _BREAK.split(text)
        if not text:
            return b""
        return self.first[words[0]] + b"".join(map(self.rest.__getitem__, words[1:]))


@functools.cache
def byte_level_ids() -> ByteLevelIds:
    """One encoder for all tasks of a worker: the words that one has met serve the next."""
    return ByteLevelIds()
