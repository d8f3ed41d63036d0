"""Token counts by a deterministic transducer compiled from the tokenizer's merges.

The tokenizer lower-cases, drops white space, cuts words into pieces (runs of
letters, single digits, runs of anything else) and merges the symbols of a piece,
its bytes, in the order of its merge table. The transducer reads the symbols of
a piece from left to right. For each beginning of a piece exactly one token can
be the last: one that ends there and is compatible with the last token of what
comes before it, where two tokens are compatible if no merge, in the order of
the table, would have joined symbols across their border. So all that matters
of the symbols read is, for each place where a token that is still open may have
begun, how far it is in the tree of tokens, which token comes before it, and how
many tokens these are. That is a state; it is finite, and states are numbered as
they are met. A transition holds the next state and the tokens that it adds.

States and transitions are compiled from the merges when first needed, and all
are dropped once there are `_STATES`; counts of whole words are kept as well, in
a bounded table. At a blank the transducer is in its first state whatever came
before. So a text is read in chunks that end at blanks, each of which maps the
first state to itself and adds a number: the maps compose by a sum, in any order.
A word without an end is read on, in bounded memory.

Words of other scripts than Latin, and those with control characters or the
tokenizer's special strings, are left to its library: what counts as a letter or
as white space there is the library's version of Unicode.

A whole text lies in one row and so in one task; nothing is shuffled.

Defined results: a null text counts as empty, 0 bytes and 0 tokens; repeated
rows are counted each; an empty table gives no rows; columns named like a
result are replaced, others kept.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinestar.llm.vocabularies import WordCache, vocabulary_path

CHUNK = 1 << 16
_STATES = 400_000

# Words that the transducer reads: ASCII and Latin letters, signs, and nothing that is white space.
_PLAIN = regex.compile(r"[!-~¡-¬®-ɏ]+")
# Fixed value: how the tokenizer cuts a word, in its order of preference.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Merges:
    """The merge table: tokens by number, in the order of their merges, and which may be neighbours."""

    def __init__(self, json_name: str) -> None:
        with open(vocabulary_path(json_name), encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.number: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {pair: k for k, pair in enumerate(pairs)}
        # Each token is made by one merge: its two parts. Symbols have no parts.
        self.parts = {"".join(pair): pair for pair in pairs}
        self.known: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}

    def symbols(self, token: str) -> list[str]:
        """The symbols of a token; the last one may bear the mark of a word's end."""
        if token.endswith(self.end) and len(token) > len(self.end):
            letters = token[: -len(self.end)]
            return [*letters[:-1], letters[-1] + self.end]
        return list(token)

    def is_whole(self, token: str) -> bool:
        """Do the merges make this token of its own symbols? Only then can it occur."""
        if token not in self.whole:
            parts = self.parts.get(token)
            self.whole[token] = parts is None or (
                self.is_whole(parts[0]) and self.is_whole(parts[1]) and self.compatible(*parts, self.rank[parts])
            )
        return self.whole[token]

    def compatible(self, left: str, right: str, below: int | None = None) -> bool:
        """May the two be neighbours: do no merges (of a rank less than `below`) join them or parts of them?

        The inner edges are compared in the order in which they have come to be:
        from the last merge on either side backwards, to the symbols at the border.
        """
        if below is None:
            if (left, right) not in self.known:
                self.known[left, right] = self._apart(left, right, len(self.rank))
            return self.known[left, right]
        return self._apart(left, right, below)

    def _apart(self, left: str, right: str, below: int) -> bool:
        while True:
            rank = self.rank.get((left, right))
            # This merge would have come before the later of the two was used in another.
            if rank is not None and rank < below:
                return False
            made_left, made_right = (self.rank[self.parts[t]] if t in self.parts else -1 for t in (left, right))
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                # Until then its right part stood at the border; of equal ranks the left one merges first.
                below, left = made_left, self.parts[left][1]
            else:
                below, right = made_right + 1, self.parts[right][0]


class CountingTransducer:
    """States over symbols, compiled as they are met."""

    def __init__(self, json_name: str) -> None:
        self.json_name, self.merges, self.exact = json_name, Merges(json_name), None
        self.special = self._special()
        letters = _byte_letters()
        self.letters = {chr(k): [letters[b] for b in chr(k).encode()] for k in range(0x250)}
        # The tree of tokens: children by symbol, and the token that ends at a node.
        self.children: list[dict[str, int]] = [{}]
        self.token: list[str | None] = [None]
        for token in self.merges.number:
            node = 0
            for symbol in self.merges.symbols(token):
                if symbol not in self.children[node]:
                    self.children[node][symbol] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = self.children[node][symbol]
            self.token[node] = token
        self._forget()
        self.words = WordCache(self._word)

    def _special(self) -> tuple[str, ...]:
        with open(vocabulary_path(self.json_name), encoding="utf-8") as file:
            return tuple(added["content"] for added in json.load(file)["added_tokens"])

    def _forget(self) -> None:
        # Open tokens of a state: (node in the tree, token before it, tokens up to it less those up to here).
        self.open: list[tuple] = [((0, None, 0),)]
        self.numbered = {self.open[0]: 0}
        self.next: list[dict[str, tuple[int, int]]] = [{}]

    def _compile(self, state: int, symbol: str) -> tuple[int, int]:
        """The state after a symbol, and the tokens that it adds."""
        merges, moved, last, added = self.merges, [], None, 0
        for node, before, count in self.open[state]:
            child = self.children[node].get(symbol)
            if child is None:
                continue
            moved.append((child, before, count))
            token = self.token[child]
            if token is not None and merges.is_whole(token) and (before is None or merges.compatible(before, token)):
                last, added = token, count + 1
        if last is None:
            raise ValueError(f"no token of {self.json_name} ends with {symbol!r} here")
        opened = (*((node, before, count - added) for node, before, count in moved if self.children[node]), (0, last, 0))
        if opened not in self.numbered:
            self.numbered[opened] = len(self.open)
            self.open.append(opened)
            self.next.append({})
        found = self.next[state][symbol] = (self.numbered[opened], added)
        return found

    def _piece(self, piece: str) -> int:
        # Printable ASCII stands for itself.
        letters = list(piece) if piece.isascii() else [letter for c in piece for letter in self.letters[c]]
        letters[-1] += self.merges.end
        state = count = 0
        for symbol in letters:
            step = self.next[state].get(symbol) or self._compile(state, symbol)
            state, count = step[0], count + step[1]
        if len(self.open) > _STATES:
            self._forget()
        return count

    def _word(self, word: str) -> int:
        """The tokens of a run without blanks."""
        if not word:
            return 0
        if _PLAIN.fullmatch(word) and not any(s in word for s in self.special):
            # Each letter by itself: what a letter becomes does not depend on its neighbours.
            lower = word.lower() if word.isascii() else "".join(c.lower() for c in word)
            if all(c in self.letters for c in lower):
                return sum(self._piece(m.group()) for m in _PIECE.finditer(lower))
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(vocabulary_path(self.json_name))
        return len(self.exact.encode(word, add_special_tokens=False))

    def chunk(self, text: str) -> int:
        """The tokens that a chunk between blanks adds."""
        words = text.replace("\n", " ").split(" ")
        return sum(map(self.words.__getitem__, words))

    def count(self, text: str) -> int:
        total = at = 0
        while at < len(text):
            end = at + CHUNK
            if end < len(text):
                blanks = [k for k in (text.find(" ", end), text.find("\n", end)) if k >= 0]
                end = min(blanks, default=len(text))
            total += self.chunk(text[at:end])
            at = end
        return total


@functools.cache
def compiled(json_name: str) -> CountingTransducer:
    """One transducer for all tasks of a worker: what one has compiled serves the next."""
    return CountingTransducer(json_name)


def token_counts(json_name: str = "word_bpe_49k.json"):
    """A column function: the number of tokens of a text, 0 for null."""

    def counts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        transducer = compiled(json_name)
        for some in texts:
            yield pd.Series([transducer.count(t) if t else 0 for t in some], dtype="int64")

    counts.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(counts, "bigint")


def count_tokens(
    documents: DataFrame,
    limit: int = 2048,
    text: str = "text",
    json_name: str = "word_bpe_49k.json",
) -> DataFrame:
    """Each row with `n_bytes`, `n_tokens` and `over_limit`."""
    body: Column = F.coalesce(F.col(text), F.lit(""))
    return documents.withColumns(
        {
            "n_bytes": F.octet_length(body).cast("long"),
            "n_tokens": token_counts(json_name)(F.col(text)),
        }
    ).withColumn("over_limit", F.col("n_tokens") > limit)
