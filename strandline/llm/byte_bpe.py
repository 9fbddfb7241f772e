"""Exact byte-level BPE ids by dynamic programming over prefixes.

Method: text is split by the tokenizer's pattern. Within a piece, every prefix has exactly one last token in its BPE encoding,
and that token t is the one vocabulary entry that is a suffix of the prefix and that BPE would leave beside the last token of
the prefix before t. An automaton over the vocabulary gives the suffix matches at every position, the pair test below decides
between them, and following the stored last tokens back from the end of the piece gives its ids. The time is linear in the
piece, however long it is and whatever it repeats.

Pair test: BPE applies merges in the order of their ranks, so the token beside the boundary is, on either side, first a single
byte and then ever larger parts along the edge of the final token. The tokens stay apart unless the two edge parts that
exist at some rank would merge with each other before one of them grows.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed value: the pattern that goes with byte_bpe_50k
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEVER = 1 << 60
CACHE_PIECES = 200_000


def vocabulary_path(folder: str | None = None, name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of a rank file; by default in the folder named by TOKENIZER_DIR or in /opt/tokenizers."""
    return os.path.join(folder or os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), name)


class PrefixEncoder:
    """Encodes text with a rank file (token bytes and rank per line); special tokens are ordinary text."""

    def __init__(self, path: str, pattern: str = PATTERN):
        import ahocorasick
        import regex

        with open(path, "rb") as f:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.token = {rank: token for token, rank in self.rank.items()}
        self.split = regex.compile(pattern).findall
        self.matches = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.matches.add_word(token.decode("latin-1"), (rank, len(token)))
        self.matches.make_automaton()
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.beside: dict[tuple[int, int], bool] = {}
        self.known: dict[str, list[int]] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for single bytes. (-1, -1) for a token that BPE never makes."""
        if token not in self.parts:
            pieces = [self.rank[bytes([b])] for b in self.token[token]]
            last = None
            while len(pieces) > 1:
                ranks = [self.rank.get(self.token[a] + self.token[b], NEVER) for a, b in zip(pieces, pieces[1:])]
                best = min(ranks)
                if best == NEVER:
                    last = (-1, -1)
                    break
                at = ranks.index(best)
                last = (pieces[at], pieces[at + 1])
                pieces[at : at + 2] = [best]
            self.parts[token] = last
        return self.parts[token]

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, rank at which it grows) along the left (0) or right (1) edge of the token, largest first."""
        known = self.edges[side]
        if token not in known:
            out, grows, part = [], NEVER, token
            while True:
                out.append((part, grows))
                halves = self.halves(part)
                if halves is None:
                    break
                grows, part = part, halves[side]
            known[token] = out
        return known[token]

    def apart(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens side by side."""
        key = (left, right)
        if key not in self.beside:
            self.beside[key] = not any(
                self._meets(a, a_grows, b, b_grows) for a, a_grows in self.edge(left, 1) for b, b_grows in self.edge(right, 0)
            )
        return self.beside[key]

    def _meets(self, a: int, a_grows: int, b: int, b_grows: int) -> bool:
        merged = self.rank.get(self.token[a] + self.token[b])
        if merged is None:
            return False
        first = max(merged, a if a > 255 else 0, b if b > 255 else 0)
        # at equal ranks the merge further left goes first
        return first < a_grows and first <= b_grows

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8", "replace").decode("latin-1")
        last = [-1] * (len(data) + 1)
        width = [0] * (len(data) + 1)
        for at, (token, size) in self.matches.iter(data):
            end = at + 1
            if last[end] >= 0:
                continue
            start = end - size
            if self.halves(token) != (-1, -1) if start == 0 else self.apart(last[start], token):
                last[end], width[end] = token, size
        ids = []
        end = len(data)
        while end:
            ids.append(last[end])
            end -= width[end]
        ids.reverse()
        return ids

    def encode(self, text: str) -> list[int]:
        known = self.known
        ids: list[int] = []
        for piece in self.split(text):
            found = known.get(piece)
            if found is None:
                found = self.encode_piece(piece)
                if len(piece) <= 64:
                    if len(known) >= CACHE_PIECES:
                        known.clear()
                    known[piece] = found
            ids += found
        return ids


@lru_cache(maxsize=2)
def encoder(path: str) -> PrefixEncoder:
    """One encoder per worker process."""
    return PrefixEncoder(path)


def token_ids(text: Column, path: str | None = None) -> Column:
    """Ids of the text as array<int>; an empty or null text has none: an empty array."""
    where = path or vocabulary_path()

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(where).encode
        for texts in batches:
            # four bytes an id at once, as a batch may hold many long texts
            yield pd.Series([np.array(encode(t) if t else [], dtype=np.int32) for t in texts], dtype=object)

    return ids(text)


def token_count(text: Column, path: str | None = None) -> Column:
    """Number of ids of the text; 0 for an empty or null text."""
    where = path or vocabulary_path()

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(where).encode
        for texts in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int32")

    return count(text)
