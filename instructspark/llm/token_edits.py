"""Token counts that follow edits.

A text is cut into pre-tokens by the tokenizer's pattern; each is encoded alone, so a
text's count is the sum over its pre-tokens.  A document keeps the lengths and counts of
its pre-tokens as leaves of a segment tree of sums.  An edit replaces a span of
characters: the tree finds the pre-tokens it touches, the pattern runs again from a few
pre-tokens before the edit until its cuts meet old ones behind it, and only new
pre-tokens are encoded; sums are updated from those leaves to the root.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instructspark.llm.common import bound_batches, replacing

# The public byte-level BPE pattern: contractions, words, numbers, marks, white space.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The pattern looks at most one character past a pre-token, but a cut before an edit can
# move when white space or a mark joins what follows: this many pre-tokens are cut again.
CONTEXT = 2

CACHE = 200_000


def load_ranks(path: str) -> bytes:
    """The tokenizer's vocabulary file: a token in base 64 and its rank on each line."""
    try:
        with open(path, "rb") as file:
            return file.read()
    except FileNotFoundError as error:
        raise FileNotFoundError(f"no vocabulary file at {path}; pass the path of a byte-level BPE rank file") from error


class Counter:
    """Token counts of pre-tokens, recent ones kept."""

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN):
        ranks = {}
        for line in vocabulary.splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}
        self.encoded = 0

    def cut(self, text: str, start: int = 0) -> Iterator[str]:
        """Pre-tokens of a text from a cut on."""
        return (m.group() for m in self.pattern.finditer(text, start))

    def count(self, piece: str) -> int:
        self.encoded += 1
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            n = len(self.encoding.encode_ordinary(piece))
            # Long pieces would fill the cache with text.
            if len(piece) <= 64:
                self.known[piece] = n
        return n


class TokenTree:
    """A text's pre-tokens as leaves, with sums of characters and tokens above them.

    Leaves lie in blocks of ``BLOCK``; a block's sums are leaves of a binary tree of
    sums.  Replacing leaves rewrites the blocks they are in; when a block outgrows twice
    its size, the blocks are dealt anew.
    """

    BLOCK = 64

    def __init__(self, chars: Sequence[int], tokens: Sequence[int]):
        self._build(list(map(int, chars)), list(map(int, tokens)))

    @classmethod
    def of(cls, text: str, counter: Counter) -> TokenTree:
        pieces = list(counter.cut(text))
        return cls([len(p) for p in pieces], [counter.count(p) for p in pieces])

    def _build(self, chars: list[int], tokens: list[int]) -> None:
        step = self.BLOCK
        self.blocks = [(chars[i : i + step], tokens[i : i + step]) for i in range(0, len(chars), step)] or [([], [])]
        self.size = 1
        while self.size < len(self.blocks):
            self.size *= 2
        self.sums = [(0, 0)] * (2 * self.size)
        for i, (c, t) in enumerate(self.blocks):
            self.sums[self.size + i] = (sum(c), sum(t))
        for i in range(self.size - 1, 0, -1):
            self._add(i)

    def _add(self, i: int) -> None:
        (a, b), (c, d) = self.sums[2 * i], self.sums[2 * i + 1]
        self.sums[i] = (a + c, b + d)

    def _refresh(self, block: int) -> None:
        i = self.size + block
        self.sums[i] = (sum(self.blocks[block][0]), sum(self.blocks[block][1]))
        while i > 1:
            i //= 2
            self._add(i)

    @property
    def n_chars(self) -> int:
        return self.sums[1][0]

    @property
    def n_tokens(self) -> int:
        return self.sums[1][1]

    def leaves(self) -> tuple[list[int], list[int]]:
        return [x for c, _ in self.blocks for x in c], [x for _, t in self.blocks for x in t]

    def find(self, char: int) -> tuple[int, int, int]:
        """Block, leaf in it and first character of the leaf that holds a character; for
        the end of the text, the place behind the last leaf."""
        if char >= self.n_chars:
            last = len(self.blocks) - 1
            return last, len(self.blocks[last][0]), self.n_chars
        i, at = 1, 0
        while i < self.size:
            left = self.sums[2 * i][0]
            if char < at + left:
                i = 2 * i
            else:
                i, at = 2 * i + 1, at + left
        block = i - self.size
        for leaf, length in enumerate(self.blocks[block][0]):
            if char < at + length:
                return block, leaf, at
            at += length
        raise AssertionError("sums disagree with leaves")

    def back(self, block: int, leaf: int, at: int, steps: int) -> tuple[int, int, int]:
        """The place some leaves earlier."""
        for _ in range(steps):
            while leaf == 0:
                if block == 0:
                    return 0, 0, 0
                block -= 1
                leaf = len(self.blocks[block][0])
            leaf -= 1
            at -= self.blocks[block][0][leaf]
        return block, leaf, at

    def replace(self, first: tuple[int, int], behind: tuple[int, int], chars: list[int], tokens: list[int]) -> None:
        """Puts new leaves in place of those from ``first`` up to ``behind``."""
        (b0, l0), (b1, l1) = first, behind
        if b0 == b1:
            own = self.blocks[b0]
            own[0][l0:l1], own[1][l0:l1] = chars, tokens
        else:
            own, last = self.blocks[b0], self.blocks[b1]
            own[0][l0:], own[1][l0:] = chars, tokens
            del last[0][:l1], last[1][:l1]
            for block in range(b0 + 1, b1):
                self.blocks[block] = ([], [])
        if len(own[0]) > 2 * self.BLOCK:
            self._build(*self.leaves())
        else:
            for block in range(b0, b1 + 1):
                self._refresh(block)

    def edit(self, text: str, start: int, length: int, new: str, counter: Counter) -> str:
        """Replaces ``length`` characters from ``start`` and returns the new text.

        The cut of the text behind the edit is old as soon as a new cut falls on an old
        one there: the pattern looks ahead, never back.
        """
        start = max(0, min(start, len(text)))
        length = max(0, min(length, len(text) - start))
        edited = text[:start] + new + text[start + length :]
        b0, l0, at = self.back(*self.find(start), CONTEXT)
        shift = len(new) - length
        # Old cuts at or behind the end of the edit, in places of the new text.
        b1, l1, old = self.find(start + length)
        if old < start + length:
            old += self.blocks[b1][0][l1]
            l1 += 1
        cut, chars, tokens = at, [], []
        pieces = counter.cut(edited, at)
        floor = start + len(new)
        while cut < len(edited):
            while cut >= floor and old + shift < cut:
                if l1 == len(self.blocks[b1][0]):
                    if b1 + 1 == len(self.blocks):
                        break
                    b1, l1 = b1 + 1, 0
                    continue
                old += self.blocks[b1][0][l1]
                l1 += 1
            if cut >= floor and old + shift == cut and cut > at:
                break
            piece = next(pieces)
            chars.append(len(piece))
            tokens.append(counter.count(piece))
            cut += len(piece)
        else:
            b1 = len(self.blocks) - 1
            l1 = len(self.blocks[b1][0])
        self.replace((b0, l0), (b1, l1), chars, tokens)
        return edited


@lru_cache(maxsize=2)
def _counter(vocabulary: bytes, pattern: str) -> Counter:
    return Counter(vocabulary, pattern)


def token_trees(df: DataFrame, vocabulary: bytes, text: str = "text", pattern: str = PATTERN, output: str = "tree") -> DataFrame:
    """Adds a text's leaves, ``struct<chars: array<int>, tokens: array<int>>``.

    NULL and empty texts have no leaves.  A column named ``output`` is replaced.
    """
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("chars array<int>, tokens array<int>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = _counter(shared.value, pattern)
        for texts in batches:
            trees = [TokenTree.of(t or "", counter).leaves() for t in texts]
            yield pd.DataFrame({"chars": [c for c, _ in trees], "tokens": [t for _, t in trees]})

    added = df.withColumn("_tree", cut(F.col(f"`{text}`")))
    return replacing(added, [output]).withColumnRenamed("_tree", output)


EDITED = ["edited_text", "edited_tree", "n_tokens", "edited_tokens", "n_recounted", "n_pieces"]


def apply_edits(
    df: DataFrame,
    vocabulary: bytes,
    text: str = "text",
    tree: str = "tree",
    edits: str = "edits",
    pattern: str = PATTERN,
) -> DataFrame:
    """Adds ``edited_text, edited_tree, n_tokens, edited_tokens, n_recounted, n_pieces``.

    ``edits`` is an array of ``struct<start, length, new>`` in order, each on the text
    that the ones before it left; places beyond the text's end are moved to it, NULL
    places are 0, a NULL ``new`` is empty.  ``n_recounted`` is how many pre-tokens were
    encoded again, ``n_pieces`` how many the edited text has.

    A NULL text is empty, a NULL tree is cut from the text, NULL edits are none.  Rows
    are independent, repeated ones too; input columns named like a result are replaced.
    """
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf(
        "edited_text string, edited_tree struct<chars:array<int>,tokens:array<int>>,"
        "n_tokens long, edited_tokens long, n_recounted long, n_pieces long"
    )
    def edit(batches: Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        counter = _counter(shared.value, pattern)
        for texts, chars, tokens, changes in batches:
            out = []
            for value, c, t, changed in zip(texts, chars, tokens, changes, strict=True):
                value = value or ""
                known = TokenTree(c, t) if c is not None else TokenTree.of(value, counter)
                before, counter.encoded = known.n_tokens, 0
                for one in changed if changed is not None else ():
                    value = known.edit(value, one["start"] or 0, one["length"] or 0, one["new"] or "", counter)
                new = known.leaves()
                out.append((value, {"chars": new[0], "tokens": new[1]}, before, known.n_tokens, counter.encoded, len(new[0])))
            yield pd.DataFrame(out, columns=EDITED)

    changed = F.col(f"`{edits}`")
    added = df.withColumn(
        "_edited", edit(F.col(f"`{text}`"), F.col(f"`{tree}`.chars"), F.col(f"`{tree}`.tokens"), changed)
    )
    return replacing(added, EDITED).select("*", "_edited.*").drop("_edited")
