"""Token counts that follow edits without encoding the document again.

A document is a sequence of pre-tokens, each of which is encoded on its own.
They lie in blocks under a segment tree whose nodes hold the characters and
tokens below them. An edit finds its place by descending the tree, cuts
pre-tokens anew from a little before the edit up to the first old boundary
behind it where old and new cuts meet, encodes those alone, and updates the
sums above the touched blocks.

Cutting at an old boundary is safe because the pattern never looks back, and a
match looks at one character beyond its end: two pre-tokens before the edit are
enough context.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.packing import default_vocabulary

#: Pre-tokens per block, and blocks of more than four times as many cause a new tree.
BLOCK = 32
#: Pre-tokens before an edit that are cut anew.
CONTEXT = 2
#: Pre-tokens whose counts a worker remembers at a time.
CACHE = 200_000

EDITS = "array<struct<start:bigint,remove:bigint,insert:string>>"


class Counter:
    """Pre-tokens of a text, and how many tokens a pre-token has. Special tokens' strings are ordinary text."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import regex
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        own = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.encode = own.encode_ordinary
        self.cut = self.pattern.findall
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        found = list(map(self.known.get, pieces))
        if None in found:
            if len(self.known) > CACHE:
                self.known.clear()
            for i, n in enumerate(found):
                if n is None:
                    found[i] = self.known[pieces[i]] = len(self.encode(pieces[i]))
        return found


class TokenTree:
    """The pre-tokens of one document under a segment tree of character and token sums."""

    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        self.encoded = 0
        self._build(counter.cut(text))

    def _build(self, pieces: list[str], counts: list[int] | None = None) -> None:
        if counts is None:
            counts = self.counter.counts(pieces)
            self.encoded += len(pieces)
        self.pieces = [pieces[i : i + BLOCK] for i in range(0, len(pieces), BLOCK)] or [[]]
        self.counts = [counts[i : i + BLOCK] for i in range(0, len(counts), BLOCK)] or [[]]
        self.leaves = 1 << (len(self.pieces) - 1).bit_length()
        self.chars = [0] * (2 * self.leaves)
        self.tokens = [0] * (2 * self.leaves)
        for b, (own, n) in enumerate(zip(self.pieces, self.counts)):
            self.chars[self.leaves + b], self.tokens[self.leaves + b] = sum(map(len, own)), sum(n)
        for i in range(self.leaves - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _update(self, b: int) -> None:
        i = self.leaves + b
        self.chars[i], self.tokens[i] = sum(map(len, self.pieces[b])), sum(self.counts[b])
        while i > 1:
            i //= 2
            self._sum(i)

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join("".join(own) for own in self.pieces)

    def _find(self, at: int) -> tuple[int, int, int]:
        """(block, pre-token, its first character) of the pre-token over a character, or behind the last one."""
        i, left = 1, at
        if at >= self.length:
            b = len(self.pieces) - 1
            return b, len(self.pieces[b]), self.length
        while i < self.leaves:
            i *= 2
            if left >= self.chars[i]:
                left -= self.chars[i]
                i += 1
        b, k = i - self.leaves, 0
        while left >= len(self.pieces[b][k]):
            left -= len(self.pieces[b][k])
            k += 1
        return b, k, at - left

    def edit(self, start: int, remove: int, insert: str) -> None:
        """Replace ``remove`` characters from ``start``; both are cut to the text."""
        start = min(max(start, 0), self.length)
        end = min(start + max(remove, 0), self.length)
        b, k, first = self._find(start)
        for _ in range(CONTEXT):
            while k == 0 and b > 0:
                b -= 1
                k = len(self.pieces[b])
            if k == 0:
                break
            k -= 1
            first -= len(self.pieces[b][k])
        # old text between the context and the edit, then what the edit leaves of the pre-token at its end
        head, at, c, j = [], first, b, k
        while at < start:
            while j == len(self.pieces[c]):
                c, j = c + 1, 0
            head.append(self.pieces[c][j])
            at += len(self.pieces[c][j])
            j += 1
        fresh = "".join(head)[: start - first] + insert
        c, j, at = self._find(end)
        buffer, edge = fresh, len(fresh)
        marks: dict[int, tuple[int, int]] = {}  # places in the buffer where an old pre-token begins
        reach = 8
        skip = end - at
        while True:
            added = 0
            while added < reach and c < len(self.pieces):
                if j == len(self.pieces[c]):
                    c, j = c + 1, 0
                    continue
                if not skip:
                    marks[len(buffer)] = (c, j)
                buffer += self.pieces[c][j][skip:]
                skip, j, added = 0, j + 1, added + 1
            done = c >= len(self.pieces)
            met, pieces = None, []
            for m in self.counter.pattern.finditer(buffer):
                # a cut near the buffer's end may change with the text behind it
                if not done and m.end() + 1 >= len(buffer):
                    break
                pieces.append(m[0])
                if m.end() >= edge and m.end() in marks:
                    met = marks[m.end()]
                    break
            if edge in marks and not buffer[:edge]:
                met, pieces = marks[edge], []
            if met or done:
                break
            reach *= 2
        counts = self.counter.counts(pieces)
        self.encoded += len(pieces)
        last, rest = (met[0], met[1]) if met else (len(self.pieces) - 1, len(self.pieces[-1]))
        tail, tail_counts = self.pieces[last][rest:], self.counts[last][rest:]
        own = self.pieces[b][:k] + pieces + tail
        own_counts = self.counts[b][:k] + counts + tail_counts
        for d in range(b + 1, last + 1):
            self.pieces[d], self.counts[d] = [], []
        self.pieces[b], self.counts[b] = own, own_counts
        if len(own) > 4 * BLOCK:
            self._build([p for x in self.pieces for p in x], [n for x in self.counts for n in x])
            return
        for d in range(b, last + 1):
            self._update(d)


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs(doc_id, text, edits)`` -> token counts before and after the edits, one row per input row.

    ``edits`` (``EDITS``) are applied in their order; ``start`` and ``remove``
    count characters of the text as the edits before left it, and are cut to
    it. NULL texts are empty, NULL edits and fields change nothing. Columns:
    doc_id, n_tokens, n_tokens_after, n_chars_after, n_pretokens (of the text
    before), n_reencoded (pre-tokens encoded for the edits). Further columns
    are not read; an empty table gives an empty result.
    """
    vocabulary = vocabulary or default_vocabulary()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(vocabulary)
        for frame in frames:
            rows = []
            for text, edits in zip(frame["text"], frame["edits"]):
                tree = TokenTree(text or "", counter)
                before, pieces = tree.total, tree.encoded
                for e in [] if edits is None else edits:
                    if e is not None:
                        tree.edit(int(e["start"] or 0), int(e["remove"] or 0), e["insert"] or "")
                rows.append((before, tree.total, tree.length, pieces, tree.encoded - pieces))
            names = ["n_tokens", "n_tokens_after", "n_chars_after", "n_pretokens", "n_reencoded"]
            out = pd.DataFrame(rows, columns=names, dtype="int64")
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    schema = "doc_id long, n_tokens long, n_tokens_after long, n_chars_after long, n_pretokens long, n_reencoded long"
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("edits").cast(EDITS).alias("edits"))
    return narrow.mapInPandas(run, schema)
