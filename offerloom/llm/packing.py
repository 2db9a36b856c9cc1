"""Cost-balanced packing of tokenised documents into fixed sequences.

A piece of n tokens costs ``linear * n + quadratic * n * n``: attention is
quadratic in the tokens that see each other. Every task packs its own
documents pool by pool: descending pieces go to the cheapest open sequence that
has room for them, and a piece that fits nowhere is cut to fill the cheapest
one that has any room. A pool opens as many sequences as its tokens fill, so
none of them has padding; what is left over joins the next pool, and at the
end of a task it goes to sequences of powers of two. There is no shuffle, and a
task holds one pool and one document at a time.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import short_batches

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
)
#: Documents' rests held at a time by a task.
POOL = 4096
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256


def default_vocabulary() -> str:
    """The byte-level BPE ranks; the same vocabulary as byte_bpe_50k.json."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(vocabulary: str):
    """text -> uint32 ids. The special token's string in a text is that token, as in the JSON form."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding(
        "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID}
    )

    def encode(text: str) -> np.ndarray:
        return own.encode_to_numpy(text, allowed_special="all", disallowed_special=())

    return encode


def assign(lengths: list[int], rooms: list[int], cost) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """Pieces and sequences of one pool -> placements and rests.

    A placement is (piece, from, length, sequence), in the order in which
    sequences fill; a rest is (piece, from) and goes on to the piece's end.
    """
    room = np.array(rooms, dtype=np.int64)
    spent = np.zeros(len(rooms))
    todo = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(todo)
    placed, rest = [], []
    left = int(room.sum())
    while todo:
        n, i, at = heapq.heappop(todo)
        n = -n
        if not left:
            rest.append((i, at))
            continue
        fits = room >= n
        if not fits.any():
            fits = room > 0
        k = int(np.argmin(np.where(fits, spent, np.inf)))
        take = min(n, int(room[k]))
        placed.append((i, at, take, k))
        room[k] -= take
        left -= take
        spent[k] += cost(take)
        if take < n:
            heapq.heappush(todo, (take - n, i, at + take))
    return placed, rest


class _Packer:
    """Pieces of one task; ``rows`` gathers what is decided."""

    def __init__(self, first: int, capacity: int, linear: float, quadratic: float):
        self.next, self.capacity = first, capacity
        self.cost = lambda n: linear * n + quadratic * n * n
        self.pool: list[tuple] = []  # doc_id, start, ids, doc_tokens
        self.rows: list[tuple] = []

    def emit(self, doc_id, start, ids, doc_tokens, sequence, offset) -> None:
        crc = zlib.crc32(ids.tobytes())
        self.rows.append((doc_id, start, len(ids), crc, doc_tokens, sequence, offset, self.cost(len(ids))))

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, c = len(ids), self.capacity
        for at in range(0, n - n % c, c):
            self.emit(doc_id, at, ids[at : at + c], n, self.next, 0)
            self.next += 1
        if n % c:
            self.pool.append((doc_id, n - n % c, ids[n - n % c :].copy(), n))

    def pack(self, last: bool = False) -> None:
        lengths = [len(p[2]) for p in self.pool]
        full, over = divmod(sum(lengths), self.capacity)
        rooms = [self.capacity] * full
        if last:
            rooms += [1 << b for b in range(over.bit_length() - 1, -1, -1) if over >> b & 1]
        placed, rest = assign(lengths, rooms, self.cost)
        offset = [0] * len(rooms)
        for i, at, n, k in placed:
            doc_id, start, ids, total = self.pool[i]
            self.emit(doc_id, start + at, ids[at : at + n], total, self.next + k, offset[k])
            offset[k] += n
        self.next += len(rooms)
        self.pool = [(self.pool[i][0], self.pool[i][1] + at, self.pool[i][2][at:], self.pool[i][3]) for i, at in rest]


def pack_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = 1024,
    end_id: int = 0,
    linear: float = 1.0,
    quadratic: float = 1.0 / 256,
    pool: int = POOL,
) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per piece (``PIECE``).

    Every document's ids are followed by ``end_id``; a NULL or empty text is
    that id alone. NULL ids of documents and repeated rows are packed like any
    other row; further columns are not read; an empty table gives no piece.
    ``sequence_id`` is unique over the table and ``offset`` runs gapless from 0
    in each. The crc32 is of the little-endian 32-bit ids.
    """
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        context = TaskContext.get()
        packer = _Packer((context.partitionId() if context else 0) << 40, capacity, linear, quadratic)
        encode = encoder(vocabulary)
        end = np.array([end_id], dtype="<u4")
        types = [pa.int64()] * 7 + [pa.float64()]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost"]

        def out():
            columns = list(zip(*packer.rows)) or [()] * len(names)
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, np.concatenate((encode(text.as_py() or "").astype("<u4", copy=False), end)))
                if len(packer.pool) >= pool:
                    packer.pack()
            if packer.rows:
                yield out()
        packer.pack(last=True)
        yield out()

    narrow = short_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, PIECE)
