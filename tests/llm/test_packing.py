"""Packing: an exact round trip of every token id."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from offerloom.llm.packing import assign, pack_documents


def test_every_id_lies_in_one_piece_and_sequences_have_no_padding(spark, documents):
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "é", "x1", "longer-word", "\n", "<|endoftext|>"]
    texts = [" ".join(rng.choice(words, n)) for n in (1, 3, 50, 400, 5000, 900, 900)]
    rows = [*enumerate(texts), (7, None), (8, ""), (None, "no id"), (0, texts[0])]
    got = pack_documents(documents(rows).repartition(2)).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4"))
    total = 0
    for r in got.itertuples():
        own = ids[None if r.doc_id != r.doc_id else r.doc_id][0]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        total += r.length
    assert total == sum(len(x) for v in ids.values() for x in v)
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert list(own.offset) == list(own.length.cumsum() - own.length)
        size = own.length.sum()
        assert size == 1024 or size & (size - 1) == 0


def test_assign_takes_descending_pieces_to_the_cheapest_sequence():
    placed, rest = assign([3, 8, 5, 4], [10, 10], lambda n: n + n * n)
    assert [(i, n, k) for i, _, n, k in placed][:2] == [(1, 8, 0), (2, 5, 1)]
    assert sum(n for _, _, n, _ in placed) == 20 and not rest
    placed, rest = assign([7, 7], [10], lambda n: n)
    assert sum(n for _, _, n, _ in placed) == 10 and rest == [(1, 3)]


def test_empty_table(spark, documents):
    assert pack_documents(documents([])).count() == 0
