"""Quality classifier: histogram gradient-boosted trees over document statistics.

A text becomes a short row of statistics: shares of kinds of characters and
words, repetition, entropy, how far it compresses. All texts are read once and
their rows stored. Trees are grown by level on binned statistics of a bounded
sample of labelled rows, each level from one histogram of gradients per node,
statistic and bin. They are complete, so that a tree is three flat arrays
(statistic, threshold, leaf value) and numpy walks a block of rows down all trees
at once, a level per step.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import crc_mod, short_batches, stored

#: The classifier is fitted on at most so many labelled rows, those with the smallest hashes.
SAMPLE_ROWS = 20_000
FOLDS = 5
CUT = 0.3
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
RIDGE = 1.0
LEAST = 2.0  # hessian on either side of a split
#: Bytes of a text that are read at once, rows that walk the trees at once.
PIECE = 4_000_000
ROWS = 4096

_KINDS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "blank": b" \t\r\x0b\x0c",
    "line": b"\n",
    "stop": b".?",
    "comma": b",;:",
    "shout": b"!",
    "quote": b"'\"()-",
    "bar": b"|/\\_=+~^`",
    "mark": b"#$%&*@",
    "bracket": b"<>[]{}",
    "high": bytes(range(128, 256)),
}
_KIND_OF = np.zeros((256, len(_KINDS)))
for _i, _chars in enumerate(_KINDS.values()):
    _KIND_OF[list(_chars), _i] = 1
_WORD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_LETTERS = bytes(c for c in range(256) if c < 128 and not chr(c).isalpha())

STATISTICS = (
    "size", "words", "lines", *(f"share_{k}" for k in _KINDS), "entropy", "doubled", "packed",
    "word_length", "word_spread", "long_words", "letterless", "loud_words", "plain_words", "kinds_of_words",
    "first_word", "three_words", "once", "line_length", "repeated_lines", "first_line", "short_lines", "marked_words",
)


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces that end with a line, else a word, where there is one."""
    at = 0
    while len(text) - at > PIECE:
        cut = max(text.rfind(b"\n", at, at + PIECE), text.rfind(b" ", at + PIECE // 2, at + PIECE)) + 1
        cut = cut if cut > at else at + PIECE
        yield text[at:cut]
        at = cut
    yield text[at:]


def statistics(text: bytes) -> np.ndarray:
    """The statistics of one text; zeros for an empty one."""
    if not text:
        return np.zeros(len(STATISTICS), np.float32)
    size = len(text)
    counts, doubled, packed = np.zeros(256), 0, 0
    words: Counter = Counter()
    lines: Counter = Counter()
    packer = zlib.compressobj(1)
    for piece in _pieces(text):
        codes = np.frombuffer(piece, np.uint8)
        counts += np.bincount(codes, minlength=256)
        same = codes[1:] == codes[:-1]
        doubled += int(np.count_nonzero(same & (codes[1:] < 128) & (codes[1:] != 32)))
        packed += len(packer.compress(piece))
        words.update(piece.split())
        lines.update(piece.split(b"\n"))
    packed += len(packer.flush())
    share = counts / size
    held = share[share > 0]
    out = [np.log1p(size), np.log1p(words.total()), np.log1p(lines.total()), *(share @ _KIND_OF)]
    out += [float(-(held * np.log2(held)).sum()), doubled / size, packed / size]
    n = words.total()
    if n:
        kinds = list(words)
        times = np.fromiter(words.values(), np.float64, len(kinds))
        length = np.fromiter(map(len, kinds), np.float64, len(kinds))
        inner = np.fromiter((len(w.translate(None, _LETTERS)) for w in kinds), np.float64, len(kinds))
        loud = np.fromiter(map(bytes.isupper, kinds), bool, len(kinds))
        mean = float(times @ length) / n
        top = np.sort(times)[::-1]
        out += [
            mean,
            float(np.sqrt(max(times @ length**2 / n - mean * mean, 0))),
            float(times @ (length > 12)) / n,
            float(times @ (inner == 0)) / n,
            float(times @ (loud & (length > 1))) / n,
            float(times @ (inner == length)) / n,
            len(kinds) / n,
            float(top[0]) / n,
            float(top[:3].sum()) / n,
            float((times == 1).sum()) / n,
        ]
    else:
        out += [0.0] * 10
    total = lines.total()
    full = {k: c for k, c in lines.items() if k.strip()}
    shown = sum(full.values())
    out += [
        np.log1p(size / total),
        1 - len(full) / shown if shown else 0.0,
        max(full.values(), default=0) / max(shown, 1),
        sum(c for k, c in full.items() if len(k) < 30) / max(shown, 1),
        sum(c for w, c in words.items() if not w.translate(_WORD).strip() or not w[-2:].translate(_WORD).strip()) / max(n, 1),
    ]
    return np.array(out, np.float32)


@dataclass
class Trees:
    """Complete trees as flat arrays: a row per tree, inner nodes and leaves by level."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds per row of ``x``: all trees go down a level at a time."""
        out = np.full(len(x), self.start)
        trees = np.arange(len(self.feature))
        depth = int(self.leaf.shape[1]).bit_length() - 1 if len(trees) else 0
        for at in range(0, len(x) if len(trees) else 0, ROWS):
            block = x[at : at + ROWS]
            rows = np.arange(len(block))[:, None]
            node = np.zeros((len(block), len(trees)), np.int64)
            for _ in range(depth):
                right = block[rows, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + right
            out[at : at + ROWS] += self.leaf[trees, node - self.feature.shape[1]].sum(axis=1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return (np.tanh(self.margin(x) / 2) + 1) / 2


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for labels 0 and 1, by Newton steps on the logistic loss."""
    n, width = x.shape
    rate = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(rate / (1 - rate)))
    inner = 2**depth - 1
    out = Trees(start, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, 2**depth)))
    if n == 0 or y.min() == y.max():
        return Trees(start, out.feature[:0], out.threshold[:0], out.leaf[:0])
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    place = binned + np.arange(width) * BINS  # of a row's values in one histogram
    limit = np.array([[i < len(e) for i in range(BINS)] for e in edges])  # a split needs an edge
    margin = np.full(n, start)
    for t in range(trees):
        p = (np.tanh(margin / 2) + 1) / 2
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)  # within its level
        for level in range(depth):
            nodes = 2**level
            cell = (node[:, None] * (width * BINS) + place).ravel()
            size = nodes * width * BINS
            sums = [np.bincount(cell, weights=np.repeat(w, width), minlength=size).reshape(nodes, width, BINS).cumsum(axis=2) for w in (g, h)]
            left_g, left_h = sums
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[~(limit & (left_h >= LEAST) & (right_h >= LEAST))] = -np.inf
            best = gain.reshape(nodes, -1).argmax(axis=1)
            ok = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            feature, cut = best // BINS, best % BINS
            first = nodes - 1
            for k in np.flatnonzero(ok):
                out.feature[t, first + k] = feature[k]
                out.threshold[t, first + k] = edges[feature[k]][cut[k]]
            right = ok[node] & (binned[np.arange(n), feature[node]] > cut[node])
            node = 2 * node + right
        total_g = np.bincount(node, weights=g, minlength=2**depth)
        total_h = np.bincount(node, weights=h, minlength=2**depth)
        out.leaf[t] = -RATE * total_g / (total_h + RIDGE)
        margin += out.leaf[t][node]
    return out


def _measured(docs: DataFrame) -> DataFrame:
    """Statistics of every row's whole text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [statistics(t or b"") for t in frame.pop("text")]
            yield frame.assign(x=rows)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (crc_mod("doc_id", FOLDS) == 0).alias("held_out"),
        F.col("text").cast("binary").alias("text"),
    )
    return rows.mapInPandas(run, "doc_id long, held_out boolean, x array<float>")


def _sample(measured: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` different labelled rows outside the held-out fold, with the smallest hashes."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.distinct().withColumn("hash", F.xxhash64("doc_id"))
    picked = known.orderBy("hash", "doc_id", "y").limit(rows)
    found = measured.where(~F.col("held_out")).join(F.broadcast(picked), "doc_id").distinct()
    return found.orderBy("hash", "doc_id", "y", "x").limit(rows).select("y", "x")


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, cut: float = CUT) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, held_out, score, predicted, one row per input row.

    Learns ``label`` of ``labels(doc_id, <label>)`` from rows whose crc32 of the
    id as text modulo 5 is not 0, at most ``rows`` different ones. A NULL text
    is empty, an empty one has a score like others. Labels that are neither 0
    nor 1 are passed over; an id with both labels counts with both, repeated
    rows once. NULL ids are scored and never learnt from; further columns are
    not read. Without two kinds of labels every score is the smoothed share of
    ones; an empty table gives an empty result.
    """
    short_batches(docs)
    measured = stored(_measured(docs), "statistics")
    known = _sample(measured, labels, label, rows).toPandas()
    x = np.array(known["x"].tolist(), np.float32).reshape(len(known), len(STATISTICS))
    order = np.lexsort((*x.T, known["y"].to_numpy()))  # sums do not depend on the order of arrival
    model = fit(x[order], known["y"].to_numpy(np.float64)[order])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = np.array(frame.pop("x").tolist(), np.float32).reshape(len(frame), len(STATISTICS))
            yield frame.assign(score=model.probability(own))

    scored = measured.mapInPandas(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", _predicted(cut))


def _predicted(cut: float) -> Column:
    return (F.col("score") >= F.lit(cut)).cast("int")
