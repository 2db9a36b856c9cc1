"""A log-bilinear language model, trained in numpy by noise-contrastive estimation.

Tokens fall into classes: each frequent token is one, and the others share
classes by their first two characters. The model predicts a class from the
classes of the two tokens before it: the context vectors, each through its
place's matrix, add up to a prediction whose product with every class vector,
plus the class's bias, is that class's log weight. Within a shared class a
token has the smoothed share of its corpus count, and one outcome stands for
all unseen tokens, so that the probabilities of all outcomes add up to one.

Counting covers all training rows. Each text is then tokenised once more and
stored as class ids, from which the model is trained and the text is scored.
Training is data-parallel: every task takes
noise-contrastive gradient steps over its own documents, and the parameters'
mean, weighted by tokens, is a grouped aggregation. Scoring normalises over all
classes by matrix products of whole blocks of contexts. Counts of tokens
outside the most frequent ones come from a join on the token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm.common import crc_mod, short_batches, stored

#: No token holds a line feed.
END = "\n"
#: Tokens that are classes of their own, and shared classes.
FREQUENT = 768
SHARED = 255
#: Share of all tokens from which on every worker has a token's count; there are at most 1 / KNOWN of them.
KNOWN = 2e-6
WIDTH = 24
ROUNDS = 2
BATCH = 1024
NOISE = 64
RATE = 0.08
SEED = 17
#: Tokens of a block that training and scoring take at a time.
CACHE = 200_000
#: Bytes of text that are tokenised at a time, and of tokens that a worker holds until it counts them.
PIECE = 4_000_000
HELD = 40_000_000


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space, A-Z lower-cased, of all texts in a row, and how many each has.

    A text's end is not among them; a NULL text has no words.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)  # around the words there are empty ones
    before = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
    offsets = lists.offsets.to_numpy()
    return words.filter(real), np.diff(before[offsets - offsets[0]])


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch's rows, in pieces of about PIECE bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    piece = np.cumsum(sizes, dtype=np.int64) // PIECE
    edges = np.flatnonzero(np.diff(piece)) + 1
    for at, end in zip([0, *edges], [*edges, len(sizes)]):
        if end > at:
            yield batch.slice(at, end - at)


@dataclass
class Classes:
    """Which class a token is in, and the counts that go with it."""

    own: dict[str, int]
    shared: dict[str, int]
    counts: dict[str, int]
    totals: np.ndarray  # tokens of each class
    kinds: np.ndarray  # different tokens of each class
    tokens: int
    distinct: int

    @property
    def size(self) -> int:
        return len(self.totals)

    def of(self, token: str) -> int:
        k = self.own.get(token)
        return self.shared.get(token[:2], len(self.own)) if k is None else k

    def inner(self, k: int) -> float:
        """log of the mass in a shared class's smoothed shares."""
        return float(np.log(self.totals[k] + 0.5 * (self.kinds[k] + 1)))


def _counts(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        ends = 0

        def rows() -> pa.RecordBatch:
            found = pc.value_counts(pa.chunked_array(held, pa.string()))
            held.clear()
            return pa.RecordBatch.from_arrays([found.field(0).cast(pa.binary()), found.field(1)], ["token", "n"])

        for batch in batches:
            ends += batch.num_rows
            for piece in _pieces(batch):
                held.append(tokens_of(piece.column("text"))[0])
                if sum(words.nbytes for words in held) >= HELD:
                    yield rows()
        yield rows()
        yield pa.RecordBatch.from_arrays([pa.array([END.encode()], pa.binary()), pa.array([ends], pa.int64())], ["token", "n"])

    counts = docs.select("text").mapInArrow(run, "token binary, n long").where("n > 0")
    return counts.groupBy(F.col("token").cast("string").alias("token")).agg(F.sum("n").alias("n"))


def _classes(counts: DataFrame) -> Classes:
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    top = counts.where(F.col("n") >= F.lit(KNOWN * (whole.n or 0))).collect()
    top.sort(key=lambda r: (-r.n, r.token))
    own = [END] + [r.token for r in top if r.token != END][: FREQUENT - 1]
    held = counts.sparkSession.createDataFrame([(t,) for t in own], "token string")
    rest = counts.join(F.broadcast(held), "token", "left_anti")
    starts = rest.groupBy(F.substring("token", 1, 2).alias("start")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    starts = stored(starts, "starts")
    shared = starts.orderBy(F.desc("n"), "start").limit(SHARED).collect()
    known = {r.token: r.n for r in top}
    size = len(own) + 1 + len(shared)
    totals, kinds = np.zeros(size), np.zeros(size)
    totals[: len(own)] = [known.get(t, 0) for t in own]
    other = starts.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    for i, r in enumerate(shared):
        totals[len(own) + 1 + i], kinds[len(own) + 1 + i] = r.n, r.v
    totals[len(own)] = (other.n or 0) - sum(r.n for r in shared)
    kinds[len(own)] = (other.v or 0) - sum(r.v for r in shared)
    return Classes(
        {t: i for i, t in enumerate(own)},
        {r.start: len(own) + 1 + i for i, r in enumerate(shared)},
        known,
        totals,
        kinds,
        int(whole.n or 0),
        int(whole.v),
    )


class LogBilinear:
    """Parameters: context vectors (the last is before the text), class vectors, biases, a matrix per place."""

    def __init__(self, context, target, bias, first, second):
        self.context, self.target, self.bias, self.first, self.second = context, target, bias, first, second

    @classmethod
    def start(cls, classes: Classes, width: int = WIDTH) -> LogBilinear:
        """Small random vectors; biases that give the classes' own shares."""
        random = np.random.default_rng(SEED)
        share = (classes.totals + 0.5) / (classes.totals + 0.5).sum()
        draw = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
        eye = np.eye(width, dtype=np.float32)
        return cls(draw(classes.size + 1, width), draw(classes.size, width), np.log(share).astype(np.float32), eye, eye * 0.5)

    def rows(self) -> np.ndarray:
        """All parameters as rows of width + 1 numbers."""
        blocks = [np.pad(a, ((0, 0), (0, 1))) for a in (self.context, self.first, self.second)]
        return np.concatenate([np.concatenate((self.target, self.bias[:, None]), axis=1), *blocks])

    @classmethod
    def of_rows(cls, rows: np.ndarray, size: int, width: int = WIDTH) -> LogBilinear:
        rows = rows.astype(np.float32)
        target, context, first, second = np.split(rows, [size, 2 * size + 1, 2 * size + 1 + width])
        a, b = np.ascontiguousarray, slice(None, width)
        return cls(a(context[:, b]), a(target[:, b]), a(target[:, width]), a(first[:, b]), a(second[:, b]))

    def train(self, before2, before1, target, noise: np.ndarray, random) -> None:
        """One pass of noise-contrastive steps, Adagrad, over aligned class arrays."""
        size, (n_contexts, width) = len(self.target), self.context.shape
        log_noise = np.log(noise * NOISE).astype(np.float32)
        edges = np.cumsum(noise)
        # class vectors with their biases, and the matrices of both places, are a matrix each;
        # zeros that stay zeros make the rows of the first a length that products are fast at
        wide = width // 4 * 4 + 4
        context, outcome = self.context, np.zeros((size, wide), np.float32)
        outcome[:, :width], outcome[:, width] = self.target, self.bias
        both = np.concatenate((self.first, self.second), axis=1)
        states = [(a, np.full_like(a, 1e-3), np.empty_like(a)) for a in (context, outcome, both)]

        def step(k, g):
            a, kept, root = states[k]
            kept += np.multiply(g, g, out=root)
            np.sqrt(kept, out=root)
            g *= RATE
            g /= root
            a -= g

        # one step's large arrays, used again and again
        h, own = np.zeros((2, BATCH, wide), np.float32)
        h[:, width] = 1
        before = np.empty((BATCH, width), np.float32)
        wrong = np.empty((BATCH, NOISE), np.float32)
        push, push_places = np.empty((2, BATCH, width)), np.empty((2, BATCH, width), np.int64)
        pull, pull_places = np.empty((BATCH + NOISE, wide)), np.empty((BATCH + NOISE, wide), np.int64)
        # where a class's sums lie: as the context before, as the one before that, as the outcome
        first_cells = np.arange(n_contexts)[:, None] * (2 * width) + np.arange(width)
        second_cells = first_cells + width
        outcome_cells = np.arange(size * wide).reshape(size, wide)

        def take(a, rows, out):
            return np.take(a, rows, axis=0, out=out, mode="clip")

        for at in range(0, len(target), BATCH):
            i, j, t = (x[at : at + BATCH] for x in (before2, before1, target))
            n = len(t)
            if n < BATCH:
                h, own, before, wrong, pull, pull_places = h[:n], own[:n], before[:n], wrong[:n], pull[: n + NOISE], pull_places[: n + NOISE]
                push, push_places = np.empty((2, n, width)), np.empty((2, n, width), np.int64)
            drawn = np.minimum(np.searchsorted(edges, random.random(NOISE)), size - 1)
            np.add(take(context @ both[:, :width], j, before), (context @ both[:, width:])[i], out=h[:, :width])
            take(outcome, t, own)
            # a logistic function is half of one plus the tanh of the half
            up = np.tanh((np.einsum("bd,bd->b", h, own) - log_noise[t]) * 0.5)
            up -= 1
            up *= 0.5 / n
            others = outcome[drawn]
            others[:, width] -= log_noise[drawn]
            others *= 0.5
            down = np.matmul(h, others.T, out=wrong)
            np.tanh(down, out=down)
            down += 1
            # gradients of predictions, added up per context class before they meet the matrices
            gh = np.matmul(down, others[:, :width] / n, out=before)
            own *= up[:, None]
            gh += own[:, :width]
            push[:] = gh
            take(first_cells, j, push_places[0])
            take(second_cells, i, push_places[1])
            by_place = np.bincount(push_places.ravel(), weights=push.ravel(), minlength=n_contexts * 2 * width)
            by_place = by_place.reshape(n_contexts, 2 * width).astype(np.float32)
            np.multiply(h, up[:, None], out=pull[:n])
            np.multiply(down.T @ h, 0.5 / n, out=pull[n:])
            take(outcome_cells, t, pull_places[:n])
            take(outcome_cells, drawn, pull_places[n:])
            gt = np.bincount(pull_places.ravel(), weights=pull.ravel(), minlength=size * wide)
            gc = by_place @ both.T
            step(2, context.T @ by_place)
            step(0, gc)
            step(1, gt.reshape(size, wide).astype(np.float32))
        for name, a in (("target", outcome[:, :width]), ("bias", outcome[:, width]), ("first", both[:, :width]), ("second", both[:, width:])):
            setattr(self, name, np.ascontiguousarray(a))


def normalisers(model: LogBilinear, before2: np.ndarray) -> np.ndarray:
    """log of the summed weights of all classes, a row per class before the last one, a column per last class."""
    one, two = model.context @ model.first, model.context @ model.second
    rows = []
    for i in before2:
        s = (two[i] + one) @ model.target.T + model.bias
        top = s.max(axis=1)
        rows.append(top + np.log(np.exp(s - top[:, None]).sum(axis=1)))
    return np.array(rows, dtype=np.float32)


def _all_normalisers(spark: SparkSession, model: LogBilinear) -> np.ndarray:
    """The normalisers of all pairs of contexts, computed once; a number per pair of classes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"id": frame["id"], "norm": list(normalisers(model, frame["id"].to_numpy()))})

    n = len(model.context)
    found = spark.range(n).mapInPandas(run, "id long, norm array<float>").toPandas().sort_values("id")
    return np.array(found["norm"].tolist(), dtype=np.float32)


class Scorer:
    """Normalised log probabilities."""

    def __init__(self, model: LogBilinear, norm: np.ndarray):
        self.model, self.norm = model, norm
        self.one, self.two = model.context @ model.first, model.context @ model.second

    def log_probabilities(self, before2, before1, target) -> np.ndarray:
        h = self.two[before2] + self.one[before1]
        own = np.einsum("bd,bd->b", h, self.model.target[target]) + self.model.bias[target]
        return (own - self.norm[before2, before1]).astype(np.float64)


def _sequences(start: int, rows) -> Iterator[tuple]:
    """Blocks of class arrays, one per text, as (sizes, before2, before1, target)."""
    held: list[np.ndarray] = []
    size = 0

    def block():
        sizes = np.array([len(k) for k in held])
        # two classes from before the text, then its own, for all texts in a row
        flat = np.concatenate([x for k in held for x in (before, k)])
        ends = np.cumsum(sizes + 2)
        own = np.ones(len(flat), bool)
        own[ends - sizes - 2] = own[ends - sizes - 1] = False
        at = np.flatnonzero(own)
        held.clear()
        return sizes, flat[at - 2], flat[at - 1], flat[at]

    before = np.array([start, start], np.int32)
    for k in rows:
        held.append(k)
        size += len(k)
        if size >= CACHE:
            yield block()
            size = 0
    if held:
        yield block()


class _Tokens:
    """What a worker knows of tokens: a row of numbers each, looked up once per different token of a piece of texts."""

    def __init__(self, classes: Classes):
        known, self.end = classes.counts, classes.of(END)
        self.tokens = pa.array(list(known), pa.string())
        self.starts = pa.array(list(classes.shared), pa.string())
        # the last class is that of tokens without a start of their own
        self.start_kinds = np.array([*classes.shared.values(), len(classes.own)], np.int32)
        # with all counts at hand, a token without one is unseen; else its count comes from a join
        complete = len(known) == classes.distinct
        unseen = np.log10(0.5) if complete else 0.0
        logs = np.log10(np.array(list(known.values()), float) + 0.5)
        self.kind = np.array([*map(classes.of, known), 0], np.int32)
        self.log = np.array([*logs, unseen])
        self.shared = np.array([*(0.0 if t in classes.own else x for t, x in zip(known, logs)), unseen])
        self.seen = np.array([True] * len(known) + [False])
        self.open = np.array([False] * len(known) + [not complete])

    def columns(self, texts: pa.Array) -> list[pa.Array]:
        """n_tokens, n_known, base, inside, rest, times and ids of every text."""
        words, sizes = tokens_of(texts)
        coded = words.dictionary_encode()
        different = pa.concat_arrays([coded.dictionary, pa.array([END])])
        end = len(different) - 1
        # every text's tokens, with its end behind them
        sizes = sizes + 1
        ends = np.cumsum(sizes)
        own = np.full(ends[-1], end, np.int64)
        inner = np.ones(len(own), bool)
        inner[ends - 1] = False
        own[inner] = coded.indices.to_numpy()
        rows = _places(different, self.tokens)
        kinds = self.kind[rows]
        rare = np.flatnonzero(rows == len(self.tokens))
        starts = pc.utf8_slice_codeunits(different.take(pa.array(rare)), 0, 2)
        kinds[rare] = self.start_kinds[_places(starts, self.starts)]
        kinds[end] = self.end

        def sums(column: np.ndarray) -> pa.Array:
            return pa.array(np.add.reduceat(column[rows][own], ends - sizes, dtype=column.dtype if column.dtype != bool else np.int64))

        # the tokens whose counts are not at hand: text by text, how often each occurs
        at = np.flatnonzero(self.open[rows][own])
        text = np.repeat(np.arange(len(sizes)), sizes)[at]
        pairs, times = np.unique(text * len(different) + own[at], return_counts=True)
        cuts = pa.array(np.searchsorted(pairs, np.arange(len(sizes) + 1) * len(different)), pa.int32())
        rest = pa.ListArray.from_arrays(cuts, different.take(pa.array(pairs % len(different))))
        return [
            pa.array(sizes), sums(self.seen), sums(self.log), sums(self.shared), pc.binary_join(rest, " "),
            pa.ListArray.from_arrays(cuts, pa.array(times, pa.int64())),
            pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(kinds[own])),
        ]


def _places(values: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each value stands among others; their number, if it does not."""
    return pc.fill_null(pc.index_in(values, value_set=among), len(among)).to_numpy()


def _encoded(docs: DataFrame, classes: Classes) -> DataFrame:
    """Every text, tokenised once: its class ids, and its sums over the tokens whose counts are at hand.

    ``rest`` holds the other tokens, a blank between two, and ``times`` how often
    each occurs; their counts come from a join.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Tokens(classes)
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "inside", "rest", "times", "ids"]
        for batch in batches:
            for piece in _pieces(batch):
                yield pa.RecordBatch.from_arrays([*piece.columns[:2], *table.columns(piece.column("text"))], names)

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base double, inside double, "
        "rest string, times array<long>, ids array<int>"
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod("doc_id", 5) == 1).alias("held_out"), "text")
    return stored(rows.mapInArrow(run, schema).withColumn("uid", F.monotonically_increasing_id()), "encoded")


def _train(encoded: DataFrame, classes: Classes, rounds: int) -> LogBilinear:
    model = LogBilinear.start(classes)
    noise = (classes.totals + 0.5) / (classes.totals + 0.5).sum()
    names = [f"v{i}" for i in range(WIDTH + 1)]
    for k in range(rounds):
        now = model

        def run(frames: Iterator[pd.DataFrame], now=now, k=k) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext

            context = TaskContext.get()
            random = np.random.default_rng([SEED, k, context.partitionId() if context else 0])
            own = LogBilinear.of_rows(now.rows(), classes.size)
            seen = 0
            for _, two, one, target in _sequences(classes.size, (k for frame in frames for k in frame["ids"])):
                order = random.permutation(len(target))
                own.train(two[order], one[order], target[order], noise, random)
                seen += len(target)
            if seen:
                out = pd.DataFrame(own.rows().astype(float) * seen, columns=names)
                yield out.assign(row=np.arange(len(out)), weight=float(seen))

        schema = ", ".join(f"{n} double" for n in names) + ", row long, weight double"
        parts = encoded.where(~F.col("held_out")).select("ids").mapInPandas(run, schema).groupBy("row")
        mean = parts.agg(*[(F.sum(n) / F.sum("weight")).alias(n) for n in names]).orderBy("row").toPandas()
        if len(mean):
            model = LogBilinear.of_rows(mean[names].to_numpy(), classes.size)
    return model


def score_texts(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per input row with base and model scores.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score. Learns from rows whose crc32 of the id as text modulo 5 is not 1.
    A NULL text is empty and has the end token alone. Repeated rows and NULL
    ids are rows like others; further columns are not read; an empty table
    gives an empty result, and without training rows every token is unseen.
    """
    train = short_batches(docs).where(crc_mod("doc_id", 5) != 1).select("text")
    counts = stored(_counts(train), "counts")
    classes = _classes(counts)
    encoded = _encoded(docs, classes)
    model = _train(encoded, classes, rounds)
    norm = _all_normalisers(docs.sparkSession, model)
    mass = float(np.log10(classes.tokens + 0.5 * (classes.distinct + 1)))
    ten = float(np.log(10))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model, norm)
        inner = np.array([0.0 if k < len(classes.own) else classes.inner(k) for k in range(classes.size)]) / ten
        for frame in frames:
            sums = [np.zeros(0)]
            for sizes, two, one, target in _sequences(classes.size, frame.pop("ids")):
                logs = scorer.log_probabilities(two, one, target) / ten - inner[target]
                sums.append(np.add.reduceat(logs, np.cumsum(sizes) - sizes))  # no text is without its end
            yield frame.assign(score=np.concatenate(sums))

    names = ["uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "inside"]
    schema = "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inside double, score double"
    rows = encoded.select(*names, "ids").mapInPandas(run, schema)
    rows = rows.withColumn("base_score", F.col("base") - F.col("n_tokens") * F.lit(mass)).withColumn("score", F.col("score") + F.col("inside"))
    rest = F.arrays_zip(F.split("rest", " ").alias("token"), F.col("times").alias("n"))
    rare = encoded.where(F.size("times") > 0).select("uid", F.inline(rest)).join(counts.withColumnRenamed("n", "c"), "token", "left")
    c = F.coalesce("c", F.lit(0))
    log = F.col("n") * F.log10(c + F.lit(0.5))
    sums = rare.groupBy("uid").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("known"), F.sum(log).alias("log")
    )
    out = rows.join(sums, "uid", "left")
    log = F.coalesce("log", F.lit(0.0))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(classes.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + log).alias("base_score"),
        (F.col("score") + log).alias("score"),
    )
