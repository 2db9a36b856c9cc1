"""Toxicity scores of texts whose obfuscation a noisy-channel decoder has undone.

A token that is not plain letters becomes a lattice of characters: leetspeak
characters may stand for letters, repeated characters may stand for fewer, and
separators may stand for nothing. Neighbouring tokens of at most ``PIECE``
characters are one lattice. A Viterbi search
takes the path that a character trigram model of the corpus and the costs of
the channel together find likeliest. Words of the restored text carry weights
learned from labelled rows (how much likelier a word start is in toxic text),
and a logistic regression turns a document's weights into a score.

The character model counts all documents. Weights and regression are fitted on
at most ``SAMPLE_ROWS`` labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import crc_mod, fresh, short_batches, stored

#: Bound of the labelled rows that the classifier is fitted on: those with the smallest id hashes.
SAMPLE_ROWS = 20_000
#: Rejected from this score on.
THRESHOLD = 0.7
#: Share of all trigrams below which the character model drops one; bounds the model to its inverse.
RARE = 1e-6
#: Least likelihood ratio statistic of a word start that gets a weight.
SURE = 18.0
#: Tokens whose outcome a worker remembers at a time.
CACHE = 100_000
#: Longest run of pieces, in characters, whose reading is remembered.
LONG = 100
#: Different words whose trigrams are counted at a time.
BLOCK = 50_000

# Letters that a leetspeak character can stand for, and separators used for spacing.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = " .-_*,'~/"
#: Longest piece of a word that is cut by white space; within a token pieces have any length.
PIECE = 3
# Log costs of the channel.
SUBSTITUTED = -1.5
REPEATED = -1.0
SPACED = -0.4

_RUN = re.compile(r"(.)\1*", re.S)
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_MIXED = re.compile(r"[^\W\d_][\d@$!|+(€£¡]|[\d@$!|+(€£¡][^\W\d_]")
_LETTERS = re.compile(r"[^\W\d_]+")
# What spacing can cut a word into, from the channel's own characters: pieces, and the separators between them.
_UNIT = rf"(?:[^\W_]|[{re.escape(''.join(c for c in LEET if not c.isalnum()))}])"
_GAP = rf"[\s{re.escape(SEPARATORS)}]+"
_CUT = re.compile(rf"{_UNIT}{_GAP}{_UNIT}")
_GAPS = re.compile(_GAP)
_LEAD = re.compile(rf"\W*?({_UNIT}{{1,{PIECE}}})(?!{_UNIT})")
_TRAIL = re.compile(rf"(?<!{_UNIT})({_UNIT}{{1,{PIECE}}})[\W_]*$")
_WHOLE = re.compile(rf"[\W_]*?{_UNIT}{{1,{PIECE}}}(?:{_GAP}{_UNIT}{{1,{PIECE}}})*[\W_]*")
# tokens' kinds: A short pieces only, T its end is one, L its start is one, X both, n none
_TOGETHER = re.compile(r"(?=((?:[TX]|(?<![TXA])A)A*[LXA]))")


#: Characters from here on are one symbol for the model.
_BEYOND = 0x250
_OTHER = "¤"


def _plain(c: str) -> str:
    return c if ord(c) < _BEYOND else _OTHER


def _trigram_counts(words: Counter) -> pd.DataFrame:
    """Trigrams of each word with two spaces before and one behind, counted as often as the word."""
    names = list(words)
    if not names:
        return pd.DataFrame({"gram": pd.Series([], dtype=object), "n": np.zeros(0)})
    chars = np.frombuffer(f"  {'  '.join(names)}  ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int32)
    chars[chars >= _BEYOND] = ord(_OTHER)
    space = chars == 32
    word = np.cumsum(space[:-2] & space[1:-1], dtype=np.int32) - 1
    inside = ~(space[1:-1] & space[2:])
    keys = (chars[:-2] << 20 | chars[1:-1] << 10 | chars[2:])[inside]
    times = np.array([words[w] for w in names], dtype=float)[word[inside]]
    keys, where = np.unique(keys, return_inverse=True)
    grams = ["".join(map(chr, (k >> 20, k >> 10 & 1023, k & 1023))) for k in keys.tolist()]
    return pd.DataFrame({"gram": pd.Series(grams, dtype=object), "n": np.bincount(where, weights=times)})


class CharacterModel:
    """Interpolated trigrams of characters within words, a space at either end."""

    def __init__(self, counts: dict[str, float]):
        tri, bi, uni = dict(counts), Counter(), Counter()
        ab = Counter()
        for g, n in tri.items():
            ab[g[:2]] += n
            bi[g[1:]] += n
            uni[g[2]] += n
        b = Counter()
        for g, n in bi.items():
            b[g[0]] += n
        self.tri, self.ab, self.bi, self.b, self.uni = tri, ab, bi, b, uni
        self.total = sum(uni.values()) + 1.0
        self.known: dict[str, float] = {}

    def log(self, g: str) -> float:
        """log P(g[2] | g[:2])."""
        p = self.known.get(g)
        if p is None:
            one = (self.uni.get(g[2], 0) + 0.01) / (self.total + 10)
            two = (self.bi.get(g[1:], 0) + 2 * one) / (self.b.get(g[1], 0) + 2)
            p = self.known[g] = math.log((self.tri.get(g, 0) + 2 * two) / (self.ab.get(g[:2], 0) + 2))
        return p

    def decode(self, token: str) -> str:
        """The likeliest reading of a token's lattice, words apart by spaces."""
        best: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
        for m in _RUN.finditer(token + " "):
            after: dict[str, tuple[float, tuple | None]] = {}
            for out, cost in _readings(m[1], len(m[0])):
                for state, (score, path) in best.items():
                    s, t = score + cost, state
                    for c in out:
                        if c == " " and t[1] == " ":
                            continue
                        c = _plain(c)
                        s += self.log(t + c)
                        t = t[1] + c
                        if c == " ":
                            t = "  "
                    if t not in after or s > after[t][0]:
                        after[t] = (s, (path, out))
            best = after
        path = max(best.values(), key=lambda x: x[0])[1]
        parts = []
        while path is not None:
            path, out = path
            parts.append(out)
        return "".join(reversed(parts)).strip()


def _readings(c: str, n: int) -> list[tuple[str, float]]:
    """What a run of n equal characters can stand for, with the cost."""
    if c in LEET:
        own = [(c if n == 1 else c * min(n, 3), 0.0)]
        for letter in LEET[c]:
            own.append((letter, SUBSTITUTED + (REPEATED if n > 1 else 0)))
            if n > 1:
                own.append((letter * 2, 2 * SUBSTITUTED))
        return own
    if c.isalnum():
        if n == 1:
            return [(c, 0.0)]
        return [(c, REPEATED), (c * 2, 0.0 if n == 2 else REPEATED)]
    if c in SEPARATORS or c.isspace():
        return [(" ", 0.0), ("", SPACED)]
    return [(" ", 0.0)]


def _token_words(token: str, model: CharacterModel) -> tuple[str, ...]:
    if token.isalpha() and not _TRIPLE.search(token):
        return (token,)
    core = _EDGE.sub("", token)
    if core.isalpha() and not _TRIPLE.search(core):
        if token[-1] not in LEET and token[0] not in LEET:
            return (core,)
        core = token
    elif token[0] in LEET or token[-1] in LEET:
        core = token
    if _MIXED.search(core) or _TRIPLE.search(core) or _CUT.search(core):
        return tuple(dict.fromkeys(_LETTERS.findall(core) + _LETTERS.findall(model.decode(core))))
    return tuple(_LETTERS.findall(core))


def _kind(token: str) -> str:
    """How a token can be part of a word that white space cuts, as in ``_TOGETHER``."""
    if len(token) > PIECE and token.isalpha():
        return "n"
    if _WHOLE.fullmatch(token):
        return "A"
    return "nLTX"[bool(_LEAD.match(token)) + 2 * bool(_TRAIL.search(token))]


class Restorer:
    """text -> (words of the restored text with counts, number of tokens)."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.cache: dict[str, tuple[str, ...]] = {}
        self.kinds: dict[str, str] = {}
        self.runs: dict[str, tuple[str, ...]] = {}

    def kind(self, token: str) -> str:
        found = self.kinds.get(token)
        if found is None:
            if len(self.kinds) >= CACHE:
                self.kinds.clear()
            found = self.kinds[token] = _kind(token)
        return found

    def spaced(self, tokens: list[str]) -> list[tuple[int, str]]:
        """Runs of short pieces in neighbouring tokens, each with its first token's place."""
        found = []
        for m in _TOGETHER.finditer("".join(map(self.kind, tokens))):
            run = tokens[m.start(1) : m.end(1)]
            if m[1][0] != "A":
                run[0] = _TRAIL.search(run[0])[0]
            if m[1][-1] != "A":
                run[-1] = _LEAD.match(run[-1])[0]
            found.append((m.start(1), " ".join(run)))
        return found

    def joined(self, run: str) -> tuple[str, ...]:
        """Words of a run's likeliest reading that are not among its pieces."""
        found = self.runs.get(run)
        if found is None:
            if len(self.runs) >= CACHE:
                self.runs.clear()
            pieces = set(_LETTERS.findall(run))
            # a character at a token's edge may be a letter or a mark around the word
            bare = " ".join(filter(None, (_EDGE.sub("", t) for t in run.split())))
            readings = dict.fromkeys((run, bare))
            read = [self.model.decode(r) for r in readings]
            found = tuple(dict.fromkeys(w for r in read for w in _LETTERS.findall(r) if w not in pieces))
            if len(run) <= LONG:
                self.runs[run] = found
        return found

    def tokens(self, text: str | None) -> list[str]:
        tokens = (text or "").lower().split()
        return tokens + [w for _, run in self.spaced(tokens) for w in self.joined(run)]

    def words(self, token: str) -> tuple[str, ...]:
        found = self.cache.get(token)
        if found is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            found = self.cache[token] = _token_words(token, self.model)
        return found


def features(word: str) -> list[str]:
    """The word and its starts, each repeated character once; the word itself ends in a mark."""
    word = _RUN.sub(r"\1", word)
    return [word[:n] for n in range(3, min(len(word), 8))] + [word + "$"]


def _character_counts(docs: DataFrame) -> dict[str, float]:
    """Trigram counts over all documents, those above ``RARE``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()

        for frame in frames:
            for text in frame["text"]:
                words.update((text or "").lower().split())
                if len(words) >= BLOCK:
                    yield _trigram_counts(words)
                    words.clear()
        yield _trigram_counts(words)

    counts = docs.select("text").mapInPandas(run, "gram string, n double").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = stored(counts, "trigrams")
    least = RARE * (counts.agg(F.sum("n")).first()[0] or 0)
    return {r.gram: r.n for r in counts.where(F.col("n") >= least).toLocalIterator()}


def _weights(sample: DataFrame, model: CharacterModel) -> dict[str, float]:
    """Word starts that are surely likelier in toxic rows -> log ratio of their rates."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer, tf, df = Restorer(model), (Counter(), Counter()), (Counter(), Counter())

        def rows() -> pd.DataFrame:
            out = [(f, t, tf[t][f], df[t][f]) for t in (0, 1) for f in df[t]]
            for c in (*tf, *df):
                c.clear()
            return pd.DataFrame(out, columns=["f", "toxic", "tf", "df"]).astype({"f": object})

        for frame in frames:
            for text, toxic in zip(frame["text"], frame["toxic"]):
                own: Counter = Counter()
                for token, n in Counter(restorer.tokens(text)).items():
                    for w in restorer.words(token):
                        for f in features(w):
                            own[f] += n
                own[""] += 1
                tf[toxic].update(own)
                df[toxic].update(own.keys())
                if len(df[0]) >= CACHE:
                    yield rows()
        yield rows()

    parts = sample.mapInPandas(run, "f string, toxic int, tf double, df double").groupBy("f").pivot("toxic", [0, 1])
    sums = parts.agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")).na.fill(0.0)
    sums = stored(sums.select("f", *[F.col(f"{t}_{c}").alias(f"{c}{t}") for t in (0, 1) for c in ("tf", "df")]), "starts")
    whole = sums.where("f = ''").first()
    if whole is None or not whole.df0 or not whole.df1:
        return {}
    words = sums.where("f like '%$'").agg(F.sum("tf0").alias("n0"), F.sum("tf1").alias("n1")).first()
    # likelihood ratio test of the rows that have the start, toxic or not
    share = (F.col("df0") + F.col("df1")) / (whole.df0 + whole.df1)
    sure = F.lit(0.0)
    for column, rows in (("df0", whole.df0), ("df1", whole.df1)):
        for seen, wanted in ((F.col(column), share * rows), (rows - F.col(column), (1 - share) * rows)):
            sure = sure + F.when((seen > 0) & (wanted > 0), 2 * seen * F.log(seen / wanted)).otherwise(0.0)
    ratio = F.log((F.col("tf1") + 0.5) / (F.col("tf0") + 0.5) * F.lit((words.n0 + 1) / (words.n1 + 1)))
    kept = sums.where((F.col("f") != "") & (sure >= SURE) & (ratio >= 1.5))
    # bounded by the sample's words
    found = {r.f: (min(r.w, 6.0), r.tf1) for r in kept.select("f", "tf1", ratio.alias("w")).toLocalIterator()}
    # a start that one of its continuations accounts for says no more than that one
    shorter = {f: f[: -2 if f.endswith("$") else -1] for f in found}
    covered = {s for f, s in shorter.items() if s in found and found[f][1] >= 0.9 * found[s][1]}
    return {f: w for f, (w, _) in found.items() if f not in covered}


def _gate(starts) -> re.Pattern:
    """Finds the places of a lower-cased text where some reading may have a word with one of the starts.

    A letter of a start is written by itself or by a character that the channel
    lets stand for it, any number of times, with marks anywhere between (some are
    separators, others are cut off a token's edge). No letter stands before the word, and none behind a start that is a whole word,
    as letters never vanish. Matches are empty, so that none hides another.
    """
    letters: dict[str, str] = {}
    for sign, read in LEET.items():
        for c in read:
            letters[c] = letters.get(c, "") + sign
    # as a tree, so that a place is given up at the first character that fits no start
    tree: dict = {}
    for start in sorted(starts):
        at = tree
        for c in start:
            at = at.setdefault(c, {})
        at[""] = {}

    def pattern(node: dict) -> str:
        longer = []
        for c, more in node.items():
            if c == "$":
                longer.append(r"(?![^\W\d_])")
            elif c:
                signs = re.escape(c + letters.get(c, ""))
                longer.append(f"[{signs}][{signs}\\W_]*{pattern(more)}")
        # a start that goes on as a longer one needs no look at that one
        return "" if "" in node else "(?:" + "|".join(longer) + ")"

    signs = "".join(sorted({x for c in tree for x in c + letters.get(c, "")}))
    if not tree:
        return re.compile(r"(?!)")
    return re.compile(rf"(?=[{re.escape(signs)}])(?<![^\W\d_])(?={pattern(tree)})")


class Weigher:
    """text -> the regression's inputs."""

    def __init__(self, model: CharacterModel, weights: dict[str, float]):
        self.restorer, self.weights = Restorer(model), weights
        self.gate = _gate(weights)
        self.starts = {f[:3] for f in weights}
        self.cache: dict[str, float] = {}

    def weight(self, token: str) -> float:
        w = self.cache.get(token)
        if w is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[token] = w = self._weight(token)
        return w

    def _weight(self, token: str) -> float:
        start = token[:3]
        if len(token) > 3 and start not in self.starts and start[0] != start[1] != start[2]:
            if token.rstrip(".,;:!?\"").isalpha():
                return 0.0  # plain letters, and no start that weighs
        if not self._can_weigh(token):
            return 0.0
        return self._most(_token_words(token, self.restorer.model))

    def _most(self, words: tuple[str, ...]) -> float:
        return max((self.weights.get(f, 0.0) for x in words for f in features(x)), default=0.0)

    def _can_weigh(self, text: str) -> bool:
        """False only if no reading of letters and separators has a start that weighs: words begin at a piece."""
        pieces = _GAPS.split(_EDGE.sub("", text))
        joined = "".join(pieces)
        if not joined.isalpha() or text[0] in LEET or text[-1] in LEET:
            return True
        at = 0
        for piece in pieces:
            start = _RUN.sub(r"\1", joined[at : at + 12])
            if start[:3] in self.starts or start[:2] + "$" in self.starts or start[:1] + "$" in self.starts:
                return True
            if len(start) < 3 and at + 12 < len(joined):
                return True
            at += len(piece)
        return False

    def _window(self, tokens: list[str], i: int) -> tuple[int, int]:
        """The tokens around the i-th that can be in one run of short pieces with it."""
        kind = self.restorer.kind
        first, last = i, i + 1
        while first > 0:
            first -= 1
            if kind(tokens[first]) != "A":
                break
        while last < len(tokens):
            last += 1
            if kind(tokens[last - 1]) != "A":
                break
        return first, last

    def found(self, text: str) -> tuple[list[float], int]:
        """Weights that are not zero, of tokens and of runs of tokens, and the number of tokens.

        Only what the gate finds is looked at: no other token or run weighs.
        """
        tokens = text.lower().split()
        line = " ".join(tokens)
        weights, seen, runs = [], -1, set()
        i = at = done = 0
        for m in self.gate.finditer(line):
            start = m.start()
            i, at = i + line.count(" ", at, start), start
            if i > seen:  # a token counts once
                seen = i
                if w := self.weight(tokens[i]):
                    weights.append(w)
            # words that white space cuts into short pieces
            if i >= done:
                first, done = self._window(tokens, i)
                runs.update((first + k, run) for k, run in self.restorer.spaced(tokens[first:done]))
                done = max(done - 1, i + 1)
        for _, run in sorted(runs):
            if self._can_weigh(run):
                weights += filter(None, (self._most((w,)) for w in self.restorer.joined(run)))
        return weights, len(tokens)

    def inputs(self, text: str | None) -> list[float]:
        found, n = self.found(text or "")
        k = sum(found)
        return [1.0, math.log1p(k), math.log1p(100 * k / max(n, 1)), float(len(found) >= 2), math.log1p(n)]


def _regression(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class ToxicityModel:
    """A fitted model; ``score`` maps a text column."""

    def __init__(self, counts: dict[str, float], weights: dict[str, float], regression: np.ndarray):
        self.counts, self.weights, self.regression = counts, weights, regression

    def score(self, text):
        counts, weights, regression = self.counts, self.weights, self.regression

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            weigher = Weigher(CharacterModel(counts), weights)
            for texts in batches:
                x = np.array([weigher.inputs(t) for t in texts]).reshape(len(texts), len(regression))
                yield pd.Series(1 / (1 + np.exp(-np.clip(x @ regression, -30, 30))))

        return run(text)


def _sample(docs: DataFrame, picked: DataFrame, rows: int) -> DataFrame:
    """``(text, toxic)`` of the picked ids, one row per id and text; ``rows`` at most, those with the smallest hashes."""
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "text", "toxic").distinct()
    found = stored(found.withColumn("at", F.struct(F.xxhash64("doc_id").alias("i"), F.xxhash64("text").alias("t"))), "sample")
    if found.count() > rows:
        last = found.select("at").orderBy("at").limit(rows).agg(F.max("at").alias("at")).first().at
        found = found.where(F.col("at") <= F.struct(F.lit(last.i), F.lit(last.t)))
    return found.select("text", "toxic")


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on the rows of ``docs(doc_id, text)`` that ``labels(doc_id, toxic)`` marks, ``rows`` at most.

    NULL labels and ids teach nothing; a doc_id with several labels is toxic
    if one of them says so. Without rows of both kinds every text gets the
    share of toxic rows (0 without any).
    """
    counts = _character_counts(docs)
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
    known = known.agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    picked = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "picked")
    sample = _sample(docs, picked, rows)
    model = CharacterModel(counts)
    weights = _weights(sample, model)

    def inputs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weigher = Weigher(CharacterModel(counts), weights)
        for frame in frames:
            rows = [weigher.inputs(t) + [float(y)] for t, y in zip(frame["text"], frame["toxic"])]
            yield pd.DataFrame(rows, columns=["a", "b", "c", "d", "e", "y"])

    table = sample.mapInPandas(inputs, "a double, b double, c double, d double, e double, y double").toPandas()
    x, y = table[["a", "b", "c", "d", "e"]].to_numpy(float), table["y"].to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        flat = np.zeros(5)
        flat[0] = 30.0 if len(y) and y[0] else -30.0
        return ToxicityModel(counts, {}, flat)
    return ToxicityModel(counts, weights, _regression(x, y))


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, held_out, score, predicted)``, one row per input row.

    A NULL text is empty. Scores come from the text alone. Further columns are
    not read; an empty table gives an empty result.
    """
    model = _fit_split(docs, labels, rows)
    scored = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (crc_mod("doc_id", 3) == 1).alias("held_out"),
        model.score(F.col("text")).alias("score"),
    )
    return scored.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _fit_split(docs: DataFrame, labels: DataFrame, rows: int) -> ToxicityModel:
    teach = labels.where(crc_mod("doc_id", 3) != 1)
    return fit_toxicity(short_batches(docs).select("doc_id", "text"), teach, rows)


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``THRESHOLD``."""
    score = fresh(docs, "score")
    model = _fit_split(docs, labels, rows)
    return docs.withColumn(score, model.score(F.col("text"))).where(F.col(score) < THRESHOLD).select(*docs.columns)
