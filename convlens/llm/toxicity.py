"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another. The model of a category sees the
text's features and the probabilities of all earlier categories. While
training, those probabilities are out of fold, so a later model learns from
values like the ones it will be given.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence
from copy import copy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from xxhash import xxh64_intdigest as digest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.session import stage

#: Lengths of the word beginnings that are features beside the words.
PREFIXES = (4, 5, 6)
#: A feature counts as seen once, twice, and so on up to this.
TIMES = 3
#: Characters of words remembered by one Python worker before it starts afresh.
MEMORY = 2_000_000


def _parts(word: str) -> list[str]:
    return [f"={word}", *[word[:n] for n in PREFIXES if len(word) > n]]


def _id(part: str, times: int) -> int:
    return digest(part, times) - (1 << 63)


def features(text: str | None) -> set[int]:
    """Hashed features of a whole text: words and word beginnings, each by how often it is seen."""
    seen = Counter()
    for word, n in Counter(re.findall(r"\w+", (text or "").lower())).items():
        for part in _parts(word):
            seen[part] += n
    return {_id(part, k) for part, n in seen.items() for k in range(1, min(n, TIMES) + 1)}


class Finder:
    """The known features of texts, looked up word by word with a bounded memory.

    A part of a word is known if its first sighting is: a text that holds it n times holds its earlier sightings too.
    """

    def __init__(self, known: Sequence[int]):
        self.known = np.asarray(known, np.int64)
        self.none = len(self.known)  # stands for an unknown feature
        #: The columns of a part's later sightings, by the column of its first.
        self.later = np.full((self.none + 1, TIMES - 1), self.none, np.int32)
        self.fresh = np.arange(self.none + 1) < self.none
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        self.held = 0
        self.first = np.empty((1 << 10, 1 + len(PREFIXES)), np.int32)

    def _columns(self, ids: list[int]) -> np.ndarray:
        wanted = np.array(ids, np.int64)
        at = np.searchsorted(self.known, wanted)
        found = at < self.none
        found[found] = self.known[at[found]] == wanted[found]
        return np.where(found, at, self.none)

    def _learn(self, words: list[str]) -> None:
        n = len(self.row)
        while len(self.first) < n + len(words):
            self.first = np.concatenate([self.first, np.empty_like(self.first)])
        parts = [part for word in words for part in _parts(word)]
        first = self._columns([_id(part, 1) for part in parts])
        long = np.array(list(map(len, words)))[:, None] > np.array((-1, *PREFIXES))
        block = self.first[n : n + len(words)]
        block[:] = self.none
        block[long] = first
        new = np.flatnonzero(self.fresh[first])
        for k in range(2, TIMES + 1):
            self.later[first[new], k - 2] = self._columns([_id(parts[i], k) for i in new])
        self.fresh[first[new]] = False
        self.row.update(zip(words, range(n, n + len(words))))
        self.held += sum(map(len, words))

    def columns(self, text: str | None) -> np.ndarray:
        counted = Counter(re.findall(r"\w+", (text or "").lower()))
        if not counted or not self.none:
            return np.empty(0, np.int32)
        new = [word for word in counted if word not in self.row]
        if new and self.held + sum(map(len, new)) > MEMORY:
            self._clear()
            new = list(counted)
        if new:
            self._learn(new)
        parts = self.first[np.fromiter(map(self.row.__getitem__, counted), np.int64, len(counted))]
        times = np.repeat(np.fromiter(counted.values(), np.int64, len(counted)), parts.shape[1])
        parts = parts.ravel()
        order = np.argsort(parts, kind="stable")
        parts, times = parts[order], times[order]
        starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]])
        parts, times = parts[starts], np.add.reduceat(times, starts)
        found = np.concatenate([parts, *[self.later[parts[times >= k], k - 2] for k in range(2, TIMES + 1)]])
        return found[found < self.none]


# --- the linear models ----------------------------------------------------


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


#: Places of a sparse table worked on together.
ENTRIES = 1 << 19


class Rows:
    """A sparse table, zero or its column's scale in each place, beside a few dense columns and a constant one at the end."""

    def __init__(self, column: np.ndarray, size: np.ndarray, width: int, extra: np.ndarray | None = None):
        self.column, self.size, self.width = column, size, width
        self.row = np.repeat(np.arange(len(size), dtype=np.int32), size)
        self.extra = np.empty((len(size), 0)) if extra is None else extra
        self.scale = np.ones(width)

    @classmethod
    def of(cls, x: np.ndarray | Rows) -> Rows:
        if isinstance(x, cls):
            return x
        row, column = np.nonzero(x)
        return cls(column, np.bincount(row, minlength=len(x)), x.shape[1])

    def __len__(self) -> int:
        return len(self.size)

    def _sums(self, key: np.ndarray, n: int, values: np.ndarray, of: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        for at in range(0, len(key), ENTRIES):  # some at a time, for the memory
            part = slice(at, at + ENTRIES)
            out += np.bincount(key[part], values[of[part]], n)
        return out

    def times(self, w: np.ndarray) -> np.ndarray:
        sparse = self._sums(self.row, len(self), w[: self.width] * self.scale, self.column)
        return sparse + self.extra @ w[self.width : -1] + w[-1]

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.r_[self._sums(self.column, self.width, g, self.row) * self.scale, g @ self.extra, g.sum()]

    def scaled(self, y: np.ndarray) -> Rows:
        """Columns at the size of their log ratio of frequencies in the two classes, so that telling ones are penalised less."""
        n = [self._sums(self.column, self.width, (y == k).astype(float), self.row) for k in (0, 1)]
        shares = [(1 + n[k]) / (1 + (y == k).sum()) for k in (0, 1)]
        out = copy(self)
        out.scale = np.abs(np.log(shares[1] / shares[0]))
        return out

    def take(self, mask: np.ndarray) -> Rows:
        return Rows(self.column[mask[self.row]], self.size[mask], self.width, self.extra[mask])

    def beside(self, column: np.ndarray) -> Rows:
        out = copy(self)
        out.extra = np.hstack([self.extra, column[:, None]])
        return out


def dot(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.einsum("i,i", a, b))  # one thread: the driver's other cores are not its own


#: Steps the solver remembers, and how far a fit goes: the gradient's norm against that at zero weights.
STEPS, TOLERANCE = 10, 1e-4


def fit_linear(
    x: np.ndarray | Rows, y: np.ndarray, weight: np.ndarray, l2: float, rounds: int = 1000,
    tolerance: float = TOLERANCE, start: np.ndarray | None = None,
) -> np.ndarray:
    """Weighted logistic regression by L-BFGS; the intercept comes last, unpenalised.

    It begins at `start` or zero, ends when the gradient's norm is at most
    `tolerance` times that at zero weights, and raises if `rounds` do not get
    there.
    """
    x, y = Rows.of(x), np.asarray(y, float)
    weight = np.asarray(weight, float) / weight.sum()

    def loss(w):
        z = x.times(w)
        grad = x.back(weight * (sigmoid(z) - y))
        grad[:-1] += l2 * w[:-1]
        return weight @ (np.logaddexp(0, z) - y * z) + l2 / 2 * dot(w[:-1], w[:-1]), grad

    w = np.zeros(x.width + x.extra.shape[1] + 1)
    value, grad = loss(w)
    goal, past = tolerance * dot(grad, grad) ** 0.5, []
    if start is not None:
        w = start
        value, grad = loss(w)
    for _ in range(rounds):
        if dot(grad, grad) ** 0.5 <= goal:
            return w
        move, kept = -grad, []
        for s, d, r in reversed(past):
            kept.append(r * dot(s, move))
            move = move - kept[-1] * d
        if past:
            s, d, r = past[-1]
            move = move / (r * dot(d, d))
        for (s, d, r), a in zip(past, reversed(kept)):
            move = move + (a - r * dot(d, move)) * s
        step, slope = 1.0 if past else min(1.0, 1 / dot(grad, grad) ** 0.5), dot(grad, move)
        while True:
            new_value, new = loss(w + step * move)
            if new_value <= value + 1e-4 * step * slope or step < 1e-12:
                break
            step /= 2
        s, d = step * move, new - grad
        if dot(s, d) > 1e-12 * dot(d, d):
            past = [*past[1 - STEPS :], (s, d, 1 / dot(s, d))]
        w, value, grad = w + s, new_value, new
    if dot(grad, grad) ** 0.5 <= goal:
        return w
    raise RuntimeError(f"no fit to {tolerance} in {rounds} rounds")


def fit_category(
    x: Rows, y, weight, l2: float, rounds: int, tolerance: float, start: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Weights for plain and for scaled columns; the fit is made on the scaled ones, from `start`."""
    x = x.scaled(y)
    w = fit_linear(x, y, weight, l2, rounds, tolerance, start)
    return np.r_[w[: x.width] * x.scale, w[x.width :]], w


def predict(x: np.ndarray | Rows, w: np.ndarray) -> np.ndarray:
    return sigmoid(Rows.of(x).times(w))


def out_of_fold(
    x: Rows, y, weight, folds: int, fold: np.ndarray, l2s: Sequence[float], rounds: int, tolerance: float
) -> np.ndarray:
    """The probabilities of each row by models that did not see the row's fold: one line for each penalty."""
    held = np.empty((len(l2s), len(x)))
    for k in range(folds):
        out = fold == k
        if out.any():
            rest, w = ~out if (~out).any() else out, None
            here, seen = x.take(out), x.take(rest)
            for i, l2 in enumerate(l2s):
                plain, w = fit_category(seen, y[rest], weight[rest], l2, rounds, tolerance, w)
                held[i, out] = predict(here, plain)
    return held


def fit_chain(
    x, ys, weight, folds: int, fold: np.ndarray, l2: float | Sequence[float], rounds: int, tolerance: float = TOLERANCE
) -> list[np.ndarray]:
    """One model per category; later ones are trained on out-of-fold probabilities of earlier ones.

    Of several penalties, strongest first, each category takes the one of the smallest out-of-fold loss.
    """
    models, x, l2s = [], Rows.of(x), np.atleast_1d(l2)
    for j, y in enumerate(ys.T):
        best = 0
        if len(l2s) > 1 or j + 1 < ys.shape[1]:
            held = np.clip(out_of_fold(x, y, weight, folds, fold, l2s, rounds, tolerance), 1e-12, 1 - 1e-12)
            best = int(np.argmin(-(y * np.log(held) + (1 - y) * np.log(1 - held)) @ weight))
        models.append(fit_category(x, y, weight, l2s[best], rounds, tolerance)[0])
        if j + 1 < ys.shape[1]:
            x = x.beside(held[best])
    return models


@dataclass
class Chain:
    """Known features, category names, and one weight vector per category."""

    known: Sequence[int]
    names: list[str]
    models: list[np.ndarray]

    def probabilities(self, finder: Finder, texts: Iterable[str | None]) -> np.ndarray:
        """(texts, categories), each category seeing the ones before it."""
        n = len(self.known)
        sums = []
        for text in texts:
            found = finder.columns(text)
            sums.append([w[found].sum() for w in self.models])
        z = np.array(sums).reshape(-1, len(self.models))
        out = np.zeros(z.shape)
        for j, w in enumerate(self.models):
            out[:, j] = sigmoid(z[:, j] + out[:, :j] @ w[n:-1] + w[-1])
        return out


# --- on tables ------------------------------------------------------------


def fit(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, str],
    balance: str,
    id_col: str = "doc_id",
    text: str = "text",
    rows_per_class: int = 3000,
    folds: int = 3,
    l2: float | Sequence[float] = 1e-5,
    rounds: int = 1000,
    tolerance: float = TOLERANCE,
) -> Chain:
    """Fit a chain on a bounded sample of labelled documents.

    Categories and `balance` are SQL conditions over the label table. At most
    `rows_per_class` rows of each value of `balance` are used, those with
    the lowest hash of their id; weights restore the classes' true shares. All
    features of the sampled texts are known to the models. Several penalties
    `l2` are compared out of fold. Rows with a null id
    or category train nothing. An id labelled more than once has a category if
    all its labels say so, and one with several texts the smallest of them.
    Without labels every probability is 0.5.
    """
    names = list(categories)
    marked = labels.select(
        F.col(id_col).alias("_id"), F.expr(balance).cast("int").alias("_class"),
        *[F.expr(c).cast("int").alias(n) for n, c in categories.items()],
    ).dropna().groupBy("_id").agg(*[F.min(n).alias(n) for n in ("_class", *names)])
    totals = marked.groupBy("_class").count()
    picks = [
        marked.filter(F.col("_class") == k).orderBy(F.xxhash64("_id"), "_id").limit(rows_per_class) for k in (0, 1)
    ]
    chosen = picks[0].union(picks[1])
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    listed = F.arrow_udf(
        lambda col: pa.array([sorted(features(t.as_py())) for t in col], pa.list_(pa.int64())), "array<bigint>"
    )
    # The sample is bounded by its two limits, whatever the size of the tables.
    one = texts.join(F.broadcast(chosen), "_id").groupBy("_id").agg(
        F.min("_text").alias("_text"), *[F.first(n).alias(n) for n in ("_class", *names)]
    )
    sample = stage(one.withColumn("_f", listed("_text")).drop("_text"))
    rows = sample.orderBy(F.xxhash64("_id"), "_id").toArrow()
    if not len(rows):
        return Chain([], names, [np.zeros(1 + j) for j in range(len(names))])
    share = {r["_class"]: r["count"] for r in totals.collect()}
    lists = rows["_f"].combine_chunks()
    found = lists.flatten().to_numpy()
    known = np.unique(found)
    column = np.empty(len(found), np.int32)
    for at in range(0, len(found), ENTRIES):
        column[at : at + ENTRIES] = np.searchsorted(known, found[at : at + ENTRIES])
    x = Rows(column, np.diff(lists.offsets.to_numpy()), len(known))
    ys = np.stack([rows[n].to_numpy() for n in names], axis=1).astype(float)
    kind = rows["_class"].to_numpy()
    weight = np.select([kind == k for k in share], [n / max((kind == k).sum(), 1) for k, n in share.items()])
    del rows, lists, found  # as large as the sample
    return Chain(known, names, fit_chain(x, ys, weight, folds, np.arange(len(x)) % folds, l2, rounds, tolerance))


#: Categories the given labels hold, in the order of the chain; the last two are toxic. The third is the
#: first two together, so its model has little to learn beyond their probabilities; the labels hold no other.
CATEGORIES = {
    "low_quality": "quality = 0",
    "toxic": "toxic = 1",
    "toxic_low_quality": "toxic = 1 AND quality = 0",
}


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = 0.4, **options
) -> DataFrame:
    """Add a probability per category of `CATEGORIES`, and `rejected`: a toxic category reaches the threshold.

    Every row stays, repeated ones too. Input columns of those names are
    replaced; all others stay, whatever they are called. The chain is fitted
    first, on `labels` joined to `docs`.
    """
    chain = fit(docs, labels, CATEGORIES, "toxic = 1", id_col, text, **options)
    if not len(chain.known):  # nothing to learn from: nothing is rejected
        return score(docs, chain, text).withColumn("rejected", F.lit(False))
    reached = F.greatest("p_toxic", "p_toxic_low_quality") >= threshold
    return score(docs, chain, text).withColumn("rejected", reached)


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that `judge` does not reject, with their own columns only, whatever these are called."""
    packed = docs.select(F.struct("*").alias("_doc"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    known = labels.withColumnRenamed(id_col, "doc_id")
    return judge(packed, known, **options).filter("NOT rejected").select("_doc.*")


def score(docs: DataFrame, chain: Chain, text: str = "text", prefix: str = "p_") -> DataFrame:
    """Add the probability of each category, in place of columns of those names. Null and empty texts have no features."""
    held: dict[str, Finder] = {}

    def of(texts: pa.Array) -> pa.Array:
        if "finder" not in held:
            held["finder"] = Finder(chain.known)
        out = chain.probabilities(held["finder"], (t.as_py() for t in texts))
        return pa.StructArray.from_arrays([pa.array(c) for c in out.T], names=chain.names)

    kind = ", ".join(f"{n} double" for n in chain.names)
    own = "_chain"
    while own in docs.columns:
        own += "_"
    scored = docs.withColumn(own, F.arrow_udf(of, f"struct<{kind}>")(F.col(text)))
    return scored.withColumns({f"{prefix}{n}": F.col(own)[n] for n in chain.names}).drop(own)
