"""A linear classifier as tables: features, weights, gradient and solver state are rows, never a vector on the driver.

Features are (id, term_id, x) rows, labels (id, label, share) rows, weights
(term_id, w) rows. A margin is a join on the term and a sum per id; a gradient is
a join of residuals on the id and a sum per term, combined before the shuffle.

The solver is limited-memory BFGS in its vector-free form: the driver holds the
scalar products of the last few steps and gradients, never the vectors, which
are columns of the state table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens import constants as K
from convlens import session
from convlens.operators import ranking, tfidf

#: Steps remembered by the solver.
HISTORY = 7
#: Step lengths tried at once along a direction, the longest first.
STEPS = [2.0**-i for i in range(20)]


def vocabulary(counts: DataFrame, n_docs: Column, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """(term, df, idf, term_id): term ids are dense, 0, 1, ..., in seeded random order of the terms.

    Ranks come from bucket totals, so the vocabulary is never in one place.
    """
    ranked = ranking.hash_ranks(tfidf.idf(counts, n_docs, min_df, max_df), "term", name="_rank")
    return ranked.withColumn("term_id", F.col("_rank") - 1).drop("_rank")


def features(counts: DataFrame, words: DataFrame, id_col: str, sublinear: bool = True) -> DataFrame:
    """(id, term_id, x): weights of known terms, of unit length per document. Works for any table's counts."""
    tf = 1 + F.ln("tf") if sublinear else F.col("tf")
    raw = counts.join(words.select("term", "term_id", "idf"), "term").select(F.col(id_col).alias("id"), "term_id", (tf * F.col("idf")).alias("_x"))
    norm = F.sqrt(F.sum(F.col("_x") * F.col("_x")).over(Window.partitionBy("id")))
    return raw.select("id", "term_id", (F.col("_x") / norm).alias("x"))


def shares(rows: DataFrame, id_col: str, label: str, balanced: bool = True) -> DataFrame:
    """(id, y, share): labels, and each row's part of the loss; balanced parts give every class the same sum."""
    own = rows.select(F.col(id_col).alias("id"), F.col(label).cast("double").alias("y"))
    if not balanced:
        return own.withColumn("share", 1 / own.agg(F.count("*")).scalar())
    sizes = own.agg(F.count_if(F.col("y") == 1).alias("n1"), F.count_if(F.col("y") == 0).alias("n0")).select(F.struct("n1", "n0")).scalar()
    return own.withColumn("share", 1 / (2 * F.when(F.col("y") == 1, sizes["n1"]).otherwise(sizes["n0"])))


def margins(x: DataFrame, weights: DataFrame, weight: str = "w") -> DataFrame:
    """(id, m): the weighted sum of each document's terms; terms without a weight add nothing."""
    met = x.join(weights.select("term_id", F.col(weight).alias("_w")), "term_id")
    return met.groupBy("id").agg(F.sum(F.col("x") * F.col("_w")).alias("m"))


def probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def row_loss(margin: Column, y: Column) -> Column:
    """Logistic loss, without overflow for margins of any size."""
    return F.log1p(F.exp(-F.abs(margin))) + F.greatest(margin, F.lit(0.0)) - margin * y


def scores(rows: DataFrame, x: DataFrame, weights: DataFrame, intercept: float, id_col: str, threshold: float = K.THRESHOLD) -> DataFrame:
    """Add `prob` and `pred`. A document without a known term gets the intercept's probability."""
    found = margins(x, weights).withColumnRenamed("id", id_col)
    prob = probability(F.coalesce("m", F.lit(0.0)) + F.lit(float(intercept)))
    out = rows.join(found, id_col, "left").withColumn("prob", prob).drop("m")
    return out.withColumn("pred", (F.col("prob") >= threshold).cast("int"))


def residuals(labels: DataFrame, x: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    """(id, loss, r): each row's part of the loss, and its derivative by the margin."""
    m = F.coalesce("m", F.lit(0.0)) + F.lit(float(intercept))
    return labels.join(margins(x, weights), "id", "left").select(
        "id", (F.col("share") * row_loss(m, F.col("y"))).alias("loss"), (F.col("share") * (probability(m) - F.col("y"))).alias("r")
    )


def loss(labels: DataFrame, x: DataFrame, weights: DataFrame, intercept: float, penalty: float) -> DataFrame:
    """One row: the loss with its penalty, and the intercept's derivative."""
    data = residuals(labels, x, weights, intercept).agg(F.sum("loss").alias("_l"), F.sum("r").alias("intercept_gradient"))
    size = weights.agg(F.coalesce(F.sum(F.col("w") * F.col("w")), F.lit(0.0))).scalar()
    return data.select((F.col("_l") + F.lit(penalty / 2) * size).alias("loss"), "intercept_gradient")


def data_gradient(x: DataFrame, r: DataFrame) -> DataFrame:
    """(term_id, g): the derivative of the rows' loss by each weight."""
    return x.join(r.select("id", "r"), "id").groupBy("term_id").agg(F.sum(F.col("x") * F.col("r")).alias("g"))


def gradient(labels: DataFrame, x: DataFrame, weights: DataFrame, intercept: float, penalty: float) -> DataFrame:
    """(term_id, g) of every weight, penalty included."""
    found = data_gradient(x, residuals(labels, x, weights, intercept))
    return weights.join(found, "term_id", "left").select(
        "term_id", (F.coalesce("g", F.lit(0.0)) + F.lit(penalty) * F.col("w")).alias("g")
    )


def top_terms(weights: DataFrame, k: int = 20, term: str = "term", weight: str = "w") -> DataFrame:
    """(side, rank, term, weight): the k strongest terms of either sign, ties by term. A table of 2 k rows, by bounded heaps."""
    up = weights.orderBy(F.desc(weight), term).limit(k).select(F.lit("harmful").alias("side"), term, weight)
    down = weights.orderBy(weight, term).limit(k).select(F.lit("unharmful").alias("side"), term, weight)
    return up.unionByName(down)


# --- fit ------------------------------------------------------------------


@dataclass
class Fitted:
    """Weights as a written table, the intercept, and how the fit ended."""

    weights: DataFrame
    intercept: float
    iterations: int
    loss: float
    gradient_norm: float


def _direction(gram: list[list[float]], k: int) -> list[float]:
    """Coefficients of the step over (s_1..s_k, y_1..y_k, g), the oldest first, from their scalar products."""
    d = [0.0] * (2 * k) + [-1.0]

    def dot(i):
        return sum(c * gram[i][j] for j, c in enumerate(d) if c)

    alpha = [0.0] * k
    for i in reversed(range(k)):
        alpha[i] = dot(i) / gram[i][k + i]
        d[k + i] -= alpha[i]
    if k:
        scale = gram[k - 1][2 * k - 1] / gram[2 * k - 1][2 * k - 1]
        d = [c * scale for c in d]
    for i in range(k):
        beta = dot(k + i) / gram[i][k + i]
        d[i] += alpha[i] - beta
    return d


def fit(labels: DataFrame, x: DataFrame, terms: DataFrame, penalty: float, tolerance: float = 1e-6, max_iter: int = 200) -> Fitted:
    """Minimise the rows' loss plus `penalty` / 2 times the squared weights; the intercept is free.

    `labels` (id, y, share), `x` (id, term_id, x) and `terms` (term_id, ...) are
    read in every iteration: pass written tables. Ends when the gradient's norm
    is `tolerance` times that of the start, and raises if it does not get there.
    A few scalars of each iteration reach the driver.
    """
    spark = x.sparkSession
    zero, none = F.lit(0.0), F.array().cast("array<double>")

    def products(state: DataFrame, k: int, extra: tuple[float, ...]):
        """Products of the gradient with every vector of the basis, and of the weights with themselves."""
        g = F.col("g")
        sums = [F.sum(F.col("s")[i] * g) for i in range(k)] + [F.sum(F.col("y")[i] * g) for i in range(k)] + [F.sum(g * g), F.sum(F.col("w") * g)]
        row = state.agg(*[F.coalesce(c, zero).alias(f"c{i}") for i, c in enumerate(sums)]).first()
        return [row[i] + e for i, e in enumerate(extra)], row[2 * k + 1]

    # The start: no weights, no intercept.
    held = session.stage(labels.withColumn("m", zero))
    r = held.select("id", (F.col("share") * (probability(F.col("m")) - F.col("y"))).alias("r"))
    state = session.stage(
        terms.select("term_id").join(data_gradient(x, r), "term_id", "left").select(
            "term_id", zero.alias("w"), F.coalesce("g", zero).alias("g"), none.alias("s"), none.alias("y")
        )
    )
    b, (value, gb) = 0.0, held.agg(F.sum(F.col("share") * row_loss(F.col("m"), F.col("y"))), F.sum(F.col("share") * (probability(F.col("m")) - F.col("y")))).first()
    sb: list[float] = []
    yb: list[float] = []
    gram: list[list[float]] = [[0.0]]
    (gg,), _ = products(state, 0, (gb * gb,))
    gram[0][0] = gg
    start, ww = math.sqrt(gg), 0.0
    for iteration in range(1, max_iter + 1):
        if math.sqrt(gram[-1][-1]) <= tolerance * start:
            return Fitted(state.select("term_id", "w"), b, iteration - 1, value, math.sqrt(gram[-1][-1]))
        k = len(sb)
        d = _direction(gram, k)
        slope = sum(c * gram[-1][j] for j, c in enumerate(d))
        pp = sum(a * c * gram[i][j] for i, a in enumerate(d) for j, c in enumerate(d))
        pb = sum(c * v for c, v in zip(d, [*sb, *yb, gb]))
        p = sum((F.lit(d[i]) * F.col("s")[i] + F.lit(d[k + i]) * F.col("y")[i] for i in range(k)), F.lit(d[-1]) * F.col("g"))
        stepped = state.withColumn("p", p)
        moved = held.join(margins(x, stepped, "p").withColumnRenamed("m", "_d"), "id", "left").select(
            "id", "y", "share", "m", (F.coalesce("_d", zero) + F.lit(pb)).alias("d")
        )
        moved = session.stage(moved)
        # Every step length at once: rows keep their margin and its change.
        tried = [F.sum(F.col("share") * row_loss(F.col("m") + F.lit(a) * F.col("d"), F.col("y"))) for a in STEPS]
        found = moved.agg(*[c.alias(f"l{i}") for i, c in enumerate(tried)]).first()
        wp, pw2 = stepped.agg(F.coalesce(F.sum(F.col("w") * F.col("p")), zero), F.coalesce(F.sum(F.col("p") * F.col("p")), zero)).first()
        losses = [found[i] + penalty / 2 * (ww + 2 * a * wp + a * a * pw2) for i, a in enumerate(STEPS)]
        step = next((i for i, a in enumerate(STEPS) if losses[i] <= value + 1e-4 * a * slope), None)
        if step is None:
            raise RuntimeError(f"no step lowers the loss after {iteration - 1} iterations")
        a, value, ww = STEPS[step], losses[step], ww + 2 * STEPS[step] * wp + STEPS[step] ** 2 * pw2
        old_held, old_state = held, state
        held = session.stage(moved.select("id", "y", "share", (F.col("m") + F.lit(a) * F.col("d")).alias("m")))
        r = held.select("id", (F.col("share") * (probability(F.col("m")) - F.col("y"))).alias("r"))
        drop = 1 if k == HISTORY else 0
        w = F.col("w") + F.lit(a) * F.col("p")
        g = F.coalesce("_g", zero) + F.lit(penalty) * F.col("_w")
        new = stepped.withColumn("_w", w).join(data_gradient(x, r).withColumnRenamed("g", "_g"), "term_id", "left").withColumn("_g", g)

        def longer(column: str, added: Column) -> Column:
            kept = F.slice(column, 2, HISTORY) if drop else F.col(column)
            return F.concat(kept, F.array(added))

        state = session.stage(new.select(
            "term_id", F.col("_w").alias("w"), F.col("_g").alias("g"),
            longer("s", F.lit(a) * F.col("p")).alias("s"), longer("y", F.col("_g") - F.col("g")).alias("y"),
        ))
        new_gb = held.agg(F.sum(F.col("share") * (probability(F.col("m")) - F.col("y")))).first()[0]
        # Products with the new step follow from the old ones; those with the new gradient are one aggregation.
        n = 2 * k + 1
        with_step = [a * sum(c * gram[j][i] for j, c in enumerate(d)) for i in range(n)]
        b += a * pb
        sb, yb, gb = [*sb[drop:], a * pb], [*yb[drop:], new_gb - gb], new_gb
        keep = [i for i in range(2 * k) if not (drop and i in (0, k))]
        j = len(sb)
        with_g, _ = products(state, j, tuple(v * gb for v in [*sb, *yb, gb]))
        old = [[gram[i][l] for l in keep] for i in keep]
        old_g = [gram[-1][i] for i in keep]
        half = len(keep) // 2
        new_gram = [[0.0] * (2 * j + 1) for _ in range(2 * j + 1)]
        at = [i if i < half else i + 1 for i in range(len(keep))]  # where the kept vectors go
        for i, u in enumerate(at):
            for l, v in enumerate(at):
                new_gram[u][v] = old[i][l]
        s_at, y_at, g_at = j - 1, 2 * j - 1, 2 * j
        for i, u in enumerate(at):
            new_gram[u][s_at] = new_gram[s_at][u] = with_step[keep[i]]
            new_gram[u][y_at] = new_gram[y_at][u] = with_g[u] - old_g[i]
        new_gram[s_at][s_at] = a * a * pp
        old_gs = with_step[-1]  # the old gradient with the new step
        new_gram[s_at][y_at] = new_gram[y_at][s_at] = with_g[s_at] - old_gs
        # g_new . y = g_new . g_new - g_new . g_old, so g_new . g_old is known, and with it y . y.
        g_old_new = with_g[g_at] - with_g[y_at]
        new_gram[y_at][y_at] = with_g[g_at] - 2 * g_old_new + gram[-1][-1]
        for u in range(2 * j + 1):
            new_gram[u][g_at] = new_gram[g_at][u] = with_g[u]
        gram = new_gram
        session.discard(spark, old_held, old_state, moved)
    raise RuntimeError(f"not converged after {max_iter} iterations")
