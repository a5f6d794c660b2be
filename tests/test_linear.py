"""The table form of the linear model against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from convlens.functions import text as TX
from convlens.operators import linear, tfidf
from convlens.session import stage


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(120):
        y = int(rng.random() < 0.3)
        own = words[: 20] if y else words[10:]
        rows.append((i, " ".join(rng.choice(own) for _ in range(rng.randrange(0, 25))), y))
    return spark.createDataFrame(rows, "id long, text string, harm int").cache(), rows


@pytest.fixture(scope="module")
def tables(spark, data):
    df, _ = data
    counts = stage(tfidf.term_counts(df, "id", TX.term_tokens(F.col("text")), 1))
    words = stage(linear.vocabulary(counts, df.agg(F.count("*")).scalar(), 2))
    return stage(linear.shares(df, "id", "harm")), stage(linear.features(counts, words, "id")), words


def dense(tables):
    labels, x, words = tables
    n = words.count()
    ids = {r.id: i for i, r in enumerate(labels.orderBy("id").collect())}
    a = np.zeros((len(ids), n))
    for r in x.collect():
        a[ids[r.id], r.term_id] = r.x
    rows = labels.orderBy("id").collect()
    return a, np.array([r.y for r in rows]), np.array([r.share for r in rows])


def objective(a, y, share, w, b, penalty):
    m = a @ w + b
    p = 1 / (1 + np.exp(-m))
    value = float(share @ (np.logaddexp(0, m) - m * y)) + penalty / 2 * float(w @ w)
    return value, a.T @ (share * (p - y)) + penalty * w, float(share @ (p - y))


def solved(a, y, share, penalty):
    """Newton's method on the dense problem."""
    z = np.hstack([a, np.ones((len(a), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.diag([penalty] * a.shape[1] + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(z @ w)))
        g = z.T @ (share * (p - y)) + ridge @ w
        w -= np.linalg.solve(z.T @ (z * (share * p * (1 - p))[:, None]) + ridge, g)
    return w[:-1], w[-1]


def test_ids_are_dense(tables):
    ids = sorted(r.term_id for r in tables[2].collect())
    assert ids == list(range(len(ids)))


def test_shares_balance_classes(spark, tables):
    sums = {r.y: r.s for r in tables[0].groupBy("y").agg(F.sum("share").alias("s")).collect()}
    assert sums == pytest.approx({0.0: 0.5, 1.0: 0.5})


def test_loss_and_gradient_at_given_weights(spark, tables):
    a, y, share = dense(tables)
    w = np.sin(np.arange(a.shape[1]))
    weights = spark.createDataFrame([(i, float(v)) for i, v in enumerate(w)], "term_id long, w double")
    value, g, gb = objective(a, y, share, w, 0.3, 0.01)
    row = linear.loss(tables[0], tables[1], weights, 0.3, 0.01).first()
    assert (row.loss, row.intercept_gradient) == pytest.approx((value, gb))
    got = {r.term_id: r.g for r in linear.gradient(tables[0], tables[1], weights, 0.3, 0.01).collect()}
    assert [got[i] for i in range(len(w))] == pytest.approx(g.tolist())


@pytest.mark.parametrize("penalty", [0.05, 0.001])
def test_fit_equals_an_independent_solver(spark, data, tables, penalty):
    a, y, share = dense(tables)
    w, b = solved(a, y, share, penalty)
    fitted = linear.fit(*tables, penalty)
    got = {r.term_id: r.w for r in fitted.weights.collect()}
    assert max(abs(got[i] - w[i]) for i in range(len(w))) < 1e-4 and abs(fitted.intercept - b) < 1e-4
    assert math.isclose(fitted.loss, objective(a, y, share, w, b, penalty)[0], rel_tol=1e-6)
    df, rows = data
    scored = linear.scores(df, tables[1], fitted.weights, fitted.intercept, "id")
    assert scored.columns == ["id", "text", "harm", "prob", "pred"] and scored.count() == len(rows)
    want = 1 / (1 + np.exp(-(a @ w + b)))
    assert all(abs(r.prob - want[r.id]) < 1e-4 for r in scored.collect())


def test_no_convergence_raises(tables):
    with pytest.raises(RuntimeError):
        linear.fit(*tables, 0.001, max_iter=2)


def test_top_terms_break_ties_by_term(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", -2.0), ("d", 0.0)], "term string, w double")
    out = linear.top_terms(rows, 2).collect()
    assert [(r.side, r.term) for r in out] == [("harmful", "a"), ("harmful", "b"), ("unharmful", "c"), ("unharmful", "d")]
