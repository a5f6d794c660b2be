"""Regressions fitted in the space of rows, against the table form and a dense solver."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from convlens.functions import text as TX
from convlens.operators import linear, models, row_fit, tfidf
from convlens.session import stage

SETTINGS = [(2, 8.0), (4, 1.0)]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    made = []
    for i in range(120):
        y = int(rng.random() < 0.3)
        own = words[:20] if y else words[10:]
        made.append((i // 2, " ".join(rng.choice(own) for _ in range(rng.randrange(0, 25))), y, i < 100))  # ids come twice
    return spark.createDataFrame(made, "id long, text string, harm int, train boolean").cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return models.fit_texts(rows, F.col("train"), "text", "harm", SETTINGS)


@pytest.mark.parametrize("which", [0, 1])
def test_probabilities_equal_the_table_solver(fitted, which):
    (min_df, c), n = SETTINGS[which], 100
    own = fitted.rows.filter("_fit")
    words = stage(linear.vocabulary(stage(tfidf.term_counts(own, "row", TX.term_tokens(F.col("text")), 2)), F.lit(n), min_df))
    x = stage(linear.features(tfidf.term_counts(fitted.rows, "row", TX.term_tokens(F.col("text")), 2), words, "row"))
    want = linear.fit(stage(linear.shares(own, "row", "harm")), x, words, 1.0 / (c * n))
    table = {r.row: r.prob for r in linear.scores(fitted.rows, x, want.weights, want.intercept, "row").collect()}
    mine = {r.row: r.prob for r in fitted.fit.rows().filter(F.col("model") == which).collect()}
    assert mine.keys() == table.keys() == set(range(120))
    assert max(abs(mine[i] - table[i]) for i in mine) < 1e-3
    weights = {r.term: r.weight for r in fitted.weights(which).collect()}
    known = {r.term: r.w for r in want.weights.join(words, "term_id").collect()}
    assert weights.keys() == known.keys() and len(weights) == fitted.features[min_df]
    assert max(abs(weights[t] - known[t]) for t in known) < 1e-2


def test_scores_equal_mllib(rows, fitted):
    train = rows.filter("train")
    model = models.fit_text_model(train, "text", "harm", 8.0, min_df=2)
    key = ["id", "text", "harm", "train"]
    want = models.score(model, rows).select(*key, F.round("prob", 2).alias("p")).collect()
    mine = fitted.scored(0).select(*key, F.round("prob", 2).alias("p")).collect()
    assert len(mine) == len(want) == 120
    assert np.abs(np.array([r.p for r in sorted(mine)]) - np.array([r.p for r in sorted(want)])).max() <= 0.011


def test_terms_stay_off_the_driver_and_out_of_passes(fitted):
    assert not any(hasattr(fitted.fit, n) for n in ("vocabulary", "coefficients"))
    assert fitted.fit.passes < 200 and all(np.isfinite(fitted.fit.b))


def test_blocks_hold_whole_terms(spark, monkeypatch):
    monkeypatch.setattr(row_fit, "BLOCK", 10)
    terms = spark.createDataFrame([(r, True, f"t{k}", 1) for k in range(9) for r in range(k % 4 + 1)], "row long, fit boolean, term string, tf long")
    blocks = row_fit.term_blocks(terms, 4, 4, 1).collect()
    sizes = [np.diff(np.append(np.frombuffer(b.starts, np.int32), len(b.rows) // 4)) for b in blocks]
    assert all((s == np.frombuffer(b.df, np.int64)).all() for s, b in zip(sizes, blocks))
    assert sum(map(len, sizes)) == 9 and sum(int(s.sum()) for s in sizes) == terms.count()


def test_one_class(rows):
    out = models.fit_texts(rows.filter("harm = 1"), F.col("train"), "text", "harm", [(2, 1.0)]).scored().collect()
    assert out and all(r.prob == 1.0 for r in out)


def unpacked(blocks):
    """{(term, row): tf} and {term: df} of blocks."""
    found, dfs = {}, {}
    for b in blocks.collect():
        starts, sizes, df, _, rows, tf = row_fit._arrays(b.asDict())
        dfs |= dict(zip(b.terms, df.tolist(), strict=True))
        names = np.repeat(np.array(b.terms, object), sizes)
        assert not found.keys() & set(zip(names, rows.tolist()))
        found |= dict(zip(zip(names, rows.tolist()), tf.tolist(), strict=True))
    return found, dfs


def test_terms_listed_by_batch_equal_counted_rows(spark, monkeypatch):
    """A term is whole though many batches of texts and of sorted records hold it; df counts fitted rows only."""
    monkeypatch.setattr(row_fit, "TOKENS", 7)
    monkeypatch.setattr(row_fit, "BLOCK", 5)
    texts = ["aa bb aa", "", None, "aa", "bb aa bb aa cc", "cc dd ee ff gg hh ii jj kk", "aa bb"] * 3 + ["aa"] * 300
    df = spark.createDataFrame([(i, i % 2 == 0, t) for i, t in enumerate(texts)], "row long, fit boolean, text string").repartition(3)
    tokens = TX.term_tokens(F.col("text"))
    blocks = row_fit.term_blocks(row_fit.text_lists(df.withColumn("t", tokens), "t"), 161, 321, 2)
    found, dfs = unpacked(blocks)
    counted = tfidf.term_counts(df, "row", tokens).join(df.select("row", "fit"), "row").collect()
    known = {}
    for r in counted:
        known.setdefault(r.term, []).append(r)
    known = {t: rows for t, rows in known.items() if sum(r.fit for r in rows) >= 2}
    assert dfs == {t: sum(r.fit for r in rows) for t, rows in known.items()}
    assert found == {(r.term, r.row): r.tf for rows in known.values() for r in rows}


def test_a_task_holds_one_piece_of_features(rows, fitted, monkeypatch):
    """Features come in parts of a bounded size, and models in groups of a bounded size, with the same results."""
    for name, value in (("PART", 900), ("BLOCK", 50), ("VECTOR", 8), ("CHUNK", 16)):
        monkeypatch.setattr(row_fit, name, value)
    parts, held = [], row_fit.Fit._held

    def counted(self, blocks):
        kept = held(self, blocks)
        parts.append(kept.getNumPartitions())
        return kept

    monkeypatch.setattr(row_fit.Fit, "_held", counted)
    again = models.fit_texts(rows, F.col("train"), "text", "harm", SETTINGS)
    assert parts[0] > 2 * rows.sparkSession.sparkContext.defaultParallelism
    for which in (0, 1):
        want = {r.row: r.prob for r in fitted.fit.rows(which).collect()}
        mine = {r.row: r.prob for r in again.fit.rows(which).collect()}
        assert mine.keys() == want.keys() and max(abs(mine[i] - want[i]) for i in mine) < 1e-6


def test_grid_without_a_vocabulary_on_the_driver(rows, spark, monkeypatch):
    """The grid gives the metrics of MLlib's fit, takes texts and labels that are null, and counts no vocabulary on the driver."""
    train, val = (rows.filter(c).select("text", "harm") for c in ("train", "not train"))
    want = models.evaluate(models.score(models.fit_text_model(train, "text", "harm", 8.0, min_df=2), val), "harm")
    terms = models.term_features(min_df=2).fit(models.listed(train, models.text_terms("text"), "harm")).stages[0].vocabulary
    monkeypatch.setattr(models, "CountVectorizer", None)
    found = {(r.min_df, r.C): r.asDict() for r in models.grid_search(train, val, "text", "harm", (1, 2), (8,)).collect()}
    assert set(found) == {(1, 8.0), (2, 8.0)} and found[2, 8.0]["features"] == len(terms)
    assert {k: pytest.approx(v, abs=1e-3) for k, v in want.items()} == {k: found[2, 8.0][k] for k in want}
    odd = train.unionByName(spark.createDataFrame([(None, 1), ("w1 w2 w3", None)], "text string, harm int"))
    assert models.grid_search(odd, val, "text", "harm", (2,), (8,)).count() == 1
