"""Training, scoring, ranking of runs, composed corpora, and scoring of a stream."""

import pytest
from pyspark.sql import functions as F

from convlens import schemas
from convlens.functions import text as TX
from convlens.operators import embeddings, models, tfidf
from convlens.plans import corpora
from convlens.streaming import scoring


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, ("bad evil plan" if i % 2 else "kind nice day") + f" word{i % 5} and more", i % 2) for i in range(60)]
    return spark.createDataFrame(data, "id long, text string, harm int").cache()


@pytest.fixture(scope="module")
def model(rows):
    return models.fit_text_model(rows, "text", "harm", 8.0, min_df=2)


def test_pipeline_features_equal_table_form(rows, spark):
    terms = models.text_terms("text")
    listed = rows
    for stage in terms:
        listed = stage.transform(listed)
    pipe = models.term_features(min_df=2).fit(listed)
    vocabulary = pipe.stages[0].vocabulary
    row = pipe.transform(listed).filter("id = 1").first()
    mine = {vocabulary[i]: v for i, v in zip(row.features.indices, row.features.values, strict=True)}
    table = tfidf.tfidf(rows, "id", TX.term_tokens(F.col("text")), 2, 2).filter("id = 1").collect()
    assert {r.term for r in table} == set(mine)
    assert all(abs(mine[r.term] - r.weight) < 1e-9 for r in table)


def test_text_model_separates(rows, model):
    scored = models.score(model, rows)
    assert scored.columns == ["id", "text", "harm", "prob", "pred"]
    assert scored.filter("pred <> harm").count() == 0
    top = models.top_weights(models.term_weights(model), 5).collect()
    assert {r.side for r in top if r.term in ("bad", "evil")} == {"harmful"}
    assert {r.side for r in top if r.term in ("kind", "nice")} == {"unharmful"}


def test_grid_and_choice(rows):
    results = models.grid_search(rows, rows, "text", "harm", (2,), (1, 8))
    assert results.count() == 2
    assert models.choose(results).first().C == 1.0


def test_feed_forward_sweep(spark):
    data = [(i, i % 2, [float(i % 2) + 0.01 * (i % 7), 1.0 - i % 2, 0.5]) for i in range(60)]
    df = models.with_vectors(spark.createDataFrame(data, "id long, harm int, e array<float>"), "e").drop("e")
    out = models.sweep(df, df, "harm", 3, {0: {"hidden": (4, 3), "max_iter": 15}}).first()
    assert out.weights == (3 + 1) * 4 + (4 + 1) * 3 + (3 + 1) * 2
    assert out.val_pr > 0.9 and out.gap == abs(out.val_pr - out.train_pr)


def test_training_parts_follow_the_rows(spark, monkeypatch):
    """Few rows in many parts are trained in one part, in the sweep and in every arm; the order of the settings is kept."""
    assert [models.pass_parts(n, 64, 12) for n in (0, 100, 5000, 500_000, 10_000_000)] == [1, 1, 3, 12, 77]
    data = [(i, i % 2, [float(i % 2) + 0.01 * (i % 7), 1.0 - i % 2, 0.5]) for i in range(60)]
    df = models.with_vectors(spark.createDataFrame(data, "id long, harm int, e array<float>"), "e").drop("e").repartition(23)
    parts, network = [], models.feed_forward

    class Counted:
        def __init__(self, *a, **b):
            self.network = network(*a, **b)

        def fit(self, train):
            parts.append((train.count(), train.rdd.getNumPartitions()))
            return self.network.fit(train)

    monkeypatch.setattr(models, "feed_forward", Counted)
    runs = models.sweep(df, df, "harm", 3, {k: {"hidden": (h,), "max_iter": 2} for k, h in enumerate((4, 3, 2, 5, 6))})
    assert [(r.run, r.weights) for r in runs.orderBy("run").collect()] == [(k, 4 * h + 2 * (h + 1)) for k, h in enumerate((4, 3, 2, 5, 6))]
    arms = models.seeds_and_arms({"A": df.limit(10), "B": df}, df, "harm", 3, (7, 42), hidden=(3,), max_iter=2)
    assert [(r.arm, r.seed) for r in arms.collect()] == [("A", 7), ("A", 42), ("B", 7), ("B", 42)]
    assert sorted(parts) == [(10, 1)] * 2 + [(60, 1)] * 7


def test_word_vectors(rows):
    fitted = embeddings.fit_word_vectors(rows, "text", size=4, min_count=1)
    out = embeddings.embed_by_words(rows, "id", "text", fitted).collect()
    assert len(out) == 60 and all(abs(sum(x * x for x in r.embedding) - 1) < 1e-5 for r in out)


def test_single_turn_rules(spark):
    data = [
        (0, "p1", "r", "unharmful", "harmful"), (1, "p1", "r", "unharmful", "unharmful"), (2, None, "r", "harmful", None),
        (3, None, None, None, None), (4, "p2", None, None, None), (5, "p3", "x y", "harmful", None), (6, "p4", None, "unharmful", None),
    ]
    raw = spark.createDataFrame(data, "row_id long, prompt string, response string, prompt_harm_label string, response_harm_label string")
    out = {r.row_id: r for r in corpora.single_turn(raw, raw.limit(0)).collect()}
    assert set(out) == {0, 4, 5, 6}
    assert [out[i].harm for i in (0, 4, 5, 6)] == [1, 0, 1, 0]
    assert out[5].conversation == "__ROLE_USER__ p3 __ROLE_ASSISTANT__ x y" and out[5].n_words == 3
    assert out[4].conversation_proc == "__role_user__ p2 __role_assistant__ "
    both = corpora.single_turn(raw, raw)
    assert both.select("conversation_id").distinct().count() == both.count() == 8


def test_stream_scores_equal_batch(spark, model, tmp_path):
    talk = spark.createDataFrame([(1, [("user", "bad evil plan")]), (2, [("user", "kind nice day")])], "id long, conversation array<struct<role:string,content:string>>")
    talk.write.parquet(str(tmp_path / "in"))
    terms = models.text_terms("conversation_proc")
    fitted = type(model)(stages=[*terms, *model.stages[len(terms):]])
    stream = spark.readStream.schema(talk.schema).parquet(str(tmp_path / "in"))
    query = scoring.run_available(scoring.score_stream(stream, fitted), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert {r.id: r.pred for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1: 1, 2: 0}
    assert schemas.CONVERSATION == talk.schema["conversation"].dataType
