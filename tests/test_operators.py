"""Operators on small frames: exact sizes, brute force, independence of partitioning."""

import math
import random

import pytest
from pyspark.sql import functions as F

from convlens.operators import bootstrap, dedup, embeddings, joins, metrics, ngrams, profile, quality, ranking, sampling, tfidf
from convlens.functions import text as TX


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, 1 if i % 3 == 0 else 0, float(i % 17)) for i in range(1000)]
    return spark.createDataFrame(rows, "id long, harm int, x double").repartition(7).cache()


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize("n", [0, 1, 10, 999, 1000, 5000])
def test_sample_exact_size(labelled, n):
    assert sampling.sample_exact(labelled, n, "id").count() == min(n, 1000)


def test_samples_do_not_depend_on_partitioning(labelled):
    for draw in (
        lambda d: sampling.sample_exact(d, 77, "id"),
        lambda d: sampling.sample_balanced(d, 31, "harm", "id"),
        lambda d: sampling.stratified_split(d, "harm", "id", 0.2).filter("split = 'val'"),
        lambda d: sampling.learning_curve(d, "harm", "id", [50]),
    ):
        assert ids(draw(labelled)) == ids(draw(labelled.coalesce(1)))


def test_balanced_gives_odd_row_to_first_class(labelled):
    counts = dict(sampling.sample_balanced(labelled, 31, "harm", "id").groupBy("harm").count().collect())
    assert counts == {1: 16, 0: 15}


def test_split_quotas(labelled):
    counts = {(r.harm, r.split): r["count"] for r in sampling.stratified_split(labelled, "harm", "id", 0.15).groupBy("harm", "split").count().collect()}
    assert sum(v for (_, s), v in counts.items() if s == "val") == 150
    assert counts[(1, "val")] == 50 and counts[(0, "val")] == 100
    three = sampling.three_way_split(labelled, "harm", "id")
    assert dict(three.groupBy("split").count().collect()) == {"train": 600, "val": 200, "test": 200}
    assert three.select("id").distinct().count() == 1000


def test_split_keeps_null_class(spark):
    df = spark.createDataFrame([(i, None if i < 10 else 1) for i in range(30)], "id long, harm int")
    assert sampling.stratified_split(df, "harm", "id", 0.5).count() == 30


def test_learning_curve_is_nested(labelled):
    out = sampling.learning_curve(labelled, "harm", "id", [30, 100, 10**9])
    by_size = {s: set(ids(out.filter(F.col("size") == s))) for s in (30, 100, 10**9)}
    assert [len(v) for v in by_size.values()] == [30, 100, 1000]
    assert by_size[30] <= by_size[100] <= by_size[10**9]


def test_matched_sample(spark):
    rng = random.Random(1)
    target = spark.createDataFrame([(i, rng.randint(10, 200)) for i in range(80)], "id long, n int")
    pool = spark.createDataFrame([(i, rng.randint(1, 400)) for i in range(3000)], "id long, n int")
    matched = sampling.sample_matched(target, pool, "n", "id", 5)
    limits = profile.edges(target, "n", 5)
    count = lambda d: {r.bin: r.n for r in profile.bin_counts(d, "n", limits).collect()}
    assert count(matched) == count(target) and matched.count() == 80
    short = sampling.sample_matched(target, pool.limit(20), "n", "id", 5)
    assert short.count() <= 20


def test_ids_are_dense_and_disjoint(spark):
    a = sampling.assign_ids(spark.range(5, 900, 7).withColumnRenamed("id", "k"), "k")
    b = sampling.assign_ids(spark.range(3).withColumnRenamed("id", "k"), "k", offset=sampling.next_free_id(a))
    got = sorted(r.conversation_id for r in a.unionByName(b).collect())
    assert got == list(range(len(got)))


def test_running_totals_and_quantiles(labelled):
    values = sorted(r.x for r in labelled.collect())
    row = ranking.quantiles(labelled, "x", [0.0, 0.1, 0.5, 0.99, 1.0]).first().q
    for p, got in zip([0.0, 0.1, 0.5, 0.99, 1.0], row, strict=True):
        at = p * (len(values) - 1)
        lo, hi = values[math.floor(at)], values[math.ceil(at)]
        assert abs(got - (lo + (hi - lo) * (at - math.floor(at)))) < 1e-9
    exact = labelled.agg(F.percentile("x", F.lit(0.37))).first()[0]
    assert abs(ranking.quantiles(labelled, "x", [0.37]).first().q[0] - exact) < 1e-9


def test_keep_first_and_nulls(spark):
    rows = [(3, "a", 1), (1, "a", 0), (2, None, 1), (5, None, 0), (4, "b", 1)]
    df = spark.createDataFrame(rows, "id long, prompt string, v int").repartition(5)
    assert ids(dedup.keep_first(df, ["prompt"], "id")) == [1, 2, 4]
    assert ids(dedup.keep_first(df, ["prompt", "v"], "id")) == [1, 2, 3, 4, 5]


def test_drop_seen_normalises(spark):
    a = spark.createDataFrame([(1, " Hello\n World "), (2, "other")], "id long, text string")
    b = spark.createDataFrame([("hello world",)], "text string")
    assert ids(dedup.drop_seen(a, "text", b)) == [2]


def test_near_duplicates_against_jaccard(spark):
    rng = random.Random(7)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(120)] for _ in range(40)]
    near = [w[:60] + ["changed"] + w[61:] for w in base[:20]]
    far = [[f"v{rng.randint(0, 400)}" for _ in range(120)] for _ in range(20)]
    mine = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(near + far)], "id long, text string")
    theirs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(base)], "id long, text string")
    kept = set(ids(dedup.drop_near_seen(mine, "id", "text", theirs, "id")))

    def shingles(w):
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}

    def best(w):
        return max(len(shingles(w) & shingles(b)) / len(shingles(w) | shingles(b)) for b in base)

    for i, w in enumerate(near + far):
        assert (i in kept) == (best(w) < 0.5), (i, best(w))


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("prompt"))
    assert dedup.keep_first(df, ["prompt"], "id").count() == 20000 - 6667 + 1
    plan = dedup.first_rows(df, ["prompt"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_top_grams_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", ["x", "y", "x"]), ("b", ["z"])], "k string, w array<string>")
    top = ngrams.top_grams(df, F.col("w"), "k", 1, 1)
    assert sorted((r.k, r.gram, r.n) for r in top.collect()) == [("a", "x", 2), ("b", "z", 1)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_one_to_one(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, t string")
    twice = spark.createDataFrame([(1, 0), (1, 1)], "id long, harm int")
    with pytest.raises(ValueError, match="not unique"):
        joins.one_to_one(a, twice, "id")
    with pytest.raises(ValueError, match="no harm"):
        joins.attach(a, twice.limit(1), "id", ["harm"])
    assert joins.load_split(a, twice.limit(1), "val", "id", "single").first().asDict()["split"] == "val"


def test_quality_rules(spark):
    df = spark.createDataFrame([("a", 1), (" ", 0), (None, 2)], "t string, y int")
    assert quality.violations(df, quality.text_rules("t", "y")).first().asDict() == {"null_text": 1, "blank_text": 1, "bad_label": 1}
    with pytest.raises(ValueError):
        quality.require(df, quality.text_rules("t", "y"))
    e = spark.createDataFrame([([1.0, float("nan")],), ([1.0],), (None,), ([0.5, 2.0],)], "e array<float>")
    assert quality.violations(e, quality.embedding_rules("e", 2)).first().asDict() == {"missing": 1, "wrong_size": 1, "not_finite": 1}


@pytest.fixture(scope="module")
def predictions(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(0, 1), rng.choice([0.0, 0.1, 0.25, 0.5, 0.5, 0.75, 0.9, 1.0]), rng.choice("ab")) for i in range(300)]
    rows += [(1000 + i, 1, 0.3, "only") for i in range(3)]
    df = spark.createDataFrame(rows, "id long, harm int, prob double, sub string")
    return df.withColumn("pred", (F.col("prob") >= 0.5).cast("int")).cache()


def test_auc_against_pairs_and_mllib(spark, predictions):
    from pyspark.mllib.evaluation import BinaryClassificationMetrics

    rows = predictions.collect()
    pos, neg = [r.prob for r in rows if r.harm], [r.prob for r in rows if not r.harm]
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    areas = metrics.curve_areas(predictions, "harm", "prob").first()
    assert abs(areas.roc_auc - pairs) < 1e-9
    theirs = BinaryClassificationMetrics(predictions.rdd.map(lambda r: (float(r.prob), float(r.harm))))
    assert abs(areas.roc_auc - theirs.areaUnderROC) < 1e-9
    assert 0 <= areas.average_precision <= 1 and 0 <= areas.pr_auc <= 1


def test_single_class_group_has_no_auc(predictions):
    by = {r["sub"]: r for r in metrics.subgroup_metrics(predictions, "harm", "pred", "prob", "sub").collect()}
    assert by["only"].roc_auc is None and by["only"].recall == 0.0 and by["a"].roc_auc is not None


def test_recall_at_precision_without_reach(spark):
    df = spark.createDataFrame([(0, 0.9), (1, 0.1)], "harm int, prob double")
    assert metrics.curve_areas(df, "harm", "prob").first().recall_at_precision == 0.0


def test_calibration_leaves_out_zero(predictions):
    zeros = predictions.filter("prob = 0").count()
    n = sum(r.n for r in metrics.calibration(predictions, "harm", "pred", "prob").collect())
    full = sum(r.n for r in metrics.calibration(predictions, "harm", "pred", "prob", include_lowest=True).collect())
    assert zeros > 0 and full - n == zeros


def test_bootstrap_interval_covers_estimate(predictions):
    point = metrics.binary_metrics(predictions, "harm", "pred").first().f1_macro
    low = bootstrap.f1_macro_interval(predictions, "harm", "pred", 300).first()
    assert low.lo < point < low.hi and low.hi - low.lo < 0.2 and low.replicates == 300
    again = bootstrap.f1_macro_interval(predictions.coalesce(1), "harm", "pred", 300).first()
    assert (low.lo, low.hi) == (again.lo, again.hi)
    auc = metrics.curve_areas(predictions, "harm", "prob").first().roc_auc
    spread = bootstrap.roc_auc_interval(predictions, "harm", "prob", 100).first()
    assert spread.lo < auc < spread.hi


def test_crosstab_with_nulls(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "x")], "r string, c string")
    full = {r.r: (r.x, r["<NA>"]) for r in profile.crosstab(df, "r", "c", ["x", "<NA>"], dropna=False).collect()}
    assert full == {"a": (1, 1), "<NA>": (1, 0)}
    share = {r.r: r.x for r in profile.crosstab(df, "r", "c", ["x"], percent=True).collect()}
    assert share == {"a": 100.0}


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.11,), (1.0,), (1.1,), (None,)], "x double")
    assert [r.b for r in df.select(profile.cut(F.col("x"), [0.0, 0.1, 1.0]).alias("b")).collect()] == [None, 1, 2, 2, None, None]


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (9.9,), (10.0,), (20.0,), (21.0,)], "x double")
    assert {r.bucket: r.n for r in profile.histogram(df, "x", 0.0, 10.0, 2).collect()} == {0: 2, 1: 2}


def test_tfidf_unit_length(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (2, "bb cc"), (3, "zz")], "id long, t string")
    weights = tfidf.tfidf(df, "id", TX.term_tokens(F.col("t")), 1)
    assert all(abs(r.n - 1) < 1e-9 for r in weights.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect())


def test_softmax_and_nearest(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "l array<double>")
    got = df.select(embeddings.softmax(F.col("l")).alias("s")).first().s
    whole = sum(math.exp(v) for v in (1, 2, 3))
    assert all(abs(g - math.exp(v) / whole) < 1e-12 for g, v in zip(got, (1, 2, 3), strict=True))
    labels = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0])], "label string, vector array<double>")
    points = spark.createDataFrame([(1, [2.0, 0.1]), (2, [0.0, 0.5])], "id long, e array<float>")
    near = embeddings.nearest_label(points, "e", labels, "label").collect()
    assert {r.id: r.nearest for r in near} == {1: "x", 2: "y"}


def test_embed_with_encoder(spark):
    import numpy as np

    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([(i, "x" * i) for i in range(70)], "id long, t string")
    out = embeddings.embed(df, "id", "t", load, "length").collect()
    assert {r.id: r.embedding[0] for r in out} == {i: float(i) for i in range(70)}
    pooled = embeddings.masked_mean(np.array([[[1.0], [3.0], [9.0]]]), np.array([[1, 1, 0]]))
    assert pooled.tolist() == [[2.0]]


def bucket_sizes(df, column):
    return [r["count"] for r in df.groupBy(ranking.quantile_bucket(df, column, 500).alias("b")).count().collect()]


def test_buckets_of_skewed_values(spark):
    ids = spark.range(20_000).withColumn("v", F.col("id").cast("double"))
    with_outlier = ids.unionByName(spark.createDataFrame([(20_000, 1e15)], "id bigint, v double"))
    assert max(bucket_sizes(with_outlier, "v")) < 20_000 * 0.03
    narrow = ids.withColumn("v", 0.49 + 0.02 * F.col("id") / 20_000)
    assert max(bucket_sizes(narrow, "v")) < 20_000 * 0.03
    ordered = narrow.withColumn("b", ranking.quantile_bucket(narrow, "v", 500)).groupBy("b").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    rows = sorted(ordered.collect())
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))
    assert ids.filter("false").withColumn("b", ranking.quantile_bucket(ids.filter("false"), "v")).count() == 0
    ranked = sampling.assign_ids(with_outlier.withColumn("v", F.col("v").cast("bigint")), "v").filter("v > 1e14").first()
    assert ranked.conversation_id == 20_000


def test_short_class_raises(spark):
    df = spark.range(100).withColumn("harm", (F.col("id") < 3).cast("int"))
    with pytest.raises(ValueError):
        sampling.sample_balanced(df, 20, "harm", "id")
    assert sampling.sample_balanced(df, 20, "harm", "id", complete=False).count() == 13
    with pytest.raises(ValueError):
        sampling.sample_balanced(df.filter("harm = 0"), 20, "harm", "id")


def test_attach_refuses_repeated_metadata(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    meta = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id int, harm string")
    with pytest.raises(ValueError):
        joins.attach(rows, meta, "id", ["harm"])
    assert joins.attach(rows, meta.filter("harm <> 'c'"), "id", ["harm"]).count() == 2


def test_false_alarms_by_group(spark):
    rows = [("a", 0, 1), ("a", 0, 0), ("a", 1, 0), ("b", 0, 1), ("c", 1, 1)]
    found = metrics.false_alarm_rates(spark.createDataFrame(rows, "g string, y int, p int"), "y", "p", "g").collect()
    assert [tuple(r) for r in found] == [("b", 1, 1, 1.0), ("a", 1, 2, 0.5)]


def test_staged_tables_are_released(spark):
    from pathlib import Path

    from convlens import session

    staged = session.stage(spark.range(3).toDF("x"))
    folder = Path(staged.inputFiles()[0].removeprefix("file:")).parent
    assert folder.exists() and staged.count() == 3
    assert session.release(spark) >= 1
    assert not folder.exists()
