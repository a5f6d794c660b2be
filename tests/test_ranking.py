"""Order structures that grow with the data, exact quantiles, table differences, Poisson draws."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from convlens.operators import bootstrap, embeddings, models, quality, ranking


def test_no_bucket_above_the_bound(spark):
    """A million rows, bound ten thousand: skewed values, a hot value, one outlier, nulls in front."""
    df = spark.range(1_000_000).select(
        F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") == 1, 1e300).otherwise(F.pow(F.lit(1.0001), (F.col("id") % 100_003).cast("double"))).alias("v"),
        F.col("id").alias("k"),
    )
    bucket = ranking.quantile_bucket(df.filter("v <> 7.0"), "v", 10_000)
    spread = df.filter("v <> 7.0").groupBy(bucket.alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect()
    assert max(r.n for r in spread) <= 10_000 and sum(r.n for r in spread) > 600_000
    assert all(a.hi < b.lo for a, b in zip(spread, spread[1:]))
    # The hot value is cut along the second key.
    both = ranking.tie_bucket(df, "v", "k", 10_000)
    parts = df.groupBy(both.alias("b")).agg(F.count("*").alias("n"), F.min(F.struct("v", "k")).alias("lo"), F.max(F.struct("v", "k")).alias("hi")).orderBy("b").collect()
    assert max(r.n for r in parts) <= 10_000 and all(a.hi < b.lo for a, b in zip(parts, parts[1:]))
    ranked = ranking.running_totals(df, ["v", "k"], both, {"place": F.lit(1).cast("bigint")})
    assert ranked.agg(F.count_distinct("place"), F.max("place")).first() == (1_000_000, 1_000_000)
    later = ranked.filter("v = 7.0").agg(F.min("place"), F.max("place"), F.count("*"), F.corr("place", "k")).first()
    assert later[1] - later[0] + 1 == later[2] and later[3] > 0.999


def test_limits_in_an_array(spark):
    """More limits than nested conditions take."""
    limits = [float(i) for i in range(0, 1000, 2)]
    df = spark.createDataFrame([(x,) for x in (None, -5.0, 0.0, 1.0, 2.0, 997.5, 998.0, 5000.0)], "x double")
    assert [r[0] for r in df.select(ranking.limits_bucket(F.col("x"), limits)).collect()] == [0, 0, 1, 1, 2, 499, 500, 500]
    assert ranking.splitters(df, "x", 100) == [] and ranking.splitters(df.limit(0), "x", 1) == []


@pytest.mark.parametrize("accuracy", [20, 200, 10_000])
def test_quantiles_inside_brackets(spark, accuracy):
    """Hot values, few values, many values, one row and nulls, against numpy."""
    rng = random.Random(accuracy)
    groups = {
        "hot": [5.0] * 900 + [rng.gauss(0, 9) for _ in range(100)], "many": [rng.gauss(0, 1) for _ in range(3000)], "few": [1.0, 2.0], "one": [3.0],
        None: [float(rng.randrange(4)) for _ in range(500)],
    }
    rows = [(g, x) for g, own in groups.items() for x in own] + [("few", None), ("void", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = {r.g: r.q for r in ranking.exact_quantiles(df, "x", probs, ["g"], accuracy).collect()}
    assert set(got) == set(groups)
    for g, own in groups.items():
        assert got[g] == pytest.approx(np.quantile(own, probs).tolist(), abs=1e-12), g
    whole = ranking.exact_quantiles(df, "x", probs, (), accuracy).first().q
    assert whole == pytest.approx(np.quantile([x for own in groups.values() for x in own], probs).tolist(), abs=1e-12)
    assert ranking.exact_quantiles(df.limit(0), "x", probs, ["g"], accuracy).count() == 0


def test_difference_of_equal_and_changed_tables(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"), F.lit(None).cast("int").alias("n"))
    found, compared = quality.table_difference(df, df.select("n", "v", "k").repartition(5), "k")
    assert found.count() == 0 and compared == 1  # one row says so
    one = df.withColumn("v", F.when(F.col("k") == 77, "other").otherwise(F.col("v")))
    found, compared = quality.table_difference(df, one, "k")
    assert [tuple(r) for r in found.collect()] == [(77, "changed")] and compared == 1 + 4 * 16
    nulls = df.unionByName(spark.createDataFrame([(None, "x", 1)], "k long, v string, n int"))
    many = nulls.filter("k IS NULL OR k <> 5").unionByName(df.filter("k = 9"))
    assert sorted(tuple(r) for r in quality.table_difference(df, many, "k")[0].select(F.coalesce("k", F.lit(-1)), "status").collect()) == [
        (-1, "right"), (5, "left"), (9, "changed")]
    assert quality.table_difference(df.limit(0), df.limit(0), "k")[0].count() == 0
    with pytest.raises(ValueError):
        quality.table_difference(df, df.drop("n"), "k")


@pytest.mark.parametrize("n", [1, 5, 32, 33, 1000, 10**9])
def test_draws_are_poisson(spark, n):
    row = spark.range(1).select(bootstrap.draws(F.lit("cell"), F.lit(n).cast("bigint"), 4000).alias("w")).first().w
    assert abs(np.mean(row) - n) < 4 * (n / 4000) ** 0.5 and 0.9 < np.var(row) / n < 1.1
    none = spark.range(1).select(bootstrap.draws(F.lit("cell"), F.lit(0).cast("bigint"), 10).alias("w")).first().w
    assert none == [0] * 10


@pytest.mark.parametrize("bound", [3, 4096])
def test_bootstrap_area_equals_plain_count(spark, bound):
    """Each replicate's area is that of its drawn rows, however the scores are cut into buckets."""
    rng = random.Random(2)
    rows = [(rng.randrange(12) / 10, rng.randrange(2)) for _ in range(80)]
    df = spark.createDataFrame(rows, "s double, y int")
    got = {r.replicate: r.roc_auc for r in bootstrap.roc_auc_replicates(df, "y", "s", 20, bound=bound).collect()}
    cells = sorted(set(rows))
    frame = spark.createDataFrame([(s, y, rows.count((s, y))) for s, y in cells], "s double, y int, n long")
    key = F.concat_ws("|", F.format_string("%.9f", "s"), F.col("y").cast("string"))
    drawn = {(r.s, r.y): r.w for r in frame.select("s", "y", bootstrap.draws(key, F.col("n"), 20).alias("w")).collect()}
    for r in range(20):
        pos, neg = ({s: w[r] for (s, y), w in drawn.items() if y == side} for side in (1, 0))
        wins = sum(a * b * (1.0 if s > t else 0.5 if s == t else 0.0) for s, a in pos.items() for t, b in neg.items())
        assert got[r] == pytest.approx(wins / (sum(pos.values()) * sum(neg.values())))


def test_forward_pass(spark):
    rng = np.random.default_rng(1)
    layers = [(rng.normal(size=(4, 3)).tolist(), rng.normal(size=4).tolist()), (rng.normal(size=(2, 4)).tolist(), rng.normal(size=2).tolist())]
    x = rng.normal(size=(20, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "prob_id int, v array<double>")
    hidden = 1 / (1 + np.exp(-(x @ np.array(layers[0][0]).T + layers[0][1])))
    out = hidden @ np.array(layers[1][0]).T + layers[1][1]
    want = np.exp(out[:, 1]) / np.exp(out).sum(axis=1)
    got = models.forward(df, "v", layers).orderBy("prob_id").collect()
    assert [r.prob for r in got] == pytest.approx(want.tolist()) and [r.pred for r in got] == (want >= 0.5).astype(int).tolist()


def test_micro_batches_and_whole_texts(spark):
    """Texts keep their places; a long text goes alone and whole; blank and null texts have the mean of nothing."""
    lengths = [5, 1, 90_000, 3, 0, 2, 2, 7]
    batches = list(embeddings.micro_batches(lengths, 3, 12))
    assert sorted(i for b in batches for i in b) == list(range(8)) and [2] in [b.tolist() for b in batches]
    assert all(len(b) == 1 or (len(b) <= 3 and len(b) * max(lengths[i] for i in b) <= 12) for b in batches)
    rows = [(i, " ".join(f"w{j % (i + 2)}" for j in range(n))) for i, n in enumerate(lengths)] + [(90, None), (91, " \t")]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("encoder", F.lit("mine"))
    got = {r.id: r.embedding for r in embeddings.embed_tokens(df.repartition(3), "id", "text", lambda: embeddings.HashedTokens(4), "h", 3, 12).collect()}
    one = embeddings.HashedTokens(4)
    for i, text in rows:
        words = (text or "").split()
        want = np.mean([one.token(w) for w in words], axis=0) if words else np.zeros(4)
        assert got[i] == pytest.approx(want.tolist(), abs=1e-6)
