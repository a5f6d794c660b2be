"""The set-similarity join against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from convlens.operators import similarity


def sets_of(text, n):
    w = text.lower().split()
    return {" ".join(w)} if len(w) < n else {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}


def texts(rng, n):
    """Random texts, near copies of a few of them, copies, and one hot word run that all share."""
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:
            w = rng.choice(out).split(" ")
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice("abcdefgh")
        else:
            w = [rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.randrange(1, 40))]
            w += ["common", "words", "in", "every", "text"] * (i % 3 == 0)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("t", [0.5, 0.8, 1.0])
@pytest.mark.parametrize("buckets", [1, 64])
def test_all_links_are_found_and_no_other(spark, t, buckets):
    """Also where every shingle falls into one bucket, so that the order is by hash alone."""
    rng = random.Random(int(10 * t) + buckets)
    left, right = texts(rng, 60), texts(rng, 50)
    right += left[:15]
    a, b = (similarity.text_sets(spark.createDataFrame([(x,) for x in side], "text string"), "text", 3) for side in (left, right))
    found = {(r.key, r.other): r.similarity for r in similarity.similar_sets(a, b, t, buckets).collect()}
    key = {x: spark.sql("SELECT md5(:x)", args={"x": x}).first()[0] for x in {*left, *right}} if t == 0.8 else None
    want = {}
    for x in set(left):
        for y in set(right):
            m, n = sets_of(x, 3), sets_of(y, 3)
            j = len(m & n) / len(m | n)
            if j >= t - 1e-9:
                want[x, y] = j
    assert sorted(round(v, 9) for v in found.values()) == sorted(round(v, 9) for v in want.values())
    if key:
        assert set(found) == {(key[x], key[y]) for x, y in want}


def test_edge_cases(spark):
    """Null, blank and short texts, copies, other columns kept, empty sides."""
    data = [(1, None), (2, " "), (3, "One  two"), (4, "one two"), (5, "lonely words here"), (5, "lonely words here")]
    df = spark.createDataFrame(data, "id long, text string").withColumn("key", F.lit("mine"))
    other = spark.createDataFrame([("ONE TWO",), ("",), (None,), ("one two",)], "text string")
    rows = sorted((r.id, r.n_near, r.nearest, r.key) for r in similarity.with_near(df, "text", other).collect())
    assert [r[:2] for r in rows] == [(1, 0), (2, 1), (3, 1), (4, 1), (5, 0), (5, 0)] and {r[3] for r in rows} == {"mine"}
    kept = similarity.drop_near(df, "text", other)
    assert kept.columns == df.columns and sorted(r.id for r in kept.collect()) == [1, 5, 5]
    assert similarity.drop_near(df, "text", other.limit(0)).count() == 6
    assert similarity.drop_near(df.limit(0), "text", other).count() == 0


def test_items_are_numbers_rarest_first_and_may_fall_together(spark, monkeypatch):
    """An item leads with its bucket's count; with one bit of hash left nearly all shingles fall together and the links are the same."""
    rng = random.Random(5)
    df = spark.createDataFrame([(x,) for x in texts(rng, 80)], "text string")
    sets = similarity.text_sets(df, "text", 3).cache()
    hashes = [h for r in sets.collect() for h in r["items"]]
    held = [sum(h % 64 == b for h in hashes) for b in range(64)]
    fronts = {}
    for r in similarity.prefixes(sets, similarity.bucket_counts(sets, buckets=64), 0.5, 64).orderBy("key", "pos").collect():
        fronts.setdefault(r.key, []).append(r.item >> similarity.HASH_BITS)
    for r in sets.collect():
        assert fronts[r.key] == sorted(held[h % 64] for h in r["items"])[: len(fronts[r.key])]
    want = sorted(map(tuple, similarity.similar_sets(sets, sets, 0.5).collect()))
    monkeypatch.setattr(similarity, "HASH_BITS", 1)
    assert sorted(map(tuple, similarity.similar_sets(sets, sets, 0.5).collect())) == want and len(want) > sets.count()
    sets.unpersist()


def test_shingles_are_not_spelt_out(spark):
    """Shingles come from word hashes; texts of fewer words are one shingle, equal only to themselves."""
    df = spark.createDataFrame([("a b c d",), ("a b",), ("b a",), ("",)], "text string")
    made = similarity.text_sets(df, "text", 3)
    assert "concat_ws" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["size"] for r in made.collect()) == [1, 1, 1, 2]
    assert len({h for r in made.collect() for h in r["items"]}) == 5
