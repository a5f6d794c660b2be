"""Frequent n-grams by summaries, and facts of conversations from message rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from convlens.functions import text as TX
from convlens.operators import messages, ngrams


def brute_top(rows, n, k):
    counts = {}
    for c, text in rows:
        w = text.split()
        counts.setdefault(c, Counter()).update(" ".join(w[i : i + n]) for i in range(len(w) - n + 1))
    return sorted((c, g, m, i + 1) for c, own in counts.items() for i, (g, m) in enumerate(sorted(own.items(), key=lambda x: (-x[1], x[0]))[:k]))


@pytest.mark.parametrize("tracked", [8, 64, 10_000])
@pytest.mark.parametrize("flat", [True, False])
def test_top_grams_are_exact(spark, monkeypatch, tracked, flat):
    """A small summary over flat counts proves nothing and falls back; a skewed one is proven from the candidates."""
    rng = random.Random(tracked)
    words = [f"w{i:03d}" for i in range(300)]
    pick = (lambda: rng.choice(words)) if flat else (lambda: words[min(int(rng.expovariate(0.7)), 299)])
    rows = [(i % 2, " ".join(pick() for _ in range(rng.randrange(0, 30)))) for i in range(400)]
    calls = []
    real = ngrams.gram_counts
    monkeypatch.setattr(ngrams, "gram_counts", lambda *a: calls.append(1) or real(*a))
    df = spark.createDataFrame(rows, "c int, text string").repartition(5)
    for n in (1, 2):
        got = ngrams.top_grams(df, TX.words(F.col("text")), "c", n, 5, tracked)
        assert sorted((r.c, r.gram, r.n, r["rank"]) for r in got.collect()) == brute_top(rows, n, 5)
    if tracked == 10_000:
        assert not calls
    if flat and tracked == 8:
        assert calls
    assert ngrams.top_grams(df.limit(0), TX.words(F.col("text")), "c", 1, 5, tracked).count() == 0


def test_facts_of_conversations(spark):
    rows = [
        (1, 0, "user", " "), (1, 1, "assistant", "yo yo"), (1, 2, "user", " hi there "), (1, 3, "USER", "bye"), (2, 0, "assistant", None), (3, 0, "user", ""),
        (3, 1, "human", "x"), (4, 0, "user", None),
    ]
    df = spark.createDataFrame(rows, "k long, turn long, role string, text string")
    size = {r.k: tuple(r)[1:] for r in messages.sizes(df, "k").collect()}
    assert size == {1: (5, 19, 4, 2), 2: (0, 0, 1, 0), 3: (1, 1, 2, 1), 4: (0, 0, 1, 1)}
    own = {r.k: tuple(r)[1:] for r in messages.user_turns(df, "k").collect()}
    assert own == {1: (3, 1, 3, "hi there"), 2: (0, 0, 0, None), 3: (1, 1, 1, "x"), 4: (0, 0, 0, None)}
    assert sorted(tuple(r) for r in messages.topic_texts(df, "k").collect()) == [(1, "hi there"), (3, "x")]
    flags = messages.moderation(df, "k", F.col("text").contains("yo"), {"b": F.col("role") == "assistant", "a": F.col("text") == "x"})
    assert {r.k: (r.harm, r.flagged_categories, r.clean) for r in flags.collect()} == {
        1: (True, ["b"], False), 2: (False, [], False), 3: (False, [], False), 4: (False, [], True)}
    asked = spark.createDataFrame([("BYE",), ("hi  there",), ("x",), (None,), ("other",)], "q string")
    left = lambda last: sorted(str(r.q) for r in messages.drop_seen_turns(asked, "q", df, "k", last).collect())
    assert left(True) == ["None", "hi  there", "other"] and left(False) == ["BYE", "None", "hi  there", "other"]
