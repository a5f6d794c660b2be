"""Prefix trie against a dictionary of tuples; centroid clustering against plain loops."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from convlens.llm import centroids, prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_trie(talks):
    """Rows of the trie of {id: [(role, text), ...]}."""
    nodes = {}
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    below = {k: [] for k in nodes}
    children = dict.fromkeys(nodes, 0)
    for k in nodes:
        for d in range(len(k) + 1):
            below[k[:d]].append(k)
        if k:
            children[k[:-1]] += 1
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(talks[c]) == len(k))
        out.append((
            min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), children[k],
            sum(children[b] == 0 for b in below[k]),
            sum((len(nodes[b]) - 1) * len(b[-1][1].encode()) for b in below[k] if b), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def rebuilt(talks):
    out = {}
    for c, turns in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = talks.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def rows(spark, talks):
    data = [(c, t, *turn) for c, turns in talks.items() for t, turn in enumerate(turns)]
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


def collected(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("band", [1, 2, 4, 16])
def test_trie_of_rebuilt_conversations(spark, band):
    """Shared beginnings, equal conversations, one that spans many bands, and a hot first turn."""
    rng = random.Random(band)
    talks = {}
    for c in range(1, 60):
        turns = [("user", "hello ä")] * (c % 3 > 0)
        turns += [(rng.choice(["user", "assistant"]), rng.choice(["", "a", "bb", "ü"])) for _ in range(rng.randrange(0, 7))]
        talks[c] = turns or [("user", "x")]
    talks[61] = [("user", f"t{i % 3}") for i in range(40)]
    talks[62] = talks[61][:39] + [("user", "other")]
    talks[7_000_000_000] = talks[61]
    marked = prefix_trie.marks(rows(spark, talks))
    head = F.crc32(F.col("id").cast("string").cast("binary")) % 9
    new, ids = prefix_trie.spliced(marked, F.col("id") - F.col("id") % 5, head, longest=8)
    assert collected(prefix_trie.trie(new, ids, band)) == brute_trie(rebuilt(talks))


def test_places_over_many_segments(spark):
    """A conversation longer than a segment, with gaps, is ranked and keyed without a break."""
    n = 2 * prefix_trie.SEGMENT + 7
    talks = {1: [("user", str(i % 5)) for i in range(n)], 2: [("user", str(i % 5)) for i in range(n - 1)]}
    data = rows(spark, talks).withColumn("turn", F.col("turn") * 3)
    marked = prefix_trie.marks(data)
    assert marked.agg(F.max("place"), F.count_distinct("id", "place")).first() == (n, 2 * n - 1)
    out = prefix_trie.trie(marked, prefix_trie.conversations(marked).select("id")).toPandas()
    assert len(out) == n + 1 and out[out.depth == 0].saved_tokens.item() == n - 1
    assert (out.n_leaves == 1).all() and sorted(out.n_convs.unique()) == [1, 2]


def test_trie_edge_cases(spark):
    """Null and equal turns, null roles, texts and ids, repeated rows, clashing columns, turnless conversations, nothing."""
    data = [
        (10, 1, "user", "b", 1), (10, None, "user", "a", 2), (12, 1, None, None, 3), (12, 1, None, None, 3), (None, 0, "user", "lost", 4),
        (14, 0, "user", "same", 5), (14, 0, "user", "other", 6),
    ]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, place long").withColumn("id", F.lit("x"))
    marked = prefix_trie.marks(df)
    places = {(r["id"], r["size"]): r["place"] for r in marked.filter("id = 10").collect()}
    assert places == {(10, 1): 2} or len(places) == 1
    first = marked.filter("id = 10 AND place = 1").select(F.hex("mark")).first()[0]
    assert first.lower() == hashlib.sha256(b"4:usera").hexdigest()
    both = sorted([hashlib.sha256(f"4:user{t}".encode()).hexdigest() for t in ("same", "other")])
    found = marked.filter("id = 14").orderBy("place").select(F.lower(F.hex("mark"))).collect()
    assert [r[0] for r in found] == both
    # 12 takes its first 4 turns from conversation 10, which has two, and has none beyond them itself.
    new, ids = prefix_trie.spliced(marked, F.lit(10).cast("long"), F.when(F.col("id") == 12, 4).otherwise(0), 8)
    assert new.filter("id = 12").count() == 2
    gone, ids = prefix_trie.spliced(marked, F.lit(99).cast("long"), F.when(F.col("id") == 12, 4).otherwise(0), 8)
    out = {(r.depth, r.conv_id): r for r in prefix_trie.trie(gone, ids).collect()}
    root = out[0, 10]
    assert root.n_convs == 3 and root.parent_conv_id is None and root.ends_sha256 == hashlib.sha256(b"12").hexdigest()
    empty = prefix_trie.marks(df.limit(0))
    assert prefix_trie.trie(*prefix_trie.spliced(empty, F.col("id"), F.lit(1), 8)).count() == 0


def test_many_ends_make_one_digest(spark):
    """More conversations end at one node than a piece holds."""
    n = 3 * prefix_trie.PIECE + 5
    talks = {c: [("user", "hi")] for c in range(n)}
    marked = prefix_trie.marks(rows(spark, talks))
    out = prefix_trie.trie(marked, prefix_trie.conversations(marked).select("id"))
    assert collected(out) == brute_trie(talks)


# --- centroids ---------------------------------------------------------------


def brute_clusters(vectors, k, rounds, seed):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for n, own in members.items():
            centers[n] = [sum(x) // len(own) for x in zip(*own)]
    out = [(i, *reversed(nearest(v))) for i, v in kept]
    total = {n: sum(r[2] for r in out if r[1] == n) for n in range(k)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted([(*r, total[r[1]], sum(total.values()), digest[r[1]]) for r in out], key=str)


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_clusters(spark, rounds):
    rng = random.Random(rounds)
    data = [(i, [float(rng.choice([-0.7, 0.1, 0.3333, 2.5])), rng.gauss(0, 1), rng.gauss(0, 300)]) for i in range(300)]
    data += [(None, [0.0, 0.0, 0.0])] + data[:40]  # a null id and repeated rows
    bad = [(900, None), (901, [1.0]), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 2.0]), (904, [1.0, float("inf"), 2.0])]
    df = spark.createDataFrame(data + bad, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x"))
    out = centroids.cluster(df.repartition(5), dimension=3, k=4, rounds=rounds)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute_clusters(data, 4, rounds, 3)


def test_few_equal_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    out = centroids.cluster(df, dimension=2, k=8, rounds=3).collect()
    assert [(r.cluster, r.distance) for r in out] == [(0, 0), (0, 0)]  # ties go to the smaller number
    assert centroids.cluster(df.limit(0), dimension=2).count() == 0
    huge = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        centroids.cluster(huge, dimension=2)
