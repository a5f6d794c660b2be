import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from convlens.llm import simhash
from convlens.llm.components import components


def brute_fingerprint(text, shingle=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, max_bits=3):
    """Smallest member of each fingerprint's component, by comparing all."""
    fps = sorted(fps)
    low = list(range(len(fps)))

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= max_bits:
                x, y = sorted((top(i), top(j)))
                low[y] = x
    return {f: fps[top(i)] for i, f in enumerate(fps)}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


TEXTS = ["", None, " \t\n", "One", "one two", "One Two three FOUR five", "é É ß one\x1ctwo three four", "a b c d e", "x " * 500, "word " * 70_000]


@pytest.mark.parametrize("text", TEXTS[:-1])
def test_fingerprint(text):
    assert simhash.majority_bits(simhash.shingle_hashes(text, 3)) == signed(brute_fingerprint(text))


def test_fingerprint_is_the_engines_hash(spark):
    grams = ["one two three", "é ß x"]
    own = [simhash.shingle_hashes(g, 3)[0] for g in grams]
    theirs = [r[0] for r in spark.createDataFrame([(g,) for g in grams], "g string").select(F.xxhash64("g")).collect()]
    assert [signed(int(x)) for x in own] == theirs


@pytest.mark.parametrize("direct", [1, 4, 2048])
@pytest.mark.parametrize("seed", [1, 2])
def test_links_join_what_brute_force_joins(spark, direct, seed):
    """A dense ball of fingerprints, chains, and strangers; small limits force the finer cuts."""
    rng = random.Random(seed)
    center, fps = rng.getrandbits(64), set()
    for _ in range(150):
        f = center
        for _ in range(rng.randrange(0, 9)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    chain = rng.getrandbits(64)
    for i in range(0, 63, 3):
        chain ^= 0b111 << i
        fps.add(chain)
    fps |= {rng.getrandbits(64) for _ in range(100)}
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    found = simhash.links(table, 3, direct).collect()
    low = {signed(f): signed(f) for f in fps}
    changed = True
    while changed:
        changed = False
        for r in found:
            m = min(low[r.a], low[r.b])
            if low[r.a] != m or low[r.b] != m:
                low[r.a] = low[r.b] = m
                changed = True
    want = classes(fps)
    groups = lambda mapping: {frozenset(k for k in mapping if mapping[k] == v) for v in mapping.values()}
    assert groups(low) == {frozenset(map(signed, g)) for g in groups(want)}


def test_other_distances(spark):
    base = 0x0123456789ABCDEF
    table = spark.createDataFrame([(base,), (base ^ 0b11111,), (base ^ (1 << 40),)], "fp bigint")
    pairs = lambda d: {frozenset((r.a, r.b)) for r in simhash.links(table, d).collect()}
    assert pairs(1) == {frozenset((base, base ^ (1 << 40)))}
    assert len({x for p in pairs(6) for x in p}) == 3


def test_groups_of_rows(spark):
    rng = random.Random(5)
    base = [rng.choice("abcdefgh") * rng.randrange(1, 6) for _ in range(400)]
    near = list(base)
    near[200] = "changed"
    rows = [(9, " ".join(base)), (4, " ".join(base).upper()), (7, " ".join(near)), (3, ""), (8, None), (1, "alone here now")]
    rows += [(9, " ".join(base)), (None, "alone here now"), (6, "word " * 70_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("x")).withColumn("_id", F.lit(1))
    got = simhash.groups(df).collect()
    assert len(got) == len(rows)
    prints = {brute_fingerprint(t) for _, t in rows}
    root = classes(prints)
    first = {}
    for i, t in rows:
        r = root[brute_fingerprint(t)]
        first[r] = min(first.get(r, 1 << 60), i if i is not None else 1 << 60)
    want = sorted((str(i), f"{brute_fingerprint(t):016x}", first[root[brute_fingerprint(t)]]) for i, t in rows)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    kept = simhash.keep_one(df).collect()
    # 4 stands for its copies; null ids stay
    assert sorted(str(r.doc_id) for r in kept) == sorted(["None", *{str(v) for v in first.values()}])
    assert set(kept[0].asDict()) == {"doc_id", "text", "fp", "_id"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.groups(df).count() == 0
    assert simhash.keep_one(df).count() == 0


def test_components_of_chain_star_and_repeats(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(5, 5), (100, 101), (None, 3), (3, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 150)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
