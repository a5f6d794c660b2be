"""Document fingerprints: peeling recovers what set differences give, and versions match plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from convlens.llm import fingerprints as P


def paragraphs(text):
    return Counter(p for p in re.split(r"\n+|(?<=[.!?])[ \t]+", text) if p)


def jaccard(a, b):
    a, b = paragraphs(a), paragraphs(b)
    either = sum((a | b).values())
    return sum((a & b).values()) / either if either else 1.0


def random_text(rng, n):
    return "".join(rng.choice(["One two.", "Three!", "four", "ä ß", "É", "five six seven?"]) + str(rng.randrange(40)) + rng.choice([". ", "\n", " ", "\n\n"]) for _ in range(n))


def test_peeling_recovers_differences():
    """From no difference to thousands, which take several retries."""
    rng = random.Random(5)
    pairs = []
    for n in (0, 1, 3, 10, 50, 400, 3000):
        a = random_text(rng, n)
        pairs += [(a, a), (a, a + "\nnew"), (a, random_text(rng, n)), (a, ""), (a, "\n".join(reversed(a.split("\n"))))]
    left, right = P.paragraph_keys([a for a, _ in pairs]), P.paragraph_keys([b for _, b in pairs])
    owner, key, side = P.differences(left, right)
    for i in range(len(pairs)):
        mine, theirs = (set(k.of(np.array([i]))[0].tolist()) for k in (left, right))
        own = owner == i
        assert set(key[own & (side == 1)].tolist()) == mine - theirs and set(key[own & (side == -1)].tolist()) == theirs - mine
        assert own.sum() == len(mine ^ theirs)
    assert P.likeness(left, right).tolist() == pytest.approx([jaccard(a, b) for a, b in pairs])


def test_repeated_paragraphs_count():
    keys = P.paragraph_keys(["a\na\na\nb", "a\nb", ""])
    assert keys.sizes().tolist() == [4, 2, 0] and len(set(keys.keys[:4].tolist())) == 4
    assert P.likeness(P.paragraph_keys(["a\na\na\nb"]), P.paragraph_keys(["a\nb"])).tolist() == [0.5]


def brute(docs):
    ordered = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for i, (doc, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        new = text[: len(text) - n] + after[:n]
        out[doc] = len(text), hashlib.sha256(new.encode()).hexdigest(), jaccard(text, new), jaccard(text, after)
    return out


def test_versions(spark):
    """Null and empty texts, a null id, copies, one very long text, clashing columns, many ranges."""
    rng = random.Random(3)
    docs = [(i * 3 - 40, random_text(rng, rng.randrange(0, 30))) for i in range(150)]
    docs += [(1000, None), (1001, ""), (1002, docs[5][1]), (1003, docs[5][1]), (None, "no id. here"), (1004, "word " * 200_000), (1005, "\n\n")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"part": F.lit(1), "kind": F.lit("k"), "n_chars": F.lit(-1)})
    out = P.versions(df.repartition(7)).collect()
    expected = brute(docs)
    assert len(out) == len(docs)
    for r in out:
        assert (r.n_chars, r.edited_sha256) == expected[r.doc_id][:2], r.doc_id
        assert (r.near_edited, r.near_next) == pytest.approx(expected[r.doc_id][2:])
    prints = {r.doc_id: r for r in out}
    assert prints[1002].fingerprint == prints[1003].fingerprint == prints[docs[5][0]].fingerprint
    assert len({r.fingerprint for r in out}) == len({tuple(sorted(paragraphs(t or "").items())) for _, t in docs})
    assert prints[1002].near_next == 1.0


def test_few_rows(spark):
    one = spark.createDataFrame([(5, "a\nb\nc\nd")], "doc_id int, text string")
    row = P.versions(one).first()
    assert (row.doc_id, row.near_next) == (5, 1.0) and row.edited_sha256 == hashlib.sha256(b"a\nb\nc\na"[:6] + b"a").hexdigest()
    assert P.versions(one.limit(0)).count() == 0
    twice = P.versions(one.union(one)).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
