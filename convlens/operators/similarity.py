"""Verified near-duplicates: a set-similarity join by prefix filtering.

A text is its set of word shingles. Shingles are put in one global order, the
rarest first; two sets of Jaccard similarity `t` or more must then share a
shingle among the first `n - ceil(t * n) + 1` of each. An inverted index over
these prefixes finds candidates, lengths and positions rule most of them out,
and the exact overlap decides. Nothing is lost and nothing below `t` is linked.

Rarity is counted per bucket of shingle hashes: the table of counts has a fixed
size, so every set orders its own shingles without meeting a vocabulary. A
frequent shingle makes its bucket frequent and moves out of every prefix; the
order needs no more than to be the same everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens import session
from convlens.functions import text as TX

BUCKETS = 1 << 16
#: Bits of an item in the order of rarity that come from its hash; the 24 above them are the count of its bucket.
HASH_BITS = 39


def shingles(tokens: Column, n: int) -> Column:
    """Distinct hashes of the word n-grams; fewer words are one shingle. Pass a named column of word hashes (`word_hashes`).

    A shingle is hashed from the hashes of its words: each word is read once, and no shingle is spelt out.
    """
    full = F.size(tokens) - (n - 1)
    grams = F.transform(F.slice(tokens, F.lit(1), F.greatest(full, F.lit(0))), lambda t, i: F.xxhash64(t, *[F.get(tokens, i + k) for k in range(1, n)]))
    return F.array_distinct(F.when(full < 1, F.array(F.xxhash64(tokens))).otherwise(grams))


def word_hashes(text: Column) -> Column:
    """The hash of each word of a text, in order."""
    return F.transform(TX.words(text), lambda w: F.xxhash64(w))


def text_sets(df: DataFrame, text: str, shingle: int = 5) -> DataFrame:
    """(key, size, items): the shingle set of each different normalised text; a null text has none."""
    known = df.filter(F.col(text).isNotNull()).select(TX.held(TX.normalized(F.col(text))).alias("_n"))
    one = known.select(F.md5("_n").alias("key"), "_n").dropDuplicates(["key"])
    listed = one.select("key", TX.held(word_hashes(F.col("_n"))).alias("_w"))
    made = listed.select("key", TX.held(shingles(F.col("_w"), shingle)).alias("items"))
    return made.select("key", F.size("items").alias("size"), "items")


def bucket_counts(*sets: DataFrame, buckets: int = BUCKETS) -> Column:
    """How many shingles of all sets fall into each bucket: a constant array, whose size does not depend on the data."""
    rows = None
    for one in sets:
        found = one.select(F.explode("items").alias("h")).groupBy(F.pmod("h", F.lit(buckets)).alias("b")).agg(F.count("*").alias("n"))
        rows = found if rows is None else rows.unionByName(found)
    counts = [0] * buckets
    for b, n in rows.groupBy("b").agg(F.sum("n")).collect():
        counts[b] = n
    return F.split(F.lit(",".join(map(str, counts))), ",").cast("array<bigint>")


def at_least(t: float, n: Column) -> Column:
    """Smallest whole number that is t * n or more."""
    return F.ceil(F.lit(t) * n - 1e-9)


def prefixes(sets: DataFrame, counts: Column, t: float, buckets: int = BUCKETS) -> DataFrame:
    """(key, size, item, pos) of the rarest items of each set, as many as a partner must share one of.

    An item is one number: how many shingles its bucket holds, over the last bits
    of its hash. Plain numbers sort several times as fast as pairs. Shingles that
    fall together here make candidates, which the exact overlap rules out.
    """
    def item(h: Column) -> Column:
        n = F.element_at(counts, (F.pmod(h, F.lit(buckets)) + 1).cast("int"))
        return F.coalesce(F.shiftleft(F.least(n, F.lit((1 << 63 - HASH_BITS) - 1)), HASH_BITS).bitwiseOR(h.bitwiseAND((1 << HASH_BITS) - 1)), F.lit(0).cast("bigint"))

    front = F.slice(F.sort_array(F.transform("items", item)), F.lit(1), (F.col("size") - at_least(t, F.col("size")) + 1).cast("int"))
    return sets.select("key", "size", F.posexplode(front).alias("pos", "item")).select("key", "size", "item", "pos")


def similar_sets(left: DataFrame, right: DataFrame, t: float = 0.8, buckets: int = BUCKETS) -> DataFrame:
    """(key, other, similarity) of every left and right set whose Jaccard similarity is `t` or more.

    Both inputs are (key, size, items) with one row per key. They are read
    several times: pass written tables.
    """
    counts = bucket_counts(left, right, buckets=buckets)
    mine = prefixes(left, counts, t, buckets)
    theirs = prefixes(right, counts, t, buckets).select(*[F.col(c).alias(f"_{c}") for c in ("key", "size", "item", "pos")])
    both = F.col("size") + F.col("_size")
    needed = at_least(t / (1 + t), both)
    room = 1 + F.least(F.col("size") - F.col("pos") - 1, F.col("_size") - F.col("_pos") - 1)
    met = mine.join(theirs, F.col("item") == F.col("_item"))
    fits = (F.col("_size") >= at_least(t, F.col("size"))) & (F.col("size") >= at_least(t, F.col("_size"))) & (room >= needed)
    pairs = met.filter(fits).select("key", F.col("_key").alias("other")).distinct()
    # The narrow pairs fetch the one set, then the other.
    full = pairs.join(left, "key").join(
        right.select(F.col("key").alias("other"), F.col("size").alias("_size"), F.col("items").alias("_items")), "other"
    )
    shared = F.size(F.array_intersect("items", "_items"))
    scored = full.select("key", "other", (shared / (F.col("size") + F.col("_size") - shared)).alias("similarity"))
    return scored.filter(F.col("similarity") >= t - 1e-9)


def near_links(df: DataFrame, text: str, other: DataFrame, other_text: str = "text", t: float = 0.8, shingle: int = 5) -> DataFrame:
    """(key, n_near, nearest) of each different text of `df` that has near-duplicates in `other`.

    `n_near` counts different normalised texts. Copies of a text share its key
    (`text_key`) and are worked on once.
    """
    left = session.stage(text_sets(df, text, shingle))
    right = session.stage(text_sets(other, other_text, shingle))
    found = similar_sets(left, right, t)
    return found.groupBy("key").agg(F.count("*").alias("n_near"), F.max("similarity").alias("nearest"))


def text_key(text: Column) -> Column:
    return F.md5(TX.normalized(text))


def with_near(df: DataFrame, text: str, other: DataFrame, other_text: str = "text", t: float = 0.8, shingle: int = 5) -> DataFrame:
    """Add `n_near` and `nearest`: how many texts of another corpus are near-duplicates, and how near the nearest is.

    A null text has none. Rows without any have 0 and null.
    """
    links = near_links(df.select(text), text, other.select(other_text), other_text, t, shingle)
    keyed = df.withColumn("_key", text_key(F.col(text)))
    joined = keyed.join(links.withColumnRenamed("key", "_key"), "_key", "left").drop("_key")
    return joined.withColumn("n_near", F.coalesce("n_near", F.lit(0)))


def drop_near(df: DataFrame, text: str, other: DataFrame, other_text: str = "text", t: float = 0.8, shingle: int = 5) -> DataFrame:
    """The rows whose text is no near-duplicate of any text of another corpus."""
    links = near_links(df.select(text), text, other.select(other_text), other_text, t, shingle).select(F.col("key").alias("_key"))
    return df.withColumn("_key", text_key(F.col(text))).join(links, "_key", "left_anti").drop("_key")
