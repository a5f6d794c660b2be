"""Benchmark passages in documents: SimHash of item-sized windows, then exact similarity.

Every benchmark item is compared with document windows of its own number of
words. Window and item fingerprints are the bit majorities of their word
shingles; Hamming blocks index the items so that every fingerprint within
`radius` bits is found: of `BLOCKS` blocks one differs in at most
`radius // BLOCKS` bits, and all such values of a block are index keys.
Candidates are verified by the weighted Jaccard similarity of the shingles,
each weighing as often as it occurs.

A window can only reach the similarity if enough of its shingles occur in items
of its size. Bitmaps of item shingles, of a size that does not depend on the
data, tell where this is so; other windows get no fingerprint. This loses nothing.

Items, their index and the windows are tables. Items never pass the driver;
what reaches it and the workers is the bitmaps and the different item sizes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.llm import spans
from convlens.session import stage

BLOCKS = 5
#: 64-bit fingerprints of texts of similarity 0.8 differ in 9.7 bits on average with a deviation of 2.9.
RADIUS = 19
BITMAP_BITS = 24
#: Characters hashed at a time, windows fingerprinted at a time, and starts of one region.
CHARS, WINDOWS, RUN = 1 << 19, 1 << 12, 1 << 12
#: Parts that the windows of one fingerprint and the candidates of one item are dealt into.
SALTS = 16


# --- words and shingles -------------------------------------------------------


@cache
def _word_characters() -> np.ndarray:
    """1 for every code point that may be part of a word."""
    table = np.zeros(0x110000, np.int8)
    for found in re.finditer(r"\w+", "".join(map(chr, range(0x110000)))):
        table[found.start() : found.end()] = 1
    return table


def words(text: str | None) -> list[str]:
    """Lower-cased words; punctuation and white space only separate."""
    return re.findall(r"\w+", (text or "").lower())


def _sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, place behind, polynomial sum) of each word in a run of code points."""
    edge = np.diff(_word_characters()[codes], prepend=np.int8(0), append=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return starts, stops, spans.sums(codes, starts, stops, CHARS)


def _long_hashes(low: str) -> np.ndarray:
    """Word hashes of a text of any length: a word cut by the end of a piece is summed up over the pieces."""
    out, carry, carried = [], 0, 0
    for at in range(0, len(low), CHARS):
        codes = spans.codes(low[at : at + CHARS])
        starts, stops, sums = _sums(codes)
        if carried:
            if len(starts) and starts[0] == 0:
                sums[0] = (carry + int(sums[0]) * pow(spans.BASE, carried, 1 << 64)) & 0xFFFFFFFFFFFFFFFF
                if stops[0] == len(codes):
                    carry, carried = int(sums[0]), carried + len(codes)
                    continue
            else:
                out.append(np.array([carry], np.uint64))
            carry = carried = 0
        if len(stops) and stops[-1] == len(codes):
            carry, carried = int(sums[-1]), int(stops[-1] - starts[-1])
            sums = sums[:-1]
        out.append(sums)
    if carried:
        out.append(np.array([carry], np.uint64))
    return spans.mix(np.concatenate(out))


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """A 64-bit hash of every word of each text, computed over the characters of many texts at once."""
    low = [(t or "").lower() for t in texts]
    if any(len(t) > CHARS for t in low):
        return [_long_hashes(t) if t else np.empty(0, np.uint64) for t in low]
    out = []
    for at, end in spans.together([len(t) + 1 for t in low], CHARS):
        starts, _, sums = _sums(spans.codes("\n".join(low[at:end])))
        behind = np.cumsum([len(t) + 1 for t in low[at:end]])
        cuts = [0, *np.searchsorted(starts, behind).tolist()]
        sums = spans.mix(sums)
        out += [sums[a:b] for a, b in zip(cuts, cuts[1:])]
    return out


def gram_hashes(hashed: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every run of k words, from the words' hashes."""
    n = len(hashed) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashed[i : i + n]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def sized(grams: np.ndarray, size: int) -> np.ndarray:
    """Shingles as marks that differ between item sizes."""
    return spans.mix(grams + np.uint64(size * spans.BASE & 0xFFFFFFFFFFFFFFFF))


def window_fingerprints(grams: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Majority bits of `n` shingles from each start; starts ascend."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        end = min(at + WINDOWS, int(np.searchsorted(starts, starts[at] + WINDOWS)))
        lo, hi = starts[at], starts[end - 1] + n
        bits = np.unpackbits(grams[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        upto = np.zeros((hi - lo + 1, 64), np.int32)
        np.cumsum(bits, axis=0, out=upto[1:], dtype=np.int32)
        s = starts[at:end] - lo
        out[at:end] = np.packbits(2 * (upto[s + n] - upto[s]) > n, axis=1, bitorder="little").view("<u8")[:, 0]
        at = end
    return out


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Shared over all shingles, counted as often as they occur."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    shared = int(np.minimum(ca[ia], cb[ib]).sum())
    return shared / (len(a) + len(b) - shared)


# --- items --------------------------------------------------------------------


def _fingerprinted(shingle: int):
    fields = [
        ("size", pa.int32()), ("k", pa.int32()), ("grams", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64())), ("fp", pa.int64()),
    ]

    def of(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            (hashed,) = word_hashes([text.as_py()])
            k = min(shingle, len(hashed))
            if not k:
                out.append(None)
                continue
            grams = gram_hashes(hashed, k)
            fp = window_fingerprints(grams, np.zeros(1, np.int64), len(grams)).view(np.int64)[0]
            out.append({"size": len(hashed), "k": k, "grams": grams.view(np.int64), "marks": sized(grams, len(hashed)).view(np.int64), "fp": fp})
        return pa.array(out, pa.struct(fields))

    return of


def item_table(items: DataFrame, item_id: str = "item_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """(key, item, size, k, grams, marks, fp) of every different item that has a word."""
    made = "struct<size:int,k:int,grams:array<bigint>,marks:array<bigint>,fp:bigint>"
    key = F.md5(F.concat_ws("|", F.col(item_id).cast("string"), F.col(text)))
    rows = items.select(F.col(item_id).alias("item"), F.col(text).alias("_text"), key.alias("key")).distinct()
    rows = rows.select("key", "item", F.arrow_udf(_fingerprinted(shingle), made)("_text").alias("_m")).filter("_m IS NOT NULL")
    return rows.select("key", "item", "_m.*")


def _blocks() -> list[tuple[int, int]]:
    cuts = [64 * b // BLOCKS for b in range(BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _block_values(fp: Column) -> list[Column]:
    return [F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1).cast("bigint")).cast("int") for first, width in _blocks()]


def block_index(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(size, block, value, fp): for each fingerprint, every block value that differs in few enough bits."""
    rows = []
    for b, ((_, width), value) in enumerate(zip(_blocks(), _block_values(F.col("fp")))):
        masks = [sum(1 << i for i in c) for d in range(radius // BLOCKS + 1) for c in combinations(range(width), d)]
        mask = F.explode(F.expr(f"array({','.join(map(str, masks))})")).alias("_mask")
        rows.append(fps.select("size", "fp", mask).select("size", F.lit(b).alias("block"), value.bitwiseXOR(F.col("_mask")).alias("value"), "fp"))
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def candidates(windows: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(size, fp, item_fp) of all pairs of different fingerprints of one size within the radius.

    Both tables have `size` and `fp`. Equality joins of block values; each pair is verified by its bits.
    """
    index = stage(block_index(items.select("size", "fp").distinct(), radius).withColumnRenamed("fp", "item_fp"))
    own = windows.select("size", "fp").distinct()
    probe = own.select("size", "fp", F.posexplode(F.array(*_block_values(F.col("fp")))).alias("block", "value"))
    near = probe.join(index, ["size", "block", "value"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    return near.select("size", "fp", "item_fp").distinct()


# --- windows ------------------------------------------------------------------


class Scanner:
    """Finds the windows of texts that hold enough item shingles."""

    def __init__(self, sizes: list[tuple[int, int]], bitmaps: dict[int, np.ndarray], similarity: float):
        self.sizes, self.bitmaps, self.similarity = sizes, bitmaps, similarity

    def need(self, n: int) -> int:
        """Fewest shingles two sets of n must share to reach the similarity."""
        return math.ceil(2 * n * self.similarity / (1 + self.similarity) - 1e-9)

    def _known(self, hashes: np.ndarray, table: int) -> np.ndarray:
        at = hashes >> np.uint64(64 - BITMAP_BITS)
        return (self.bitmaps[table][at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1

    def _starts(self, known: np.ndarray, n: int) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(known, dtype=np.int64)])
        return np.flatnonzero(upto[n:] - upto[:-n] >= self.need(n))

    def regions(self, hashed: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(size, first start, shingles, fingerprints) of each run of neighbouring windows of one document."""
        made = {}
        for size, k in self.sizes:
            n = size - k + 1
            if len(hashed) < size:
                continue
            if k not in made:
                grams = gram_hashes(hashed, k)
                made[k] = grams, self._known(grams, k)
            grams, known = made[k]
            coarse = self._starts(known, n)
            if not len(coarse):
                continue
            lo, hi = coarse[0], coarse[-1] + n
            starts = lo + self._starts(self._known(sized(grams[lo:hi], size), 0), n)
            if not len(starts):
                continue
            fps = window_fingerprints(grams, starts, n)
            new = np.flatnonzero(np.diff(starts) != 1) + 1
            for a, b in zip(np.r_[0, new], np.r_[new, len(starts)]):
                for c in range(a, b, RUN):
                    d = min(c + RUN, b)
                    yield size, int(starts[c]), grams[starts[c] : starts[d - 1] + n], fps[c:d]

    def hopeful(self, hashed: list[np.ndarray]) -> np.ndarray:
        """Places of the documents that hold enough known shingles for any window at all."""
        whole, ends = np.concatenate(hashed), np.cumsum([len(h) for h in hashed])
        maybe = np.zeros(len(hashed), bool)
        for k in {k for _, k in self.sizes}:
            fewest = min(self.need(size - k + 1) for size, own in self.sizes if own == k)
            at = np.flatnonzero(self._known(gram_hashes(whole, k), k)) if len(whole) >= k else np.empty(0, int)
            maybe |= np.bincount(np.searchsorted(ends, at, "right"), minlength=len(hashed))[: len(hashed)] >= fewest
        return np.flatnonzero(maybe)


def bitmaps(items: DataFrame) -> dict[int, np.ndarray]:
    """Which shingles occur in items: one bitmap for each number of words in a shingle, one (0) of marks."""
    marks = items.select("k", F.explode("grams").alias("h")).unionByName(items.select(F.lit(0).alias("k"), F.explode("marks").alias("h")))
    at = F.shiftrightunsigned("h", 64 - BITMAP_BITS)
    bit = F.expr("shiftleft(1L, cast(_at & 63 AS INT))")
    cells = marks.select("k", at.alias("_at")).groupBy("k", F.shiftright("_at", 6).alias("cell")).agg(F.bit_or(bit).alias("bits"))
    found = cells.toArrow()
    out = {}
    for k in set(found.column("k").to_pylist()):
        own = found.filter(pa.compute.equal(found.column("k"), k))
        table = np.zeros(1 << (BITMAP_BITS - 6), "<i8")
        table[own.column("cell").to_numpy()] = own.column("bits").to_numpy()
        out[k] = table.view(np.uint8)
    return out


def _scan(scanner: Scanner, per_group: int = 256):
    fields = [("digest", pa.string()), ("size", pa.int32()), ("first", pa.int64()), ("grams", pa.list_(pa.int64())), ("fps", pa.list_(pa.int64()))]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, per_group):
                some = batch.slice(at, per_group)
                hashed = word_hashes(some.column("text").to_pylist())
                rows = []
                for i in scanner.hopeful(hashed):
                    digest = some.column("digest")[i].as_py()
                    rows += [(digest, size, first, g.view(np.int64), f.view(np.int64)) for size, first, g, f in scanner.regions(hashed[i])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(zip(*rows), fields)], schema=schema)

    return run


def digest_of(text: Column) -> Column:
    """What documents and their hits meet on: rows of one text have the same hits."""
    return F.md5(text)


def passages(
    texts: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: float = 0.8,
    radius: int = RADIUS,
    shingle: int = 5,
) -> DataFrame:
    """(digest, item, similarity, first_word, n_words): the items each different text holds.

    Of each item, the most similar window is given, the first of equals. Items
    of fewer than `shingle` words are one shingle; items without a word, null
    texts and empty texts match nothing. Repeated items count once.
    """
    known = stage(item_table(items, item_id, item_text, shingle))
    sizes = [(r["size"], r["k"]) for r in known.select("size", "k").distinct().orderBy("size").collect()]
    item_type = known.schema["item"].dataType.simpleString()
    if not sizes:
        none = f"digest string, item {item_type}, similarity double, first_word bigint, n_words bigint"
        return texts.sparkSession.createDataFrame([], none)
    scanner = Scanner(sizes, bitmaps(known), similarity)
    rows = texts.filter(F.col(text).isNotNull()).select(digest_of(F.col(text)).alias("digest"), F.col(text).alias("text"))
    regions = rows.mapInArrow(_scan(scanner), "digest string, size int, first bigint, grams array<bigint>, fps array<bigint>")
    # Copies of a document have the same regions.
    regions = regions.groupBy("digest", "size", "first").agg(F.any_value("grams").alias("grams"), F.any_value("fps").alias("fps"))
    regions = stage(regions)

    # Different fingerprints meet items; a passage that many documents share is searched for once.
    near = candidates(regions.select("size", F.explode("fps").alias("fp")), known, radius)
    keyed = near.join(known.select("key", "size", F.col("fp").alias("item_fp")), ["size", "item_fp"]).select("size", "fp", "key")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    keyed = stage(keyed.withColumn("salt", every))
    windows = regions.select("digest", "size", "first", "grams", F.posexplode("fps").alias("_i", "fp"))
    windows = windows.withColumn("salt", F.pmod(F.xxhash64("digest", "_i"), F.lit(SALTS)).cast("int"))
    n = F.col("size") - F.least("size", F.lit(shingle)) + 1
    met = windows.join(keyed, ["size", "fp", "salt"]).select(
        "digest", "size", (F.col("first") + F.col("_i")).alias("start"), F.slice("grams", F.col("_i") + 1, n).alias("own"), "key", "salt"
    )
    salted = known.select("key", "item", F.col("grams").alias("theirs")).withColumn("salt", every)

    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([weighted_jaccard(np.array(x.as_py()), np.array(y.as_py())) for x, y in zip(a, b)], pa.float64())

    judged = met.join(salted, ["key", "salt"]).withColumn("similarity", F.arrow_udf(alike, "double")("own", "theirs"))
    best = judged.filter(F.col("similarity") >= similarity - 1e-12).groupBy("digest", "key").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("_s"), F.col("size").cast("bigint").alias("n"), "item")).alias("_b")
    )
    return best.select(
        "digest", "_b.item", "_b.similarity", (-F.col("_b._s")).alias("first_word"), F.col("_b.n").alias("n_words")
    )


def with_hits(docs: DataFrame, items: DataFrame, text: str = "text", name: str = "hits", **options) -> DataFrame:
    """Add the items each document holds, in ascending order: item, similarity, and the window's place in words.

    The rules are those of `passages`, which `options` go to. Repeated documents
    each get their hits; the list is empty where nothing is found. A column of
    the name given is replaced; all others are kept.
    """
    found = passages(docs.select(F.col(text).alias("text")), items, "text", **options)
    one = F.struct("item", "similarity", "first_word", "n_words")
    listed = found.groupBy("digest").agg(F.array_sort(F.collect_list(one)).alias("_h"))
    packed = docs.select(F.struct(*[c for c in docs.columns if c != name]).alias("_doc"), digest_of(F.col(text)).alias("digest"))
    joined = packed.join(listed, "digest", "left")
    return joined.select("_doc.*", F.coalesce("_h", F.expr("filter(array(_h[0]), x -> false)")).alias(name))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    text = options.pop("text", "text")
    found = passages(docs.select(F.col(text).alias("text")), items, "text", **options).select("digest").distinct()
    packed = docs.select(F.struct("*").alias("_doc"), digest_of(F.col(text)).alias("digest"))
    return packed.join(found, "digest", "left_anti").select("_doc.*")
