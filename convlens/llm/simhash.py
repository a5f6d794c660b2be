"""Near-duplicates by SimHash fingerprints and deletion-variant signatures.

Fingerprints link when they differ in at most `max_bits` bits. Cut into
`max_bits // 2 + 1` segments, two linked fingerprints have a segment that differs
in at most one bit; with that bit as a wildcard both index the same variant. An
equality join on the variants brings candidates together, and each is verified
by its bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.llm.components import components
from convlens.session import stage

SEED = 42
#: Shingles unpacked to bits at a time: 64 bytes each.
PIECE = 1 << 16
#: Members of one variant compared directly. Larger variants are cut anew by
#: further segments until the bits that are left free bound their size.
DIRECT = 2048
#: Further cuts of a large variant.
LEVELS = 2
#: Where a variant holds its segment's number, and the largest number.
NUMBER_AT, NUMBERS = 38, (1 << 12) - 1


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each word shingle; ASCII letters lower-cased, ASCII white space between words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(g, SEED) for g in grams], np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half of the hashes, as a signed long."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), PIECE):
        part = hashes[start : start + PIECE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """SimHash of a whole text as a long. A null text or one without a word gives 0."""

    def of(texts: pa.Array) -> pa.Array:
        return pa.array([majority_bits(shingle_hashes(t.as_py(), shingle)) for t in texts], pa.int64())

    return F.arrow_udf(of, "bigint")(text)


# --- variants -------------------------------------------------------------


def _spans(start: int, width: int, parts: int) -> list[tuple[int, int]]:
    """(first bit, width) of equal parts of a run of bits."""
    cuts = [start + width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _variants(fp: Column, spans: list[tuple[int, int]], own: int = 0) -> Column:
    """All one-wildcard variants of the segments: the segment's number, from `own` on, and the wildcard above the masked bits."""
    keys = []
    for i, (first, width) in enumerate(spans):
        value = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
        for p in range(width):
            tag = (own + i) << NUMBER_AT | p << 32
            keys.append(value.bitwiseAND(F.lit(~(1 << p)).cast("bigint")) + F.lit(tag).cast("bigint"))
    return F.array(*keys)


def _number(variant: Column) -> Column:
    return F.shiftrightunsigned(variant, NUMBER_AT).bitwiseAND(F.lit(NUMBERS).cast("bigint"))


def _rest(spans: list[tuple[int, int]], parts: int) -> list[list[tuple[int, int]]]:
    """For each segment, what is left to cut inside its variants: all other segments, each in equal parts."""
    return [[s for j, (f, w) in enumerate(spans) if j != i for s in _spans(f, w, parts)] for i in range(len(spans))]


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= max_bits


def _forest(members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the components of a few fingerprints: each to its component's smallest place."""
    label = np.arange(len(members))
    while True:
        low = np.empty_like(label)
        for at in range(0, len(members), DIRECT):  # a block of rows at a time
            near = _near(members[at : at + DIRECT, None], members[None, :], max_bits)
            low[at : at + DIRECT] = np.where(near, label[None, :], len(members)).min(axis=1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = label != np.arange(len(members))
    return members[moved], members[label[moved]]


def _links(max_bits: int, direct: int):
    """Stream rows sorted by variant; give verified links, and the rows of variants too large to compare."""

    def batch(key, a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(a.view(np.int64)), pa.array(b, pa.int64())], ["variant", "a", "b"]
        )

    def solve(keys: np.ndarray, fps: np.ndarray):
        """Whole variants: pairs of small ones at once, each larger one by its forest."""
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        each = np.repeat(sizes, sizes)
        left, right = [], []
        small = (each > 1) & (each <= 8)
        k, f = keys[small], fps[small]
        for step in range(1, 8):
            same = k[step:] == k[:-step]
            a, b = f[step:][same], f[:-step][same]
            ok = _near(a, b, max_bits)
            left.append(a[ok])
            right.append(b[ok])
        for at in np.flatnonzero(sizes > 8):
            a, b = _forest(fps[starts[at] : starts[at] + sizes[at]], max_bits)
            left.append(a)
            right.append(b)
        a, b = np.concatenate(left), np.concatenate(right)
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
        return batch([None] * len(pairs), np.ascontiguousarray(pairs[:, 0]), pairs[:, 1].view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f, over = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for part in batches:
            keys = np.concatenate([held_k, part.column("variant").to_numpy()])
            fps = np.concatenate([held_f, part.column("fp").to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            last = np.searchsorted(keys, keys[-1])
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            sizes = np.repeat(np.diff(np.r_[starts, len(keys)]), np.diff(np.r_[starts, len(keys)]))
            large = (sizes > direct) | (keys == over if over is not None else False)
            if large.any():
                yield batch(keys[large], fps[large], np.ma.masked_all(large.sum(), np.int64).filled(0)).set_column(
                    2, "b", pa.nulls(int(large.sum()), pa.int64())
                )
                over = keys[-1] if large[-1] else None
            whole = ~large & (np.arange(len(keys)) < last)
            if whole.any():
                yield solve(keys[whole], fps[whole])
            rest = ~large & (np.arange(len(keys)) >= last)
            held_k, held_f = keys[rest], fps[rest]
        if len(held_k):
            yield solve(held_k, held_f)

    return run


def links(fps: DataFrame, max_bits: int = 3, direct: int = DIRECT) -> DataFrame:
    """(a, b): links that join all distinct fingerprints within `max_bits`, directly or through others.

    `fps` has one column `fp` of distinct longs. A variant shared by more than
    `direct` fingerprints is cut again, by one-wildcard variants of its other
    segments: they too differ in few enough bits for one part to match. Each cut
    fixes bits that were free before, and after the last one (for `max_bits` of
    2 or 3, eleven free bits: at most 2,048 fingerprints) the rest is compared. No group is
    dropped.
    """
    parts = max(2, max_bits // 2 + 1)
    segments = [_spans(0, 64, parts)]
    rows = fps.select("fp", F.explode(_variants(F.col("fp"), segments[0])).alias("variant"))
    found, level = [], 0
    while True:
        task = _links(max_bits, direct if level < LEVELS else 1 << 62)
        table = stage(
            rows.repartition("variant").sortWithinPartitions("variant").mapInArrow(task, "variant bigint, a bigint, b bigint")
        )
        found.append(table.filter("b IS NOT NULL").select("a", "b"))
        over = table.filter("b IS NULL").select("variant", F.col("a").alias("fp"))
        if level == LEVELS or over.isEmpty():
            break
        level += 1
        segments = [rest for spans in segments for rest in _rest(spans, parts)]
        finer, own = F.lit(None).cast("array<bigint>"), 0
        for number, spans in enumerate(segments):
            finer = F.when(_number(F.col("variant")) == number, _variants(F.col("fp"), spans, own)).otherwise(finer)
            own += len(spans)
        cut = over.select("fp", "variant", F.explode(finer).alias("_v"))
        # The hash of both keys, with the number of the segment in its place.
        mask = F.lit(NUMBERS << NUMBER_AT).cast("bigint")
        mixed = F.xxhash64("variant", "_v").bitwiseAND(F.bitwise_not(mask)).bitwiseOR(F.col("_v").bitwiseAND(mask))
        rows = cut.select("fp", mixed.alias("variant"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    Rows of equal fingerprint are one node, so copies make no pairs. component_id
    is the smallest id that can be reached; null ids are kept and count for
    nothing. Null and empty texts have fingerprint 0 and link like any other;
    repeated rows stay repeated; an empty table gives an empty table.
    """
    marked = stage(docs.select(F.col(id_col).alias("_id"), fingerprint(F.col(text), shingle).alias("fp")))
    nodes = stage(marked.groupBy("fp").agg(F.min("_id").alias("first")))
    tree = components(links(nodes.select("fp"), max_bits))
    rooted = nodes.join(tree, nodes.fp == tree.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(lowest, "root").select("fp", "component_id")
    out = marked.join(classes, "fp")
    return out.select(
        F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The document with the smallest id of each group, with all its columns.

    Rows that repeat an id are one document and leave one row. Rows without an
    id belong to no named document and all stay.
    """
    found = groups(docs.select(id_col, text), id_col, text, shingle, max_bits)
    keep = found.filter(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("_keep")).distinct()
    packed = docs.select(F.col(id_col).alias("_id"), F.struct("*").alias("_doc"))
    named = packed.join(keep, F.col("_id") == F.col("_keep")).dropDuplicates(["_id"])
    return named.select("_doc.*").unionByName(docs.filter(F.col(id_col).isNull()))
