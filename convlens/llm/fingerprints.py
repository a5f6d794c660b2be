"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A paragraph ends with its line or its sentence. Every paragraph's digest falls
into one cell of each of three tables; a cell holds how many fell in, the
exclusive or of their keys and that of their check sums. Two versions'
sketches subtract cell by cell: what both hold cancels, and peeling cells with a
single key left recovers the paragraphs that differ. Where a sketch is too
small to be peeled, both versions are sketched again in `GROWTH` times as many
cells, until all differing digests are recovered.

The work is done for many documents at once: the cells of all pairs of a group
lie in one array. Groups are bounded by characters, not only by documents.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convlens.session import stage

#: Cells of each of the three tables of a fingerprint, and the factor of a retry.
TABLE, GROWTH = 5, 4
#: Where a paragraph ends: a line break, or white space after the end of a sentence.
ENDS = r"\n+|(?<=[.!?])[ \t]+"
#: Documents and characters worked on together, and cells held at a time.
TOGETHER, CHARS, CELLS = 256, 4_000_000, 1 << 20
#: Peeling rounds after which a sketch counts as too small.
ROUNDS = 200

_split = re.compile(ENDS).split
_SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _check(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys ^ np.uint64(0xD6E8FEB86659FD93)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class Keys:
    """The paragraph keys of some texts: one array, with the text each belongs to in ascending order."""

    def __init__(self, keys: np.ndarray, owner: np.ndarray, texts: int):
        self.keys, self.owner = keys, owner
        self.starts = np.searchsorted(owner, np.arange(texts + 1))

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the chosen texts, and the place of their text among the chosen."""
        n = self.sizes()[chosen]
        own = np.repeat(np.arange(len(chosen)), n)
        first = np.repeat(self.starts[:-1][chosen] - (np.cumsum(n) - n), n)
        return self.keys[first + np.arange(len(own))], own


def paragraph_keys(texts: list[str]) -> Keys:
    """Digests of the paragraphs of each text. The second, third, ... copy of a paragraph has a key of its own."""
    parts = [[p for p in _split(t) if p] for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    owner = np.repeat(np.arange(len(parts)), sizes)
    digest = np.fromiter((xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) for own in parts for p in own), np.uint64, int(sizes.sum()))
    order = np.lexsort((digest, owner))
    d, o = digest[order], owner[order]
    new = np.r_[True, (d[1:] != d[:-1]) | (o[1:] != o[:-1])] if len(d) else np.empty(0, bool)
    at = np.flatnonzero(new)
    copy = np.arange(len(d)) - np.repeat(at, np.diff(np.r_[at, len(d)]))
    return Keys(np.where(copy == 0, d, _mix(d + copy.astype(np.uint64) * np.uint64(_SALTS[0]))), o, len(texts))


class Sketches:
    """Sketches of several texts or pairs: counts, keys and check sums of 3 x `table` cells each."""

    def __init__(self, n: int, table: int):
        self.n, self.table, self.width = n, table, 3 * table
        self.count = np.zeros(n * self.width, np.int32)
        self.key = np.zeros(n * self.width, np.uint64)
        self.check = np.zeros(n * self.width, np.uint32)

    def add(self, keys: np.ndarray, owner: np.ndarray, sign) -> None:
        check = _check(keys)
        for j, salt in enumerate(_SALTS):
            # The table's size enters the hash, so that keys that share all cells part in a larger sketch.
            own = np.uint64(salt * self.table & 0xFFFFFFFFFFFFFFFF)
            cell = (_mix(keys + own) % np.uint64(self.table)).astype(np.int64)
            at = owner * self.width + j * self.table + cell
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, check)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.n, self.table)
        out.count, out.key, out.check = self.count - other.count, self.key ^ other.key, self.check ^ other.check
        return out

    def take(self, chosen: np.ndarray) -> Sketches:
        out = Sketches(0, self.table)
        out.n = len(chosen)
        out.count, out.key, out.check = (a.reshape(self.n, self.width)[chosen].ravel() for a in (self.count, self.key, self.check))
        return out

    def written(self) -> list[str]:
        """Each sketch's cells as text: count, key and check sum, little-endian, in base 64."""
        cells = np.zeros((self.n, self.width), [("count", "<i4"), ("key", "<u8"), ("check", "<u4")])
        for name in ("count", "key", "check"):
            cells[name] = getattr(self, name).reshape(self.n, self.width)
        return [base64.b64encode(row.tobytes()).decode() for row in cells]

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(solved, owner, key, side) of a difference: side 1 for keys of the first version, -1 of the second.

        Keys of a sketch that could not be emptied are given too and mean nothing.
        """
        owners, keys, sides = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int32)]
        for _ in range(ROUNDS):
            at = np.flatnonzero(np.abs(self.count) == 1)
            at = at[_check(self.key[at]) == self.check[at]]
            if not len(at):
                break
            owner, key, side = at // self.width, self.key[at], self.count[at]
            order = np.lexsort((key, owner))
            owner, key, side = owner[order], key[order], side[order]
            first = np.r_[True, (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])]
            owner, key, side = owner[first], key[first], side[first]
            self.add(key, owner, -side)
            owners.append(owner)
            keys.append(key)
            sides.append(side)
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        solved = ~left.reshape(self.n, self.width).any(axis=1)
        return solved, np.concatenate(owners), np.concatenate(keys), np.concatenate(sides)


def sketches(texts: Keys, table: int = TABLE) -> Sketches:
    out = Sketches(len(texts.starts) - 1, table)
    out.add(texts.keys, texts.owner, 1)
    return out


def differences(a: Keys, b: Keys, base: Sketches | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, key, side) of every paragraph that only one text of a pair holds: text i of `a` and text i of `b`.

    `base` is the difference of sketches made before; what it cannot recover is sketched anew in more cells.
    """
    n = len(a.starts) - 1
    if base is None:
        base = sketches(a).minus(sketches(b))
    todo, table = np.arange(n), base.table
    found = []
    while True:
        unsolved = []
        step = max(1, CELLS // (3 * table))
        for at in range(0, len(todo), step):
            part = todo[at : at + step]
            if table == base.table:
                diff = base.take(part)
            else:
                diff = Sketches(len(part), table)
                diff.add(*a.of(part), 1)
                diff.add(*b.of(part), -1)
            solved, owner, key, side = diff.peel()
            keep = solved[owner]
            found.append((part[owner[keep]], key[keep], side[keep]))
            unsolved.append(part[~solved])
        todo = np.concatenate(unsolved) if unsolved else todo
        if not len(todo):
            break
        table *= GROWTH
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3)) if found else (
        np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int32))


def likeness(a: Keys, b: Keys, base: Sketches | None = None) -> np.ndarray:
    """Shared paragraphs over all paragraphs of each pair, from the recovered differences; two texts without any are alike."""
    differing = np.bincount(differences(a, b, base)[0], minlength=len(a.starts) - 1)
    both = a.sizes() + b.sizes()
    shared = (both - differing) / 2
    return np.where(both == 0, 1.0, shared / np.maximum(shared + differing, 1))


# --- documents and their edited versions ------------------------------------


def edited(text: str, other: str) -> str:
    """The last quarter of a text's code points replaced by the first as many, or all, of another text."""
    n = len(text) // 4
    return text[: len(text) - n] + other[:n]


def _groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Lists of (id, text, next text), bounded by documents and characters."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[1]) + len(row[2])
        if len(held) >= TOGETHER or chars >= CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def compared(rows: list[tuple]) -> list[list]:
    """Columns n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of (id, text, next text) rows."""
    texts = [r[1] for r in rows]
    changed = [edited(r[1], r[2]) for r in rows]
    own, new, after = (paragraph_keys(t) for t in (texts, changed, [r[2] for r in rows]))
    mine, theirs = sketches(own), sketches(new)
    return [
        [len(t) for t in texts],
        [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
        mine.written(),
        theirs.written(),
        likeness(own, new, mine.minus(theirs)).tolist(),
        likeness(own, after, mine.minus(sketches(after))).tolist(),
    ]


_FOUND = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_TYPES = [
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]


def _batch(rows: list[tuple], id_type) -> pa.RecordBatch:
    values = [pa.array([r[0] for r in rows], id_type)] + [pa.array(v, t) for v, (_, t) in zip(compared(rows), _TYPES)]
    return pa.RecordBatch.from_arrays(values, names=["_id", *[n for n, _ in _TYPES]])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            some = batch.slice(at, TOGETHER)
            yield from zip(*[some.column(i).to_pylist() for i in range(some.num_columns)])


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted part: all but the last are compared with the row after them; the ends are handed on."""
    from pyspark import TaskContext

    part, held = TaskContext.get().partitionId(), {}

    def pairs():
        for id_, text in _rows(typed()):
            text = text or ""
            if "last" not in held:
                held["first"] = id_, text
            else:
                yield *held["last"], text
            held["last"] = id_, text

    def typed():
        for batch in batches:
            held["type"] = batch.schema.field(0).type
            yield batch

    def out(columns: pa.RecordBatch, kind: int, texts: list):
        n = columns.num_rows
        lead = [pa.array([part] * n, pa.int32()), pa.array([kind] * n, pa.int32()), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays([*lead, *columns.columns], names=["part", "kind", "text", *columns.schema.names])

    for group in _groups(pairs()):
        yield out(_batch(group, held["type"]), 0, [None] * len(group))
    for kind, end in ((1, "first"), (2, "last")):
        if end in held:
            empty = pa.RecordBatch.from_arrays(
                [pa.array([held[end][0]], held["type"]), *[pa.nulls(1, t) for _, t in _TYPES]], names=["_id", *[n for n, _ in _TYPES]]
            )
            yield out(empty, kind, [held[end][1]])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def typed():
        for batch in batches:
            held["type"] = batch.schema.field(0).type
            yield batch

    held: dict = {}
    for group in _groups(_rows(typed())):
        yield _batch(group, held["type"])


def versions(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fingerprint, its edited version's, and how alike they and the next document's are.

    Documents follow each other by id, null ids first, rows of one id by a hash
    of their texts; after the last comes the first, and a lone document follows
    itself. A null text is empty: no paragraph, all cells zero. Equal texts have
    equal fingerprints; so have texts of the same paragraphs in another order.
    `near_edited` and `near_next` are shared paragraphs over all paragraphs of
    both, 1 where both have none. Repeated rows each get a row; other columns
    are not read; an empty table gives an empty table.

    Texts move once, into ranges of ids. Inside a range each row meets the next
    one; only the two rows at the ends of each range meet across ranges.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    order = [F.col("_id"), F.xxhash64("_text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stage(placed.mapInArrow(_inside, f"part int, kind int, text string, _id {id_type}, {_FOUND}"))
    names = ["_id", *[n for n, _ in _TYPES]]
    firsts, lasts = (found.filter(F.col("kind") == k).select("part", "_id", "text") for k in (1, 2))
    # One number per range: the ranges that hold rows, and the one after each.
    ahead = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("part").over(ahead), F.min("part").over(whole)).alias("_next"))
    follow = firsts.select(F.col("part").alias("_next"), F.col("text").alias("_after"))
    ends = lasts.join(after, "part").join(follow, "_next").select("_id", "text", "_after")
    closing = ends.mapInArrow(_across, f"_id {id_type}, {_FOUND}")
    return found.filter("kind = 0").select(*names).unionByName(closing).withColumnRenamed("_id", id_col)
