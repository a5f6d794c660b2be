"""Token ids of documents, written as fixed-width bit-packed blocks and read back.

A file is a Parquet table of blocks, so that any store Spark can write to will
do and a repeated task leaves nothing behind. A block holds whole documents:
their ids, each in the fewest bits that the vocabulary needs, the ids of the
documents, and the place of each one's first id in the block. Blocks know their
part and place in it; parts follow the order of the documents.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convlens.llm import spans
from convlens.session import checkpoint_dir, stage

#: A block ends with the document that brings it to this many ids.
BLOCK_IDS = 1 << 16
#: Pieces remembered by one Python worker, and the characters of the longest of them: some 50 MB.
PIECE_MEMORY, PIECE_CHARS = 300_000, 40
#: Documents, and characters of them, encoded together.
TOGETHER, CHARS = 256, 1 << 19
GAP = re.compile("[ \n]")
NOTHING = np.empty(0, "<u4")


#: Widths of whole bytes that numpy knows: the same layout in one step.
WHOLE = {8: "u1", 16: "<u2", 32: "<u4"}


def width_of(vocabulary: int) -> int:
    """Fewest bits that hold every id of a vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as consecutive little-endian bit fields."""
    if width in WHOLE:
        return ids.astype(WHOLE[width]).tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width], bitorder="little").tobytes()


def unpack(packed: bytes, width: int, start: int, n: int) -> np.ndarray:
    """`n` ids from place `start` on, without reading the ones before."""
    first = start * width
    if width in WHOLE:
        return np.frombuffer(packed, WHOLE[width], n, first >> 3).astype(np.uint32)
    raw = np.frombuffer(packed, np.uint8, offset=first >> 3)[: ((n * width + (first & 7) + 7) >> 3)]
    raw = np.concatenate([raw, np.zeros(8, np.uint8)])
    at = np.arange(n, dtype=np.int64) * width + (first & 7)
    byte, shift = at >> 3, (at & 7).astype(np.uint64)
    value = np.zeros(n, np.uint64)
    for i in range((width + 14) >> 3):
        value |= raw[byte + i].astype(np.uint64) << np.uint64(8 * i)
    return ((value >> shift) & np.uint64((1 << width) - 1)).astype(np.uint32)


# --- encoding -------------------------------------------------------------

# The rules of a tokenizer file that `PieceEncoder` follows piece by piece.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}

#: The last character of the blocks in which all three rules act on single characters: basic, supplement and extension A of Latin.
PLAIN_END = "\u017f"
#: What may follow an apostrophe that begins a piece, to form one with it.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
SPACE, LETTER, NUMBER, MARK = range(4)


def _kinds() -> np.ndarray:
    """Space, letter, number or mark, for each code point that lower-casing a plain text may give."""
    kinds = np.full(0x340, MARK, np.uint8)
    for i in range(ord(PLAIN_END) + 1):
        kinds[i] = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(i))[0], MARK)
    kinds[[*range(9, 14), 0x20, 0x85, 0xA0]] = SPACE
    return kinds


KINDS = _kinds()


def pieces(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first places, places behind) of the pieces that `SPLIT` finds in lower-cased plain text."""
    kind = KINDS[points]
    before = np.concatenate([[np.uint8(SPACE)], kind[:-1]])
    start = (kind != SPACE) & ((kind != before) | (kind == NUMBER))
    stop = (before != SPACE) & ((kind != before) | (before == NUMBER))
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    for at in np.flatnonzero((points == ord("'")) & (before != MARK)).tolist():
        for suffix in SUFFIXES:
            if all(padded[at + 1 + i] == ord(c) for i, c in enumerate(suffix)):
                start[at + 1] = stop[at + 1] = False
                behind = at + 1 + len(suffix)
                if behind < len(points):
                    stop[behind] = True
                    start[behind] = kind[behind] != SPACE
                break
    ends = np.flatnonzero(stop)
    return np.flatnonzero(start), np.append(ends, len(points)) if len(points) and kind[-1] != SPACE else ends


class WholeEncoder:
    """Encodes whole texts: what any tokenizer file allows."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.vocabulary = tokenizer.get_vocab_size(with_added_tokens=True)

    def many(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        found = self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
        return [np.array(f.ids, "<u4") for f in found]


class Memory:
    """Ids of pieces by their hash. Bounded: the older half is given up, except for what was used since."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def get(self, keys: list[int]) -> list[bytes | None]:
        found = list(map(self.young.get, keys))
        for i, ids in enumerate(found):
            if ids is None and (ids := self.old.get(keys[i])) is not None:
                found[i] = self.young[keys[i]] = ids
        return found

    def put(self, new) -> None:
        self.young.update(new)
        if len(self.young) > self.limit // 2:
            self.old, self.young = self.young, {}


class PieceEncoder(WholeEncoder):
    """Encodes plain texts piece by piece, remembering pieces; other texts as a whole.

    For a file with the rules above. Up to `PLAIN_END` no two characters combine
    and lower case is a matter of single characters, so normalising is
    lower-casing and the split follows kinds of characters. A text with any
    other character, or with what may be an added token, is encoded whole.

    Pieces are found and hashed for many texts at once; each different one is
    looked up once, and the ids are gathered in the order of the pieces.
    """

    def __init__(self, tokenizer):
        super().__init__(tokenizer)
        self.memory = Memory(PIECE_MEMORY)
        added = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        self.other = re.compile("|".join([f"[^\0-{PLAIN_END}]", *added])).search
        # The model alone, for pieces spelt as it wants them, with white space between.
        spell = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {c: spell(chr(c))[0][0] for c in range(len(KINDS)) if chr(c) != " "}
        self.model = tokenizers.Tokenizer(tokenizer.model)
        self.model.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
        self.closes = np.zeros(self.vocabulary, bool)
        self.closes[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def _learn(self, some: list[str]) -> list[bytes]:
        """Ids of pieces, encoded many at a time: the ids that close a piece part them."""
        out = []
        for start in range(0, len(some), 1000):
            part = some[start : start + 1000]
            ids = np.array(self.model.encode_batch_fast([" ".join(part).translate(self.spelling)])[0].ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                raw, cuts = ids.tobytes(), (4 * ends).tolist()
                out += [raw[a:b] for a, b in zip([0, *cuts], cuts)]
            else:
                out += [np.array(self.model.encode(p.translate(self.spelling)).ids, "<u4").tobytes() for p in part]
        return out

    @staticmethod
    def fits(rules: dict) -> bool:
        """Whether a tokenizer file has the rules that pieces rely on."""
        normalizer, split = rules.get("normalizer") or {}, rules.get("pre_tokenizer") or {}
        return (
            normalizer.get("normalizers") == NORMALIZER
            and split.get("pretokenizers") == [{"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}, BYTES]
            and rules.get("post_processor") is None
            and rules.get("truncation") is None
            and rules["model"].get("type") == "BPE"
            and not rules["model"].get("dropout")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in rules["added_tokens"])
        )

    def _plain(self, low: list[str]) -> list[np.ndarray]:
        """The ids of lower-cased plain texts."""
        text = "\n".join(low)
        points = spans.codes(text)
        starts, stops = pieces(points)
        if not len(starts):
            return [np.empty(0, "<u4") for _ in low]
        sizes = stops - starts
        short = sizes <= PIECE_CHARS
        # A long piece gets a number of its own, above which no hash lies.
        keys = np.empty(len(starts), np.uint64)
        keys[short] = spans.mix(spans.sums(points, starts[short], stops[short], PIECE_CHARS)) >> np.uint64(1)
        keys[~short] = (1 << 63) + np.arange(np.count_nonzero(~short), dtype=np.uint64)
        each, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        n_short = int(np.searchsorted(each, np.uint64(1 << 63)))
        listed = each[:n_short].tolist()
        found = self.memory.get(listed) + [None] * (len(each) - n_short)
        lacking = [i for i, ids in enumerate(found) if ids is None]
        if lacking:
            at = first[lacking]
            new = self._learn([text[a:b] for a, b in zip(starts[at].tolist(), stops[at].tolist())])
            for i, ids in zip(lacking, new):
                found[i] = ids
            self.memory.put((listed[i], found[i]) for i in lacking if i < n_short)
        flat = np.frombuffer(b"".join(found), "<u4")
        length = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        begin = np.cumsum(length) - length
        n = length[inverse]
        upto = np.cumsum(n)
        ids = flat[np.repeat(begin[inverse] - (upto - n), n) + np.arange(upto[-1])]
        # Where each text's pieces, and so its ids, end.
        behind = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in low]))
        cuts = np.concatenate([[0], upto])[behind].tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    def many(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text. Long plain texts are cut at white space, which no piece holds."""
        parts, owner, whole = [], [], []
        for i, text in enumerate(texts):
            if text and self.other(text):
                whole.append(i)
            elif text:
                low = text.lower()
                while len(low) > CHARS and (gap := GAP.search(low, CHARS)):
                    parts.append(low[: gap.end()])
                    owner.append(i)
                    low = low[gap.end() :]
                parts.append(low)
                owner.append(i)
        out: dict[int, np.ndarray] = {}
        for a, b in spans.together([len(p) + 1 for p in parts], CHARS):
            for i, ids in zip(owner[a:b], self._plain(parts[a:b])):
                out[i] = np.concatenate([out[i], ids]) if i in out else ids
        if whole:
            out.update(zip(whole, super().many([texts[i] for i in whole])))
        return [out.get(i, NOTHING) for i in range(len(texts))]


@lru_cache(maxsize=1)
def encoder_for(path: str) -> WholeEncoder:
    """One encoder while a Python worker lives: piece by piece where the file's rules allow it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    tokenizer = tokenizers.Tokenizer.from_file(path)
    return (PieceEncoder if PieceEncoder.fits(rules) else WholeEncoder)(tokenizer)


# --- files ----------------------------------------------------------------


def _layout(id_type: str) -> str:
    return (
        f"part int, block bigint, first bigint, width int, n_ids bigint, docs array<{id_type}>, "
        "starts array<bigint>, packed binary"
    )


def write_blocks(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int | None,
    id_col: str = "doc_id",
    text: str = "text",
    encoder: Callable[[str], WholeEncoder] = encoder_for,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every whole text and write its ids, in ascending order of the documents' ids.

    `end_id` closes each document. Null and empty texts have no ids but that
    one; null document ids come first; rows that repeat an id follow each other.
    A block is never larger than `block_ids` and one document.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder_of = encoder(tokenizer_path)
        width, part = width_of(encoder_of.vocabulary), TaskContext.get().partitionId()
        end = np.array([] if end_id is None else [end_id], "<u4")
        block, first, held, ids, starts, total = 0, 0, [], [], [], 0

        def row():
            packed = pack(np.concatenate(ids), width)
            values = [part], [block], [first], [width], [total], [held], [starts], [packed]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            schema = pa.schema([
                ("part", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("width", pa.int32()), ("n_ids", pa.int64()),
                ("docs", pa.list_(batch.schema.field("_id").type)), ("starts", pa.list_(pa.int64())), ("packed", pa.binary()),
            ])
            for at in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(at, TOGETHER)
                for doc, own in zip(some.column("_id").to_pylist(), encoder_of.many(some.column("_text").to_pylist())):
                    held.append(doc)
                    starts.append(total)
                    ids += [own, end]
                    total += len(own) + len(end)
                    if total >= block_ids:
                        yield row()
                        block, first, held, ids, starts, total = block + 1, first + total, [], [], [], 0
        if held:
            yield row()

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    order = [F.col("_id"), F.xxhash64("_text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.mapInArrow(encode, _layout(id_type)).write.parquet(path)


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of each document, from the files alone.

    `start` counts the ids of all documents before it. Only totals per part meet
    in one place; the ids are unpacked where the blocks lie.
    """
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Written first, so that Spark knows how small it is and leaves the blocks where they are.
    offsets = stage(totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    id_type = blocks.schema["docs"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack(r["packed"], r["width"], 0, r["n_ids"]).astype("<u4")
                starts = r["starts"]
                sizes = np.diff([*starts, r["n_ids"]])
                crc = [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(starts, sizes)]
                values = [r["docs"], np.array(starts) + r["first"] + r["_before"], sizes, crc]
                types = [batch.schema.field("docs").type.value_type, pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(values, types)], names=[id_col, "start", "n_tokens", "ids_crc32"]
                )

    placed = blocks.join(offsets, "part").drop("part", "block")
    return placed.mapInArrow(decode, f"`{id_col}` {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_ids(spark: SparkSession, path: str, doc_ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, ids) of chosen documents: of each block, only their own bits are unpacked."""
    blocks = spark.read.parquet(path)
    ends = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array("n_ids"))
    one = F.explode(F.arrays_zip(F.col("docs").alias("doc"), F.col("starts").alias("start"), ends.alias("end")))
    placed = blocks.select("packed", "width", one.alias("d"))
    chosen = placed.join(doc_ids.select(F.col(id_col).alias("_id")), F.col("d.doc") == F.col("_id"), "left_semi")

    @F.arrow_udf("array<bigint>")
    def ids_of(packed: pa.Array, width: pa.Array, start: pa.Array, end: pa.Array) -> pa.Array:
        rows = zip(packed.to_pylist(), width.to_pylist(), start.to_pylist(), end.to_pylist())
        return pa.array([unpack(p, w, s, e - s).tolist() for p, w, s, e in rows], pa.list_(pa.int64()))

    return chosen.select(F.col("d.doc").alias(id_col), ids_of("packed", "width", "d.start", "d.end").alias("ids"))


def new_path(spark: SparkSession) -> str:
    """A fresh folder for one run's files, in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/ids-{uuid.uuid4().hex}"
