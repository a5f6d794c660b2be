"""Chats of any known layout as canonical turns, and turns as one training text with a loss mask.

A layout is recognised by the hash of its nested field paths, which selects a
declarative mapping to (conversation, turn, role, text). The template marks each
turn; control strings inside texts are escaped so that the text can be read back.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- layouts --------------------------------------------------------------

#: Name -> (field paths, mapping). A mapping lists turns as (role, paths of text joined by a blank line), or an
#: array with its role and text fields. Roles named by a path start with a dot.
LAYOUTS = {
    "turn rows": (["role", "text", "turn"], {"rows": ("turn", "role", "text")}),
    "messages": (["messages[]", "messages[].content", "messages[].role"], {"array": ("messages", "role", "content")}),
    "from and value": (["conversations[]", "conversations[].from", "conversations[].value"], {"array": ("conversations", "from", "value")}),
    "instruction": (["instruction", "input", "output"], {"turns": [("user", ["instruction", "input"]), ("assistant", ["output"])]}),
    "instruction only": (["instruction", "output"], {"turns": [("user", ["instruction"]), ("assistant", ["output"])]}),
    "instruction and context": (["instruction", "context", "response"], {"turns": [("user", ["context", "instruction"]), ("assistant", ["response"])]}),
    "prompt and response": (["prompt", "response"], {"turns": [("user", ["prompt"]), ("assistant", ["response"])]}),
    "prompt and completion": (["prompt", "completion"], {"turns": [("user", ["prompt"]), ("assistant", ["completion"])]}),
    "system and prompt": (["system", "prompt", "response"], {"turns": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]}),
}
#: Other names of the roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: Iterable[str]) -> str:
    """Hash of the field paths a layout consists of, in any order."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


MAPPINGS = {fingerprint(paths): mapping for paths, mapping in LAYOUTS.values()}
#: Field paths of the layouts, the largest first; layouts of one size in the order above.
SHAPES = sorted((frozenset(paths) for paths, _ in LAYOUTS.values()), key=len, reverse=True)


def schema_paths(kind: T.DataType, at: str = "") -> set[str]:
    """Nested field paths of a schema: `a.b` for fields, `a[]` for arrays."""
    if isinstance(kind, T.StructType):
        return set().union(*[schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return {f"{at}[]"} | (schema_paths(kind.elementType, f"{at}[]") if isinstance(kind.elementType, T.StructType) else set())
    return {at}


def value_paths(value, at: str = "") -> set[str]:
    """The same of a parsed JSON value."""
    if isinstance(value, dict):
        return set().union(*[value_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()], set())
    if isinstance(value, list):
        return {f"{at}[]"}.union(*[value_paths(v, f"{at}[]") for v in value if isinstance(v, dict)])
    return {at}


def mapping_of(paths: set[str]) -> dict | None:
    """The mapping of the largest layout whose paths are all present; the first of `LAYOUTS` among equals.

    Other fields do not count, whatever layout their names belong to.
    """
    shape = next((s for s in SHAPES if s <= paths), None)
    return None if shape is None else MAPPINGS[fingerprint(shape)]


def _role(role: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    plain = F.coalesce(role, F.lit(""))
    return F.coalesce(table[plain], plain)


def _blank_joined(columns: list[str]) -> Column:
    kept = [F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)) for c in columns]
    return F.concat_ws("\n\n", *kept)


def canonical(df: DataFrame, id_col: str) -> DataFrame:
    """(id, turn, role, text) from a table of one layout, recognised by its schema.

    Null texts are empty, null roles the empty role. A null or empty array gives
    no turns; null prompts and answers give empty turns. Extra columns do not
    matter, also where their names belong to another layout: the largest layout
    that is whole decides. A schema that no layout fits raises.
    """
    paths = schema_paths(T.StructType([f for f in df.schema.fields if f.name != id_col]))
    mapping = mapping_of(paths)
    if mapping is None:
        raise ValueError(f"no layout has the fields {sorted(paths)}")
    text = lambda c: F.coalesce(c, F.lit(""))
    if "rows" in mapping:
        turn, role, content = mapping["rows"]
        return df.select(id_col, F.col(turn).cast("bigint").alias("turn"), _role(F.col(role)).alias("role"), text(F.col(content)).alias("text"))
    if "array" in mapping:
        name, role, content = mapping["array"]
        each = df.select(id_col, F.posexplode(name).alias("turn", "_m"))
        return each.select(id_col, F.col("turn").cast("bigint"), _role(F.col("_m")[role]).alias("role"), text(F.col("_m")[content]).alias("text"))
    turns = [
        F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(role).alias("role"), _blank_joined(columns).alias("text"))
        for i, (role, columns) in enumerate(mapping["turns"])
    ]
    return df.select(id_col, F.inline(F.array(*turns)))


def record_turns(record: str | None) -> list[tuple[str, str]] | None:
    """(role, text) turns of one JSON record, or None if no layout fits."""
    try:
        value = json.loads(record or "")
    except ValueError:
        return None
    mapping = mapping_of(value_paths(value)) if isinstance(value, dict) else None
    if mapping is None or "rows" in mapping:
        return None
    plain = lambda x: "" if x is None else x if isinstance(x, str) else json.dumps(x)
    if "array" in mapping:
        name, role, content = mapping["array"]
        turns = [(plain(m.get(role)), plain(m.get(content))) for m in value[name] or [] if isinstance(m, dict)]
    else:
        turns = [(r, "\n\n".join(filter(None, (plain(value.get(c)) for c in columns)))) for r, columns in mapping["turns"]]
    return [(ROLES.get(r, r), t) for r, t in turns]


def canonical_records(df: DataFrame, id_col: str, record: str) -> DataFrame:
    """(id, turn, role, text) from JSON records of mixed layouts, each recognised by its own fields.

    A record that is null, broken or of no known layout gives one row with a null
    turn, role and text, so nothing is lost unseen.
    """

    def of(records: pa.Array) -> pa.Array:
        rows = []
        for r in records:
            turns = record_turns(r.as_py())
            rows.append(
                [{"turn": None, "role": None, "text": None}] if turns is None
                else [{"turn": i, "role": role, "text": text} for i, (role, text) in enumerate(turns)]
            )
        return pa.array(rows, pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])))

    listed = F.arrow_udf(of, "array<struct<turn:bigint,role:string,text:string>>")(F.col(record))
    return df.select(id_col, F.inline(listed))


# --- template -------------------------------------------------------------

# The template's control strings.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]
#: Role -> what stands before and after its text. Other roles are named.
TURN = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
_CONTROL_AT = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))


def escape(text: str) -> str:
    """Backslashes doubled, and one set behind the first character of each control string."""
    return _CONTROL_AT.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def turn_text(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its escaped text begins and ends in it."""
    before, after = TURN.get(role) or (f"[ROLE]{escape(role)}[/ROLE][INST] ", " [/INST]")
    body = escape(text)
    return before + body + after, len(before), len(before) + len(body)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, begin, end) of each turn of a formatted text; begin and end bound the escaped text."""
    at = 0
    while at < len(formatted):
        if formatted.startswith("[ROLE]", at):
            end = formatted.index("[/ROLE]", at)
            role, before, after = unescape(formatted[at + 6 : end]), None, " [/INST]"
            begin = end + len("[/ROLE][INST] ")
        else:
            role, (before, after) = next((r, t) for r, t in TURN.items() if formatted.startswith(t[0], at))
            begin = at + len(before)
        end = formatted.index(after, begin)
        yield role, unescape(formatted[begin:end]), begin, end
        at = end + len(after)


# --- on tables ------------------------------------------------------------

#: A conversation longer than this is written as several segments of whole turns.
SEGMENT_CHARS = 1 << 20


def formatted(turns: DataFrame, id_col: str, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """(id, segment, text, loss): each conversation's turns in order as template text.

    `loss` lists the [begin, end) of the assistant texts, in code points. Turns
    stream through their task in order, so a conversation of any length needs
    the memory of one segment. Turns of equal number follow by role and text.
    """
    id_type = turns.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        done: list[tuple] = []
        key, segment, parts, loss, size = None, 0, [], [], 0
        kind = None

        def close():
            done.append((key, segment, "".join(parts), loss))

        def rows():
            columns = list(zip(*done))
            done.clear()
            types = [kind, pa.int64(), pa.string(), span]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["_id", "segment", "text", "loss"])

        for batch in batches:
            kind = batch.schema.field("_id").type
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "role", "text"))):
                if parts and (conv != key or size >= segment_chars):
                    close()
                    segment, parts, loss, size = segment + 1 if conv == key else 0, [], [], 0
                key = conv
                piece, begin, end = turn_text(role, text)
                if role == "assistant":
                    loss.append({"begin": size + begin, "end": size + end})
                parts.append(piece)
                size += len(piece)
            if done:
                yield rows()
        if parts:
            close()
        if done:
            yield rows()

    rows = turns.select(F.col(id_col).alias("_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("_id").sortWithinPartitions("_id", "turn", "role", "text")
    schema = f"_id {id_type}, segment bigint, text string, loss array<struct<begin:bigint,end:bigint>>"
    return ordered.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def read_back(texts: DataFrame, id_col: str) -> DataFrame:
    """(id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from formatted text alone.

    Roles and texts are parsed from the template; the loss mask's spans give what
    is learnt. Digests grow turn by turn, so segments stream like turns.
    """
    id_type = texts.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, kind = None, None, None

        def row():
            n, turns, chars, loss, size = held
            values = [key], [n], [turns.hexdigest()], [chars], [loss.hexdigest()], [size]
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

        for batch in batches:
            kind, out = batch.schema.field("_id").type, []
            for conv, text, loss in zip(*(batch.column(c).to_pylist() for c in ("_id", "text", "loss"))):
                if held is None or conv != key:
                    if held is not None:
                        out.append(row())
                    key, held = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, content, _, _ in parse(text):
                    held[0] += 1
                    held[1].update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
                for span in loss:
                    learnt = unescape(text[span["begin"] : span["end"]])
                    held[2] += len(learnt)
                    held[3].update(learnt.encode("utf-8", "surrogatepass"))
                held[4] += len(text)
            yield from out
        if held is not None:
            yield row()

    rows = texts.select(F.col(id_col).alias("_id"), "segment", "text", "loss")
    ordered = rows.repartition("_id").sortWithinPartitions("_id", "segment")
    schema = f"_id {id_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return ordered.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
