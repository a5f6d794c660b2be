"""The trie of conversation prefixes, with subtree totals by a rollup over depth bands.

A node is a distinct sequence of first turns. Its key is its depth and the
exclusive or of one 128-bit hash per turn, each made of the turn's place and
digest, so that keys are running aggregates over narrow rows: texts are digested
where they lie and never move.

Subtree totals come in two steps. A node explodes to its ancestors inside its
band of `band` depths, never further; the totals of band roots, completed from
the deepest band upwards, are then handed across bands. The explosion is at most
`band` rows a node, and there is one round per band.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.operators.ranking import running_totals
from convlens.session import stage

#: Depths of a band, and places of a conversation that one window sees: a multiple of any sensible band.
BAND, SEGMENT = 16, 1 << 10
#: Ids written into one piece of an `ends` list before it is hashed.
PIECE = 256
#: Parts that the children of one node are dealt into when they look up their parent.
SALTS = 64

KEY = ["depth", "k1", "k2"]


def marks(rows: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, place, mark, size) of every turn: its 1-based place, a digest of role and text, the text's UTF-8 bytes.

    Turns go in ascending order, null first; equal turns by their digests. A
    null role or text is empty. Rows without a conversation belong to none and
    are left out. A conversation of any length is ranked in segments of turns.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    one = F.sha2(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), 256)
    narrow = rows.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(turn).alias("_turn"), F.unhex(one).alias("mark"), F.octet_length(text_).cast("bigint").alias("size")
    )
    segment = F.floor(F.col("_turn") / SEGMENT)
    placed = running_totals(narrow, ["_turn", "mark"], segment, {"place": F.lit(1).cast("bigint")}, ["id"])
    return placed.select("id", "place", "mark", "size")


def conversations(marked: DataFrame) -> DataFrame:
    """(id, turns) of each conversation that has a turn."""
    return marked.groupBy("id").agg(F.count("*").alias("turns"))


def spliced(marked: DataFrame, source: Column, head: Column, longest: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt from the first turns of another one and their own later ones, and all their ids.

    `source` and `head` are expressions over `id`: the conversation whose first
    `head` turns are taken (all if it has fewer, none if it does not exist), and
    the number of a conversation's own turns that they replace, at most `longest`.
    """
    talks = conversations(marked).select("id", source.alias("_from"), head.cast("bigint").alias("_head"))
    have = conversations(marked).select(F.col("id").alias("_from"), F.least("turns", F.lit(longest)).alias("_have"))
    plan = talks.join(have, "_from", "left").withColumn("_taken", F.least("_head", F.coalesce("_have", F.lit(0))))
    plan = stage(plan.select("id", "_from", "_head", "_taken"))
    taken = plan.join(marked.filter(F.col("place") <= longest).withColumnRenamed("id", "_from"), "_from").filter("place <= _taken")
    own = marked.join(plan, "id").filter("place > _head").withColumn("place", F.col("place") - F.col("_head") + F.col("_taken"))
    columns = ["id", "place", "mark", "size"]
    return taken.select(*columns).unionByName(own.select(*columns)), plan.select("id")


def _prefixes(marked: DataFrame, band: int) -> DataFrame:
    """(id, depth, k1, k2, up, size, ends) of every turn: the key of the prefix it ends, and its ancestors' keys.

    `up` lists the ancestors of the node inside its band from the band root down;
    for a band root it lists those of the whole band above.
    """
    place = F.col("place")
    terms = marked.withColumns({
        "_x1": F.xxhash64("place", "mark"), "_x2": F.xxhash64(F.lit("second"), "place", "mark"),
        "_segment": F.floor((place - 1) / SEGMENT), "_band": F.floor((place - 1) / band),
    })
    totals = terms.groupBy("id", "_segment").agg(
        F.bit_xor("_x1").alias("_t1"), F.bit_xor("_x2").alias("_t2"), F.max("place").alias("_last")
    )
    talk = Window.partitionBy("id")
    before = talk.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "id", "_segment", F.max("_last").over(talk).alias("_last"),
        *[F.coalesce(F.bit_xor(f"_t{i}").over(before), F.lit(0)).alias(f"_o{i}") for i in (1, 2)],
    )
    inside = Window.partitionBy("id", "_segment").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    local = terms.withColumns({f"_l{i}": F.bit_xor(f"_x{i}").over(inside) for i in (1, 2)})
    keyed = local.join(offsets, ["id", "_segment"]).withColumns({
        f"k{i}": F.col(f"_l{i}").bitwiseXOR(F.col(f"_o{i}")) for i in (1, 2)
    })
    parent = F.struct(F.col("k1").bitwiseXOR(F.col("_x1")).alias("k1"), F.col("k2").bitwiseXOR(F.col("_x2")).alias("k2"))
    in_band = Window.partitionBy("id", "_segment", "_band").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return keyed.withColumn("up", F.collect_list(parent).over(in_band)).select(
        "id", place.alias("depth"), "k1", "k2", "up", "size", (place == F.col("_last")).alias("ends")
    )


def _exploded(nodes: DataFrame, values: list[str], with_self: bool, band: int) -> DataFrame:
    """Rows (key, child, *values) for the ancestors that a node lists in `up`, and for itself.

    `child` is 1 in the row of the direct parent.
    """
    own = F.struct("k1", "k2")
    listed = F.concat("up", F.array(own)) if with_self else F.col("up")
    first = F.floor((F.col("depth") - 1) / band) * band  # the depth of the first ancestor listed
    rows = nodes.select("depth", F.size("up").alias("_n"), first.alias("_first"), *values, F.posexplode(listed).alias("_i", "_k"))
    return rows.select(
        (F.col("_first") + F.col("_i")).alias("depth"), "_k.k1", "_k.k2", (F.col("_i") == F.col("_n") - 1).cast("bigint").alias("child"), *values
    )


def _ends(rows: DataFrame) -> DataFrame:
    """(key, ends_sha256): the digest of the ids of each node, numerically ascending, joined by commas.

    Ids are sorted and joined into pieces over ranges, so the ids of one node may
    lie in many tasks; a digest is one running hash, so only the pieces of a node
    pass one task, a few at a time.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []

        def close():
            out.append((*key, held[0], ",".join(map(str, held))))

        for batch in batches:
            for *at, id_ in zip(*[c.to_pylist() for c in batch.columns]):
                if at != key or len(held) == PIECE:
                    if held:
                        close()
                    key, held = at, []
                held.append(id_)
            if out:
                yield rows_to_batch(out, batch.schema.field("id").type)
                out = []
            kind = batch.schema.field("id").type
        if held:
            close()
            yield rows_to_batch(out, kind)

    def rows_to_batch(found, kind):
        types = [pa.int64()] * 3 + [kind, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found), types)], names=[*KEY, "first", "piece"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []

        def give():
            names, types = [*KEY, "ends_sha256"], [pa.int64()] * 3 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], names=names)

        for batch in batches:
            for *at, piece in zip(*[c.to_pylist() for c in batch.columns]):
                if at == key:
                    state.update(b"," + piece.encode())
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = at, hashlib.sha256(piece.encode())
            if out:
                yield give()
                out = []
        if key is not None:
            out.append((*key, state.hexdigest()))
            yield give()

    id_type = rows.schema["id"].dataType.simpleString()
    order = [*KEY, "id"]
    keys = "depth bigint, k1 bigint, k2 bigint"
    cut = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    cut = cut.mapInArrow(pieces, f"{keys}, first {id_type}, piece string")
    together = cut.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "piece")
    return together.mapInArrow(digests, f"{keys}, ends_sha256 string")


def _parents(nodes: DataFrame) -> DataFrame:
    """(key, parent_conv_id) of every node but the root.

    The children of one node may be a third of all nodes. They are dealt into
    parts; each part looks its parent up once, and a child meets its own part only.
    """
    last = F.element_at("up", -1)
    asked = nodes.filter("depth > 0").select(
        *KEY, (F.col("depth") - 1).alias("_d"), last["k1"].alias("_p1"), last["k2"].alias("_p2"),
        F.pmod(F.xxhash64("k1", "k2"), F.lit(SALTS)).alias("_part"),
    )
    parts = asked.select("_d", "_p1", "_p2", "_part").distinct()
    known = nodes.select(F.col("depth").alias("_d"), F.col("k1").alias("_p1"), F.col("k2").alias("_p2"), F.col("conv_id").alias("parent_conv_id"))
    found = parts.join(known, ["_d", "_p1", "_p2"])
    return asked.join(found, ["_d", "_p1", "_p2", "_part"]).select(*KEY, "parent_conv_id")


def trie(marked: DataFrame, ids: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `marked` has (id, place, mark, size) with places 1, 2, ... without gaps;
    `ids` has one row per conversation, those without turns included. The root
    stands for the empty prefix; no conversation, no node. `saved_tokens` adds
    over a subtree, for every node, the bytes of its last text once for each
    member but the first. A turn and place occur once; equal conversations share
    their nodes.
    """
    if SEGMENT % band:
        raise ValueError(f"the band must divide {SEGMENT}")
    prefixes = stage(_prefixes(stage(marked), band))
    inner = prefixes.groupBy(*KEY).agg(
        F.min("id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if("ends").alias("n_ends"),
        F.any_value("up").alias("up"), F.any_value("size").alias("size"),
    )
    zero = F.lit(0).cast("bigint")
    turnless = stage(ids.select("id").join(prefixes.filter("depth = 1").select("id"), "id", "left_anti"))
    n_turnless = turnless.agg(F.count("*"))
    root = ids.agg(F.min("id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", n_turnless.scalar().alias("n_ends"),
        F.array().cast("array<struct<k1:bigint,k2:bigint>>").alias("up"), zero.alias("size"),
    )
    leaf = (F.col("n_convs") == F.col("n_ends")).cast("bigint")
    nodes = stage(inner.unionByName(root).withColumns({
        "leaves": leaf, "saved": (F.col("n_convs") - 1) * F.col("size"),
    }))
    values = ["leaves", "saved"]
    is_root = F.col("depth") % band == 0

    # Inside bands: every node gives to itself and to the ancestors in its band.
    parts = [
        _exploded(nodes.filter(~is_root), values, True, band),
        nodes.filter(is_root).select(*KEY, zero.alias("child"), *values),
    ]

    # Across bands: totals of a band's roots, completed by the roots below, from the deepest band upwards.
    top = F.get("up", F.lit(0))
    to_root = [
        F.when(is_root, F.col("depth")).otherwise(F.col("depth") - F.col("depth") % band).alias("depth"),
        F.when(is_root, F.col("k1")).otherwise(top["k1"]).alias("k1"), F.when(is_root, F.col("k2")).otherwise(top["k2"]).alias("k2"),
    ]
    own = nodes.select(*to_root, *values).groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in values])
    roots = nodes.filter(is_root & (F.col("depth") > 0)).select(*KEY, "up").join(own, KEY)
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    if deepest >= band:
        roots = stage(roots)
    below = None
    for depth in range(deepest - deepest % band, 0, -band):
        here = roots.filter(F.col("depth") == depth)
        if below is not None:
            handed = below.select(top["k1"].alias("k1"), top["k2"].alias("k2"), *[F.col(v).alias(f"_{v}") for v in values])
            handed = handed.groupBy("k1", "k2").agg(*[F.sum(f"_{v}").alias(f"_{v}") for v in values])
            here = here.join(handed, ["k1", "k2"], "left").select(
                *KEY, "up", *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values]
            )
        below = stage(here)
        parts.append(_exploded(below, values, False, band))

    together = parts[0]
    for more in parts[1:]:
        together = together.unionByName(more)
    totals = together.groupBy(*KEY).agg(
        F.sum("child").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    ended = prefixes.filter("ends").select(*KEY, "id").unionByName(
        turnless.select(*[zero.alias(c) for c in KEY], "id")
    )
    out = nodes.join(totals, KEY).join(_parents(nodes), KEY, "left").join(_ends(ended), KEY, "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )
