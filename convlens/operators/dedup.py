"""Exact and near deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.functions import text as TX


def first_rows(df: DataFrame, keys: Sequence[str], row_id: str, carry: Sequence[str] = ()) -> DataFrame:
    """Row id (and carried narrow columns) of the first row of each key.

    Groups on a digest with a partial minimum, so a key that fills a third of
    the table leaves each task as one narrow row. Null keys are equal.
    """
    key = TX.fingerprint(*[F.col(k) for k in keys]).alias("_fp")
    if not carry:
        return df.select(key, row_id).groupBy("_fp").agg(F.min(row_id).alias(row_id)).select(row_id)
    narrow = df.select(key, F.struct(row_id, *carry).alias("_row"))
    return narrow.groupBy("_fp").agg(F.min("_row").alias("_row")).select("_row.*")


def keep_first(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """Drop duplicates on the keys, keeping the row with the lowest id.

    The surviving ids are found on narrow rows; wide rows move once, spread
    over their unique id.
    """
    return df.join(first_rows(df, keys, row_id), row_id, "left_semi")


def drop_seen(df: DataFrame, text: str, *others: DataFrame, other_text: str = "text") -> DataFrame:
    """Drop rows whose normalised text occurs in any of the other corpora."""
    seen = None
    for other in others:
        part = other.select(TX.held(TX.fingerprint(TX.normalized(F.col(other_text)))).alias("_fp"))
        seen = part if seen is None else seen.unionByName(part)
    keyed = df.withColumn("_fp", TX.fingerprint(TX.normalized(F.col(text))))
    return keyed.join(seen.distinct(), "_fp", "left_anti").drop("_fp")


# Modulus and multipliers of the MinHash permutations.
PRIME = 2147483647
MULTIPLIER_STEP = 48271
OFFSET_STEP = 69621


def permutation(i: int) -> tuple[int, int]:
    """Multiplier and offset of the i-th permutation, from a fixed recurrence."""
    return pow(MULTIPLIER_STEP, i + 1, PRIME), pow(OFFSET_STEP, i + 1, PRIME)


def minhash_bands(
    df: DataFrame, id_col: str, text: str, shingle: int = 3, bands: int = 8, rows: int = 8
) -> DataFrame:
    """One row per text and band: (id, band, key).

    Texts with equal normalised content are hashed once by the caller's choice
    of ids. Each shingle becomes one row and the signature is a partial
    minimum, so long texts and hot texts combine inside their own task.
    """
    tokens = df.select(id_col, TX.held(TX.words(TX.normalized(F.col(text)))).alias("_w"))
    grams = tokens.select(
        id_col,
        F.explode(
            F.when(F.size("_w") < shingle, F.array(F.array_join("_w", " "))).otherwise(
                TX.ngrams(F.col("_w"), shingle)
            )
        ).alias("_g"),
    )
    hashed = grams.select(
        id_col, (F.conv(F.substring(F.md5("_g"), 1, 8), 16, 10).cast("bigint") % PRIME).alias("_h")
    )
    mins = [
        F.expr(f"min((_h * {a} + {b}) % {PRIME}) AS _p{i}")
        for i, (a, b) in enumerate(map(permutation, range(bands * rows)))
    ]
    keys = ", ".join(
        f"struct({b} AS band, md5(concat_ws('-', {', '.join(f'_p{b * rows + r}' for r in range(rows))})) AS key)"
        for b in range(bands)
    )
    return hashed.groupBy(id_col).agg(*mins).selectExpr(id_col, f"inline(array({keys}))")


def drop_near_seen(
    df: DataFrame, id_col: str, text: str, other: DataFrame, other_id: str, other_text: str = "text", **minhash
) -> DataFrame:
    """Drop rows that share a MinHash band with any text of another corpus.

    Only band keys are compared, by a semi-join against their distinct set: no
    pairs are built, however many texts fall into one band.
    """
    mine = minhash_bands(df, id_col, text, **minhash)
    theirs = minhash_bands(other, other_id, other_text, **minhash).select("band", "key").distinct()
    near = mine.join(theirs, ["band", "key"], "left_semi").select(id_col).distinct()
    return df.join(near, id_col, "left_anti")
