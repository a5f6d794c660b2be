"""Joins with the checks the corpora need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.operators import quality


def one_to_one(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on a key that must be unique on both sides; raises otherwise."""
    quality.require_unique(left, key)
    quality.require_unique(right, key)
    return left.join(right, key, how)


def attach(left: DataFrame, meta: DataFrame, key: str, columns: Sequence[str], complete: bool = True) -> DataFrame:
    """Left-join metadata columns by key, which must be unique in them; with `complete`, every row must find some."""
    quality.require_unique(meta, key)
    joined = left.join(meta.select(key, *columns), key, "left")
    if complete:
        quality.require(joined, {f"no {c} for a row": F.col(c).isNull() for c in columns})
    return joined


def load_split(features: DataFrame, labels: DataFrame, split: str, key: str = "conversation_id",
               dataset: str | None = None) -> DataFrame:
    """Features beside labels of one split, tagged with the split (and dataset)."""
    joined = one_to_one(features, labels, key).withColumn("split", F.lit(split))
    return joined if dataset is None else joined.withColumn("dataset", F.lit(dataset))


def union_tagged(parts: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """All rows of the named tables, each tagged with its name."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(tag, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out
