"""Replacing redacted-name tokens by names drawn from a weighted dictionary."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens import constants as K
from convlens.functions import conversation as C
from convlens.operators import ranking
from convlens.operators.embeddings import let

#: A dictionary is one value of the plan; a list of names is never longer than this.
LARGEST = 1_000_000


def name_intervals(names: DataFrame, name: str = "Name", weight: str = "Count", row_id: str = "Id") -> DataFrame:
    """(name, lo, hi): each name's share of [0, 1). A repeated name keeps its last weight."""
    unique = names.groupBy(F.col(name).alias("name")).agg(F.max_by(weight, row_id).alias("w"))
    keyed = unique.withColumn("_key", F.md5("name"))
    cum = ranking.running_totals(keyed, ["_key", "name"], ranking.hash_bucket(F.col("_key")), {"cum": F.col("w")})
    total = unique.agg(F.sum("w")).scalar()
    return cum.select("name", ((F.col("cum") - F.col("w")) / total).alias("lo"), (F.col("cum") / total).alias("hi"))


class NameTable:
    """The weighted dictionary as two arrays held by the plan, so that a draw is a look-up and meets no join."""

    def __init__(self, intervals: DataFrame):
        rows = intervals.orderBy("hi").limit(LARGEST + 1).collect()
        if len(rows) > LARGEST:
            raise ValueError(f"a dictionary of more than {LARGEST} names")
        rows = [r for r in rows if r["lo"] < r["hi"]]
        self.starts = [r["lo"] for r in rows]
        self.names = F.from_json(F.lit(json.dumps([r["name"] for r in rows])), "array<string>")

    def draw(self, key: Column, token: Column, seed=K.SEED) -> Column:
        """The name of a (key, token): equal pairs always draw the same one."""
        digest = F.md5(F.concat_ws("|", key.cast("string"), token, F.lit(str(seed))))
        u = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0
        if not self.starts:
            return F.lit(None).cast("string")
        return let(u, lambda x: F.get(self.names, ranking.limits_bucket(x, self.starts) - 1))


def found_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(K.NAME_TOKEN), F.lit(0))


def substitute(text: Column, name_of) -> Column:
    """Text with every token replaced by `name_of` the token; brackets around tokens stay, tokens without a name too."""
    between = F.split(text, K.NAME_TOKEN, -1)
    chosen = F.transform(found_tokens(text), lambda t: F.coalesce(name_of(t), t))
    return F.array_join(F.zip_with(between, chosen, lambda b, n: F.concat(b, F.coalesce(n, F.lit("")))), "")


def replace_in_conversations(
    df: DataFrame, key: str, conversation: str, names: DataFrame, redacted: Column | None = None, seed=K.SEED
) -> DataFrame:
    """Replace tokens in nested conversations: one name per token per conversation. No row moves."""
    table = NameTable(name_intervals(names))
    replaced = F.transform(
        F.col(conversation),
        lambda m: C.message(m["role"], substitute(m["content"], lambda t: table.draw(F.col(key), t, seed))),
    )
    return df.withColumn(conversation, replaced if redacted is None else F.when(redacted, replaced).otherwise(F.col(conversation)))


def replace_in_messages(df: DataFrame, key: str, text: str, names: DataFrame, redacted: Column | None = None, seed=K.SEED) -> DataFrame:
    """The same on one row per message. The draw depends on key and token alone,
    so messages of one conversation agree without being brought together."""
    table = NameTable(name_intervals(names))
    replaced = substitute(F.col(text), lambda t: table.draw(F.col(key), t, seed))
    return df.withColumn(text, replaced if redacted is None else F.when(redacted, replaced).otherwise(F.col(text)))
