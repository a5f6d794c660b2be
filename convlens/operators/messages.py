"""Facts of conversations from message rows: whatever a text is asked for is derived where it lies, and only that is grouped.

A message is one row with the conversation's id, its turn, role and text. No
conversation is brought together; what is shuffled are numbers, flags and, where
one text of a conversation is wanted, that text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.functions import text as TX


def sizes(df: DataFrame, key: str, role: str = "role", text: str = "text") -> DataFrame:
    """(key, n_words, n_chars, n_turns, n_user_turns); null texts count as turns only."""
    t = F.col(text)
    return df.groupBy(key).agg(
        F.sum(TX.word_count(t).cast("bigint")).alias("n_words"), F.sum(TX.char_count(t).cast("bigint")).alias("n_chars"),
        F.count("*").alias("n_turns"), F.count_if(F.col(role) == "user").alias("n_user_turns"),
    )


def moderation(df: DataFrame, key: str, flagged: Column, categories: dict[str, Column]) -> DataFrame:
    """(key, harm, flagged_categories, clean) from each message's flag and categories.

    harm: any message is flagged. A category counts if a flagged message has it.
    clean: no message has any category, flagged or not. Null counts as false.
    """
    flagged = F.coalesce(flagged, F.lit(False))
    marks = {name: F.coalesce(c, F.lit(False)) for name, c in categories.items()}
    rows = df.select(key, flagged.alias("_f"), *[c.alias(f"_c_{n}") for n, c in marks.items()])
    grouped = rows.groupBy(key).agg(
        F.bool_or("_f").alias("harm"), *[F.bool_or(f"_c_{n}").alias(f"_any_{n}") for n in marks],
        *[F.bool_or(F.col("_f") & F.col(f"_c_{n}")).alias(f"_in_{n}") for n in marks],
    )
    found = F.array_compact(F.array(*[F.when(F.col(f"_in_{n}"), F.lit(n)) for n in sorted(marks)]))
    clean = F.lit(True)
    for n in marks:
        clean = clean & ~F.col(f"_any_{n}")
    return grouped.select(key, "harm", found.alias("flagged_categories"), clean.alias("clean"))


def user_turns(df: DataFrame, key: str, turn: str = "turn", role: str = "role", text: str = "text", roles: Sequence[str] = ("user", "human")) -> DataFrame:
    """(key, n_user_turns, first_len, last_len, topic_text) of every conversation.

    Counted are non-empty turns of a user; `topic_text` is the first that is not
    blank, trimmed, and null where there is none.
    """
    t = F.col(text)
    sent = F.lower(role).isin(*roles) & (TX.char_count(t) > 0)
    rows = df.select(key, F.col(turn).alias("_t"), sent.alias("_sent"), TX.char_count(t).alias("_n"), F.when(sent & ~TX.is_blank(t), TX.strip(t)).alias("_text"))
    own = F.when(F.col("_sent"), F.col("_t"))
    return rows.groupBy(key).agg(
        F.count_if(F.coalesce("_sent", F.lit(False))).alias("n_user_turns"),
        F.coalesce(F.min_by("_n", own), F.lit(0)).alias("first_len"), F.coalesce(F.max_by("_n", own), F.lit(0)).alias("last_len"),
        F.min_by("_text", F.when(F.col("_text").isNotNull(), F.col("_t"))).alias("topic_text"),
    )


def topic_texts(df: DataFrame, key: str, **columns) -> DataFrame:
    """(key, topic_text) of the conversations that have a non-blank user turn; the others are dropped."""
    return user_turns(df, key, **columns).filter(F.col("topic_text").isNotNull()).select(key, "topic_text")


def drop_seen_turns(df: DataFrame, text: str, talks: DataFrame, key: str, last: bool = False, turn: str = "turn", role: str = "role", talk_text: str = "text") -> DataFrame:
    """The rows whose normalised text is not the first (or last) user turn of any conversation."""
    own = talks.filter(F.lower(role).isin("user", "human") & (TX.char_count(F.col(talk_text)) > 0))
    digest = TX.fingerprint(TX.normalized(F.col(talk_text)))
    pick = (F.max_by if last else F.min_by)("_d", "_t")
    seen = own.select(key, F.col(turn).alias("_t"), digest.alias("_d")).groupBy(key).agg(pick.alias("_fp")).select("_fp").distinct()
    keyed = df.withColumn("_fp", TX.fingerprint(TX.normalized(F.col(text))))
    return keyed.join(seen, "_fp", "left_anti").drop("_fp")
